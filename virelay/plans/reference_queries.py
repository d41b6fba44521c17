"""Registered queries of the read-analytics operators, each over whole tables, with the SQL that gives the same rows."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from virelay import schemas
from virelay.functions import seq as sq
from virelay.operators import align, compare, duplicates, hierarchy, joins, reads, relops, tree
from virelay.plans import workflows
from virelay.plans.problems import _LATEST
from virelay.session import shared_folder, table
from virelay.sources import writers
from virelay.streaming import incremental

#: A taxon the alignments of which count as artificial, and the note that marks a taxon as unclassified.
ARTIFICIAL, UNSURE = 100283, "rank unsure"


def _links(spark: SparkSession, d: str) -> DataFrame:
    return hierarchy.latest_links(table(spark, d, "test_virus_db"), "taxid", "parent_taxid", "loaded_at")


def _unclassified(spark: SparkSession, d: str, paths: DataFrame) -> DataFrame:
    names = table(spark, d, "test_virus_db").select(F.col("taxid").alias("node"), F.when(F.col("notes") == UNSURE, "unclassified").otherwise(F.col("notes")).alias("name"))
    return tree.unclassified_nodes(paths, names)


def _best_rows(spark: SparkSession, d: str) -> DataFrame:
    """The best alignment of each read."""
    t = table(spark, d, "tab_minimap").select("row_no", "seq_id", "taxid", "best_alignment_score", "genome_id", "ref_start", "sample")
    t = t.where("seq_id IS NOT NULL AND taxid IS NOT NULL AND best_alignment_score IS NOT NULL AND sample IS NOT NULL")
    return relops.distinct_on(t, ["seq_id"], [-F.col("best_alignment_score"), F.col("row_no")])


def clade_counts(spark: SparkSession, d: str) -> DataFrame:
    best = _best_rows(spark, d)
    exemplar = best.groupBy("sample", "genome_id", "ref_start").agg(F.min("seq_id").alias("exemplar"))
    keys = ["sample", "genome_id", "ref_start"]
    on = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    marked = best.alias("a").join(exemplar.alias("b"), on).select("a.sample", "a.seq_id", "a.taxid", "b.exemplar")
    links = _links(spark, d)
    return tree.clade_counts(marked, "sample", "seq_id", "exemplar", "taxid", links, hierarchy.full_paths(links))


def lca_by_read(spark: SparkSession, d: str) -> DataFrame:
    paths = hierarchy.full_paths(_links(spark, d))
    out = tree.lca_by_group(table(spark, d, "tab_minimap"), "seq_id", "taxid", "best_alignment_score", "row_no", paths, _unclassified(spark, d, paths), ARTIFICIAL)
    return out


def taxid_distance(spark: SparkSession, d: str) -> DataFrame:
    """Each alignment's taxid against that of its read's best alignment; all rows of tab_minimap."""
    best = _best_rows(spark, d).select("seq_id", F.col("taxid").alias("taxid_2"))
    pairs = table(spark, d, "tab_minimap").select("row_no", "seq_id", F.col("taxid").alias("taxid_1")).join(best, "seq_id", "left")
    return tree.taxid_distance(pairs.select("row_no", "taxid_1", "taxid_2"), "taxid_1", "taxid_2", hierarchy.full_paths(_links(spark, d)))


def taxid_distance_reads(spark: SparkSession, d: str) -> DataFrame:
    """Each alignment's taxid against the ancestor of its read; all rows of tab_minimap, those without a read or taxid too."""
    paths = hierarchy.full_paths(_links(spark, d))
    t = table(spark, d, "tab_minimap").select("row_no", "seq_id", "taxid", "best_alignment_score")
    lca = tree.lca_by_group(t, "seq_id", "taxid", "best_alignment_score", "row_no", paths, _unclassified(spark, d, paths), ARTIFICIAL).select("seq_id", "taxid_lca")
    pairs = t.join(lca, "seq_id", "left").select("row_no", F.col("taxid").alias("taxid_1"), F.col("taxid_lca").alias("taxid_2"))
    return tree.taxid_distance(pairs, "taxid_1", "taxid_2", paths)


def _trade_links(spark: SparkSession, d: str) -> DataFrame:
    """Root 1, regions from 10, nations from 1000, customers from 1000000."""
    region = table(spark, d, "region").select((F.col("r_regionkey") + 10).cast("bigint").alias("node"), F.lit(1).cast("bigint").alias("parent"), F.lit("family").alias("rank"))
    nation = table(spark, d, "nation").select((F.col("n_nationkey") + 1000).cast("bigint").alias("node"), (F.col("n_regionkey") + 10).cast("bigint").alias("parent"), F.lit("genus").alias("rank"))
    customer = table(spark, d, "customer").select((F.col("c_custkey") + 1000000).alias("node"), (F.col("c_nationkey") + 1000).cast("bigint").alias("parent"), F.lit("species").alias("rank"))
    root = spark.range(1).select(F.lit(1).cast("bigint").alias("node"), F.lit(None).cast("bigint").alias("parent"), F.lit("no rank").alias("rank"))
    return root.unionByName(region).unionByName(nation).unionByName(customer)


def raise_rank(spark: SparkSession, d: str) -> DataFrame:
    links = _trade_links(spark, d)
    return tree.raise_to_rank(hierarchy.full_paths(links), links.select("node", "rank"), "genus")


def infection_status(spark: SparkSession, d: str) -> DataFrame:
    links = _trade_links(spark, d)
    hosts = table(spark, d, "customer").where("c_acctbal > 5000 OR c_acctbal < 0").select((F.col("c_custkey") + 1000000).alias("node"), F.when(F.col("c_acctbal") > 5000, 1).otherwise(2).alias("host"))
    group = table(spark, d, "region").where("r_regionkey = 1").select(F.col("r_regionkey").alias("host"))
    out = tree.infection_status(links, hierarchy.full_paths(links), hosts, group)
    return out.groupBy("status").agg(F.count(F.lit(1)).alias("n_nodes"), F.sum("node").alias("node_sum"))


def nearest_marked(spark: SparkSession, d: str) -> DataFrame:
    paths = hierarchy.full_paths(_links(spark, d)).where("path IS NOT NULL")
    marked = table(spark, d, "test_infection_db").select(F.col("virus_tax_id").alias("node"))
    return hierarchy.nearest_in(paths, marked)


def _reads(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "read_entry").where("query_name IS NOT NULL")
    order = [F.col(c) for c in ("loaded_at", "genome_id", "aln_start", "aln_end", "avg_quality", "sample")]
    return relops.distinct_on(t, ["query_name"], order)


def _marked(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return duplicates.mark_duplicates(_reads(spark, d), "query_name", "genome_id", "aln_start", "aln_end", "avg_quality", 1)


def duplicate_reads(spark: SparkSession, d: str) -> DataFrame:
    return _marked(spark, d)[0]


def duplicate_groups(spark: SparkSession, d: str) -> DataFrame:
    return _marked(spark, d)[1]


def top_duplicate_groups(spark: SparkSession, d: str) -> DataFrame:
    return relops.top_rows(_marked(spark, d)[1].select("exemplar", "group_size"), 25, [F.col("group_size").desc(), F.col("exemplar")])


def rank_fraction(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "tab_minimap").where("seq_id IS NOT NULL").select("row_no", "seq_id", "best_alignment_score")
    return relops.rank_fraction_filter(t, "seq_id", "best_alignment_score", 5, 0.9).select("row_no", "seq_id", "rank", F.round("fraction", 6).alias("fraction"))


def best_per_pair(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "lineitem").select("l_partkey", "l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice")
    return relops.distinct_on(t, ["l_partkey", "l_suppkey"], [-F.col("l_extendedprice"), F.col("l_orderkey"), F.col("l_linenumber")])


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    """How many pairs each read is in as the first; reads and pairs have names that the other side lacks."""
    return table(spark, d, "duplicate_group").where("query_name IS NOT NULL").groupBy("query_name").agg(F.count(F.lit(1)).alias("n_pairs"))


def _joined(how: str):
    def run(spark: SparkSession, d: str) -> DataFrame:
        return joins.checked_join(_reads(spark, d).select("query_name", "sample"), _pairs(spark, d), "query_name", how)

    return run


def join_strict(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation").withColumnRenamed("n_regionkey", "r_regionkey")
    return joins.checked_join(n, table(spark, d, "region"), "r_regionkey", "strict")


def join_semi(spark: SparkSession, d: str) -> DataFrame:
    return joins.rows_with(_reads(spark, d).select("query_name", "sample"), _pairs(spark, d), "query_name")


def join_anti(spark: SparkSession, d: str) -> DataFrame:
    return joins.rows_without(_reads(spark, d).select("query_name", "sample"), _pairs(spark, d), "query_name")


def _alignments(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "tab_minimap").select("row_no", "taxid")


def _taxa(spark: SparkSession, d: str) -> DataFrame:
    return _links(spark, d).select(F.col("node").alias("taxid"), F.col("parent").alias("parent_taxid"))


def _joined_taxa(how: str):
    """All alignments with all taxa; either side has keys that the other lacks."""

    def run(spark: SparkSession, d: str) -> DataFrame:
        return joins.checked_join(_alignments(spark, d), _taxa(spark, d), "taxid", how)

    return run


def join_semi_taxa(spark: SparkSession, d: str) -> DataFrame:
    return joins.rows_with(_alignments(spark, d), _taxa(spark, d), "taxid")


def join_anti_taxa(spark: SparkSession, d: str) -> DataFrame:
    return joins.rows_without(_alignments(spark, d), _taxa(spark, d), "taxid")


def join_strict_parts(spark: SparkSession, d: str) -> DataFrame:
    """Lines with their parts: each line has a part, each part a line. Orders without lines exist, so orders would be an error."""
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("p_partkey"))
    return joins.checked_join(lines, table(spark, d, "part").select("p_partkey", "p_name"), "p_partkey", "strict")


def projections(spark: SparkSession, d: str) -> DataFrame:
    t = relops.keep_columns(table(spark, d, "customer"), ["c_custkey", "c_mktsegment", "c_name", "c_acctbal", "c_nationkey"])
    t = relops.drop_columns(relops.rename_columns(t, ["c_custkey", "c_nationkey"], ["c_nationkey", "c_custkey"]), ["c_acctbal", "none_such"])
    t = relops.add_fixed_columns(t, ["stage", "platform"], "raw")
    t = relops.add_conditional_column(t, "label", "c_mktsegment", "BUILDING", "c_name", "c_mktsegment")
    return relops.pad_columns(relops.prefix_columns(t, "x_", ["label"]), {"query_len_rev": "int"})


def filter_value(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "tab_minimap").select("row_no", F.col("edit_distance").cast("string").alias("cell"))
    return relops.filter_by_value(t, "cell", "2.0", keep=False).groupBy("cell").agg(F.count(F.lit(1)).alias("n_rows"))


def union_headers(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return relops.union_by_header([o.where("o_orderstatus = 'O'"), o.where("o_orderstatus <> 'O'").select("o_orderstatus", "o_orderkey", "o_custkey")]).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"), F.sum("o_custkey").alias("customers"))


def unique_rows(spark: SparkSession, d: str) -> DataFrame:
    return relops.assert_unique(table(spark, d, "tab_minimap").select("row_no", "classification"), ["row_no"]).groupBy("classification").agg(F.count(F.lit(1)).alias("n"))


def chunks(spark: SparkSession, d: str) -> DataFrame:
    t = relops.chunk_rows(table(spark, d, "tab_minimap").select("row_no"), 1000, ["row_no"])
    return t.groupBy("chunk").agg(F.count(F.lit(1)).alias("n"), F.min("row_no").alias("first_row"), F.max("row_no").alias("last_row"))


def missing_hosts(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "test_infection_db").select(F.col("host_tax_id").alias("taxid"))
    return relops.set_difference(a, table(spark, d, "host_nodes"), "taxid")


def read_counts(spark: SparkSession, d: str) -> DataFrame:
    return reads.read_counts(_reads(spark, d), "sample", paired=True)


def qc_basic(spark: SparkSession, d: str) -> DataFrame:
    return reads.basic_stats(table(spark, d, "tab_minimap"), "sample", "query_seq")


def qc_lengths(spark: SparkSession, d: str) -> DataFrame:
    return reads.length_stats(table(spark, d, "tab_minimap"), "sample", "query_seq")


def qc_quality_by_base(spark: SparkSession, d: str) -> DataFrame:
    return reads.quality_by_base(table(spark, d, "tab_minimap"), "sample", "query_qual")


def qc_quality_by_read(spark: SparkSession, d: str) -> DataFrame:
    return reads.quality_by_sequence(table(spark, d, "tab_minimap"), "sample", "query_qual")


def strand_sequences(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "tab_minimap").where("query_seq IS NOT NULL")
    turned = F.when(F.col("query_rc"), sq.reverse_complement(F.col("query_seq"))).otherwise(F.col("query_seq"))
    return t.select("row_no", turned.alias("read_seq"), F.round(sq.long_read_score(F.col("best_alignment_score"), F.col("query_len")), 6).alias("score"), F.round(sq.mean_phred(F.col("query_qual")), 6).alias("mean_phred"))


def kmer_screen(spark: SparkSession, d: str) -> DataFrame:
    """Reads that share a 24-mer with the supplementary alignments' sequences."""
    t = table(spark, d, "tab_minimap").where("query_seq IS NOT NULL").select("row_no", "query_seq", "classification")
    index = reads.kmer_index(t.where("classification = 'supplementary'"), "row_no", "query_seq", 24)
    return reads.kmer_screen(t, "row_no", "query_seq", index, 24)


def low_complexity(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "tab_minimap").where("query_seq IS NOT NULL")
    e = t.select(F.floor(F.round(sq.linguistic_entropy(F.col("query_seq")), 9) * 20).alias("bin"))
    return e.groupBy("bin").agg(F.count(F.lit(1)).alias("n_reads"))


def index_changes(spark: SparkSession, d: str) -> DataFrame:
    """Taxa that the taxonomy of July lost or gained against that of January."""
    v = table(spark, d, "test_virus_db")
    old, new = (v.where(f"loaded_at <= timestamp_ntz'{t}' AND (deleted_at IS NULL OR deleted_at > timestamp_ntz'{t}')") for t in ("2025-01-01 00:00:00", "2025-07-01 00:00:00"))
    return compare.changed_keys(old, new, "taxid")


def parent_transitions(spark: SparkSession, d: str) -> DataFrame:
    v = table(spark, d, "test_virus_db").where("taxid IS NOT NULL")
    first = relops.distinct_on(v, ["taxid"], [F.col("loaded_at"), F.col("expected_status_jabberwocks"), F.col("parent_taxid")])
    last = v.groupBy("taxid").agg(F.max(F.struct("loaded_at", "expected_status_jabberwocks", "parent_taxid")).alias("m")).select("taxid", "m.*")
    return compare.transitions(first, last, "taxid", "parent_taxid")


def species_deltas(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "tab_minimap").where("genome_id IS NOT NULL")
    return compare.count_deltas(t.where("aligned_at < timestamp_ntz'2025-07-01 00:00:00'"), t.where("aligned_at >= timestamp_ntz'2025-07-01 00:00:00'"), "genome_id")


def metric_changes(spark: SparkSession, d: str) -> DataFrame:
    a = compare.table_metrics(table(spark, d, "read_entry").where("sequenced_at < timestamp_ntz'2025-07-01 00:00:00'").select("query_name", "genome_id", "avg_quality"))
    b = compare.table_metrics(table(spark, d, "read_entry").where("sequenced_at >= timestamp_ntz'2025-07-01 00:00:00'").select("query_name", "genome_id", "avg_quality"))
    return compare.metric_changes(a, b)


def schema_violations(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "duplicate_group").select(F.col("genome_id").alias("prim_align_genome_id_all"), F.col("exemplar_name").alias("prim_align_dup_exemplar"), F.col("group_size").alias("prim_align_dup_count"), F.col("pairwise_match_frac").alias("prim_align_dup_pairwise_match_frac"))
    return schemas.violations(t, schemas.TABLES["duplicate_stats"])


def fastq_records(spark: SparkSession, d: str) -> DataFrame:
    t = _best_rows(spark, d).select("row_no").join(table(spark, d, "tab_minimap"), "row_no").where("query_seq IS NOT NULL AND query_qual IS NOT NULL")
    return writers.fastq_text(t.select("seq_id", "query_seq", "query_qual"))


def group_json(spark: SparkSession, d: str) -> DataFrame:
    per = table(spark, d, "read_entry").where("sample IS NOT NULL AND genome_id IS NOT NULL").groupBy("genome_id", "sample").agg(F.to_json(F.struct(F.count(F.lit(1)).alias("n"))).alias("payload"))
    return writers.group_json(per, "genome_id", "sample", "payload").select("genome_id", F.explode(F.from_json("json", "map<string,map<string,string>>")).alias("sample", "entry")).select(
        "genome_id", "sample", F.col("entry")["n"].cast("bigint").alias("n_reads"), F.col("entry")["sample"].alias("own_sample"), F.col("entry")["group"].alias("own_group")
    )


def annotated_hits(spark: SparkSession, d: str) -> DataFrame:
    """Each read's ancestor beside its primary alignments."""
    t = table(spark, d, "tab_minimap").where("seq_id IS NOT NULL AND taxid IS NOT NULL AND best_alignment_score IS NOT NULL")
    t = t.select("row_no", "seq_id", "taxid", F.col("best_alignment_score").alias("length_normalized_score"), "genome_id", "classification")
    return workflows.annotated_hits(t, _links(spark, d), "all", None, ARTIFICIAL).groupBy("taxid_lca_combined").agg(F.count(F.lit(1)).alias("n_alignments"), F.sum("prim_align_row_no").alias("row_sum"))


def _sam(spark: SparkSession, d: str) -> DataFrame:
    """The alignments as records of a SAM file, sequences in the reference's direction."""
    t = table(spark, d, "tab_minimap").where("seq_id IS NOT NULL AND genome_id IS NOT NULL AND taxid IS NOT NULL AND query_seq IS NOT NULL AND best_alignment_score IS NOT NULL AND ref_start IS NOT NULL")
    rc = F.coalesce("query_rc", F.lit(False))
    flag = F.when(rc, sq.REVERSE).otherwise(0) + F.when(F.col("classification") == "supplementary", sq.SUPPLEMENTARY).when(F.col("classification") == "secondary", sq.SECONDARY).otherwise(0)
    return t.select(
        "seq_id", flag.alias("flag"), F.col("genome_id").alias("rname"), (F.col("ref_start") + 1).alias("pos"), F.col("map_qual").alias("mapq"), "cigar", F.lit("*").alias("rnext"), F.lit(0).alias("pnext"),
        F.lit(0).alias("tlen"), F.when(rc, sq.reverse_complement(F.col("query_seq"))).otherwise(F.col("query_seq")).alias("seq"), F.when(rc, F.reverse("query_qual")).otherwise(F.col("query_qual")).alias("qual"),
        F.col("best_alignment_score").alias("as_score"), F.col("next_alignment_score").alias("xs_score"), F.lit(None).cast("int").alias("ys_score"), F.col("edit_distance").alias("nm"), F.lit("UU").alias("pair_status"), F.col("row_no").alias("ordinal"),
    )


def _genomes(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Genomes with two taxids, and the taxids that count as viral."""
    g = table(spark, d, "tab_minimap").where("genome_id IS NOT NULL AND taxid IS NOT NULL").groupBy("genome_id").agg(F.min("taxid").alias("taxid"), F.max("taxid").alias("species_taxid"))
    return g, table(spark, d, "test_infection_db").select(F.col("virus_tax_id").alias("taxid"))


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(c, 6).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes])


def unpaired_hits(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(align.unpaired_hits(_sam(spark, d), *_genomes(spark, d)))


def paired_hits(spark: SparkSession, d: str) -> DataFrame:
    """The two best alignments of each read as a pair; a read with one alignment has no mate."""
    s = _sam(spark, d)
    two = s.withColumn("mate", F.row_number().over(Window.partitionBy("seq_id").orderBy(F.col("as_score").desc(), "ordinal"))).where("mate <= 2")
    first, n = Window.partitionBy("seq_id"), F.count(F.lit(1)).over(Window.partitionBy("seq_id"))
    other = {c: F.sum(c).over(first) - F.col(c) for c in ("pos", "as_score")}
    pair = n == 2
    flag = F.col("flag").bitwiseAND(sq.REVERSE) + sq.PAIRED + F.when(F.col("mate") == 1, sq.READ1).otherwise(sq.READ2) + F.when(pair, 0).otherwise(sq.MATE_UNMAPPED)
    sam = two.withColumns({
        "flag": flag.cast("int"), "pnext": F.when(pair, other["pos"]).otherwise(F.col("pos")).cast("int"), "tlen": F.when(pair, other["pos"] - F.col("pos")).otherwise(0).cast("int"),
        "ys_score": F.when(pair, other["as_score"]).cast("int"), "pair_status": F.when(pair, "CP").otherwise("UP"),
    }).drop("mate")
    genomes, viral = _genomes(spark, d)
    return _rounded(workflows.hits_from_sam(sam, genomes, 20.0, viral).drop("group_id"))


def streamed_counts(spark: SparkSession, d: str) -> DataFrame:
    """Alignments of each genome and day, counted by a stream over the table's files; redelivered rows are in.

    Windows leave the state 90 days after the latest time seen, more than any row of the table is late. Each batch writes the windows it changed, to the
    shared folder; of a window the highest count is the last.
    """
    at = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    rows = incremental.stream_table(spark, d, "tab_minimap", 8).where("genome_id IS NOT NULL").withColumn("aligned_at", F.col("aligned_at").cast("timestamp"))
    counts = incremental.windowed_counts(rows, "genome_id", "aligned_at", "1 day", "90 days")
    q = counts.writeStream.outputMode("update").option("checkpointLocation", at + "/state").trigger(availableNow=True).foreachBatch(lambda b, i: b.write.mode("overwrite").parquet(f"{at}/out/batch={i}")).start()
    q.awaitTermination()
    out = spark.read.parquet(at + "/out").groupBy("window_start", "genome_id").agg(F.max("n_rows").alias("n_rows"))
    return out.select(F.date_format("window_start", "yyyy-MM-dd").alias("day"), "genome_id", "n_rows")


QUERIES = {
    f.__name__: f
    for f in (
        clade_counts, lca_by_read, taxid_distance, taxid_distance_reads, raise_rank, infection_status, nearest_marked, duplicate_reads, duplicate_groups, top_duplicate_groups, rank_fraction,
        best_per_pair, join_strict, join_semi, join_anti, join_semi_taxa, join_anti_taxa, join_strict_parts, projections, filter_value, union_headers, unique_rows, chunks, missing_hosts, read_counts, qc_basic, qc_lengths,
        qc_quality_by_base, qc_quality_by_read, strand_sequences, kmer_screen, low_complexity, index_changes, parent_transitions, species_deltas, metric_changes,
        schema_violations, fastq_records, group_json, annotated_hits, unpaired_hits, paired_hits, streamed_counts,
    )
}
QUERIES |= {f"join_{how}": _joined(how) for how in ("inner", "left", "right", "outer")}
QUERIES |= {f"join_{how}_taxa": _joined_taxa(how) for how in ("inner", "left", "right", "outer")}

_ROWS = "SELECT seq_id g, taxid t, CAST(best_alignment_score AS DOUBLE) s, row_no o FROM tab_minimap WHERE seq_id IS NOT NULL AND taxid IS NOT NULL AND best_alignment_score IS NOT NULL"
_UNC = f"SELECT DISTINCT x.taxid FROM tree x WHERE EXISTS (SELECT 1 FROM test_virus_db v WHERE v.notes = '{UNSURE}' AND list_contains(x.path, v.taxid)) UNION SELECT taxid FROM test_virus_db WHERE notes = '{UNSURE}'"


def _lca_sql(rows: str, unclassified: str | None, only_combined: bool = False) -> str:
    parts = [f"rows_ AS ({rows})", f"unc AS ({unclassified or 'SELECT -1 taxid WHERE false'})", f"info AS (SELECT r.*, x.path, u.taxid IS NULL c, coalesce(list_contains(x.path, {ARTIFICIAL}), false) art FROM rows_ r LEFT JOIN tree x ON x.taxid = r.t LEFT JOIN unc u ON u.taxid = r.t)"]
    cols, joins_ = [], []
    subsets = {"_combined": "true"} if only_combined else {"_combined": "true", "": "NOT art", "_artificial": "art"}
    for k, cond in subsets.items():
        n = k or "_natural"
        parts += [
            f"sub{n} AS (SELECT *, max(s) OVER (PARTITION BY g) m, row_number() OVER (PARTITION BY g ORDER BY s DESC, c DESC, o) r FROM info WHERE {cond})",
            f"top{n} AS (SELECT g, bool_or(c) FILTER (WHERE s = m) cm FROM sub{n} GROUP BY g)",
            f"el{n} AS (SELECT DISTINCT b.g, b.t, b.path FROM sub{n} b JOIN top{n} p USING (g) WHERE b.c OR (b.s = b.m AND NOT p.cm))",
            f"cnt{n} AS (SELECT g, count(*) n, min(t) a, bool_or(path IS NULL) u FROM el{n} GROUP BY g)",
            f"anc{n} AS (SELECT g, a, max(i) i, count(*) n FROM (SELECT g, unnest(path) a, unnest(range(1, len(path) + 1)) i FROM el{n}) GROUP BY g, a)",
            f"deep{n} AS (SELECT x.g, arg_max(x.a, x.i) a FROM anc{n} x JOIN cnt{n} c ON c.g = x.g AND c.n = x.n GROUP BY x.g)",
            f"res{n} AS (SELECT b.g, count(*) n_entries, count(*) FILTER (WHERE c) n_classified, max(t) FILTER (WHERE r = 1) top, bool_or(c) FILTER (WHERE r = 1) topc, min(s) lo, max(s) hi, round(avg(s), 6) mean FROM sub{n} b GROUP BY b.g)",
            f"fin{n} AS (SELECT r.*, CASE WHEN c.n = 1 THEN c.a WHEN c.u THEN 1 ELSE coalesce(d.a, 1) END lca FROM res{n} r LEFT JOIN cnt{n} c USING (g) LEFT JOIN deep{n} d USING (g))",
        ]
        f = f"f{n}"
        cols += [f"coalesce({f}.n_entries, 0) n_entries{k}, coalesce({f}.n_classified, 0) n_classified{k}, {f}.top taxid_top{k}, {f}.topc top_classified{k}, {f}.lo score_min{k}, {f}.hi score_max{k}, {f}.mean score_mean{k}, {f}.lca taxid_lca{k}"]
        joins_.append(f"LEFT JOIN fin{n} {f} ON {f}.g = q.g")
    parts.append(f"lca AS (SELECT q.g seq_id, {', '.join(cols)} FROM (SELECT DISTINCT g FROM rows_) q {' '.join(joins_)})")
    return ", ".join(parts)


_BEST = "best AS (SELECT row_no, seq_id, taxid, genome_id, ref_start, sample FROM (SELECT *, row_number() OVER (PARTITION BY seq_id ORDER BY best_alignment_score DESC, row_no) r FROM tab_minimap WHERE seq_id IS NOT NULL AND taxid IS NOT NULL AND best_alignment_score IS NOT NULL AND sample IS NOT NULL) WHERE r = 1)"
_READS = "reads_ AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_name ORDER BY loaded_at, genome_id NULLS FIRST, aln_start NULLS FIRST, aln_end NULLS FIRST, avg_quality NULLS FIRST, sample NULLS FIRST) r FROM read_entry WHERE query_name IS NOT NULL) WHERE r = 1)"
_GROUPS = f"""WITH RECURSIVE {_READS},
  placed AS (SELECT query_name, genome_id g, coalesce(least(aln_start, aln_end), aln_start, aln_end) lo, CASE WHEN aln_start IS NOT NULL AND aln_end IS NOT NULL THEN greatest(aln_start, aln_end) END hi, coalesce(avg_quality, 0) q
    FROM reads_ WHERE genome_id IS NOT NULL AND (aln_start IS NOT NULL OR aln_end IS NOT NULL)),
  nodes AS (SELECT row_number() OVER (ORDER BY g, lo, hi NULLS FIRST) id, g, lo, hi, n FROM (SELECT g, lo, hi, count(*) n FROM placed GROUP BY ALL)),
  links AS (SELECT a.id a, b.id b, a.n * b.n w FROM nodes a JOIN nodes b ON a.g = b.g AND a.id <> b.id AND abs(a.lo - b.lo) <= 1 AND ((a.hi IS NULL AND b.hi IS NULL) OR abs(a.hi - b.hi) <= 1)),
  reach(a, b) AS (SELECT id, id FROM nodes UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
  comp AS (SELECT a id, min(b) c FROM reach GROUP BY a),
  member AS (SELECT p.query_name, p.g, p.q, c.c FROM placed p JOIN nodes n ON n.g = p.g AND n.lo = p.lo AND n.hi IS NOT DISTINCT FROM p.hi JOIN comp c ON c.id = n.id),
  ex AS (SELECT c, first(query_name ORDER BY q DESC, query_name) exemplar, first(g) genome, count(*) group_size FROM member GROUP BY c),
  pairs AS (SELECT c, sum(w) w FROM (SELECT c.c, l.w FROM links l JOIN comp c ON c.id = l.a WHERE l.a < l.b UNION ALL SELECT c.c, n.n * (n.n - 1) / 2 FROM nodes n JOIN comp c USING (id)) GROUP BY c)"""
_PAIRS = "pairs_ AS (SELECT query_name, count(*) n_pairs FROM duplicate_group WHERE query_name IS NOT NULL GROUP BY query_name)"
_PHRED = "[ascii(x) - 33 for x in string_split(query_qual, '')]"
_RC = "translate(reverse(query_seq), 'ACGTUNRYSWKMBDHVacgtunryswkmbdhv', 'TGCAANYRSWMKVHDBtgcaanyrswmkvhdb')"


_FIELDS = "best_alignment_score, next_alignment_score, edit_distance, ref_start, map_qual, cigar, query_len, query_seq, query_rc, query_qual"
_HITS = """viral AS (SELECT DISTINCT virus_tax_id v FROM test_infection_db WHERE virus_tax_id IS NOT NULL),
      genome AS (SELECT genome_id, min(taxid) t, max(taxid) s FROM tab_minimap WHERE genome_id IS NOT NULL AND taxid IS NOT NULL GROUP BY genome_id),
      hit AS (SELECT seq_id, genome_id, CASE WHEN t IN (SELECT v FROM viral) THEN t WHEN s IN (SELECT v FROM viral) THEN s ELSE t END taxid, best_alignment_score, next_alignment_score, edit_distance, ref_start, map_qual, cigar,
        CAST(length(query_seq) AS INT) query_len, query_seq, coalesce(query_rc, false) query_rc, query_qual, CASE WHEN length(query_seq) <= 1 THEN 0 ELSE best_alignment_score / ln(length(query_seq)) END norm,
        CASE WHEN classification IN ('supplementary', 'secondary') THEN classification ELSE 'primary' END classification, row_no
        FROM tab_minimap JOIN genome USING (genome_id) WHERE seq_id IS NOT NULL AND taxid IS NOT NULL AND query_seq IS NOT NULL AND best_alignment_score IS NOT NULL AND ref_start IS NOT NULL)"""


def _at(t: str) -> str:
    return f"SELECT DISTINCT taxid FROM test_virus_db WHERE taxid IS NOT NULL AND loaded_at <= TIMESTAMP '{t}' AND (deleted_at IS NULL OR deleted_at > TIMESTAMP '{t}')"


def _metric_sql(cond: str) -> str:
    return " UNION ALL ".join(f"SELECT '{m}' metric, CAST({e} AS DOUBLE) v FROM read_entry WHERE {cond}" for m, e in (("rows", "count(*)"), ("query_name.filled", "count(query_name)"), ("genome_id.filled", "count(genome_id)"), ("avg_quality.filled", "count(avg_quality)")))


ORACLE = {
    "clade_counts": f"""WITH RECURSIVE {_LATEST}, {_BEST},
      marked AS (SELECT *, min(seq_id) OVER (PARTITION BY sample, genome_id, ref_start) e FROM best),
      direct AS (SELECT sample g, taxid, count(*) t, count(*) FILTER (WHERE seq_id = e) u FROM marked GROUP BY ALL),
      up AS (SELECT d.g, d.taxid, d.t, d.u, unnest(x.path) a FROM direct d JOIN tree x USING (taxid))
      SELECT u.g "group", u.a taxid, coalesce(l.p, 1) parent_taxid, sum(CASE WHEN u.a = u.taxid THEN t ELSE 0 END) reads_direct_total, sum(CASE WHEN u.a = u.taxid THEN u.u ELSE 0 END) reads_direct_dedup,
        sum(t) reads_clade_total, sum(u.u) reads_clade_dedup FROM up u JOIN links l ON l.taxid = u.a GROUP BY ALL""",
    "lca_by_read": f"WITH RECURSIVE {_LATEST}, {_lca_sql(_ROWS, _UNC)} SELECT * FROM lca",
    "taxid_distance": f"""WITH RECURSIVE {_LATEST}, {_BEST},
      j AS (SELECT a.row_no, a.taxid taxid_1, b.taxid taxid_2, x.path p1, y.path p2 FROM tab_minimap a LEFT JOIN best b USING (seq_id) LEFT JOIN tree x ON x.taxid = a.taxid LEFT JOIN tree y ON y.taxid = b.taxid),
      s AS (SELECT *, len([v for v in p1 if list_contains(p2, v)]) k FROM j)
      SELECT row_no, taxid_1, taxid_2, CASE WHEN k > 0 THEN CAST(len(p1) - k AS INT) END distance_1, CASE WHEN k > 0 THEN CAST(len(p2) - k AS INT) END distance_2 FROM s""",
    "taxid_distance_reads": f"""WITH RECURSIVE {_LATEST}, {_lca_sql(_ROWS, _UNC)},
      j AS (SELECT a.row_no, a.taxid taxid_1, b.taxid_lca taxid_2, x.path p1, y.path p2 FROM tab_minimap a LEFT JOIN lca b USING (seq_id) LEFT JOIN tree x ON x.taxid = a.taxid LEFT JOIN tree y ON y.taxid = b.taxid_lca),
      s AS (SELECT *, len([v for v in p1 if list_contains(p2, v)]) k FROM j)
      SELECT row_no, taxid_1, taxid_2, CASE WHEN k > 0 THEN CAST(len(p1) - k AS INT) END distance_1, CASE WHEN k > 0 THEN CAST(len(p2) - k AS INT) END distance_2 FROM s""",
    "raise_rank": "SELECT 1::BIGINT node, NULL::BIGINT raised UNION ALL SELECT r_regionkey + 10, NULL FROM region UNION ALL SELECT n_nationkey + 1000, n_nationkey + 1000 FROM nation UNION ALL SELECT c_custkey + 1000000, c_nationkey + 1000 FROM customer",
    "nearest_marked": f"""WITH RECURSIVE {_LATEST}, steps AS (SELECT taxid, unnest(path) a, unnest(range(1, len(path) + 1)) i FROM tree)
      SELECT t.taxid node, arg_max(s.a, s.i) nearest FROM tree t LEFT JOIN (SELECT * FROM steps WHERE a IN (SELECT virus_tax_id FROM test_infection_db)) s USING (taxid) GROUP BY t.taxid""",
    "duplicate_reads": f"{_GROUPS} SELECT m.query_name, e.exemplar FROM member m JOIN ex e USING (c)",
    "duplicate_groups": f"{_GROUPS} SELECT e.exemplar, e.genome, e.group_size, CASE WHEN group_size > 1 THEN round(p.w / (group_size * (group_size - 1) / 2), 6) ELSE 1.0 END pairwise_match_frac FROM ex e JOIN pairs p USING (c)",
    "top_duplicate_groups": f"{_GROUPS} SELECT exemplar, group_size FROM ex ORDER BY group_size DESC, exemplar LIMIT 25",
    "rank_fraction": "SELECT row_no, seq_id, CAST(rank AS INT) rank, round(fraction, 6) fraction FROM (SELECT row_no, seq_id, dense_rank() OVER (PARTITION BY seq_id ORDER BY best_alignment_score DESC) rank, best_alignment_score / max(best_alignment_score) OVER (PARTITION BY seq_id) fraction FROM tab_minimap WHERE seq_id IS NOT NULL AND best_alignment_score IS NOT NULL) WHERE rank <= 5 AND (rank = 1 OR fraction >= 0.9)",
    "best_per_pair": "SELECT l_partkey, l_suppkey, l_orderkey, l_linenumber, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey, l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) r FROM lineitem) WHERE r = 1",
    "join_strict": "SELECT n_nationkey, n_name, r_regionkey, r_name FROM nation JOIN region ON r_regionkey = n_regionkey",
    "join_semi": f"WITH {_READS}, {_PAIRS} SELECT query_name, sample FROM reads_ WHERE query_name IN (SELECT query_name FROM pairs_)",
    "join_anti": f"WITH {_READS}, {_PAIRS} SELECT query_name, sample FROM reads_ WHERE query_name NOT IN (SELECT query_name FROM pairs_)",
    **{f"join_{how}": f"WITH {_READS}, {_PAIRS} SELECT coalesce(a.query_name, b.query_name) query_name, a.sample, b.n_pairs FROM reads_ a {how if how != 'outer' else 'full'} JOIN pairs_ b ON a.query_name = b.query_name" for how in ("inner", "left", "right", "outer")},
    "join_strict_parts": "SELECT l_orderkey, l_linenumber, p_partkey, p_name FROM lineitem JOIN part ON p_partkey = l_partkey",
    "join_semi_taxa": "SELECT row_no, taxid FROM tab_minimap WHERE taxid IN (SELECT taxid FROM test_virus_db WHERE taxid IS NOT NULL)",
    "join_anti_taxa": "SELECT row_no, taxid FROM tab_minimap a WHERE NOT EXISTS (SELECT 1 FROM test_virus_db v WHERE v.taxid = a.taxid)",
    **{f"join_{how}_taxa": f"WITH RECURSIVE {_LATEST} SELECT a.row_no, coalesce(a.taxid, b.taxid) taxid, b.p parent_taxid FROM tab_minimap a {how if how != 'outer' else 'full'} JOIN links b ON a.taxid = b.taxid" for how in ("inner", "left", "right", "outer")},
    "projections": "SELECT c_custkey c_nationkey, c_mktsegment, c_name, c_nationkey c_custkey, 'raw' stage, 'raw' platform, CASE WHEN c_mktsegment = 'BUILDING' THEN c_name ELSE c_mktsegment END x_label, CAST(NULL AS INT) query_len_rev FROM customer",
    "filter_value": "SELECT CAST(edit_distance AS VARCHAR) cell, count(*) n_rows FROM tab_minimap WHERE edit_distance IS NULL OR edit_distance <> 2 GROUP BY ALL",
    "union_headers": "SELECT o_orderstatus, count(*) n, CAST(sum(o_orderkey) AS BIGINT) keys, CAST(sum(o_custkey) AS BIGINT) customers FROM orders GROUP BY ALL",
    "unique_rows": "SELECT classification, count(*) n FROM tab_minimap GROUP BY ALL",
    "chunks": "SELECT (n - 1) // 1000 + 1 chunk, count(*) n, min(row_no) first_row, max(row_no) last_row FROM (SELECT row_no, row_number() OVER (ORDER BY row_no) n FROM tab_minimap) GROUP BY ALL",
    "missing_hosts": "SELECT host_tax_id taxid FROM test_infection_db EXCEPT SELECT taxid FROM host_nodes",
    "read_counts": f"WITH {_READS} SELECT sample, count(*) * 2 n_reads_single, count(*) n_read_pairs FROM reads_ GROUP BY sample",
    "qc_basic": """SELECT sample, count(*) n_reads, CAST(sum(length(query_seq)) AS BIGINT) n_bases, round(sum(length(query_seq)) / count(*), 4) mean_seq_len,
      round(sum(length(regexp_replace(upper(query_seq), '[^GC]', '', 'g'))) * 100 / sum(length(query_seq)), 4) percent_gc,
      round((count(*) - count(DISTINCT upper(query_seq))) * 100 / count(*), 4) percent_duplicates, count(DISTINCT upper(query_seq)) n_distinct FROM tab_minimap WHERE query_seq IS NOT NULL GROUP BY sample""",
    "qc_lengths": "SELECT sample, length(query_seq) length, count(*) n_sequences FROM tab_minimap WHERE query_seq IS NOT NULL GROUP BY ALL",
    "qc_quality_by_base": f"SELECT sample, CAST(p AS INT) \"position\", round(avg(q), 4) mean_phred_score FROM (SELECT sample, unnest({_PHRED}) q, unnest(range(1, length(query_qual) + 1)) p FROM tab_minimap WHERE length(query_qual) > 0) GROUP BY sample, p",
    "qc_quality_by_read": f"SELECT sample, CAST(floor(CASE WHEN length(query_qual) > 0 THEN list_avg({_PHRED}) ELSE 0 END) AS BIGINT) mean_phred_score, count(*) n_sequences FROM tab_minimap WHERE query_qual IS NOT NULL GROUP BY ALL",
    "strand_sequences": f"SELECT row_no, CASE WHEN query_rc THEN {_RC} ELSE query_seq END read_seq, round(CASE WHEN query_len <= 1 THEN 0 ELSE best_alignment_score / ln(query_len) END, 6) score, round(CASE WHEN length(query_qual) > 0 THEN list_avg({_PHRED}) ELSE 0 END, 6) mean_phred FROM tab_minimap WHERE query_seq IS NOT NULL",
    "low_complexity": """WITH w AS (SELECT row_no, unnest([substring(upper(query_seq), i, 3) for i in range(1, length(query_seq) - 1)]) w FROM tab_minimap WHERE query_seq IS NOT NULL),
      c AS (SELECT row_no, sum(c) n, sum(c * log2(c)) s FROM (SELECT row_no, w, count(*) c FROM w GROUP BY ALL) GROUP BY row_no)
      SELECT CAST(floor(round((log2(n) - s / n) / log2(least(n, 64)), 9) * 20) AS BIGINT) bin, count(*) n_reads
      FROM tab_minimap t LEFT JOIN (SELECT * FROM c WHERE n >= 2) c USING (row_no) WHERE query_seq IS NOT NULL GROUP BY ALL""",
    "schema_violations": """WITH d AS (SELECT genome_id g, exemplar_name e, group_size n, pairwise_match_frac f FROM duplicate_group),
      v AS (SELECT 'prim_align_genome_id_all' c, 'null' p, count(*) FILTER (WHERE g IS NULL) n FROM d
        UNION ALL SELECT 'prim_align_genome_id_all', 'pattern', count(*) FILTER (WHERE NOT regexp_full_match(g, '[^/]+(/[^/]+)?')) FROM d
        UNION ALL SELECT 'prim_align_dup_count', 'null', count(*) FILTER (WHERE n IS NULL) FROM d
        UNION ALL SELECT 'prim_align_dup_count', 'below 1', count(*) FILTER (WHERE n < 1) FROM d
        UNION ALL SELECT 'prim_align_dup_pairwise_match_frac', 'null', count(*) FILTER (WHERE f IS NULL) FROM d
        UNION ALL SELECT 'prim_align_dup_pairwise_match_frac', 'below 0', count(*) FILTER (WHERE f < 0) FROM d
        UNION ALL SELECT 'prim_align_dup_pairwise_match_frac', 'above 1', count(*) FILTER (WHERE f > 1) FROM d
        UNION ALL SELECT 'prim_align_dup_exemplar', 'repeated key', count(*) FROM (SELECT e FROM d GROUP BY e HAVING count(*) > 1))
      SELECT c "column", p problem, n n_rows FROM v WHERE n > 0""",
    "kmer_screen": """WITH r AS (SELECT row_no, upper(query_seq) s, classification FROM tab_minimap WHERE query_seq IS NOT NULL),
      w AS (SELECT row_no, classification, w FROM (SELECT row_no, classification, unnest([substring(s, i, 24) for i in range(1, length(s) - 22)]) w FROM r) WHERE NOT regexp_matches(w, '[^ACGT]')),
      k AS (SELECT DISTINCT row_no, classification, least(w, translate(reverse(w), 'ACGT', 'TGCA')) kmer FROM w),
      i AS (SELECT DISTINCT kmer FROM k WHERE classification = 'supplementary')
      SELECT r.row_no, CAST(count(k.kmer) AS INT) n_kmers, count(i.kmer) n_hits, count(i.kmer) > 0 matched FROM r LEFT JOIN k USING (row_no) LEFT JOIN i ON i.kmer = k.kmer GROUP BY r.row_no""",
    "index_changes": f"WITH a AS ({_at('2025-01-01')}), b AS ({_at('2025-07-01')}) SELECT taxid, 'lost' change FROM a WHERE taxid NOT IN (SELECT taxid FROM b) UNION ALL SELECT taxid, 'gained' FROM b WHERE taxid NOT IN (SELECT taxid FROM a)",
    "parent_transitions": """WITH v AS (SELECT taxid, first(parent_taxid ORDER BY loaded_at, expected_status_jabberwocks NULLS FIRST, parent_taxid NULLS FIRST) o, first(parent_taxid ORDER BY loaded_at DESC, expected_status_jabberwocks DESC NULLS LAST, parent_taxid DESC NULLS LAST) n FROM test_virus_db WHERE taxid IS NOT NULL GROUP BY taxid)
      SELECT o old_value, n new_value, count(*) n FROM v WHERE o IS DISTINCT FROM n GROUP BY ALL""",
    "species_deltas": "SELECT genome_id, n_old, n_new, n_new - n_old delta FROM (SELECT genome_id, count(*) FILTER (WHERE aligned_at < TIMESTAMP '2025-07-01') n_old, count(*) FILTER (WHERE aligned_at >= TIMESTAMP '2025-07-01') n_new FROM tab_minimap WHERE genome_id IS NOT NULL GROUP BY genome_id) WHERE n_new <> n_old",
    "metric_changes": f"WITH a AS ({_metric_sql(chr(39).join(['sequenced_at < TIMESTAMP ', '2025-07-01', '']))}), b AS ({_metric_sql(chr(39).join(['sequenced_at >= TIMESTAMP ', '2025-07-01', '']))}) SELECT metric, a.v \"old\", b.v \"new\", b.v - a.v delta, CASE WHEN a.v <> 0 THEN round((b.v - a.v) / a.v * 100, 2) END pct_change FROM a JOIN b USING (metric)",
    "annotated_hits": f"""WITH RECURSIVE {_LATEST}, {_lca_sql(_ROWS, None, only_combined=True)}
      SELECT taxid_lca_combined, count(*) n_alignments, CAST(sum(t.row_no) AS BIGINT) row_sum FROM lca JOIN tab_minimap t USING (seq_id) WHERE t.classification = 'primary' AND t.taxid IS NOT NULL AND t.best_alignment_score IS NOT NULL GROUP BY ALL""",
    "streamed_counts": "SELECT strftime(aligned_at, '%Y-%m-%d') \"day\", genome_id, count(*) n_rows FROM tab_minimap WHERE genome_id IS NOT NULL AND aligned_at IS NOT NULL GROUP BY ALL",
    "group_json": "SELECT genome_id, sample, count(*) n_reads, sample own_sample, genome_id own_group FROM read_entry WHERE genome_id IS NOT NULL AND sample IS NOT NULL GROUP BY ALL",
    "unpaired_hits": f"""WITH {_HITS} SELECT seq_id, genome_id, taxid, {_FIELDS}, round(norm, 6) length_normalized_score, classification, row_no FROM hit""",
    "paired_hits": f"""WITH {_HITS}, ranked AS (SELECT *, row_number() OVER (PARTITION BY seq_id ORDER BY best_alignment_score DESC, row_no) m FROM hit),
      a AS (SELECT * FROM ranked WHERE m = 1), b AS (SELECT * FROM ranked WHERE m = 2)
      SELECT a.seq_id, CASE WHEN b.norm > a.norm THEN b.genome_id ELSE a.genome_id END genome_id, CASE WHEN a.genome_id <> b.genome_id THEN concat(a.genome_id, '/', b.genome_id) ELSE a.genome_id END genome_id_all,
        CASE WHEN b.norm > a.norm THEN b.taxid ELSE a.taxid END taxid, CASE WHEN a.taxid <> b.taxid THEN concat(a.taxid, '/', b.taxid) ELSE CAST(a.taxid AS VARCHAR) END taxid_all,
        CASE WHEN a.genome_id = b.genome_id THEN abs(a.ref_start - b.ref_start) END fragment_length, a.genome_id genome_id_fwd, b.genome_id genome_id_rev, a.taxid taxid_fwd, b.taxid taxid_rev,
        {", ".join(f"a.{c}, b.{c} {c}_rev" for c in _FIELDS.split(", "))},
        round(a.norm, 6) length_normalized_score_fwd, round(b.norm, 6) length_normalized_score_rev, round(greatest(a.norm, b.norm), 6) length_normalized_score,
        CASE WHEN b.m IS NULL THEN 'UP' ELSE 'CP' END pair_status, 'primary' classification, least(a.row_no, b.row_no) row_no
      FROM a LEFT JOIN b USING (seq_id) WHERE greatest(a.norm, b.norm) >= 20""",
    "fastq_records": f"WITH {_BEST} SELECT concat('@', t.seq_id, chr(10), t.query_seq, chr(10), '+', chr(10), t.query_qual) \"value\" FROM best b JOIN tab_minimap t USING (row_no) WHERE t.query_seq IS NOT NULL AND t.query_qual IS NOT NULL",
}
