"""Alignments: filtering by score, pairing of mates, one row for each hit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from virelay.functions import seq as sq
from virelay.operators.joins import lookup_preferring

_KEY = ["seq_id", "group_id"]


def with_scores(sam: DataFrame) -> DataFrame:
    """Adds norm_score (alignment score over the log of the length) and whether a row is secondary, by flag bits."""
    return sam.withColumn("norm_score", sq.pair_score(F.col("as_score"), F.col("seq"))).withColumn(
        "secondary", sq.flag_set(F.col("flag"), sq.SECONDARY) | sq.flag_set(F.col("flag"), sq.SUPPLEMENTARY)
    )


def alignment_groups(sam: DataFrame) -> DataFrame:
    """Adds group_id, the same for the mates of one placement, and drops what repeats within it.

    Primary rows of a read are one group. Secondary rows of unpaired placements (UP) are grouped by their reference and their two positions, or stand
    alone where the mate lies nowhere else; the highest score stays, at ties the first. Those of pairs (CP, DP) are grouped by references, positions,
    insert and scores; the first row of each mate stays. ``ordinal`` gives the order. Errors when rows are read: a read with more than two primary rows,
    a secondary row of a pair without its own or its mate's score, and such a group with more rows of one mate than of the other.
    """
    s = with_scores(sam)
    lo, hi = F.least("pos", "pnext"), F.greatest("pos", "pnext")
    alone = (F.col("pnext") == 0) | (F.col("pos") == F.col("pnext")) | ((F.col("rnext") != "=") & (F.col("rnext") != F.col("rname")))
    up_key = F.when(alone, F.concat_ws("|", F.lit("up"), F.col("ordinal").cast("string"))).otherwise(F.concat_ws("|", F.lit("up"), "rname", lo.cast("string"), hi.cast("string")))
    scores = F.concat_ws("|", F.least("as_score", "ys_score").cast("string"), F.greatest("as_score", "ys_score").cast("string"))
    refs = F.concat_ws("|", F.least("rname", F.when(F.col("rnext") == "=", F.col("rname")).otherwise(F.col("rnext"))), F.greatest("rname", F.when(F.col("rnext") == "=", F.col("rname")).otherwise(F.col("rnext"))))
    pair_key = F.concat_ws("|", F.lit("pair"), refs, lo.cast("string"), hi.cast("string"), F.abs("tlen").cast("string"), scores)
    s = s.withColumn("group_id", F.when(~F.col("secondary"), "primary").when(F.col("pair_status") == "UP", up_key).otherwise(pair_key))
    s = s.withColumn("mate", F.when(sq.flag_set(F.col("flag"), sq.READ2), 2).otherwise(1))
    of_pair = F.col("secondary") & F.col("pair_status").isin("CP", "DP")
    group, read = Window.partitionBy(*_KEY), Window.partitionBy("seq_id")
    faults = {
        "more than two primary rows": F.sum((~F.col("secondary")).cast("int")).over(read) > 2,
        "a pair without its scores": of_pair & (F.col("as_score").isNull() | F.col("ys_score").isNull()),
        "unequal numbers of mates": of_pair & (F.sum(F.when(F.col("mate") == 1, 1).otherwise(-1)).over(group) != 0),
    }
    checked = F.col("group_id")
    for what, fault in faults.items():
        checked = F.when(fault, F.raise_error(F.concat(F.lit(f"{what}: "), "seq_id"))).otherwise(checked)
    s = s.withColumn("__checked", checked).withColumn("group_id", F.col("__checked")).drop("__checked")
    one = F.when(F.col("pair_status").isin("CP", "DP") | ~F.col("secondary"), F.col("mate")).otherwise(F.lit(0))
    w = Window.partitionBy(*_KEY, one).orderBy(F.coalesce("as_score", F.lit(0)).desc(), "ordinal")
    first = Window.partitionBy(*_KEY, one).orderBy("ordinal")
    keep = F.when(F.col("secondary") & (F.col("pair_status") == "UP"), F.row_number().over(w)).otherwise(F.row_number().over(first))
    return s.withColumn("__keep", keep).where("__keep = 1").drop("__keep")


def filter_by_score(sam: DataFrame, threshold: float) -> DataFrame:
    """Groups whose best norm_score reaches the threshold, of reads whose primary group does."""
    g = alignment_groups(sam)
    best = g.withColumn("group_score", F.max("norm_score").over(Window.partitionBy(*_KEY)))
    primary = F.max(F.when(F.col("group_id") == "primary", F.col("group_score"))).over(Window.partitionBy("seq_id"))
    return best.withColumn("primary_score", primary).where((F.col("primary_score") >= threshold) & (F.col("group_score") >= threshold)).drop("primary_score")


def add_missing_mates(sam: DataFrame) -> DataFrame:
    """For UP rows without a mate row in their group, an unmapped mate: no CIGAR, own position as the mate's, flag of the other end."""
    n = F.count(F.lit(1)).over(Window.partitionBy(*_KEY))
    s = sam.withColumn("__n", n)
    lone = s.where((F.col("__n") == 1) & (F.col("pair_status") == "UP"))
    made = lone.withColumns({
        "flag": sq.mate_flag(F.col("flag")), "cigar": F.lit("*"), "rnext": F.lit("="), "pnext": F.col("pos"), "mate": F.lit(3) - F.col("mate"),
        "as_score": F.lit(None).cast(dict(sam.dtypes)["as_score"]), "norm_score": F.lit(0.0),
        "seq": F.lit(None).cast("string"), "qual": F.lit(None).cast("string"),
    })
    return s.unionByName(made).drop("__n")


def genome_taxids(genomes: DataFrame, viral: DataFrame | None = None) -> DataFrame:
    """(rname, taxid) of each genome (genome_id, taxid and, with ``viral``, species_taxid): its taxid if that is in ``viral`` (taxid), else its species if that is, else its taxid."""
    if viral is None:
        return genomes.select(F.col("genome_id").alias("rname"), "taxid")
    return lookup_preferring(genomes.select("genome_id"), genomes, viral).select(F.col("genome_id").alias("rname"), "taxid")


def _with_taxids(sam: DataFrame, genomes: DataFrame, viral: DataFrame | None) -> DataFrame:
    """Mapped rows with their genome's taxid; an unknown genome is an error when rows are read."""
    mapped = sam.where(~sq.flag_set(F.col("flag"), sq.UNMAPPED))
    found = mapped.join(genome_taxids(genomes, viral).withColumn("__known", F.lit(True)), "rname", "left")
    known = F.when(F.col("__known"), F.col("taxid")).otherwise(F.raise_error(F.concat(F.lit("unknown genome: "), F.coalesce("rname", F.lit("null")))))
    return found.withColumn("taxid", known).drop("__known")


def _class_of(flag: Column) -> Column:
    return F.when(sq.flag_set(flag, sq.SUPPLEMENTARY), "supplementary").when(sq.flag_set(flag, sq.SECONDARY), "secondary").otherwise("primary")


#: Columns of a mate beside its row's, in the order of the table (fixed values).
_MATE_COLUMNS = ["best_alignment_score", "next_alignment_score", "edit_distance", "ref_start", "map_qual", "cigar", "query_len", "query_seq", "query_rc", "query_qual"]


def _mate_fields() -> list[Column]:
    """The row's fields as columns of a hit; sequence and qualities in the read's own direction, starts from 0."""
    rc = sq.flag_set(F.col("flag"), sq.REVERSE)
    return [
        F.col("as_score").alias("best_alignment_score"), F.col("xs_score").alias("next_alignment_score"), F.col("nm").alias("edit_distance"), (F.col("pos") - 1).alias("ref_start"),
        F.col("mapq").alias("map_qual"), F.col("cigar"), F.length("seq").alias("query_len"), F.when(rc, sq.reverse_complement(F.col("seq"))).otherwise(F.col("seq")).alias("query_seq"),
        rc.alias("query_rc"), F.when(rc, F.reverse("qual")).otherwise(F.col("qual")).alias("query_qual"),
    ]


def paired_hits(sam: DataFrame, genomes: DataFrame, viral: DataFrame | None = None) -> DataFrame:
    """One row for each placement (seq_id, group_id) of a pair: the 35 columns of the table of paired hits, then group_id and row_no, its least ordinal.

    ``genome_id`` and ``taxid`` are those of the mate with the higher normalised score, the forward one at ties; ``*_all`` have both, forward first, parted by
    ``/`` where they differ. The fragment length is null where the genomes do, or a mate isn't placed or has no score. Taxids are those of genome_taxids. A pair is secondary if its forward
    mate is; a lone mate may be supplementary as well.
    """
    s = _with_taxids(sam, genomes, viral)
    side = F.struct("rname", "taxid", "norm_score", F.abs("tlen").alias("insert"), "pair_status", _class_of(F.col("flag")).alias("kind"), sq.flag_set(F.col("flag"), sq.SECONDARY).alias("is_secondary"), *_mate_fields())
    scored = F.col("as_score").isNotNull()
    one = s.groupBy(*_KEY).agg(
        *[F.min(F.when((F.col("mate") == m) & scored, F.struct("ordinal", side.alias("m"))))["m"].alias(name) for m, name in ((1, "f"), (2, "r"))], F.min("ordinal").alias("row_no")
    ).where("f IS NOT NULL OR r IS NOT NULL")
    f, r = F.col("f"), F.col("r")
    pair = f.isNotNull() & r.isNotNull()
    best = F.when(f.isNotNull() & (r.isNull() | (f["norm_score"] >= r["norm_score"])), f).otherwise(r)

    def both(name: str) -> Column:
        a, b = f[name].cast("string"), r[name].cast("string")
        return F.when(pair & (a != b), F.concat_ws("/", a, b)).otherwise(F.coalesce(a, b))

    same = pair & (f["rname"] == r["rname"])
    kind = F.when(pair, F.when(f["is_secondary"], "secondary").otherwise("primary")).otherwise(F.coalesce(f["kind"], r["kind"]))
    return one.select(
        "seq_id", best["rname"].alias("genome_id"), both("rname").alias("genome_id_all"), best["taxid"].alias("taxid"), both("taxid").alias("taxid_all"),
        F.when(same, f["insert"]).alias("fragment_length"), f["rname"].alias("genome_id_fwd"), r["rname"].alias("genome_id_rev"), f["taxid"].alias("taxid_fwd"), r["taxid"].alias("taxid_rev"),
        *[x[c].alias(c + end) for c in _MATE_COLUMNS for x, end in ((f, ""), (r, "_rev"))],
        f["norm_score"].alias("length_normalized_score_fwd"), r["norm_score"].alias("length_normalized_score_rev"), best["norm_score"].alias("length_normalized_score"),
        best["pair_status"].alias("pair_status"), kind.alias("classification"), "group_id", "row_no",
    )


def unpaired_hits(sam: DataFrame, genomes: DataFrame, viral: DataFrame | None = None) -> DataFrame:
    """One row for each mapped alignment of single reads: the 15 columns of the table of unpaired hits, then row_no, its ordinal."""
    s = _with_taxids(with_scores(sam), genomes, viral)
    return s.select("seq_id", F.col("rname").alias("genome_id"), "taxid", *_mate_fields(), F.col("norm_score").alias("length_normalized_score"), _class_of(F.col("flag")).alias("classification"), F.col("ordinal").alias("row_no"))


def long_read_hits(sam: DataFrame, reads: DataFrame, genomes: DataFrame, viral: DataFrame | None = None, strict: bool = False) -> DataFrame:
    """One row for each mapped alignment, with the read's own (unmasked) sequence and qualities, turned if it lies reversed.

    ``reads`` has seq_id, seq and qual. An alignment to an unknown genome, and with ``strict`` one without its read, is an error when rows are read; else the latter is left out. Classification: supplementary, else secondary, else primary.
    """
    whole = reads.select("seq_id", "seq", "qual", F.lit(True).alias("__read"))
    s = _with_taxids(sam.drop("seq", "qual"), genomes, viral).join(whole, "seq_id", "left" if strict else "inner")
    s = s.withColumn("seq_id", F.when(F.col("__read"), F.col("seq_id")).otherwise(F.raise_error(F.concat(F.lit("alignment without its read: "), "seq_id"))))
    return s.select(
        "seq_id", F.col("rname").alias("genome_id"), "taxid", *_mate_fields(), sq.long_read_score(F.col("as_score"), F.length("seq")).alias("length_normalized_score"),
        _class_of(F.col("flag")).alias("classification"), F.col("ordinal").alias("row_no"),
    )


def primary_with_lca(lca: DataFrame, alignments: DataFrame, prefix: str = "prim_align_") -> DataFrame:
    """The aggregate of each read beside its primary alignment, whose columns but seq_id get the prefix. One exchange, no sorts of its own."""
    prim = alignments.where("classification = 'primary'").drop("classification")
    return lca.join(prim.toDF(*[c if c == "seq_id" else prefix + c for c in prim.columns]), "seq_id")


def split_mapped(sam: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(mapped, unmapped): rows of pairs of which both mates are unmapped are the second table."""
    neither = sq.flag_set(F.col("flag"), sq.UNMAPPED) & (sq.flag_set(F.col("flag"), sq.MATE_UNMAPPED) | ~sq.flag_set(F.col("flag"), sq.PAIRED))
    return sam.where(~neither), sam.where(neither)
