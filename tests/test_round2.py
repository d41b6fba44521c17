"""Cases of the second round: values of any size, several fragments, readers at line starts, numbers as texts."""

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from virelay.operators import components, reads, relops
from virelay.operators import hierarchy as h
from virelay.operators.hot_keys import key_summary
from virelay.operators.orphans import Entity, Reference, orphans
from virelay.sources import readers


def test_key_summary_loses_no_value(spark, rows):
    df = spark.createDataFrame([("a", "m", 1e-9), ("a", "m", 1e25), ("a", "n", -1e25), ("b", "m", 5e-324), ("b", "m", 1e308), ("c", "m", 0.1), ("c", "m", 0.2), ("c", "m", -0.0), ("d", "m", float("inf"))], "k string, m string, v double")
    got = {r[0]: r[1:] for r in rows(key_summary(df, "k", "m", "v"))}
    assert got["a"][:3] == (3, 2, 3) and got["a"][4:] == (-1e25, 1e25)
    assert got["b"][4:] == (5e-324, 1e308) and got["c"][3:] == (0.1, -0.0, 0.2) and got["d"][3] == float("inf")


@settings(max_examples=10, deadline=None)
@given(st.lists(st.floats(-1e12, 1e12, allow_nan=False), min_size=1, max_size=40))
def test_sums_are_exact_in_any_order(spark, values):
    import math

    df = spark.createDataFrame([("a", "m", v) for v in values], "k string, m string, v double")
    one = key_summary(df, "k", "m", "v").first()
    assert one.mean_value == pytest.approx(math.fsum(values) / len(values), rel=1e-14, abs=1e-6)
    assert key_summary(df.orderBy(F.rand(3)).repartition(3), "k", "m", "v").first() == one


def test_key_summary_of_whole_numbers(spark, rows):
    df = spark.createDataFrame([("a", None, 2**62), ("a", "x", 2**62), ("a", "x", None), ("a", "y", 3)], "k string, m string, v long")
    assert rows(key_summary(df, "k", "m", "v")) == [("a", 4, 2, 3, pytest.approx((2**63 + 3) / 3), 3.0, 2.0**62)]


def test_contract_gives_components(spark):
    chain = spark.range(400).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).where("a % 101 <> 100")
    star = spark.range(1, 500).select(F.lit(10_000).cast("bigint").alias("a"), (F.col("id") + 10_000).alias("b"))
    got = components.contract(chain.unionByName(star).unionByName(star.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    sizes = sorted(r["count"] for r in got.groupBy("r").count().collect())
    assert sizes == [98, 101, 101, 101, 500] and got.count() == 901
    assert components.contract(chain.limit(0)).count() == 0


def test_small_trees_take_several_fragments(spark):
    links = spark.range(1000).select(F.col("id").alias("node"), F.when(F.col("id") > 0, F.floor(F.col("id") / 2)).alias("parent"))
    assert h._n_fragments(spark, 1000, h.FRAGMENT_NODES) > 1
    got = {r.node: (r.root, r.depth, list(r.path)) for r in h.hierarchy(links).collect()}
    want = lambda i: want(i // 2) + [i] if i else [0]
    assert all(got[i] == (0, len(want(i)) - 1, want(i)) for i in range(1000))


def test_contracted_fragment_in_pieces(monkeypatch):
    t = pa.table({"frag": [0] * 6, "node": [1, 2, 3, 7, 8, 9], "parent": [None, 1, 2, 8, 7, 99], "load": pa.array([[1], [2], [5, 3], [7], [8], [9]], pa.list_(pa.int64()))})
    for size in (1 << 28, 2):
        monkeypatch.setattr(h, "_CHUNK", size)
        got = h._contract(t).to_pydict()
        assert got["steps"] == [[1], [1, 2], [1, 2, 5, 3], None, None, [9]] and got["exit"] == [None, None, None, None, None, 99]


def test_orphans_direct_and_inherited(spark, rows):
    import datetime as dt

    t = lambda d: dt.datetime(2025, 1, d)
    v = spark.createDataFrame([(1, 99, t(1), None), (2, 1, t(1), t(5)), (2, 1, t(7), None), (3, None, t(2), None)], "taxid long, parent long, loaded_at timestamp, deleted_at timestamp")
    refs = spark.createDataFrame([(1, 1, t(1)), (2, 2, t(2)), (3, 2, t(6)), (4, 3, t(1)), (5, 3, t(2)), (6, 50, t(2)), (7, None, t(2)), (8, 2, None)], "row_no long, k long, at timestamp")
    got = orphans({"v": v, "refs": refs}, [Reference("refs", "k", "row_no", "at", "v")], [Entity("v", "taxid", "loaded_at", "deleted_at", "parent")])
    assert rows(got.select("row_no", "kind")) == [(1, "inherited"), (2, "inherited"), (3, "deleted"), (4, "late"), (6, "missing"), (8, "deleted")]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text("ACGTNacg", max_size=12)), min_size=1, max_size=8), st.sampled_from([1, 3, 4]))
def test_packed_kmers_equal_brute_force(spark, texts, k):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    comp = str.maketrans("ACGT", "TGCA")
    for r in reads.packed_kmers(df, ["i"], "s", k).collect():
        s = texts[r.i]
        words = None if s is None else sorted({min(w, w[::-1].translate(comp)) for w in (s.upper()[j : j + k] for j in range(len(s) - k + 1)) if set(w) <= set("ACGT")})
        assert r.kmers == (None if words is None else [sum("ACGT".index(c) << 2 * (k - 1 - j) for j, c in enumerate(w)) for w in words])


def test_fasta_begins_at_line_starts(spark, tmp_path):
    (tmp_path / "a.fa").write_text(">s1 gene->protein x\nAC\nGT\n>s2\nTT>T\r\n\n>s3 d\n")
    got = {r.seq_id: (r.description, r.seq) for r in readers.read_fasta(spark, str(tmp_path / "a.fa")).collect()}
    assert got == {"s1": ("gene->protein x", "ACGT"), "s2": (None, "TT>T"), "s3": ("d", "")}


def test_fastq_in_many_blocks(spark, tmp_path):
    n = 3000
    (tmp_path / "a.fq").write_text("".join(f"@r{i} x{i}\n{'ACGT' * (i % 9)}\n+\n{'@III' * (i % 9)}\n" for i in range(n)) + "\n")
    (tmp_path / "b.fq").write_text("@only\nAC\n+\nII\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = readers.read_fastq(spark, [str(tmp_path / "a.fq"), str(tmp_path / "b.fq")])
        got = {(r.file[-4:], r.record): (r.seq_id, r.description, r.seq) for r in df.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(got) == n + 1 and got["b.fq", 1] == ("only", None, "AC")
    assert all(got["a.fq", i + 1] == (f"r{i}", f"x{i}", "ACGT" * (i % 9)) for i in range(n))
    for i, bad in enumerate(("@a\nAC\n+\nI\n", "a\nAC\n+\nII\n", "@a\nAC\n+\n")):
        (tmp_path / f"bad{i}.fq").write_text(bad)
        with pytest.raises(Exception, match="isn't FASTQ"):
            readers.read_fastq(spark, str(tmp_path / f"bad{i}.fq")).collect()


def test_taxonomy_dump_is_checked(spark):
    nodes = spark.createDataFrame([(1, 1, "no rank"), (5, 1, "species"), (6, 5, "x")], "node long, parent long, rank string")
    assert readers.check_nodes(nodes, 1, 5).count() == 3
    for bad, artificial in ((nodes.where("node > 1"), 5), (nodes, 6), (nodes, 77)):
        with pytest.raises(relops.TableError):
            readers.check_nodes(bad, 1, artificial)


CELLS = ["9007199254740993", "9007199254740992", "1", "1.0", "01", "+1", "-0", "0.0", "true", "TRUE", "False", "1d", "1f", "NaN", "nan", "inf", "1e0", "1_000", "1000.0", "abc", "", " 1 ", "0x1", "1e400", None]


@pytest.mark.parametrize("value", [c for c in CELLS if c is not None])
def test_coerced_equality(spark, value):
    def read(x):
        if x.lower() in ("true", "false"):
            return x.lower() == "true"
        for kind in (int, float):
            try:
                return kind(x)
            except ValueError:
                pass
        return x

    df = spark.createDataFrame([(c,) for c in CELLS], "c string").select("c", F.coalesce(relops.coerced_equal(F.col("c"), value), F.lit(False)).alias("same"))
    got = {r.c for r in df.collect() if r.same}
    assert got == {c for c in CELLS if c is not None and read(c) == read(value)}
    assert np.isnan(float("nan"))


def test_virus_taxonomy_and_genomes(spark, rows):
    from virelay.plans import databases

    nodes = spark.createDataFrame([(1, 1, "no rank"), (10, 1, "superkingdom"), (20, 10, "family"), (21, 20, "genus"), (22, 21, "species"), (23, 22, "no rank"), (24, 20, "species"), (90, 1, "species")], "node long, parent long, rank string")
    names = spark.createDataFrame([(22, "good virus", "scientific name"), (22, "a synonym", "synonym"), (24, "other", "synonym")], "node long, name string, name_class string")
    hosts = spark.createDataFrame([(23, 9606), (24, 7)], "node long, host long")
    groups = {"human": spark.createDataFrame([(9606,)], "host long"), "fly": spark.createDataFrame([(7,), (8,)], "host long")}
    db = databases.virus_taxonomy(nodes, names, 10, hosts, groups)
    got = {r.taxid: r for r in db.collect()}
    assert set(got) == {10, 20, 21, 22, 23, 24} and got[10].parent_taxid == 10
    assert (got[22].name, got[24].name, got[20].name) == ("good virus", "other", "unknown virus")
    assert (got[23].taxid_species, got[23].taxid_genus, got[23].taxid_family, got[24].taxid_genus) == (22, 21, 20, None)
    assert got[23].infection_status_human == 1 and got[24].infection_status_fly == 1 and got[24].infection_status_human != 1
    assemblies = spark.createDataFrame([("GCA_1.1", 23, "current"), ("GCA_2.1", 24, "current"), ("GCA_3.1", 23, "replaced")], "accession string, taxid long, assembly_status string")
    fasta = spark.createDataFrame([("/x/GCA_1.1_b.fna", "s1", "fine", "AC"), ("/x/GCA_1.1_b.fna", "s2", "a Vector", "GG"), ("/x/GCA_2.1_a.fna", "s3", None, "TT")], "file string, seq_id string, description string, seq string")
    table, seqs = databases.virus_genomes(assemblies, db, fasta, ["human"], ["vector"])
    assert {(r.accession, r.genome_id, r.species_taxid) for r in table.collect()} == {("GCA_1.1", "s1", 22), ("GCA_1.1", "s2", 22)}
    assert [r.seq_id for r in seqs.collect()] == ["s1"]
    with pytest.raises(relops.TableError):
        databases.virus_genomes(assemblies, db, fasta, ["human"], [], "suppressed")


def test_sample_sheets_suffixes_and_groups(spark, tmp_path, rows):
    for i, (text, platform) in enumerate((("sample,fastq\na,x\na,y\n", "ont"), ("sample,fastq\na,\n", "ont"), ("sample,fastq\na,x\n", "pacbio"), ("sample,fastq\na,x\n", "abacus"), ("sample,file\na,x\n", "ont"))):
        (tmp_path / f"s{i}.csv").write_text(text)
        with pytest.raises(relops.TableError):
            readers.read_sample_sheet(spark, str(tmp_path / f"s{i}.csv"), platform)
    (tmp_path / "p.csv").write_text("sample,fastq_1,fastq_2\na,x,y\n")
    assert readers.read_sample_sheet(spark, str(tmp_path / "p.csv"), "aviti").count() == 1
    (tmp_path / "o.toml").write_text('[tool.x]\nexpected-outputs-run = ["in/sheet.csv", "r/{SAMPLE}_b.tsv.gz", "r/{SAMPLE}_a.json"]\nexpected-outputs-run-shortread-extra = ["r/{SAMPLE}_b.tsv", "r/{SAMPLE}_c.tsv.gz"]\n')
    assert readers.expected_suffixes(str(tmp_path / "o.toml"), "ont", ("tool", "x")) == ["a.json", "b.tsv"]
    assert readers.expected_suffixes(str(tmp_path / "o.toml"), "illumina", ("tool", "x")) == ["a.json", "b.tsv", "c.tsv"]
    (tmp_path / "g.tsv").write_text("sample\tgroup\ns1\tg1\ns2\tg1\n")
    (tmp_path / "runs.csv").write_text("label,run_results_dir,groups_tsv\nr1,out,g.tsv\nr2,/abs,g.tsv\n")
    runs = readers.read_run_inputs(spark, str(tmp_path / "runs.csv"), str(tmp_path))
    got = readers.run_groups(spark, runs)
    assert rows(got.select("label", "sample", "group")) == [("r1", "s1", "g1"), ("r1", "s2", "g1"), ("r2", "s1", "g1"), ("r2", "s2", "g1")]


def test_paired_table_of_mates_that_disagree(spark):
    from virelay.plans import workflows

    cols = "seq_id string, flag int, rname string, pos int, mapq int, cigar string, rnext string, pnext int, tlen int, seq string, qual string, as_score int, xs_score int, ys_score int, nm int, pair_status string, ordinal long"
    rows = [("r", 65, "g1", 11, 40, "4M", "g2", 31, 0, "ACGT", "IIII", 30, 5, 40, 0, "DP", 1), ("r", 145, "g2", 31, 41, "4M", "g1", 11, 0, "GGCC", "5556", 40, None, 30, 1, "DP", 2)]
    genomes = spark.createDataFrame([("g1", 7, 70), ("g2", 8, 80)], "genome_id string, taxid long, species_taxid long")
    viral = spark.createDataFrame([(7,), (80,)], "taxid long")
    one = workflows.hits_from_sam(spark.createDataFrame(rows, cols), genomes, 10.0, viral).first()
    assert (one.genome_id, one.genome_id_all, one.taxid, one.taxid_all, one.fragment_length) == ("g2", "g1/g2", 80, "7/80", None)
    assert (one.genome_id_fwd, one.genome_id_rev, one.next_alignment_score, one.map_qual_rev, one.cigar_rev, one.query_len, one.classification) == ("g1", "g2", 5, 41, "4M", 4, "primary")
    assert len(one) == 37 and one.query_seq_rev == "GGCC" and one.query_qual_rev == "6555" and one.query_rc_rev and one.length_normalized_score == one.length_normalized_score_rev
    for bad in ([rows[0], rows[0], rows[1]], [("r", 321, *rows[0][2:-2], "CP", 3), *rows]):
        with pytest.raises(Exception, match="primary rows|numbers of mates"):
            workflows.hits_from_sam(spark.createDataFrame(bad, cols), genomes, 1.0, viral).collect()
    with pytest.raises(Exception, match="unknown genome"):
        workflows.hits_from_sam(spark.createDataFrame(rows, cols), genomes.where("taxid = 7"), 1.0, viral).collect()


def test_long_reads_that_are_missing(spark):
    from virelay.operators import align

    sam = spark.createDataFrame([("a", 0, "g1", 11, 40, "4M", 30, 5, 0, 1), ("b", 16, "g1", 5, 40, "4M", 20, 5, 0, 2)], "seq_id string, flag int, rname string, pos int, mapq int, cigar string, as_score int, xs_score int, nm int, ordinal long")
    sam = sam.withColumns({"seq": F.lit("NNNN"), "qual": F.lit("!!!!")})
    genomes = spark.createDataFrame([("g1", 7)], "genome_id string, taxid long")
    read = spark.createDataFrame([("b", "AACC", "1234")], "seq_id string, seq string, qual string")
    one = align.long_read_hits(sam, read, genomes).collect()
    assert [(r.seq_id, r.query_seq, r.query_qual, r.ref_start, r.taxid, r.classification) for r in one] == [("b", "GGTT", "4321", 4, 7, "primary")]
    with pytest.raises(Exception, match="without its read"):
        align.long_read_hits(sam, read, genomes, strict=True).collect()


def test_profiles_and_validated_groups(spark, rows):
    from virelay.plans import workflows

    a, b = spark.createDataFrame([(1, "x")], "taxid long, name string"), spark.createDataFrame([("y", 2)], "name string, taxid long")
    assert rows(workflows.profile_tables({"TRUE": a, "FALSE": b}).select("taxid", "name", "ribosomal")) == [(1, "x", "TRUE"), (2, "y", "FALSE")]
    paths = h.full_paths(spark.createDataFrame([(1, None), (5, 1), (6, 5)], "node long, parent long"))
    hits = spark.createDataFrame([("s1", 6, "g"), ("s2", 6, "g")], "seq_id string, aligner_taxid_lca long, `group` string")
    db = spark.createDataFrame([(6, 5), (5, None)], "taxid long, taxid_species long")
    members = spark.createDataFrame([("s1", "s1"), ("s2", "s1")], "seq_id string, vsearch_cluster_rep_id string")
    search = spark.createDataFrame([("s1", "x", 5, 50.0, 30, 1), ("s1", "x", 5, 40.0, 30, 2)], "qseqid string, sseqid string, staxid long, bitscore double, length int, ordinal long")
    groups = spark.createDataFrame([("g",), ("empty",)], "`group` string")
    out, empty = workflows.validated_groups(hits, db, members, search, paths, groups)
    got = {r.seq_id: (r.validation_lca, r.validation_distance_aligner, r.validation_distance_validation) for r in out.collect()}
    assert got == {"s1": (5, 1, 0), "s2": (5, 1, 0)} and "taxid_species" not in out.columns and rows(empty) == [("empty",)]
