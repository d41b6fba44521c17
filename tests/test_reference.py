"""Relational, tree, duplicate, alignment and file operators on small cases with known results."""

import gzip
import random

import pytest
from pyspark.sql import functions as F

from virelay import schemas
from virelay.functions import seq as sq
from virelay.operators import align, compare, duplicates, hierarchy, joins, reads, relops, tree
from virelay.operators.components import components
from virelay.operators.relops import TableError
from virelay.plans import workflows
from virelay.sources import readers, writers

TREE = [(1, None), (9000, 1), (8000, 1), (9001, 9000), (9002, 9000), (9003, 9000), (9004, 9003), (9007, 9003), (9010, 9003), (9005, 9004), (9006, 9004), (9008, 9001), (9009, 9008), (8001, 8000), (8002, 8000)]


@pytest.fixture(scope="module")
def paths(spark):
    return hierarchy.full_paths(spark.createDataFrame(TREE, "node long, parent long")).cache()


def test_lca_golden(spark, paths):
    hits = {
        "A": [(9001, 100)], "B": [(9002, 100), (9003, 200)], "D": [(9005, 100), (9006, 200), (9007, 300)], "F": [(9001, 100), (9999, 150)],
        "X": [(8001, 100), (8002, 200)], "Q": [(9005, 200), (9006, 200), (9009, 50)], "R": [(9005, 200), (9006, 200), (9009, 260)], "E": [(9999, 5), (9999, 5)],
    }
    data = [(g, t, float(s), i) for g, v in hits.items() for i, (t, s) in enumerate(v)] + [(None, 9001, 1.0, 0), ("N", None, 1.0, 0)]
    random.Random(1).shuffle(data)
    names = spark.createDataFrame([(9009, "Unclassified thing"), (9001, None)], "node long, name string")
    unc = tree.unclassified_nodes(paths, names)
    got = {r.g: r for r in tree.lca_by_group(spark.createDataFrame(data, "g string, t long, s double, o int"), "g", "t", "s", "o", paths, unc, 8000).collect()}
    assert {g: (got[g].taxid_lca, got[g].taxid_top) for g in "ABDFQRE"} == {"A": (9001, 9001), "B": (9000, 9003), "D": (9003, 9007), "F": (1, 9999), "Q": (9004, 9005), "R": (9000, 9009), "E": (9999, 9999)}
    x = got["X"]
    assert (x.taxid_lca, x.taxid_lca_artificial, x.taxid_lca_combined, x.n_entries, x.n_entries_artificial) == (None, 8000, 8000, 0, 2)
    assert got["Q"].top_classified and got["Q"].n_classified == 2 and not got["R"].top_classified and got["E"].n_entries == 2
    assert set(got) == set(hits)


def test_clade_counts_golden(spark, rows):
    links = spark.createDataFrame([(1, None), (2, 1), (3, 1), (4, 2)], "node long, parent long")
    data = [("g", "a", "a", 1), ("g", "b", "b", 1), ("g", "c", "a", 1), ("g", "d", "d", 3), ("g", "e", "d", 3), ("g", "f", "f", 4), ("g", "z", "z", 77), ("g", "y", "y", None)]
    df = spark.createDataFrame(data, "grp string, seq_id string, ex string, taxid long")
    got = tree.clade_counts(df, "grp", "seq_id", "ex", "taxid", links, hierarchy.full_paths(links))
    assert rows(got) == [("g", 1, 1, 3, 2, 6, 4), ("g", 2, 1, 0, 0, 1, 1), ("g", 3, 1, 2, 1, 2, 1), ("g", 4, 2, 1, 1, 1, 1)]


def test_distance_and_ranks(spark, paths, rows):
    df = spark.createDataFrame([(9005, 9007), (9001, 9001), (9009, 8001), (None, None), (9001, 4242)], "a long, b long")
    assert rows(tree.taxid_distance(df, "a", "b", paths).select("distance_1", "distance_2")) == [(0, 0), (2, 1), (4, 2), (None, None), (None, None)]
    with pytest.raises(ValueError):
        tree.taxid_distance(df, "a", "b", paths, "a")
    ranks = spark.createDataFrame([(9000, "family"), (9003, "genus"), (9004, "no rank"), (9005, "species"), (9001, "species")], "node long, rank string")
    got = dict(rows(tree.raise_to_rank(paths, ranks, "genus")))
    assert (got[9005], got[9004], got[9003], got[9000], got[9001], got[9009]) == (9003, 9003, 9003, None, None, None)


def brute_status(parent, hosts, group, exclude, include):
    kids = {}
    for n, p in parent.items():
        kids.setdefault(p, []).append(n)

    def below(n):
        return {n}.union(*[below(k) for k in kids.get(n, [])])

    s = {n: (1 if hosts[n] & group else 0) if n in hosts else -1 for n in parent}
    for n in exclude:
        s |= {k: 0 for k in below(n)}
    s |= {n: 1 for n in include}
    if 1 not in s.values():
        return {n: 0 for n in s}

    def up(n):
        c = [up(k) for k in kids.get(n, [])]
        if c and s[n] != 1 and set(c) != {-1}:
            v = set(c)
            if len(v) == 1:
                s[n] = c[0]
            elif 2 in v or (v & {0, -2} and v & {1, 3}):
                s[n] = 2
            elif v & {0, -2}:
                s[n] = 0 if s[n] == 0 else -2
            else:
                s[n] = 3
        return s[n]

    for r in kids[None]:
        up(r)
    for v, cond in ((1, lambda x: True), (0, lambda x: True), (3, lambda x: x != 1), (2, lambda x: x < 0)):
        for n in [n for n in s if s[n] == v]:
            for k in below(n):
                if cond(s[k]) and not (v == 3 and s[k] == 0):
                    s[k] = v
    return s


@pytest.mark.parametrize("seed", range(3))
def test_infection_status_equals_brute_force(spark, seed):
    r = random.Random(seed)
    parent = {0: None} | {i: r.randrange(max(0, i - 6), i) for i in range(1, 40)}
    hosts = {n: {r.choice([1, 2])} for n in r.sample(range(40), 14)}
    exclude, include = [r.randrange(20, 40)], [r.randrange(20, 40)]
    links = spark.createDataFrame(list(parent.items()), "node long, parent long")
    h = spark.createDataFrame([(n, x) for n, v in hosts.items() for x in v], "node long, host long")
    one = lambda v, c: spark.createDataFrame([(x,) for x in v], f"{c} long")
    got = tree.infection_status(links, hierarchy.full_paths(links), h, one([1], "host"), one(exclude, "node"), one(include, "node"))
    assert {x.node: x.status for x in got.collect()} == brute_status(parent, hosts, {1}, exclude, include)


@pytest.mark.parametrize("seed", range(2))
def test_components_equal_brute_force(spark, seed):
    r = random.Random(seed)
    pairs = [(r.randrange(60), r.randrange(60)) for _ in range(45)] + [(None, 1), (5, 5)]
    parent = list(range(60))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if a is not None:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    linked = {x for a, b in pairs if a is not None and a != b for x in (a, b)}
    assert {x.node: x.component for x in components(spark.createDataFrame(pairs, "a int, b int")).collect()} == {x: find(x) for x in linked}
    assert components(spark.createDataFrame([], "a int, b int")).count() == 0


def test_duplicates_are_components_of_near_places(spark, rows):
    places = [(0, 10), (1, 8), (1, 10), (1, 12), (2, 9), (2, 11)]
    data = [(f"r{i}", "g", s, e, 30.0 + (i == 3)) for i, (s, e) in enumerate(places)] + [("n1", "g", 5, None, None), ("n2", "g", 6, None, 1.0), ("n3", "g", 5, 6, 1.0), ("x", "h/g", 3, 9, 2.0), ("y", "g/h", 9, 4, 2.0), (None, "g", 1, 1, 1.0), ("q", None, 1, 1, 1.0), ("w", "g", None, None, 1.0)]
    df = spark.createDataFrame(data, "read string, genome string, s int, e int, q double")
    marked, groups = duplicates.mark_duplicates(df, "read", "genome", "s", "e", "q", 1)
    assert dict(rows(marked)) == {f"r{i}": "r3" for i in range(6)} | {"n1": "n2", "n2": "n2", "n3": "n3", "x": "x", "y": "x"}
    by = {r.exemplar: r for r in groups.collect()}
    near = sum(1 for i in range(6) for j in range(i) if all(abs(a - b) <= 1 for a, b in zip(places[i], places[j], strict=True)))
    assert by["r3"].group_size == 6 and by["r3"].pairwise_match_frac == pytest.approx(near / 15, abs=1e-5) and by["n3"].pairwise_match_frac == 1.0
    exact, _ = duplicates.mark_duplicates(df, "read", "genome", "s", "e", "q", 0)
    assert dict(rows(exact))["r3"] == "r3" and dict(rows(exact))["r0"] == "r0"


def test_cluster_summary(spark, rows):
    records = spark.createDataFrame(
        [("S", 0, 100, "*", "*", "*", "a", "*"), ("H", 0, 90, "97.5", "-", "90M", "b", "a"), ("C", 0, 2, "*", "*", "*", "a", "*"), ("S", 1, 80, "*", "*", "*", "c", "*"), ("C", 1, 1, "*", "*", "*", "c", "*")],
        "type string, cluster long, length int, identity string, orientation string, cigar string, query string, target string",
    )
    m = duplicates.cluster_summary(records)
    assert rows(m.select("seq_id", "vsearch_cluster_rep_id", "vsearch_percent_identity", "vsearch_cigar", "vsearch_cluster_size")) == [("a", "a", 100.0, "100M", 2), ("b", "a", 97.5, "90M", 2), ("c", "c", 100.0, "80M", 1)]
    assert [tuple(r) for r in duplicates.top_representatives(m, 1).collect()] == [("a", 2)]


def test_joins(spark, rows):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (None, "n")], "k int, a string")
    b = spark.createDataFrame([(2, 5), (2, 6), (3, 7), (None, 8)], "k int, b int")
    assert rows(joins.checked_join(a, b, "k")) == [(2, "y", 5), (2, "y", 6)]
    assert len(rows(joins.checked_join(a, b, "k", "outer"))) == 6 and joins.checked_join(a, b, "k", "right").columns == ["k", "a", "b"]
    assert (None, "n", 8) in rows(joins.checked_join(a, b, "k", null_keys_match=True))
    for how, left, right in (("strict", a, b), ("inner", b, b.withColumnRenamed("b", "c")), ("inner", a, a), ("cross", a, b)):
        with pytest.raises(TableError):
            joins.checked_join(left, right, "k", how)
    with pytest.raises(TableError):
        joins.subset_checked(a, b, "k")
    assert joins.checked_join(a.limit(0), b, "k", "left").count() == 0


def test_relops(spark, rows):
    t = spark.createDataFrame([(1, "a", 2.0), (2, "b", 1.0), (2, "b", 3.0), (3, None, None)], "k int, v string, s double")
    assert rows(relops.distinct_on(t, ["k"], [-F.col("s")])) == [(1, "a", 2.0), (2, "b", 3.0), (3, None, None)]
    assert relops.rename_columns(t, ["k", "v"], ["v", "k"]).columns == ["v", "k", "s"]
    for bad in (lambda: relops.keep_columns(t, ["z"]), lambda: relops.drop_columns(t, t.columns), lambda: relops.add_fixed_columns(t, ["k"], 1), lambda: relops.assert_unique(t, ["k"]), lambda: relops.union_by_header([t, t.drop("s")]), lambda: relops.rename_columns(t, ["k"], ["v"])):
        with pytest.raises(TableError):
            bad()
    cells = spark.createDataFrame([("1",), ("1.0",), ("true",), ("TRUE",), ("x",), (None,), ("2",)], "c string")
    assert rows(relops.filter_by_value(cells, "c", "1")) == [("1",), ("1.0",), ("TRUE",), ("true",)] and len(rows(relops.filter_by_value(cells, "c", "1", keep=False))) == 3
    assert rows(relops.chunk_rows(t.select("k", "s"), 2, ["k", "s"]).select("chunk")) == [(1,), (1,), (2,), (2,)]
    assert relops.sample_by_key(t, "k", 1.0).count() == 4 and relops.sample_by_key(t, "k", 0.0).count() == 0 and relops.sample_to_target(t, "k", 10).count() == 4
    r = spark.createDataFrame([("q", 100.0, 1), ("q", 95.0, 2), ("q", 95.0, 3), ("q", 80.0, 4), ("q", None, 5), ("p", 0.0, 6)], "g string, s double, i int")
    assert rows(relops.rank_fraction_filter(r, "g", "s", 2, 0.9).select("i", "rank")) == [(1, 1), (2, 2), (3, 2), (6, 1)]


def test_sequences(spark):
    df = spark.createDataFrame([("ACGTn", "II!I5"), (None, None), ("", "")], "s string, q string")
    got = df.select(sq.reverse_complement(F.col("s")).alias("rc"), sq.mean_phred(F.col("q")).alias("m"), sq.kmers(F.col("s"), 4).alias("k"), sq.canonical_kmers(F.col("s"), 4).alias("c"), sq.linguistic_entropy(F.col("s"), 1).alias("e")).collect()
    assert got[0].rc == "nACGT" and got[0].m == pytest.approx((40 + 40 + 0 + 40 + 20) / 5) and got[0].k == ["ACGT", "CGTN"] and got[0].c == ["ACGT"] and got[0].e == pytest.approx(2.321928 / 2, abs=1e-5)
    assert got[1].rc is None and got[1].m == 0 and got[2].k == [] and got[2].e is None
    flags = spark.range(1).select(sq.mate_flag(F.lit(73)).alias("f"), sq.flag_set(F.lit(1040), sq.DUPLICATE).alias("d")).first()
    assert flags.f == 133 and flags.d


SAM = "@HD\tVN:1.6\n" + "\n".join(
    "\t".join(map(str, x)) for x in [
        ("r1", 99, "g1", 11, 40, "4M", "=", 31, 24, "ACGT", "IIII", "AS:i:40", "YS:i:38", "NM:i:0", "YT:Z:CP"), ("r1", 147, "g1", 31, 40, "4M", "=", 11, -24, "GGCC", "5555", "AS:i:38", "YS:i:40", "NM:i:1", "YT:Z:CP"),
        ("r2", 73, "g2", 5, 9, "4M", "=", 5, 0, "ACGT", "IIII", "AS:i:30", "NM:i:0", "YT:Z:UP"), ("r3", 73, "g1", 5, 9, "4M", "=", 5, 0, "ACGT", "IIII", "AS:i:2", "NM:i:0", "YT:Z:UP"),
    ]
) + "\n"


def test_sam_to_hits(spark, tmp_path, rows):
    (tmp_path / "a.sam").write_text(SAM)
    sam = readers.check_pair_status(readers.read_sam(spark, str(tmp_path / "a.sam")), paired=True)
    genomes = spark.createDataFrame([("g1", 7), ("g2", 8)], "genome_id string, taxid long")
    hits = {r.seq_id: r for r in workflows.hits_from_sam(sam, genomes, 10.0).collect()}
    assert set(hits) == {"r1", "r2"}
    r1 = hits["r1"]
    assert (r1.genome_id_all, r1.taxid, r1.fragment_length, r1.ref_start, r1.ref_start_rev, r1.query_seq_rev, r1.query_rc_rev, r1.best_alignment_score_rev) == ("g1", 7, 24, 10, 30, "GGCC", True, 38)
    assert hits["r2"].ref_start_rev is None and hits["r2"].fragment_length is None
    with pytest.raises(Exception):
        readers.check_pair_status(readers.read_sam(spark, str(tmp_path / "a.sam")), paired=False).collect()
    flat = readers.read_sam(spark, str(tmp_path / "a.sam"))
    lr = align.long_read_hits(flat, flat.where("seq_id <> 'r1'").select("seq_id", "seq", "qual"), genomes)
    assert rows(lr.select("seq_id", "classification", "ref_start")) == [("r2", "primary", 4), ("r3", "primary", 4)]


def test_files(spark, tmp_path, rows):
    with gzip.open(tmp_path / "a.fastq.gz", "wt") as f:
        f.write('@r1 first one\nACGT\n+\n"III\n@r2\nGG\n+\nII\n')
    assert rows(readers.read_fastq(spark, str(tmp_path / "a.fastq.gz")).select("record", "seq_id", "description", "seq", "qual")) == [(1, "r1", "first one", "ACGT", '"III'), (2, "r2", None, "GG", "II")]
    (tmp_path / "bad.fastq").write_text("@r1\nACGT\n+\nII\n")
    with pytest.raises(Exception):
        readers.read_fastq(spark, str(tmp_path / "bad.fastq")).collect()
    (tmp_path / "a.fasta").write_text(">s1 a genome\nACGT\nAC\n>s2\nGG\n")
    assert rows(readers.read_fasta(spark, str(tmp_path / "a.fasta")).select("seq_id", "description", "seq")) == [("s1", "a genome", "ACGTAC"), ("s2", None, "GG")]
    t = spark.createDataFrame([("a", '"q\\', None), ("b", "", 2)], "k string, q string, n int")
    writers.write_tsv(t, str(tmp_path / "t"))
    assert rows(readers.read_tsv(spark, str(tmp_path / "t"), "k string, q string, n int"))[0] == ("a", '"q\\', None)
    (tmp_path / "nodes.dmp").write_text("1\t|\t1\t|\tno rank\t|\n5\t|\t1\t|\tspecies\t|\n")
    assert rows(readers.read_nodes(spark, str(tmp_path / "nodes.dmp"))) == [(1, 1, "no rank"), (5, 1, "species")]
    hits = spark.createDataFrame([("r", "AC", None, "II", None)], "seq_id string, query_seq string, query_seq_rev string, query_qual string, query_qual_rev string")
    assert writers.fastq_text(hits).first()[0] == "@r 1\nAC\n+\nII\n@r 2\nN\n+\n!" and writers.fastq_text(hits, drop_unpaired=True).count() == 0
    (tmp_path / "sheet.csv").write_text("sample,fastq\ns,a.fq\n")
    assert readers.read_sample_sheet(spark, str(tmp_path / "sheet.csv"), "ont").count() == 1
    with pytest.raises(TableError):
        readers.read_sample_sheet(spark, str(tmp_path / "sheet.csv"), "illumina")
    files = spark.createDataFrame([("/x/s_a.tsv",), ("/x/s_a.tsv.gz",)], "file string")
    samples = spark.createDataFrame([("s",)], "sample string")
    assert rows(readers.discover_outputs(samples, ["a.tsv"], files)) == [("s", "a.tsv", "/x/s_a.tsv.gz")]
    with pytest.raises(TableError):
        readers.discover_outputs(samples, ["b.tsv"], files)


def test_schema_violations(spark, rows):
    t = spark.createDataFrame([("s", "4", "2", "g"), ("s", "-1", None, "g"), (None, "x", "1", "h")], "sample string, n_reads_single string, n_read_pairs string, `group` string")
    got = rows(schemas.violations(t, schemas.TABLES["read_counts"]))
    assert ("sample", "null", 1) in got and ("n_reads_single", "below 0", 1) in got and ("n_reads_single", "not bigint", 1) in got and ("group,sample", "repeated key", 1) in got


def test_reads_and_compare(spark, rows):
    t = spark.createDataFrame([("s", "ACGT"), ("s", "acgt"), ("s", "GG"), ("u", None)], "sample string, q string")
    assert rows(reads.basic_stats(t, "sample", "q")) == [("s", 3, 10, 3.3333, 60.0, 33.3333, 2)]
    index = reads.kmer_index(spark.createDataFrame([("i", "AAACCC")], "n string, s string"), "n", "s", 4)
    r = spark.createDataFrame([("hit", "GGGTTT"), ("miss", "ACACAC"), ("short", "AC")], "r string, s string")
    assert {x.r: x.matched for x in reads.kmer_screen(r, "r", "s", index, 4).collect()} == {"hit": True, "miss": False, "short": False}
    a, b = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string"), spark.createDataFrame([(2, "z"), (3, "y")], "k int, v string")
    assert rows(compare.changed_keys(a, b, "k")) == [(1, "lost"), (3, "gained")] and rows(compare.transitions(a, b, "k", "v")) == [("y", "z", 1)]
    assert spark.range(1).select(compare.last_reason([(F.lit(True), "a"), (F.lit(True), "b"), (F.lit(False), "c")], "d")).first()[0] == "b"


def test_small_filters(spark, tmp_path, rows):
    f = spark.createDataFrame([("s1 a Phage", "AC", 2), ("s1 b", "ACGT", 1), (None, "A", 3)], "h string, seq string, o int")
    assert rows(reads.without_headers_like(f, "h", ["phage", "xyz"]).select("o")) == [(1,), (3,)]
    assert rows(reads.between_lengths(f, "seq", 2, 3).select("o")) == [(2,)]
    assert rows(reads.first_by_name(f.withColumn("n", F.substring("h", 1, 2)), "n", ["o"]).select("o")) == [(1,), (3,)]
    pairs = spark.createDataFrame([("r", "A", "I", "C", "J")], "seq_id string, seq string, qual string, seq_rev string, qual_rev string")
    assert rows(reads.interleaved(pairs)) == [("r", 1, "A", "I"), ("r", 2, "C", "J")]
    (tmp_path / "a.sam").write_text(SAM)
    mapped, unmapped = align.split_mapped(readers.read_sam(spark, str(tmp_path / "a.sam")))
    assert (mapped.count(), unmapped.count()) == (4, 0)


def test_streams(spark, tmp_path, rows):
    from virelay.streaming import incremental

    t = spark.sql("SELECT * FROM VALUES ('a', 1, timestamp'2025-01-01 01:00:00'), ('a', 1, timestamp'2025-01-01 01:00:00'), ('b', 2, timestamp'2025-01-02 01:00:00') AS t(k, v, at)")
    t.write.parquet(str(tmp_path / "t.parquet"))
    once = incremental.without_redelivered(incremental.stream_table(spark, str(tmp_path), "t"), ["k", "v"], "at", "1 day")
    incremental.write_available(once, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "out")).select("k", "v")) == [("a", 1), ("b", 2)]


def test_workflow_of_validation(spark, paths, rows):
    hits = spark.createDataFrame([("a", 9005), ("b", 9006)], "seq_id string, aligner_taxid_lca long")
    members = spark.createDataFrame([("a", "a"), ("b", "a")], "seq_id string, vsearch_cluster_rep_id string")
    lca = spark.createDataFrame([("a", 9007)], "seq_id string, validation_lca long")
    got = workflows.validate_hits(hits, members, lca, paths)
    assert rows(got.select("seq_id", "validation_distance_aligner", "validation_distance_validation")) == [("a", 2, 1), ("b", 2, 1)]
    search = spark.createDataFrame([("q", "s1", 9005, 100.0, 50, 1), ("q", "s1", 9005, 90.0, 60, 2), ("q", "s2", 9006, 95.0, 50, 3), ("q", "s3", 8001, 50.0, 50, 4)], "qseqid string, sseqid string, staxid long, bitscore double, length int, ordinal int")
    assert workflows.search_lca(search, paths).first().taxid_lca == 9004
    db = spark.createDataFrame([(9005, 9004), (9006, None)], "taxid long, taxid_species long")
    assert rows(workflows.by_species(hits, db).select("seq_id", "selected_taxid")) == [("a", 9004), ("b", 9006)]


def test_entry_contract(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries()) and e.entry(spark).count() > 0


def test_core_does_not_import_llm():
    from pathlib import Path

    root = Path(__file__).resolve().parent.parent / "virelay"
    assert not [p for p in root.rglob("*.py") if "llm" not in p.parts and "virelay.llm" in p.read_text()]
