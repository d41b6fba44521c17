"""Whole jobs where a review found cuts."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from virelay.operators import hierarchy as h

DATA = Path("/root/testdata/sf0.001")


def same_as_sql(spark, rows, name):
    """The query's rows, after comparing them with those of its SQL."""
    import __spark_entry__ as e

    duckdb = pytest.importorskip("duckdb")
    if not DATA.is_dir():
        pytest.skip("no tables")
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for p in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    got = e.queries()[name](spark, str(DATA))
    sql = con.execute(e.oracle_sql()[name])
    at = [[c[0] for c in sql.description].index(c) for c in got.columns]
    key = lambda t: [(x is None, str(x)) for x in t]
    want = sorted((tuple(r[i] for i in at) for r in sql.fetchall()), key=key)
    assert sorted((tuple(r) for r in got.collect()), key=key) == want
    return want


def test_every_alignment_reaches_the_distance(spark, rows):
    got = same_as_sql(spark, rows, "taxid_distance_reads")
    assert len(got) == spark.read.parquet(str(DATA / "tab_minimap.parquet")).count()
    assert sum(r[2] is not None for r in got) > len(got) * 0.9


@pytest.mark.parametrize("level", [1, 4])
def test_roots_of_small_trees_spread_over_fragments(spark, level):
    n, size = 4000, 100
    links = spark.range(2 * n).select(F.col("id").alias("node"), F.when(F.col("id") >= n, F.col("id") - n).alias("parent"), F.array("id").alias("load"))
    frags = h._fragments(links, 2 * n, level, size).groupBy("frag").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("parent").isNull()).alias("roots")).collect()
    assert sum(f.n for f in frags) == 2 * n
    assert max(f.n for f in frags) < 3 * size and max(f.roots for f in frags) < 2 * size


def test_forest_of_many_two_level_trees(spark):
    n = 3000
    links = spark.range(2 * n).select(F.col("id").alias("node"), F.when(F.col("id") >= n, F.col("id") - n).alias("parent"))
    got = h.hierarchy(links, 200)
    assert got.where(F.col("node") < n).agg(F.count_if((F.col("depth") == 0) & (F.col("n_descendants") == 1) & (F.col("root") == F.col("node")))).first()[0] == n
    assert got.where(F.col("node") >= n).agg(F.count_if((F.col("depth") == 1) & (F.col("root") == F.col("node") - n))).first()[0] == n


@pytest.mark.parametrize("how", ["inner", "left", "right", "outer", "semi", "anti"])
def test_joins_take_whole_tables(spark, rows, how):
    got = same_as_sql(spark, rows, f"join_{how}_taxa")
    n = spark.read.parquet(str(DATA / "tab_minimap.parquet")).count()
    matched = len(same_as_sql(spark, rows, "join_inner_taxa"))
    unmatched = n - matched
    assert 0 < unmatched
    assert {"inner": len(got) == matched, "semi": len(got) == matched, "anti": len(got) == unmatched, "left": len(got) == n, "right": len(got) > matched, "outer": len(got) > n}[how]


def test_strict_join_of_a_growing_pair(spark, rows):
    assert len(same_as_sql(spark, rows, "join_strict_parts")) == spark.read.parquet(str(DATA / "lineitem.parquet")).count()
