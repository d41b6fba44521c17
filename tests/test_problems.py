"""Hot keys, hierarchies, packed fields and orphans on small cases: nulls, ties, repeats, empty tables, clashing names."""

import datetime as dt

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from virelay.operators import hierarchy as h
from virelay.operators.hot_keys import heavy_keys, key_counts, key_summary
from virelay.operators.orphans import Entity, Reference, direct_orphans, orphan_report
from virelay.operators.packed import explode_packed, split_packed


def test_key_summary(spark, rows):
    df = spark.createDataFrame([("a", "r1", 1.0, 1), ("a", "r1", 2.0, 2), ("a", None, None, 3), ("a", "r2", float("nan"), 4), (None, "r3", 9.0, 5), ("b", "r3", None, 6)], "k string, m string, v double, __k int")
    assert rows(key_summary(df, "k", "m", "v")) == [("a", 4, 2, 2, 1.5, 1.0, 2.0), ("b", 1, 1, 0, None, None, None)]
    assert key_summary(df.limit(0), "k", "m", "v").count() == 0
    assert rows(key_counts(df, "k")) == [("a", 4), ("b", 1)]


def test_heavy_keys_counts_nulls_in_the_total(spark, rows):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)] * 2 + [(None,)] * 95, "k string")
    assert rows(heavy_keys(df, "k", 3)) == [("a", 3, 100)]
    assert heavy_keys(df.limit(0), "k", 3).count() == 0


def brute_tree(parent):
    out = {}
    for n in parent:
        path, x, seen = [], n, set()
        while x is not None and x not in seen:
            seen.add(x)
            path.append(x)
            p = parent[x]
            x = None if p is None or p == x or p not in parent else p
        out[n] = None if x is not None else path[::-1]
    return {n: (p[0] if p else -1, len(p) - 1 if p else -1, sum(1 for q in out.values() if q and n in q[:-1]) if p else -1, p or []) for n, p in out.items()}


@pytest.mark.parametrize("size", [3, 1000])
@settings(max_examples=6, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.one_of(st.none(), st.integers(1, 45)), min_size=1, max_size=40))
def test_hierarchy_equals_brute_force(spark, size, parent):
    df = spark.createDataFrame(list(parent.items()), "n long, p long")
    got = {r.node: (r.root, r.depth, r.n_descendants, list(r.path)) for r in h.hierarchy(h.latest_links(df, "n", "p"), size).collect()}
    assert got == brute_tree(parent)


def test_hierarchy_long_chain_and_star_over_many_fragments(spark):
    chain = [(i, i - 1 if i else None) for i in range(300)] + [(1000 + i, 5) for i in range(200)]
    got = {r.node: (r.root, r.depth, r.n_descendants) for r in h.hierarchy(spark.createDataFrame(chain, "node long, parent long"), 20).collect()}
    assert got[299] == (0, 299, 0) and got[5] == (0, 5, 294 + 200) and got[1199] == (0, 6, 0) and got[0][2] == 499


def test_latest_links(spark, rows):
    df = spark.createDataFrame([(1, None, 1), (2, 1, 1), (2, 3, 2), (3, 1, 1), (3, 3, 1), (4, 9, 1), (None, 1, 1), (5, 3, 7), (5, 2, 7)], "node long, parent long, v int")
    assert rows(h.latest_links(df, "node", "parent", "v")) == [(1, None), (2, 3), (3, 1), (4, None), (5, 2)]
    assert h.hierarchy(h.latest_links(df.limit(0), "node", "parent", "v")).count() == 0


PACKED = {
    None: None, "": [], "  ": [], "a": ["a"], "a b": ["a", "b"], "a\tb": ["a", "b"], " a ; b ": ["a", "b"], "[a;b]": ["a", "b"], "[;w]": ["", "w"], "a;;b": ["a", "", "b"], "; |w": ["", "", "w"],
    '"x; y" / z': ["x; y", "z"], 'a "b ""q"", c" d': ["a", 'b "q", c', "d"], "'it''s' , \"d\"": ["it's", "d"], "[]": [], "[ a ]": ["a"], "a,": ["a", ""], '""': [""], '"";""': ["", ""], "O'Brien, x": ["O'Brien", "x"],
    "'x \"t\", p'|b": ['x "t", p', "b"], '"[a"]': ['[a'] if False else ['"[a"]'], "é;ü": ["é", "ü"], ",": ["", ""], '"open; end': ['"open; end'],
}


def test_split_packed():
    got = split_packed(pa.array(list(PACKED), pa.string())).to_pylist()
    assert dict(zip(PACKED, got, strict=True)) == PACKED
    assert split_packed(pa.array([], pa.string())).to_pylist() == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab ;,|/\t\"'[](é", max_size=30), max_size=8))
def test_split_packed_is_the_same_alone_and_together(texts):
    alone = [split_packed(pa.array([t])).to_pylist()[0] for t in texts]
    assert split_packed(pa.array(texts, pa.string())).to_pylist() == alone


def test_explode_packed(spark, rows):
    df = spark.createDataFrame([(1, "a;b", "x"), (2, None, "p q r"), (2, "", '"one"')], "row_no long, pos string, g string")
    assert rows(explode_packed(df, "row_no", ["pos", "g"], least=2)) == [(1, "pos", 1, "a"), (1, "pos", 2, "b"), (2, "g", 1, "p"), (2, "g", 2, "q"), (2, "g", 3, "r")]
    assert len(rows(explode_packed(df, "row_no", ["pos", "g"]))) == 7
    long = spark.createDataFrame([(1, ";".join(str(i) for i in range(20000)))], "row_no long, g string")
    assert explode_packed(long, "row_no", ["g"], batch_bytes=100).agg(F.max("pos")).first()[0] == 20000


def test_orphans(spark, rows):
    t = lambda d: dt.datetime(2025, 1, d)
    v = spark.createDataFrame([(1, None, t(1), t(5)), (1, None, t(4), t(9)), (2, 1, t(10), None), (3, 99, t(1), None), (4, 3, t(1), None), (4, 3, t(1), None), (None, 1, t(1), None)], "taxid long, parent long, loaded_at timestamp, deleted_at timestamp")
    refs = spark.createDataFrame([(1, 1, t(4)), (2, 1, t(9)), (3, 2, t(9)), (4, 7, t(1)), (5, None, t(1)), (6, 4, t(2)), (6, 4, t(2)), (7, 3, None)], "row_no long, k long, at timestamp")
    e, r = Entity("v", "taxid", "loaded_at", "deleted_at", "parent"), Reference("refs", "k", "row_no", "at", "v")
    got = direct_orphans(refs, r, v, e).select("row_no", "kind")
    assert rows(got) == [(2, "deleted"), (3, "late"), (4, "missing"), (7, "deleted")]
    assert {x[1] for x in rows(direct_orphans(refs, r, v.limit(0), e).select("row_no", "kind"))} == {"missing"}
    report = {(x.kind): x.n_refs for x in orphan_report({"v": v, "refs": refs}, [r], [e]).where("period_month = '2025-01'").collect()}
    assert report["inherited"] == 2


def test_orphan_cascade_goes_down_long_chains_and_stops_at_loops(spark):
    t = dt.datetime(2025, 1, 1)
    chain = [(i, i - 1, t, None) for i in range(2, 40)] + [(1, 900, t, None), (100, 101, t, None), (101, 100, t, None)]
    v = spark.createDataFrame(chain, "taxid long, parent long, loaded_at timestamp, deleted_at timestamp")
    from virelay.operators.orphans import orphan_entities

    got = orphan_entities({"v": v}, [Entity("v", "taxid", "loaded_at", "deleted_at", "parent")])
    assert {(r.entity_key, r.inherited) for r in got.collect()} == {(1, False)} | {(i, True) for i in range(2, 40)}
