"""Top items, groups, encoding, mixing and sentences on small cases."""

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from virelay.llm import bpe, components, mixing, sentences, top_n


def test_top_n(spark, rows):
    data = [("a", i % 7, i % 5, i) for i in range(200)] + [("b", 1, 3, 0), ("b", 2, 3, 0), ("b", 2, 3, 0), (None, 1, 1, 0), ("c", None, 1, 0), ("d", 1, None, 0)]
    df = spark.createDataFrame(data, "g string, i int, s int, rank_no int")
    assert rows(top_n.top_n(df, "g", "i", "s", 3)) == [("a", 1, 0, 4), ("a", 2, 1, 4), ("a", 3, 2, 4), ("b", 1, 1, 3), ("b", 2, 2, 3)]
    assert top_n.top_n(df.limit(0), "g", "i", "s", 3).count() == 0


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 25)), st.one_of(st.none(), st.integers(0, 25))), max_size=40))
def test_groups_equal_brute_force(spark, pairs):
    df = spark.createDataFrame([(None if a is None else f"n{a:02}", None if b is None else f"n{b:02}") for a, b in pairs], "a string, b string")
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in df.collect():
        if a is not None and b is not None and a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    assert {r["name"]: r.group_name for r in components.linked_groups(df, "a", "b").collect()} == {x: find(x) for x in parent}


def test_groups_of_chain_and_star(spark):
    chain = [(f"c{i:03}", f"c{i + 1:03}") for i in range(150)] + [("hub", f"s{i}") for i in range(300)]
    got = components.linked_groups(spark.createDataFrame(chain, "a string, b string"), "a", "b")
    assert {(r.group_name, r.group_size) for r in got.collect()} == {("c000", 151), ("hub", 301)}
    alone = components.all_groups(spark.createDataFrame([("x",), ("hub",), (None,)], "name string"), "name", got)
    assert {r["name"]: r.group_size for r in alone.collect() if r["name"] in ("x", "hub")} == {"x": 1, "hub": 301}


@pytest.fixture(scope="module")
def reference():
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(bpe.VOCABULARY)
    t.encode_special_tokens = True
    return lambda texts: [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.characters(codec="utf-8", max_codepoint=0x2FFF), st.sampled_from(list(" \n\t''stvrelmd09中文🎉"))), max_size=60), min_size=1, max_size=6))
def test_encoding_equals_the_library(reference, texts):
    known = [t for t in texts if all(ord(c) < 0x2FF0 for c in t)]
    assert bpe.encode_texts(pa.array(known, pa.string())).to_pylist() == reference(known)


def test_encoding_of_odd_texts(reference):
    odd = ["", " ", "\n\n", "a" * 9000, "ab" * 5000, "  x", "it's they'll 're", "<|endoftext|>", "x" * 70000, " a　b", "é" * 3000]
    assert bpe.encode_texts(pa.array(odd)).to_pylist() == reference(odd)
    assert bpe.encode_texts(pa.array([None, "a"])).to_pylist()[0] == []
    assert bpe.count_texts(pa.array([*odd, None])).to_pylist() == [len(x) for x in reference(odd)] + [0]


def test_encode_query(spark):
    df = spark.createDataFrame([(1, "hello world", "x"), (2, None, "y"), (2, "", "z")], "doc_id long, text string, ids string")
    assert {(r.doc_id, len(r.ids)) for r in bpe.encode(df, ["doc_id"]).collect()} == {(1, 2), (2, 0)}
    assert bpe.encode(df.limit(0), ["doc_id"]).count() == 0


@settings(max_examples=50, deadline=None)
@given(st.lists(st.tuples(st.floats(0.01, 0.99), st.integers(1, 500)), min_size=1, max_size=60), st.integers(0, 99))
def test_pivot_keeps_sizes_and_leaves_one(pairs, seed):
    p, w = np.array([x for x, _ in pairs]), np.array([float(x) for _, x in pairs])
    q = mixing.pivot(p, w, np.random.default_rng(seed))
    assert abs((p * w).sum() - (q * w).sum()) < 1e-6 and ((q > 0) & (q < 1)).sum() <= 1 and ((q >= 0) & (q <= 1)).all()


def test_pivot_keeps_expectations():
    p, w = np.full(20, 0.3), np.arange(1.0, 21.0)
    mean = np.mean([mixing.pivot(p, w, np.random.default_rng(i)) for i in range(3000)], axis=0)
    assert np.abs(mean - 0.3).max() < 0.04


def test_mix(spark):
    docs = spark.createDataFrame([(i, "big" if i % 4 else "small", 10 + i % 7) for i in range(4000)] + [(9000, "big", 0), (9001, None, 500), (9002, "big", None)], "doc_id long, source string, n_tokens long")
    targets = spark.createDataFrame([("m", "big", 0.5, 2, 0.5), ("m", "small", 0.5, 1, 2.0), ("m", "small", 0.5, 1, 2.0), ("m", "gone", 0.1, None, 0.5), (None, "big", 1.0, 1, 1.0)], "mix_id string, source string, target_share double, max_repeats int, budget_ratio double")
    uses, shares = mixing.mix(docs, targets, bucket_rows=100, fan_in=4)
    by = {r.source: r for r in shares.collect()}
    assert abs(by["big"].used_tokens - by["big"].wanted_tokens) <= 17 and by["small"].used_tokens == by["small"].source_tokens and by["gone"].used_tokens == 0
    assert uses.where("n_uses < 0 OR n_uses > 2").count() == 0 and uses.where("n_tokens = 0 AND n_uses > 0").count() == 0 and uses.count() == 4002
    again, _ = mixing.mix(docs.repartition(7), targets, bucket_rows=100, fan_in=4)
    assert uses.exceptAll(again).count() == 0
    assert mixing.mix(docs.limit(0), targets)[0].count() == 0


def units(spark, text, boxes=None):
    df = spark.createDataFrame([(1, text, boxes)], "doc_id long, text string, line_boxes array<struct<x0:int,y0:int,x1:int,y1:int,conf:double>>")
    return [text[r.start_char : r.end_char] for r in sentences.sentences(df).orderBy("start_char", "end_char").collect()]


def box(x0, x1):
    return (x0, 0, x1, 0, 1.0)


CASES = {
    "Mr. T. Pelidale paid at 9.15 p.m. near the gate. He left.": 2, "It cost £49.45; the copper, 4s. 6½d. The end.": 2, "“A scythe?” said a crowd; “never a sickle!” Treacle is flat.": 2, 'Maridale said: "We lost it. The mail forgot it." Bonnet is dear.': 2,
    "(The jury paid. It left.) Several farmers came.": 2, "Am 17. März kam d. h. niemand usw. Der Zug fuhr.": 2, "« Est-ce la jument ? » demanda le vieux passeur. On vendit.": 2, "Πότε άνοιξε τη γέφυρα; Ο κ. Σολδα πούλησε τον τοίχο· δύο είδαν.": 2,
    "«فتح حارسان الجسر!» صاح ولاور. وصف حارسان برميل زيت.": 2, "क्या गाड़ी आई? \"बूढ़ा मल्लाह ने पीपा खोला!\" तोरागढ़ ने कहा।": 2, "老船夫卖掉了木桥。“夜班列车忘记了！”枫人喊道。价格涨至30.79元。": 3, "「織工は伝えた！」と者は叫んだ。大麦は21.29円に上がった。": 2,
    "ดร.โมนาเปิดตะเกียง 76 ครั้ง พายุตำรวจตรวจ \"ทิ้งใหม่\" ตลาด": 2, "Когда толпа ткачей открыл т. д. и т. п. стену? Цена 25,45 руб. в г. Моровка.": 2, "": 0, "   ": 0, "\n\n": 0,
}


@pytest.mark.parametrize("text", CASES)
def test_sentence_counts(spark, text):
    got = units(spark, text)
    assert len(got) == CASES[text], got


def test_sentences_round_advert_and_column(spark):
    lines = ["FIRE AT MARAC", "The jury lost sight of the", "TO BE LET", "Try it once! No house should", "be without it.", "cotton shed. The tug left.", "* * *", "New line ends", "THE OTHER", "A mail came."]
    boxes = [box(200, 758), box(145, 830), box(165, 770), box(165, 770), box(165, 770), box(110, 840), box(110, 840), box(145, 600), box(990, 1540), box(935, 1620)]
    assert units(spark, "\n".join(lines), boxes) == [
        "FIRE AT MARAC", "\n".join(lines[1:5]) + "\ncotton shed.", "TO BE LET", "Try it once!", "No house should\nbe without it.", "The tug left.", "New line ends", "THE OTHER", "A mail came.",
    ]


def test_sentences_of_merged_columns(spark):
    text = "LATEST BY WIRE   FIRE AT CORVEAC\nThe jury opened the   The board left the\ngate. It closed.   cotton shed."
    boxes = [box(200, 1540), box(145, 1620), box(110, 1620)]
    assert units(spark, text, boxes) == ["LATEST BY WIRE", "FIRE AT CORVEAC", text[33:77].strip() if False else text[text.index("The jury") : text.index(" It closed")], text[text.index("The board") :], "It closed."]


def test_sentences_odd_rows(spark):
    df = spark.createDataFrame([(1, "One here. Two here.", None), (1, "One here. Two here.", None), (None, "Lost.", None), (2, None, None)], "doc_id long, text string, line_boxes array<struct<x0:int,y0:int,x1:int,y1:int,conf:double>>")
    assert sentences.sentences(df).count() == 2
    assert sentences.sentences(df.limit(0)).count() == 0
    long = spark.createDataFrame([(3, "\n".join("This is line %d of it." % i for i in range(3000)))], "doc_id long, text string")
    assert sentences.sentences(long, boxes=None).count() == 3000
    assert sentences.sentences(spark.createDataFrame([(4, "x" * 200000)], "doc_id long, text string"), boxes=None).agg(F.max("end_char")).first()[0] == 200000
