"""Cases of the second round: pages of other geometry, long pieces, empty documents."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from virelay.llm import bpe, mixing, sentences

BOXED = "doc_id long, text string, line_boxes array<struct<x0:int,y0:int,x1:int,y1:int,conf:double>>"


def units(spark, text, boxes):
    df = spark.createDataFrame([(1, text, [(int(a), 0, int(b), 0, 1.0) for a, b in boxes])], BOXED)
    return [text[r.start_char : r.end_char] for r in sentences.sentences(df).orderBy("start_char", "end_char").collect()]


@pytest.mark.parametrize("scale, shift", [(1, 0), (0.4, 300), (3.5, -200)])
def test_layout_at_any_resolution(spark, scale, shift):
    lines = ["FIRE AT MARAC", "The jury lost sight of the", "TO BE LET", "Try it once! No house should", "be without it.", "cotton shed. The tug left.", "It sank", "New line ends.", "THE OTHER", "A mail came."]
    boxes = [(200, 758), (145, 830), (165, 770), (165, 770), (165, 770), (110, 840), (110, 840), (145, 838), (990, 1540), (935, 1620)]
    boxes += [(900, 1622), (901, 1619)]
    lines += ["It was late", "and cold."]
    got = units(spark, "\n".join(lines), [(a * scale + shift, b * scale + shift) for a, b in boxes])
    assert got == [
        "FIRE AT MARAC", "\n".join(lines[1:5]) + "\ncotton shed.", "TO BE LET", "Try it once!", "No house should\nbe without it.", "The tug left.", "It sank", "New line ends.", "THE OTHER", "A mail came.", "It was late\nand cold.",
    ]


def test_three_columns_read_across(spark):
    text = "ONE WORD   TWO WORDS   THREE WORDS\nThe jury opened the   The board left the   A tug lost a\ngate. It closed.   cotton shed.   mast. It rained.\nThe end came."
    got = units(spark, text, [(200, 2330), (145, 2410), (110, 2410), (145, 838)])
    assert [" ".join(u.split()) for u in got if "   " not in u] == ["ONE WORD", "TWO WORDS", "THREE WORDS", "It closed.", "It rained.", "The end came."]
    assert [u[:8] for u in got if "   " in u] == ["The jury", "The boar", "A tug lo"]


def test_long_pieces_are_merged_alike():
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(bpe.VOCABULARY)
    rng = np.random.default_rng(5)
    texts = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), n)) for n in (1000, 1025, 5000, 20000)] + ["aaab" * 3000, "漢字仮名交じり文" * 900, "a" * 30001, "ab c" + "the" * 4000 + " x"]
    assert bpe.encode_texts(pa.array(texts)).to_pylist() == [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def test_many_empty_documents_are_not_grouped(spark):
    docs = spark.range(200_000).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.when(F.col("id") % 1000 == 0, F.col("id") % 50 + 1).otherwise(0).alias("n_tokens"))
    targets = spark.createDataFrame([("m", "s", 1.0, 3, 0.5)], "mix_id string, source string, target_share double, max_repeats int, budget_ratio double")
    uses, shares = mixing.mix(docs, targets, bucket_rows=50, fan_in=4)
    assert uses.count() == 200_000 and uses.where("n_tokens = 0 AND n_uses > 0").count() == 0
    one = shares.first()
    assert abs(one.used_tokens - one.wanted_tokens) <= 50
