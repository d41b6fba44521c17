"""Cost of pages read across columns: a step over their pieces carries no copies of the pieces before it."""

import time

from pyspark.sql import functions as F

from virelay.llm import sentences

BOXED = "doc_id long, text string, line_boxes array<struct<x0:int,y0:int,x1:int,y1:int,conf:double>>"


def test_long_page_read_across(spark):
    def spans(n):
        text = "\n".join(["The jury opened the   The board left the"] * n)
        return sentences.sentences(spark.createDataFrame([(1, text, [(110, 0, 1600, 0, 1.0)] * n)], BOXED))

    spans(50).count()  # compiles
    begin = time.perf_counter()
    assert spans(3000).agg(F.count("*")).first()[0] == 3
    assert time.perf_counter() - begin < 25
