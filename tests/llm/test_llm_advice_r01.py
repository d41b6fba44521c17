"""Quotations where a review found a cap."""

import pytest

from virelay.llm import sentences

MARKS = {"„": "“", "“": "”", "»": "«", "«": "»", '"': '"', "''": "''", "「": "」"}


@pytest.mark.parametrize("open_", MARKS)
@pytest.mark.parametrize("n", [3, 60, 3000])
def test_long_quotations_are_one_unit(spark, open_, n):
    if open_ == "「":
        text = "老人は言った。「" + "船は港を出た。" * n + "」と船長は言った。雨が降った。"
    else:
        text = f"It rained. The captain said: {open_}" + " ".join(["The ship left the port."] * n) + f"{MARKS[open_]} Then they left."
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = [text[r.start_char : r.end_char] for r in sentences.sentences(df, boxes=None).orderBy("start_char").collect()]
    assert len(got) == 3 and open_ in got[1] and MARKS[open_] in got[1]


@pytest.mark.parametrize("n", [3, 60])
def test_text_between_german_quotations_is_cut(spark, n):
    text = "(»Wer kam?«) " + "Er ging heim. " * n + "»Wer kam?« fragte er. Regen fiel."
    text = text.replace("(»", "x»").replace("«)", "«")
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert sentences.sentences(df, boxes=None).count() >= n
