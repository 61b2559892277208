from __future__ import annotations

import pytest

from replygauge.functions.numeric import in_range, is_bad_sum, to_number
from replygauge.functions.replies import ReplySchema, Score, Text, overall_matches, parse_replies, repair_open_fence

SCHEMA = ReplySchema((Score("score"), Text("why")))
OBJECT = '{"output":{"score":3,"why":"x"}}'
CASES = {
    OBJECT: "ok",
    '{"score":3,"why":"x"}': "wrong_shape",
    '{"output":{"score":4,"comment":"x"}}': "wrong_shape",
    '{"output":{"score":3,"why":"x","extra":1}}': "wrong_shape",
    '{"output":null}': "wrong_shape",
    '{"output":[1]}': "wrong_shape",
    '{"output":{}}': "wrong_shape",
    "I'm sorry, I can't do that.": "prose",
    "[1]": "prose",
    f"```json\n{OBJECT}": "open_fence",
    f"```json\n{OBJECT}\n```": "ok",
    f" \n```\n{OBJECT}\n```\n": "ok",
    '{"output":{"score":3,"why":"cut off': "truncated",
    '{"output":{"score":3,"why":"cut off"}': "malformed",
    f"{OBJECT} Hope this helps.": "trailing_text",
    f"{OBJECT}}}": "trailing_text",
    f"{OBJECT} {OBJECT}": "trailing_text",
    "": "empty",
    " \n": "empty",
    None: "empty",
    '{"output":{"score":"3","why":"x"}}': "bad_type",
    '{"output":{"score":2.5,"why":"x"}}': "bad_type",
    '{"output":{"score":null,"why":"x"}}': "bad_type",
    '{"output":{"score":3,"why":7}}': "bad_type",
    '{"output":{"score":true,"why":"x"}}': "bad_type",
    '{"output":{"score":3.0,"why":"x"}}': "ok",
    '{"output":{"score":3e0,"why":"{}"}}': "ok",
    '{"output":{"score":9,"why":"x"}}': "out_of_range",
    '{"output":{"score":0,"why":"x"}}': "out_of_range",
    '{"output":{"score":99999999999999999999,"why":"x"}}': "out_of_range",
}


def test_each_reply_gets_its_class_and_only_ok_has_values(spark):
    df = spark.createDataFrame([(raw,) for raw in CASES], "raw string")
    rows = parse_replies(df, "raw", SCHEMA).collect()
    assert {row.raw: row.reply_class for row in rows} == CASES
    for row in rows:
        assert (row.reply is not None) == (row.reply_class == "ok")
        if row.reply is not None:
            assert row.reply.score == 3


def test_open_fence_can_be_repaired(spark, column):
    assert column([f"```json\n{OBJECT}"], repair_open_fence("t")) == [OBJECT]
    df = spark.createDataFrame([(f"```json\n{OBJECT}",)], "raw string")
    assert parse_replies(df, "raw", SCHEMA, repair=True).first().reply_class == "ok"


def test_overall_is_compared_with_its_parts(spark):
    schema = ReplySchema((Score("a"), Score("b"), Score("total", 2, 6)))
    raws = ['{"output":{"a":1,"b":2,"total":3}}', '{"output":{"a":1,"b":2,"total":4}}']
    df = parse_replies(spark.createDataFrame([(r,) for r in raws], "raw string"), "raw", schema)
    assert [r.ok for r in df.select(overall_matches("reply", "a", "b", "total").alias("ok")).collect()] == [True, False]


@pytest.mark.parametrize("value, number", [
    (" 3 ", 3.0), ("1e0", 1.0), ("3.0", 3.0), ("+2", 2.0), (".5", 0.5), ("-1.", -1.0), ("\n3\t", 3.0),
    ("1_0", None), ("3f", None), ("3d", None), ("nan", None), ("inf", None), ("", None), ("abc", None), (None, None),
])
def test_numbers_in_text(column, value, number):
    assert column([value], to_number("t")) == [number]
    assert column([value], in_range("t", 1, 3)) == [number is not None and 1 <= number <= 3]


def test_sums_skip_rows_that_are_not_numbers(spark):
    rows = [("1", "2", "3"), ("1", "2", "4"), ("x", "2", "4"), ("1", "nan", "4"), (None, "1", "1")]
    df = spark.createDataFrame(rows, "a string, b string, o string")
    assert [r.bad for r in df.select(is_bad_sum("a", "b", "o").alias("bad")).collect()] == [False, True, False, False, False]
