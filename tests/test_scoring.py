from __future__ import annotations

import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from replygauge.functions import scoring as sc
from replygauge.operators.audit import audit


def rows(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_auto_send_and_human_routing_fail_closed(spark):
    df = spark.createDataFrame(
        [(3, 3, False, 6), (3, 2, False, 5), (3, 3, True, 4), (3, None, False, None), (3, 3, None, 6)],
        "issue int, clarity int, flag boolean, overall int",
    )
    got = rows(df, sc.auto_send("issue", "clarity", "flag"), sc.needs_human("overall"))
    assert got == [(True, False), (False, False), (False, True), (False, True), (False, False)]


def test_verdict_needs_mean_and_faithfulness(spark):
    df = spark.createDataFrame([(5, 5, 4), (5, 5, 3), (3, 3, 5), (None, 5, 5)], "a int, b int, faith int")
    assert rows(df, sc.verdict(["a", "b", "faith"], "faith")) == [(True,), (True and False,), (False,), (False,)]


def test_queue_takes_a_row_for_any_unknown_term(spark):
    cases = [
        (True, True, False, True, False), (False, True, False, True, True), (None, True, False, True, True),
        (True, None, False, True, True), (True, True, True, True, True), (True, True, None, True, True),
        (True, True, False, None, True),
    ]
    df = spark.createDataFrame(cases, "a boolean, b boolean, self boolean, usable boolean, want boolean")
    assert all(got == want for got, want in rows(df, sc.in_review_queue(["a", "b"], "self", ["usable"]), "want"))


def test_cap_and_route(spark):
    df = spark.createDataFrame([(3, True), (3, False), (3, None)], "score int, bad boolean")
    assert rows(df, sc.cap("score", "bad")) == [(1,), (3,), (1,)]
    assert rows(df, sc.route("bad", F.lit(None).cast("boolean"))) == [("senior",), ("standard",), ("standard",)]


def test_coverage_counts_only_what_was_needed(spark):
    df = spark.createDataFrame(
        [(["a", "b"], ["b"]), ([], ["x"]), (["a"], []), (["a"], ["a", "b"])], "need array<string>, got array<string>"
    )
    share = sc.coverage("need", "got")
    assert rows(df, share, sc.coverage_score(share)) == [(0.5, 2), (1.0, 3), (0.0, 1), (1.0, 3)]


def test_bands_at_their_edges(spark):
    df = spark.createDataFrame([(d,) for d in (3, 4, 5, 6, 7, 8, 10, 11, None)], "d int")
    assert [r[0] for r in rows(df, sc.entitlement("d", "delay"))] == [
        None, "voucher", "voucher", "voucher", "voucher", "full refund", "full refund", "full refund", None,
    ]
    assert [r[0] for r in rows(df, sc.entitlement("d", "return"))][-3:] == ["refund or replacement", "case by case", None]
    assert [r[0] for r in rows(df, sc.entitlement("d", "reversal"))][2:4] == ["automatic reversal", "manual investigation"]


def test_business_days(spark):
    df = spark.sql(
        "select a, b from (select explode(sequence(date'2024-02-25', date'2024-03-08')) a),"
        " (select explode(sequence(date'1969-12-20', date'1970-01-12')) b union all"
        "  select explode(sequence(date'2024-02-20', date'2024-04-10')) b)"
    )
    one = dt.timedelta(1)
    for a, b, n in rows(df, "a", "b", sc.business_days("a", "b")):
        assert n == (int(np.busday_count(a + one, b + one)) if b > a else 0)


def test_audit(spark):
    cases = [
        ("I want a refund for SNX-100", "A refund for SNX-100 comes within 7 days.", (3, 3, 3, 3, 6)),
        ("I want a refund for SNX-100", "A refund for SNX-200 comes within 7 days.", (1, 2, 1, 3, 4)),
        ("I want a refund", "A refund comes within 9 days.", (3, 3, 1, 3, 4)),
        ("I want a refund", "We have heard you.", (3, 1, 2, 2, 4)),
        ("Hello", "Please share your order number.", (3, 3, 3, 3, 6)),
        ("Hello", "Tell your attorney.", (3, 3, 1, 2, 3)),
    ]
    df = spark.createDataFrame([c[:2] for c in cases], "source string, reply string")
    criteria = [
        "information_extraction_score", "field_coverage_score", "issue_addressal_score", "resolution_clarity_score",
        "overall_score",
    ]
    assert rows(audit(df, "source", "reply"), *criteria) == [c[2] for c in cases]


def test_a_policy_without_bands_grants_nothing(spark):
    df = spark.createDataFrame([(3,)], "d int")
    assert df.select(sc.entitlement("d", "unlisted").alias("e")).first().e is None
