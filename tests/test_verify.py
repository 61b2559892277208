from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from replygauge.functions import lexicon as lx
from replygauge.operators.verify import Spec, always_blank, first_offenders, missing_columns, verdict, verify

NAMES = lx.CONSOLIDATED_COLUMNS


def clean_rows(n=5):
    row = {name: "text" for name in NAMES} | {name: "3" for name in lx.SCORE_RANGES} | {"overall_score": "6"}
    return [row | {"support_ticket_id": str(i)} for i in range(1, n + 1)]


def table(spark, rows, names=NAMES):
    return spark.createDataFrame([tuple(r[c] for c in names) for r in rows], ", ".join(f"{c} string" for c in names))


def tripped(report):
    return {r.check: (r.n_bad, r.sample_ids) for r in report.collect() if not r.ok}


def changed(column, value, row=2):
    rows = clean_rows()
    rows[row][column] = value
    return rows


def test_a_clean_table_passes(spark):
    report = verify(table(spark, clean_rows()), 5)
    assert tripped(report) == {}
    assert verdict(report).first().asDict() == {"ok": True, "failed_checks": 0, "notes": 0}
    assert {r.severity for r in report.collect()} == {"fail", "note"}


CORRUPTIONS = {
    "blank text": (("overall_reasoning", " \n"), {"blank_cell:overall_reasoning"}),
    "null text": (("summarisation", None), {"blank_cell:summarisation"}),
    "blank score": (("field_coverage_score", ""), {"blank_cell:field_coverage_score", "range:field_coverage_score"}),
    "not a number": (("information_extraction_score", "abc"), {"range:information_extraction_score"}),
    "too low": (("information_extraction_score", "0"), {"range:information_extraction_score"}),
    "too high": (("information_extraction_score", "4"), {"range:information_extraction_score"}),
    "nan": (("information_extraction_score", "nan"), {"range:information_extraction_score"}),
    "float suffix": (("information_extraction_score", "3f"), {"range:information_extraction_score"}),
    "part too low": (("issue_addressal_score", "0"), {"range:issue_addressal_score", "sum:overall_score"}),
    "part too high": (("issue_addressal_score", "4"), {"range:issue_addressal_score", "sum:overall_score"}),
    "part not a number": (("issue_addressal_score", "abc"), {"range:issue_addressal_score"}),
    "wrong sum": (("overall_score", "5"), {"sum:overall_score"}),
}


@pytest.mark.parametrize("name", CORRUPTIONS)
def test_one_corruption_trips_exactly_its_checks(spark, name):
    (column, value), checks = CORRUPTIONS[name]
    report = verify(table(spark, changed(column, value)), 5)
    assert tripped(report) == {check: (1, ["3"]) for check in checks}
    assert verdict(report).first().ok is False


def test_row_count(spark):
    assert tripped(verify(table(spark, clean_rows(4)), 5)) == {"row_count": (1, [])}
    assert tripped(verify(table(spark, clean_rows(7)), 5)) == {"row_count": (2, [])}


def test_no_rows_is_the_only_finding(spark):
    report = verify(table(spark, []), 5)
    assert [(r.check, r.ok) for r in report.collect()] == [("no_rows", False)]
    assert verdict(report).first().ok is False


def test_missing_column_is_named(spark):
    names = [c for c in NAMES if c != "field_coverage_score"]
    report = verify(table(spark, clean_rows(), names), 5)
    assert tripped(report) == {"missing_columns": (1, [])}
    assert report.where("check = 'missing_columns'").first().detail == "field_coverage_score"
    assert missing_columns(table(spark, clean_rows(), names), NAMES) == ["field_coverage_score"]


def test_missing_id_column_is_reported_and_rows_numbered(spark):
    names = [c for c in NAMES if c != "support_ticket_id"]
    got = tripped(verify(table(spark, changed("overall_score", "5"), names), 5))
    assert got["missing_columns"] == (1, [])
    assert got["sum:overall_score"][0] == 1
    assert len(got["sum:overall_score"][1]) == 1


def test_a_column_blank_everywhere_is_reported_once(spark):
    rows = [r | {"field_coverage_score": " "} for r in clean_rows()]
    report = verify(table(spark, rows), 5)
    assert tripped(report) == {"blank_columns": (1, [])}
    assert report.where("check = 'blank_columns'").first().detail == "field_coverage_score"
    assert [r.column for r in always_blank(table(spark, rows)).collect()] == ["field_coverage_score"]


def test_a_blank_part_voids_the_sum_check(spark):
    rows = [r | {"issue_addressal_score": ""} for r in clean_rows()]
    assert "sum:overall_score" not in [r.check for r in verify(table(spark, rows), 5).collect()]


def test_blank_columns_nobody_asked_for_count_too(spark):
    df = table(spark, clean_rows()).withColumn("extra", F.lit(""))
    assert tripped(verify(df, 5)) == {"blank_columns": (1, [])}


def test_marker_is_a_note(spark):
    report = verify(table(spark, changed("response_generation", "x [MOCK REPLY]")), 5)
    assert tripped(report) == {}
    assert verdict(report).first().asDict() == {"ok": True, "failed_checks": 0, "notes": 1}


def test_samples_are_bounded_and_ordered(spark):
    rows = [r | {"overall_score": "5"} for r in clean_rows(30)]
    (n_bad, sample), = tripped(verify(table(spark, rows), 30, Spec(sample_size=4))).values()
    assert (n_bad, sample) == (30, ["1", "10", "11", "12"])


def test_sample_rank_limits_rows_before_the_shuffle(spark):
    offences = spark.range(1000).selectExpr("if(id % 2 = 0, 'even', 'odd') as check", "id as k")
    sample = first_offenders(offences, "check", "k", 3)
    assert {r.check: r.sample_ids for r in sample.collect()} == {"even": [0, 2, 4], "odd": [1, 3, 5]}
    plan = sample._jdf.queryExecution().executedPlan().toString()
    final, partial = plan.index("row_number(), 3, Final"), plan.index("row_number(), 3, Partial")
    assert "Exchange hashpartitioning(check" in plan[final:partial]
