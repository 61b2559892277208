"""Every registered query against its SQL counterpart, and the shape of its plan."""

from __future__ import annotations

import re

import pytest

import check_queries
from __spark_entry__ import entry, oracle_sql
from replygauge.plans import catalog

FOLDER = "/root/testdata/sf0.001"
WRITING = {
    "model_stage", "model_pipeline", "verify_report", "verify_verdict", "consolidated_roundtrip", "review_queue", "escalated_in_queue",
    "quality_statistics", "stage_join", "csv_roundtrip", "stream_ingest", "stream_weekly",
}


@pytest.fixture(scope="module")
def db():
    return check_queries.connect(FOLDER)


@pytest.mark.parametrize("name", catalog.QUERIES)
def test_query_equals_its_sql(spark, db, name):
    assert check_queries.compare(spark, db, FOLDER, name) is None


def test_every_query_has_sql():
    assert set(oracle_sql()) >= set(catalog.QUERIES) == set(catalog.ORACLES)


def test_entry(spark):
    assert entry(spark).count() == 1


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - WRITING))
def test_plan_has_no_cross_join_and_no_row_python(spark, name):
    plan = catalog.QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython|ArrowEvalPython", plan)


@pytest.mark.parametrize("name, columns", [
    ("text_profile", "struct<doc_id:bigint,text:string,lang:string>"),
    ("weekly_scores", "struct<ts:timestamp_ntz,event_type:string,value:double>"),
    ("stage_loss", "struct<conv_id:bigint,turn:bigint,role:string>"),
    ("policy_bands", "struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>"),
])
def test_scans_read_only_what_is_needed(spark, name, columns):
    plan = catalog.QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert f"ReadSchema: {columns}" in plan


def test_role_filters_reach_the_scan(spark):
    plan = catalog.QUERIES["invented_refs"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(role,user)" in plan and "EqualTo(role,assistant)" in plan


@pytest.mark.parametrize("name", ["audit_scores", "invented_refs"])
def test_one_exchange_for_each_side_of_the_pair_join(spark, name):
    tasks = spark.conf.get("spark.replygauge.spreadTasks")
    spark.conf.unset("spark.replygauge.spreadTasks")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = catalog.QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.replygauge.spreadTasks", tasks)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(re.findall(r"Exchange (?:hash|Round)", plan)) == 2
