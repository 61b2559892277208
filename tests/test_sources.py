from __future__ import annotations

import pytest
from pyspark.errors import PySparkException

from replygauge.functions import lexicon as lx
from replygauge.session import work_folder
from replygauge.sources import prompts, sinks, tickets
from replygauge.sources.tables import SPREAD, dealt, small_table, spread

HEADER = "support_ticket_id,support_ticket_desc\r\n"
BOM = "﻿"


@pytest.fixture
def csv(tmp_path):
    def write(text, name="in.csv"):
        path = tmp_path / name
        path.write_bytes(text.encode())
        return str(path)

    return write


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("start", [BOM, ""])
def test_mark_quotes_and_line_breaks(spark, csv, start):
    path = csv(start + HEADER + '1,"He said ""no"", twice\nand left 😡"\r\n2,plain\r\n')
    df = tickets.read_tickets(spark, path)
    assert df.columns == tickets.TICKET_COLUMNS
    assert rows(df) == [("1", 'He said "no", twice\nand left 😡'), ("2", "plain")]


def test_wrong_header_fails(spark, csv):
    with pytest.raises(Exception, match="CSV header does not conform to the schema"):
        tickets.read_tickets(spark, csv("id,text\n1,a\n")).collect()
    with pytest.raises(ValueError, match="expected the columns"):
        tickets.read_tickets(spark, csv("id,text\n1,a\n"), keep_corrupt=True)


def test_short_and_long_rows(spark, csv):
    path = csv(HEADER + "1,a\r\n2\r\n3,b,c\r\n")
    assert ("2", None) in rows(tickets.read_tickets(spark, path))
    kept = {r.support_ticket_id: r for r in tickets.read_tickets(spark, path, keep_corrupt=True).collect()}
    assert kept["1"]._corrupt_row is None
    assert kept["2"]._corrupt_row is not None
    assert kept["3"]._corrupt_row is not None


@pytest.mark.parametrize("text", ["", HEADER])
def test_a_file_without_rows_fails(spark, csv, text):
    with pytest.raises((ValueError, PySparkException)):
        tickets.require_rows(tickets.read_tickets(spark, csv(text)))


def test_missing_path_fails(spark, tmp_path):
    with pytest.raises(PySparkException, match="PATH_NOT_FOUND"):
        tickets.read_tickets(spark, str(tmp_path / "none.csv"))


def test_require_rows(spark):
    df = spark.range(3)
    assert tickets.require_rows(df, 3) is df
    with pytest.raises(ValueError, match="at least 4 rows, found 3"):
        tickets.require_rows(df, 4)


def test_ingest(spark, csv, tmp_path):
    df = tickets.ingest_tickets(spark, csv(BOM + HEADER + "1,a\r\n"), str(tmp_path / "t"))
    assert rows(df) == [("1", "a")]


@pytest.mark.parametrize("single_file", [True, False])
def test_consolidated_export_keeps_every_character(spark, tmp_path, single_file):
    names = lx.CONSOLIDATED_COLUMNS
    values = [" lead", "trail ", 'quote "x"', "line\n\nbreak", "comma, x", "\ttab", "3", "back\\slash", "é😡", "a", "b", "c", "6", "z"]
    df = spark.createDataFrame([tuple(values)] * 3, ", ".join(f"{n} string" for n in names))
    path = str(tmp_path / "out")
    sinks.write_csv(df.repartition(3), path, single_file=single_file)
    assert rows(tickets.read_consolidated(spark, path)) == [tuple(values)] * 3
    with pytest.raises(PySparkException):
        sinks.write_csv(df, path)


def test_queue_and_statistics_are_partitioned_by_run_date(spark, tmp_path):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, q boolean")
    for day in ("2024-01-01", "2024-01-02"):
        sinks.write_review_queue(df, "q", str(tmp_path / "q"), day)
        sinks.write_statistics(df, str(tmp_path / "s"), day)
    assert spark.read.parquet(str(tmp_path / "q")).where("run_date = '2024-01-01'").count() == 1
    assert spark.read.parquet(str(tmp_path / "s")).count() == 6


WRITER = """Intro
1. Refund Policy
- A refund within 10 days
  of delivery
- Paid in 5 to 7 business days

2. Delay Policy
- A voucher of Rs 100 after 3 days

HOW TO WRITE
- not a clause
"""


def test_prompts_and_clauses(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes((WRITER + " \n\n").encode())
    (tmp_path / "b.txt").write_text("a triage\nanalyst\t\n")
    (tmp_path / "c.md").write_text("ignored")
    loaded = prompts.load_prompts(spark, str(tmp_path))
    found = {r.prompt: r for r in loaded.collect()}
    assert set(found) == {"a", "b"}
    assert found["b"].text == "a triage\nanalyst"
    assert (found["a"].stage, found["b"].stage) == ("unknown", "summarise")
    assert found["a"].text == WRITER.rstrip()
    assert len(found["a"].version) == 64
    clauses = prompts.policy_clauses(loaded, "prompt", "text")
    assert rows(clauses) == [
        ("a", 1, 1, "A refund within 10 days of delivery"),
        ("a", 1, 2, "Paid in 5 to 7 business days"),
        ("a", 2, 1, "A voucher of Rs 100 after 3 days"),
    ]
    facts = clauses.select(prompts.clause_facts("clause").alias("f"))
    assert sorted(sum((r.f for r in facts.collect()), [])) == ["10 day", "3 day", "5-7 business day", "rs 100"]


def test_work_folder_lies_in_the_shared_folder_of_the_session(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = work_folder(spark, "x"), work_folder(spark, "x")
    assert first.startswith(shared)
    assert first != second


def test_spread_follows_its_setting_alone(spark):
    one = spark.range(10).coalesce(1)
    assert spread(one).rdd.getNumPartitions() == 4
    tasks = spark.conf.get(SPREAD)
    spark.conf.unset(SPREAD)
    try:
        assert spread(one) is one
    finally:
        spark.conf.set(SPREAD, tasks)


def test_rows_of_one_row_group_are_dealt_out_over_all_cores(spark, tmp_path):
    spark.range(2000).coalesce(1).write.parquet(str(tmp_path / "one"))
    one = spark.read.parquet(str(tmp_path / "one"))
    tasks = spark.conf.get(SPREAD)
    spark.conf.unset(SPREAD)
    try:
        rows = [len(part) for part in dealt(one).rdd.glom().collect()]
    finally:
        spark.conf.set(SPREAD, tasks)
    assert sum(rows) == 2000 and len(rows) >= spark.sparkContext.defaultParallelism
    assert max(rows) <= 2 * 2000 / len(rows)


def test_swapped_columns_in_any_file_are_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"\xef\xbb\xbfsupport_ticket_id,support_ticket_desc\r\n1,x\r\n")
    assert tickets.read_tickets(spark, str(tmp_path), keep_corrupt=True).count() == 1
    (tmp_path / "b.csv").write_text("support_ticket_desc,support_ticket_id\ny,2\n")
    with pytest.raises(ValueError, match="b.csv"):
        tickets.read_tickets(spark, str(tmp_path), keep_corrupt=True)


def test_a_rerun_of_a_date_replaces_its_rows(spark, tmp_path):
    df = spark.createDataFrame([(1, True), (2, True)], "id int, q boolean")
    for part in (df, df, df.limit(1)):
        sinks.write_review_queue(part, "q", str(tmp_path / "q"), "2024-01-01")
        sinks.write_review_queue(df, "q", str(tmp_path / "q"), "2024-01-02")
    assert spark.read.parquet(str(tmp_path / "q")).groupBy("run_date").count().orderBy("run_date").select("count").collect() == [(1,), (2,)]


def test_small_table(spark):
    df = small_table(spark, ["a", "b"], [("x", 1), ("y", None)])
    assert rows(df.na.fill(0)) == [("x", 1), ("y", 0)]
    assert "LocalTableScan" in df._jdf.queryExecution().executedPlan().toString()
