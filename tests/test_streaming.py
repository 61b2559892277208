from __future__ import annotations

from pyspark.sql import functions as F

from replygauge.streaming.ingest import ingest_new, run_to_end
from replygauge.streaming.weekly import weekly_stream

HEADER = "support_ticket_id,support_ticket_desc\n"


def test_only_new_files_are_ingested(spark, tmp_path):
    source, sink, checkpoint = (str(tmp_path / n) for n in ("in", "sink", "check"))
    (tmp_path / "in").mkdir()

    def run():
        ingest_new(spark, source, sink, checkpoint)
        return sorted(r.support_ticket_id for r in spark.read.parquet(sink).collect())

    (tmp_path / "in" / "a.csv").write_text(HEADER + '1,"a\nb"\n')
    assert run() == ["1"]
    (tmp_path / "in" / "b.csv").write_text("﻿" + HEADER + "2,c\n")
    assert run() == ["1", "2"]
    assert run() == ["1", "2"]


def test_a_backlog_is_taken_in_steps(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for i in range(3):
        (tmp_path / "in" / f"{i}.csv").write_text(HEADER + f"{i},x\n")
    sink = tmp_path / "sink"
    ingest_new(spark, str(tmp_path / "in"), str(sink), str(tmp_path / "check"), max_files=1)
    assert sorted(p.name for p in sink.iterdir() if p.name.startswith("batch=")) == ["batch=0", "batch=1", "batch=2"]
    assert spark.read.parquet(str(sink)).count() == 3


def test_weeks_in_append_and_complete_mode(spark, tmp_path):
    days = ["2024-01-01", "2024-01-07", "2024-01-08", "2024-01-22", "2024-02-12"]
    events = spark.createDataFrame([(d, 1.0) for d in days], "d string, v double").select(
        F.col("d").cast("timestamp_ntz").alias("ts"), "v"
    )
    events.write.parquet(str(tmp_path / "events"))

    def run(mode):
        stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "events"))
        run_to_end(
            weekly_stream(stream, "ts", F.col("v")), str(tmp_path / mode), str(tmp_path / f"{mode}_check"), mode
        )
        return {str(r.week): r.n for r in spark.read.parquet(str(tmp_path / mode)).collect()}

    everything = {"2024-01-01": 2, "2024-01-08": 1, "2024-01-22": 1, "2024-02-12": 1}
    assert run("complete") == everything
    closed = run("append")
    assert "2024-02-12" not in closed
    assert closed.items() <= everything.items()
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        assert {str(r.week): r.n for r in weekly_stream(events, "ts", F.col("v")).collect()} == everything
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    batch = {str(r.week): r.n for r in weekly_stream(events, "ts", F.col("v")).collect()}
    assert batch == everything
