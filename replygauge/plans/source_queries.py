"""Queries that write, read and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from replygauge.plans import sql as s
from replygauge.plans.derive import tickets
from replygauge.plans.registry import query
from replygauge.session import work_folder
from replygauge.sources.sinks import write_csv
from replygauge.sources.tables import spread, table
from replygauge.sources.tickets import ingest_tickets
from replygauge.streaming.ingest import ingest_new, run_to_end, stream_table
from replygauge.streaming.weekly import weekly_stream


@query("SELECT CAST(doc_id AS VARCHAR) AS support_ticket_id, text AS support_ticket_desc FROM documents")
def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as ticket CSV, ingested again into Parquet."""
    docs = spread(table(spark, folder, "documents").select("doc_id", "text")).select(
        F.col("doc_id").cast("string").alias("support_ticket_id"), F.col("text").alias("support_ticket_desc")
    )
    path = work_folder(spark, "tickets")
    write_csv(docs, f"{path}/csv")
    return ingest_tickets(spark, f"{path}/csv", f"{path}/table")


@query(f"WITH {s.TICKETS} SELECT support_ticket_id, support_ticket_desc FROM tickets")
def stream_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Ticket files ingested as a stream, three to a batch; the second run finds nothing new."""
    path = work_folder(spark, "ingest")
    write_csv(tickets(spark, folder), f"{path}/in")
    for _ in range(2):
        ingest_new(spark, f"{path}/in", f"{path}/sink", f"{path}/checkpoint", max_files=3)
    return spark.read.parquet(f"{path}/sink").select("support_ticket_id", "support_ticket_desc")


@query("""
SELECT CAST(date_trunc('week', ts) AS DATE) AS week, count(value) AS n,
  CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) AS total FROM events GROUP BY 1""")
def stream_weekly(spark: SparkSession, folder: str) -> DataFrame:
    """Weekly totals of the events replayed as a stream, open week included."""
    path = work_folder(spark, "weekly")
    events = stream_table(spark, folder, "events", table(spark, folder, "events").schema)
    weeks = weekly_stream(events, "ts", F.col("value").cast("decimal(18,2)"))
    run_to_end(weeks, f"{path}/sink", f"{path}/checkpoint", output_mode="complete")
    return spark.read.parquet(f"{path}/sink").select("week", "n", F.col("total").cast("double").alias("total"))
