"""Weekly means as events arrive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Windows count from a Thursday (1970-01-01); four days later is a Monday.
_MONDAY = "4 days"


def _as_utc(events: DataFrame, ts: str) -> Column:
    """Watermarks need an instant. A time without zone is read as UTC, whatever the session zone."""
    if dict(events.dtypes)[ts] == "timestamp_ntz":
        return F.concat(F.col(ts).cast("string"), F.lit("Z")).cast("timestamp")
    return F.col(ts).cast("timestamp")


def weekly_stream(events: DataFrame, ts: str, value: Column, delay: str = "7 days") -> DataFrame:
    """Count and sum per Monday week in UTC, for a stream or a batch.

    The state is one row per open week and aggregates combine map-side. Run it in
    complete mode to see the week still open, in append mode for closed weeks only.
    """
    stamped = events.select(_as_utc(events, ts).alias("ts"), value.alias("value"))
    days = (F.unix_seconds("window.start") / 86400).cast("int")
    return (
        stamped.withWatermark("ts", delay)
        .groupBy(F.window("ts", "7 days", "7 days", _MONDAY))
        .agg(F.count("value").alias("n"), F.sum("value").alias("total"))
        .select(F.date_from_unix_date(days).alias("week"), "n", "total")
    )
