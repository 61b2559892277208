"""Parquet tables of one data folder."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Session setting of ``spread``.
SPREAD = "spark.replygauge.spreadTasks"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows out over a number of tasks the caller has set; as they are without the setting.

    A scan can not be split below a row group, so text work on a small table may
    use few cores. ``spark.replygauge.spreadTasks`` is set by ``local_session``; on
    a cluster it is left out, and no plan holds this exchange.
    """
    tasks = df.sparkSession.conf.get(SPREAD, None)
    return df.repartition(int(tasks)) if tasks else df


def dealt(df: DataFrame) -> DataFrame:
    """Deal the rows out evenly, whatever the row groups of the files; for passes that are bound by the processor.

    A file of one row group is one task, however many cores wait. The rows are shuffled once, which is little next to
    such a pass: into four tasks a core, the session's number of shuffle partitions or the scan's own, whichever is most.
    """
    spark = df.sparkSession
    if spark.conf.get(SPREAD, None):
        return spread(df)
    own = df.rdd.getNumPartitions()
    return df.repartition(max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")), own))


def small_table(spark: SparkSession, columns: Sequence[str], rows: Sequence[tuple]) -> DataFrame:
    """A lookup table given in code. Its exact size is known to the planner."""
    return spark.createDataFrame(pa.Table.from_pylist([dict(zip(columns, row, strict=True)) for row in rows]))
