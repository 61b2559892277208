"""What several operators of this subpackage share: work tables, hold-out split, bounded samples."""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replygauge.session import work_folder

_RATE = 1_000_000


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The frame as a Parquet table in the shared work folder, read again.

    It cuts the lineage, survives lost executors, and gives the planner true sizes.
    """
    path = work_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.written_to = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete tables made by ``written`` that nothing reads any more.

    The driver's garbage is collected too: Spark deletes the shuffle files of a finished
    write only when the driver's collector has found its plan gone.
    """
    for table in tables:
        spark = table.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table.written_to)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    if tables:
        tables[0].sparkSession.sparkContext._jvm.System.gc()


def remainder(key: str | Column, parts: int) -> Column:
    """crc32 of the key as text, modulo parts; null for a null key."""
    column = F.col(key) if isinstance(key, str) else key
    return F.pmod(F.crc32(column.cast("string").cast("binary")), F.lit(parts))


def remainder_of(key: int, parts: int) -> int:
    return zlib.crc32(str(key).encode()) % parts


def bounded_sample(rows: DataFrame, key: str, by: str, per_class: int) -> DataFrame:
    """About ``per_class`` rows of each value of ``by``, picked by a hash of the key.

    All of a class if it has no more. One narrow count, then a filter: no sort, no
    shuffle of the rows, and the same rows in every run.
    """
    counts = {r[by]: r["count"] for r in rows.groupBy(by).count().collect()}
    chance = F.pmod(F.xxhash64(F.col(key), F.lit(29)), F.lit(_RATE))
    keep = F.lit(False)
    for value, count in counts.items():
        keep = keep | ((F.col(by) == F.lit(value)) & (chance < F.lit(int(_RATE * min(1.0, per_class / count)))))
    return rows.where(keep)
