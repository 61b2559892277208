"""Session defaults and the shared working folder."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def local_session(
    cores: int | str = "*", app: str = "replygauge", extra: Mapping[str, str] | None = None
) -> SparkSession:
    """A local session for tests and benchmarks. On a cluster, bring your own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.replygauge.spreadTasks", "8" if cores == "*" else str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config(map=dict(extra or {}))
        .getOrCreate()
    )


def work_root(spark: SparkSession) -> str:
    """Where tables that a job writes and reads again lie.

    The shared ``spark.checkpoint.dir`` of the session; where it is unset, a folder
    below ``spark.sql.warehouse.dir``, which a cluster puts on shared storage too.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    if warehouse.startswith("file:") and not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"{warehouse} lies on each machine alone; set spark.checkpoint.dir to shared storage")
    return f"{warehouse.rstrip('/')}/replygauge_work"


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below ``work_root``."""
    return f"{work_root(spark)}/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The frame as a table below ``work_root``, read again, so that its expressions are planned once and copied nowhere."""
    path = work_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_work(spark: SparkSession) -> bool:
    """Delete the default work root once no result is needed any more; a folder the session names is left to its owner."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(work_root(spark))
    if root.getName() != "replygauge_work":
        return False
    return root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(root, True)
