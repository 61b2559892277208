"""Writers: consolidated table, review queue, quality statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_CSV = {
    "header": True,
    "escape": '"',
    # The writer trims every string unless both are off.
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def write_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), mode: str = "errorifexists") -> None:
    """Columnar write, the primary sink at any size."""
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def write_csv(df: DataFrame, path: str, *, single_file: bool = False, mode: str = "errorifexists") -> None:
    """CSV export, in parallel by default.

    ``single_file`` pulls all rows through one task; it is for hand-over files of
    a size one person can open, never for a whole large table.
    """
    (df.coalesce(1) if single_file else df).write.mode(mode).options(**_CSV).csv(path)


def _write_run(df: DataFrame, path: str, run_date: str) -> None:
    """One folder per run date, replaced as a whole: a rerun of a date leaves its own rows, also if it has none."""
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/run_date={run_date}")


def write_review_queue(df: DataFrame, in_queue: str, path: str, run_date: str) -> None:
    """Only the rows that need a person, in a folder per run date."""
    _write_run(df.where(F.col(in_queue)), path, run_date)


def write_statistics(stats: DataFrame, path: str, run_date: str) -> None:
    _write_run(stats, path, run_date)
