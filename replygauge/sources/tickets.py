"""Readers for ticket and consolidated CSV files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.sql.utils import AnalysisException

from replygauge.functions import lexicon as lx

TICKET_COLUMNS = ["support_ticket_id", "support_ticket_desc"]
CORRUPT = "_corrupt_row"


def text_schema(columns: Sequence[str]) -> StructType:
    return StructType([StructField(name, StringType()) for name in columns])


def csv_options(multi_line: bool = True) -> dict[str, object]:
    """Quoted CSV with a header that must match the schema by name.

    A byte order mark is dropped by the reader. ``multi_line`` is needed for
    quoted line breaks and makes each file one task, so split large inputs into
    many files, or turn it off where no field holds a line break.
    """
    return {
        "header": True,
        "multiLine": multi_line,
        "escape": '"',
        "enforceSchema": False,
        "encoding": "UTF-8",
    }


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    columns: Sequence[str],
    *,
    multi_line: bool = True,
    keep_corrupt: bool = False,
) -> DataFrame:
    """All-string read. A wrong header fails the first action that reads the file.

    With ``keep_corrupt`` the header of every file is checked at once, and rows that are too short or too long also carry their
    raw text in ``_corrupt_row``; without it a short row has nulls at its end.
    """
    names = [*columns, CORRUPT] if keep_corrupt else columns
    reader = spark.read.options(**csv_options(multi_line)).schema(text_schema(names))
    if keep_corrupt:
        # The extra column is not part of the header, so names are checked apart.
        _require_header(spark, path, columns)
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT).option("enforceSchema", True)
    return reader.csv(path)


def _require_header(spark: SparkSession, path: str | list[str], columns: Sequence[str]) -> None:
    """Every file must begin with the header; one job over the first split of each file."""
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"),
        F.monotonically_increasing_id().alias("line"),
    )
    heads = lines.where("at = 0").groupBy("file").agg(F.min_by("value", "line").alias("head"))
    plain = F.translate("head", '"\r\ufeff', "")
    wrong = heads.where(plain != ",".join(columns)).orderBy("file").first()
    if wrong is not None:
        raise ValueError(f"expected the columns {list(columns)} in {wrong['file']}, found {wrong['head']!r}")


def read_tickets(spark: SparkSession, path: str | list[str], **options) -> DataFrame:
    return read_csv(spark, path, TICKET_COLUMNS, **options)


def read_consolidated(spark: SparkSession, path: str | list[str], **options) -> DataFrame:
    return read_csv(spark, path, lx.CONSOLIDATED_COLUMNS, **options)


def ingest_tickets(spark: SparkSession, path: str | list[str], table_path: str, min_rows: int = 1) -> DataFrame:
    """Parse the CSV once into Parquet, which later scans can split and prune."""
    read_tickets(spark, path).write.mode("errorifexists").parquet(table_path)
    return require_rows(spark.read.parquet(table_path), min_rows)


def require_rows(df: DataFrame, min_rows: int = 1) -> DataFrame:
    """Fail on too few rows instead of passing an empty table on."""
    if min_rows <= 1:
        found = int(not df.isEmpty())
    else:
        found = df.select(F.count(F.lit(1))).first()[0]
    if found < min_rows:
        raise ValueError(f"expected at least {min_rows} rows, found {found}")
    return df


def read_if_present(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet table, or an empty one where nothing has been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
