"""Incremental ingest of new ticket files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from replygauge.sources.tickets import TICKET_COLUMNS, csv_options, text_schema

#: Files that one micro-batch takes at most.
MAX_FILES = 1000


def ingest_new(
    spark: SparkSession, folder: str, sink: str, checkpoint: str, max_files: int = MAX_FILES
) -> None:
    """Write the tickets of all files not seen before, then stop.

    Each micro-batch owns one folder and overwrites it, so a batch repeated after
    a failure leaves the same rows. Every sink needs a checkpoint of its own.
    ``max_files`` bounds a batch, so that a long backlog is taken in steps.
    """
    reader = spark.readStream.options(**csv_options()).schema(text_schema(TICKET_COLUMNS))
    run_to_end(reader.option("maxFilesPerTrigger", max_files).csv(folder), sink, checkpoint)


def run_to_end(stream: DataFrame, sink: str, checkpoint: str, output_mode: str = "append") -> None:
    def write(batch: DataFrame, batch_id: int) -> None:
        # One folder per batch; in complete mode every batch replaces the whole result.
        folder = sink if output_mode == "complete" else f"{sink}/batch={batch_id}"
        batch.write.mode("overwrite").parquet(folder)

    query = (
        stream.writeStream.foreachBatch(write)
        .outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def stream_table(
    spark: SparkSession, folder: str, name: str, schema: StructType, max_files: int = MAX_FILES
) -> DataFrame:
    """A Parquet table of a data folder as a stream. It may be one file or a folder of files."""
    # A streaming source takes a folder or a pattern; this one matches a single name.
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(f"{folder.rstrip('/')}/{name}.parque[t]")
