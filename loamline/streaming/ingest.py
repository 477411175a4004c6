"""Streaming ingest of landed pages into the bronze table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from loamline.plans.ingest import add_soil_lines
from loamline.sources.pages import with_place


def stream_pages(
    spark: SparkSession, path: str, files_per_batch: int | None = None
) -> DataFrame:
    """Lines of landed files, all of a file in one batch."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return with_place(reader.text(path))


def ingest_pages(
    spark: SparkSession,
    landing: str,
    table: str,
    checkpoint: str,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Take in every page not seen yet, then stop; the checkpoint replaces the high-water mark.

    Each batch inserts only ids the table lacks, so pages that overlap, come late or are processed
    again after a failure change nothing. No watermark: no row is dropped for being late. What cannot
    be stored is set aside just as the batch step does.
    """

    def add(batch: DataFrame, batch_id: int) -> None:
        add_soil_lines(batch, table)

    return (
        stream_pages(spark, landing, files_per_batch)
        .writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def first_seen(rows: DataFrame, overlap: str = "2 minutes") -> DataFrame:
    """Stream without repeated ids inside the overlap, for sinks that cannot look ids up.

    State is kept for the overlap only; rows older than the watermark are not passed on.
    ``event_time`` must be a TIMESTAMP.
    """
    return rows.withWatermark("event_time", overlap).dropDuplicatesWithinWatermark(["ID"])
