"""Hourly summary kept up to date from a stream of silver readings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loamline.config import MOISTURE, Settings
from loamline.operators.summary import (
    SITE,
    TEXTURE_DEPTH_CM,
    as_instant,
    depth_means,
    moisture_averages,
)


def hourly_stream(silver: DataFrame, settings: Settings, late_by: str = "2 minutes") -> DataFrame:
    """The hourly summary without texture, as a windowed aggregation with a watermark.

    In append mode an hour is emitted once, when the watermark has passed its end; in update mode
    whenever it changes.
    """
    timed = silver.withColumn("event_time", as_instant(silver, "event_time"))
    wide = (
        timed.withWatermark("event_time", late_by)
        .groupBy(*SITE, F.window("event_time", "1 hour").alias("_window"))
        .agg(
            *depth_means(settings),
            F.count_if(F.col("measure_type") == MOISTURE).alias("_moisture_rows"),
        )
        .filter("_moisture_rows > 0")
        .withColumn("hour", F.col("_window.start"))
        .drop("_window", "_moisture_rows")
    )
    return moisture_averages(wide, settings)


def texture_stream(silver: DataFrame) -> DataFrame:
    """Each site's earliest known texture at 10 cm so far, as keyed state: one row for each site.

    There is no watermark, because a reading however late may be earlier than all before it. In
    update mode a site comes out again whenever its earliest texture changed.
    """
    timed = silver.withColumn("event_time", as_instant(silver, "event_time"))
    textured = timed.filter((F.col("depth_cm") == TEXTURE_DEPTH_CM) & F.col("soil_texture").isNotNull())
    return textured.groupBy(*SITE).agg(F.min(F.struct("event_time", "soil_texture")).alias("first"))


def write_changes(changes: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Write every row that changed, then stop.

    Each batch has a folder of its own, which a batch that runs again replaces, so a key may stand
    in several batches and the last of them counts.
    """

    def replace(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table}/batch={batch_id}")

    return (
        changes.writeStream.outputMode("update")
        .foreachBatch(replace)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def write_hours(summary: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Write every hour that changed, open ones too, then stop; :func:`latest_hours` reads the table."""
    return write_changes(summary, table, checkpoint)


def write_textures(textures: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Write every site whose earliest texture changed, then stop; :func:`latest_textures` reads them."""
    return write_changes(textures, table, checkpoint)


def latest_textures(spark: SparkSession, table: str) -> DataFrame:
    """One row for each site with its texture as of the last batch: the earliest of all batches."""
    return (
        spark.read.parquet(table)
        .groupBy(*SITE)
        .agg(F.min("first").alias("first"))
        .select(*SITE, F.col("first.soil_texture").alias("soil_texture"))
    )


def latest_hours(spark: SparkSession, table: str, textures: str | None = None) -> DataFrame:
    """The hourly table as of the last batch.

    With ``textures`` each hour gets its site's texture, all columns of the batch summary. It is joined
    when the table is read, so a texture that came late counts for the hours already written as well.
    """
    last = Window.partitionBy(*SITE, "hour").orderBy(F.desc("batch"))
    hours = (
        spark.read.parquet(table)
        .withColumn("_rank", F.row_number().over(last))
        .filter("_rank = 1")
        .drop("_rank", "batch")
    )
    if textures is None:
        return hours
    known = latest_textures(spark, textures).withColumnsRenamed({c: f"_{c}" for c in SITE})
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in SITE]
    return hours.join(known, same, "left").drop(*[f"_{c}" for c in SITE])


def keep_hourly(
    silver: DataFrame, settings: Settings, table: str, checkpoint: str, late_by: str = "2 minutes"
) -> list[StreamingQuery]:
    """Bring the hourly table at ``table`` up to date from a stream of silver readings, textures included.

    Two queries read the stream, each with a checkpoint of its own; :func:`read_hourly` gives the table.
    """
    return [
        write_hours(hourly_stream(silver, settings, late_by), f"{table}/hours", f"{checkpoint}/hours"),
        write_textures(texture_stream(silver), f"{table}/textures", f"{checkpoint}/textures"),
    ]


def read_hourly(spark: SparkSession, table: str) -> DataFrame:
    """What :func:`keep_hourly` keeps at ``table``."""
    return latest_hours(spark, f"{table}/hours", f"{table}/textures")


def late_rows(query: StreamingQuery) -> int:
    """Rows that came after the watermark and were left out, over all batches still reported."""
    return sum(
        state.get("numRowsDroppedByWatermark", 0)
        for progress in query.recentProgress
        for state in progress["stateOperators"]
    )


def append_closed_hours(summary: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Write the hours that can no longer change, then stop."""
    return (
        summary.writeStream.outputMode("append")
        .format("parquet")
        .option("path", table)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
