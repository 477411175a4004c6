"""Analytics over ordered series: gaps between readings and day-to-day changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def gap_counts(readings: DataFrame, by: Sequence[str], time: str = "event_time") -> DataFrame:
    """How often each gap, in seconds, occurs between consecutive readings of a series.

    A series may hold a large share of all rows, so it is never sorted in one task. Readings of one
    instant are counted together (they are gaps of zero); the other instants are ordered inside one
    hour of one series; and the first instant of an hour takes its predecessor from the series'
    hours, of which there is one row each.
    """
    by = list(by)
    hour = Window.partitionBy(*by, "_hour")
    instants = (
        readings.filter(F.col(time).isNotNull())
        .groupBy(*by, F.date_trunc("hour", time).alias("_hour"), time)
        .agg(F.count("*").alias("_n"))
        .withColumn("_before", F.lag(time).over(hour.orderBy(time)))
    )
    hours = Window.partitionBy(*by).orderBy("_hour")
    firsts = (
        instants.withColumn("_last", F.max(time).over(hour))
        .filter("_before IS NULL")
        .withColumn("_before", F.lag("_last").over(hours))
        .drop("_last")
    )
    placed = instants.filter("_before IS NOT NULL").unionByName(firsts)
    gap = F.timestamp_diff("MICROSECOND", F.col("_before"), F.col(time)) / F.lit(1e6)
    one = F.when(F.col("_before").isNotNull(), 1).otherwise(0).cast("bigint")
    counted = F.array(
        F.struct(gap.alias("gap_seconds"), one.alias("n")),
        F.struct(F.lit(0.0).alias("gap_seconds"), (F.col("_n") - 1).alias("n")),
    )
    return (
        placed.select(*by, F.inline(counted))
        .filter("n > 0")
        .groupBy(*by, "gap_seconds")
        .agg(F.sum("n").alias("n"))
    )


def day_changes(gold: DataFrame, site: Sequence[str] = ("site_name", "site_id")) -> DataFrame:
    """Shallow moisture change since, and rain on, the site's previous summary day.

    Gold holds one row per site and day, so a window holds at most a site's calendar.
    """
    days = Window.partitionBy(*site).orderBy("date")
    moisture = F.col("avg_moisture_shallow")
    return gold.withColumns(
        {
            "moisture_change": moisture - F.lag(moisture).over(days),
            "prev_rainfall": F.lag("rainfall_mm").over(days),
        }
    )
