"""Reports over the daily gold table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamline.config import MOISTURE, Settings
from loamline.operators.counts import latest_rows
from loamline.operators.series import day_changes
from loamline.operators.summary import SITE, day_of

STATUS = (
    *SITE,
    "date",
    "avg_moisture_shallow",
    "avg_moisture_deep",
    "rainfall_mm",
    "irrigation_needed",
)


def latest_day(silver: DataFrame, settings: Settings) -> DataFrame:
    """Last summary day, read from silver: one row, no shuffle of readings."""
    moisture = silver.filter(F.col("measure_type") == MOISTURE)
    return moisture.agg(F.max(day_of(silver, settings)).alias("date"))


def on_latest_day(gold: DataFrame, latest: DataFrame | None = None) -> DataFrame:
    """Gold rows of the last day. The day is a scalar subquery, so the filter on it moves below
    gold's aggregation when gold is computed on the fly, and into the scan when it is stored."""
    day = (gold if latest is None else latest).agg(F.max("date"))
    return gold.filter(F.col("date") == day.scalar())


def irrigation_status(gold: DataFrame, latest: DataFrame | None = None) -> DataFrame:
    """All sites on the latest day, driest first, sites without a shallow average last."""
    return (
        on_latest_day(gold, latest)
        .select(*STATUS)
        .orderBy(F.asc_nulls_last("avg_moisture_shallow"), "site_id", "site_name")
    )


def driest_sites(gold: DataFrame, n: int = 5, latest: DataFrame | None = None) -> DataFrame:
    known = on_latest_day(gold, latest).filter("avg_moisture_shallow IS NOT NULL")
    order = [F.asc("avg_moisture_shallow"), F.asc("site_id"), F.asc("site_name")]
    return latest_rows(known.select(*SITE, "avg_moisture_shallow"), order, n)


def moisture_trend(
    gold: DataFrame, settings: Settings, n: int = 5, latest: DataFrame | None = None
) -> DataFrame:
    """Daily shallow moisture of the n driest sites, with the threshold to compare it to."""
    # n rows by definition of the report, hence safe to broadcast
    sites = F.broadcast(driest_sites(gold, n, latest).select(*SITE))
    return site_series(gold.join(sites, list(SITE), "left_semi"), settings).drop("rainfall_mm")


def site_series(gold: DataFrame, settings: Settings, site_name: str | None = None) -> DataFrame:
    """Moisture and rain per day with the threshold, for one site or for all."""
    rows = gold if site_name is None else gold.filter(F.col("site_name") == site_name)
    return rows.select(
        *SITE,
        "date",
        "avg_moisture_shallow",
        "rainfall_mm",
        F.lit(settings.irrigate_below).alias("threshold"),
    ).orderBy("site_id", "site_name", "date")


def irrigation_listing(gold: DataFrame) -> DataFrame:
    return gold.filter("irrigation_needed").select(
        *SITE, "date", "avg_moisture_shallow", "rainfall_mm"
    )


def irrigation_days(gold: DataFrame) -> DataFrame:
    return gold.groupBy(*SITE).agg(
        F.count_if("irrigation_needed").alias("irrigation_days"), F.count("*").alias("days")
    )


def rain_response(gold: DataFrame, more_than_mm: float = 5.0) -> DataFrame:
    """Moisture change on the days that follow significant rain."""
    changes = day_changes(gold.select(*SITE, "date", "avg_moisture_shallow", "rainfall_mm"))
    return changes.filter(F.col("prev_rainfall") > more_than_mm).select(
        *SITE, "date", "prev_rainfall", "avg_moisture_shallow", "moisture_change"
    )
