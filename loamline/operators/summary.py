"""Wide site summaries: one column per measure and depth, per day or per hour."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loamline.config import MOISTURE, Settings
from loamline.functions import civil_date, hour_start, row_mean
from loamline.operators.counts import first_known

# Prefixes of the wide columns.
PREFIX = {"Moisture": "moisture", "Temperature": "temp", "Salinity": "salinity"}
SITE = ("site_name", "site_id")
TEXTURE_DEPTH_CM = 10


def wide_column(measure: str, depth: int) -> str:
    return f"{PREFIX[measure]}_{depth}cm"


def wide_columns(settings: Settings) -> list[str]:
    return [wide_column(m, d) for m in settings.ranges for d in settings.depths]


def _is_instant(df: DataFrame, name: str) -> bool:
    return dict(df.dtypes)[name] == "timestamp"


def as_instant(df: DataFrame, name: str) -> Column:
    """The column as a TIMESTAMP; a TIMESTAMP_NTZ holds UTC."""
    t = F.col(name)
    if _is_instant(df, name):
        return t
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), t).cast("timestamp")


def day_of(silver: DataFrame, settings: Settings) -> Column:
    return civil_date(F.col("event_time"), settings.timezone, _is_instant(silver, "event_time"))


def hour_of(silver: DataFrame, settings: Settings) -> Column:
    return hour_start(F.col("event_time"), settings.timezone, _is_instant(silver, "event_time"))


def depth_means(settings: Settings) -> list[Column]:
    """Mean value of each measure at each depth, as conditional aggregates for one grouping."""
    return [
        F.expr(f"avg(CASE WHEN measure_type = '{m}' AND depth_cm = {d} THEN soil_value END)").alias(
            wide_column(m, d)
        )
        for m in settings.ranges
        for d in settings.depths
    ]


def moisture_averages(wide: DataFrame, settings: Settings) -> DataFrame:
    """Shallow and deep moisture: means over the depth columns that have a value."""
    shallow = [F.col(wide_column(MOISTURE, d)) for d in settings.shallow]
    deep = [F.col(wide_column(MOISTURE, d)) for d in settings.deep]
    return wide.withColumns(
        {"avg_moisture_shallow": row_mean(*shallow), "avg_moisture_deep": row_mean(*deep)}
    )


def summarize(
    silver: DataFrame, period: Column, name: str, settings: Settings, texture: bool = False
) -> DataFrame:
    """Site summary per ``period``, for the periods in which the site has a moisture reading.

    All measures are pivoted by one aggregation over one scan: no join between measures, one
    shuffle, and map-side partial means, so a hot site or day never meets in one task.

    With ``texture`` the same scan also finds each site's first known texture (as
    :func:`texture_lookup` does). Readings are first grouped by texture too, with sums and counts;
    the few rows that leaves are added up per period, and a window over a site's periods finds the
    earliest texture, before periods without moisture go.
    """
    moisture = F.count_if(F.col("measure_type") == MOISTURE)
    if not texture:
        wide = (
            silver.withColumn(name, period)
            .groupBy(*SITE, name)
            .agg(*depth_means(settings), moisture.alias("_moisture_rows"))
            .filter("_moisture_rows > 0")
            .drop("_moisture_rows")
        )
        return moisture_averages(wide, settings)

    cells = wide_columns(settings)
    parts = [
        F.expr(f"{fn}(CASE WHEN measure_type = '{m}' AND depth_cm = {d} THEN soil_value END)").alias(
            f"_{fn}_{wide_column(m, d)}"
        )
        for fn in ("sum", "count")
        for m in settings.ranges
        for d in settings.depths
    ]
    at_depth = (F.col("depth_cm") == TEXTURE_DEPTH_CM) & F.col("soil_texture").isNotNull()
    by_texture = (
        silver.withColumn(name, period)
        .groupBy(*SITE, name, "soil_texture")
        .agg(
            *parts,
            moisture.alias("_moisture_rows"),
            F.min(F.when(at_depth, F.col("event_time"))).alias("_since"),
        )
    )
    first = F.struct(F.col("_since"), F.col("soil_texture"))
    by_period = by_texture.groupBy(*SITE, name).agg(
        *[(F.sum(f"_sum_{c}") / F.nullif(F.sum(f"_count_{c}"), F.lit(0))).alias(c) for c in cells],
        F.sum("_moisture_rows").alias("_moisture_rows"),
        F.min(F.when(F.col("_since").isNotNull(), first)).alias("_first"),
    )
    wide = (
        by_period.withColumn("_first", F.min("_first").over(Window.partitionBy(*SITE)))
        .filter("_moisture_rows > 0")
        .withColumn("soil_texture", F.col("_first.soil_texture"))
        .drop("_moisture_rows", "_first")
    )
    return moisture_averages(wide, settings)


def texture_lookup(silver: DataFrame, at_depth_cm: int = TEXTURE_DEPTH_CM) -> DataFrame:
    """Each site's first known texture at one depth: earliest in time, then by name."""
    at_depth = silver.filter(F.col("depth_cm") == at_depth_cm)
    return first_known(at_depth, SITE, "soil_texture", "event_time")
