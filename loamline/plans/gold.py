"""Gold: daily and hourly site summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamline.config import Settings
from loamline.functions import irrigation_needed
from loamline.operators.summary import SITE, day_of, hour_of, summarize, texture_lookup


def gold_hourly(silver: DataFrame, settings: Settings) -> DataFrame:
    return summarize(silver, hour_of(silver, settings), "hour", settings, texture=True)


def with_weather(days: DataFrame, weather: DataFrame, settings: Settings) -> DataFrame:
    """Weather (one row per day) and the irrigation flag. The join carries no hint: Spark broadcasts
    the weather while its measured size allows it and sorts and merges it beyond that."""
    values = weather.select("date", "rainfall_mm", "max_temp_c", "solar_exposure_mj")
    return days.join(values, "date", "left").withColumn(
        "irrigation_needed",
        irrigation_needed(F.col("avg_moisture_shallow"), F.col("rainfall_mm"), settings),
    )


def gold_daily(silver: DataFrame, weather: DataFrame, settings: Settings) -> DataFrame:
    """Daily summary with texture, weather and the irrigation flag, from one scan of the readings."""
    days = summarize(silver, day_of(silver, settings), "date", settings, texture=True)
    return with_weather(days, weather, settings)


def touched_days(
    gold: DataFrame, silver: DataFrame, changed: DataFrame, settings: Settings
) -> DataFrame:
    """The days whose gold rows can differ: those in ``changed`` (a column ``date``), and all days of
    a site whose texture is another one now."""
    texture = texture_lookup(silver).withColumnRenamed("soil_texture", "_now")
    moved = (
        gold.select(*SITE, "date", "soil_texture")
        .join(texture, list(SITE), "left")
        .filter(~F.col("soil_texture").eqNullSafe(F.col("_now")))
    )
    return changed.select("date").unionByName(moved.select("date")).distinct()


def gold_days(
    silver: DataFrame, weather: DataFrame, days: DataFrame, settings: Settings
) -> DataFrame:
    """The daily summary of some days only: readings of other days are left out before they are
    grouped; textures still come from all readings, of which the lookup reads four columns."""
    day = day_of(silver, settings)
    some = silver.withColumn("date", day).join(days.select("date"), "date", "left_semi").drop("date")
    wide = summarize(some, day_of(some, settings), "date", settings)
    return with_weather(wide.join(texture_lookup(silver), list(SITE), "left"), weather, settings)
