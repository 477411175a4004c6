"""Silver: merged readings and daily weather."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamline.config import Settings
from loamline.operators.readings import merge_probes, valid_readings
from loamline.schemas import WEATHER_VALUE


def silver_soil(bronze: DataFrame, settings: Settings) -> DataFrame:
    return merge_probes(valid_readings(bronze, settings))


def silver_weather(
    rain: DataFrame, temperature: DataFrame, solar: DataFrame, settings: Settings
) -> DataFrame:
    """One row per day that any feed has.

    The feeds are put one below the other and grouped once, so a date that a feed holds several
    times (more than one station) multiplies nothing: its values are averaged, NULL left out. The
    date bound is applied to each feed, below the grouping.
    """
    feeds = {"rainfall": rain, "temperature": temperature, "solar": solar}
    start = settings.weather_from
    rows = [
        (df if start is None else df.filter(F.col("date") >= F.lit(start))).select(
            "date", WEATHER_VALUE[name]
        )
        for name, df in feeds.items()
    ]
    below = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    means = [F.avg(value).alias(value) for value in WEATHER_VALUE.values()]
    return below.filter("date IS NOT NULL").groupBy("date").agg(*means).orderBy("date")
