"""Sensor-shaped tables derived by Spark from the star-schema test tables.

Every reading comes from one row of ``events`` and every day of weather from the ``orders`` of that
day, so all work grows with those tables.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamline.config import Settings
from loamline.functions import iso_text
from loamline.plans import bronze, gold, silver
from loamline.schemas import WEATHER_VALUE

# Which orders feed which weather series, and how far their days are moved (28 years).
FEED_PRIORITIES = {
    "rainfall": ("1-URGENT",),
    "temperature": ("2-HIGH",),
    "solar": ("3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"),
}
SHIFT_DAYS = 10227


def once(method: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Build each plan once per set of tables; nothing is computed or cached by this."""

    @wraps(method)
    def built(self: Tables, *args: str) -> DataFrame:
        key = (method.__name__, *args)
        if key not in self.plans:
            self.plans[key] = method(self, *args)
        return self.plans[key]

    return built


@dataclass
class Tables:
    spark: SparkSession
    sf_dir: str
    settings: Settings = Settings()
    plans: dict[tuple, DataFrame] = field(default_factory=dict)

    @once
    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @once
    def bronze_soil(self) -> DataFrame:
        """Readings with the event time as a TIMESTAMP_NTZ in UTC."""
        k = F.get_json_object("props", "$.k").cast("int")
        site = F.col("user_id") % 12
        kind = F.col("event_type")
        word = (
            F.when(kind == "error", "Battery")
            .when((site == 11) | kind.isin("click", "view"), "Moisture")
            .when(kind == "purchase", "Temperature")
            .otherwise("Salinity")
        )
        tens = F.col("k") % 9
        depth = (
            F.when(tens == 0, "")
            .when(F.col("k") % 2 == 0, F.concat(F.lit(" "), (tens * 10).cast("string"), F.lit("cm")))
            .otherwise(F.concat(F.lit(" "), (tens * 10).cast("string"), F.lit(" cm")))
        )
        mix = (F.col("k") + F.col("user_id")) % 4
        texture = (
            F.when(mix == 0, " (Clay)")
            .when(mix == 1, " (Sandy Loam)")
            .when(mix == 2, " (Clayey Loam)")
            .otherwise("")
        )
        probe = F.col("k") % 3
        suffix = F.when(site >= 8, "").when(probe == 0, "#0").when(probe == 1, "#1").otherwise("")
        scaled = (kind == "signup") & (site != 11)
        six_hours = F.make_dt_interval(F.lit(0), (F.floor(F.hour("ts") / 6) * 6).cast("int"))
        # Exploding an array of one keeps Spark from repeating the text's expression in every filter
        # on it; a stored table would hold the text just the same.
        text = F.concat(F.lit("Soil "), word, depth, texture, suffix)
        return (
            self.read("events")
            .withColumn("k", k)
            .select(
                F.col("event_id").cast("string").alias("ID"),
                F.concat(F.lit("Site "), site.cast("string")).alias("Site_Name"),
                site.cast("string").alias("Site_ID"),
                probe.cast("string").alias("Probe_ID"),
                F.explode(F.array(text)).alias("Probe_Measure"),
                F.when(scaled, F.col("value") / 10).otherwise(F.col("value")).alias("Soil_Value"),
                F.when(word == "Moisture", "%").alias("Unit"),
                (F.col("ts").cast("date").cast("timestamp_ntz") + six_hours).alias("event_time"),
            )
        )

    @once
    def raw_soil(self) -> DataFrame:
        """The same readings as the source hands them out: time as text with an offset."""
        names = {new: old for old, new in bronze.SOIL_COLUMNS.items()}
        return (
            self.bronze_soil()
            .withColumn("local_time", F.concat(iso_text(F.col("event_time")), F.lit("+00:00")))
            .withColumn("json_featuretype", F.lit("Feature"))
            .drop("event_time")
            .withColumnsRenamed(names)
        )

    @once
    def raw_weather(self, feed: str) -> DataFrame:
        """Daily rows of one feed, laid out like its CSV file."""
        day = F.date_add(F.to_date("o_orderdate"), SHIFT_DAYS)
        seed = F.sum("o_custkey")
        value = {
            "rainfall": (seed % 80).cast("double") / 10,
            "temperature": F.lit(15.0) + (seed % 20).cast("double"),
            "solar": (seed % 30).cast("double"),
        }[feed]
        days = (
            self.read("orders")
            .filter(F.col("o_orderpriority").isin(*FEED_PRIORITIES[feed]))
            .groupBy(day.alias("day"))
            .agg(
                F.when(seed % 11 != 0, value).alias(WEATHER_VALUE[feed]),
                F.lit(1.0).alias("span"),
            )
        )
        columns = [
            F.lit(f"P-{feed}").alias("product_code"),
            F.lit("000001").alias("station_number"),
            F.year("day").alias("year"),
            F.month("day").alias("month"),
            F.dayofmonth("day").alias("day"),
            F.col(WEATHER_VALUE[feed]),
        ]
        if feed == "rainfall":
            columns += [F.col("span").alias("period_days"), F.lit("Y").alias("quality")]
        elif feed == "temperature":
            columns += [F.col("span").alias("days_accum"), F.lit("Y").alias("quality")]
        return days.select(*columns)

    @once
    def bronze_weather(self, feed: str) -> DataFrame:
        return bronze.accepted(bronze.weather_with_date(self.raw_weather(feed)), "date")

    @once
    def raw_sites(self) -> DataFrame:
        return self.read("supplier").select(
            F.col("s_suppkey").cast("int").alias("site_id"),
            F.concat(F.lit("Site "), F.col("s_suppkey").cast("string")).alias("site_name"),
            F.col("s_name").alias("property_name"),
            (F.lit(-37.8) + F.col("s_acctbal") / 1e5).alias("latitude"),
            (F.lit(144.9) + F.col("s_acctbal") / 1e5).alias("longitude"),
        )

    @once
    def silver_soil(self) -> DataFrame:
        return silver.silver_soil(self.bronze_soil(), self.settings)

    @once
    def silver_weather(self) -> DataFrame:
        return silver.silver_weather(
            *[self.bronze_weather(feed) for feed in WEATHER_VALUE], self.settings
        )

    @once
    def gold_daily(self) -> DataFrame:
        return gold.gold_daily(self.silver_soil(), self.silver_weather(), self.settings)

    @once
    def gold_hourly(self) -> DataFrame:
        return gold.gold_hourly(self.silver_soil(), self.settings)
