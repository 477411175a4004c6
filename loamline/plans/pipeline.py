"""The steps of a scheduled run, each from stored tables to stored tables."""

from __future__ import annotations

import os
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamline.config import Settings
from loamline.operators.quality import assert_quality
from loamline.operators.summary import day_of
from loamline.plans import bronze, gold, ingest, silver
from loamline.schemas import (
    OPTIONAL_SOIL,
    RAW_SOIL,
    SILVER_SOIL,
    SILVER_WEATHER,
    SITES,
    STORED,
    WEATHER_VALUE,
    conform,
    require_columns,
)
from loamline.session import scratch_path
from loamline.sinks import (
    Ingested,
    append_absent,
    connection,
    load_tables,
    replace_partitions,
    replace_table,
    set_aside,
    store_rejects,
    write_table,
)
from loamline.sources import page_lines, read_sites_csv, read_table, weather_text
from loamline.versions import is_versioned


@dataclass(frozen=True)
class Lake:
    """Where the tables of one lake live."""

    root: str

    def path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{table}"


@dataclass(frozen=True)
class Pipeline:
    spark: SparkSession
    lake: Lake
    settings: Settings = Settings()

    def _read(self, layer: str, table: str) -> DataFrame:
        return read_table(self.spark, self.lake.path(layer, table), STORED.get((layer, table)))

    def ingest_soil(self, raw_path: str) -> Ingested:
        """Replace bronze readings by a historical parquet file; rows without a time are set aside."""
        path = self.lake.path("bronze", "soil_readings")
        raw = require_columns(read_table(self.spark, raw_path), RAW_SOIL, OPTIONAL_SOIL)
        read = bronze.soil_from_raw(raw.withColumn("_raw", F.struct("*")))
        problem = F.when(F.col("event_time").isNull(), "unreadable time")
        aside = set_aside(
            read.filter(problem.isNotNull()).select("_raw.*"), F.lit("unreadable time"), F.lit(raw_path)
        )
        rejected = store_rejects(aside, path)
        added = replace_table(
            ingest.soil_rows(read.filter(problem.isNull()).drop("_raw")),
            path,
            partition_by=("event_day",),
            stamps=("ingested_at", "ingested_date"),
        )
        return Ingested(added, rejected)

    def ingest_soil_pages(self, pages_path: str | list[str]) -> Ingested:
        """Append the readings of landed pages that the table lacks, however late they come."""
        return ingest.add_soil_lines(
            page_lines(self.spark, pages_path), self.lake.path("bronze", "soil_readings")
        )

    def ingest_weather(self, feed: str, csv_path: str) -> Ingested:
        path = self.lake.path("bronze", f"weather_{feed}")
        rows, aside = ingest.dated_weather(weather_text(self.spark, csv_path, feed), feed)
        rejected = store_rejects(aside, path)
        return Ingested(replace_table(rows, path, stamps=("ingested_at",)), rejected)

    def ingest_sites_csv(self, csv_path: str) -> Ingested:
        rows, aside = ingest.sites_from_text(
            read_sites_csv(self.spark, csv_path), F.lit(csv_path)
        )
        return append_absent(
            conform(rows, SITES), self.lake.path("bronze", "sites"), ["site_id"], rejects=aside
        )

    def ingest_sites_pages(self, pages_path: str) -> Ingested:
        text, broken = ingest.site_records(page_lines(self.spark, pages_path))
        rows, aside = ingest.sites_from_text(text, F.lit(pages_path))
        return append_absent(
            conform(rows, SITES),
            self.lake.path("bronze", "sites"),
            ["site_id"],
            rejects=aside.unionByName(broken),
        )

    def silver_soil(self) -> int:
        return replace_table(
            conform(silver.silver_soil(self._read("bronze", "soil_readings"), self.settings), SILVER_SOIL),
            self.lake.path("silver", "soil_readings"),
            partition_by=("measure_type",),
            stamps=("transformed_at",),
        )

    def silver_weather(self) -> int:
        feeds = [self._read("bronze", f"weather_{feed}") for feed in WEATHER_VALUE]
        return replace_table(
            conform(silver.silver_weather(*feeds, self.settings), SILVER_WEATHER),
            self.lake.path("silver", "weather_daily"),
            stamps=("transformed_at",),
        )

    def validate(self) -> None:
        assert_quality(self._read("silver", "soil_readings"), self.settings)

    def gold_daily(self) -> int:
        readings = self._read("silver", "soil_readings")
        weather = self._read("silver", "weather_daily")
        return replace_table(
            gold.gold_daily(readings, weather, self.settings),
            self.lake.path("gold", "daily_site_summary"),
            partition_by=("date",),
            stamps=("transformed_at",),
        )

    def gold_daily_since(self, ingested: datetime) -> int:
        """Bring the daily table up to date: only days whose readings came in from ``ingested`` on,
        and days of sites whose texture changed, are built again and replaced."""
        path = self.lake.path("gold", "daily_site_summary")
        new = read_table(self.spark, self.lake.path("bronze", "soil_readings")).filter(
            F.col("ingested_at") >= F.lit(ingested)
        )
        return self.gold_daily_days(new.select(day_of(new, self.settings).alias("date")).distinct(), path)

    def gold_daily_days(self, changed: DataFrame, path: str) -> int:
        readings = self._read("silver", "soil_readings")
        weather = self._read("silver", "weather_daily")
        stored = read_table(self.spark, path)
        days = gold.touched_days(stored, readings, changed, self.settings)
        rows = gold.gold_days(readings, weather, days, self.settings)
        if not is_versioned(self.spark, path):
            # Spark may not replace files that the same job reads, so the rows are put down first.
            between = scratch_path(self.spark, "gold-days")
            write_table(rows, between)
            rows = read_table(self.spark, between)
        return replace_partitions(rows, path, ("date",), ("transformed_at",))

    def gold_hourly(self) -> int:
        return replace_table(
            gold.gold_hourly(self._read("silver", "soil_readings"), self.settings),
            self.lake.path("gold", "hourly_site_summary"),
            stamps=("transformed_at",),
        )

    def load(self, database_url: str | None = None) -> None:
        """Replace both gold tables in the database named by ``LOAMLINE_DB_URL``."""
        options = connection(database_url or os.environ["LOAMLINE_DB_URL"])
        names = ("daily_site_summary", "hourly_site_summary")
        load_tables({n: self._read("gold", n) for n in names}, options)
