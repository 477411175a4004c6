"""From bronze readings to merged silver readings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamline.config import Settings
from loamline.functions import depth_cm, measure_type, plausible, soil_texture

# The columns that identify a merged reading.
SILVER_KEYS = ("site_name", "site_id", "event_time", "depth_cm", "measure_type", "soil_texture")


def describe_probes(bronze: DataFrame, settings: Settings) -> DataFrame:
    """Add what the probe text says: depth, measure, texture."""
    text = F.col("Probe_Measure")
    return bronze.withColumns(
        {
            "depth_cm": depth_cm(text),
            "measure_type": measure_type(text, tuple(settings.ranges)),
            "soil_texture": soil_texture(text),
        }
    )


def valid_readings(bronze: DataFrame, settings: Settings) -> DataFrame:
    """Readings with a known measure, depth and time and a value inside its limits.

    Filtered before the probe text is taken apart: cheap tests first, the depth pattern last.
    """
    text = F.col("Probe_Measure")
    kept = bronze.filter(
        F.col("event_time").isNotNull()
        & plausible(text, F.col("Soil_Value"), settings)
        & depth_cm(text).isNotNull()
    )
    return describe_probes(kept, settings)


def merge_probes(readings: DataFrame) -> DataFrame:
    """One row per site, time, depth, measure and texture: the mean of its probes and their number.

    Mean and count combine on the map side, so a key that holds a large share of all rows reaches
    the shuffle as one row per map task.
    """
    return (
        readings.withColumnsRenamed({"Site_Name": "site_name", "Site_ID": "site_id"})
        .groupBy(*SILVER_KEYS)
        .agg(
            F.avg("Soil_Value").alias("soil_value"),
            F.count("Soil_Value").alias("reading_count"),
        )
    )
