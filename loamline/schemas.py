"""Declared schemas. Readers apply them, so no file is ever opened to infer a type."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _table(columns: str) -> StructType:
    """Schema from ``name type, …``; unlike Spark's own parser it needs no running session."""
    out = StructType()
    for column in columns.split(","):
        name, kind = column.split()
        out = out.add(name, kind)
    return out


# Column names and types of every table.
RAW_SOIL = _table(
    "local_time string, site_name string, site_id string, id string, probe_id string, "
    "probe_measure string, soil_value double, unit string, json_featuretype string"
)
# A landed page as the source writes it: ids may be numbers or text, values may be malformed.
SOIL_RECORD = _table(
    "local_time string, site_name string, site_id string, id string, probe_id string, "
    "probe_measure string, soil_value string, unit string, json_featuretype string"
)
OPTIONAL_SOIL = ("json_featuretype",)
BRONZE_SOIL = _table(
    "Local_Time string, Site_Name string, Site_ID string, ID string, Probe_ID string, "
    "Probe_Measure string, Soil_Value double, Unit string, json_featuretype string, "
    "event_time timestamp, event_day date"
)
# Rows that an ingest step sets aside: why, the row as JSON, the file, and a key of both.
REJECTS = _table("reason string, record string, source string, digest string")
RAINFALL_CSV = _table(
    "product_code string, station_number string, year integer, month integer, day integer, "
    "rainfall_mm double, period_days double, quality string"
)
TEMPERATURE_CSV = _table(
    "product_code string, station_number string, year integer, month integer, day integer, "
    "max_temp_c double, days_accum double, quality string"
)
SOLAR_CSV = _table(
    "product_code string, station_number string, year integer, month integer, day integer, "
    "solar_exposure_mj double"
)
SITES = _table(
    "site_id integer, site_name string, property_name string, latitude double, longitude double"
)
SITE_RECORD = _table(
    "site_id string, site_name string, property_name string, latitude string, longitude string"
)
SILVER_SOIL = _table(
    "site_name string, site_id string, event_time timestamp, depth_cm integer, measure_type string, "
    "soil_texture string, soil_value double, reading_count long"
)
SILVER_WEATHER = _table(
    "date date, rainfall_mm double, max_temp_c double, solar_exposure_mj double"
)

WEATHER_CSV = {"rainfall": RAINFALL_CSV, "temperature": TEMPERATURE_CSV, "solar": SOLAR_CSV}
WEATHER_VALUE = {
    "rainfall": "rainfall_mm",
    "temperature": "max_temp_c",
    "solar": "solar_exposure_mj",
}


# Stored tables by layer and name, without the load times that the sinks add.
STORED = {
    ("bronze", "soil_readings"): BRONZE_SOIL,
    ("bronze", "sites"): SITES,
    ("silver", "soil_readings"): SILVER_SOIL,
    ("silver", "weather_daily"): SILVER_WEATHER,
}


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """The declared columns in their order and types. A missing column is NULL, as is a text that
    is no number; other columns are left out."""
    have = {c.lower() for c in df.columns}
    return df.select(
        *[
            (F.col(f.name) if f.name.lower() in have else F.lit(None)).try_cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def require_types(df: DataFrame, schema: StructType, what: str) -> None:
    """Refuse a stored table whose columns have other types than the rows to be added."""
    stored = {f.name.lower(): f.dataType for f in df.schema}
    other = [
        f"{f.name} is {stored[f.name.lower()].simpleString()}, not {f.dataType.simpleString()}"
        for f in schema
        if f.name.lower() in stored and stored[f.name.lower()] != f.dataType
    ]
    if other:
        raise ValueError(f"{what}: {'; '.join(other)}")


def require_columns(df: DataFrame, schema: StructType, optional: Sequence[str] = ()) -> DataFrame:
    """Fail early, from the schema alone, when a table lacks a declared column."""
    have = {c.lower() for c in df.columns} | set(optional)
    missing = [f.name for f in schema if f.name.lower() not in have]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df
