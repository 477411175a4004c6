"""Bronze: raw feeds, typed and dated, with what cannot be read set aside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamline.functions import calendar_date, clean_text, offset_timestamp
from loamline.functions.times import OFFSET_PATTERN
from loamline.operators.keyed import first_per_key

# Names of the raw fields and of the bronze columns they become.
SOIL_COLUMNS = {
    "local_time": "Local_Time",
    "site_name": "Site_Name",
    "site_id": "Site_ID",
    "id": "ID",
    "probe_id": "Probe_ID",
    "probe_measure": "Probe_Measure",
    "soil_value": "Soil_Value",
    "unit": "Unit",
}


# Where a row of a text file stands: its file, the start of its part, its number.
PLACE = ("_file", "_block", "_line")


def soil_from_raw(raw: DataFrame, pattern: str | None = None) -> DataFrame:
    """Raw readings under their bronze names with ``event_time``, NULL where it cannot be read.

    ``pattern=None`` takes any usual form of the time text; a column that already is a timestamp is
    used as it is.
    """
    if dict(raw.dtypes)["local_time"] == "string":
        event_time = offset_timestamp(F.col("local_time"), pattern)
    else:
        event_time = F.col("local_time")
    return raw.withColumn("event_time", event_time).withColumnsRenamed(SOIL_COLUMNS)


def soil_from_records(records: DataFrame) -> DataFrame:
    """Bronze readings from page records: ids as text, values as numbers, 0 kept, NULL kept."""
    typed = records.withColumns(
        {
            "site_id": F.col("site_id").cast("string"),
            "id": F.col("id").cast("string"),
            "probe_id": F.col("probe_id").cast("string"),
            "soil_value": F.col("soil_value").try_cast("double"),
        }
    )
    return soil_from_raw(typed, OFFSET_PATTERN)


def weather_with_date(feed: DataFrame) -> DataFrame:
    return feed.withColumn("date", calendar_date(F.col("year"), F.col("month"), F.col("day")))


def site_rows(text: DataFrame, *keep: str) -> DataFrame:
    """Typed site rows from text, with the reason for those that cannot be used."""

    def number(name: str, kind: str) -> Column:
        return F.trim(F.col(name)).try_cast(kind)

    def broken(name: str, kind: str) -> Column:
        return F.col(name).isNotNull() & number(name, kind).isNull()

    return text.select(
        *keep,
        number("site_id", "int").alias("site_id"),
        clean_text(F.col("site_name")).alias("site_name"),
        clean_text(F.col("property_name")).alias("property_name"),
        number("latitude", "double").alias("latitude"),
        number("longitude", "double").alias("longitude"),
        F.when(F.col("site_id").isNull(), "missing site_id")
        .when(broken("site_id", "int"), "bad site_id")
        .when(broken("latitude", "double"), "bad latitude")
        .when(broken("longitude", "double"), "bad longitude")
        .alias("reject_reason"),
    )


def sites_dimension(text: DataFrame) -> DataFrame:
    """One row per site_id, the first in the order of file names and lines. Missing coordinates
    stay NULL. Rows that say nothing about their place fall to the least one."""
    place = place_of(text)
    good = site_rows(text, *place).filter("reject_reason IS NULL").drop("reject_reason")
    return first_rows(good, place).drop(*place)


def first_rows(sites: DataFrame, place: list[str]) -> DataFrame:
    return first_per_key(sites, ["site_id"], place)


def place_of(text: DataFrame) -> list[str]:
    """Columns that say where a row stands in its files; readers of site lists add them."""
    return [c for c in PLACE if c in text.columns]


def accepted(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull())


def rejected(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())
