"""From landed files to bronze rows and to rows set aside; nothing is dropped on the way."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamline.plans import bronze
from loamline.schemas import BRONZE_SOIL, SITE_RECORD, SOIL_RECORD, conform
from loamline.session import stored
from loamline.sinks.files import Ingested, append_absent, set_aside
from loamline.sources.files import weather_from_text
from loamline.sources.pages import incomplete, landed_pages, records, unreadable


def reading_problem() -> Column:
    """Why a reading cannot be stored; NULL when it can."""
    return F.when(F.col("event_time").isNull(), "unreadable time").when(
        F.col("ID").isNull(), "missing id"
    )


def soil_rows(readings: DataFrame) -> DataFrame:
    """Readings in the declared types of the bronze table, with their day."""
    return conform(readings.withColumn("event_day", F.to_date("event_time")), BRONZE_SOIL)


def page_rejects(pages: DataFrame) -> DataFrame:
    """Pages that cannot be read, and deliveries with fewer records than they name."""
    broken = set_aside(unreadable(pages).select("text", "file"), F.lit("unreadable page"), F.col("file"))
    short = set_aside(
        incomplete(pages).select("total_count", "records", "file"),
        F.lit("incomplete delivery"),
        F.col("file"),
    )
    return broken.unionByName(short)


def soil_from_lines(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Bronze readings of landed lines, and everything else with the reason.

    A delivery is parsed once: its lines, and then its readings, are written to the scratch folder, from
    where the days it touches, its rejects and its rows are read.
    """
    pages = landed_pages(lines, SOIL_RECORD, stored)
    raw = records(pages)
    # What is set aside keeps the record as it came.
    kept = F.struct(*[F.col(c) for c in raw.columns])
    read = bronze.soil_from_records(raw.withColumn("_raw", kept)).withColumn("_why", reading_problem())
    read = stored(read.withColumn("_raw", F.when(F.col("_why").isNotNull(), F.col("_raw"))), "readings")
    good = soil_rows(read.filter("_why IS NULL").drop("_why", "_raw"))
    bad = read.filter("_why IS NOT NULL").select("_why", "_raw.*")
    aside = set_aside(bad, F.col("_why"), F.col("file"))
    return good, aside.unionByName(page_rejects(pages))


def add_soil_lines(lines: DataFrame, table: str) -> Ingested:
    """Append the readings of landed lines that the table lacks. Batch and stream both end here."""
    rows, rejects = soil_from_lines(lines)
    return append_absent(
        rows,
        table,
        ["ID"],
        ["event_time"],
        stamps=("ingested_at", "ingested_date"),
        day="event_day",
        rejects=rejects,
    )


def sites_from_text(text: DataFrame, source: Column) -> tuple[DataFrame, DataFrame]:
    """The sites of a list, and its rows that were skipped: broken ones and repeated ids."""
    place = bronze.place_of(text)
    typed = bronze.site_rows(text, *place)
    broken = typed.filter("reject_reason IS NOT NULL")
    sites = bronze.sites_dimension(text)
    good = typed.filter("reject_reason IS NULL").drop("reject_reason")
    first = bronze.first_rows(good, place)
    again = good.exceptAll(first.select(good.columns)).drop(*place)
    aside = set_aside(broken.drop(*place), F.col("reject_reason"), source)
    return sites, aside.unionByName(set_aside(again, F.lit("repeated site_id"), source))


def site_records(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Site records of landed pages as text, and the pages that cannot be read."""
    pages = landed_pages(lines, SITE_RECORD)
    return records(pages).drop("file"), page_rejects(pages)


def dated_weather(text: DataFrame, feed: str) -> tuple[DataFrame, DataFrame]:
    """Rows of a daily feed with a date, from its file as text; and its malformed lines, its cells that
    do not fit their column (the rows stay, with NULL in their place), and its rows without a date."""
    typed, misfits = weather_from_text(text, feed)
    dated = bronze.weather_with_date(typed)
    undated = set_aside(bronze.rejected(dated, "date"), F.lit("no such day"), F.lit(None))
    wrong = set_aside(misfits, F.col("reason"), F.col("file"))
    return bronze.accepted(dated, "date"), undated.unionByName(wrong)
