"""Incremental reads: where a table ends, and what a source has from there on."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loamline.config import Settings
from loamline.session import stored
from loamline.storage import exists, names_in
from loamline.versions import commits, folders_of, is_versioned, read_version


def read_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    if is_versioned(spark, path):
        return read_version(spark, path)
    # Looked up first, because Spark prints a stack trace for a path that is not there.
    if not exists(spark, path):
        return None
    try:
        return spark.read.parquet(path)
    except AnalysisException as err:
        # Nothing written yet, or a folder without a single data file.
        if err.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def high_water_mark(df: DataFrame, time: str = "event_time") -> DataFrame:
    """One row, NULL for an empty table. Reads the time column only; :func:`stored_high_water_mark` reads
    the newest day of a stored table."""
    return df.agg(F.max(time).alias("high_water_mark"))


def newest_parts(spark: SparkSession, path: str, day: str) -> list[str]:
    """Names of a stored table's partitions by ``day``, newest first, from its folders alone.

    The table may have versions; then the folders of its newest commit count.
    """
    if is_versioned(spark, path):
        folders = folders_of(spark, path, commits(spark, path)[-1])
        names = {part for folder in folders for part in folder.split("/") if part.startswith(f"{day}=")}
    else:
        names = {n for n in names_in(spark, path) if n.startswith(f"{day}=")}
    return sorted((n.split("=", 1)[1] for n in names if not n.endswith("=__HIVE_DEFAULT_PARTITION__")), reverse=True)


def stored_high_water_mark(
    spark: SparkSession, path: str, time: str = "event_time", day: str = "event_day"
) -> datetime | None:
    """The last time of a stored table that is partitioned by the day of that time; None where there is none.

    Only the newest day is read, and older ones as long as no time was found; the days are known from
    the table's folders. Of a table without such partitions the time column is read.
    """
    table = read_if_exists(spark, path)
    if table is None:
        return None
    parts = newest_parts(spark, path, day)
    if not parts and day not in table.columns:
        return high_water_mark(table, time).first()[0]
    for part in parts:
        last = high_water_mark(table.filter(F.col(day) == F.lit(part).cast(dict(table.dtypes)[day])), time).first()[0]
        if last is not None:
            return last
    return None


def numbered_rows(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """Rows with ``row_number`` (from 0) in a total order, without sorting them in one task.

    Rows are dealt to ranges of the order, sorted inside these, and written with their range and place.
    The sizes of the ranges, one row each, then tell how many rows come before a range.
    """
    number = F.monotonically_increasing_id()
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stored(
        dealt.withColumns(
            {"_range": F.shiftright(number, 33), "_place": number.bitwiseAND(F.lit((1 << 33) - 1))}
        ),
        "numbered-rows",
    )
    ranges = Window.orderBy("_range")
    before = (
        placed.groupBy("_range")
        .agg(F.count("*").alias("_rows"))
        .select("_range", (F.sum("_rows").over(ranges) - F.col("_rows")).alias("_before"))
    )
    # one row for each range, of which there are as many as shuffle partitions
    return placed.join(F.broadcast(before), "_range").select(
        *[F.col(f"`{c}`") for c in df.columns], (F.col("_before") + F.col("_place")).alias("row_number")
    )


def all_pages(df: DataFrame, order: Sequence[str | Column], limit: int) -> DataFrame:
    """Every row with the number of its page (from 0), all pages of ``limit`` rows in one pass."""
    rows = numbered_rows(df, order)
    return rows.withColumn("page", F.floor(F.col("row_number") / limit)).drop("row_number")


def range_slice(
    df: DataFrame, start: datetime | None, end: datetime | None = None, time: str = "event_time"
) -> DataFrame:
    """Rows in [start, end); both bounds reach the scan, and None is no bound."""
    out = df if start is None else df.filter(F.col(time) >= F.lit(start))
    return out if end is None else out.filter(F.col(time) < F.lit(end))


def page_of(
    df: DataFrame, order: Sequence[str | Column], limit: int, offset: int = 0
) -> DataFrame:
    """One page of a table in a total order, as a paged source hands it out."""
    return df.orderBy(*order).offset(offset).limit(limit)


def page_after(df: DataFrame, key: str, limit: int, last: object = None) -> DataFrame:
    """The next ``limit`` rows by a unique key, after the last key of the page before.

    Every page costs the same, however deep: the bound reaches the scan and each task keeps
    ``limit`` rows, where an offset gathers all rows that it skips.
    """
    rest = df if last is None else df.filter(F.col(key) > F.lit(last))
    return rest.orderBy(key).limit(limit)


def incremental_slice(
    source: DataFrame, table: DataFrame | None, settings: Settings, time: str = "event_time"
) -> DataFrame:
    """Rows of ``source`` from the table's last time minus the overlap, or, for a missing or empty
    table, from the fixed first load.

    The bound is a scalar subquery: Spark computes it first and then filters the scan with it.
    """
    if table is None:
        return range_slice(source, settings.first_load, time=time)
    last = F.col("high_water_mark") - F.lit(settings.overlap)
    first_load = F.lit(settings.first_load).cast(dict(table.dtypes)[time])
    bound = high_water_mark(table, time).select(F.coalesce(last, first_load)).scalar()
    return source.filter((F.col(time) >= bound) | bound.isNull())
