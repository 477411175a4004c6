"""Date and time spines built from the data's own bounds."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loamline.config import Settings


def date_spine(df: DataFrame, column: str) -> DataFrame:
    """Every day from the first to the last date of ``column``."""
    bounds = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi")).filter("lo IS NOT NULL")
    return bounds.select(F.explode(F.sequence("lo", "hi")).alias(column))


def missing_dates(df: DataFrame, column: str = "date") -> DataFrame:
    """Days between the first and the last date that no row has. However large the table, only its
    distinct days are joined."""
    days = df.select(column).distinct()
    return date_spine(days, column).join(days, column, "left_anti")


def rows_per_month(df: DataFrame, column: str) -> DataFrame:
    """Rows per calendar month, labelled by its last day; months without rows count 0."""
    month = F.to_date(F.date_trunc("month", column))
    counts = df.filter(F.col(column).isNotNull()).groupBy(month.alias("month")).agg(
        F.count("*").alias("n")
    )
    bounds = counts.agg(F.min("month").alias("lo"), F.max("month").alias("hi"))
    spine = bounds.filter("lo IS NOT NULL").select(
        F.explode(F.expr("sequence(lo, hi, interval 1 month)")).alias("month")
    )
    return spine.join(counts, "month", "left").select(
        F.last_day("month").alias("month_end"), F.coalesce("n", F.lit(0)).alias("n")
    )


def chunk_spans(bounds: DataFrame, start: Column, end: Column, settings: Settings) -> DataFrame:
    """Half-open chunks covering [start, end) of each row; the last one is cut at ``end``."""
    step = F.lit(settings.chunk)
    spans = bounds.select(start.alias("_start"), end.alias("_end"))
    starts = F.sequence(F.col("_start"), F.greatest("_start", "_end"), step)
    return (
        spans.withColumn("chunk_start", F.explode(starts))
        .filter("chunk_start < _end")
        .select("chunk_start", F.least(F.col("chunk_start") + step, F.col("_end")).alias("chunk_end"))
    )


def time_chunks(
    spark: SparkSession, start: datetime, end: datetime, settings: Settings
) -> DataFrame:
    return chunk_spans(spark.range(1), F.lit(start), F.lit(end), settings)
