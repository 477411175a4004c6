"""Data profiling over bronze and silver tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamline.config import DEPTHS_CM, MEASURES
from loamline.functions import depth_cm, first_measure_word, probe_suffix, soil_texture
from loamline.operators.counts import (
    count_known,
    count_matrix,
    distinct_histogram,
    first_known,
    value_counts,
)
from loamline.operators.distribution import describe
from loamline.operators.series import gap_counts
from loamline.operators.sets import side_by_predicate

# Measure words, and values above which readings are counted as suspicious.
MEASURE_WORDS = (*MEASURES, "Conductivity")
SUSPICIOUS_ABOVE = {"Moisture": 100.0, "Temperature": 60.0, "Salinity": 10.0}


def with_measure(bronze: DataFrame) -> DataFrame:
    return bronze.withColumn("measure_type", first_measure_word(F.col("Probe_Measure")))


def with_depth(bronze: DataFrame) -> DataFrame:
    return bronze.withColumn("depth_cm", depth_cm(F.col("Probe_Measure")))


def feed_coverage(feeds: Mapping[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """Per feed (table, date column, value column): first and last day, days without a row, NULL
    and zero values. One global aggregate per feed, hence one row each."""

    def one(name: str, df: DataFrame, day: str, value: str) -> DataFrame:
        return df.agg(
            F.lit(name).alias("feed"),
            F.count("*").alias("rows"),
            F.min(day).alias("first_day"),
            F.max(day).alias("last_day"),
            (F.date_diff(F.max(day), F.min(day)) + 1 - F.count_distinct(day)).alias("missing_days"),
            F.count_if(F.col(value).isNull()).alias("null_values"),
            F.count_if(F.col(value) == 0).alias("zero_values"),
        )

    return reduce(DataFrame.unionByName, [one(name, *parts) for name, parts in feeds.items()])


def measure_profile(bronze: DataFrame) -> DataFrame:
    """Distribution and outlier counts of the raw values, per measure."""
    known = with_measure(bronze).filter(F.col("measure_type").isNotNull())
    counts = {
        "null_values": lambda v: v.isNull(),
        "zero_values": lambda v: v == 0,
        "negative_values": lambda v: v < 0,
        **{
            f"above_{int(limit)}": (lambda v, limit=limit: v > limit)
            for limit in SUSPICIOUS_ABOVE.values()
        },
    }
    # the measure pattern names four words, so there are at most four groups
    return describe(known, ["measure_type"], "Soil_Value", counts=counts, few_groups=True)


def weather_profile(feeds: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Distribution of the values of each feed (table, value column), all feeds in one go."""
    counts = {"null_values": lambda v: v.isNull(), "zero_values": lambda v: v == 0}
    rows = [
        df.select(F.lit(name).alias("feed"), F.col(value).cast("double").alias("value"))
        for name, (df, value) in feeds.items()
    ]
    below = reduce(DataFrame.unionByName, rows)
    # one group for each feed that is handed in
    return describe(below, ["feed"], "value", counts=counts, few_groups=True)


def site_coverage(bronze: DataFrame) -> DataFrame:
    """Number of measures and of depths seen at each site: one bit for each usual one."""
    return (
        with_depth(with_measure(bronze))
        .groupBy("Site_Name")
        .agg(
            count_known("measure_type", MEASURE_WORDS).alias("measures"),
            count_known("depth_cm", DEPTHS_CM).alias("depths"),
        )
    )


def depth_coverage(bronze: DataFrame) -> DataFrame:
    """How many sites have 0, 1, 2, … depths."""
    return distinct_histogram(with_depth(bronze), ["Site_Name"], "depth_cm", DEPTHS_CM)


def coverage_classes(bronze: DataFrame) -> DataFrame:
    """Number of sites with 0, 1, 2, … distinct measures."""
    return site_coverage(bronze).groupBy("measures").agg(F.count("*").alias("sites"))


def site_measure_matrix(bronze: DataFrame) -> DataFrame:
    """Readings per site and measure word, 0 where a site has none."""
    return count_matrix(with_measure(bronze), "Site_Name", "measure_type", MEASURE_WORDS)


def sites_missing_measure(bronze: DataFrame) -> DataFrame:
    """The matrix for the sites that have some measures, but fewer than three."""
    present = reduce(add, [(F.col(m) > 0).cast("int") for m in MEASURE_WORDS])
    return site_measure_matrix(bronze).filter((present > 0) & (present < len(MEASURES)))


def texture_consistency(bronze: DataFrame) -> DataFrame:
    """Per site and depth: number of textures and the first one in time order."""
    keys = ["Site_Name", "depth_cm"]
    textured = (
        with_depth(bronze)
        .withColumn("soil_texture", soil_texture(F.col("Probe_Measure")))
        .filter("soil_texture IS NOT NULL AND depth_cm IS NOT NULL")
        .groupBy(*keys, "soil_texture")
        .agg(F.min("event_time").alias("since"))
    )
    return textured.groupBy(*keys).agg(
        F.count("*").alias("textures"),
        F.min_by("soil_texture", F.struct("since", "soil_texture")).alias("first_texture"),
    )


def hash_probe_sites(bronze: DataFrame) -> DataFrame:
    """Per site: has it probes marked ``#0``, and probes without the mark?"""
    return side_by_predicate(bronze, "Site_Name", F.col("Probe_Measure").contains("#0"))


def hash_probe_overlap(bronze: DataFrame) -> DataFrame:
    return hash_probe_sites(bronze).agg(
        F.count_if("has").alias("with_hash"),
        F.count_if("lacks").alias("without_hash"),
        F.count_if(F.col("has") & F.col("lacks")).alias("overlap"),
        F.count_if(F.col("lacks") & ~F.col("has")).alias("only_without"),
    )


def suffix_counts(bronze: DataFrame) -> DataFrame:
    return value_counts(
        bronze.select(probe_suffix(F.col("Probe_Measure")).alias("suffix")), "suffix"
    )


def reading_gaps(bronze: DataFrame) -> DataFrame:
    """Distribution of the seconds between readings, per site, measure and depth."""
    keys = ["Site_Name", "measure_type", "depth_cm"]
    series = with_depth(with_measure(bronze)).filter(
        "measure_type IS NOT NULL AND depth_cm IS NOT NULL"
    )
    return describe(gap_counts(series, keys), keys, "gap_seconds", weight="n", counted=True)


def first_texture(bronze: DataFrame) -> DataFrame:
    readings = with_depth(bronze).withColumn("soil_texture", soil_texture(F.col("Probe_Measure")))
    return first_known(readings, ["Site_Name", "depth_cm"], "soil_texture", "event_time")
