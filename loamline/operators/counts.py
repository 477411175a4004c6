"""Counting operators: frequencies, distinct values, matrices, firsts and duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def value_counts(df: DataFrame, column: str, by_value: bool = False) -> DataFrame:
    """Frequency of each non-NULL value: most frequent first, or in order of the value."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    order = [F.col(column)] if by_value else [F.desc("n"), F.col(column)]
    return counts.orderBy(*order)


def count_known(column: str, known: Sequence[object] = ()) -> Column:
    """Number of distinct non-NULL values, as an aggregate that needs no expansion of rows.

    The values in ``known`` (at most 63) set one bit each of a number; any others are collected as a
    set, so the count is exact whatever occurs. Several such counts share one grouping and one shuffle
    with one row for each group and task.
    """
    if len(known) > 63:
        raise ValueError("more known values than bits")
    value = F.col(column)
    others = F.size(F.collect_set(F.when(~value.isin(*known), value) if known else value))
    if not known:
        return others.cast("bigint")
    bit = F.lit(None).cast("bigint")
    for at, item in enumerate(known):
        bit = F.when(value == item, F.lit(1 << at)).otherwise(bit)
    return (F.coalesce(F.bit_count(F.bit_or(bit)), F.lit(0)) + others).cast("bigint")


def distinct_per_group(
    df: DataFrame, by: Sequence[str], column: str, name: str, known: Sequence[object] = ()
) -> DataFrame:
    return df.groupBy(*by).agg(count_known(column, known).alias(name))


def distinct_histogram(
    df: DataFrame, by: Sequence[str], column: str, known: Sequence[object] = ()
) -> DataFrame:
    """How many groups have 1, 2, … distinct values of ``column``."""
    per_group = distinct_per_group(df, by, column, "distinct_values", known)
    return (
        per_group.groupBy("distinct_values")
        .agg(F.count("*").alias("groups"))
        .orderBy("distinct_values")
    )


def count_matrix(
    df: DataFrame, by: str, across: str, values: Sequence[str], prefix: str = ""
) -> DataFrame:
    """Rows per ``by`` and value of ``across``, one column per value, 0 where there are none."""
    cells = [F.count_if(F.col(across) == v).alias(f"{prefix}{v}") for v in values]
    return df.groupBy(by).agg(*cells)


def first_known(df: DataFrame, by: Sequence[str], column: str, order: str) -> DataFrame:
    """First non-NULL value of ``column`` per group in the order of one column, ties by the value.

    The first step keeps one minimum per group and value, which stays a hash aggregation that
    combines on the map side; only its small result is compared by value.
    """
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(*by, column)
        .agg(F.min(order).alias("_first"))
        .groupBy(*by)
        .agg(F.min_by(column, F.struct("_first", column)).alias(column))
    )


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with the number of rows beyond the first. NULLs are equal."""
    return (
        df.groupBy(*key)
        .agg((F.count("*") - 1).alias("extra_rows"))
        .filter("extra_rows > 0")
    )


def latest_rows(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """Top n by a total order; Spark keeps n rows per task, then n of those."""
    return df.orderBy(*order).limit(n)
