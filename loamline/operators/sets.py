"""Set operations over the values of one column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def values_where(df: DataFrame, column: str, predicate: Column) -> DataFrame:
    return df.filter(predicate).select(column).distinct()


def in_both(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.intersect(right)


def only_left(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.subtract(right)


def side_by_predicate(df: DataFrame, column: str, predicate: Column) -> DataFrame:
    """For each value: does it have rows that satisfy the predicate, and rows that do not?

    One aggregation gives both sets, their overlap and their difference.
    """
    return df.groupBy(column).agg(
        F.coalesce(F.bool_or(predicate), F.lit(False)).alias("has"),
        F.coalesce(F.bool_or(~predicate), F.lit(False)).alias("lacks"),
    )
