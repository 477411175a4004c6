"""Helpers that several operators use."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loamline.session import scratch_path, ship_library

Batches = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]

# A key is hot when it holds more than this part of all rows: fewer than as many can be.
HOT_PART = 1000


def arrow_map(df: DataFrame, batches: Batches, schema: str | StructType) -> DataFrame:
    """``mapInArrow`` with this library at hand in the workers."""
    ship_library(df.sparkSession)
    return df.mapInArrow(batches, schema)


def stored(df: DataFrame, spark: SparkSession, name: str) -> DataFrame:
    """The rows, written to the shared folder and read again: cuts the lineage, and its size is known."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table, or a part of one, that nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def join_facts(rows: DataFrame, facts: DataFrame, same: Column, n: Column, total: int) -> DataFrame:
    """Inner join of ``rows`` with ``facts``, which holds one row for each key and says in ``n`` how many
    rows have it.

    The few hot keys are handed to all tasks; the join of the others then has no key with more than a
    thousandth of all rows.
    """
    hot, cold = facts.filter(n * HOT_PART > total), facts.filter(n * HOT_PART <= total)
    common = rows.join(F.broadcast(hot), same)
    others = rows.join(F.broadcast(hot), same, "left_anti").join(cold, same)
    return common.unionByName(others)
