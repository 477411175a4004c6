"""Recovery check: lose the newest rows, ingest again, compare."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from loamline.config import Settings
from loamline.operators.counts import latest_rows
from loamline.operators.keyed import absent_rows, difference
from loamline.session import scratch_path
from loamline.sources.incremental import incremental_slice


def last_by_id(table: DataFrame, n: int = 10) -> DataFrame:
    """The n rows with the highest numeric id."""
    order = [F.desc_nulls_last(F.col("ID").try_cast("bigint")), F.desc("ID")]
    return latest_rows(table, order, n)


def last_ids(table: DataFrame, n: int = 10) -> list[str]:
    """The ids of :func:`last_by_id`: n of them, from a scan of one column."""
    return [r.ID for r in last_by_id(table.select("ID"), n).collect()]


def staged(table: DataFrame, n: int = 10) -> str:
    """Write the table with a flag ``_lost`` for its last n rows, by flag; gives the path.

    The rows that remain can then be read, and read again, without the table. Rows without an id stay.
    """
    spark = table.sparkSession
    path = scratch_path(spark, "replay-table")
    lost = F.coalesce(F.col("ID").isin(last_ids(table, n)), F.lit(False))
    table.withColumn("_lost", lost).write.partitionBy("_lost").parquet(path)
    return path


def _stored(table: DataFrame, path: str) -> DataFrame:
    schema = StructType([*table.schema.fields, StructField("_lost", BooleanType())])
    return table.sparkSession.read.schema(schema).parquet(path)


def restored(source: DataFrame, remaining: DataFrame, settings: Settings) -> DataFrame:
    """Rows of the source's overlapping slice that the remaining table lacks."""
    fetched = incremental_slice(source, remaining, settings)
    return absent_rows(fetched, remaining, ["ID"], ["event_time"])


def replay(source: DataFrame, table: DataFrame, settings: Settings, n: int = 10) -> DataFrame:
    """Table after losing its last n rows and taking in the source's overlapping slice again.

    The table is read twice, once for the ids alone, and the source once.
    """
    remaining = _stored(table, staged(table, n)).filter("NOT _lost").drop("_lost")
    return remaining.unionByName(restored(source, remaining, settings))


def replay_difference(
    source: DataFrame, table: DataFrame, settings: Settings, n: int = 10
) -> DataFrame:
    """Rows lost and rows gained by the replay; both are 0 when it restored the table.

    Of table and source no more is read than :func:`replay` does: the table's rows, the lost ones
    among them, are compared from where they were written, and so are the rows that come back.
    """
    spark = table.sparkSession
    whole = _stored(table, staged(table, n))
    remaining = whole.filter("NOT _lost").drop("_lost")
    path = scratch_path(spark, "replay-rebuilt")
    restored(source, remaining, settings).write.parquet(path)
    rebuilt = remaining.unionByName(spark.read.schema(table.schema).parquet(path))

    def copies(side: str):
        return F.coalesce(F.sum(F.when(F.col("side") == side, F.col("copies"))), F.lit(0))

    return difference(whole.drop("_lost"), rebuilt).agg(
        copies("left").alias("missing"), copies("right").alias("unexpected")
    )
