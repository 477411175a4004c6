"""Parquet and CSV readers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from loamline.schemas import WEATHER_CSV
from loamline.versions import is_versioned, read_version


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Parquet with the schema stored in it, or with a declared one; of a versioned table its newest version."""
    if is_versioned(spark, path):
        return read_version(spark, path, schema)
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def read_weather_csv(spark: SparkSession, path: str, feed: str) -> DataFrame:
    """A ``rainfall``, ``temperature`` or ``solar`` file. Columns are taken by position; a cell that
    does not fit its type is NULL."""
    return spark.read.schema(WEATHER_CSV[feed]).option("header", True).csv(path)


def weather_text(spark: SparkSession, path: str | list[str], feed: str) -> DataFrame:
    """A weather file with every cell as text, ``_line`` (the line as it stands in the file, where its cells
    are not as many as the columns) and ``_file``."""
    columns = [StructField(f.name, StringType()) for f in WEATHER_CSV[feed]]
    schema = StructType([*columns, StructField("_line", StringType())])
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("columnNameOfCorruptRecord", "_line")
        .csv(path)
        .withColumn("_file", F.col("_metadata.file_path"))
    )


def _typed(field: StructField) -> Column:
    """A text cell in its type, NULL where it does not fit."""
    if field.dataType == StringType():
        return F.col(field.name)
    return F.trim(field.name).try_cast(field.dataType).alias(field.name)


def weather_from_text(text: DataFrame, feed: str) -> tuple[DataFrame, DataFrame]:
    """The rows of a weather file in their types, and what did not fit.

    The first has the columns of :func:`read_weather_csv`, NULL where a cell does not fit. The second has
    one row for each line with too few or too many cells (``column`` is NULL), and one for each cell
    that is no value of its column: reason, column, cell, line (all cells of the row, or the raw line), file.
    """
    schema = WEATHER_CSV[feed]
    typed = text.select(*[_typed(f) for f in schema])
    cells = [
        F.when(
            (F.trim(f.name) != "") & _typed(f).isNull(),
            F.struct(
                F.lit(f"not {f.dataType.simpleString()}").alias("reason"),
                F.lit(f.name).alias("column"),
                F.col(f.name).alias("cell"),
            ),
        )
        for f in schema
        if f.dataType != StringType()
    ]
    nothing = F.lit(None).cast("string")
    broken = F.when(
        F.col("_line").isNotNull(),
        F.struct(F.lit("malformed line").alias("reason"), nothing.alias("column"), nothing.alias("cell")),
    )
    whole = F.coalesce("_line", F.concat_ws(",", *[F.coalesce(f.name, F.lit("")) for f in schema]))
    aside = text.select(
        F.explode(F.array_compact(F.array(broken, *cells))).alias("what"), whole.alias("line"), F.col("_file").alias("file")
    )
    return typed, aside.select("what.*", "line", "file")


def read_sites_csv(spark: SparkSession, path: str) -> DataFrame:
    """Site list as text, with headers and cells trimmed and empty cells NULL.

    ``_file``, ``_block`` and ``_line`` tell the order of rows, in whatever order files are read.
    """
    raw = spark.read.option("header", True).csv(path)
    cells = {c: c.strip().lstrip("﻿").lower() for c in raw.columns}
    return raw.select(
        *[F.nullif(F.trim(F.col(f"`{c}`")), F.lit("")).alias(name) for c, name in cells.items()],
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"),
    )
