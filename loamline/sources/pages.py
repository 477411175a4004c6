"""Landed response pages: JSON documents ``{"results": [record, …], "total_count": n}``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from loamline.schemas import SOIL_RECORD


# What a text that holds an object, or a list of them, begins with.
BEGINS = r"^[\s\uFEFF]*[{\[]"


def page_schema(record: StructType) -> StructType:
    return StructType([StructField("results", ArrayType(record))]).add("total_count", "long")


def page_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Landed files as lines with the file they come from."""
    return with_place(spark.read.text(path))


def with_place(text: DataFrame) -> DataFrame:
    return text.select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )


def readable(page: Column) -> Column:
    return page["results"].isNotNull() | page["total_count"].isNotNull()


def landed_pages(
    lines: DataFrame,
    record: StructType = SOIL_RECORD,
    keep: Callable[[DataFrame, str], DataFrame] | None = None,
) -> DataFrame:
    """One row per page: file, text and ``page``, NULL fields in the latter where it is unreadable.

    A file may hold one page per line, or one page over many lines. It counts as the latter when
    none of its lines is a page by itself; then its lines are put together again, which gathers no
    more than one such file. Blank lines are no pages. ``text`` is NULL where ``page`` says it all.

    ``keep`` may write the parsed lines somewhere and read them again (:func:`loamline.session.stored`).
    They are then parsed once, however often the pages are used.
    """
    schema = page_schema(record)

    def parsed(text: str) -> Column:
        return F.from_json(F.col(text), schema, {"mode": "PERMISSIVE"})

    # Most lines of a page over many lines are none by themselves, which is told far faster by how they
    # begin than by parsing them.
    nothing = F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])
    page = F.col("page")
    numbered = (
        lines.filter(F.trim("value") != "")
        .withColumn("line", F.monotonically_increasing_id())
        .withColumn("page", F.when(F.col("value").rlike(BEGINS), parsed("value")).otherwise(nothing))
        .withColumn("value", F.when(~readable(page), F.col("value")))
    )
    if keep:
        numbered = keep(numbered, "parsed-lines")
    kinds = numbered.groupBy("file").agg(F.max(readable(page)).alias("_by_line"))
    known = numbered.join(kinds, "file")
    by_line = known.filter("_by_line").select("file", F.col("value").alias("text"), "page")
    whole = (
        known.filter("NOT _by_line")
        .groupBy("file")
        .agg(F.sort_array(F.collect_list(F.struct("block", "line", "value"))).alias("_lines"))
        .select("file", F.array_join(F.col("_lines.value"), "\n").alias("text"))
        .withColumn("page", parsed("text"))
    )
    return by_line.unionByName(whole)


def records(pages: DataFrame) -> DataFrame:
    """One row per record of readable pages, with the file; pages without records give none."""
    return pages.select("file", F.explode("page.results").alias("_record")).select("file", "_record.*")


def unreadable(pages: DataFrame) -> DataFrame:
    return pages.filter(~readable(F.col("page")))


def incomplete(pages: DataFrame) -> DataFrame:
    """Deliveries that hold fewer records than their pages say there are: total_count, records.

    Pages of one request name the same total, so pages are counted together by it.
    """
    return (
        pages.filter(F.col("page.total_count").isNotNull())
        .groupBy(F.col("page.total_count").alias("total_count"))
        .agg(
            F.sum(F.coalesce(F.size("page.results"), F.lit(0))).alias("records"),
            F.min("file").alias("file"),
        )
        .filter("records < total_count")
    )


def read_pages(
    spark: SparkSession, path: str | list[str], record: StructType = SOIL_RECORD
) -> DataFrame:
    """Records of all readable pages under one or more paths, one page per line or per file."""
    return records(landed_pages(page_lines(spark, path), record)).drop("file")
