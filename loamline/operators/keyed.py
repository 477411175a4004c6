"""Keyed insert, delete and comparison over tables without an index."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loamline.functions import row_digest


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key: the first by ``order``, then by all other columns.

    Rows without a key are not part of the result; see :func:`without_key`. Spark keeps only the
    first row of a key before it shuffles, so a key with many copies does not pile up.
    """
    rest = [c for c in df.columns if c not in key and c not in order]
    ranked = Window.partitionBy(*key).orderBy(*order, *rest)
    return (
        df.dropna(subset=list(key))
        .withColumn("_rank", F.row_number().over(ranked))
        .filter("_rank = 1")
        .drop("_rank")
    )


def without_key(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """The rows that keyed operations cannot place, because a part of their key is NULL."""
    return df.filter(reduce(or_, [F.col(c).isNull() for c in key]))


def absent_rows(
    new: DataFrame, existing: DataFrame, key: Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """The rows of ``new`` that an insert-if-absent adds to ``existing``.

    The existing table may be huge and the batch small, so the table is first reduced to the keys
    the batch mentions. In that semi join the batch is the side Spark may broadcast, which leaves
    the table unshuffled; beyond the broadcast limit it becomes a sort-merge join.
    """
    key = list(key)
    known = existing.select(*key).join(new.select(*key), key, "left_semi").distinct()
    return first_per_key(new, key, order).join(known, key, "left_anti")


def insert_if_absent(
    existing: DataFrame, new: DataFrame, key: Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    return existing.unionByName(absent_rows(new, existing, key, order))


def delete_keys(df: DataFrame, keys: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.join(keys.select(*key), list(key), "left_anti")


def matching_rows(df: DataFrame, keys: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.join(keys.select(*key), list(key), "left_semi")


def bucket_sums(rows: DataFrame, buckets: int) -> DataFrame:
    """Per bucket of row digests their number and sums, all that a comparison needs at first.

    Digests are added up in quarters, so sums stay exact; equal sums of 128-bit digests mean equal rows.
    """
    high, low = row_digest(rows.columns)
    quarters = {
        f"_{side}{part}": F.shiftrightunsigned(half, shift).bitwiseAND(F.lit(0xFFFFFFFF))
        for side, half in (("high", high), ("low", low))
        for part, shift in (("a", 32), ("b", 0))
    }
    return (
        rows.select(F.pmod(high, F.lit(buckets)).alias("_bucket"), *[q.alias(n) for n, q in quarters.items()])
        .groupBy("_bucket")
        .agg(F.count("*").alias("_rows"), *[F.sum(n).alias(n) for n in quarters])
    )


def unequal_buckets(left: DataFrame, right: DataFrame, buckets: int) -> DataFrame:
    """The buckets in which both sides' sums differ, at most as many as there are buckets."""
    sides = [bucket_sums(side, buckets) for side in (left, right)]
    sums = [c for c in sides[0].columns if c != "_bucket"]
    signed = sides[0].unionByName(sides[1].select("_bucket", *[(-F.col(c)).alias(c) for c in sums]))
    return (
        signed.groupBy("_bucket")
        .agg(*[F.sum(c).alias(c) for c in sums])
        .filter(reduce(or_, [F.col(c) != 0 for c in sums]))
        .select("_bucket")
    )


def difference(left: DataFrame, right: DataFrame, buckets: int = 4096) -> DataFrame:
    """Rows that one side has more often than the other, with that side and how many more; empty
    when both hold the same rows.

    Both sides are first compared by sums of row digests in a fixed number of buckets, which needs no
    shuffle of rows. Only rows of unequal buckets are then grouped and compared themselves. The list of
    unequal buckets is broadcast; it holds ``buckets`` numbers at most.
    """
    columns = left.columns
    right = right.select(*columns)
    apart = F.broadcast(unequal_buckets(left, right, buckets))

    def suspect(side: DataFrame, sign: int) -> DataFrame:
        bucket = F.pmod(row_digest(columns)[0], F.lit(buckets))
        marked = side.withColumn("_bucket", bucket).join(apart, "_bucket", "left_semi")
        return marked.drop("_bucket").withColumn("_n", F.lit(sign))

    return (
        suspect(left, 1)
        .unionByName(suspect(right, -1))
        .groupBy(*columns)
        .agg(F.sum("_n").alias("_n"))
        .filter("_n <> 0")
        .select(
            *columns,
            F.when(F.col("_n") > 0, "left").otherwise("right").alias("side"),
            F.abs("_n").alias("copies"),
        )
    )
