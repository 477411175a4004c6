"""Parquet sinks. Each write is one job that also counts its rows; load times are stamped here,
so that everything upstream stays deterministic."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from loamline.operators.keyed import absent_rows, first_per_key, without_key
from loamline import storage, versions
from loamline.schemas import require_types
from loamline.sources.incremental import read_if_exists


class Ingested(NamedTuple):
    """What an ingest step did with its rows."""

    added: int
    rejected: int


def stamp(df: DataFrame, *names: str) -> DataFrame:
    """Add load metadata: ``…_at`` is the current time, ``…_date`` its day."""
    now = F.current_timestamp()
    return df.withColumns({n: F.to_date(now) if n.endswith("_date") else now for n in names})


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    stamps: Sequence[str] = (),
    single_file: bool = False,
    partition_overwrite: str = "static",
) -> int:
    """Write and return the number of rows written, taken from the write itself.

    ``single_file`` is for small tables that others read as one file. The rows are worked out in
    parallel and only then meet in one task.
    """
    counted = Observation()
    out = stamp(df, *stamps).observe(counted, F.count(F.lit(1)).alias("rows"))
    if single_file:
        out = out.repartition(1)
    writer = out.write.mode(mode).option("partitionOverwriteMode", partition_overwrite)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return storage.rows_of(counted)


def replace_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), stamps: Sequence[str] = ()
) -> int:
    """Replace a table as a whole or not at all (:mod:`loamline.versions`); returns the rows written."""
    return versions.replace_table(stamp(df, *stamps), path, partition_by)


def append_rows(df: DataFrame, path: str, stamps: Sequence[str] = ()) -> int:
    return write_table(df, path, mode="append", stamps=stamps)


def replace_partitions(
    df: DataFrame, path: str, partition_by: Sequence[str], stamps: Sequence[str] = ()
) -> int:
    """Overwrite only the partitions that occur in ``df``; in one commit where the table has versions.

    The rows may then come from the table itself; otherwise they must be written elsewhere before.
    """
    if versions.is_versioned(df.sparkSession, path):
        return versions.replace_version_partitions(stamp(df, *stamps), path, partition_by)
    return write_table(
        df, path, partition_by=partition_by, stamps=stamps, partition_overwrite="dynamic"
    )


def set_aside(df: DataFrame, reason: Column, source: Column) -> DataFrame:
    """Rows in the form of a table of rejects: reason, the row as JSON, source, and a key of both."""
    record = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))
    out = df.select(reason.alias("reason"), record.alias("record"), source.cast("string").alias("source"))
    return out.withColumn("digest", F.sha2(F.concat_ws("|", "reason", "record"), 256))


def rejects_path(path: str) -> str:
    """Where the rows lie that were not added to the table at ``path``."""
    return f"{path.rstrip('/')}_rejects"


def store_rejects(rejects: DataFrame, path: str) -> int:
    """Add rejects that are not there yet; returns how many rows of this delivery were rejected."""
    seen = Observation()
    counted = rejects.observe(seen, F.count(F.lit(1)).alias("rows"))
    existing = read_if_exists(rejects.sparkSession, rejects_path(path))
    rows = (
        first_per_key(counted, ["digest"])
        if existing is None
        else absent_rows(counted, existing, ["digest"])
    )
    write_table(rows, rejects_path(path), mode="append", stamps=("rejected_at",))
    return storage.rows_of(seen)


def bucket_column(buckets: int) -> str:
    """The partition column of a table in so many key buckets; another number is another column."""
    return f"key_bucket_{buckets}"


def in_buckets(rows: DataFrame, key: Sequence[str], buckets: int) -> DataFrame:
    """Rows with the bucket of their key."""
    bucket = F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")
    return rows.withColumn(bucket_column(buckets), bucket)


def pruned(existing: DataFrame, new: DataFrame, part: str) -> DataFrame:
    """The partitions of a stored table that occur in ``new``; their list reaches the scan.

    It has as many values as ``new`` has calendar days, or as the table has buckets at most.
    """
    if part not in existing.columns:
        raise ValueError(f"the stored table is not partitioned by {part}")
    values = [r[0] for r in new.select(part).distinct().collect()]
    return existing.filter(F.col(part).isin(values))


def append_absent(
    new: DataFrame,
    path: str,
    key: Sequence[str],
    order: Sequence[str] = (),
    stamps: Sequence[str] = (),
    day: str | None = None,
    rejects: DataFrame | None = None,
    buckets: int | None = None,
) -> Ingested:
    """Append the rows whose key the table does not hold yet; returns how many were added.

    Running it again with the same rows adds nothing. One writer at a time; of two writers to a table
    with versions the second one fails. Rows without a key, and the ``rejects`` of earlier steps, go to
    a table beside this one (:func:`rejects_path`).

    With ``day`` the table is partitioned by that date column, and keys are looked up in the days of
    ``new`` only, so that the cost follows the delivery and not the history. That is exact as long as
    a key keeps its day. With ``buckets`` it is partitioned by a hash of the key into so many buckets,
    and keys are looked up in the buckets of ``new`` only, which is always exact and reads little for
    a small delivery. Without either every key of the table is looked up.
    """
    if day and buckets:
        raise ValueError("a table is partitioned by day or by key buckets, not by both")
    if buckets:
        new = in_buckets(new, key, buckets)
    part = bucket_column(buckets) if buckets else day
    existing = read_if_exists(new.sparkSession, path)
    if existing is not None:
        require_types(existing, new.schema, path)
        if part:
            existing = pruned(existing, new, part)
    rows = (
        first_per_key(new, key, order)
        if existing is None
        else absent_rows(new, existing, key, order)
    )
    aside = set_aside(without_key(new, key), F.lit("missing key"), F.lit(None))
    rejected = store_rejects(aside if rejects is None else rejects.unionByName(aside), path)
    partition_by = (part,) if part else ()
    if versions.is_versioned(new.sparkSession, path):
        added = versions.append_version(stamp(rows, *stamps), path, partition_by)
    else:
        added = write_table(rows, path, mode="append", stamps=stamps, partition_by=partition_by)
    return Ingested(added, rejected)
