"""Tables that are replaced as a whole: versioned folders and a small commit file.

A write puts its files into a folder of its own, ``version=N``, beside those of earlier versions. Only
when it has ended does a commit file say which folders make up the table; it is written last and read
first. A failed write leaves a folder that no commit names, and the table stays what it was. A reader
takes the newest commit once and sees that version to its end, whatever is written meanwhile. Two
writers cannot make the same commit: the second one fails.

Commits lie in ``_commits``, numbered. One names folders relative to the table: whole versions, or
single partitions where only some were replaced, so that nothing is copied. The ``keep`` newest
commits and the folders they name stay; older ones are deleted after a commit. Readers that may run
longer than ``keep`` writes need a higher number.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loamline import storage

COMMITS = "_commits"
VERSION = "version"
KEEP = 2


class CommitConflict(RuntimeError):
    """Another writer has changed the table since this one began."""


def commits(spark: SparkSession, path: str) -> list[int]:
    return [int(n.removesuffix(".json")) for n in storage.names_in(spark, f"{path}/{COMMITS}") if n.endswith(".json")]


def is_versioned(spark: SparkSession, path: str) -> bool:
    return bool(commits(spark, path))


def folders_of(spark: SparkSession, path: str, commit: int) -> list[str]:
    """The folders, relative to the table, that make up a commit."""
    return json.loads(storage.read_text(spark, f"{path}/{COMMITS}/{commit:010d}.json"))["folders"]


def read_version(
    spark: SparkSession, path: str, schema: StructType | None = None, commit: int | None = None
) -> DataFrame:
    """The table as of its newest commit, or as of another one that is still kept."""
    known = commits(spark, path)
    if not known:
        raise AnalysisException(f"no version of {path} has been committed")
    at = known[-1] if commit is None else commit
    return _rows(spark, path, folders_of(spark, path, at), schema or _schema(spark, path, at))


def _rows(spark: SparkSession, path: str, folders: Sequence[str], schema: StructType) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], schema)
    places = [f"{path}/{folder}" for folder in folders]
    rows = spark.read.schema(schema).option("basePath", path).parquet(*places)
    return rows.select(*[F.col(f"`{f.name}`") for f in schema])


def _schema(spark: SparkSession, path: str, commit: int) -> StructType:
    text = storage.read_text(spark, f"{path}/{COMMITS}/{commit:010d}.json")
    return StructType.fromJson(json.loads(text)["schema"])


def _commit(
    spark: SparkSession,
    path: str,
    base: int,
    folders: Sequence[str],
    schema: StructType,
    keep: int,
) -> None:
    text = json.dumps({"folders": list(folders), "schema": schema.jsonValue()})
    if not storage.create_text(spark, f"{path}/{COMMITS}/{base + 1:010d}.json", text):
        raise CommitConflict(f"{path} was changed by another writer; this write is left out")
    _clean(spark, path, keep)


def _clean(spark: SparkSession, path: str, keep: int) -> None:
    """Delete commits beyond the newest ``keep``, and folders older than these that none of them names."""
    known = commits(spark, path)
    kept = known[-keep:]
    named = {folder for at in kept for folder in folders_of(spark, path, at)}
    versions = {folder.split("/")[0] for folder in named}
    for at in known[:-keep]:
        for folder in folders_of(spark, path, at):
            if folder not in named and folder.split("/")[0] not in named:
                storage.discard(spark, f"{path}/{folder}")
        storage.discard(spark, f"{path}/{COMMITS}/{at:010d}.json")
    # What failed writes left: folders of commits before the kept ones that none of those names.
    for name in storage.names_in(spark, path):
        if name.startswith(f"{VERSION}=") and name not in versions and _number(name) <= kept[0]:
            storage.discard(spark, f"{path}/{name}")


def _number(folder: str) -> int:
    return int(folder.split("=")[1].split("-")[0])


def _write(
    df: DataFrame, path: str, partition_by: Sequence[str], change: Callable[[list[str], list[str]], list[str]], keep: int
) -> int:
    """Write the rows as a new folder; ``change`` makes the folders after from those before and the new ones."""
    spark = df.sparkSession
    known = commits(spark, path)
    base = known[-1] if known else 0
    before = folders_of(spark, path, base) if known else []
    own = f"{VERSION}={base + 1:010d}-{uuid.uuid4().hex}"
    counted = Observation()
    writer = df.observe(counted, F.count(F.lit(1)).alias("rows")).write
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{path}/{own}")
    fresh = _partitions(spark, f"{path}/{own}", own, len(partition_by)) if partition_by else [own]
    _commit(spark, path, base, change(before, fresh), df.schema, keep)
    return storage.rows_of(counted)


def _partitions(spark: SparkSession, place: str, name: str, depth: int) -> list[str]:
    """The partitions below a folder, as paths relative to the table."""
    if depth == 0:
        return [name]
    inner = [n for n in storage.names_in(spark, place) if "=" in n]
    return [p for n in inner for p in _partitions(spark, f"{place}/{n}", f"{name}/{n}", depth - 1)]


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), keep: int = KEEP) -> int:
    """Make the rows the table, whole or not at all; returns their number.

    The old version may be read while this runs, by the job itself too.
    """
    return _write(df, path, partition_by, lambda before, fresh: fresh, keep)


def replace_version_partitions(df: DataFrame, path: str, partition_by: Sequence[str], keep: int = KEEP) -> int:
    """Replace the partitions that occur in ``df``; the commit names the others where they are."""

    def change(before: list[str], fresh: list[str]) -> list[str]:
        new = {folder.split("/", 1)[1] for folder in fresh}
        return [f for f in before if f.split("/", 1)[1] not in new] + fresh

    return _write(df, path, partition_by, change, keep)


def append_version(df: DataFrame, path: str, partition_by: Sequence[str] = (), keep: int = KEEP) -> int:
    """Add rows in one commit."""
    return _write(df, path, partition_by, lambda before, fresh: before + fresh, keep)
