"""Files of tables through Spark's own file systems, so that any path a reader opens works here too."""

from __future__ import annotations

import uuid
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import Observation, SparkSession


def rows_of(counted: Observation) -> int:
    """The observed ``rows``. Where the optimizer saw that there are none, nothing is observed at all."""
    try:
        return counted.get["rows"]
    except Py4JJavaError as err:
        if "AssertionError" in str(err):
            return 0
        raise


def _open(spark: SparkSession, path: str) -> tuple[Any, Any]:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder in order; none where there is no such folder."""
    files, target = _open(spark, path)
    if not files.exists(target):
        return []
    return sorted(entry.getPath().getName() for entry in files.listStatus(target))


def exists(spark: SparkSession, path: str) -> bool:
    files, target = _open(spark, path)
    return files.exists(target)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, if it is there."""
    files, target = _open(spark, path)
    files.delete(target, True)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as text."""
    files, target = _open(spark, path)
    stream = files.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file with all of its text at once; False when the name is taken.

    The text is written under another name first and then renamed, so nobody reads half of it.
    """
    files, target = _open(spark, path)
    files.mkdirs(target.getParent())
    part = spark._jvm.org.apache.hadoop.fs.Path(f"{target.getParent()}/.{target.getName()}-{uuid.uuid4().hex}")
    stream = files.create(part, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if files.exists(target) or not files.rename(part, target):
        files.delete(part, False)
        return False
    return True
