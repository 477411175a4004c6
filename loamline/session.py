"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from loamline.storage import discard

# AQE sizes reduce tasks from what was really shuffled, turns a join into a broadcast when the side
# it measured is small, and splits skewed join partitions. No master and no fixed shuffle width:
# both belong to whoever launches the job.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Without a stack trace per column expression, wide plans build noticeably faster.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_spark(app_name: str = "loamline", **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**DEFAULTS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_LOCAL: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """This application's folder for intermediate tables, below the one named by ``spark.checkpoint.dir``.

    Executors must see it, so a machine-local folder is only made up in local mode.
    """
    root, application = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext.applicationId
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        if application not in _LOCAL:
            _LOCAL[application] = tempfile.mkdtemp(prefix="loamline-")
        root = _LOCAL[application]
    return f"{root.rstrip('/')}/loamline-{application}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for an intermediate table. Results may read it until :func:`clear_scratch`."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete all intermediate tables of this application; for when its last result has been read.

    The commands do so when a step has ended. A job that calls operators itself does it last; what an
    application that was lost has left lies in the folder that bears its id.
    """
    discard(spark, scratch_root(spark))


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows, written to the scratch folder once and read from there however often they are used."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship_library(spark: SparkSession) -> None:
    """Hand this package to the Python workers, once per application.

    Spark serves the file from the driver, so workers need neither a path nor a copy of their own.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="loamline-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)
