import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from loamline.config import Settings  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def settings():
    return Settings()


@pytest.fixture(scope="session")
def tables(spark):
    from loamline.demo.tables import Tables

    return Tables(spark, SF)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def same_rows(left, right) -> bool:
    right = right.select(*left.columns)
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()
