"""Every named query against its SQL twin in DuckDB."""

import pytest

import __spark_entry__ as entry
from loamline.demo import catalog
from tests.compare import differences, duck
from tests.conftest import SF

QUERIES, STATEMENTS = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_sensor_query_has_sql():
    assert set(catalog.queries()) <= set(STATEMENTS) <= set(QUERIES)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in STATEMENTS])
def test_query(spark, con, name):
    problem, rows = differences(spark, con, SF, QUERIES[name], STATEMENTS[name])
    assert problem is None
    assert rows > 0


def test_entry(spark):
    status = entry.entry(spark)
    assert status.count() > 0
    assert "irrigation_needed" in status.columns
