"""Every registered query against its SQL on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from ledgerloom.catalog import registry
from tools.check_queries import normal

SF = Path("/root/testdata/sf0.001")
# Those of the library itself; tests/llm has its own.
NAMES = sorted(registry.QUERIES)

pytestmark = pytest.mark.skipif(not SF.exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for file in SF.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_every_query_has_sql():
    assert set(NAMES) == set(registry.ORACLE) and set(NAMES) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, db, name):
    got = normal(entry.queries()[name](spark, str(SF)).toPandas())
    expected = normal(db.sql(entry.oracle_sql()[name]).df())
    assert list(got.columns) == list(expected.columns)
    assert len(got) > 0
    assert got.equals(expected)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
