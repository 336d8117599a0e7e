"""Every registered query against its SQL on the smallest shared tables."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import compare  # noqa: E402
import __spark_entry__ as entry  # noqa: E402
from recordlens.plans.stores import ORACLE, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="shared test tables not present")


@pytest.fixture(scope="module")
def connection():
    connection = duckdb.connect()
    for name in compare.TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    line = compare.compare(spark, SF, name, entry.queries()[name], entry.oracle_sql().get(name), connection)
    assert line.startswith("ok"), line


def test_entry(spark):
    assert [r.band for r in entry.entry(spark).orderBy("position").collect()] == ["red", "orange", "yellow", "green"]
