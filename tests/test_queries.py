"""Every SQL-checkable query equals DuckDB on the smallest given tables."""

import os

import duckdb
import pytest

from check_queries import normal
from cohortflow.registry.bindings import TABLES
from cohortflow.registry.catalog import ORACLES, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_duckdb(spark, duck, name):
    found = QUERIES[name](spark, SF)
    expected = duck.sql(ORACLES[name])
    assert sorted(found.columns) == sorted(expected.columns)
    assert normal(found.collect(), found.columns) == normal(expected.fetchall(), expected.columns)
