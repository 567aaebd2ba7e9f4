"""Every registered query gives the rows of its SQL."""

import duckdb
import pytest

import __spark_entry__ as entry
from finmart import catalog
from finmart.catalog.base import TABLES
from tests.compare import assert_same

FOLDER = "/root/testdata/sf0.001"
QUERIES = catalog.QUERIES
# no supplier of this scale is in the state asked for
MAY_BE_EMPTY = {"filter_eq"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(catalog.SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    assert_same(QUERIES[name](spark, FOLDER), duck.sql(catalog.SQL[name]), name in MAY_BE_EMPTY)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
