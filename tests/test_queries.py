"""Every registered query against its SQL, over whole tables."""

import pytest

import __spark_entry__ as entry
from newsmart.bridge.queries import QUERIES
from compare import connect, difference, spark_rows, sql_rows

SF_DIR = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(SQL)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("key", list(QUERIES))
def test_query_equals_sql(spark, con, key):
    assert difference(spark_rows(QUERIES[key](spark, SF_DIR)), sql_rows(con, SQL[key])) == ""


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.columns == ["sqldate", "country", "language", "count"]
    assert df.limit(1).count() == 1
