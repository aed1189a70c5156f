"""Every registered query against its SQL on the smallest data."""

import pytest
from check_sql import compare, connect

from __spark_entry__ import entry, oracle_sql, queries

SF_DIR = "/root/testdata/sf0.001"
QUERIES, SQL = queries(), oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, duck, name):
    assert compare(duck, name, QUERIES[name](spark, SF_DIR), SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["occupation", "avg_hours"] and df.count() == 6
