"""Every query with SQL against DuckDB over the smallest tables; the others must run with a stable schema."""

import os

import pytest

import __spark_entry__ as entry
from tests.compare import differences, tables

DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
CORE = entry.catalog.queries()
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return tables(DIR)


@pytest.mark.parametrize("name", sorted(CORE))
def test_query(spark, con, name):
    df = CORE[name](spark, DIR)
    sql = entry.catalog.oracle_sql().get(name)
    if sql:
        assert differences(df, con, sql) == ""
    else:
        assert df.count() >= 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
