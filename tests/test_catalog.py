"""Every catalogue query against DuckDB, on the smallest tables."""

import pytest
from compare import connect, differences

import __spark_entry__ as entry
from tidemark.catalog.queries import QUERIES
from tidemark.catalog.sql import ORACLE

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(SF)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert QUERIES.items() <= entry.queries().items()
    assert ORACLE.items() <= entry.oracle_sql().items()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, db, name):
    assert differences(QUERIES[name](spark, SF), db, ORACLE[name]) == ""


def test_entry_has_rows_and_a_stable_schema(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["business_date", "destination"]
    assert df.count() == 75
