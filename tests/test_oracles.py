"""Every query against its SQL in DuckDB, value by value and type by type."""

import pytest

import __spark_entry__ as entry_module
from curbline import registry
from conftest import DATA
from oracle import connect, duck_rows, spark_rows, type_mismatches

SF = str(DATA / "sf0.01")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_an_oracle():
    assert registry.QUERIES.keys() == registry.oracle_sql().keys()
    assert registry.QUERIES.keys() <= entry_module.queries().keys()
    assert registry.oracle_sql().keys() <= entry_module.oracle_sql().keys()


@pytest.mark.parametrize("name", registry.QUERIES)
def test_query_equals_oracle(spark, con, name):
    df, sql = registry.QUERIES[name](spark, SF), registry.oracle_sql()[name]
    names, rows = spark_rows(df)
    duck_names, expected = duck_rows(con, sql)
    assert names == duck_names
    assert rows and len(rows) == len(expected)
    assert rows == expected
    assert not type_mismatches(df, con, sql)


def test_entry_runs(spark):
    assert not entry_module.entry(spark).isEmpty()
