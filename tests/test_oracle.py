"""Every registered query against its SQL counterpart, over whole tables."""

import pytest

import __spark_entry__ as entry_module
from tests.oracle import connect, spark_rows, spark_types, sql_rows, sql_types

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables():
    connection = connect(SF_DIR)
    yield connection
    connection.close()


def test_every_query_has_sql():
    assert entry_module.own_queries().keys() == entry_module.own_sql().keys()


@pytest.mark.parametrize("name", sorted(entry_module.own_queries()))
def test_query_matches_sql(spark, tables, name):
    df = entry_module.own_queries()[name](spark, SF_DIR)
    assert spark_types(df) == sql_types(tables, entry_module.own_sql()[name])
    names, rows = spark_rows(df)
    expected_names, expected = sql_rows(tables, entry_module.own_sql()[name])
    assert names == expected_names
    assert len(rows) == len(expected)
    assert rows == expected


def test_entry(spark):
    rows = entry_module.entry(spark).collect()
    assert {row["lang"] for row in rows} == {"de", "en", "es", "fr"}
    assert sum(row["n_documents"] for row in rows) == 200
