"""The registered queries over whole tables, against SQL where there is some."""

import pytest

from leafmill.llm.queries import QUERIES, SQL
from tests.oracle import connect, spark_rows, spark_types, sql_rows, sql_types

SF_DIR = "/root/testdata/sf0.01"
ROWS = {"op2_warc": "pages", "op6_main_text": "pages"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    tables = connect(SF_DIR)
    df = QUERIES[name](spark, SF_DIR)
    assert spark_types(df) == sql_types(tables, SQL[name])
    assert spark_rows(df) == sql_rows(tables, SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op4_packing"} - set(SQL)))
def test_one_row_for_each_row(spark, name):
    table = spark.read.parquet(f"{SF_DIR}/{ROWS.get(name, 'documents')}.parquet")
    key = "page_id" if name in ROWS else "doc_id"
    found = QUERIES[name](spark, SF_DIR)
    assert sorted(r[0] for r in found.select(key).collect()) == sorted(
        r[0] for r in table.select(key).collect()
    )
