"""SQL over the loaded tables."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession

Params = Sequence[Any] | Mapping[str, Any] | None


def run_query(spark: SparkSession, sql: str, params: Params = None) -> DataFrame:
    """Run a SQL statement; ``?`` markers take a list, ``:name`` markers a mapping."""
    if not params:
        return spark.sql(sql)
    return spark.sql(sql, args=dict(params) if isinstance(params, Mapping) else list(params))


def iter_records(
    spark: SparkSession, sql: str, params: Params = None
) -> Iterator[dict[str, Any]]:
    """Rows of a query as dictionaries, fetched one partition at a time."""
    for row in run_query(spark, sql, params).toLocalIterator():
        yield row.asDict()


def fetch_records(
    spark: SparkSession, sql: str, params: Params = None, *, max_rows: int | None
) -> list[dict[str, Any]]:
    """All rows of a query as dictionaries; of two columns with one name the last counts.

    The caller says how many rows the driver can hold. A larger result is refused rather
    than cut (``iter_records`` reads those); None means any number.
    """
    result = run_query(spark, sql, params)
    rows = (result if max_rows is None else result.limit(max_rows + 1)).collect()
    if max_rows is not None and len(rows) > max_rows:
        raise ValueError(f"more than {max_rows} rows; use iter_records or raise max_rows")
    return [row.asDict() for row in rows]


def table_exists(spark: SparkSession, name: str) -> bool:
    """Whether a table or view of that name exists in the current schema."""
    return spark.catalog.tableExists(name)
