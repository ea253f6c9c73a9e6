"""Compare a registered query with its SQL counterpart."""

from __future__ import annotations

import datetime
import decimal
import math
from pathlib import Path

import duckdb


def _plain(value):
    if isinstance(value, decimal.Decimal):
        value = int(value) if value == value.to_integral_value() else float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 6))
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    if value is None:
        return "\0null"
    return str(value)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


def sql_types(connection, sql: str) -> dict[str, str]:
    return {row[0]: row[1] for row in connection.execute(f"DESCRIBE {sql}").fetchall()}


def spark_types(df) -> dict[str, str]:
    return {name: TYPES[dtype] for name, dtype in df.dtypes}


def sql_rows(connection, sql: str) -> tuple[list[str], list[tuple]]:
    result = connection.execute(sql)
    return _ordered([column[0] for column in result.description], result.fetchall())


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return _ordered(df.columns, [tuple(row) for row in df.collect()])


def _ordered(names: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=names.__getitem__)
    return [names[i] for i in order], sorted(tuple(_plain(row[i]) for i in order) for row in rows)
