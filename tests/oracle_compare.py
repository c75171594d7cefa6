"""Row-for-row comparison of a registered query with its SQL."""

from __future__ import annotations

import datetime as dt
import math

import duckdb

TABLES = ("events",)


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'"
        )
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return repr(value)


def canonical(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    body = sorted(tuple(_plain(row[i]) for i in order) for row in rows)
    return [columns[i] for i in order], body


def spark_rows(df):
    return canonical(df.columns, df.collect())


def duck_rows(connection, sql: str):
    result = connection.execute(sql)
    return canonical([d[0] for d in result.description], result.fetchall())
