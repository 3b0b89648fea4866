"""Run registered queries against their SQL counterparts on the given tables."""

from __future__ import annotations

import math
from datetime import date, datetime

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def sql_engine(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def _cell(value):
    if isinstance(value, datetime):
        return value.date().isoformat() if value.time() == datetime.min.time() else value.isoformat()
    if isinstance(value, date):
        return value.isoformat()
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else round(value, 6) + 0.0
    return value


def normal(columns, rows):
    """Columns by name, rows in a fixed order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = [tuple(_cell(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(cells, key=repr)


def spark_result(df):
    return normal(df.columns, df.collect())


def sql_result(connection, text):
    cursor = connection.execute(text)
    return normal([c[0] for c in cursor.description], cursor.fetchall())
