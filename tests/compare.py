"""Comparison of a Spark result with the DuckDB result of its SQL twin."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def duckdb_on(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.12g}"
    return str(value)


def canonical(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    """Columns by name, rows in a fixed order, values as text."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def spark_result(df):
    return canonical(df.columns, df.collect())


def duckdb_result(connection, sql: str):
    found = connection.execute(sql)
    return canonical([d[0] for d in found.description], found.fetchall())
