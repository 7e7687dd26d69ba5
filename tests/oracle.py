"""Running a named query and its SQL, and comparing the rows."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connected(folder: str) -> duckdb.DuckDBPyConnection:
    """DuckDB in this process with every table of ``folder`` as a view."""
    connection = duckdb.connect()
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _comparable(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def _sorted_rows(columns: list[str], rows) -> list[tuple]:
    places = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(_comparable(row[i]) for i in places) for row in rows]
    return sorted(picked, key=lambda row: tuple((v is not None, str(v)) for v in row))


def spark_rows(frame) -> tuple[list[str], list[tuple]]:
    """Sorted column names and rows of a DataFrame."""
    return sorted(frame.columns), _sorted_rows(frame.columns, frame.collect())


def oracle_rows(connection, sql: str) -> tuple[list[str], list[tuple]]:
    """Sorted column names and rows of a SQL result."""
    result = connection.execute(sql)
    columns = [c[0] for c in result.description]
    return sorted(columns), _sorted_rows(columns, result.fetchall())
