"""Compare a query with its SQL, run by DuckDB on the same tables."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def sql_rows(connection, sql: str) -> tuple[list[str], list[tuple]]:
    cursor = connection.execute(sql)
    return [d[0] for d in cursor.description], cursor.fetchall()


def difference(frame, connection, sql: str) -> str | None:
    """What differs between a frame and the result of a statement, if anything."""
    columns, rows = sql_rows(connection, sql)
    if sorted(columns) != sorted(frame.columns):
        return f"columns {frame.columns} and {columns}"
    ours, theirs = bag(frame.columns, frame.collect()), bag(columns, rows)
    if ours == theirs:
        return None
    extra, missing = list((ours - theirs).items())[:3], list((theirs - ours).items())[:3]
    return f"{sum(ours.values())} and {sum(theirs.values())} rows; only ours {extra}; only theirs {missing}"
