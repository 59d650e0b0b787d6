"""Row-by-row comparison of a query with its SQL twin (needs DuckDB)."""

from __future__ import annotations

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES.split():
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def normal(value):
    if value is None:
        return None
    if isinstance(value, bool) or hasattr(value, "isoformat"):
        return str(value)
    if isinstance(value, float):
        return value if math.isfinite(value) else str(value)
    if isinstance(value, int):
        return float(value)
    return str(value)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    values = [tuple(normal(row[i]) for i in order) for row in rows]
    return sorted(values, key=lambda t: tuple((v is None, str(v)) for v in t))


def compare(con, spark, folder, name, run, sql) -> str | None:
    """None when both sides agree, else a short account of the difference."""
    frame = run(spark, folder)
    rows = frame.collect()
    if sql is None:
        return None
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    if sorted(columns) != sorted(frame.columns):
        return f"columns {set(columns) ^ set(frame.columns)}"
    if len(rows) != len(expected):
        return f"rows {len(rows)} against {len(expected)}"
    mine, theirs = canonical(frame.columns, rows), canonical(columns, expected)
    if mine != theirs:
        wrong = [(a, b) for a, b in zip(mine, theirs) if a != b]
        names = sorted(columns)
        pair = [(n, x, y) for n, x, y in zip(names, *wrong[0]) if x != y]
        return f"{len(wrong)} of {len(mine)} rows differ, first {pair}"
    return None
