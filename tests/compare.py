"""Run a registered query and its SQL and compare them as sets of rows."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def connect(root: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for file in sorted(Path(root).glob("*.parquet")):
        db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return db


def _value(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    return None if value is None else str(value)


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    made = [tuple(_value(row[i]) for i in order) for row in rows]
    return sorted(made, key=lambda r: tuple((v is None, v or "") for v in r))


def compare(spark, root: str, query, sql: str, db=None) -> str | None:
    """None when equal, else what differs."""
    df = query(spark, root)
    got = _rows(df.columns, df.collect())
    result = (db or connect(root)).execute(sql)
    names = [d[0] for d in result.description]
    kinds = [str(d[1]) for d in result.description]
    want = _rows(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(set(df.columns) ^ set(names))}"
    spark_kinds = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR"}
    for name, kind in df.dtypes:
        if spark_kinds.get(kind) != kinds[names.index(name)]:
            return f"type of {name}: {kind}, {kinds[names.index(name)]}"
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    columns = sorted(names)
    for a, b in zip(got, want):
        if a != b:
            return str({c: (x, y) for c, x, y in zip(columns, a, b) if x != y})
    return None
