"""Compare a Spark result with its SQL twin in DuckDB."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{Path(folder) / name}.parquet'")
    return con


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, Decimal):
        return ("decimal", str(value))
    if isinstance(value, list):
        return tuple(normal(v) for v in value)
    return value


def rows(table) -> tuple[list[str], list[str], Counter]:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    types = [str(table.schema.field(n).type).replace("large_", "") for n in names]
    return names, types, Counter(tuple(normal(v) for v in row) for row in zip(*columns))


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if both agree in names, types and rows, else what differs."""
    got_names, got_types, got = rows(df.toArrow())
    want = con.sql(sql).to_arrow_table()
    want_names, want_types, want = rows(want)
    if got_names != want_names:
        return f"columns {got_names} vs {want_names}"
    if got != want:
        extra, missing = list((got - want).items())[:2], list((want - got).items())[:2]
        return f"rows {sum(got.values())} vs {sum(want.values())}; only here {extra}; only there {missing}"
    if got_types != want_types:
        return f"types {[(n, a, b) for n, a, b in zip(got_names, got_types, want_types) if a != b]}"
    return None
