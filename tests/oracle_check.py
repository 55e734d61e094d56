"""Compare a query with its SQL counterpart value by value."""

from __future__ import annotations

import math

import duckdb
import pandas as pd

from visitlens.sources.roles import TABLES


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _cell(value):
    if value is None or value is pd.NaT:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if hasattr(value, "item"):
        return _cell(value.item())
    if isinstance(value, pd.Timestamp):
        return value.to_pydatetime()
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def difference(df, sql: str, con: duckdb.DuckDBPyConnection) -> str | None:
    """None when columns and all values agree, else a short description."""
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    want = rows_of(names, found.fetchall())
    got = rows_of(df.columns, df.collect())
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)} rows"
    for a, b in zip(got, want):
        if a != b:
            return f"{sorted(names)}: {a} != {b}"
    return None
