"""Runs a query on Spark and its SQL on DuckDB over the same tables and compares the rows."""

from __future__ import annotations

import datetime
import glob
import math
import os

import duckdb


def tables(d: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for p in glob.glob(f"{d}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    return v


def rows(columns: list[str], data) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in data), key=repr)


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty if both give the same columns and rows."""
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    theirs = rows(names, cur.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    ours = rows(df.columns, [tuple(r) for r in df.collect()])
    if ours == theirs:
        return ""
    a, b = set(map(repr, ours)), set(map(repr, theirs))
    return f"{len(ours)} and {len(theirs)} rows; only here {sorted(a - b)[:3]}; only in SQL {sorted(b - a)[:3]}"
