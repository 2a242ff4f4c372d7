"""Runs registered queries next to their SQL and compares whole results."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
import os

import duckdb
import numpy as np

SMALL = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf, f"{name}.parquet")
        if glob.glob(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, (bool, np.bool_)):
        return bool(value)
    if isinstance(value, decimal.Decimal):
        return round(float(value), 6)
    if isinstance(value, (float, np.floating)):
        return round(float(value), 6)
    if isinstance(value, (int, np.integer)):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple, np.ndarray)):
        return tuple(plain(v) for v in value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def compare(spark, con, fn, sql: str, sf: str) -> str | None:
    """None when equal, else what differs."""
    df = fn(spark, sf)
    mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    theirs = rows_of([d[0] for d in result.description], result.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} / {theirs[0]}"
    if len(mine[1]) != len(theirs[1]):
        return f"rows {len(mine[1])} / {len(theirs[1])}"
    bad = [(a, b) for a, b in zip(mine[1], theirs[1]) if a != b]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else None
