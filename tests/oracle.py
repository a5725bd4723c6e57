"""Compare registered queries with their SQL on the same Parquet tables."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from pathlib import Path

import duckdb

from millrace.plans.catalog import ORACLES, QUERIES


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in Path(folder).glob("*.parquet"):
        con.execute(f"create view {f.stem} as select * from '{f}'")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else v + 0.0
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def _key(row):
    return tuple((x is not None, type(x).__name__ if not isinstance(x, (int, float)) else "n", x if x is not None else 0) for x in row)


def rows_of(columns, rows):
    place = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in place) for r in rows), key=_key)


def spark_rows(df):
    return sorted(df.columns), rows_of(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    return sorted(names), rows_of(names, cur.fetchall())


def compare(spark, con, folder: str, key: str) -> str:
    """'' when equal, else what differs."""
    cols, got = spark_rows(QUERIES[key](spark, folder))
    if key not in ORACLES:
        return "" if got else "no rows"
    want_cols, want = duck_rows(con, ORACLES[key])
    if cols != want_cols:
        return f"columns {cols} != {want_cols}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}; e.g. {got[:2]} / {want[:2]}"
    for a, b in zip(got, want):
        if a != b:
            return f"row {a} != {b}"
    return "" if got else "no rows on either side"
