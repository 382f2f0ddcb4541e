"""Runs queries and their SQL side by side (order-insensitive, columns by name)."""

from __future__ import annotations

import datetime
import glob
import math
import os


def tables_of(base: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for p in glob.glob(f"{base}/*.parquet"):
        src = f"{p}/*.parquet" if os.path.isdir(p) else p
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM read_parquet('{src}')")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 5) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    if hasattr(v, "asDict"):
        return tuple(plain(x) for x in v)
    return float(v) if type(v).__name__ == "Decimal" else v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, query, sql: str, base: str) -> str:
    """'' if equal, else what differs."""
    df = query(spark, base)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    want = rows_of([d[0] for d in cur.description], cur.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} and {want[0]}"
    if got[1] != want[1]:
        a, b = [r for r in got[1] if r not in set(want[1])][:2], [r for r in want[1] if r not in set(got[1])][:2]
        return f"{len(got[1])} and {len(want[1])} rows; only here {a}; only in SQL {b}"
    return ""
