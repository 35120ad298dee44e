"""Runs registered queries and their SQL checks side by side."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
import os

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9) + 0.0
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark_df, con, sql: str) -> list[str]:
    """Differences as text; empty when equal."""
    cur = con.execute(sql)
    want_cols = [d[0] for d in cur.description]
    want = canon(want_cols, cur.fetchall())
    got = canon(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    out = []
    if sorted(want_cols) != sorted(spark_df.columns):
        return [f"columns {sorted(spark_df.columns)} want {sorted(want_cols)}"]
    if len(got) != len(want):
        out.append(f"rows {len(got)} want {len(want)}")
    if not want:
        out.append("check is empty")
    only_got = [r for r in got if r not in set(want)][:3] if got != want else []
    only_want = [r for r in want if r not in set(got)][:3] if got != want else []
    if got != want:
        out.append(f"got {only_got} want {only_want}")
    return out
