"""Spark-vs-DuckDB comparison used by the tests (mirrors the driver's gate:
row count, column names, order-insensitive values)."""

from __future__ import annotations

import datetime as dt
import decimal
import os

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if v != v:
            return "nan"
        return float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return v.normalize() if v == v else "nan"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: repr(r))


def compare(spark_df, con, sql: str | None):
    """Return (ok, message)."""
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    if sql is None:
        return True, f"rows-only: {len(s_rows)} rows"
    rel = con.execute(sql)
    d_cols = [c[0] for c in rel.description]
    d_rows = rel.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={s_cols} duck={d_cols}"
    if len(s_rows) != len(d_rows):
        return False, f"row count differs: spark={len(s_rows)} duck={len(d_rows)}"
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    if a != b:
        cols = sorted(s_cols)
        for x, y in zip(a, b):
            if x != y:
                diffs = [(c, p, q) for c, p, q in zip(cols, x, y) if p != q]
                return False, f"values differ (first): {diffs[:6]}"
    return True, f"{len(s_rows)} rows match"
