"""Spark-vs-DuckDB comparison in the driver's manner: row count, column names
(sorted) and an order-insensitive multiset of normalised values."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os

import duckdb

from vitalspark.sources.tables import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, bool):
        return v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def compare(spark_df, con, sql: str):
    s_names = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_names = [d[0] for d in res.description]
    d_rows = res.fetchall()
    problems = []
    if sorted(s_names) != sorted(d_names):
        problems.append(f"columns differ: spark={sorted(s_names)} duck={sorted(d_names)}")
        return problems, len(s_rows), len(d_rows)
    if len(s_rows) != len(d_rows):
        problems.append(f"row counts differ: spark={len(s_rows)} duck={len(d_rows)}")
    a, b = _rows(s_names, s_rows), _rows(d_names, d_rows)
    if a != b:
        sa, sb = set(a), set(b)
        only_s = [r for r in a if r not in sb][:3]
        only_d = [r for r in b if r not in sa][:3]
        problems.append(f"values differ: spark-only={only_s} duck-only={only_d}")
    return problems, len(s_rows), len(d_rows)
