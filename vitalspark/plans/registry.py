"""Named queries: each is ``fn(spark, sf_dir) -> DataFrame`` paired with the
DuckDB SQL that states the same result over the same parquet tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def half_up_rounding(sql: str) -> str:
    """State Spark's rounding in DuckDB: every ``round(x, n)`` becomes HALF_UP
    rounding of x taken at 12 decimals (see ``functions.columns.round_half_up``);
    DuckDB's own ``round`` works on the binary double."""
    out, i, key = [], 0, "round("
    while True:
        j = sql.find(key, i)
        if j < 0 or (j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i:j + len(key)])
            i = j + len(key)
            continue
        depth, k, comma = 1, j + len(key), -1
        while depth:
            ch = sql[k]
            depth += (ch == "(") - (ch == ")")
            if ch == "," and depth == 1:
                comma = k
            k += 1
        arg, scale = sql[j + len(key):comma], sql[comma + 1:k - 1].strip()
        out.append(sql[i:j] + f"CAST(round(CAST({half_up_rounding(arg)} AS DECIMAL(38,12)), {scale}) AS DOUBLE)")
        i = k


def register(key: str, sql: str | None = None):
    """Register a query; ``sql=None`` marks it as not SQL-expressible."""
    def deco(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = half_up_rounding(sql)
        return fn
    return deco
