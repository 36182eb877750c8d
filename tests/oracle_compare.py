"""Compare a registered Spark query with its DuckDB oracle (order-insensitive)."""

from __future__ import annotations

import math

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return ("nan",)
        return round(v, 9)
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def compare(df, con, sql: str) -> tuple[bool, str]:
    spark_cols = sorted(df.columns)
    rows = [tuple(_norm(r[c]) for c in spark_cols) for r in df.collect()]
    res = con.execute(sql)
    duck_cols = [d[0] for d in res.description]
    if sorted(duck_cols) != spark_cols:
        return False, f"columns differ: spark={spark_cols} oracle={sorted(duck_cols)}"
    idx = [duck_cols.index(c) for c in spark_cols]
    orows = [tuple(_norm(r[i]) for i in idx) for r in res.fetchall()]
    if len(rows) != len(orows):
        return False, f"row count spark={len(rows)} oracle={len(orows)}"
    a, b = sorted(rows, key=_key), sorted(orows, key=_key)
    for x, y in zip(a, b):
        if x != y:
            return False, f"first differing row:\n spark={x}\n oracle={y}"
    return True, f"{len(rows)} rows equal"
