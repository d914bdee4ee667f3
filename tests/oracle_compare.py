"""Compare a registered Spark query with its DuckDB oracle (the driver's check, locally)."""

from __future__ import annotations

import math

import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6) + 0.0
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def frame_rows(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    rows = [tuple(_norm(v) for v in r) for r in df[cols].astype(object).itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark, con, name, qfn, sql, sf_dir) -> tuple[bool, str]:
    sdf = qfn(spark, sf_dir)
    s = sdf.toPandas()
    o = con.execute(sql).df()
    if sorted(s.columns) != sorted(o.columns):
        return False, f"columns differ: spark={sorted(s.columns)} oracle={sorted(o.columns)}"
    if len(s) != len(o):
        return False, f"rows differ: spark={len(s)} oracle={len(o)}"
    rs, ro = frame_rows(s), frame_rows(o)
    for a, b in zip(rs, ro):
        if a != b:
            return False, f"first differing row:\n spark ={a}\n oracle={b}\n cols={sorted(s.columns)}"
    return True, f"{len(s)} rows"
