"""Run a workload in Spark and its SQL in DuckDB; compare rows, columns and values."""

from __future__ import annotations

import datetime as _dt
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(data_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{data_dir}/{t}.parquet"
        if os.path.isdir(path):
            path = f"{path}/*.parquet"  # a folder written by Spark
        elif not os.path.exists(path):
            continue
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (0, "")
        return (1, f"{v:.10g}")
    if isinstance(v, bool):
        return (1, str(int(v)))
    if isinstance(v, int):
        return (1, str(v))
    if isinstance(v, _dt.datetime):
        return (1, v.replace(tzinfo=None).isoformat())
    if hasattr(v, "tolist"):
        return (1, repr(v.tolist()))
    return (1, str(v))


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in records)


def compare(spark, con, name, spark_df_fn, sql, data_dir):
    sdf = spark_df_fn(spark, data_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    out = {
        "rows_spark": len(s_rows),
        "rows_oracle": len(d_rows),
        "columns_match": sorted(s_cols) == sorted(d_cols),
    }
    out["values_match"] = out["columns_match"] and rows_of(s_cols, s_rows) == rows_of(d_cols, d_rows)
    if not out["columns_match"]:
        out["columns"] = (sorted(s_cols), sorted(d_cols))
    return out
