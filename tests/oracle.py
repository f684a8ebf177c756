"""Runs a query in Spark and its oracle in DuckDB over the same Parquet files, and compares the rows."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def _value(x):
    if hasattr(x, "item"):
        x = x.item()
    if isinstance(x, float):
        return None if math.isnan(x) else f"{round(x, 6) + 0.0:.6f}"
    return x if x is None or isinstance(x, (bool, str)) else str(x)


def rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(_value(r[i]) for i in order) for r in records), key=repr)


def duck(sf_dir: str, sql: str):
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf_dir}/{t}.parquet"):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    got = con.execute(sql)
    return rows([d[0] for d in got.description], got.fetchall())


def spark_rows(df):
    return rows(df.columns, [tuple(r) for r in df.collect()])
