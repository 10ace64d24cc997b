"""Compare a registered query with its SQL, as the driver does: by sorted column names and sorted rows."""

from __future__ import annotations

import math
import os

import duckdb
import pandas as pd


def views(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for f in sorted(os.listdir(sf_dir)):
        if f.endswith(".parquet"):
            db.sql(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{sf_dir}/{f}'")
    return db


def plain(v):
    if v is None or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "isoformat"):
        s = v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat() + " 00:00:00"
        return s[:19]
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float)) or type(v).__name__ in ("Decimal", "int64", "float64", "int32"):
        return float(v)
    return v


def rows(columns: list[str], data) -> list[tuple]:
    at = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(plain(x[i]) for i in at) for x in data), key=repr)


def differences(spark, query, sql: str, sf_dir: str, tolerance: float = 1e-9) -> list:
    df = query(spark, sf_dir)
    got = rows(df.columns, [tuple(x) for x in df.collect()])
    rel = views(sf_dir).sql(sql)
    want = rows(rel.columns, rel.fetchall())
    if sorted(df.columns) != sorted(rel.columns):
        return [("columns", sorted(df.columns), sorted(rel.columns))]
    if len(got) != len(want):
        return [("rows", len(got), len(want))]

    def near(a, b) -> bool:
        return a == b or isinstance(a, float) and isinstance(b, float) and abs(a - b) <= tolerance * max(1, abs(a))

    return [(a, b) for a, b in zip(got, want) if not all(map(near, a, b))][:3]
