"""Compares a query's rows with those of its DuckDB counterpart."""

import os

import duckdb
import pandas as pd


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in os.listdir(sf_dir):
        if f.endswith(".parquet"):
            con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{sf_dir}/{f}'")
    return con


def plain(v):
    if v is None or v is pd.NA or v is pd.NaT or isinstance(v, float) and v != v:
        return "~"
    if isinstance(v, float):
        return repr(round(v, 5))
    if hasattr(v, "isoformat"):
        t = pd.Timestamp(v)
        return str(t if t.tzinfo is None else t.tz_convert("UTC").tz_localize(None))
    return str(v.tolist() if hasattr(v, "tolist") else v)


def rows(df):
    df = df[sorted(df.columns)]
    return sorted(tuple(map(plain, r)) for r in df.itertuples(index=False))
