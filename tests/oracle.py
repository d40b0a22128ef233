"""Rows of Spark and DuckDB in one comparable form."""

import math

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir, sql):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con.execute(sql).df()


def plain(x):
    if isinstance(x, float) and math.isnan(x) or x is None or x is pd.NaT or x is pd.NA:
        return None
    if isinstance(x, bool):
        return x
    if hasattr(x, "isoformat"):
        return pd.Timestamp(x).isoformat()
    if isinstance(x, (int, float)) or hasattr(x, "dtype"):
        return round(float(x), 6) + 0.0
    return str(x)


def rows(df):
    df = df[sorted(df.columns)]
    return sorted((tuple(map(plain, r)) for r in df.astype(object).itertuples(index=False, name=None)), key=str)
