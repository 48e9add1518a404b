"""Compare a DataFrame with DuckDB's answer over the same tables."""

import os

import duckdb
import numpy as np
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def cell(v):
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and np.isnan(v)):
        return "null"
    if isinstance(v, (bool, np.bool_)):
        return str(bool(v))
    if isinstance(v, (int, float, np.integer, np.floating)):
        return repr(round(float(v), 6))
    return str(v)


def rows(frame):
    frame = frame[sorted(frame.columns)]
    return sorted(tuple(map(cell, r)) for r in frame.itertuples(index=False, name=None))


def duck(sql, folder):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{folder}/{t}.parquet"
        con.execute(f"create view {t} as select * from '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con.sql(sql).df()
