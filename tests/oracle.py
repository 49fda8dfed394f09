"""Compares a Spark result with DuckDB's on the same tables."""

import datetime
import decimal
import os

import duckdb
import numpy as np
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder):
    con = duckdb.connect()
    con.execute("set TimeZone='UTC'")
    for t in TABLES:
        path = f"{folder}/{t}.parquet"
        con.execute(f"create view {t} as select * from '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


def plain(v):
    if v is None or v is pd.NaT:
        return None
    if isinstance(v, (float, np.floating, decimal.Decimal)):
        return None if v != v else f"{float(v):.6g}"
    if isinstance(v, (list, tuple, np.ndarray)):
        return tuple(plain(x) for x in v)
    if isinstance(v, (bool, np.bool_, datetime.date)):
        return str(v)
    return f"{int(v)}" if isinstance(v, (int, np.integer)) else str(v)


def same(df, con, sql):
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str)
    found = con.execute(sql)
    names = [x[0] for x in found.description]
    assert sorted(names) == columns
    want = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in found.fetchall()), key=str)
    assert got == want
