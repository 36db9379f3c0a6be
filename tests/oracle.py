"""Comparison of a query with its SQL in DuckDB, order of rows and columns aside."""

import os

import duckdb
import pandas as pd


def connect(sf_dir):
    con = duckdb.connect()
    for f in os.listdir(sf_dir):
        p = os.path.join(sf_dir, f)
        con.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{p if os.path.isfile(p) else p + '/*.parquet'}'")
    return con


def _cell(x):
    if x is None or x is pd.NaT or (isinstance(x, float) and x != x):
        return None
    if isinstance(x, float):
        return repr(x)
    return str(list(x)) if hasattr(x, "__len__") and not isinstance(x, str) else str(x)


def frame_rows(df):
    df = df[sorted(df.columns)]
    return sorted(zip(*[df[c].map(_cell) for c in df.columns], strict=True), key=str)


def same(got, expected):
    assert sorted(got.columns) == sorted(expected.columns)
    a, b = frame_rows(got), frame_rows(expected)
    assert len(a) == len(b)
    assert a == b
