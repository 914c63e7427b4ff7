"""Queries held against their SQL."""

import datetime as dt
import math
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, (float, np.floating)):
        return float(f"{v:.9g}")
    if isinstance(v, (list, tuple, np.ndarray)):
        return tuple(plain(x) for x in v)
    if isinstance(v, np.integer):
        return int(v)
    return v.replace(tzinfo=None) if isinstance(v, dt.datetime) else v


def differences(spark, sf, queries, sql):
    """For each query with SQL that differs from it: the rows that only one of both has."""
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for f in Path(sf).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    out = {}
    for name, text in sql.items():
        df = queries[name](spark, sf)
        columns = sorted(df.columns)
        found = con.execute(text)
        at = {d[0]: i for i, d in enumerate(found.description)}
        assert sorted(at) == columns, name
        want = Counter(tuple(plain(r[at[c]]) for c in columns) for r in found.fetchall())
        got = Counter(tuple(plain(r[c]) for c in columns) for r in df.collect())
        if got != want:
            out[name] = (list((got - want).items())[:2], list((want - got).items())[:2])
    return out
