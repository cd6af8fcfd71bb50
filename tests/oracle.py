"""Run a registered query in Spark and its oracle in DuckDB, compare as multisets."""

from __future__ import annotations

import datetime as dt
import math

import duckdb

from harrow.plans.fixtures import TABLES


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6) + 0.0
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, bool):
        return int(v)
    return v


def compare(spark, con, name, fn, sql, sf_dir):
    sdf = fn(spark, sf_dir)
    cols = sdf.columns
    srows = sdf.collect()
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    problems = []
    if sorted(cols) != sorted(dcols):
        problems.append(f"columns differ: spark={cols} duck={dcols}")
        return problems
    order = sorted(cols)
    si = [cols.index(c) for c in order]
    di = [dcols.index(c) for c in order]
    a = sorted((tuple(_norm(r[i]) for i in si) for r in srows), key=repr)
    b = sorted((tuple(_norm(r[i]) for i in di) for r in drows), key=repr)
    if len(a) != len(b):
        problems.append(f"row count spark={len(a)} duck={len(b)}")
    if a != b:
        sa, sb = set(a), set(b)
        problems.append(f"values differ: only spark {list(sa - sb)[:3]} only duck {list(sb - sa)[:3]}")
    return problems
