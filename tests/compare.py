"""Comparison of a registered query with its SQL in DuckDB."""

import datetime
import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connection(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, int):
        return float(v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def same(df, con, sql):
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    cur = con.execute(sql)
    names = [x[0] for x in cur.description]
    assert sorted(names) == columns
    want = sorted((tuple(plain(dict(zip(names, r, strict=True))[c]) for c in columns) for r in cur.fetchall()), key=repr)
    assert got == want
