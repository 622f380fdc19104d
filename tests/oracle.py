"""Compares a query with its DuckDB SQL over the same tables, as sets of rows with multiplicity."""

import math
from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else float(f"{x:.9g}")
    if hasattr(x, "isoformat"):
        return x.isoformat()
    if isinstance(x, (bytes, bytearray)):
        return bytes(x)
    return x


def compare(spark, df, sql, sf_dir):
    cur = connect(sf_dir).execute(sql)
    theirs = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(theirs)
    at = [theirs.index(c) for c in df.columns]
    want = Counter(tuple(plain(r[i]) for i in at) for r in cur.fetchall())
    got = Counter(tuple(map(plain, r)) for r in df.collect())
    assert got == want, (list((got - want).items())[:4], list((want - got).items())[:4])
    return sum(got.values())
