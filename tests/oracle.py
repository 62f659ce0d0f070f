"""Runs a query and its SQL twin and compares all rows."""

import glob
import math
import os

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for p in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


def _key(row):
    return tuple((v is None, "" if v is None else (f"{v:.4f}" if isinstance(v, float) else str(v))) for v in row)


def same(a, b):
    if isinstance(a, float) and isinstance(b, (float, int)):
        return a == b or math.isclose(a, b, rel_tol=1e-9, abs_tol=2.1e-6)
    return a == b


def compare(spark, con, query, sql, sf_dir):
    df = query(spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted((tuple(r) for r in df.select(*columns).collect()), key=_key)
    rel = con.execute(sql)
    names = [c[0] for c in rel.description]
    assert sorted(names) == columns, (names, columns)
    order = [names.index(c) for c in columns]
    want = sorted((tuple(r[i] for i in order) for r in rel.fetchall()), key=_key)
    assert len(got) == len(want), (len(got), len(want))
    bad = [(g, w) for g, w in zip(got, want) if not all(same(x, y) for x, y in zip(g, w))]
    exact = sum(g == w for g, w in zip(got, want))
    assert not bad, (columns, len(bad), bad[:3])
    return len(got), exact
