"""Spark results against DuckDB's, without regard to order."""

import glob
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET timezone='UTC'")
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        path = f if os.path.isfile(f) else f"{f}/*.parquet"
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{path}'")
    return con


def plain(v):
    if isinstance(v, float):
        return 0.0 if v == 0 else float(f"{v:.9g}")
    if hasattr(v, "as_tuple"):
        return float(v)
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v


def assert_same(df, con, sql: str) -> None:
    r = con.execute(sql)
    names = [c[0] for c in r.description]
    assert sorted(names) == sorted(df.columns)
    order = sorted(names)
    want = sorted((tuple(plain(row[names.index(c)]) for c in order) for row in r.fetchall()), key=repr)
    got = sorted((tuple(plain(row[c]) for c in order) for row in df.collect()), key=repr)
    assert len(got) == len(want)
    for a, b in zip(got, want, strict=True):
        assert a == b
