"""Compare a query with its SQL in DuckDB."""

import os

import duckdb


def tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    c = duckdb.connect()
    for f in sorted(os.listdir(sf_dir)):
        path = f"{sf_dir}/{f}"
        c.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    return c


def normal(df):
    df = df[sorted(df.columns)].copy()
    for k in df.columns:
        if df[k].dtype == object or str(df[k].dtype).startswith(("str", "datetime")):
            df[k] = df[k].map(lambda v: "" if v is None or v != v else str(v))
        else:
            df[k] = df[k].astype(float).round(6)
    return df.sort_values(list(df.columns)).reset_index(drop=True)


def assert_same(spark, con, name, f, sql, sf_dir):
    got, want = f(spark, sf_dir).toPandas(), con.sql(sql).df()
    assert sorted(got.columns) == sorted(want.columns), name
    assert len(got) == len(want), (name, len(got), len(want))
    a, b = normal(got), normal(want)
    assert a.equals(b), (name, a[~((a == b) | (a.isna() & b.isna())).all(axis=1)].head(), b[~((a == b) | (a.isna() & b.isna())).all(axis=1)].head())
