"""Run a query and its SQL and compare rows without regard to order."""

import os

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}{'/*.parquet' if os.path.isdir(path) else ''}')")
    return con


def _text(v):
    if hasattr(v, "tolist"):
        v = v.tolist()
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
        return ""
    if isinstance(v, float):
        return f"{v:.6g}" if v else "0"
    return str(v)


def rows(df):
    df = df[sorted(df.columns)]
    return list(df.columns), sorted(tuple(map(_text, r)) for r in df.itertuples(index=False, name=None))


def same(spark_df, con, sql):
    assert rows(spark_df.toPandas()) == rows(con.execute(sql).df())
