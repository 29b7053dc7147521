"""Compare a query with its SQL in DuckDB, without regard to order."""

import os

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows(frame):
    frame = frame.reindex(sorted(frame.columns), axis=1)
    return sorted(tuple(_plain(x) for x in r) for r in frame.itertuples(index=False))


def _plain(x):
    if x is None or x is pd.NA or x != x:
        return ""
    if isinstance(x, float):
        return f"{x:.9g}"
    if hasattr(x, "isoformat"):
        return x.isoformat()
    return f"{x:.9g}" if hasattr(x, "dtype") and x.dtype.kind == "f" else str(x)


def same(spark, query, sql, sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf_dir}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    want = con.execute(sql).fetch_df()
    df = query(spark, sf_dir)
    got = df.toPandas()
    assert sorted(got.columns) == sorted(want.columns), (sorted(got.columns), sorted(want.columns))
    a, b = rows(got), rows(want)
    assert len(a) == len(b), (len(a), len(b))
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    assert not bad, bad[:3]
    return len(a)
