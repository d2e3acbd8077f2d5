"""Hold a Spark result against DuckDB SQL over the same tables."""

from __future__ import annotations

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    c = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{p}{'/*.parquet' if os.path.isdir(p) else ''}'")
    return c


def plain(v):
    return round(v, 5) if isinstance(v, float) else v


def same(df, sql: str, c: duckdb.DuckDBPyConnection) -> bool:
    columns = sorted(df.columns)
    found = sorted((tuple(plain(v) for v in r) for r in df.select(*columns).collect()), key=repr)
    other = c.sql(sql)
    assert sorted(other.columns) == columns
    at = [other.columns.index(x) for x in columns]
    return found == sorted((tuple(plain(r[i]) for i in at) for r in other.fetchall()), key=repr)
