"""Compare a Spark result with the oracle engine, ignoring row order."""

from __future__ import annotations

import math
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(v):
    if isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, Decimal):
        return ("decimal", str(v))
    return v


def _table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    body = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(body, key=repr)


def spark_table(df):
    return _table(df.columns, [tuple(r) for r in df.collect()])


def oracle_table(con, sql):
    cur = con.execute(sql)
    return _table([d[0] for d in cur.description], cur.fetchall())
