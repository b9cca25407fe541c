"""Row-set comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import math
from collections import Counter
from datetime import datetime

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return None
        v = round(v, 6)
        return 0.0 if v == 0 else v
    if isinstance(v, datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def _typed(v):
    """Values tagged with a type family, so that 1 and True or 1 and '1' differ."""
    v = _norm(v)
    return (type(v).__name__, v)


def rows_of(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_typed(r[i]) for i in order) for r in rows)


def differences(spark_df, con, sql: str) -> list[str]:
    """Messages about what differs; empty when the results are equal."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    theirs = rows_of(names, result.fetchall())
    mine = rows_of(spark_df.columns, spark_df.collect())
    out = []
    if sorted(names) != sorted(spark_df.columns):
        out.append(f"columns: {sorted(set(names) ^ set(spark_df.columns))}")
    if sum(mine.values()) != sum(theirs.values()):
        out.append(f"rows: {sum(mine.values())} vs {sum(theirs.values())}")
    if not out and mine != theirs:
        out.append(f"only spark: {list((mine - theirs).items())[:2]} only sql: {list((theirs - mine).items())[:2]}")
    if not mine:
        out.append("empty")
    return out
