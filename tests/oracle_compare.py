"""Compares a query's rows with those of its SQL, regardless of order."""

from __future__ import annotations

import datetime
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _value(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.12g}")
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return v


def as_bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


def differences(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if names, kinds and rows agree; else what differs."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    expected = as_bag(names, cursor.fetchall())
    found = as_bag(spark_df.columns, spark_df.collect())
    if found == expected:
        return None
    extra, lacking = found - expected, expected - found
    return (
        f"{sum(found.values())} rows, expected {sum(expected.values())}; "
        f"extra {list(extra.items())[:3]}, lacking {list(lacking.items())[:3]}"
    )
