"""Uniqueness of keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.functions.text import named, quoted


def _key_counts(df: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.groupBy(*[quoted(k) for k in key]).agg(F.count(F.lit(1)).alias("copies"))


def key_uniqueness(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row: whether no key occurs twice. Two nulls are a repeat."""
    return _key_counts(df, key).agg(
        F.lit(",".join(key)).alias("key_columns"),
        (F.coalesce(F.max("copies"), F.lit(0)) <= 1).alias("is_unique"),
    )


def key_violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once or are null in part, with their number of copies."""
    has_null = reduce(lambda a, b: a | b, [named(k).isNull() for k in key])
    return _key_counts(df, key).where((F.col("copies") > 1) | has_null)


def cast_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key columns as integers. What is no integer becomes null, and so a key violation."""
    return df.withColumns({k: named(k).try_cast("bigint") for k in keys})
