"""Joins of facts with dimensions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.functions.numbers import amount, sum_of, sum_parts
from tallyward.functions.text import named


def fact_dim_join(fact: DataFrame, dim: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Inner join on an equally named key, reading only the named columns. A null key drops the row.

    A dimension below the session's broadcast threshold is broadcast; else rows are shuffled by key.
    """
    needed = {key, *columns}
    left = fact.select(*[c for c in fact.columns if c in needed])
    right = dim.select(*[c for c in dim.columns if c == key or (c in needed and c not in left.columns)])
    return left.join(right, key).select(*columns)


def is_small(df: DataFrame) -> bool:
    """Whether Spark will broadcast the frame: its size in bytes, as the optimizer bounds it from the files
    that it reads, is within the session's threshold. Runs nothing."""
    session = df.sparkSession._jsparkSession.sessionState()
    threshold = session.conf().autoBroadcastJoinThreshold()
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= threshold


def star_sum(
    fact: DataFrame,
    dims: Mapping[str, DataFrame],
    by: Sequence[str],
    sums: Mapping[str, str],
    counts: Mapping[str, str] | None = None,
) -> DataFrame:
    """Sums and counts of a fact table's columns, by columns of its own and of dimensions joined on their keys.

    Small dimensions come first; Spark broadcasts them, so they cost no shuffle. If others are left, the
    rows are summed by their keys and by the wanted columns known so far: a key that makes up a third of
    the table then enters the shuffle with a few rows per task. Without any, one shuffle carries one row
    per task and group.
    """
    parts = {k: v for name, column in sums.items() for k, v in sum_parts(fact, column, name).items()}
    totals = parts | {name: F.count(amount(named(c))) for name, c in (counts or {}).items()}
    summed = False
    for key, dim in sorted(dims.items(), key=lambda item: not is_small(item[1])):
        if not is_small(dim) and not summed:
            left = [k for k in dims if k in fact.columns and not is_small(dims[k])]
            fact = fact.groupBy(*dict.fromkeys([*left, *[c for c in by if c in fact.columns]])).agg(*[t.alias(n) for n, t in totals.items()])
            totals, summed = {n: F.sum(n) for n in totals}, True
        fact = fact.join(dim, key)
    found = fact.groupBy(*by).agg(*[t.alias(n) for n, t in totals.items()])
    return found.select(*by, *[sum_of(parts, n).alias(n) for n in sums], *(counts or {}))
