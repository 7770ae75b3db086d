"""First ranks per group, ties kept."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyward.functions.text import named
from tallyward.operators.duplicates import copies, numbered_copies


def first_ranked(df: DataFrame, group: str, value: str, descending: bool) -> DataFrame:
    """Rows of rank 1 by `value` within `group`; nulls come first ascending, last descending.

    For groups of which there are few, such as months: the best value of each, one row per group, is
    broadcast and joined back, so rows are neither sorted nor gathered by group, however many share the
    first rank.
    """
    v = named(value)
    best = F.max(v) if descending else F.when(F.count(v) == F.count(F.lit(1)), F.min(v))
    first = df.groupBy(named(group).alias("_group")).agg(best.alias("_best"))
    found = df.join(F.broadcast(first), named(group).eqNullSafe(F.col("_group")) & v.eqNullSafe(F.col("_best")))
    return found.drop("_group", "_best")


def first_ranked_with_copies(df: DataFrame, group: str, value: str, descending: bool) -> DataFrame:
    """As `first_ranked`, for tables where very many equal rows may share the first rank.

    Equal rows are counted before the shuffle, ranked as one, and written out again after it, each with the
    number of its copy in `_copy`.
    """
    return numbered_copies(first_ranked(copies(df, "_copies"), group, value, descending), "_copies")


def _sorted(value: str, descending: bool):
    """SQL's order: nulls last descending, first ascending."""
    return named(value).desc_nulls_last() if descending else named(value).asc_nulls_first()


def kth_values(df: DataFrame, group: str, value: str, k: int, descending: bool) -> DataFrame:
    """(_group, _bound, _all): the k-th value of each group, copies counted; `_all` where a group has no more than k rows.

    Every task keeps the k first rows of each group it meets, and shares of tasks are cut to k again before they meet by
    group, so a group that holds a third of all rows is never gathered: at most k rows a task are.
    """
    rows = df.select(named(group).alias("_group"), named(value).alias("_value"))
    order = _sorted("_value", descending)
    shares = rows.withColumn("_share", F.pmod(F.spark_partition_id(), F.lit(64)))
    first = shares.withColumn("_place", F.row_number().over(Window.partitionBy("_group", "_share").orderBy(order))).where(F.col("_place") <= k)
    top = first.withColumn("_place", F.row_number().over(Window.partitionBy("_group").orderBy(order))).where(F.col("_place") <= k)
    last = F.max_by(F.struct("_value"), "_place")
    return top.groupBy("_group").agg(last["_value"].alias("_bound"), (F.count(F.lit(1)) < k).alias("_all"))


def rank_within(df: DataFrame, group: str, value: str, k: int, descending: bool, rank_name: str = "rank") -> DataFrame:
    """Rows whose SQL RANK by `value` within `group` is at most `k`, ties kept, with that rank.

    A row's rank is within k if fewer than k rows are before it, that is if it is not behind the k-th one: the k-th
    values are found from partial lists and joined back, so rows that tie are neither sorted nor gathered. The rank
    itself is counted from the distinct values that are left, k a group at most. Null groups are a group.
    """
    if k < 1:
        raise ValueError("ranks start at 1")
    bounds = kth_values(df, group, value, k, descending)
    v, bound = named(value), F.col("_bound")
    if descending:
        before = bound.isNull() | F.coalesce(v >= bound, F.lit(False))
    else:
        before = v.isNull() | F.coalesce(v <= bound, F.lit(False))
    kept = df.join(bounds, named(group).eqNullSafe(F.col("_group"))).where(F.col("_all") | before).drop("_group", "_bound", "_all")
    counts = kept.groupBy(named(group).alias("_group"), named(value).alias("_value")).agg(F.count(F.lit(1)).alias("_n"))
    so_far = Window.partitionBy("_group").orderBy(_sorted("_value", descending)).rowsBetween(Window.unboundedPreceding, -1)
    ranks = counts.select("_group", "_value", (F.coalesce(F.sum("_n").over(so_far), F.lit(0)) + 1).alias(rank_name))
    joined = kept.join(ranks, named(group).eqNullSafe(F.col("_group")) & v.eqNullSafe(F.col("_value")))
    return joined.drop("_group", "_value")
