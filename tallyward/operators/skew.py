"""Joins in which one key may hold a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.functions.text import quoted
from tallyward.operators.joins import fact_dim_join, is_small
from tallyward.sources.shared import shared_folder

#: Shares of a hot key's rows per partition. Hashing deals them out unevenly; with so many, by little.
SPREAD = 32
#: Bound of the keys that are looked for, and counters of the sketch for each.
MOST_KEYS, COUNTERS = 10_000, 8


def partitions_of(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def heavy_keys(df: DataFrame, key: str, partitions: int) -> DataFrame:
    """(key, share) of the keys that hold more than half of an average partition's rows, and null; their number is bounded.

    Found in one pass by a sketch of counters per task, which Spark merges. The sketch never overlooks a key of that
    share, and what it counts too much only spreads a key further than needed.
    """
    most = min(MOST_KEYS, 2 * partitions)
    counters = 1 << (COUNTERS * most - 1).bit_length()
    rows = df.select(quoted_column(df, key).alias("key")).where("key IS NOT NULL")
    top = rows.agg(F.expr(f"approx_top_k(key, {most}, {min(counters, 1_000_000)})").alias("top"), F.count(F.lit(1)).alias("n"))
    found = top.select(F.explode("top").alias("t"), "n").select(F.col("t.item").alias(key), (F.col("t.count") / F.col("n")).alias("share"))
    found = found.where(F.col("share") > 0.5 / partitions)
    path = f"{shared_folder(df.sparkSession)}/heavy"
    found.write.parquet(path)  # at most `most` rows: read again, their size is known
    return df.sparkSession.read.schema(found.schema).parquet(path)


def quoted_column(df: DataFrame, name: str):
    return df[quoted(name)]


def split_join(fact: DataFrame, dim: DataFrame, key: str, columns: Sequence[str], partitions: int | None = None, broadcast_small: bool = True) -> DataFrame:
    """As `fact_dim_join`, which is used if the dimension is small, for one too large to broadcast and keys that hold a large share of the facts.

    The rows of a hot key are dealt to as many shares as it needs, and the dimension's rows of that key are there once for
    each; all other rows have one share. Together the dimension grows by `SPREAD` rows a partition at most, times its
    rows per key. Shares are numbered by the place of a row in its input split, so a task that runs again deals alike.
    """
    if broadcast_small and is_small(dim):
        return fact_dim_join(fact, dim, key, columns)
    partitions = partitions or partitions_of(fact.sparkSession)
    needed = {key, *columns}
    left = fact.select(*[quoted(c) for c in fact.columns if c in needed])
    right = dim.select(*[quoted(c) for c in dim.columns if c == key or (c in needed and c not in left.columns)])
    hot = heavy_keys(left, key, partitions).select(quoted(key), F.ceil(F.col("share") * partitions * SPREAD).cast("int").alias("_shares"))
    hot = F.broadcast(hot)  # at most MOST_KEYS rows
    dealt = left.join(hot, key, "left").withColumn("_share", F.when(F.col("_shares").isNotNull(), F.pmod(F.monotonically_increasing_id(), F.col("_shares")).cast("int")).otherwise(0))
    copied = right.join(hot, key, "left").withColumn("_share", F.explode(F.sequence(F.lit(0), F.coalesce("_shares", F.lit(1)) - 1)))
    return dealt.drop("_shares").join(copied.drop("_shares"), [key, "_share"]).select(*[quoted(c) for c in columns])
