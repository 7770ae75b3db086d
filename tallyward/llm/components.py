"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm.common import stored


def _pairs(df: DataFrame, u: str, v: str) -> DataFrame:
    return df.select(F.col(u).alias("u"), F.col(v).alias("v"))


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node of the links (a, b); the label is the least node reachable.

    Every round joins neighbours with the least one they know and halves the depth at least, so a chain of n nodes
    takes about log n rounds. Least neighbours are summed before the shuffle, and what is kept per node is one row.
    """
    edges = stored(links.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while True:
        both = edges.unionByName(_pairs(edges, "v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = _pairs(both.join(least, "u").filter("v > u"), "v", "m").distinct()
        large = stored(large)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = _pairs(large.join(least, "u").filter("v != m"), "v", "m").unionByName(_pairs(least, "u", "m"))
        edges = stored(small.distinct())
        ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("below"), F.lit(0).alias("above"))
        ends = ends.unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("below"), F.lit(1).alias("above")))
        ends = ends.groupBy("node").agg(F.sum("below").alias("below"), F.max("above").alias("above"))
        if ends.filter("below > 1 OR below > 0 AND above > 0").isEmpty():  # every node hangs on one, and nothing on it
            break
    leaves = edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return leaves.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
