"""Exact quantiles of any number of columns of any size.

Spark's exact `percentile` keeps every distinct value in one buffer. Here the distinct values of all columns are
counted in one pass and stay spread over the tasks. The positions that are wanted, two per probability and
column, are narrowed down to ranges of values: each round cuts the ranges by approximate quantiles, counts,
and keeps the part that holds the position, until no range has more than `SORTED_VALUES` distinct values. Only
those are sorted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyward.functions.numbers import missing
from tallyward.functions.text import named
from tallyward.sources.shared import shared_folder

# Distinct values of a range that one task sorts, and the parts a larger range is cut into.
SORTED_VALUES = 100_000
RANGE_BITS = 11

RANGE = "id int, number int, which int, part double, offset bigint, low double, high double, distinct_values bigint"


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    range_bits: int = RANGE_BITS,
    sorted_values: int = SORTED_VALUES,
) -> DataFrame:
    """One row per column, by its `number` in the list, with the array `quantiles`, linearly interpolated; columns
    without values are left out. The counting pass, and the narrowing of large columns, run at once; with three
    or more `sorted_values`, every round of it makes a range smaller."""
    spark = df.sparkSession
    values = [F.struct(F.lit(i).alias("number"), F.when(~missing(df, c), named(c).cast("double")).alias("value")) for i, c in enumerate(columns)]
    long = df.select(F.inline(F.array(*values))).where("value is not null")
    folder = shared_folder(spark)
    long.groupBy("number", "value").agg(F.count(F.lit(1)).alias("n")).write.parquet(folder)
    counts = spark.read.schema("number int, value double, n bigint").parquet(folder)
    whole = counts.groupBy("number").agg(
        F.sum("n").alias("total"), F.min("value").alias("low"), F.max("value").alias("high"), F.count(F.lit(1)).alias("m")
    )
    ranges: list[tuple] = []
    for row in whole.collect():  # one per column
        for which, p in enumerate(probabilities):
            exact = p * (row.total - 1)
            for offset in (int(exact), int(exact) + (exact > int(exact))):
                ranges.append((len(ranges), row.number, which, exact - int(exact), offset, row.low, row.high, row.m))
    while wide := [r for r in ranges if r[-1] > sorted_values]:
        found = {r.id: r for r in _narrowed(counts, spark.createDataFrame(wide, RANGE), range_bits).collect()}  # one per position
        ranges = [tuple(found[r[0]]) if r[0] in found else r for r in ranges]
    wanted = F.broadcast(spark.createDataFrame(ranges, RANGE))  # two rows per column and probability
    hits = _in_ranges(counts, wanted)
    upto = F.sum("n").over(Window.partitionBy("id").orderBy("value"))
    at = hits.withColumn("upto", upto).where("upto - n <= offset and offset < upto")
    ends = at.groupBy("number", "which").agg(F.expr("min_by(value, id)").alias("a"), F.expr("max_by(value, id)").alias("b"), F.max("part").alias("part"))
    found = ends.groupBy("number").agg(F.expr("map_from_entries(collect_list(struct(which, a + (b - a) * part)))").alias("found"))
    entries = ", ".join(f"try_element_at(found, {i})" for i in range(len(probabilities)))
    return found.selectExpr("number", f"array({entries}) as quantiles")


def _in_ranges(counts: DataFrame, ranges: DataFrame) -> DataFrame:
    """Values with the ranges of their column that hold them."""
    return counts.join(ranges, "number").where("value between low and high")


def _narrowed(counts: DataFrame, ranges: DataFrame, range_bits: int) -> DataFrame:
    """For each range the part of it that holds its position, with the position's offset in that part."""
    n_ranges = 2**range_bits
    steps = ", ".join(f"{i / n_ranges}D" for i in range(1, n_ranges))
    hits = _in_ranges(counts, F.broadcast(ranges)).select("id", "value", "n")
    cuts = hits.groupBy("id").agg(F.expr(f"percentile_approx(value, array({steps}), {max(128, 2 * n_ranges)})").alias("cuts"))
    numbered = _with_range_number(hits.join(F.broadcast(cuts), "id"), range_bits)
    parts = numbered.groupBy("id", "at").agg(
        F.min("value").alias("low"), F.max("value").alias("high"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("distinct_values")
    )
    before = F.sum("n").over(Window.partitionBy("id").orderBy("at")) - F.col("n")  # at most 2**range_bits rows per range
    own = ranges.select("id", "number", "which", "part", "offset")
    holding = parts.withColumn("before", before).join(F.broadcast(own), "id").where("before <= offset and offset < before + n")
    return holding.selectExpr("id", "number", "which", "part", "offset - before as offset", "low", "high", "distinct_values")


def _with_range_number(df: DataFrame, range_bits: int) -> DataFrame:
    """Adds the number of cuts at or below the value, by halving, one generated step per bit.

    Any cuts give right quantiles; even cuts give even ranges.
    """
    steps, at = [], "0"
    for bit in reversed(range(range_bits)):
        step = 2**bit
        steps.append(f"{at} + if(get(cuts, {at} + {step - 1}) <= value, {step}, 0) as at_{bit}")
        at = f"at_{bit}"
    return df.selectExpr("*", *steps).withColumnRenamed(at, "at")
