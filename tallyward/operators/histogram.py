"""Equal-width histogram."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.functions.numbers import missing
from tallyward.functions.text import named


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """One row per bin: its number, lower and upper edge, and count. The last bin holds its upper edge.

    A column with a single value gets bins from half below to half above it; one without values, no bins.
    """
    values = df.where(~missing(df, column)).select(named(column).cast("double").alias("value"))
    half = F.when(F.min("value") == F.max("value"), 0.5).otherwise(0.0)
    span = values.agg((F.min("value") - half).alias("low"), (F.max("value") + half).alias("high"))
    width = (F.col("high") - F.col("low")) / bins
    inner = F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), lambda i: F.col("low") + i * width)
    edges = span.where("low is not null").select(F.array_append(inner, F.col("high")).alias("edges"))

    # Division can be off by one at an edge; the edges themselves decide.
    guess = F.least(F.floor((F.col("value") - F.col("e")[0]) / (F.col("e")[1] - F.col("e")[0])), F.lit(bins - 1))
    placed = (
        values.withColumn("e", edges.scalar())
        .withColumn("g", guess.cast("int"))
        .withColumn(
            "bin",
            F.when(F.col("value") < F.col("e")[F.col("g")], F.col("g"))
            .when((F.col("g") < bins - 1) & (F.col("value") >= F.col("e")[F.col("g") + 1]), F.col("g") + 2)
            .otherwise(F.col("g") + 1),
        )
    )
    counts = placed.groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    every = edges.select("edges", F.explode(F.sequence(F.lit(1), F.size("edges") - 1)).alias("bin"))
    return every.join(counts, "bin", "left").select(
        "bin",
        F.col("edges")[F.col("bin") - 1].alias("low"),
        F.col("edges")[F.col("bin")].alias("high"),
        F.coalesce("n", F.lit(0).cast("bigint")).alias("n"),
    )
