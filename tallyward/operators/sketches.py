"""Column summaries that can be merged: approximate quartiles and distinct counts from stored sketches."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tallyward.functions.numbers import amount
from tallyward.functions.text import named
from tallyward.sources.manifest import commit, current, new_folder

#: Size of a quantile sketch. A quartile's rank is within RANK_ERROR of the wanted one, as a share of the values, in 99
#: of 100 cases; the error of merged sketches is that of one over all rows.
QUANTILE_SIZE, RANK_ERROR = 800, 0.005
#: Size of a sketch of distinct values, as a power of two; the relative deviation is about 1.04 / sqrt(2^14), 0.8 percent.
DISTINCT_SIZE, DISTINCT_DEVIATION = 14, 0.0082
SKETCH = "column_name string, n_rows bigint, n_values bigint, min double, max double, quantiles binary, distinct binary"
KIND = "sketches:"


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, NumericType)]


def column_sketches(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per numeric column with the sketches of its values, from one pass; tasks send sketches, not values.

    NaN counts as lacking, like null.
    """
    columns = numeric_columns(df) if columns is None else list(columns)
    made = {}
    for i, c in enumerate(columns):
        v = amount(named(c)).cast("double")
        hashed = F.when(v.isNotNull(), F.xxhash64(v + F.lit(0.0)))  # both zeros alike, and null is no value
        made |= {
            f"n_values{i}": F.count(v), f"min{i}": F.min(v), f"max{i}": F.max(v),
            f"quantiles{i}": F.kll_sketch_agg_double(v, F.lit(QUANTILE_SIZE)), f"distinct{i}": F.hll_sketch_agg(hashed, F.lit(DISTINCT_SIZE)),
        }
    row = df.agg(F.count(F.lit(1)).alias("n_rows"), *[e.alias(n) for n, e in made.items()])
    names = ("n_values", "min", "max", "quantiles", "distinct")
    packed = [F.struct(F.lit(c).alias("column_name"), "n_rows", *[F.col(f"{n}{i}").alias(n) for n in names]) for i, c in enumerate(columns)]
    return row.select(F.explode(F.array(*packed)).alias("s")).select("s.*") if packed else row.sparkSession.createDataFrame([], SKETCH)


def merged_sketches(sketches: DataFrame) -> DataFrame:
    """One row per column from the sketches of several parts of a table."""
    return sketches.groupBy("column_name").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_values").alias("n_values"), F.min("min").alias("min"), F.max("max").alias("max"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"), F.hll_union_agg("distinct").alias("distinct"),
    )


def summary_of(sketches: DataFrame) -> DataFrame:
    """(column_name, n_rows, n_values, n_distinct, min, p25, p50, p75, max): quartiles and distinct values approximate."""
    some = F.col("n_values") > 0
    quartiles = [F.when(some, F.kll_sketch_get_quantile_double("quantiles", F.lit(p / 100))).alias(f"p{p}") for p in (25, 50, 75)]
    distinct = F.when(some, F.hll_sketch_estimate("distinct")).otherwise(F.lit(0)).alias("n_distinct")
    return sketches.select("column_name", "n_rows", "n_values", distinct, "min", *quartiles, "max")


def approx_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The summary of a table's numeric columns in one pass of small buffers; `numeric_summary` is the exact one."""
    return summary_of(column_sketches(df, columns))


# Stored sketches


def sketch_folders(spark: SparkSession, root: str, layer: str, name: str) -> int:
    """Store the sketches of those folders of a table that have none yet; returns how many that were.

    Each load of new rows is a folder of its own, so a new day costs the scan of that day.
    """
    entry = current(spark, root, layer)[name.lower()]
    lacking = [folder for folder in entry.folders if KIND + folder not in entry.facts]
    if not lacking:
        return 0
    facts = {k: v for k, v in entry.facts.items() if not k.startswith(KIND) or k.removeprefix(KIND) in entry.folders}
    for folder in lacking:
        facts[KIND + folder] = new_folder(name, "sketches")
        rows = spark.read.schema(entry.struct).parquet(f"{root}/{layer}/{folder}")
        column_sketches(rows).write.parquet(f"{root}/{layer}/{facts[KIND + folder]}")
    changed = replace(entry, facts=facts)
    commit(spark, root, layer, {name: changed}, expected={name: entry})
    return len(lacking)


def stored_summary(spark: SparkSession, root: str, layer: str, name: str) -> DataFrame:
    """The summary of a stored table from its sketches alone, after those that are lacking have been made."""
    sketch_folders(spark, root, layer, name)
    entry = current(spark, root, layer)[name.lower()]
    parts = [spark.read.schema(SKETCH).parquet(f"{root}/{layer}/{path}") for kind, path in sorted(entry.facts.items()) if kind.startswith(KIND)]
    return summary_of(merged_sketches(reduce(DataFrame.unionAll, parts)))
