"""Column profiles and grouped measures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, DoubleType, IntegerType, LongType, NumericType, TimestampNTZType, TimestampType

from tallyward.functions.numbers import missing
from tallyward.functions.text import fixed_point, named
from tallyward.operators.quantiles import quantiles

# Type names of the schema report; every other type is text.
SQL_TYPES = {
    DoubleType: "float",
    TimestampNTZType: "date",
    TimestampType: "date",
    DateType: "date",
    LongType: "int",
    IntegerType: "int",
}
QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def sql_type(data_type: DataType) -> str:
    return SQL_TYPES.get(type(data_type), "text")


def table_profile(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, number of values. A single pass over the table."""
    counts = df.agg(*[F.count(F.when(~missing(df, c), 1)).alias(f"n{i}") for i, c in enumerate(df.columns)])
    rows = [
        F.struct(
            F.lit(i + 1).alias("position"),
            F.lit(field.name).alias("column_name"),
            F.lit(sql_type(field.dataType)).alias("sql_type"),
            F.col(f"n{i}").alias("n_values"),
        )
        for i, field in enumerate(df.schema)
    ]
    return counts.select(F.inline(F.array(*rows)))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, NumericType)]


def numeric_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per numeric column, all of them by default: count, mean, sample deviation, least, exact quartiles,
    greatest. Two passes over the table, whatever the number of columns."""
    columns = numeric_columns(df) if columns is None else list(columns)
    value = {c: F.when(~missing(df, c), named(c).cast("double")) for c in columns}
    measures = {"n": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    basics = df.agg(*[f(value[c]).alias(f"{name}_{i}") for i, c in enumerate(columns) for name, f in measures.items()])
    rows = [
        F.struct(F.lit(i).alias("number"), F.lit(c).alias("column_name"), *[F.col(f"{name}_{i}").alias(name) for name in measures])
        for i, c in enumerate(columns)
    ]
    quartiles = F.broadcast(quantiles(df, columns, list(QUARTILES.values())))  # one row per column
    named_quartiles = [F.col("quantiles")[i].alias(name) for i, name in enumerate(QUARTILES)]
    summary = basics.select(F.inline(F.array(*rows))).join(quartiles, "number", "left")
    return summary.select("column_name", "n", "mean", "std", "min", *named_quartiles, "max")


def numeric_summary_text(summary: DataFrame) -> DataFrame:
    """The measures of a numeric summary as fixed-point text."""
    measures = [c for c in summary.columns if c != "column_name"]
    return summary.withColumns({c: fixed_point(F.col(c).cast("double")) for c in measures})


def mean_by_group(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Mean of a column per key; rows without a key are left out."""
    present = F.when(~missing(df, value), named(value))
    return df.where(~missing(df, key)).groupBy(named(key)).agg(F.avg(present).alias(name))


def count_by_group(df: DataFrame, key: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Number of values of each column per key; all other columns by default, no row without a key."""
    counted = [c for c in df.columns if c != key] if columns is None else columns
    counts = [F.count(F.when(~missing(df, c), 1)).alias(c) for c in counted]
    return df.where(~missing(df, key)).groupBy(named(key)).agg(*counts)


def count_by_band(df: DataFrame, value: str, bands: Sequence[tuple[float | None, str]], band: str) -> DataFrame:
    """Number of rows per band of a numeric column; a band holds what is below its bound."""
    label: Column | None = None
    for bound, name in bands:
        if bound is None:
            label = F.lit(name) if label is None else label.otherwise(F.lit(name))
        else:
            condition = named(value) < F.lit(bound)
            label = F.when(condition, name) if label is None else label.when(condition, name)
    return df.where(~missing(df, value)).groupBy(label.alias(band)).agg(F.count(F.lit(1)).alias("n"))


def sum_by_date(df: DataFrame, date: str, value: str, name: str) -> DataFrame:
    """Sum per date, in order of date; rows without a date are left out."""
    present = F.when(~missing(df, value), named(value))
    sums = df.where(named(date).isNotNull()).groupBy(named(date)).agg(F.sum(present).alias(name))
    return sums.orderBy(named(date))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(named(column)).distinct()


def null_rows(df: DataFrame, column: str) -> DataFrame:
    """Rows without a value in `column`."""
    return df.where(missing(df, column))


def head_rows(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """First rows in the order of the given columns, so that the answer is fixed."""
    return df.orderBy(*[named(c) for c in order]).limit(n)
