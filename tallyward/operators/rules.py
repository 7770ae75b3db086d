"""Data-quality rules and the error log."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions.text import joined_key, quoted
from tallyward.operators.duplicates import DUPLICATE, duplicate_rows, duplicate_wide_rows


@dataclass(frozen=True)
class Rule:
    """A row that meets `predicate` is logged under `error_type`; a null predicate counts as not met.

    `helpers` are columns that the predicate uses several times, by name; they are computed once per row.
    """

    error_type: str
    predicate: Callable[[DataFrame], Column]
    helpers: Callable[[DataFrame], dict[str, Column]] = lambda df: {}


def failing_rows(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per failed rule, with its `error_type`, from a single scan."""
    columns = [quoted(c) for c in df.columns]
    helpers = {name: column for rule in rules for name, column in rule.helpers(df).items()}
    rows = df.withColumns(helpers) if helpers else df
    # Each row once, or as often as it fails. Outer, since a plain explode makes the optimizer add a filter on the
    # array, which evaluates all predicates twice.
    failed = F.array_compact(F.array(*[F.when(r.predicate(df), F.lit(r.error_type)) for r in rules]))
    return rows.select(*columns, F.explode_outer(failed).alias("error_type")).where("error_type is not null")


def error_log(df: DataFrame, rules: Sequence[Rule], wide: bool = False) -> DataFrame:
    """Repeated rows and failing rows of one table, in its own columns and as they came in.

    A row that fails two rules is logged twice. `wide` chooses the search for repeated rows in large
    tables, which runs its first pass at once.
    """
    repeated = duplicate_wide_rows(df) if wide else duplicate_rows(df)
    log = repeated.withColumn("error_type", F.lit(DUPLICATE))
    return log.unionByName(failing_rows(df, rules), allowMissingColumns=True) if rules else log


def common_log(log: DataFrame, table_name: str, key: Sequence[str]) -> DataFrame:
    """An error log in the form shared by all tables."""
    data = [quoted(c) for c in log.columns if c != "error_type"]
    return log.select(
        F.lit(table_name).alias("table_name"),
        joined_key(list(key)).alias("row_key"),
        "error_type",
        F.to_json(F.struct(*data), {"ignoreNullFields": "false"}).alias("row_json"),
    )
