"""Error logs and normalized tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.functions.numbers import missing, without_nan
from tallyward.functions.text import joined_key, named, phone_number
from tallyward.operators.keys import key_violations
from tallyward.operators.repair import repair_dates
from tallyward.operators.rules import common_log, error_log
from tallyward.plans.specs import TableSpec


def table_errors(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Error log of one table, with the raw values."""
    return error_log(df, spec.rules, spec.wide)


def normalize(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The table without rows that lack a required column, with repaired dates, phones and integer keys, and null for NaN.

    Columns keep their order. Normalizing a normalized table changes nothing.
    """
    kept = without_nan(df)
    for column in spec.required:
        kept = kept.where(~missing(kept, column))
    kept = repair_dates(kept, spec.date_columns, spec.date_formats)
    changed = {c: phone_number(named(c)) for c in spec.phone_columns}
    changed |= {c: named(c).try_cast("bigint") for c in spec.integer_columns}
    return kept.withColumns(changed) if changed else kept


def all_errors(tables: Mapping[str, DataFrame], specs: Mapping[str, TableSpec]) -> DataFrame:
    """One error log over all given tables, repeated rows of each included."""
    logs = [common_log(table_errors(df, specs[n]), n, specs[n].row_key) for n, df in tables.items()]
    return reduce(DataFrame.unionByName, logs)


def all_key_violations(tables: Mapping[str, DataFrame], keys: Mapping[str, tuple[str, ...]]) -> DataFrame:
    """Repeated and null keys over all given tables that have a key."""
    found = [
        key_violations(df, keys[n]).select(
            F.lit(n).alias("table_name"), joined_key(list(keys[n])).alias("row_key"), "copies"
        )
        for n, df in tables.items()
        if keys.get(n)
    ]
    return reduce(DataFrame.unionByName, found)
