"""Number expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType, IntegralType

from tallyward.functions.text import named

# Part of a floating-point amount that is added as a decimal. Ten digits after the point hold every amount of
# money; eighteen before it leave room for 10**10 of the greatest in one sum.
EXACT = "decimal(28,10)"


def amount(column: Column) -> Column:
    """A number with NaN as null."""
    return F.nanvl(column.cast("double"), F.lit(None).cast("double"))


def sum_parts(df: DataFrame, column: str, name: str) -> dict[str, Column]:
    """Aggregates whose values may be added again, and from which `sum_of` makes the sum of a column.

    Decimals and integers are added as they are. A floating-point number is cut into a decimal, which adds up
    the same in any order, and what the decimal does not hold: zero for amounts of money, the whole for a
    number beyond its range or an infinite one. So nothing is rounded away, and sums of money do not depend
    on the order in which tasks finish.
    """
    kind, value = df.schema[column].dataType, named(column)
    if isinstance(kind, DecimalType):
        return {name: F.sum(value)}
    if isinstance(kind, IntegralType):
        return {name: F.sum(value.cast("decimal(20,0)"))}
    value = amount(value)
    exact = F.coalesce(value.try_cast(EXACT), F.when(value.isNotNull(), F.lit(0).cast(EXACT)))
    return {name: F.sum(exact), f"{name}_rest": F.sum(value - exact.cast("double"))}


def sum_of(parts: Mapping[str, Column], name: str) -> Column:
    """The sum itself, from the columns that hold the parts: a decimal, or a double if there is a rest."""
    rest = f"{name}_rest"
    return F.col(name).cast("double") + F.col(rest) if rest in parts else F.col(name)


def money_sum(df: DataFrame, column: str) -> Column:
    """Sum of an amount; null where there is no amount."""
    parts = list(sum_parts(df, column, "sum").values())
    return parts[0] if len(parts) == 1 else parts[0].cast("double") + parts[1]


def money_mean(df: DataFrame, column: str) -> Column:
    """Mean of an amount by its sum; null where there is no amount."""
    n = F.count(amount(named(column)))
    return F.when(n > 0, money_sum(df, column).cast("double") / n)


def missing(df: DataFrame, column: str) -> Column:
    """True where there is no value: null, or NaN in a floating-point column."""
    value = named(column)
    if isinstance(df.schema[column].dataType, (DoubleType, FloatType)):
        return value.isNull() | F.isnan(value)
    return value.isNull()


def without_nan(df: DataFrame) -> DataFrame:
    """NaN as null in every floating-point column."""
    floats = [f for f in df.schema if isinstance(f.dataType, (DoubleType, FloatType))]
    return df.withColumns({f.name: F.when(~F.isnan(named(f.name)), named(f.name)) for f in floats}) if floats else df
