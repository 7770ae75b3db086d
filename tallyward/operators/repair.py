"""Repair of dates whose year has only two digits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

from tallyward.functions.dates import DATE_FORMATS, parse_date, short_date_flag, with_century
from tallyward.functions.text import named


def century_of(df: DataFrame, column: str, formats: Sequence[str] = DATE_FORMATS) -> DataFrame:
    """One row: the first two digits of the median year among the dates with a full year.

    The median keeps one entry per distinct year, at most 10,000, whatever the number of rows. Short dates
    are left out by the condition and not by a filter, so that several columns share one scan.
    """
    year = F.year(parse_date(named(column), formats))
    full_year = F.when(short_date_flag(named(column)) == 0, year)
    return df.agg(F.substring(F.median(full_year).cast("string"), 1, 2).alias("century"))


def is_date(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, (DateType, TimestampType, TimestampNTZType))


def complete_text(df: DataFrame, column: str, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """The text of a date with a full year: a short one gets the column's century. To be read by `parse_date`.

    A column of its own, so that the century is looked up once and not once per format.
    """
    text = named(column)
    century = century_of(df, column, formats).scalar()
    return F.when(short_date_flag(text) == 0, text).otherwise(with_century(text, century))


def repair_dates(df: DataFrame, columns: Sequence[str], formats: Sequence[str] = DATE_FORMATS) -> DataFrame:
    """Replace text columns by their dates, with short years placed in the column's century. Columns that hold
    dates or times already stay as they are, but for their type."""
    texts = [c for c in columns if not is_date(df, c)]
    completed = df.withColumns({c: complete_text(df, c, formats) for c in texts}) if texts else df
    times = {c: parse_date(named(c), formats) for c in texts}
    times |= {c: named(c).cast("timestamp_ntz") for c in columns if c not in texts}
    return completed.withColumns(times) if times else df
