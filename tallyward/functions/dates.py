"""Date expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions.text import named

# Order matters: year first, then month first, then day first.
DATE_FORMATS = ("yyyy-M-d[ HH:mm:ss]",) + tuple(
    order.replace("/", sign) for sign in "/-." for order in ("M/d/yyyy", "d/M/yyyy")
)

# A date text of at most this length has no room for a four-digit year.
SHORT_DATE = 8

SHORT_DATE_SHAPE = r"^\d{1,2}[/.-]\d{1,2}[/.-]\d{2}$"


def month_text(column: Column) -> Column:
    """Month as two digits."""
    return two_digits(F.month(column))


def two_digits(month: Column) -> Column:
    return F.lpad(month.cast("string"), 2, "0")


def year_text(column: Column) -> Column:
    """Year as four digits."""
    return F.lpad(F.year(column).cast("string"), 4, "0")


def in_year(column: Column, year: int) -> Column:
    """Calendar-year filter as a half-open range on the bare column, so that it reaches the file scan."""
    return (column >= F.lit(f"{year:04d}-01-01")) & (column < F.lit(f"{year + 1:04d}-01-01"))


def rows_of_year(df: DataFrame, column: str, year: int) -> DataFrame:
    """Rows of a calendar year; of a table stored by the year of that column, only its folder is read."""
    rows = df.where(in_year(named(column), year))
    folder = year_column(column)
    return rows.where(named(folder) == year) if folder in df.columns else rows


def year_column(column: str) -> str:
    """The column that a table stored by the year of `column` is partitioned by."""
    return f"{column}_year"


def since(column: Column, day: str) -> Column:
    """Rows on or after a day given as yyyy-MM-dd; the column stays bare, as above."""
    return column >= F.lit(day)


def date_of_key(column: Column) -> Column:
    """Date of an integer key of the form yyyyMMdd; null where the key is no date."""
    return _read(column.cast("string"), "yyyyMMdd")


def age_in_years(birth: Column, as_of: Column | None = None) -> Column:
    """Difference of the calendar years, with today's as the default."""
    return F.year(F.current_date() if as_of is None else as_of) - F.year(birth)


def short_date_flag(column: Column) -> Column:
    """1 where the text is too short for a full year, or null; else 0."""
    return F.when(F.length(column.cast("string")) > SHORT_DATE, 0).otherwise(1)


def parse_date(column: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """First format that reads the whole text; null if none does."""
    text = column.cast("string")
    return F.coalesce(*[_parse_one(text, f) for f in formats])


def _parse_one(text: Column, date_format: str) -> Column:
    """A text of another shape is not even tried: each failed try costs an exception inside the parser."""
    return F.when(text.rlike(_shape(date_format)), _read(text, date_format))


def _read(text: Column, date_format: str) -> Column:
    """The time of a text, whatever the session's time zone: read as UTC and counted from 1970 without a zone."""
    utc = F.try_to_timestamp(F.concat(text, F.lit("Z")), F.lit(f"{date_format}XXX"))
    return F.timestamp_add("MICROSECOND", F.unix_micros(utc), F.lit("1970-01-01").cast("timestamp_ntz"))


def _shape(date_format: str) -> str:
    """Regular expression that every text of the format meets."""
    shape = ""
    for part in re.finditer(r"'[^']*'|([A-Za-z])\1*|.", date_format):
        token = part.group()
        if token in ("[", "]"):
            shape += "(" if token == "[" else ")?"
        elif part.group(1) is None:
            shape += ".*" if token.startswith("'") else re.escape(token)
        elif token[0] in "MdHhms" and len(token) <= 2:
            shape += r"\d{1,2}" if len(token) == 1 else r"\d{2}"
        else:
            shape += r"\d{4}" if token == "yyyy" else ".+"
    return f"^{shape}$"


def with_century(column: Column, century: Column) -> Column:
    """Short date text with the century put before its two-digit year."""
    text = column.cast("string")
    full = F.concat(F.substring(text, F.lit(1), F.length(text) - 2), century, F.right(text, F.lit(2)))
    return F.when(text.rlike(SHORT_DATE_SHAPE), full).otherwise(text)
