"""Date formats settled by what a whole column shows, not row by row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions.dates import parse_date
from tallyward.functions.text import named

#: Formats that a column may be written in, by preference: the first of those that read most texts wins. A text may have
#: a time behind its date, after a blank or a T.
DATES = (
    "yyyy-M-d", "yyyy/M/d", "yyyy.M.d", "yyyyMMdd", "d/M/yyyy", "M/d/yyyy", "d-M-yyyy", "M-d-yyyy", "d.M.yyyy", "M.d.yyyy",
    "d MMM yyyy", "d MMMM yyyy", "MMM d, yyyy", "MMMM d, yyyy", "MMM d yyyy", "MMMM d yyyy", "d-MMM-yyyy",
)
TIME = r"^(.*\d)[T ](\d{1,2}:\d{2}(?::\d{2}(?:\.\d{1,6})?)?)$"


def _date_part(text: Column) -> Column:
    """A text without the time behind its date."""
    return F.coalesce(F.nullif(F.regexp_extract(text, TIME, 1), F.lit("")), text)


def _time_part(text: Column) -> Column:
    """Microseconds since midnight of the time behind a date; 0 without one, null if there is no such time."""
    time = F.regexp_extract(text, TIME, 2)
    hour, minute = (F.split_part(time, F.lit(":"), F.lit(i)).try_cast("int") for i in (1, 2))
    second = F.coalesce(F.nullif(F.split_part(time, F.lit(":"), F.lit(3)), F.lit("")), F.lit("0")).try_cast("decimal(9,6)")
    there = (hour < 24) & (minute < 60) & (second < 60)
    micros = ((hour * 3600 + minute * 60).cast("bigint") * 1_000_000) + (second * 1_000_000).cast("bigint")
    return F.when(time == "", F.lit(0).cast("bigint")).when(there, micros)


def read_as(text: Column, date_format: str) -> Column:
    """The time of a text in one format, null if it is in none or does not exist."""
    trimmed = F.trim(text.cast("string"))
    day, time = parse_date(_date_part(trimmed), [date_format]), _time_part(trimmed)
    return F.when(time.isNotNull(), F.timestamp_add("MICROSECOND", time, day))


def format_votes(df: DataFrame, columns: Sequence[str], formats: Sequence[str] = DATES) -> DataFrame:
    """(column_name, format, n_read, n_texts): how many texts of each column every format admits, from one pass.

    Every text becomes a row with its column's number, so that a format is one expression, whatever the number of columns.
    """
    texts = F.array(*[F.struct(F.lit(i).alias("i"), F.trim(named(c).cast("string")).alias("t")) for i, c in enumerate(columns)])
    each = df.select(F.explode(texts).alias("v")).select("v.i", "v.t")
    parts = each.select("i", "t", _date_part(F.col("t")).alias("d"), _time_part(F.col("t")).isNotNull().alias("timed"))
    read = parts.select("i", "t", *[(F.col("timed") & parse_date(F.col("d"), [f]).isNotNull()).alias(f"r{j}") for j, f in enumerate(formats)])
    own = lambda i, met: F.count(F.when((F.col("i") == i) & met, F.lit(1)))
    reads = [own(i, F.col(f"r{j}")).alias(f"r{i}_{j}") for i in range(len(columns)) for j in range(len(formats))]
    row = read.agg(*reads, *[own(i, F.col("t").isNotNull()).alias(f"n{i}") for i in range(len(columns))])
    packed = [
        F.struct(F.lit(c).alias("column_name"), F.lit(f).alias("format"), F.lit(j).alias("place"), F.col(f"r{i}_{j}").alias("n_read"), F.col(f"n{i}").alias("n_texts"))
        for i, c in enumerate(columns) for j, f in enumerate(formats)
    ]
    return row.select(F.explode(F.array(*packed)).alias("v")).select("v.*")


def settled_formats(df: DataFrame, columns: Sequence[str], formats: Sequence[str] = DATES) -> DataFrame:
    """(column_name, format, n_read, n_texts): the one order in which each column is read: that of most texts, and among
    equals the first one of the list."""
    votes = format_votes(df, columns, formats)
    best = F.max_by(F.struct("format", "n_read", "n_texts"), F.struct("n_read", -F.col("place"))).alias("best")
    return votes.groupBy("column_name").agg(best).select("column_name", "best.*")


def parse_by_evidence(df: DataFrame, columns: Sequence[str], formats: Sequence[str] = DATES) -> DataFrame:
    """Date texts as times, every column in the one format that most of its texts are in; what is not becomes null.

    In a column with `13/02/2011`, `02/03/2011` is the second of March too, where row by row it would be read as the
    first format of a list says. One pass counts the formats; the settled ones, one row, are a scalar subquery of the
    second, looked up once for all columns: repeated for every column and format, its plan outgrows the driver. Formats
    that write the day before the month and those that write it after never mix in one column.
    """
    formats_of = [F.max(F.when(F.col("column_name") == c, F.col("format"))).alias(f"f{i}") for i, c in enumerate(columns)]
    settled = settled_formats(df, columns, formats).groupBy().agg(F.struct(*formats_of).alias("settled"))
    # Columns of their own, so that each is worked out once and not once per format.
    chosen, *helpers = (_unused(df, n) for n in ("_settled", *[f"_{part}{i}" for i in range(len(columns)) for part in ("date", "micros")]))
    added = {chosen: settled.scalar()}
    for i, c in enumerate(columns):
        text = F.trim(named(c).cast("string"))
        added |= {helpers[2 * i]: _date_part(text), helpers[2 * i + 1]: _time_part(text)}
    changed = {}
    for i, c in enumerate(columns):
        date, micros = named(helpers[2 * i]), named(helpers[2 * i + 1])
        day = F.coalesce(*[F.when(named(chosen)[f"f{i}"] == f, parse_date(date, [f])) for f in formats])
        changed[c] = F.when(micros.isNotNull(), F.timestamp_add("MICROSECOND", micros, day))
    return df.withColumns(added).withColumns(changed).drop(chosen, *helpers)


def _unused(df: DataFrame, name: str) -> str:
    """A name that no column of the table has."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name
