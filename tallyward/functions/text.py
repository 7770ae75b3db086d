"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a size given as a letter code instead of a measure.
SIZE_LETTERS = "S|M|L|XL"

# Fixed value: the signs that may stand between the digits of a phone number.
PHONE_SIGNS = "()- "


def same_text(column: Column, text: str) -> Column:
    """Text match that ignores case."""
    return column.ilike(text)


def has_size_letter(column: Column) -> Column:
    """True where the text holds a letter size; null counts as no match in a filter."""
    return column.rlike(SIZE_LETTERS)


def phone_number(column: Column) -> Column:
    """Digits of a phone number as an integer; null where other signs remain."""
    return F.translate(column.cast("string"), PHONE_SIGNS, "").try_cast("bigint")


def fixed_point(column: Column) -> Column:
    """Number as text with six decimals; null stays null."""
    return F.when(column.isNotNull(), F.format_string("%f", column))


def joined_key(columns: list[str]) -> Column:
    """Key columns as one text, for logs over tables of different shape: a JSON array, in which no two keys look alike."""
    return F.to_json(F.array(*[F.expr(f"cast({quoted(c)} as string)") for c in columns]))


def quoted(column: str) -> str:
    """Reference to a column of exactly this name, also where the name holds a dot or a space."""
    return "`" + column.replace("`", "``") + "`"


def named(column: str) -> Column:
    """Column of exactly this name."""
    return F.col(quoted(column))
