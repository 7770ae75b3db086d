"""What is checked and normalized in each table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions.dates import DATE_FORMATS, parse_date, short_date_flag
from tallyward.functions.numbers import missing
from tallyward.functions.text import has_size_letter, named, phone_number
from tallyward.operators.repair import complete_text, is_date
from tallyward.operators.rules import Rule


@dataclass(frozen=True)
class TableSpec:
    """`key` is unique in the normalized table; `identify` names a row in the shared log.

    `wide` marks large tables, see `error_log`. `stored_by` is the date of a fact: the normalized table has a
    folder per year of it, in files sorted by it, so that a date filter opens few files and skips most of
    their pages.
    """

    name: str
    key: tuple[str, ...] = ()
    identify: tuple[str, ...] = ()
    rules: tuple[Rule, ...] = ()
    required: tuple[str, ...] = ()
    integer_columns: tuple[str, ...] = ()
    date_columns: tuple[str, ...] = ()
    phone_columns: tuple[str, ...] = ()
    date_formats: tuple[str, ...] = DATE_FORMATS
    wide: bool = False
    stored_by: str | None = None

    @property
    def row_key(self) -> tuple[str, ...]:
        return self.key or self.identify


def _any(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def date_rules(columns: Sequence[str], formats: Sequence[str] = DATE_FORMATS) -> tuple[Rule, ...]:
    """Rows whose date text is short or null, and rows whose date text cannot be read even after repair."""

    def full(column: str) -> str:
        return f"_full_{column}"

    def texts(df: DataFrame) -> list[str]:
        return [c for c in columns if not is_date(df, c)]

    def unreadable(df: DataFrame) -> Column:
        conditions = [named(c).isNotNull() & parse_date(named(full(c)), formats).isNull() for c in texts(df)]
        return _any(conditions) if conditions else F.lit(False)

    return (
        Rule("date_inconcistency", lambda df: _any([short_date_flag(named(c)) == 1 for c in columns])),
        Rule("date_unparseable", unreadable, lambda df: {full(c): complete_text(df, c, formats) for c in texts(df)}),
    )


def customer_spec(formats: Sequence[str] = DATE_FORMATS) -> TableSpec:
    dates = ("BirthDate", "DateFirstPurchase")
    unreadable_phone = Rule(
        "phone_unparseable", lambda df: named("Phone").isNotNull() & phone_number(named("Phone")).isNull()
    )
    return TableSpec(
        "dimcustomer",
        key=("CustomerKey",),
        rules=(*date_rules(dates, formats), unreadable_phone),
        integer_columns=("CustomerKey",),
        date_columns=dates,
        phone_columns=("Phone",),
        date_formats=tuple(formats),
    )


# The integer keys of the sales table, which has no unique key.
SALES_KEYS = (
    "ProductKey",
    "OrderDateKey",
    "DueDateKey",
    "ShipDateKey",
    "ResellerKey",
    "EmployeeKey",
    "PromotionKey",
    "CurrencyKey",
    "SalesTerritoryKey",
)

# The spellings of the error types are fixed values.
SPECS = {
    spec.name: spec
    for spec in (
        TableSpec(
            "dimaccounts",
            key=("AccountKey",),
            rules=(Rule("potential_data_corruption", lambda df: ~missing(df, "CustomMembers")),),
            integer_columns=("AccountKey",),
        ),
        customer_spec(),
        TableSpec(
            "dimproduct",
            key=("ProductKey",),
            rules=(
                Rule("potentially_dismissed_prod", lambda df: missing(df, "StartDate") | missing(df, "Status")),
                Rule("size_inconcistency", lambda df: has_size_letter(named("Size"))),
            ),
            integer_columns=("ProductKey",),
        ),
        TableSpec("dimsalesterritory", key=("SalesTerritoryKey",), required=("SalesTerritoryRegion",)),
        TableSpec("dimscenario", key=("ScenarioKey",)),
        TableSpec("factfinance", key=("FinanceKey",), integer_columns=("FinanceKey",), wide=True, stored_by="Date"),
        TableSpec(
            "factresellersales",
            identify=SALES_KEYS,
            integer_columns=SALES_KEYS,
            wide=True,
            stored_by="OrderDate",
        ),
    )
}


def spec_of(name: str, formats: Sequence[str] | None = None) -> TableSpec:
    """Spec of a table, by name in any case; `formats` replaces the date formats."""
    if name.lower() not in SPECS:
        raise KeyError(f"no checks are defined for table {name!r}; defined: {', '.join(SPECS)}")
    spec = SPECS[name.lower()]
    if formats is None or not spec.date_columns:
        return spec
    return replace(customer_spec(formats), name=spec.name)
