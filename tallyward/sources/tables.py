"""Loading a set of named tables."""

from __future__ import annotations

import json
import warnings
from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Source name -> table name.
TABLE_NAMES = {
    "DimAccounts": "dimaccounts",
    "DimCustomer": "dimcustomer",
    "DimProduct": "dimproduct",
    "DimSalesTerritory": "dimsalesterritory",
    "DimScenario": "dimscenario",
    "FactFinance": "factfinance",
    "FactResellerSales": "factresellersales",
}

CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "mode": "FAILFAST"}


class LackingTable(KeyError):
    """A table that was asked for is not there."""


class Tables(dict):
    """Tables by name. Asking for a table that was not loaded says which one is lacking.

    `absent` holds the names that were asked for and not found, each with the path it was looked for at.
    """

    def __init__(self, *args, **kwargs) -> None:
        super().__init__(*args, **kwargs)
        self.absent: dict[str, str] = {}

    def __missing__(self, name: str) -> DataFrame:
        raise LackingTable(f"table {name!r} was not loaded; loaded: {', '.join(sorted(self)) or 'none'}")


def table_names(config_path: str) -> dict[str, str]:
    """Source-to-table names from a JSON file of the form {"DATABASE": {"TABLES": {...}}}."""
    with open(config_path) as f:
        return json.load(f)["DATABASE"]["TABLES"]


def load_tables(
    spark: SparkSession,
    directory: str,
    names: Mapping[str, str] | Iterable[str] = TABLE_NAMES,
    file_format: str = "parquet",
    schemas: Mapping[str, StructType | str] | None = None,
    multi_line: bool = False,
) -> Tables:
    """The tables among `names` that lie in `directory`, one file or folder each, read lazily.

    A name without a file is warned of and kept in `absent` of the result.

    CSV needs a schema per table, so that no pass over the data infers one. `multi_line` lets a CSV
    value hold line breaks, but then a file cannot be split among tasks.
    """
    if file_format not in ("parquet", "csv"):
        raise ValueError(f"unknown file format {file_format!r}: parquet or csv")
    pairs = names.items() if isinstance(names, Mapping) else [(n, n) for n in names]
    tables = Tables()
    for source, table in pairs:
        reader = spark.read
        if schemas and source in schemas:
            reader = reader.schema(schemas[source])
        elif file_format == "csv":
            raise ValueError(f"no schema given for CSV table {source!r}")
        if file_format == "csv":
            reader = reader.options(**CSV_OPTIONS, multiLine=multi_line)
        path = f"{directory}/{source}.{file_format}"
        try:
            tables[table] = reader.format(file_format).load(path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            tables.absent[table] = path
    if tables.absent:
        warnings.warn("not found: " + ", ".join(f"{t} at {path}" for t, path in tables.absent.items()), stacklevel=2)
    return tables
