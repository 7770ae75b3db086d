"""Reports: query results saved as CSV."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyward.sources.manifest import Stored, commit, current, new_folder
from tallyward.sources.tables import CSV_OPTIONS

REPORTS = "reports"

# Stands for null in a report, and so cannot be a text of it; an empty text is a quoted empty field.
NULL = "\\N"

# Blanks at the ends of a text and microseconds are kept.
WHOLE_VALUES = {
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]XXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
    "nullValue": NULL,
}


def report_path(spark: SparkSession, root: str, name: str) -> str:
    """The folder with the files of a report, as the last commit left it."""
    entry = current(spark, root, REPORTS).get(name.lower())
    if entry is None:
        raise FileNotFoundError(f"there is no report {name!r} in {root}/{REPORTS}")
    return f"{root}/{REPORTS}/{entry.folders[0]}"


def stage_report(df: DataFrame, root: str, name: str) -> Stored:
    """Write a report to a fresh folder that no reader sees before a commit.

    Not squeezed into one file: a report per product grows with the products. Small results come out
    as one file anyway, and the files of a sorted result follow each other in order.
    """
    options = {k: v for k, v in CSV_OPTIONS.items() if k != "mode"}
    written, folder = Observation(), new_folder(name)
    counted = df.observe(written, F.count(F.lit(1)).alias("n_rows"))
    counted.write.options(**options, **WHOLE_VALUES).csv(f"{root}/{REPORTS}/{folder}")
    return Stored((folder,), df.schema.json(), written.get["n_rows"])


def staged_report(spark: SparkSession, root: str, entry: Stored) -> DataFrame:
    """A report as read back from the files of an entry, committed or not."""
    return _read_csv(spark, f"{root}/{REPORTS}/{entry.folders[0]}", entry.struct)


def write_report(df: DataFrame, root: str, name: str) -> DataFrame:
    """Replace the report `name` in one step, and return it as read back from its files."""
    entry = stage_report(df, root, name)
    commit(df.sparkSession, root, REPORTS, {name: entry})
    return staged_report(df.sparkSession, root, entry)


def _read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.read.schema(schema).options(**CSV_OPTIONS, **WHOLE_VALUES, multiLine=True).csv(path)


def read_report(spark: SparkSession, root: str, name: str, schema: StructType | str) -> DataFrame:
    return _read_csv(spark, report_path(spark, root, name), schema)


def clear_reports(spark: SparkSession, root: str) -> None:
    """Remove all reports, in one step."""
    commit(spark, root, REPORTS, {}, whole=True)


def report_from_sql(
    spark: SparkSession, tables: Mapping[str, DataFrame], query: str, root: str, name: str
) -> DataFrame:
    """Run a Spark SQL query over the named tables and save its result as a report."""
    return write_report(spark.sql(query, **{k: v for k, v in tables.items() if f"{{{k}}}" in query}), root, name)
