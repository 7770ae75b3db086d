"""The three table layers: raw, normalized, errors. A write replaces a table in one step, see `manifest`."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyward.functions.dates import year_column
from tallyward.functions.text import named
from tallyward.sources.manifest import Stored, commit, current, new_folder, rows_of

RAW, NORMALIZED, ERRORS = "raw", "normalized", "errors"


def layer_path(root: str, layer: str, name: str) -> str:
    return f"{root}/{layer}/{name.lower()}"


def stage_layer(
    df: DataFrame,
    root: str,
    layer: str,
    name: str,
    partition_by: Sequence[str] = (),
    sorted_by: Sequence[str] = (),
    gather: bool = True,
) -> Stored:
    """Write `df` to a fresh folder that no reader sees before a commit; its rows are counted during the write.

    Rows are gathered by the partition columns, else every task writes a small file per partition; a
    partition that grows large is split again. Where tasks are large and partitions few, `gather=False` spares
    that shuffle. `sorted_by` sorts within each file, without a shuffle.
    """
    if partition_by and gather:
        df = df.hint("rebalance", *partition_by)
    if sorted_by:
        df = df.sortWithinPartitions(*([] if gather else partition_by), *sorted_by)
    # Counted last: below a shuffle, the count of an empty table gets lost.
    written, folder = Observation(), new_folder(name)
    counted = df.observe(written, F.count(F.lit(1)).alias("n_rows"))
    counted.write.partitionBy(*partition_by).parquet(f"{root}/{layer}/{folder}")
    return Stored((folder,), df.schema.json(), written.get["n_rows"], tuple(partition_by))


def stage_by_year(df: DataFrame, root: str, layer: str, name: str, date: str, gather: bool = True) -> Stored:
    """As `stage_layer`, with a folder per year of a date; that year is one more column."""
    dated = df.withColumn(year_column(date), F.year(named(date)))
    return stage_layer(dated, root, layer, name, [year_column(date)], [date], gather)


def write_layer(
    df: DataFrame,
    root: str,
    layer: str,
    name: str,
    partition_by: Sequence[str] = (),
    sorted_by: Sequence[str] = (),
) -> int:
    """Replace a stored table by `df` in one step; returns the rows written."""
    entry = stage_layer(df, root, layer, name, partition_by, sorted_by)
    commit(df.sparkSession, root, layer, {name: entry})
    return entry.n_rows


def write_by_year(df: DataFrame, root: str, layer: str, name: str, date: str, gather: bool = True) -> int:
    """Replace a stored table by `df` in one step, with a folder per year of a date; that year is one more column."""
    entry = stage_by_year(df, root, layer, name, date, gather)
    commit(df.sparkSession, root, layer, {name: entry})
    return entry.n_rows


def read_layer(
    spark: SparkSession, root: str, layer: str, name: str, schema: StructType | str | None = None
) -> DataFrame:
    """A stored table, as the last commit left it, by default with the schema it was written with."""
    entry = current(spark, root, layer).get(name.lower())
    if entry is None:
        raise FileNotFoundError(f"there is no table {name!r} in {root}/{layer}")
    return rows_of(spark, root, layer, entry, schema)


def remove_others(spark: SparkSession, root: str, names: Sequence[str]) -> list[str]:
    """Remove the stored tables of all layers but those named; returns what was removed."""
    kept, gone = {name.lower() for name in names}, []
    for layer in (RAW, NORMALIZED, ERRORS):
        others = [name for name in current(spark, root, layer) if name not in kept]
        if others:
            commit(spark, root, layer, dict.fromkeys(others))
        gone += [layer_path(root, layer, name) for name in others]
    return gone
