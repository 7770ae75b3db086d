"""Measures over a stored fact table that are kept as partial sums per year folder."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType

from tallyward.functions.numbers import sum_of, sum_parts
from tallyward.functions.text import quoted
from tallyward.sources.layers import stage_layer
from tallyward.sources.manifest import Stored, commit, current, new_folder, rows_of, written_folder
from tallyward.sources.shared import folders_in

KIND = "measure:"


def by_partition(spark: SparkSession, root: str, layer: str, entry: Stored) -> Stored:
    """The same table with a folder for each partition, so that each can be replaced by itself."""
    if not entry.partition_by:
        raise ValueError("the table is not stored by partition")
    folders = []
    for folder in entry.folders:
        whole = folder == written_folder(folder)
        inside = [f for f in folders_in(spark, f"{root}/{layer}/{folder}") if f.startswith(f"{entry.partition_by[0]}=")] if whole else []
        folders += [f"{folder}/{f}" for f in inside] if whole else [folder]
    return replace(entry, folders=tuple(folders))


def replace_partition(df: DataFrame, root: str, layer: str, name: str, value: object, gather: bool = True) -> int:
    """Replace the rows of one partition of a stored table in one step; returns the rows written.

    `df` has the table's columns, and the partition's value in its first partition column on every row. The folders of
    all other partitions stay as they are, and so does what is stored of them. The old rows are removed after the commit.
    `gather` as for `stage_layer`.
    """
    spark = df.sparkSession
    base = current(spark, root, layer)[name.lower()]
    split = by_partition(spark, root, layer, base)
    column = split.partition_by[0]
    tail = f"/{column}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}"
    others = tuple(f for f in split.folders if not f.endswith(tail))
    gone = replace(split, folders=tuple(f for f in split.folders if f.endswith(tail)))
    removed = rows_of(spark, root, layer, gone).count()
    df = df.select(*[quoted(f.name) for f in split.struct])
    if not df.where(~F.col(quoted(column)).eqNullSafe(F.lit(value))).isEmpty():
        raise ValueError(f"rows of another partition than {column}={value}")
    new = stage_layer(df, root, layer, name, split.partition_by, gather=gather)
    new = by_partition(spark, root, layer, new)
    entry = replace(split, folders=others + new.folders, n_rows=base.n_rows - removed + new.n_rows)
    commit(spark, root, layer, {name: entry}, expected={name: base})
    return new.n_rows


def _apart(entry: Stored, by: Sequence[str]) -> bool:
    """Whether rows of different folders are never of one group: the partition's value is one of the columns, and each has
    one folder. Numbers with a fraction do not count, as both zeros are one group."""
    if not entry.partition_by or entry.partition_by[0] not in by:
        return False
    values = [folder.rpartition("/")[2] for folder in entry.folders]
    return len(set(values)) == len(values) and not isinstance(entry.struct[entry.partition_by[0]].dataType, FloatType | DoubleType)


def stored_sum(spark: SparkSession, root: str, layer: str, name: str, measure: str, by: Sequence[str], sums: Mapping[str, str]) -> DataFrame:
    """Sums of a stored table's columns (new name: column) by others, with the rows of each group as `n_rows`.

    Partial sums are stored for every partition of the table under the name of the measure, and only partitions that have
    none are read: after one year is replaced, that is one folder. A measure's name stands for one set of columns.
    Groups of different folders are only merged, which takes a shuffle, where folders can share one.
    """
    base = current(spark, root, layer)[name.lower()]
    entry = by_partition(spark, root, layer, base) if base.partition_by else base
    prefix = f"{KIND}{measure}:"
    facts = {k: v for k, v in entry.facts.items() if not k.startswith(prefix) or k.removeprefix(prefix) in entry.folders}
    lacking = [folder for folder in entry.folders if prefix + folder not in facts]
    empty = spark.createDataFrame([], entry.struct)
    parts = {k: v for new, column in sums.items() for k, v in sum_parts(empty, column, new).items()}
    for folder in lacking:
        one = replace(entry, folders=(folder,))
        facts[prefix + folder] = new_folder(name, "measure")
        partial = rows_of(spark, root, layer, one).groupBy(*map(quoted, by)).agg(*[p.alias(n) for n, p in parts.items()], F.count(F.lit(1)).alias("n_rows"))
        partial.write.parquet(f"{root}/{layer}/{facts[prefix + folder]}")
    if lacking or entry != base:
        changed = replace(entry, facts=facts)
        commit(spark, root, layer, {name: changed}, expected={name: base})
    shape: StructType = empty.groupBy(*map(quoted, by)).agg(*[p.alias(n) for n, p in parts.items()], F.count(F.lit(1)).alias("n_rows")).schema
    stored = [spark.read.schema(shape).parquet(f"{root}/{layer}/{facts[prefix + folder]}") for folder in entry.folders]
    rows = reduce(DataFrame.unionAll, stored) if stored else spark.createDataFrame([], shape)
    merged = rows.groupBy(*map(quoted, by)).agg(*[F.sum(n).alias(n) for n in parts], F.sum("n_rows").alias("n_rows"))
    if _apart(entry, by):
        merged = rows.select(*[F.col(quoted(f.name)).cast(f.dataType).alias(f.name) for f in merged.schema])
    return merged.select(*map(quoted, by), *[sum_of(parts, n).alias(n) for n in sums], "n_rows")
