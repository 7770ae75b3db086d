"""Loading only rows that are not stored yet."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.functions.prints import row_prints
from tallyward.functions.text import quoted
from tallyward.operators.duplicates import repeat_rows
from tallyward.sources.layers import stage_layer
from tallyward.sources.manifest import Stored, commit, current, new_folder, rows_of
from tallyward.sources.shared import shared_folder

PRINTS = "_print_a bigint, _print_b bigint, _n bigint"


def print_counts(df: DataFrame) -> DataFrame:
    """(_print_a, _print_b, _n): how often each row of a table is there, by its fingerprint. Counted before the shuffle."""
    a, b = row_prints(df)
    return df.select(a.alias("_print_a"), b.alias("_print_b")).groupBy("_print_a", "_print_b").agg(F.count(F.lit(1)).alias("_n"))


def rows_beyond(df: DataFrame, stored_prints: DataFrame) -> DataFrame:
    """The rows of `df` that a stored table lacks, as bags: of each row as many copies as `df` has more.

    Fingerprints alone, 24 bytes a distinct row, are shuffled to find them; the rows themselves are then met by those
    that are lacking, which are broadcast if they are few. Rows of which some copies are stored already are written as
    often as they are lacking.
    """
    held = stored_prints.groupBy("_print_a", "_print_b").agg(F.sum("_n").alias("_held"))
    lacking = print_counts(df).join(held, ["_print_a", "_print_b"], "left").withColumn("_held", F.coalesce("_held", F.lit(0)))
    path = f"{shared_folder(df.sparkSession)}/lacking"
    lacking.where("_n > _held").select("_print_a", "_print_b", (F.col("_n") - F.col("_held")).alias("_more"), (F.col("_held") == 0).alias("_all")).write.parquet(path)
    lacking = df.sparkSession.read.schema("_print_a bigint, _print_b bigint, _more bigint, _all boolean").parquet(path)
    a, b = row_prints(df)
    met = df.withColumns({"_print_a": a, "_print_b": b}).join(lacking, ["_print_a", "_print_b"])
    columns = [quoted(c) for c in df.columns]
    wholly = met.where("_all").select(*columns)
    partly = met.where("NOT _all").dropDuplicates(["_print_a", "_print_b"]).select(*columns, "_more")
    return wholly.unionAll(repeat_rows(partly, "_more").select(*columns))


def stage_new_rows(df: DataFrame, root: str, layer: str, name: str, base: Stored | None) -> Stored:
    """What a stored table becomes with the rows that `df` has beyond it; nothing that is stored is written again.

    Rows that `df` has no longer stay. The fingerprints of the added rows are stored beside them, so the next load reads
    no stored row. A table with other columns is refused.
    """
    spark = df.sparkSession
    if base is None:
        rows, before = df, None
    else:
        if [(f.name, f.dataType) for f in base.struct] != [(f.name, f.dataType) for f in df.schema]:
            raise ValueError(f"{layer}/{name} has other columns than the rows to be added")
        if base.prints:
            parts = [spark.read.schema(PRINTS).parquet(f"{root}/{layer}/{folder}") for folder in base.prints]
        else:  # written without them
            folder = _stage_prints(rows_of(spark, root, layer, base), root, layer, name)
            base = replace(base, prints=(folder,))
            parts = [spark.read.schema(PRINTS).parquet(f"{root}/{layer}/{folder}")]
        before = parts[0]
        for part in parts[1:]:
            before = before.unionAll(part)
        rows = rows_beyond(df, before)
    added = stage_layer(rows, root, layer, name)
    prints = _stage_prints(rows_of(spark, root, layer, added), root, layer, name)
    if base is None:
        return replace(added, prints=(prints,))
    return replace(base, folders=(*base.folders, *added.folders), n_rows=base.n_rows + added.n_rows, prints=(*base.prints, prints))


def _stage_prints(df: DataFrame, root: str, layer: str, name: str) -> str:
    folder = new_folder(name, "prints")
    print_counts(df).write.parquet(f"{root}/{layer}/{folder}")
    return folder


def load_new_rows(df: DataFrame, root: str, layer: str, name: str) -> tuple[int, DataFrame]:
    """Add to a stored table the rows that `df` has beyond it, in one step; returns how many, and them.

    Two loads of one table at the same time do not lose rows: the later one ends in `Conflict`.
    """
    spark = df.sparkSession
    base = current(spark, root, layer).get(name.lower())
    entry = stage_new_rows(df, root, layer, name, base)
    commit(spark, root, layer, {name: entry}, expected={name: base})
    added = Stored(entry.folders[-1:], entry.schema, entry.n_rows - (base.n_rows if base else 0))
    return added.n_rows, rows_of(spark, root, layer, added)
