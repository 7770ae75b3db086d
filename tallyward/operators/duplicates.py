"""Repeated rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.functions.text import quoted
from tallyward.sources.shared import shared_folder

DUPLICATE = "duplicated_row_in_raw_table"

# Copies in one block. Blocks of one row are dealt to tasks as those of different rows are.
COPIES_PER_BLOCK = 10_000


def copies(df: DataFrame, count_name: str) -> DataFrame:
    """Each distinct row once, with its number of copies. Nulls count as equal.

    Copies are counted before the shuffle, so a row that makes up a third of the table costs one
    record per task.
    """
    return df.groupBy(*[quoted(c) for c in df.columns]).agg(F.count(F.lit(1)).alias(count_name))


def numbered_copies(df: DataFrame, times: str, per_block: int = COPIES_PER_BLOCK) -> DataFrame:
    """Each row as often as its integer column `times` says, which gives way to the copy's number, `_copy`.

    Every count is cut into blocks, which are dealt by row and block before they are written out. The number
    of partitions is fixed: the blocks are a few bytes each, and would else be merged into one task.
    """
    n = quoted(times)
    kept = [quoted(c) for c in df.columns if c != times]
    spread = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = df.where(f"{n} > 0").select("*", F.expr(f"explode(sequence(0L, ({n} - 1) div {per_block}))").alias("_block"))
    dealt = blocks.repartition(spread, *kept, "_block")
    first, last = f"_block * {per_block} + 1", f"least((_block + 1) * {per_block}, cast({n} as bigint))"
    return dealt.select(*kept, F.expr(f"explode(sequence({first}, {last}))").alias("_copy"))


def repeat_rows(df: DataFrame, times: str, per_block: int = COPIES_PER_BLOCK) -> DataFrame:
    """Each row as often as its integer column `times` says; that column is dropped."""
    return numbered_copies(df, times, per_block).drop("_copy")


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Every copy of a row beyond its first."""
    extra = copies(df, "_copies").where("_copies > 1").withColumn("_copies", F.expr("_copies - 1"))
    return repeat_rows(extra, "_copies")


def duplicate_wide_rows(df: DataFrame) -> DataFrame:
    """As `duplicate_rows`, for large tables with wide rows.

    A first pass shuffles only an 8-byte fingerprint per row, and stores those that repeat. Rows with one of
    these are then shuffled whole and compared exactly, so equal fingerprints of unlike rows do no harm. The
    stored table's size in bytes is known, by which Spark broadcasts or shuffles it. If no fingerprint repeats, no
    row does, and the table, with the joins it may come from, is not worked out again.
    """
    print_ = F.xxhash64(*[quoted(c) for c in df.columns])
    path = f"{shared_folder(df.sparkSession)}/fingerprints"
    counts = df.select(print_.alias("_print")).groupBy("_print").agg(F.count(F.lit(1)).alias("n"))
    counts.where("n > 1").select("_print").write.parquet(path)
    repeated = df.sparkSession.read.schema("_print bigint").parquet(path)
    if repeated.isEmpty():
        return duplicate_rows(df.limit(0))
    return duplicate_rows(df.withColumn("_print", print_).join(repeated, "_print", "left_semi").drop("_print"))


def duplicate_count(df: DataFrame) -> DataFrame:
    """Number of copies beyond the first, as one row."""
    return copies(df, "_copies").agg(
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).cast("bigint").alias("n_duplicates")
    )
