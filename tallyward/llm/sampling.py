"""Training rows and folds that the learned operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def fold(doc_id: str = "doc_id") -> Column:
    """CRC-32 of the id as text, modulo 5; rows of fold 0 are held out. A null id is held out too."""
    return F.coalesce(F.crc32(F.col(f"`{doc_id}`").cast("string").cast("binary")) % FOLDS, F.lit(0))


def labelled_ids(labels: DataFrame, label: str, doc_id: str = "doc_id") -> DataFrame:
    """Ids of the training folds with their label; an id with two different labels counts as the larger."""
    rows = labels.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{label}`").cast("int").alias("label"))
    return rows.filter((fold() != 0) & F.col("label").isin(0, 1)).groupBy("doc_id").agg(F.max("label").alias("label"))


def one_text_each(rows: DataFrame, by: str) -> DataFrame:
    """One row per id and `by`, the one whose text has the least hash: what many rows share an id never meets in one task."""
    return rows.groupBy("doc_id", by).agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")).select("doc_id", "text", by)


def first_by_hash(ids: DataFrame, rows: int) -> DataFrame:
    """At most `rows` of the rows, those whose ids have the least hashes: a sample that does not depend on the order."""
    return ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
