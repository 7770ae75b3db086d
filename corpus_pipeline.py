"""From raw documents to tokens: the stages, in order, each written as Parquet and read again by the next.

All stages but the last return the columns of documents. An empty table gives an empty one; null texts are empty texts;
what each stage does with ties, repeated rows and clashing columns stands with its operator.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyward.llm.common import stored, table
from tallyward.llm.decontaminate import drop_contaminated
from tallyward.llm.exact_dedup import drop_exact_duplicates
from tallyward.llm.jaccard_join import drop_near_duplicates
from tallyward.llm.pieces import with_pieces
from tallyward.llm.quality import keep_good

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learned from `labels`, does not reject."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts."""
    return drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a similarity of 0.8."""
    return drop_near_duplicates(docs, words_each=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of `benchmark`."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids, and whether these decode to the text."""
    return with_pieces(docs, mark_name="round_trip")


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality),
    ("exact dedup", exact_dedup),
    ("n-gram Jaccard join", near_dedup),
    ("benchmark decontamination", decontamination),
    ("SentencePiece encoding", encoding),
]

#: Learned scores and merges have no counterpart in SQL; tests hold the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
