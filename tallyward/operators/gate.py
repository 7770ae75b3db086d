"""A table that only rows with a unique key enter."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tallyward.functions.text import named, quoted
from tallyward.sources.manifest import Stored, commit, new_folder
from tallyward.sources.shared import folders_in, shared_folder

STATE = "key_state"
UNIQUE, NULL, REPEATED = "unique", "null", "repeated"


def with_key_state(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Each row with the state of its key: `unique`, `null` (in any part) or `repeated`.

    Keys are counted before the shuffle, and only those that are repeated, stored first so that their size is known, are
    met with the rows: the rows are not gathered by key, however many share one.
    """
    counts = df.where(_all_there(key)).groupBy(*[named(k).alias(f"_key_{i}") for i, k in enumerate(key)]).agg(F.count(F.lit(1)).alias("_n"))
    repeated = counts.where("_n > 1").drop("_n")
    path = f"{shared_folder(df.sparkSession)}/repeated"
    repeated.write.parquet(path)
    known = df.sparkSession.read.schema(repeated.schema).parquet(path).withColumn("_repeated", F.lit(True))
    same = reduce(lambda a, b: a & b, [named(k) == F.col(f"_key_{i}") for i, k in enumerate(key)])
    state = F.when(~_all_there(key), NULL).when(F.col("_repeated"), REPEATED).otherwise(UNIQUE)
    return df.join(known, same, "left").select(*[quoted(c) for c in df.columns], state.alias(STATE))


def _all_there(key: Sequence[str]):
    return reduce(lambda a, b: a & b, [named(k).isNotNull() for k in key])


def stage_gated(df: DataFrame, root: str, layer: str, name: str, key: Sequence[str]) -> tuple[Stored, Stored]:
    """Write the rows with a unique key and, apart, all others; returns both as entries that no reader sees before a commit.

    One write deals the rows to a folder per state. The quarantine has the state as one more column. Every row is in one
    of the two.
    """
    folder = new_folder(name)
    counts = {s: F.count_if(F.col(STATE) == s).alias(s) for s in (UNIQUE, NULL, REPEATED)}
    written = Observation()
    stated = with_key_state(df, key).observe(written, *counts.values())
    stated.write.partitionBy(STATE).parquet(f"{root}/{layer}/{folder}")
    there = [f for f in folders_in(df.sparkSession, f"{root}/{layer}/{folder}") if f.startswith(f"{STATE}=")]
    found = written.get
    good = f"{STATE}={UNIQUE}"
    table = Stored(tuple(f"{folder}/{f}" for f in there if f == good), df.schema.json(), found[UNIQUE])
    held = StructType([*df.schema, StructField(STATE, StringType())])
    return table, Stored(tuple(f"{folder}/{f}" for f in there if f != good), held.json(), found[NULL] + found[REPEATED], (STATE,))


def write_gated(df: DataFrame, root: str, layer: str, name: str, key: Sequence[str], quarantine: str) -> tuple[int, int]:
    """Replace a table by the rows whose key is there once, and its quarantine by all others, in one step.

    Returns the rows of both.
    """
    table, others = stage_gated(df, root, layer, name, key)
    commit(df.sparkSession, root, layer, {name: table, quarantine: others})
    return table.n_rows, others.n_rows
