"""Facts stored in buckets of their join key, so that a join does not shuffle them.

Rows are dealt to buckets by the hash that a shuffle would use, and sorted by key within each file. A key that holds a
large share of all rows would make one bucket, and so one task of every join, as large: the rows of such keys are stored
apart, without buckets, and joined by themselves with the few rows that the other side has for them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyward.functions.text import quoted
from tallyward.operators.skew import heavy_keys
from tallyward.sources.manifest import Stored, commit, current, new_folder

HOT = "hot"


def stage_bucketed(df: DataFrame, root: str, layer: str, name: str, key: str, buckets: int) -> Stored:
    """Write `df` in buckets of `key` to fresh folders that no reader sees before a commit.

    Rows are gathered by bucket first, else every task writes a file for each bucket; a bucket that grows large is split
    into several files. Null keys are rows like any other.
    """
    spark = df.sparkSession
    hot = heavy_keys(df, key, buckets).select(quoted(key))
    folder, hot_folder, written, hot_written = new_folder(name), new_folder(name, HOT), Observation(), Observation()
    table = _table_name(folder)
    common = df.join(F.broadcast(hot), key, "left_anti").select(*map(quoted, df.columns)).hint("rebalance", buckets, key)
    counted = common.observe(written, F.count(F.lit(1)).alias("n_rows"))
    counted.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", f"{root}/{layer}/{folder}").saveAsTable(table)
    spark.sql(f"DROP TABLE {table}")  # of the session's catalog; the files stay
    few = df.join(F.broadcast(hot), key, "left_semi").select(*map(quoted, df.columns)).observe(hot_written, F.count(F.lit(1)).alias("n_rows"))
    few.write.parquet(f"{root}/{layer}/{hot_folder}")
    n = written.get["n_rows"] + hot_written.get["n_rows"]
    return Stored((folder, hot_folder), df.schema.json(), n, buckets=buckets, bucket_by=(key,))


def write_bucketed(df: DataFrame, root: str, layer: str, name: str, key: str, buckets: int) -> int:
    """Replace a stored table by `df` in buckets of `key`, in one step; returns the rows written."""
    entry = stage_bucketed(df, root, layer, name, key, buckets)
    commit(df.sparkSession, root, layer, {name: entry})
    return entry.n_rows


def _table_name(folder: str) -> str:
    return "tallyward_" + "".join(c if c.isalnum() else "_" for c in folder)


def _bucketed(spark: SparkSession, root: str, layer: str, entry: Stored) -> DataFrame:
    """The rows in buckets, made known to the session's catalog."""
    (key,) = entry.bucket_by
    table = _table_name(entry.folders[0])
    columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in entry.struct)
    layout = f"CLUSTERED BY ({quoted(key)}) SORTED BY ({quoted(key)}) INTO {entry.buckets} BUCKETS"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet {layout} LOCATION '{root}/{layer}/{entry.folders[0]}'")
    return spark.table(table)


def join_bucketed(spark: SparkSession, root: str, layer: str, name: str, dim: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Inner join of a stored table in buckets with a dimension that has the same key column, reading only the named columns.

    The buckets are not shuffled: only the dimension is, to as many partitions, or nothing if it is in such buckets too.
    """
    entry = current(spark, root, layer).get(name.lower())
    if entry is None or not entry.buckets:
        raise FileNotFoundError(f"there is no table {name!r} in buckets in {root}/{layer}")
    (key,) = entry.bucket_by
    needed = {key, *columns}
    own = [quoted(f.name) for f in entry.struct if f.name in needed]
    right = dim.select(*[quoted(c) for c in dim.columns if c == key or (c in needed and c not in entry.struct.names)])
    wanted = [quoted(c) for c in columns]
    common = _bucketed(spark, root, layer, entry).select(*own).join(right, key).select(*wanted)
    rest = spark.read.schema(entry.struct).parquet(f"{root}/{layer}/{entry.folders[1]}").select(*own)
    keys = rest.select(quoted(key)).distinct()
    return common.unionAll(rest.join(right.join(keys, key, "left_semi"), key).select(*wanted))
