"""Joins with hot keys, and facts in buckets."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyward.operators.joins import fact_dim_join
from tallyward.operators.skew import heavy_keys, split_join
from tallyward.sources.buckets import join_bucketed, write_bucketed
from tallyward.sources.layers import NORMALIZED, read_layer
from tallyward.sources.manifest import current

COLUMNS = ["k", "v", "name"]


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def facts(spark, rows=60_000):
    """A third of the rows has one key, some have none, some have keys that the dimension lacks or has twice."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 101 == 0, None).otherwise(F.col("id") % 5000)
    return spark.range(rows).select(key.cast("long").alias("k"), F.col("id").alias("v"), F.lit("unused").alias("x"))


def dimension(spark):
    rows = spark.range(4000).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("name"), F.lit(1).alias("y"))
    return rows.unionAll(rows.where("k IN (7, 9)"))


def bag(df):
    return Counter(map(tuple, df.collect()))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_heavy_keys(spark):
    found = {r.k: r.share for r in heavy_keys(facts(spark), "k", 8).collect()}
    assert list(found) == [7] and abs(found[7] - 1 / 3) < 0.01
    assert heavy_keys(facts(spark).limit(0), "k", 8).collect() == []
    assert heavy_keys(spark.range(1000).withColumnRenamed("id", "k"), "k", 8).collect() == []


def test_split_join_equals_the_plain_join(spark, no_broadcast):
    fact, dim = facts(spark), dimension(spark)
    expected = bag(fact.join(dim, "k").select(*COLUMNS))
    joined = split_join(fact, dim, "k", COLUMNS)
    assert "SortMergeJoin" in plan(joined) and bag(joined) == expected
    assert bag(split_join(fact.limit(0), dim, "k", COLUMNS)) == Counter()


def test_no_task_of_a_split_join_has_twice_the_median(spark, no_broadcast):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    try:
        def rows_of_tasks(df):
            return sorted(r["count"] for r in df.withColumn("p", F.spark_partition_id()).groupBy("p").count().collect())

        dim = dimension(spark).dropDuplicates(["k"])
        fact = facts(spark).where("k < 4000")
        split, plain = rows_of_tasks(split_join(fact, dim, "k", COLUMNS)), rows_of_tasks(fact_dim_join(fact, dim, "k", COLUMNS))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    assert sum(split) == sum(plain) and len(split) == 12
    assert max(split) <= 2 * split[6] < 2 * max(split)
    assert max(plain) > 4 * plain[6]


def test_a_small_dimension_is_broadcast(spark):
    small = spark.read.schema("r_regionkey int, r_name string").parquet("/root/testdata/sf0.001/region.parquet").withColumnRenamed("r_regionkey", "k")
    assert "BroadcastHashJoin" in plan(split_join(facts(spark), small, "k", ["v", "r_name"]))


def test_facts_in_buckets_are_not_shuffled(spark, tmp_path, no_broadcast):
    root, fact, dim = str(tmp_path), facts(spark), dimension(spark)
    assert write_bucketed(fact, root, NORMALIZED, "facts", "k", 4) == 60_000
    joined = join_bucketed(spark, root, NORMALIZED, "facts", dim, COLUMNS)
    assert bag(joined) == bag(fact.join(dim, "k").select(*COLUMNS))
    text = plan(joined)
    bucketed = text[text.index("SortMergeJoin") : text.index("Exchange")]
    assert re.search(r"FileScan.*Bucketed: true.*SelectedBucketsCount: 4 out of 4", bucketed)
    assert "ReadSchema: struct<k:bigint,v:bigint>" in bucketed
    assert bag(read_layer(spark, root, NORMALIZED, "facts")) == bag(fact)
    folders = current(spark, root, NORMALIZED)["facts"].folders
    hot = spark.read.parquet(f"{root}/{NORMALIZED}/{folders[1]}")
    assert [tuple(r) for r in hot.groupBy("k").count().collect()] == [(7, fact.where("k = 7").count())]


def test_two_tables_in_buckets_need_no_shuffle(spark, tmp_path, no_broadcast):
    root = str(tmp_path)
    fact = spark.range(9000).select((F.col("id") % 3000).alias("k"), F.col("id").alias("v"))
    dim = spark.range(3000).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("name"))
    write_bucketed(fact, root, NORMALIZED, "facts", "k", 4)
    write_bucketed(dim, root, NORMALIZED, "dims", "k", 4)
    from tallyward.sources import buckets

    bucketed_dim = buckets._bucketed(spark, root, NORMALIZED, current(spark, root, NORMALIZED)["dims"])
    joined = join_bucketed(spark, root, NORMALIZED, "facts", bucketed_dim, COLUMNS)
    text = plan(joined)
    assert "Exchange" not in text[text.index("SortMergeJoin") : text.index("SortMergeJoin", text.index("SortMergeJoin") + 1)]
    assert bag(joined) == bag(fact.join(dim, "k").select(*COLUMNS))


def test_tables_in_buckets_are_replaced_in_one_step(spark, frame, tmp_path):
    root = str(tmp_path)
    write_bucketed(frame([(1, "a"), (None, "b")], "k long, `a.b` string"), root, NORMALIZED, "t", "k", 2)
    write_bucketed(frame([], "k long, `a.b` string"), root, NORMALIZED, "t", "k", 2)
    assert read_layer(spark, root, NORMALIZED, "t").collect() == []
    assert join_bucketed(spark, root, NORMALIZED, "t", frame([(1, "x")], "k long, name string"), ["a.b", "name"]).collect() == []
    with pytest.raises(FileNotFoundError, match="nosuch"):
        join_bucketed(spark, root, NORMALIZED, "nosuch", spark.range(1), ["id"])
