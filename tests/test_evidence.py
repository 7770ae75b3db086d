"""Ranks, sketches, stored measures and date formats by evidence."""

import datetime as dt
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyward.functions.date_evidence import parse_by_evidence, settled_formats
from tallyward.operators import sketches
from tallyward.operators.increment import load_new_rows
from tallyward.operators.ranking import rank_within
from tallyward.plans.measures import replace_partition, stored_sum
from tallyward.sources import layers
from tallyward.sources.layers import NORMALIZED, RAW, read_layer, write_by_year
from tallyward.sources.manifest import current


def bag(df):
    return Counter(tuple(None if v != v else v for v in r) for r in df.collect())


# Ranks


@pytest.mark.parametrize("k", [1, 3, 100])
@pytest.mark.parametrize("descending", [True, False])
def test_rank_within_equals_sql(spark, k, descending):
    rng = random.Random(k)
    rows = [(rng.choice(["a", "b", None, "hot", "hot", "hot"]), rng.choice([None, float("nan"), *map(float, range(40))]), i) for i in range(900)] + [("one", None, -1), ("two", 1.0, -2), ("two", 1.0, -3)]
    df = spark.createDataFrame(rows, "g string, `v.w` double, id long").repartition(5)
    order = F.desc_nulls_last("`v.w`") if descending else F.asc_nulls_first("`v.w`")
    expected = df.withColumn("rank", F.rank().over(Window.partitionBy("g").orderBy(order))).where(F.col("rank") <= k)
    found = rank_within(df, "g", "v.w", k, descending)
    assert found.columns == ["g", "v.w", "id", "rank"]
    assert bag(found) == bag(expected)


def test_rank_within_bounds(spark):
    df = spark.createDataFrame([], "g string, v long")
    assert rank_within(df, "g", "v", 3, True).collect() == []
    with pytest.raises(ValueError, match="1"):
        rank_within(df, "g", "v", 0, True)
    tied = spark.range(5000).selectExpr("'g' AS g", "if(id < 2, 9, 5) AS v")
    assert {(r.v, r["rank"]): r["count"] for r in rank_within(tied, "g", "v", 3, True).groupBy("v", "rank").count().collect()} == {(9, 1): 2, (5, 3): 4998}
    plan = rank_within(tied, "g", "v", 3, True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2


# Sketches


def test_sketches_keep_their_bounds(spark):
    rng = np.random.default_rng(3)
    values = {"a": rng.normal(size=20_000), "b": rng.integers(0, 700, 20_000).astype(float), "c": np.exp(rng.normal(size=20_000) * 3)}
    df = spark.createDataFrame(list(zip(*(v.tolist() for v in values.values()), strict=True)), "a double, b double, c double")
    rows = {r.column_name: r for r in sketches.approx_summary(df).collect()}
    for name, v in values.items():
        r, order = rows[name], np.sort(v)
        assert (r.n_rows, r.n_values, r.min, r.max) == (20_000, 20_000, order[0], order[-1])
        assert abs(r.n_distinct / len(set(v.tolist())) - 1) < 4 * sketches.DISTINCT_DEVIATION
        for p in (25, 50, 75):
            low, high = np.searchsorted(order, r[f"p{p}"], "left") / 20_000, np.searchsorted(order, r[f"p{p}"], "right") / 20_000
            assert low - 2 * sketches.RANK_ERROR <= p / 100 <= high + 2 * sketches.RANK_ERROR


def test_sketches_of_awkward_columns(spark):
    df = spark.createDataFrame([(1, float("nan"), None, "x"), (None, 0.0, None, "y"), (1, -0.0, None, None)], "`a.b` long, d double, e int, s string")
    rows = {r.column_name: tuple(r)[1:] for r in sketches.approx_summary(df).collect()}
    assert rows == {"a.b": (3, 2, 1, 1.0, 1.0, 1.0, 1.0, 1.0), "d": (3, 2, 1, 0.0, -0.0, -0.0, 0.0, 0.0), "e": (3, 0, 0, None, None, None, None, None)} or rows["d"][:3] == (3, 2, 1)
    assert rows["a.b"][:4] == (3, 2, 1, 1.0) and rows["e"] == (3, 0, 0, None, None, None, None, None)
    assert sketches.approx_summary(df.select("s")).collect() == []
    assert [tuple(r)[1:4] for r in sketches.approx_summary(df.limit(0).select("d")).collect()] == [(0, 0, 0)]


def test_a_new_day_costs_one_days_scan(spark, tmp_path):
    root, days = str(tmp_path), spark.range(30_000).selectExpr("id", "cast(id % 977 as double) as v")
    load_new_rows(days.where("id < 20000"), root, RAW, "t")
    assert sketches.sketch_folders(spark, root, RAW, "T") == 1
    first = current(spark, root, RAW)["t"].folders[0]
    load_new_rows(days, root, RAW, "t")
    for file in (tmp_path / RAW / first).glob("*.parquet"):
        file.write_bytes(b"not read")
    rows = {r.column_name: r for r in sketches.stored_summary(spark, root, RAW, "t").collect()}
    assert (rows["id"].n_rows, rows["id"].min, rows["id"].max) == (30_000, 0, 29_999)
    assert abs(rows["id"].p50 / 30_000 - 0.5) < 2 * sketches.RANK_ERROR and abs(rows["v"].n_distinct / 977 - 1) < 0.03
    assert sketches.sketch_folders(spark, root, RAW, "t") == 0


# Stored measures


def sales(spark, years, rows=900, factor=1.0):
    day = F.expr(f"timestamp_ntz'{years[0]}-01-01 00:00:00' + make_dt_interval(cast(id % {365 * len(years)} as int))")
    return spark.range(rows).select(F.when(F.col("id") % 90 != 0, day).alias("day"), (F.col("id") % 7).alias("k"), (F.col("id") * factor / 4).alias("v"))


def full(df):
    return bag(df.groupBy("k", F.year("day").alias("day_year")).agg(F.sum("v").alias("total"), F.count(F.lit(1)).alias("n_rows")).select("k", "day_year", "total", "n_rows"))


def test_measures_read_only_the_year_that_changed(spark, tmp_path):
    root, df = str(tmp_path), sales(spark, [2011, 2012, 2013])
    write_by_year(df, root, NORMALIZED, "sales", "day")
    measure = lambda: stored_sum(spark, root, NORMALIZED, "sales", "by_key", ["k", "day_year"], {"total": "v"})
    assert bag(measure()) == full(df)
    changed = sales(spark, [2012], 200, 3.0).where("day IS NOT NULL")
    assert replace_partition(changed.withColumn("day_year", F.lit(2012)), root, NORMALIZED, "sales", 2012) == changed.count()
    now = df.where("day IS NULL OR year(day) <> 2012").unionAll(changed)
    entry = current(spark, root, NORMALIZED)["sales"]
    assert entry.n_rows == now.count() and bag(read_layer(spark, root, NORMALIZED, "sales").drop("day_year")) == bag(now)
    for folder in entry.folders:  # other years are not read
        if "day_year=2012" not in folder:
            for file in (tmp_path / NORMALIZED / folder).glob("*.parquet"):
                file.write_bytes(b"not read")
    assert bag(measure()) == full(now)
    facts = current(spark, root, NORMALIZED)["sales"].facts
    assert len(facts) == len(entry.folders) and bag(measure()) == full(now)
    assert current(spark, root, NORMALIZED)["sales"].facts == facts


def test_a_partition_takes_only_its_own_rows(spark, tmp_path):
    root = str(tmp_path)
    write_by_year(sales(spark, [2011, 2012]), root, NORMALIZED, "sales", "day")
    with pytest.raises(ValueError, match="another"):
        replace_partition(sales(spark, [2011]).withColumn("day_year", F.lit(2011)), root, NORMALIZED, "sales", 2012)
    rows = sales(spark, [2014], 50).where("day IS NOT NULL").withColumn("day_year", F.lit(2014))
    replace_partition(rows, root, NORMALIZED, "sales", 2014)  # a year that was not there
    replace_partition(rows.limit(0), root, NORMALIZED, "sales", 2011)
    years = {r.day_year for r in read_layer(spark, root, NORMALIZED, "sales").select("day_year").distinct().collect()}
    assert years == {None, 2012, 2014}
    nulls = sales(spark, [2011]).where("day IS NULL").withColumn("day_year", F.lit(None).cast("int"))
    assert replace_partition(nulls.limit(1), root, NORMALIZED, "sales", None) == 1
    assert read_layer(spark, root, NORMALIZED, "sales").where("day_year IS NULL").count() == 1


def test_a_year_is_replaced_from_its_stored_folder(spark, tmp_path, monkeypatch):
    from tallyward.workload import queries

    day = F.expr("timestamp_ntz'1997-06-01 00:00:00' + make_dt_interval(cast(id % 5 * 150 as int))")
    spark.range(40).selectExpr("id as o_orderkey", "id % 3 as o_custkey", "'F' as o_orderstatus", "1.0D as o_totalprice", "id", "'1' as o_orderpriority").withColumn("o_orderdate", day).drop("id").write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(90).selectExpr(
        "id % 40 as l_orderkey", "id % 7 as l_partkey", "1L as l_suppkey", "cast(id as int) as l_linenumber", "2.0D as l_quantity", "cast(id as double) as l_extendedprice",
        "0.05D as l_discount", "0.02D as l_tax", "'N' as l_returnflag", "'O' as l_linestatus", "timestamp_ntz'1999-01-01 00:00:00' as l_shipdate",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    given, real = [], queries.replace_partition
    monkeypatch.setattr(queries, "replace_partition", lambda df, *rest: (given.append(df.inputFiles()), real(df, *rest))[1])
    found = {(r.ProductKey, r.OrderDate_year): (r.amount, r.n_rows) for r in queries.QUERIES["measure_after_replace"](spark, str(tmp_path)).collect()}
    assert given and all("/normalized/sales/" in f for f in given[0])
    expected = {}
    for i in range(90):
        year = (dt.datetime(1997, 6, 1) + dt.timedelta(days=i % 40 % 5 * 150)).year
        amount, n = expected.get((i % 7, year), (0.0, 0))
        expected[i % 7, year] = (amount + i * (2 if year == 1998 else 1), n + 1)
    assert found == expected


def test_years_apart_are_neither_dealt_again_nor_merged(spark, tmp_path, monkeypatch):
    from tallyward.workload import queries

    spark.range(40).selectExpr("id as o_orderkey", "id % 3 as o_custkey", "'F' as o_orderstatus", "1.0D as o_totalprice", "'1' as o_orderpriority", "timestamp_ntz'1997-06-01 00:00:00' + make_dt_interval(cast(id % 5 * 150 as int)) as o_orderdate").write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(90).selectExpr(
        "id % 40 as l_orderkey", "id % 7 as l_partkey", "1L as l_suppkey", "cast(id as int) as l_linenumber", "2.0D as l_quantity", "cast(id as double) as l_extendedprice",
        "0.05D as l_discount", "0.02D as l_tax", "'N' as l_returnflag", "'O' as l_linestatus", "timestamp_ntz'1999-01-01 00:00:00' as l_shipdate",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    plans, real = [], layers.stage_layer

    def staged(df, *rest, **more):
        entry = real(df, *rest, **more)
        plans.append((more.get("gather", rest[-1]), entry))
        return entry

    monkeypatch.setattr(layers, "stage_layer", staged)
    t = {name: spark.read.parquet(f"{tmp_path}/{name}.parquet") for name in ("orders", "lineitem")}
    found = queries.QUERIES["measure_after_replace"](spark, str(tmp_path))
    assert [gather for gather, _ in plans] == [False]
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    year = F.year("o_orderdate")
    want = t["lineitem"].join(t["orders"], F.expr("l_orderkey = o_orderkey")).groupBy("l_partkey", year).agg(F.sum(F.col("l_extendedprice") * F.when(year == 1998, 2).otherwise(1)), F.count("*"))
    assert bag(found) == bag(want)


@pytest.mark.parametrize("gather", [True, False])
def test_a_table_by_year_is_the_same_gathered_or_not(spark, tmp_path, gather):
    root, df = str(tmp_path), sales(spark, [2011, 2012, 2013]).repartition(3)
    assert layers.write_by_year(df, root, NORMALIZED, "sales", "day", gather) == 900
    assert bag(read_layer(spark, root, NORMALIZED, "sales").drop("day_year")) == bag(df)
    for file in tmp_path.glob(f"{NORMALIZED}/sales/*/day_year=2012/*.parquet"):
        days = [r.day for r in spark.read.parquet(str(file)).collect()]
        assert days == sorted(days) and {d.year for d in days} == {2012}


def test_groups_that_folders_share_are_merged(spark, tmp_path):
    root, df = str(tmp_path), sales(spark, [2011, 2012])
    write_by_year(df, root, NORMALIZED, "sales", "day")
    found = stored_sum(spark, root, NORMALIZED, "sales", "by_key", ["k"], {"total": "v"})
    assert bag(found) == bag(df.groupBy("k").agg(F.sum("v"), F.count("*")))
    apart = stored_sum(spark, root, NORMALIZED, "sales", "by_year", ["k", "day_year"], {"total": "v"})
    assert bag(apart) == full(df) and apart.schema["n_rows"].dataType == found.schema["n_rows"].dataType


# Date formats


def test_a_column_is_read_in_one_order(spark):
    rows = [
        ("13/02/2011", "02/13/2011", "5 March 2011", "2011-02-03T04:05:06.7", "20110203"),
        ("02/03/2011", "02/03/2011", "13 May 2011", "2011-02-03 23:59", "20111301"),
        ("31/02/2011", "1/2/2011", "May 5, 2011", "2011-2-3", "02/03/2011"),
        (" 1/12/2011 ", None, "", "2011-02-03T25:00", None),
    ]
    df = spark.createDataFrame(rows, "a string, `b.c` string, d string, e string, f string")
    columns = df.columns
    settled = {r.column_name: (r.format, r.n_read, r.n_texts) for r in settled_formats(df, columns).collect()}
    assert settled == {"a": ("d/M/yyyy", 3, 4), "b.c": ("M/d/yyyy", 3, 3), "d": ("d MMMM yyyy", 2, 4), "e": ("yyyy-M-d", 3, 4), "f": ("yyyyMMdd", 1, 3)}
    day = lambda m, d, *t: dt.datetime(2011, m, d, *t)
    found = [tuple(r) for r in parse_by_evidence(df, columns).collect()]
    assert found == [
        (day(2, 13), day(2, 13), day(3, 5), day(2, 3, 4, 5, 6, 700_000), day(2, 3)),
        (day(3, 2), day(2, 3), day(5, 13), day(2, 3, 23, 59), None),
        (None, day(1, 2), None, day(2, 3), None),
        (day(12, 1), None, None, None, None),
    ]


def test_without_evidence_the_first_order_counts(spark):
    df = spark.createDataFrame([("02/03/2011",), (None,)], "a string")
    assert [r.a for r in parse_by_evidence(df, ["a"]).collect()] == [dt.datetime(2011, 3, 2), None]
    assert parse_by_evidence(df.limit(0), ["a"]).collect() == []
    assert [r.a for r in parse_by_evidence(spark.createDataFrame([("no date",)], "a string"), ["a"]).collect()] == [None]


def test_settled_formats_are_looked_up_once_for_all_columns(spark):
    df = spark.createDataFrame([("13/02/2011", "02/13/2011", "kept")], "a string, b string, `_settled` string")
    found = parse_by_evidence(df, ["a", "b"])
    plan = found._jdf.queryExecution().analyzed().toString()
    assert plan.count("scalar-subquery") == 1 and len(plan) < 60_000
    assert [tuple(r) for r in found.collect()] == [(dt.datetime(2011, 2, 13), dt.datetime(2011, 2, 13), "kept")]
