"""What the physical plans must and must not hold."""

import re

import pytest

from tallyward.workload.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", 10_000)  # else long filter lists are cut off
    return {name: plan(q(spark, FOLDER)) for name, q in QUERIES.items()}


def test_no_python_and_no_cross_join_anywhere(plans):
    bad = re.compile("Python|Pandas|CartesianProduct|BroadcastNestedLoopJoin|Collect_list", re.I)
    allowed = {"numeric_summary", "numeric_summary_text", "numeric_summary_all"}  # collects two positions per quartile
    found = {n: sorted(set(bad.findall(p))) for n, p in plans.items()}
    assert {n: f for n, f in found.items() if f and not (n in allowed and {x.lower() for x in f} == {"collect_list"})} == {}


@pytest.mark.parametrize("name", ["top_transaction_per_month", "lowest_revenue_per_month"])
def test_first_rank_needs_no_window(plans, name):
    assert "Window" not in plans[name]


@pytest.mark.parametrize(
    "name, column",
    [
        ("top_transaction_per_month", "o_orderdate"),
        ("lowest_revenue_per_month", "l_shipdate"),
        ("avg_amount_by_scenario", "o_orderdate"),
        ("product_month_sales", "o_orderdate"),
        ("quantity_by_date_since", "o_orderdate"),
    ],
)
def test_date_filter_reaches_the_scan(plans, name, column):
    pushed = re.findall(r"PushedFilters: \[(.*?)\], ReadSchema", plans[name])
    assert any(f"GreaterThanOrEqual({column}" in p for p in pushed)


def test_scans_read_only_used_columns(plans):
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint,l_extendedprice:double,l_shipdate:timestamp_ntz>" in (
        plans["lowest_revenue_per_month"]
    )
    assert "ReadSchema: struct<c_acctbal:double,c_mktsegment:string>" in plans["mean_by_group"]


def test_small_dimensions_are_broadcast_before_the_only_shuffle(plans):
    lines = plans["product_month_sales"].splitlines()
    partial = next(i for i, line in enumerate(lines) if "partial_sum" in line)
    assert any("BroadcastHashJoin" in line for line in lines[partial:])
    assert not any("SortMergeJoin" in line for line in lines[:partial])


def test_sums_with_one_large_and_one_small_dimension(spark):
    """Small dimension, sum by the large one's key and the wanted attribute, large dimension."""
    from tallyward.operators.joins import star_sum

    fact = spark.range(1000).selectExpr("id % 10 AS big", "id % 3 AS little", "1.5D AS v")
    big = spark.read.parquet(f"{FOLDER}/documents.parquet").selectExpr("doc_id AS big", "text AS name")
    little = spark.read.parquet(f"{FOLDER}/region.parquet").selectExpr("cast(r_regionkey AS bigint) AS little", "r_name AS region")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20k")
    try:
        text = plan(star_sum(fact, {"big": big, "little": little}, ["name", "region"], {"v": "v"}))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert re.search(r"SortMergeJoin.*big.*?partial_sum.*?keys=\[big#\d+L?, region#\d+\]|keys=\[big#\d+L?, region#\d+\], functions=\[partial", text, re.S)
    assert text.index("SortMergeJoin") < text.index("keys=[big") < text.index("BroadcastHashJoin")


@pytest.mark.parametrize("name", ["top_transaction_per_month", "lowest_revenue_per_month", "avg_amount_by_scenario", "product_month_sales"])
def test_questions_are_built_without_a_job(spark, name):
    spark.sparkContext.setJobGroup(f"build-{name}", "")
    QUERIES[name](spark, FOLDER)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup(f"build-{name}")


def test_date_repair_plans_few_scans(plans):
    assert plans["error_log_customer"].count("FileScan") <= 8


def test_year_filter_opens_one_folder(spark):
    text = plan(QUERIES["normalized_roundtrip"](spark, FOLDER))
    assert re.search(r"PartitionFilters: \[isnotnull\(OrderDate_year#\d+\), \(OrderDate_year#\d+ = 1998\)\]", text)


def test_rules_of_one_table_share_one_scan(spark):
    from tallyward.operators.rules import failing_rows
    from tallyward.plans.specs import spec_of
    from tallyward.workload import standins

    product = standins.products(spark.read.parquet(f"{FOLDER}/part.parquet"))
    assert plan(failing_rows(product, spec_of("dimproduct").rules)).count("FileScan") == 1


def test_profile_is_one_pass(plans):
    assert plans["table_profile"].count("FileScan") == 1
