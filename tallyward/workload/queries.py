"""Every operator on the given tables: name -> function of (session, folder)."""

from __future__ import annotations

import warnings
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tallyward.functions.date_evidence import parse_by_evidence
from tallyward.functions.dates import date_of_key, month_text, parse_date, rows_of_year, short_date_flag, since, year_text
from tallyward.functions.text import phone_number
from tallyward.operators import duplicates, keys, profile
from tallyward.operators.gate import write_gated
from tallyward.operators.histogram import histogram
from tallyward.operators.increment import load_new_rows
from tallyward.operators.joins import fact_dim_join
from tallyward.operators.ranking import rank_within
from tallyward.operators.repair import repair_dates as repair_date_columns
from tallyward.operators.rules import common_log, failing_rows
from tallyward.operators.sketches import DISTINCT_DEVIATION, RANK_ERROR, sketch_folders, stored_summary
from tallyward.operators.skew import split_join
from tallyward.plans import charts, etl, questions
from tallyward.plans.cleansing import all_errors, all_key_violations, normalize, table_errors
from tallyward.plans.measures import replace_partition, stored_sum
from tallyward.plans.specs import SALES_KEYS, spec_of
from tallyward.sources.buckets import join_bucketed, write_bucketed
from tallyward.sources.layers import ERRORS, NORMALIZED, RAW, read_layer, stage_layer, write_by_year, write_layer
from tallyward.sources.reports import write_report
from tallyward.sources.shared import shared_folder
from tallyward.sources.tables import Tables, load_tables
from tallyward.workload import standins
from tallyward.workload.schemas import SCHEMAS

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

STAR_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
YEAR = 1998
FINANCE_YEAR = 1997
PRODUCT = "Red Plate"
# Upper bound and name of each band.
WEIGHT_BANDS = ((10.0, "0-10"), (50.0, "10-50"), (None, "50+"))
STATUS_SCENARIOS = {"scenario_f": "F", "scenario_o": "O", "scenario_x": "X"}


class OnDemand(dict):
    """The given tables, each loaded when first asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __missing__(self, name: str) -> DataFrame:
        self[name] = load_tables(self.spark, self.folder, [name], schemas=SCHEMAS)[name]
        return self[name]


def query(function: Callable[[SparkSession, OnDemand], DataFrame]) -> Callable:
    """Register a function of (session, tables) under its name."""
    QUERIES[function.__name__.rstrip("_")] = lambda spark, folder: function(spark, OnDemand(spark, folder))
    return function


# Sources and sinks


@query
def load_tables_(spark, t):
    tables = load_tables(t.spark, t.folder, STAR_TABLES, schemas=SCHEMAS)
    names = [df.select(F.lit(n).alias("table_name")) for n, df in tables.items()]
    return reduce(DataFrame.unionAll, names).groupBy("table_name").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def stage_raw_roundtrip(spark, t):
    root = shared_folder(spark)
    written = write_layer(t["orders"], root, RAW, "orders")
    return read_layer(spark, root, RAW, "orders", t["orders"].schema).withColumn("rows_written", F.lit(written).cast("bigint"))


@query
def report_csv_roundtrip(spark, t):
    return write_report(_avg_amount_by_scenario(t), shared_folder(spark), "qa3")


@query
def load_mapped_tables(spark, t):
    """Tables under other names, and a name that has no file."""
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        tables = load_tables(t.spark, t.folder, {"region": "r", "nation": "n", "no_such_table": "x"}, schemas=SCHEMAS)
    rows = [df.select(F.lit(name).alias("table_name"), F.lit(True).alias("found")) for name, df in tables.items()]
    absent = [t["region"].select(F.lit(name).alias("table_name"), F.lit(False).alias("found")).limit(0) for name in tables.absent]
    counts = reduce(DataFrame.unionAll, rows + absent).groupBy("table_name", "found").agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.withColumn("n_absent", F.lit(len(tables.absent)).cast("bigint"))


def _stored_sales(spark, t):
    """Sales as normalized, stored by year and read back; and how many were written."""
    root = shared_folder(spark)
    clean = normalize(standins.sales(t["lineitem"], t["orders"]), spec_of("factresellersales"))
    written = write_by_year(clean, root, NORMALIZED, "sales", "OrderDate")
    schema = StructType([*clean.schema, StructField("OrderDate_year", IntegerType())])
    return read_layer(spark, root, NORMALIZED, "sales", schema), F.lit(written).cast("bigint")


@query
def normalized_roundtrip(spark, t):
    """One year of the stored sales."""
    stored, written = _stored_sales(spark, t)
    return rows_of_year(stored, "OrderDate", YEAR).withColumn("rows_written", written)


@query
def normalized_roundtrip_all(spark, t):
    """All stored sales, also those without a date."""
    stored, written = _stored_sales(spark, t)
    return stored.withColumn("rows_written", written)


def _stored_logs(spark, t):
    """The log of the products and an empty one, stored by type of error and read back; and how many rows were written."""
    root = shared_folder(spark)
    log = common_log(table_errors(standins.products(t["part"]), spec_of("dimproduct")), "dimproduct", ("ProductKey",))
    empty = common_log(table_errors(t["region"], spec_of("dimscenario")), "region", ("r_regionkey",))
    for name, rows in (("products", log), ("region", empty)):
        written = write_layer(rows, root, ERRORS, name, ["error_type"])
        yield read_layer(spark, root, ERRORS, name, rows.schema), F.lit(written).cast("bigint")


@query
def error_log_roundtrip(spark, t):
    """Rows of the stored logs by type of error."""
    counts = [back.groupBy("table_name", "error_type").agg(F.count(F.lit(1)).alias("n")).withColumn("rows_written", n) for back, n in _stored_logs(spark, t)]
    return reduce(DataFrame.unionByName, counts)


@query
def error_log_roundtrip_all(spark, t):
    """All rows and columns of the stored logs."""
    return reduce(DataFrame.unionByName, [back.withColumn("rows_written", n) for back, n in _stored_logs(spark, t)])


@query
def replace_roundtrip(spark, t):
    """A table in two versions: the second, made from the first as read, replaces it while a third is never committed."""
    root = shared_folder(spark)
    first = write_layer(t["orders"], root, RAW, "orders")
    changed = read_layer(spark, root, RAW, "orders").where("o_orderstatus <> 'F'").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    second = write_layer(changed, root, RAW, "orders")
    stage_layer(t["orders"].limit(10), root, RAW, "orders")
    counts = {"first_rows": first, "second_rows": second}
    return read_layer(spark, root, RAW, "orders").withColumns({k: F.lit(v).cast("bigint") for k, v in counts.items()})


@query
def resumed_run(spark, t):
    """Raw tables of a run that goes on after another one was ended behind its third table."""
    root, star = shared_folder(spark), Tables(_star(t))
    etl.Run(spark, root).stage_raw({n: star[n] for n in list(star)[:3]}, False)
    run = etl.Run(spark, root)
    run.stage_raw(star, False)
    run.publish()
    rows = [read_layer(spark, root, RAW, n).select(F.lit(n).alias("table_name"), F.lit((n, RAW) in run.journal.kept).alias("kept")) for n in star]
    return reduce(DataFrame.unionAll, rows).groupBy("table_name", "kept").agg(F.count(F.lit(1)).alias("n_rows"))


def _loaded_twice(spark, t):
    """Classes of orders, loaded in part and then in full; and the rows that the second load has added."""
    root = shared_folder(spark)
    load_new_rows(_order_classes({"orders": t["orders"].where("o_orderkey % 4 <> 0")}), root, RAW, "classes")
    n, added = load_new_rows(_order_classes(t), root, RAW, "classes")
    return read_layer(spark, root, RAW, "classes"), added, F.lit(n).cast("bigint")


@query
def load_new_rows_(spark, t):
    """All rows that are stored after both loads."""
    stored, _, n = _loaded_twice(spark, t)
    return stored.withColumn("rows_added", n)


@query
def load_new_rows_added(spark, t):
    """What the second load has added."""
    return _loaded_twice(spark, t)[1]


def _gated_lines(spark, t):
    """Order lines behind a gate on (order, line), which is not unique; a part of the keys is null."""
    root = shared_folder(spark)
    lines = t["lineitem"].select(F.when(F.col("l_partkey") % 50 != 0, F.col("l_orderkey")).alias("l_orderkey"), "l_linenumber", "l_partkey", "l_quantity", "l_shipdate")
    write_gated(lines, root, NORMALIZED, "lines", ("l_orderkey", "l_linenumber"), "lines_quarantine")
    return root


@query
def key_gate_table(spark, t):
    return read_layer(spark, _gated_lines(spark, t), NORMALIZED, "lines")


@query
def key_gate_quarantine(spark, t):
    return read_layer(spark, _gated_lines(spark, t), NORMALIZED, "lines_quarantine")


def _hot_lines(t):
    """Order lines of which a third is of one product."""
    key = F.when(F.col("l_linenumber") % 3 == 0, F.lit(1)).otherwise(F.col("l_partkey")).cast("bigint")
    return t["lineitem"].select(key.alias("ProductKey"), "l_orderkey", "l_linenumber", "l_extendedprice")


_HOT_COLUMNS = ["ProductKey", "ProductName", "l_orderkey", "l_linenumber", "l_extendedprice"]


@query
def split_key_join(spark, t):
    return split_join(_hot_lines(t), standins.products(t["part"]), "ProductKey", _HOT_COLUMNS, broadcast_small=False)


@query
def bucketed_join(spark, t):
    root = shared_folder(spark)
    write_bucketed(_hot_lines(t), root, NORMALIZED, "lines", "ProductKey", 8)
    return join_bucketed(spark, root, NORMALIZED, "lines", standins.products(t["part"]), _HOT_COLUMNS)


def _ranked_orders(t, k, descending):
    orders = t["orders"].select("o_orderkey", "o_totalprice", month_text(F.col("o_orderdate")).alias("month"))
    return rank_within(orders, "month", "o_totalprice", k, descending).withColumn("rank", F.col("rank").cast("bigint"))


@query
def rank_within_first(spark, t):
    return _ranked_orders(t, 1, True)


@query
def rank_within_three(spark, t):
    return _ranked_orders(t, 3, False)


@query
def rank_within_hundred(spark, t):
    return _ranked_orders(t, 100, True)


@query
def rank_within_ties(spark, t):
    """Quantities have 50 values, so each rank is shared by very many lines."""
    lines = t["lineitem"].select("l_returnflag", "l_quantity", "l_orderkey", "l_partkey")
    return rank_within(lines, "l_returnflag", "l_quantity", 100, False).withColumn("rank", F.col("rank").cast("bigint"))


@query
def sketch_summary(spark, t):
    """Summary of a table loaded in two parts, from its stored sketches; and whether it keeps its bounds against all rows."""
    root = shared_folder(spark)
    load_new_rows(t["orders"].where("o_orderkey % 3 <> 0"), root, RAW, "orders")
    sketch_folders(spark, root, RAW, "orders")
    load_new_rows(t["orders"], root, RAW, "orders")
    summary = stored_summary(spark, root, RAW, "orders").where("column_name = 'o_totalprice'")
    v, one = F.col("o_totalprice"), lambda c: summary.select(c).scalar()
    quartiles = [F.abs(F.avg((v < one(f"p{p}")).cast("double")) - p / 100) <= 2 * RANK_ERROR for p in (25, 50, 75)]
    near = F.abs(one("n_distinct") / F.countDistinct(v) - 1) <= 5 * DISTINCT_DEVIATION
    found = t["orders"].agg(reduce(lambda a, b: a & b, quartiles).alias("quartiles_within"), near.alias("distinct_within"))
    return found.select(*[one(c).alias(c) for c in ("column_name", "n_rows", "n_values", "min", "max")], "quartiles_within", "distinct_within")


@query
def measure_after_replace(spark, t):
    """Sums by product and year, kept per year folder, after the sales of one year were replaced."""
    root = shared_folder(spark)
    # Orders grow with their lines, so both are dealt by order at any size; its tasks are large and the years few, so rows are not dealt again.
    clean = normalize(standins.sales(t["lineitem"], t["orders"].hint("merge")), spec_of("factresellersales"))
    write_by_year(clean, root, NORMALIZED, "sales", "OrderDate", gather=False)
    measure = (spark, root, NORMALIZED, "sales", "by_product", ["ProductKey", "OrderDate_year"], {"amount": "SalesAmount"})
    stored_sum(*measure)
    # As stored, so that the year costs its folder and not the joins of all sales once more.
    doubled = rows_of_year(read_layer(spark, root, NORMALIZED, "sales"), "OrderDate", YEAR).withColumns({"SalesAmount": F.col("SalesAmount") * 2, "OrderDate_year": F.lit(YEAR)})
    replace_partition(doubled, root, NORMALIZED, "sales", YEAR, False)
    return stored_sum(*measure).withColumn("amount", F.round("amount", 2))


@query
def dates_by_evidence(spark, t):
    """Dates written in another order in each column, in which many a text could be read in two."""
    d, key = F.col("o_orderdate"), F.col("o_orderkey")
    text = lambda pattern: F.when(key % 97 == 0, None).when(key % 10 == 3, F.lit("n/a")).otherwise(F.date_format(d, pattern))
    patterns = {"day_first": "dd/MM/yyyy", "month_first": "MM/dd/yyyy", "month_name": "MMM d, yyyy", "with_time": "yyyy-MM-dd'T'HH:mm:ss"}
    texts = t["orders"].select("o_orderkey", *[text(p).alias(n) for n, p in patterns.items()])
    return parse_by_evidence(texts, list(patterns))


# Profiles


@query
def table_profile(spark, t):
    return profile.table_profile(standins.products(t["part"]))


@query
def numeric_summary(spark, t):
    return _rounded(profile.numeric_summary(t["events"], ["value"]))


@query
def numeric_summary_text(spark, t):
    return profile.numeric_summary_text(_rounded(profile.numeric_summary(t["orders"], ["o_totalprice"])))


def _rounded(summary):
    """Means and deviations of doubles differ in the last digits from engine to engine."""
    return summary.withColumns({c: F.round(c, 6) for c in ("mean", "std", "p25", "p50", "p75")})


@query
def numeric_summary_all(spark, t):
    return _rounded(profile.numeric_summary(t["lineitem"]))


@query
def histogram_20(spark, t):
    h = histogram(t["events"], "value", 20)
    return h.withColumns({c: F.round(c, 6) for c in ("low", "high")})


@query
def mean_by_group(spark, t):
    means = profile.mean_by_group(t["customer"], "c_mktsegment", "c_acctbal", "mean_acctbal")
    return means.withColumn("mean_acctbal", F.round("mean_acctbal", 6))


@query
def count_by_group(spark, t):
    return profile.count_by_group(standins.products(t["part"]), "Size", ["ProductKey", "StartDate"])


@query
def count_all_by_group(spark, t):
    return profile.count_by_group(standins.products(t["part"]), "ProductName")


@query
def weight_bands(spark, t):
    return profile.count_by_band(standins.products(t["part"]), "Weight", WEIGHT_BANDS, "size_cat")


@query
def amount_by_date(spark, t):
    sums = profile.sum_by_date(t["orders"], "o_orderdate", "o_totalprice", "amount")
    return sums.withColumn("amount", F.round("amount", 2))


@query
def quantity_by_date_since(spark, t):
    sales = standins.sales(t["lineitem"], t["orders"]).where(since(F.col("OrderDate"), "2001-06-01"))
    return profile.sum_by_date(sales, "OrderDate", "OrderQuantity", "quantity")


@query
def sales_since(spark, t):
    sales = standins.sales(t["lineitem"], t["orders"]).where(since(F.col("OrderDate"), "2001-06-01"))
    return sales.select("OrderDate", "ShipDate", "UnitPrice", "OrderQuantity")


@query
def distinct_values(spark, t):
    return profile.distinct_values(t["lineitem"], "l_quantity")


@query
def head_rows(spark, t):
    return profile.head_rows(t["orders"], ["o_orderkey"])


@query
def null_rows(spark, t):
    return profile.null_rows(standins.products(t["part"]), "Size").select("ProductKey", "Size")


# Keys and repeated rows


@query
def key_uniqueness(spark, t):
    return keys.key_uniqueness(t["orders"], ["o_orderkey"]).unionAll(
        keys.key_uniqueness(t["lineitem"], ["l_orderkey", "l_linenumber"])
    )


@query
def key_violations(spark, t):
    return all_key_violations(
        {"orders": t["orders"], "lineitem": t["lineitem"]},
        {"orders": ("o_orderkey",), "lineitem": ("l_orderkey", "l_linenumber")},
    )


def _order_classes(t):
    return t["orders"].select("o_orderstatus", "o_orderpriority", F.year("o_orderdate").alias("order_year"))


@query
def duplicate_rows(spark, t):
    return duplicates.duplicate_rows(_order_classes(t))


@query
def duplicate_count(spark, t):
    return duplicates.duplicate_count(_order_classes(t))


@query
def duplicate_texts(spark, t):
    return duplicates.duplicate_wide_rows(t["documents"].select("text"))


# Rules and error logs


def _customers(t):
    return standins.customers(t["customer"], t["orders"])


def _customer_spec():
    return spec_of("dimcustomer", standins.DATE_FORMATS)


def _rows_of_rule(df, spec, error_type):
    return failing_rows(df, [r for r in spec.rules if r.error_type == error_type])


@query
def error_unexpected_value(spark, t):
    return _rows_of_rule(standins.accounts(t["customer"]), spec_of("dimaccounts"), "potential_data_corruption")


@query
def error_missing_attribute(spark, t):
    return _rows_of_rule(standins.products(t["part"]), spec_of("dimproduct"), "potentially_dismissed_prod")


@query
def error_size_unit(spark, t):
    return _rows_of_rule(standins.products(t["part"]), spec_of("dimproduct"), "size_inconcistency")


@query
def error_date_inconsistency(spark, t):
    return _rows_of_rule(_customers(t), _customer_spec(), "date_inconcistency")


@query
def error_log_accounts(spark, t):
    return table_errors(standins.accounts(t["customer"]), spec_of("dimaccounts"))


@query
def error_log_customer(spark, t):
    return table_errors(_customers(t), _customer_spec())


@query
def error_log_product(spark, t):
    return table_errors(standins.products(t["part"]), spec_of("dimproduct"))


def _star(t):
    return {
        "dimaccounts": standins.accounts(t["customer"]),
        "dimcustomer": _customers(t),
        "dimproduct": standins.products(t["part"]),
        "dimsalesterritory": standins.raw_territories(t["nation"]),
        "dimscenario": standins.raw_scenarios(t["orders"]),
        "factfinance": standins.finance(t["orders"]),
        "factresellersales": standins.sales(t["lineitem"], t["orders"]),
    }


@query
def error_log_all(spark, t):
    star = _star(t)
    specs = {n: spec_of(n, standins.DATE_FORMATS) for n in star}
    return all_errors(star, specs)


# Dates, phones, casts


@query
def date_parts(spark, t):
    d = F.col("o_orderdate")
    return t["orders"].select(
        "o_orderkey", year_text(d).alias("year_text"), month_text(d).alias("month_text"), F.year(d).alias("year_number")
    )


@query
def date_flags(spark, t):
    return standins.order_date_texts(t["orders"]).withColumn("date_flag", short_date_flag(F.col("date_text")))


@query
def parse_dates(spark, t):
    texts = standins.order_date_texts(t["orders"])
    return texts.withColumn("parsed", parse_date(F.col("date_text"), standins.DATE_FORMATS))


@query
def repair_dates(spark, t):
    texts = standins.order_date_texts(t["orders"])
    repaired = repair_date_columns(texts.withColumn("repaired", F.col("date_text")), ["repaired"], standins.DATE_FORMATS)
    return repaired.select("o_orderkey", "date_text", "repaired")


@query
def date_key_to_date(spark, t):
    return standins.order_date_keys(t["orders"]).withColumn("key_date", date_of_key(F.col("date_key")))


@query
def normalize_phone(spark, t):
    return _customers(t).select("CustomerKey", phone_number(F.col("Phone")).alias("Phone"))


@query
def cast_keys(spark, t):
    names = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    return keys.cast_keys(standins.keys_as_text(t["lineitem"].select(*names), names), names)


# Normalized tables


@query
def normalize_accounts(spark, t):
    raw = standins.keys_as_text(standins.accounts(t["customer"]), ("AccountKey",))
    return normalize(raw, spec_of("dimaccounts"))


@query
def normalize_customer(spark, t):
    return normalize(standins.keys_as_text(_customers(t), ("CustomerKey",)), _customer_spec())


@query
def normalize_customer_twice(spark, t):
    once = normalize(standins.keys_as_text(_customers(t), ("CustomerKey",)), _customer_spec())
    return normalize(once, _customer_spec())


@query
def normalize_product(spark, t):
    return normalize(standins.keys_as_text(standins.products(t["part"]), ("ProductKey",)), spec_of("dimproduct"))


@query
def normalize_territory(spark, t):
    return normalize(standins.raw_territories(t["nation"]), spec_of("dimsalesterritory"))


@query
def normalize_copy(spark, t):
    return normalize(t["region"], spec_of("dimscenario"))


@query
def normalize_finance(spark, t):
    return normalize(standins.keys_as_text(standins.finance(t["orders"]), ("FinanceKey",)), spec_of("factfinance"))


@query
def normalize_sales(spark, t):
    raw = standins.keys_as_text(standins.sales(t["lineitem"], t["orders"]), SALES_KEYS)
    return normalize(raw, spec_of("factresellersales"))


# Joins and questions


@query
def fact_dim_join_(spark, t):
    columns = ["ProductKey", "ProductName", "SalesAmount", "ShipDate"]
    return fact_dim_join(standins.shipped_sales(t["lineitem"]), standins.products(t["part"]), "ProductKey", columns)


def _top_transactions(t, ordered=True):
    wanted = questions.products_named(standins.products(t["part"]), PRODUCT)
    return questions.top_transaction_per_month(standins.sales(t["lineitem"], t["orders"], wanted), wanted, YEAR, ordered)


def _lowest_revenue(t, ordered=True):
    return questions.lowest_revenue_per_month(
        standins.shipped_sales(t["lineitem"]),
        standins.products(t["part"]),
        standins.territories(t["supplier"], t["nation"]),
        YEAR,
        ordered,
    )


def _avg_amount_by_scenario(t):
    return questions.avg_amount_by_scenario(
        standins.finance(t["orders"]),
        standins.accounts(t["customer"]),
        standins.scenarios(t["orders"]),
        FINANCE_YEAR,
        STATUS_SCENARIOS,
    )


def _product_month_sales(t):
    return questions.product_month_sales(
        standins.sales(t["lineitem"], t["orders"]), standins.products(t["part"]), YEAR
    )


def _age_bands(t):
    return questions.age_bands(standins.birth_dates(t["customer"]), F.lit("2026-01-01").cast("date"))


@query
def top_transaction_per_month(spark, t):
    return _top_transactions(t)


@query
def lowest_revenue_per_month(spark, t):
    return _lowest_revenue(t)


@query
def avg_amount_by_scenario(spark, t):
    return _avg_amount_by_scenario(t)


@query
def product_month_sales(spark, t):
    return _product_month_sales(t)


@query
def age_bands(spark, t):
    return _age_bands(t)


@query
def chart_frames(spark, t):
    return charts.chart_frames(_top_transactions(t, ordered=False), _lowest_revenue(t, ordered=False))


@query
def product_month_matrix(spark, t):
    return charts.product_month_matrix(_product_month_sales(t))


@query
def age_bands_rollup(spark, t):
    return charts.age_bands_rollup(_age_bands(t))
