"""The sales star schema, derived in full from the given tables.

Repeated rows, nulls, letter sizes, short dates and phone texts, which the given tables lack, are derived
from their keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DATE_FORMATS = ("yyyy-MM-dd", "dd/MM/yyyy")


def date_key(column: Column) -> Column:
    """Integer key yyyyMMdd of a date."""
    return (F.year(column) * 10000 + F.month(column) * 100 + F.dayofmonth(column)).cast("bigint")


def date_text(column: Column, key: Column) -> Column:
    """ISO text of a date; every tenth as dd/MM/yy, some null."""
    return (
        F.when(key % 10 == 0, F.date_format(column, "dd/MM/yy"))
        .when(key % 97 == 0, F.lit(None))
        .otherwise(F.date_format(column, "yyyy-MM-dd"))
    )


def accounts(customer: DataFrame) -> DataFrame:
    return customer.select(
        F.col("c_custkey").alias("AccountKey"),
        F.col("c_name").alias("AccountDescription"),
        F.col("c_mktsegment").alias("AccountType"),
        F.when(F.col("c_custkey") % 500 == 7, F.lit("[Account].[Members]")).alias("CustomMembers"),
    )


def customers(customer: DataFrame, orders: DataFrame) -> DataFrame:
    """Customers with raw date and phone texts; the first purchase is their first order."""
    key = F.col("c_custkey")
    first = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.min("o_orderdate").alias("first"))
    birth = F.make_timestamp_ntz(
        F.lit(1950) + key % 60, F.lit(1) + key % 12, F.lit(1) + key % 28, F.lit(0), F.lit(0), F.lit(0)
    )
    return customer.join(first, "c_custkey", "left").select(
        key.alias("CustomerKey"),
        date_text(birth, key).alias("BirthDate"),
        date_text(F.col("first"), key + 5).alias("DateFirstPurchase"),
        F.concat(F.lit("1 (11) 500 555-"), F.lpad(key.cast("string"), F.greatest(F.lit(4), F.length(key.cast("string"))), F.lit("0"))).alias("Phone"),
        F.when(key % 2 == 0, "M").otherwise("S").alias("MaritalStatus"),
        F.when(F.col("c_nationkey") % 2 == 0, "F").otherwise("M").alias("Gender"),
        F.col("c_acctbal").alias("YearlyIncome"),
    )


def birth_dates(customer: DataFrame) -> DataFrame:
    """Customers with parsed birth dates, as after normalization."""
    key = F.col("c_custkey")
    return customer.select(
        key.alias("CustomerKey"),
        F.when(key % 97 != 0, F.make_date((F.lit(1950) + key % 60).cast("int"), F.lit(1), F.lit(1))).alias("BirthDate"),
        F.col("c_mktsegment").alias("MaritalStatus"),
        F.when(F.col("c_nationkey") % 2 == 0, "F").when(F.col("c_nationkey") % 2 == 1, "M").alias("Gender"),
    )


def products(part: DataFrame) -> DataFrame:
    key = F.col("p_partkey")
    return part.select(
        key.alias("ProductKey"),
        F.col("p_name").alias("ProductName"),
        F.col("p_brand").alias("ProductAlternateKey"),
        F.when(key % 13 != 0, F.expr("timestamp_ntz'2011-07-01 00:00:00' + make_dt_interval(p_size)")).alias("StartDate"),
        F.when(key % 11 != 0, F.lit("Current")).alias("Status"),
        F.when(key % 7 == 0, "S").when(key % 7 == 1, "XL").when(key % 7 == 2, F.lit(None))
        .otherwise(F.col("p_size").cast("string")).alias("Size"),
        F.when(key % 7 != 2, F.col("p_size").cast("double")).alias("Weight"),
        F.col("p_retailprice").alias("DealerPrice"),
    )


def territories(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    return supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).select(
        F.col("s_suppkey").alias("SalesTerritoryKey"),
        F.col("s_name").alias("SalesTerritoryRegion"),
        F.col("n_name").alias("SalesTerritoryCountry"),
    )


def raw_territories(nation: DataFrame) -> DataFrame:
    """Territories with one row of nulls."""
    rows = nation.select(
        F.col("n_nationkey").alias("SalesTerritoryKey"),
        F.col("n_name").alias("SalesTerritoryRegion"),
        F.col("n_regionkey").alias("SalesTerritoryGroup"),
    )
    nulls = nation.groupBy().agg(F.count(F.lit(1))).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema])
    return rows.unionAll(nulls)


def scenarios(orders: DataFrame) -> DataFrame:
    return raw_scenarios(orders).distinct()


def raw_scenarios(orders: DataFrame) -> DataFrame:
    """Scenarios as often as they are used: three rows, nearly all of them repeats."""
    return orders.select(
        F.col("o_orderstatus").alias("ScenarioKey"), F.lower("o_orderstatus").alias("ScenarioName")
    )


def finance(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_orderkey").alias("FinanceKey"),
        F.col("o_custkey").alias("AccountKey"),
        F.col("o_orderstatus").alias("ScenarioKey"),
        F.col("o_orderdate").alias("Date"),
        F.col("o_totalprice").alias("Amount"),
    )


def sales(lineitem: DataFrame, orders: DataFrame, products: DataFrame | None = None) -> DataFrame:
    """Sales, one per order line. Lines of other than the given products are dropped before the orders
    are joined, as a filter on the sales table itself would be."""
    lines = lineitem
    if products is not None:
        lines = lines.join(products.withColumnRenamed("ProductKey", "l_partkey"), "l_partkey", "left_semi")
    due = F.col("l_shipdate") + F.make_dt_interval(F.lit(7))
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("l_partkey").alias("ProductKey"),
        date_key(F.col("o_orderdate")).alias("OrderDateKey"),
        date_key(due).alias("DueDateKey"),
        date_key(F.col("l_shipdate")).alias("ShipDateKey"),
        F.col("o_custkey").alias("ResellerKey"),
        F.col("l_suppkey").alias("EmployeeKey"),
        F.round(F.col("l_discount") * 100).cast("bigint").alias("PromotionKey"),
        F.round(F.col("l_tax") * 100).cast("bigint").alias("CurrencyKey"),
        F.col("l_suppkey").alias("SalesTerritoryKey"),
        F.col("o_orderdate").alias("OrderDate"),
        F.col("l_shipdate").alias("ShipDate"),
        F.col("l_extendedprice").alias("SalesAmount"),
        F.col("l_quantity").alias("OrderQuantity"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("UnitPrice"),
    )


def shipped_sales(lineitem: DataFrame) -> DataFrame:
    """The columns of the sales table that an order line alone holds."""
    return lineitem.select(
        F.col("l_partkey").alias("ProductKey"),
        F.col("l_suppkey").alias("SalesTerritoryKey"),
        F.col("l_shipdate").alias("ShipDate"),
        F.col("l_extendedprice").alias("SalesAmount"),
        F.col("l_quantity").alias("OrderQuantity"),
    )


def keys_as_text(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    return df.withColumns({k: F.col(k).cast("string") for k in keys})


def order_date_texts(orders: DataFrame) -> DataFrame:
    return orders.select("o_orderkey", date_text(F.col("o_orderdate"), F.col("o_orderkey")).alias("date_text"))


def order_date_keys(orders: DataFrame) -> DataFrame:
    return orders.select("o_orderkey", date_key(F.col("o_orderdate")).alias("date_key"))
