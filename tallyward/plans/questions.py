"""The five questions. Each takes normalized tables and gives the answer as a DataFrame."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions.dates import age_in_years, month_text, rows_of_year, two_digits
from tallyward.functions.text import same_text
from tallyward.operators.joins import star_sum
from tallyward.operators.ranking import first_ranked, first_ranked_with_copies

# Result column -> scenario name.
SCENARIOS = {"ActualScenario": "Actual", "BudgetScenario": "Budget", "ForecastScenario": "Forecast"}


def products_named(product: DataFrame, name: str) -> DataFrame:
    """Keys of the products of one name, whatever its case."""
    return product.where(same_text(F.col("ProductName"), name)).select("ProductKey")


def top_transaction_per_month(sales: DataFrame, products: DataFrame, year: int, ordered: bool = True) -> DataFrame:
    """Highest single sale of each order month among the given products; equal sales are all kept.

    Ordered by month, and within it by copy, so that a month of very many equal sales is no single task.
    """
    rows = (
        rows_of_year(sales, "OrderDate", year)
        .join(products.select("ProductKey"), "ProductKey")
        .select(
            month_text(F.col("OrderDate")).alias("month"),
            F.col("SalesAmount").alias("sales_amount"),
            F.col("OrderDate").alias("order_date"),
        )
    )
    first = first_ranked_with_copies(rows, "month", "sales_amount", descending=True)
    return (first.orderBy("month", "_copy") if ordered else first).drop("_copy")


def lowest_revenue_per_month(
    sales: DataFrame, product: DataFrame, territory: DataFrame, year: int, ordered: bool = True
) -> DataFrame:
    """Product and country of least revenue in each ship month; equal revenues are all kept.

    Ordered by month, and within it by country and product.
    """
    revenue = star_sum(
        rows_of_year(sales, "ShipDate", year).withColumn("m", F.month("ShipDate")),
        {
            "ProductKey": product.select("ProductKey", "ProductName"),
            "SalesTerritoryKey": territory.select("SalesTerritoryKey", "SalesTerritoryCountry"),
        },
        ["m", "SalesTerritoryCountry", "ProductName"],
        {"amount": "SalesAmount"},
    )
    lowest = first_ranked(revenue, "m", "amount", descending=False).select(
        two_digits(F.col("m")).alias("month"),
        F.col("SalesTerritoryCountry").alias("sales_territory_country"),
        F.col("ProductName").alias("product_name"),
        F.col("amount").cast("double").alias("sales_amount"),
    )
    return lowest.orderBy("month", "sales_territory_country", "product_name") if ordered else lowest


def avg_amount_by_scenario(
    finance: DataFrame,
    account: DataFrame,
    scenario: DataFrame,
    year: int,
    scenarios: Mapping[str, str] = SCENARIOS,
) -> DataFrame:
    """Mean amount per account type, one column per scenario; null for a scenario without rows."""
    totals = star_sum(
        rows_of_year(finance, "Date", year),
        {
            "AccountKey": account.select("AccountKey", "AccountType"),
            "ScenarioKey": scenario.select("ScenarioKey", "ScenarioName"),
        },
        ["AccountType", "ScenarioName"],
        {"total": "Amount"},
        {"n": "Amount"},
    )
    return totals.groupBy("AccountType").agg(*[_mean_where(n, c) for c, n in scenarios.items()])


def _mean_where(scenario_name: str, result: str) -> Column:
    matches = same_text(F.col("ScenarioName"), scenario_name)
    total = F.sum(F.when(matches, F.col("total"))).cast("double")
    n = F.sum(F.when(matches, F.col("n")))
    return F.when(n > 0, total / n).alias(result)


def product_month_sales(sales: DataFrame, product: DataFrame, year: int) -> DataFrame:
    """Sum of the positive sales per product and order month."""
    sold = rows_of_year(sales, "OrderDate", year).where(F.col("SalesAmount") > 0)
    totals = star_sum(
        sold.withColumn("m", F.month("OrderDate")),
        {"ProductKey": product.select("ProductKey")},
        ["ProductKey", "m"],
        {"amount": "SalesAmount"},
    )
    return totals.select(
        "ProductKey", F.col("amount").cast("double").alias("SalesAmount"), two_digits(F.col("m")).alias("OrderMonth")
    ).orderBy("ProductKey", "OrderMonth")


def age_bands(customer: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Customers per age band, by marital status and gender. Without a birth date they are in no band."""
    age = age_in_years(F.col("BirthDate"), as_of)

    def number(condition: Column) -> Column:
        return F.sum(F.when(condition, 1).otherwise(0))

    return customer.groupBy(
        F.col("MaritalStatus").alias("marital_status"), F.col("Gender").alias("gender")
    ).agg(
        number(age < 35).alias("age_less_than_35"),
        number((age >= 35) & (age <= 50)).alias("age_between_35_50"),
        number(age > 50).alias("age_more_than_50"),
    )
