"""The frames behind the charts of the five questions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.functions.numbers import money_mean

MONTHS = tuple(f"{m:02d}" for m in range(1, 13))
# The names of the age bands.
BANDS = ("age_less_than_35", "age_between_35_50", "age_more_than_50")


def chart_frames(top_transactions: DataFrame, lowest_revenue: DataFrame) -> DataFrame:
    """Bar heights in one long frame: the mean per month, for the second question also per country and
    per product. Both of its charts come from one pass over the answer."""
    first = top_transactions.select(
        F.lit("qa1").alias("chart"), "month", F.lit(None).cast("string").alias("hue"), "sales_amount"
    )
    hues = F.array(
        F.struct(F.lit("qa2a").alias("chart"), F.col("sales_territory_country").alias("hue")),
        F.struct(F.lit("qa2b").alias("chart"), F.col("product_name").alias("hue")),
    )
    second = lowest_revenue.select("month", "sales_amount", F.inline(hues))
    both = first.unionByName(second)
    return both.groupBy("chart", "month", "hue").agg(money_mean(both, "sales_amount").alias("value"))


def product_month_matrix(product_month: DataFrame) -> DataFrame:
    """One row per product with a column for each of the twelve months, zero where nothing was sold."""
    return product_month.groupBy("ProductKey").agg(
        *[
            F.coalesce(F.sum(F.when(F.col("OrderMonth") == m, F.col("SalesAmount"))), F.lit(0.0)).alias(f"m{m}")
            for m in MONTHS
        ]
    )


def age_bands_rollup(bands: DataFrame) -> DataFrame:
    """The age bands as they are, per gender and per marital status; the latter two without null keys."""
    level = (
        F.when(F.grouping_id() == 0, "both").when(F.grouping_id() == 2, "gender").otherwise("marital_status")
    )
    sets = [[F.col("marital_status"), F.col("gender")], [F.col("gender")], [F.col("marital_status")]]
    rolled = bands.groupingSets(sets, "marital_status", "gender").agg(
        level.alias("level"), *[F.sum(b).alias(b) for b in BANDS]
    )
    return rolled.where(
        (F.col("level") == "both")
        | ((F.col("level") == "gender") & F.col("gender").isNotNull())
        | ((F.col("level") == "marital_status") & F.col("marital_status").isNotNull())
    ).select("level", "marital_status", "gender", *BANDS)
