"""python -m tallyward SOURCE OUTPUT: load the tables in SOURCE, cleanse them, write layers and reports."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tallyward.plans.etl import FINANCE_YEAR, PRODUCT_NAME, SALES_YEAR, run
from tallyward.sources.tables import TABLE_NAMES, load_tables, table_names


def main() -> None:
    parser = argparse.ArgumentParser(prog="tallyward", description=__doc__)
    parser.add_argument("source", help="folder with one Parquet file or folder per table")
    parser.add_argument("output", help="folder for layers and reports; shared by all executors")
    parser.add_argument("--config", help="JSON file with the source-to-table names")
    parser.add_argument("--sales-year", type=int, default=SALES_YEAR)
    parser.add_argument("--finance-year", type=int, default=FINANCE_YEAR)
    parser.add_argument("--product-name", default=PRODUCT_NAME)
    parser.add_argument("--new-rows-only", action="store_true", help="keep the stored raw rows and add those beyond them")
    parser.add_argument("--gate", action="store_true", help="only rows with a unique key enter normalized tables")
    options = parser.parse_args()
    spark = SparkSession.builder.appName("tallyward").getOrCreate()
    names = table_names(options.config) if options.config else TABLE_NAMES
    tables = load_tables(spark, options.source, names)
    run(
        spark,
        tables,
        options.output,
        sales_year=options.sales_year,
        finance_year=options.finance_year,
        product_name=options.product_name,
        new_rows_only=options.new_rows_only,
        gate=options.gate,
    ).show(1000, truncate=False)


if __name__ == "__main__":
    main()
