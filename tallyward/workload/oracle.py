"""The registered queries in plain SQL, over the same tables: name -> query."""

from __future__ import annotations

from tallyward.plans.specs import SALES_KEYS

# The star schema, derived from the given tables.

ACCOUNTS = """accounts AS (
  SELECT c_custkey AS "AccountKey", c_name AS "AccountDescription", c_mktsegment AS "AccountType",
         CASE WHEN c_custkey % 500 = 7 THEN '[Account].[Members]' END AS "CustomMembers"
  FROM customer)"""


def _date_text(column: str, key: str) -> str:
    return f"""CASE WHEN {key} % 10 = 0 THEN strftime({column}, '%d/%m/%y')
                    WHEN {key} % 97 = 0 THEN NULL
                    ELSE strftime({column}, '%Y-%m-%d') END"""


CUSTOMERS = f"""customers AS (
  SELECT c_custkey AS "CustomerKey",
         {_date_text('''make_timestamp(1950 + c_custkey % 60, 1 + c_custkey % 12, 1 + c_custkey % 28, 0, 0, 0)''', 'c_custkey')} AS "BirthDate",
         {_date_text('first_order', '(c_custkey + 5)')} AS "DateFirstPurchase",
         '1 (11) 500 555-' || CASE WHEN c_custkey < 10000 THEN lpad(CAST(c_custkey AS VARCHAR), 4, '0')
                                   ELSE CAST(c_custkey AS VARCHAR) END AS "Phone",
         CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'S' END AS "MaritalStatus",
         CASE WHEN c_nationkey % 2 = 0 THEN 'F' ELSE 'M' END AS "Gender",
         c_acctbal AS "YearlyIncome"
  FROM customer
  LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS first_order FROM orders GROUP BY o_custkey) AS f
    ON o_custkey = c_custkey)"""

BIRTHS = """births AS (
  SELECT c_mktsegment AS marital_status,
         CASE WHEN c_nationkey % 2 = 0 THEN 'F' WHEN c_nationkey % 2 = 1 THEN 'M' END AS gender,
         CASE WHEN c_custkey % 97 <> 0 THEN 2026 - (1950 + c_custkey % 60) END AS age
  FROM customer)"""

PRODUCTS = """products AS (
  SELECT p_partkey AS "ProductKey", p_name AS "ProductName", p_brand AS "ProductAlternateKey",
         CASE WHEN p_partkey % 13 <> 0 THEN TIMESTAMP '2011-07-01 00:00:00' + to_days(p_size) END AS "StartDate",
         CASE WHEN p_partkey % 11 <> 0 THEN 'Current' END AS "Status",
         CASE p_partkey % 7 WHEN 0 THEN 'S' WHEN 1 THEN 'XL' WHEN 2 THEN NULL
              ELSE CAST(p_size AS VARCHAR) END AS "Size",
         CASE WHEN p_partkey % 7 <> 2 THEN CAST(p_size AS DOUBLE) END AS "Weight",
         p_retailprice AS "DealerPrice"
  FROM part)"""

RAW_TERRITORIES = """territories AS (
  SELECT n_nationkey AS "SalesTerritoryKey", n_name AS "SalesTerritoryRegion",
         n_regionkey AS "SalesTerritoryGroup" FROM nation
  UNION ALL SELECT NULL, NULL, NULL)"""

RAW_SCENARIOS = """scenarios AS (
  SELECT o_orderstatus AS "ScenarioKey", lower(o_orderstatus) AS "ScenarioName" FROM orders)"""

FINANCE = """finance AS (
  SELECT o_orderkey AS "FinanceKey", o_custkey AS "AccountKey", o_orderstatus AS "ScenarioKey",
         o_orderdate AS "Date", o_totalprice AS "Amount" FROM orders)"""


def _date_key(column: str) -> str:
    return f"CAST(strftime({column}, '%Y%m%d') AS BIGINT)"


SALES = f"""sales AS (
  SELECT l_partkey AS "ProductKey", {_date_key('o_orderdate')} AS "OrderDateKey",
         {_date_key('(l_shipdate + INTERVAL 7 DAY)')} AS "DueDateKey", {_date_key('l_shipdate')} AS "ShipDateKey",
         o_custkey AS "ResellerKey", l_suppkey AS "EmployeeKey",
         CAST(round(l_discount * 100) AS BIGINT) AS "PromotionKey",
         CAST(round(l_tax * 100) AS BIGINT) AS "CurrencyKey", l_suppkey AS "SalesTerritoryKey",
         o_orderdate AS "OrderDate", l_shipdate AS "ShipDate", l_extendedprice AS "SalesAmount",
         l_quantity AS "OrderQuantity", l_extendedprice / l_quantity AS "UnitPrice"
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

DATE_TEXTS = f"""date_texts AS (
  SELECT o_orderkey, {_date_text('o_orderdate', 'o_orderkey')} AS date_text FROM orders)"""


def _parsed(text: str) -> str:
    return f"""CASE WHEN regexp_full_match({text}, '\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN try_strptime({text}, '%Y-%m-%d')
                    WHEN regexp_full_match({text}, '\\d{{2}}/\\d{{2}}/\\d{{4}}') THEN try_strptime({text}, '%d/%m/%Y') END"""


def _flag(text: str) -> str:
    return f"CASE WHEN length({text}) > 8 THEN 0 ELSE 1 END"


def _century(table: str, text: str) -> str:
    return f"""(SELECT substr(CAST(median(year({_parsed(text)})) AS VARCHAR), 1, 2)
                FROM {table} WHERE length({text}) > 8)"""


def _repaired(table: str, text: str) -> str:
    full = f"(substr({text}, 1, 6) || {_century(table, text)} || substr({text}, 7))"
    return f"CASE WHEN length({text}) > 8 THEN {_parsed(text)} ELSE {_parsed(full)} END"


def _duplicates(table: str, columns: str) -> str:
    return f"""SELECT {columns}, 'duplicated_row_in_raw_table' AS error_type
      FROM (SELECT *, row_number() OVER (PARTITION BY {columns}) AS copy FROM {table}) WHERE copy > 1"""


def _common(table: str, log: str, key: str, row: str) -> str:
    return f"SELECT '{table}' AS table_name, {key} AS row_key, error_type, {row} AS row_json FROM ({log})"


ACCOUNT_COLUMNS = '"AccountKey", "AccountDescription", "AccountType", "CustomMembers"'
CUSTOMER_COLUMNS = '"CustomerKey", "BirthDate", "DateFirstPurchase", "Phone", "MaritalStatus", "Gender", "YearlyIncome"'
PRODUCT_COLUMNS = (
    '"ProductKey", "ProductName", "ProductAlternateKey", "StartDate", "Status", "Size", "Weight", "DealerPrice"'
)
TERRITORY_COLUMNS = '"SalesTerritoryKey", "SalesTerritoryRegion", "SalesTerritoryGroup"'
SCENARIO_COLUMNS = '"ScenarioKey", "ScenarioName"'
FINANCE_COLUMNS = '"FinanceKey", "AccountKey", "ScenarioKey", "Date", "Amount"'
SALES_COLUMNS = ", ".join(f'"{c}"' for c in (*SALES_KEYS, "OrderDate", "ShipDate", "SalesAmount", "OrderQuantity", "UnitPrice"))

UNEXPECTED_VALUE = """SELECT *, 'potential_data_corruption' AS error_type FROM accounts
  WHERE "CustomMembers" IS NOT NULL"""
MISSING_ATTRIBUTE = """SELECT *, 'potentially_dismissed_prod' AS error_type FROM products
  WHERE "StartDate" IS NULL OR "Status" IS NULL"""
SIZE_UNIT = """SELECT *, 'size_inconcistency' AS error_type FROM products
  WHERE regexp_matches("Size", 'S|M|L|XL')"""
DATE_INCONSISTENCY = f"""SELECT *, 'date_inconcistency' AS error_type FROM customers
  WHERE {_flag('"BirthDate"')} = 1 OR {_flag('"DateFirstPurchase"')} = 1"""

ACCOUNT_LOG = f"""{_duplicates('accounts', ACCOUNT_COLUMNS)} UNION ALL {UNEXPECTED_VALUE}"""
CUSTOMER_LOG = f"""{_duplicates('customers', CUSTOMER_COLUMNS)} UNION ALL {DATE_INCONSISTENCY}
  UNION ALL SELECT *, 'date_unparseable' FROM customers
    WHERE ("BirthDate" IS NOT NULL AND {_repaired('customers', '"BirthDate"')} IS NULL)
       OR ("DateFirstPurchase" IS NOT NULL AND {_repaired('customers', '"DateFirstPurchase"')} IS NULL)"""
PRODUCT_LOG = f"""{_duplicates('products', PRODUCT_COLUMNS)}
  UNION ALL {MISSING_ATTRIBUTE} UNION ALL {SIZE_UNIT}"""


def _json_text(value: str) -> str:
    escaped = f"replace(replace(replace({value}, '\\', '\\\\'), '\"', '\\\"'), chr(10), '\\n')"
    return f"coalesce('\"' || {escaped} || '\"', 'null')"


def _key(*columns: str) -> str:
    """The keys as a JSON array of texts."""
    parts = " || ',' || ".join(_json_text(f'CAST("{c}" AS VARCHAR)') for c in columns)
    return f"'[' || {parts} || ']'"


def _row(columns: str, times: str = "", numbers: str = "") -> str:
    """The row as a JSON object; columns named in `times` and `numbers` are no texts."""
    parts = []
    for c in [x.strip().strip('"') for x in columns.split(",")]:
        if c in times.split():
            value = _json_text(f"strftime(\"{c}\", '%Y-%m-%dT%H:%M:%S.%g')")
        elif c in numbers.split():
            value = f"coalesce(CAST(\"{c}\" AS VARCHAR), 'null')"
        else:
            value = _json_text(f'"{c}"')
        parts.append(f"'\"{c}\":' || {value}")
    return "'{' || " + " || ',' || ".join(parts) + " || '}'"


PRODUCT_ROW = _row(PRODUCT_COLUMNS, "StartDate", "ProductKey Weight DealerPrice")

# The questions.

TOP_TRANSACTIONS = """SELECT month, sales_amount, order_date FROM (
    SELECT strftime(o_orderdate, '%m') AS month, l_extendedprice AS sales_amount, o_orderdate AS order_date,
           rank() OVER (PARTITION BY strftime(o_orderdate, '%m') ORDER BY l_extendedprice DESC NULLS LAST) AS rnk
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
    WHERE p_name ILIKE 'Red Plate' AND year(o_orderdate) = 1998)
  WHERE rnk = 1"""

LOWEST_REVENUE = """SELECT month, sales_territory_country, product_name, CAST(amount AS DOUBLE) AS sales_amount FROM (
    SELECT *, rank() OVER (PARTITION BY month ORDER BY amount ASC NULLS FIRST) AS rnk FROM (
      SELECT strftime(l_shipdate, '%m') AS month, n_name AS sales_territory_country, p_name AS product_name,
             sum(CAST(CAST(l_extendedprice AS VARCHAR) AS DECIMAL(28, 10))) AS amount
      FROM lineitem JOIN part ON l_partkey = p_partkey
      JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
      WHERE year(l_shipdate) = 1998 GROUP BY ALL))
  WHERE rnk = 1"""

AVG_AMOUNT = "SELECT c_mktsegment AS \"AccountType\", " + ", ".join(
    f"""CAST(sum(CAST(CAST(o_totalprice AS VARCHAR) AS DECIMAL(28, 10))) FILTER (s ILIKE '{status}') AS DOUBLE)
        / count(o_totalprice) FILTER (s ILIKE '{status}') AS scenario_{status}"""
    for status in "fox"
) + """ FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN (SELECT DISTINCT o_orderstatus AS k, lower(o_orderstatus) AS s FROM orders) ON o_orderstatus = k
  WHERE year(o_orderdate) = 1997 GROUP BY c_mktsegment"""

PRODUCT_MONTH = """SELECT p_partkey AS "ProductKey",
    CAST(sum(CAST(CAST(l_extendedprice AS VARCHAR) AS DECIMAL(28, 10))) AS DOUBLE) AS "SalesAmount",
    strftime(o_orderdate, '%m') AS "OrderMonth"
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  WHERE year(o_orderdate) = 1998 AND l_extendedprice > 0 GROUP BY ALL"""

AGE_BANDS = """SELECT marital_status, gender,
    CAST(sum(CASE WHEN age < 35 THEN 1 ELSE 0 END) AS BIGINT) AS age_less_than_35,
    CAST(sum(CASE WHEN age >= 35 AND age <= 50 THEN 1 ELSE 0 END) AS BIGINT) AS age_between_35_50,
    CAST(sum(CASE WHEN age > 50 THEN 1 ELSE 0 END) AS BIGINT) AS age_more_than_50
  FROM births GROUP BY marital_status, gender"""

_BAND_SUMS = ", ".join(
    f"CAST(sum({b}) AS BIGINT) AS {b}" for b in ("age_less_than_35", "age_between_35_50", "age_more_than_50")
)

_SUMMARY = """count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, min({c}) AS min,
  round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50,
  round(quantile_cont({c}, 0.75), 6) AS p75, max({c}) AS max"""

_LINE_NUMBERS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
)

_PROFILE_TYPES = (
    ("ProductKey", "int"), ("ProductName", "text"), ("ProductAlternateKey", "text"), ("StartDate", "date"),
    ("Status", "text"), ("Size", "text"), ("Weight", "float"), ("DealerPrice", "float"),
)

_MEAN = "CAST(sum(CAST(CAST(sales_amount AS VARCHAR) AS DECIMAL(28, 10))) AS DOUBLE) / count(sales_amount)"

ORDER_CLASSES = """classes AS (
  SELECT o_orderstatus, o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS order_year FROM orders)"""

_HOT_JOIN = """SELECT CASE WHEN l_linenumber % 3 = 0 THEN 1 ELSE l_partkey END AS "ProductKey", p_name AS "ProductName", l_orderkey, l_linenumber, l_extendedprice
  FROM lineitem JOIN part ON p_partkey = CASE WHEN l_linenumber % 3 = 0 THEN 1 ELSE l_partkey END"""


def _ranked(order: str, k: int) -> str:
    return f"""SELECT o_orderkey, o_totalprice, strftime(o_orderdate, '%m') AS month,
      rank() OVER (PARTITION BY strftime(o_orderdate, '%m') ORDER BY o_totalprice {order}) AS rank FROM orders QUALIFY rank <= {k}"""


_CLASSES = "o_orderstatus, o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS order_year"

_GATED = """lines AS (
  SELECT CASE WHEN l_partkey % 50 <> 0 THEN l_orderkey END AS l_orderkey, l_linenumber, l_partkey, l_quantity, l_shipdate FROM lineitem
), counted AS (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lines)"""

ORACLE: dict[str, str] = {
    "load_tables": " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, count(*) AS n_rows FROM {n}"
        for n in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
    ),
    "stage_raw_roundtrip": "SELECT *, (SELECT count(*) FROM orders) AS rows_written FROM orders",
    "replace_roundtrip": """SELECT * REPLACE (o_totalprice + 1 AS o_totalprice), (SELECT count(*) FROM orders) AS first_rows,
      (SELECT count(*) FROM orders WHERE o_orderstatus <> 'F') AS second_rows FROM orders WHERE o_orderstatus <> 'F'""",
    "resumed_run": f"""WITH {SALES} SELECT 'dimaccounts' AS table_name, TRUE AS kept, count(*) AS n_rows FROM customer
      UNION ALL SELECT 'dimcustomer', TRUE, count(*) FROM customer UNION ALL SELECT 'dimproduct', TRUE, count(*) FROM part
      UNION ALL SELECT 'dimsalesterritory', FALSE, count(*) + 1 FROM nation UNION ALL SELECT 'dimscenario', FALSE, count(*) FROM orders
      UNION ALL SELECT 'factfinance', FALSE, count(*) FROM orders UNION ALL SELECT 'factresellersales', FALSE, count(*) FROM sales""",
    "load_new_rows": f"""SELECT {_CLASSES}, (SELECT count(*) FROM orders WHERE o_orderkey % 4 = 0) AS rows_added FROM orders""",
    "load_new_rows_added": f"SELECT {_CLASSES} FROM orders EXCEPT ALL SELECT {_CLASSES} FROM orders WHERE o_orderkey % 4 <> 0",
    "key_gate_table": f"WITH {_GATED} SELECT * EXCLUDE (n) FROM counted WHERE l_orderkey IS NOT NULL AND n = 1",
    "key_gate_quarantine": f"""WITH {_GATED} SELECT * EXCLUDE (n), CASE WHEN l_orderkey IS NULL THEN 'null' ELSE 'repeated' END AS key_state
      FROM counted WHERE l_orderkey IS NULL OR n > 1""",
    "split_key_join": _HOT_JOIN,
    "bucketed_join": _HOT_JOIN,
    "rank_within_first": _ranked("DESC NULLS LAST", 1),
    "rank_within_three": _ranked("ASC NULLS FIRST", 3),
    "rank_within_hundred": _ranked("DESC NULLS LAST", 100),
    "rank_within_ties": """SELECT l_returnflag, l_quantity, l_orderkey, l_partkey, rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity ASC NULLS FIRST) AS rank
      FROM lineitem QUALIFY rank <= 100""",
    "sketch_summary": """SELECT 'o_totalprice' AS column_name, count(*) AS n_rows, count(o_totalprice) AS n_values, min(o_totalprice) AS min,
      max(o_totalprice) AS max, TRUE AS quartiles_within, TRUE AS distinct_within FROM orders""",
    "measure_after_replace": f"""WITH {SALES} SELECT "ProductKey", CAST(year("OrderDate") AS INTEGER) AS "OrderDate_year",
      round(sum(CASE WHEN year("OrderDate") = 1998 THEN 2 * "SalesAmount" ELSE "SalesAmount" END), 2) AS amount, count(*) AS n_rows FROM sales GROUP BY 1, 2""",
    "dates_by_evidence": f"""SELECT o_orderkey, {", ".join(
        f"CASE WHEN o_orderkey % 97 <> 0 AND o_orderkey % 10 <> 3 THEN o_orderdate END AS {c}" for c in ("day_first", "month_first", "month_name", "with_time"))} FROM orders""",
    "report_csv_roundtrip": AVG_AMOUNT,
    "load_mapped_tables": """SELECT 'r' AS table_name, TRUE AS found, count(*) AS n_rows, 1 AS n_absent FROM region
      UNION ALL SELECT 'n', TRUE, count(*), 1 FROM nation""",
    "normalized_roundtrip": f"""WITH {SALES} SELECT *, CAST(year("OrderDate") AS INTEGER) AS "OrderDate_year",
      (SELECT count(*) FROM sales) AS rows_written FROM sales WHERE year("OrderDate") = 1998""",
    "error_log_roundtrip": f"""WITH {PRODUCTS} SELECT 'dimproduct' AS table_name, error_type, count(*) AS n,
      (SELECT count(*) FROM ({PRODUCT_LOG})) AS rows_written FROM ({PRODUCT_LOG}) GROUP BY error_type""",
    "normalized_roundtrip_all": f"""WITH {SALES} SELECT *, CAST(year("OrderDate") AS INTEGER) AS "OrderDate_year",
      (SELECT count(*) FROM sales) AS rows_written FROM sales""",
    "error_log_roundtrip_all": f"""WITH {PRODUCTS} SELECT *, (SELECT count(*) FROM ({PRODUCT_LOG})) AS rows_written
      FROM ({_common("dimproduct", PRODUCT_LOG, _key("ProductKey"), PRODUCT_ROW)})""",
    "table_profile": f"WITH {PRODUCTS} "
    + " UNION ALL ".join(
        f"SELECT {i + 1} AS position, '{c}' AS column_name, '{k}' AS sql_type, count(\"{c}\") AS n_values FROM products"
        for i, (c, k) in enumerate(_PROFILE_TYPES)
    ),
    "numeric_summary": f"SELECT 'value' AS column_name, {_SUMMARY.format(c='value')} FROM events",
    "numeric_summary_all": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {_SUMMARY.format(c=f'CAST({c} AS DOUBLE)')} FROM lineitem" for c in _LINE_NUMBERS
    ),
    "numeric_summary_text": "SELECT column_name, "
    + ", ".join(
        f"printf('%.6f', CAST({m} AS DOUBLE)) AS {m}" for m in ("n", "mean", "std", "min", "p25", "p50", "p75", "max")
    )
    + f" FROM (SELECT 'o_totalprice' AS column_name, {_SUMMARY.format(c='o_totalprice')} FROM orders)",
    "histogram_20": """WITH span AS (SELECT min(value) AS lo, max(value) AS hi FROM events),
      bins AS (SELECT CAST(i AS INTEGER) AS bin, lo + (i - 1) * ((hi - lo) / 20) AS low,
                      CASE WHEN i = 20 THEN hi ELSE lo + i * ((hi - lo) / 20) END AS high
               FROM span, range(1, 21) AS r(i))
      SELECT bin, round(low, 6) AS low, round(high, 6) AS high, count(value) AS n
      FROM bins LEFT JOIN events ON value >= low AND (value < high OR (bin = 20 AND value = high))
      GROUP BY ALL""",
    "mean_by_group": """SELECT c_mktsegment, round(avg(c_acctbal), 6) AS mean_acctbal FROM customer
      GROUP BY c_mktsegment""",
    "count_by_group": f"""WITH {PRODUCTS} SELECT "Size", count("ProductKey") AS "ProductKey",
      count("StartDate") AS "StartDate" FROM products WHERE "Size" IS NOT NULL GROUP BY "Size\"""",
    "count_all_by_group": f"""WITH {PRODUCTS} SELECT "ProductName", count("ProductKey") AS "ProductKey",
      count("ProductAlternateKey") AS "ProductAlternateKey", count("StartDate") AS "StartDate",
      count("Status") AS "Status", count("Size") AS "Size", count("Weight") AS "Weight",
      count("DealerPrice") AS "DealerPrice" FROM products GROUP BY "ProductName\"""",
    "weight_bands": f"""WITH {PRODUCTS} SELECT CASE WHEN "Weight" < 10 THEN '0-10' WHEN "Weight" < 50 THEN '10-50'
      ELSE '50+' END AS size_cat, count(*) AS n FROM products WHERE "Weight" IS NOT NULL GROUP BY 1""",
    "amount_by_date": """SELECT o_orderdate, round(sum(o_totalprice), 2) AS amount
      FROM orders GROUP BY o_orderdate ORDER BY o_orderdate""",
    "quantity_by_date_since": f"""WITH {SALES}
      SELECT "OrderDate", sum("OrderQuantity") AS quantity
      FROM sales WHERE "OrderDate" >= TIMESTAMP '2001-06-01' GROUP BY "OrderDate" ORDER BY "OrderDate\"""",
    "sales_since": f"""WITH {SALES} SELECT "OrderDate", "ShipDate", "UnitPrice", "OrderQuantity" FROM sales
      WHERE "OrderDate" >= TIMESTAMP '2001-06-01'""",
    "distinct_values": "SELECT DISTINCT l_quantity FROM lineitem",
    "head_rows": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5",
    "null_rows": f'WITH {PRODUCTS} SELECT "ProductKey", "Size" FROM products WHERE "Size" IS NULL',
    "key_uniqueness": """SELECT 'o_orderkey' AS key_columns, count(*) = count(DISTINCT o_orderkey) AS is_unique FROM orders
      UNION ALL SELECT 'l_orderkey,l_linenumber', count(*) = count(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem""",
    "key_violations": f"""SELECT 'orders' AS table_name, {_key('o_orderkey')} AS row_key, count(*) AS copies
      FROM orders GROUP BY o_orderkey HAVING count(*) > 1
      UNION ALL SELECT 'lineitem', {_key('l_orderkey', 'l_linenumber')}, count(*)
      FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "duplicate_rows": f"""WITH {ORDER_CLASSES}
      SELECT o_orderstatus, o_orderpriority, order_year FROM (
        SELECT *, row_number() OVER (PARTITION BY o_orderstatus, o_orderpriority, order_year) AS copy FROM classes)
      WHERE copy > 1""",
    "duplicate_count": f"""WITH {ORDER_CLASSES}
      SELECT (SELECT count(*) FROM classes) - (SELECT count(*) FROM (SELECT DISTINCT * FROM classes)) AS n_duplicates""",
    "duplicate_texts": """SELECT text FROM (
        SELECT text, row_number() OVER (PARTITION BY text) AS copy FROM documents) WHERE copy > 1""",
    "error_unexpected_value": f"WITH {ACCOUNTS} {UNEXPECTED_VALUE}",
    "error_missing_attribute": f"WITH {PRODUCTS} {MISSING_ATTRIBUTE}",
    "error_size_unit": f"WITH {PRODUCTS} {SIZE_UNIT}",
    "error_date_inconsistency": f"WITH {CUSTOMERS} {DATE_INCONSISTENCY}",
    "error_log_accounts": f"WITH {ACCOUNTS} {ACCOUNT_LOG}",
    "error_log_customer": f"WITH {CUSTOMERS} {CUSTOMER_LOG}",
    "error_log_product": f"WITH {PRODUCTS} {PRODUCT_LOG}",
    "error_log_all": f"WITH {ACCOUNTS}, {CUSTOMERS}, {PRODUCTS}, {RAW_TERRITORIES}, {RAW_SCENARIOS}, {FINANCE}, {SALES} "
    + " UNION ALL ".join(
        (
            _common("dimaccounts", ACCOUNT_LOG, _key("AccountKey"), _row(ACCOUNT_COLUMNS, "", "AccountKey")),
            _common("dimcustomer", CUSTOMER_LOG, _key("CustomerKey"), _row(CUSTOMER_COLUMNS, "", "CustomerKey YearlyIncome")),
            _common("dimproduct", PRODUCT_LOG, _key("ProductKey"), PRODUCT_ROW),
            _common("dimsalesterritory", _duplicates("territories", TERRITORY_COLUMNS), _key("SalesTerritoryKey"),
                    _row(TERRITORY_COLUMNS, "", "SalesTerritoryKey SalesTerritoryGroup")),
            _common("dimscenario", _duplicates("scenarios", SCENARIO_COLUMNS), _key("ScenarioKey"), _row(SCENARIO_COLUMNS)),
            _common("factfinance", _duplicates("finance", FINANCE_COLUMNS), _key("FinanceKey"),
                    _row(FINANCE_COLUMNS, "Date", "FinanceKey AccountKey Amount")),
            _common("factresellersales", _duplicates("sales", SALES_COLUMNS), _key(*SALES_KEYS),
                    _row(SALES_COLUMNS, "OrderDate ShipDate", " ".join([*SALES_KEYS, "SalesAmount OrderQuantity UnitPrice"]))),
        )
    ),
    "date_parts": """SELECT o_orderkey, strftime(o_orderdate, '%Y') AS year_text, strftime(o_orderdate, '%m') AS month_text,
      CAST(year(o_orderdate) AS INTEGER) AS year_number FROM orders""",
    "date_flags": f"WITH {DATE_TEXTS} SELECT *, {_flag('date_text')} AS date_flag FROM date_texts",
    "parse_dates": f"WITH {DATE_TEXTS} SELECT *, {_parsed('date_text')} AS parsed FROM date_texts",
    "repair_dates": f"WITH {DATE_TEXTS} SELECT *, {_repaired('date_texts', 'date_text')} AS repaired FROM date_texts",
    "date_key_to_date": f"""SELECT o_orderkey, {_date_key('o_orderdate')} AS date_key,
      strptime(strftime(o_orderdate, '%Y%m%d'), '%Y%m%d') AS key_date FROM orders""",
    "normalize_phone": f"""WITH {CUSTOMERS} SELECT "CustomerKey",
      CAST(regexp_replace("Phone", '[() -]', '', 'g') AS BIGINT) AS "Phone" FROM customers""",
    "cast_keys": """SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber
      FROM lineitem""",
    "normalize_accounts": f"WITH {ACCOUNTS} SELECT * FROM accounts",
    "normalize_customer": f"""WITH {CUSTOMERS} SELECT * REPLACE (
        {_repaired('customers', '"BirthDate"')} AS "BirthDate",
        {_repaired('customers', '"DateFirstPurchase"')} AS "DateFirstPurchase",
        CAST(regexp_replace("Phone", '[() -]', '', 'g') AS BIGINT) AS "Phone") FROM customers""",
    "normalize_customer_twice": f"""WITH {CUSTOMERS} SELECT * REPLACE (
        {_repaired('customers', '"BirthDate"')} AS "BirthDate",
        {_repaired('customers', '"DateFirstPurchase"')} AS "DateFirstPurchase",
        CAST(regexp_replace("Phone", '[() -]', '', 'g') AS BIGINT) AS "Phone") FROM customers""",
    "normalize_product": f"WITH {PRODUCTS} SELECT * FROM products",
    "normalize_territory": f'WITH {RAW_TERRITORIES} SELECT * FROM territories WHERE "SalesTerritoryRegion" IS NOT NULL',
    "normalize_copy": "SELECT * FROM region",
    "normalize_finance": f"WITH {FINANCE} SELECT * FROM finance",
    "normalize_sales": f"WITH {SALES} SELECT * FROM sales",
    "fact_dim_join": """SELECT l_partkey AS "ProductKey", p_name AS "ProductName", l_extendedprice AS "SalesAmount",
      l_shipdate AS "ShipDate" FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "top_transaction_per_month": f"{TOP_TRANSACTIONS} ORDER BY month",
    "lowest_revenue_per_month": f"{LOWEST_REVENUE} ORDER BY month",
    "avg_amount_by_scenario": AVG_AMOUNT,
    "product_month_sales": f'{PRODUCT_MONTH} ORDER BY "ProductKey", "OrderMonth"',
    "age_bands": f"WITH {BIRTHS} {AGE_BANDS}",
    "chart_frames": f"""SELECT 'qa1' AS chart, month, CAST(NULL AS VARCHAR) AS hue, {_MEAN} AS value
        FROM ({TOP_TRANSACTIONS}) GROUP BY month
      UNION ALL SELECT 'qa2a', month, sales_territory_country, {_MEAN} FROM ({LOWEST_REVENUE}) GROUP BY ALL
      UNION ALL SELECT 'qa2b', month, product_name, {_MEAN} FROM ({LOWEST_REVENUE}) GROUP BY ALL""",
    "product_month_matrix": 'SELECT "ProductKey", '
    + ", ".join(
        f"""coalesce(sum("SalesAmount") FILTER ("OrderMonth" = '{m:02d}'), 0.0) AS m{m:02d}""" for m in range(1, 13)
    )
    + f' FROM ({PRODUCT_MONTH}) GROUP BY "ProductKey"',
    "age_bands_rollup": f"""WITH {BIRTHS}, bands AS ({AGE_BANDS})
      SELECT 'both' AS level, * FROM bands
      UNION ALL SELECT 'gender', NULL, gender, {_BAND_SUMS} FROM bands WHERE gender IS NOT NULL GROUP BY gender
      UNION ALL SELECT 'marital_status', marital_status, NULL, {_BAND_SUMS} FROM bands
        WHERE marital_status IS NOT NULL GROUP BY marital_status""",
}
