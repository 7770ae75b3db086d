"""The whole run, sources and sinks."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tallyward.__main__ import main
from tallyward.plans import etl
from tallyward.sources.layers import ERRORS, NORMALIZED, RAW, read_layer, write_layer
from tallyward.sources.reports import read_report, report_from_sql, write_report
from tallyward.sources.shared import shared_folder
from tallyward.sources.tables import TABLE_NAMES, Tables, load_tables, table_names

DAY = dt.datetime(2012, 3, 4)
HELMET = "Sport-100 Helmet, Red"


@pytest.fixture
def source(spark, frame, tmp_path):
    """A small star schema as Parquet files."""
    frames = {
        "DimAccounts": frame([(1, "Cash", "Assets", None), (2, "Rent", "Expenses", "[a].[b]")],
                             "AccountKey long, AccountDescription string, AccountType string, CustomMembers string"),
        "DimCustomer": frame([(1, "1965-01-02", "2011-05-05", "245-555-0173", "M", "F"), (2, "12/31/70", "2011-05-05", "1 (11) 500 555-0162", "S", "M")],
                             "CustomerKey long, BirthDate string, DateFirstPurchase string, Phone string, MaritalStatus string, Gender string"),
        "DimProduct": frame([(1, HELMET, DAY, "Current", "M"), (2, "Glove", None, None, "42"), (2, "Glove", None, None, "42")],
                            "ProductKey long, ProductName string, StartDate timestamp_ntz, Status string, Size string"),
        "DimSalesTerritory": frame([(1, "North", "UK"), (None, None, None)],
                                   "SalesTerritoryKey long, SalesTerritoryRegion string, SalesTerritoryCountry string"),
        "DimScenario": frame([(1, "Actual"), (2, "Budget")], "ScenarioKey long, ScenarioName string"),
        "FactFinance": frame([(1, 1, 1, dt.datetime(2011, 1, 1), 10.0), (2, 1, 1, dt.datetime(2011, 2, 1), 20.0)],
                             "FinanceKey long, AccountKey long, ScenarioKey long, Date timestamp_ntz, Amount double"),
        "FactResellerSales": frame([(1, 20120304, 20120316, 20120311, 5, 6, 7, 8, 1, DAY, DAY, 100.5), (1, 20120304, 20120316, 20120311, 5, 6, 7, 8, 1, DAY, DAY, 50.0)],
                                   "ProductKey long, OrderDateKey long, DueDateKey long, ShipDateKey long, ResellerKey long, EmployeeKey long, "
                                   "PromotionKey long, CurrencyKey long, SalesTerritoryKey long, OrderDate timestamp_ntz, ShipDate timestamp_ntz, SalesAmount double"),
    }
    for name, df in frames.items():
        df.write.parquet(f"{tmp_path}/in/{name}.parquet")
    return f"{tmp_path}/in"


def test_whole_run(spark, source, tmp_path, monkeypatch, capsys):
    root = f"{tmp_path}/out"
    config = tmp_path / "config.json"
    config.write_text(json.dumps({"DATABASE": {"TABLES": TABLE_NAMES}}))
    monkeypatch.setattr("sys.argv", ["tallyward", source, root, "--config", str(config)])
    main()
    assert "factresellersales" in capsys.readouterr().out
    # A second run replaces, and adds nothing.
    summary = etl.run(spark, load_tables(spark, source), root, as_of=F.lit("2026-01-01").cast("date"))
    written = {(r.table_name, r.layer): r.n_rows for r in summary.collect()}
    assert written["dimproduct", RAW] == written["dimproduct", NORMALIZED] == 3
    assert written["dimsalesterritory", RAW] == 2 and written["dimsalesterritory", NORMALIZED] == 1
    assert written["dimscenario", ERRORS] == 0
    log = read_layer(spark, root, ERRORS, "dimproduct").collect()
    assert sorted((json.loads(r.row_key)[0], r.error_type) for r in log) == [
        ("1", "size_inconcistency"),
        ("2", "duplicated_row_in_raw_table"),
        ("2", "potentially_dismissed_prod"),
        ("2", "potentially_dismissed_prod"),
    ]
    assert json.loads(next(r for r in log if r.row_key == '["1"]').row_json)["ProductName"] == HELMET
    violations = read_layer(spark, root, ERRORS, "key_violations").collect()
    assert [tuple(r) for r in violations] == [("dimproduct", '["2"]', 2)]
    raw = read_layer(spark, root, RAW, "dimcustomer")
    assert raw.where("CustomerKey = 2").first().BirthDate == "12/31/70"
    assert read_layer(spark, root, NORMALIZED, "dimcustomer").where("CustomerKey = 2").first().BirthDate == dt.datetime(1970, 12, 31)
    qa1 = read_report(spark, root, "qa1", "month string, sales_amount double, order_date timestamp_ntz")
    assert [tuple(r) for r in qa1.collect()] == [("03", 100.5, DAY)]
    qa3 = read_report(spark, root, "qa3", "AccountType string, ActualScenario double, BudgetScenario double, ForecastScenario double")
    assert [tuple(r) for r in qa3.collect()] == [("Assets", 15.0, None, None)]


def test_run_with_two_tables_answers_what_it_can(spark, source, tmp_path):
    tables = load_tables(spark, source, {n: TABLE_NAMES[n] for n in ("DimCustomer", "DimScenario")})
    rows = {(r.table_name, r.layer): r for r in etl.run(spark, tables, f"{tmp_path}/out").collect()}
    assert rows["dimcustomer", NORMALIZED].n_rows == 2
    assert rows["qa5", "reports"].left_out is None and rows["age_bands_rollup", "reports"].left_out is None
    assert "factresellersales" in rows["qa1", "reports"].left_out
    assert "qa4" in rows["product_month_matrix", "reports"].left_out


def test_present_tables_are_loaded_and_a_question_names_the_lacking_one(spark, frame, tmp_path):
    frame([(1,)], "ProductKey long").write.parquet(f"{tmp_path}/DimProduct.parquet")
    tables = load_tables(spark, str(tmp_path))
    assert list(tables) == ["dimproduct"]
    with pytest.raises(KeyError, match="factresellersales"):
        tables["factresellersales"]


def test_table_names_from_config(tmp_path):
    path = tmp_path / "config.json"
    path.write_text(json.dumps({"DATABASE": {"TABLES": TABLE_NAMES}}))
    assert table_names(str(path)) == TABLE_NAMES


def test_csv_tables_need_a_schema(spark, frame, tmp_path):
    df = frame([(1, 'a,"b"'), (2, None)], "k long, s string")
    df.write.options(header=True, quote='"', escape='"').csv(f"{tmp_path}/t.csv")
    loaded = load_tables(spark, str(tmp_path), ["t"], "csv", {"t": "k long, s string"})
    assert sorted(map(tuple, loaded["t"].collect())) == [(1, 'a,"b"'), (2, None)]
    with pytest.raises(ValueError, match="schema"):
        load_tables(spark, str(tmp_path), ["t"], "csv")
    with pytest.raises(ValueError, match="format"):
        load_tables(spark, str(tmp_path), ["t"], "xlsx")


def test_report_reads_back_equal(spark, frame, tmp_path):
    rows = [(1, 'a, "b"\nc', 1.5, DAY), (2, None, None, None), (4, " x\\", -1e300, dt.datetime(2012, 1, 2, 3, 4, 5, 678901))]
    df = frame(rows, "k long, s string, v double, d timestamp_ntz")
    assert sorted(map(tuple, write_report(df, str(tmp_path), "r").collect())) == rows


def test_sorted_report_stays_sorted(spark, tmp_path):
    df = spark.range(1000).repartition(7).orderBy(F.desc("id"))
    assert [r.id for r in write_report(df, str(tmp_path), "r").collect()] == list(range(999, -1, -1))


def test_report_from_sql(spark, frame, tmp_path):
    tables = {"sales": frame([(1, 2.0), (1, 3.0)], "k long, v double"), "unused": frame([(1,)], "x int")}
    report = report_from_sql(spark, tables, "SELECT k, sum(v) AS v FROM {sales} GROUP BY k", str(tmp_path), "mine")
    assert [tuple(r) for r in report.collect()] == [(1, 5.0)]


def test_written_rows_are_counted_during_the_write(spark, frame, tmp_path):
    df = frame([(i, i % 3) for i in range(10)], "a int, b int")
    assert write_layer(df, str(tmp_path), RAW, "T", ["b"]) == 10
    assert write_layer(df.where("a < 0"), str(tmp_path), RAW, "T") == 0
    assert read_layer(spark, str(tmp_path), RAW, "t").count() == 0
    assert write_layer(df.where("a < 0"), str(tmp_path), ERRORS, "T", ["b"], ["a"]) == 0
    assert write_layer(df.repartition(3).where("a > 100"), str(tmp_path), ERRORS, "T", ["b"]) == 0
    assert write_layer(df.groupBy("b").count().where("b > 9"), str(tmp_path), ERRORS, "T", ["b"]) == 0


def test_empty_text_and_null_of_a_report_read_back_as_written(spark, frame, tmp_path):
    rows = [(1, ""), (2, None), (3, "null"), (4, '""'), (5, " ")]
    df = frame(rows, "k long, s string")
    assert sorted(map(tuple, write_report(df, str(tmp_path), "r").collect())) == rows


def test_stale_reports_and_tables_are_removed(spark, source, tmp_path):
    root = f"{tmp_path}/out"
    etl.run(spark, load_tables(spark, source), root)
    assert (tmp_path / "out/reports/qa1").exists() and (tmp_path / "out/raw/dimproduct").exists()
    few = load_tables(spark, source, {n: TABLE_NAMES[n] for n in ("DimCustomer", "DimScenario")})
    rows = {(r.table_name, r.layer) for r in etl.run(spark, few, root).collect()}
    assert not (tmp_path / "out/reports/qa1").exists() and (tmp_path / "out/reports/qa5").exists()
    assert sorted(p.name for p in (tmp_path / "out/raw").iterdir()) == ["_manifest", "dimcustomer", "dimscenario"]
    assert ("qa1", "reports") in rows


def test_names_that_are_not_found_are_reported(spark, source, tmp_path):
    with pytest.warns(UserWarning, match="nosuch"):
        tables = load_tables(spark, source, {"DimScenario": "dimscenario", "NoSuch": "nosuch"})
    assert list(tables) == ["dimscenario"] and list(tables.absent) == ["nosuch"]
    rows = {r.table_name: r for r in etl.run(spark, tables, f"{tmp_path}/out").collect()}
    assert "not found" in rows["nosuch"].left_out


def test_unknown_table_is_refused_before_anything_is_written(spark, frame, tmp_path):
    with pytest.raises(KeyError, match="eighth"):
        etl.run(spark, Tables(eighth=frame([(1,)], "a int")), f"{tmp_path}/out")
    assert not (tmp_path / "out").exists()


def test_empty_error_log_reads_back(spark, frame, tmp_path):
    rows = frame([(1, "x")], "a int, error_type string").where("a > 1")
    assert write_layer(rows, str(tmp_path), ERRORS, "T", ["error_type"]) == 0
    assert read_layer(spark, str(tmp_path), ERRORS, "T", rows.schema).collect() == []


def test_raw_layer_keeps_nan(spark, frame, tmp_path):
    etl.stage({"t": frame([(float("nan"),), (None,)], "v double")}, str(tmp_path))
    assert sorted(str(r.v) for r in read_layer(spark, str(tmp_path), RAW, "t").collect()) == ["None", "nan"]


def test_shared_folder_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    first, second = shared_folder(spark), shared_folder(spark)
    assert first != second
    assert base is None or first.startswith(f"{base.rstrip('/')}/tallyward-")
