"""Replacing in one step, going on after a failure, loading new rows, and the gate on keys."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyward.functions.prints import row_prints
from tallyward.operators import gate, increment
from tallyward.plans import etl
from tallyward.sources import manifest
from tallyward.sources.journal import JOURNAL, input_print
from tallyward.sources.layers import ERRORS, NORMALIZED, RAW, read_layer, remove_others, stage_layer, write_layer
from tallyward.sources.manifest import Conflict, commit, current, remove_orphans
from tallyward.sources.reports import read_report, stage_report, write_report
from tallyward.sources.shared import folders_in, read_text, write_new
from tallyward.sources.tables import Tables

DAY = dt.datetime(2012, 3, 4)


def bag(df):
    return Counter(map(tuple, df.collect()))


# Replacing in one step


def test_a_write_that_ends_half_way_leaves_the_old_table(spark, tmp_path):
    root = str(tmp_path)
    write_layer(spark.range(100), root, RAW, "t")
    broken = spark.range(0, 1000, 1, 8).select(F.when(F.col("id") == 999, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        write_layer(broken, root, RAW, "t")
    assert read_layer(spark, root, RAW, "t").count() == 100
    stage_layer(spark.range(5), root, RAW, "t")  # written whole, but its driver stops before the commit
    assert read_layer(spark, root, RAW, "t").count() == 100
    assert len(remove_orphans(spark, root, RAW)) == 2
    assert read_layer(spark, root, RAW, "t").count() == 100
    assert write_layer(spark.range(7), root, RAW, "t") == 7
    assert read_layer(spark, root, RAW, "t").count() == 7 and len(folders_in(spark, f"{root}/raw/t")) == 1


def test_a_manifest_that_was_not_renamed_does_not_count(spark, tmp_path):
    root = str(tmp_path)
    write_layer(spark.range(3), root, RAW, "t")
    folder = tmp_path / RAW / manifest.MANIFEST
    (folder / ".0000000002.json-draft").write_text("{ half of a manif")
    assert read_layer(spark, root, RAW, "t").count() == 3
    write_layer(spark.range(4), root, RAW, "t")
    assert read_layer(spark, root, RAW, "t").count() == 4


def test_a_table_may_be_replaced_by_what_is_read_from_it(spark, tmp_path):
    root = str(tmp_path)
    write_layer(spark.range(10), root, RAW, "t")
    write_layer(read_layer(spark, root, RAW, "t").where("id > 4"), root, RAW, "t")
    assert sorted(r.id for r in read_layer(spark, root, RAW, "t").collect()) == list(range(5, 10))


def test_two_writers(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    write_layer(spark.range(1), root, RAW, "a")
    late = stage_layer(spark.range(2), root, RAW, "b")
    real, calls = manifest.write_new, []

    def overtaken(spark, path, text):
        if not calls:
            calls.append(path)
            write_layer(spark.range(3), root, RAW, "a")  # takes the number first
        return real(spark, path, text)

    monkeypatch.setattr(manifest, "write_new", overtaken)
    commit(spark, root, RAW, {"b": late})
    assert {n: read_layer(spark, root, RAW, n).count() for n in "ab"} == {"a": 3, "b": 2}
    monkeypatch.undo()
    base = current(spark, root, RAW)["a"]
    write_layer(spark.range(4), root, RAW, "a")
    with pytest.raises(Conflict):
        commit(spark, root, RAW, {"a": late}, expected={"a": base})
    assert read_layer(spark, root, RAW, "a").count() == 4


def test_a_manifest_that_is_replaced_while_it_is_looked_up(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    write_layer(spark.range(1), root, RAW, "t")
    real, calls = manifest.read_text, []

    def late(spark, path):
        if not calls:
            calls.append(path)
            write_layer(spark.range(6), root, RAW, "t")
        return real(spark, path)

    monkeypatch.setattr(manifest, "read_text", late)
    assert current(spark, root, RAW)["t"].n_rows == 6


def test_new_files_are_whole_and_never_replaced(spark, tmp_path):
    assert write_new(spark, f"{tmp_path}/x.json", "één") and not write_new(spark, f"{tmp_path}/x.json", "two")
    assert read_text(spark, f"{tmp_path}/x.json") == "één"
    assert [p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc")] == ["x.json"]


def test_reports_are_replaced_in_one_step(spark, frame, tmp_path):
    root = str(tmp_path)
    write_report(frame([(1,)], "k long"), root, "r")
    stage_report(frame([(2,)], "k long"), root, "r")
    assert [r.k for r in read_report(spark, root, "r", "k long").collect()] == [1]
    with pytest.raises(FileNotFoundError, match="other"):
        read_report(spark, root, "other", "k long")


def test_other_tables_are_taken_out(spark, tmp_path):
    root = str(tmp_path)
    for name in ("A", "b"):
        write_layer(spark.range(2), root, RAW, name)
    assert remove_others(spark, root, ["B"]) == [f"{root}/raw/a"]
    assert list(current(spark, root, RAW)) == ["b"]
    with pytest.raises(FileNotFoundError, match="A"):
        read_layer(spark, root, RAW, "A")


# Going on after a failure


def star(frame):
    return Tables(
        dimaccounts=frame([(1, "Cash", "Assets", None), (2, "Rent", "Expenses", "[a]")], "AccountKey long, AccountDescription string, AccountType string, CustomMembers string"),
        dimproduct=frame([(1, "Cap", DAY, "Current", "M"), (2, "Hat", None, None, "4"), (2, "Hat", None, None, "4")], "ProductKey long, ProductName string, StartDate timestamp_ntz, Status string, Size string"),
        dimsalesterritory=frame([(1, "North", "UK"), (None, None, None)], "SalesTerritoryKey long, SalesTerritoryRegion string, SalesTerritoryCountry string"),
        dimscenario=frame([(1, "Actual"), (2, "Budget")], "ScenarioKey long, ScenarioName string"),
        factfinance=frame([(1, 1, 1, dt.datetime(2011, 1, 1), 10.0), (1, 1, 1, dt.datetime(2011, 2, 1), 20.0), (None, 1, 2, None, 1.0)], "FinanceKey long, AccountKey long, ScenarioKey long, Date timestamp_ntz, Amount double"),
    )


def everything(spark, root):
    tables = {(layer, n): bag(read_layer(spark, root, layer, n)) for layer in (RAW, NORMALIZED, ERRORS) for n in current(spark, root, layer)}
    reports = {n: bag(read_report(spark, root, n, e.struct)) for n, e in current(spark, root, "reports").items()}
    return tables | reports


def test_a_run_goes_on_after_a_failure(spark, frame, tmp_path, monkeypatch):
    root, clean = f"{tmp_path}/out", f"{tmp_path}/clean"
    before = star(frame)
    etl.run(spark, Tables(dimscenario=before["dimscenario"]), root)
    seen = everything(spark, root)
    real, written = etl.stage_layer, []

    def failing(df, root, layer, name, *options):
        if layer == RAW and name == "factfinance":
            raise RuntimeError("driver lost")
        written.append((layer, name))
        return real(df, root, layer, name, *options)

    monkeypatch.setattr(etl, "stage_layer", failing)
    with pytest.raises(RuntimeError, match="driver lost"):
        etl.run(spark, before, root)
    assert everything(spark, root) == seen  # nothing of the failed run is visible
    assert [n for layer, n in written if layer == RAW] == ["dimaccounts", "dimproduct", "dimsalesterritory"]
    written.clear()
    monkeypatch.setattr(etl, "stage_layer", lambda df, root, layer, name, *o: (written.append((layer, name)), real(df, root, layer, name, *o))[1])
    summary = {(r.table_name, r.layer): r for r in etl.run(spark, star(frame), root).collect()}
    assert [n for layer, n in written if layer == RAW] == ["factfinance"]
    kept = sorted(n for (n, layer), r in summary.items() if layer == RAW and r.kept)
    assert kept == ["dimaccounts", "dimproduct", "dimsalesterritory", "dimscenario"]
    assert not summary["factfinance", RAW].kept and summary["dimproduct", RAW].n_rows == 3
    etl.run(spark, star(frame), clean)
    assert everything(spark, root) == everything(spark, clean)
    # With the same inputs nothing is written again; with another one, only what depends on it.
    written.clear()
    assert all(r.kept for r in etl.run(spark, star(frame), root).collect() if r.left_out is None)
    assert written == []
    changed = star(frame)
    changed["dimproduct"] = changed["dimproduct"].union(changed["dimproduct"].limit(1))
    etl.run(spark, changed, root)
    assert {n for _, n in written} == {"dimproduct", "key_violations"}
    assert len(folders_in(spark, f"{root}/{JOURNAL}")) == len({*map(str, folders_in(spark, f"{root}/{JOURNAL}"))})


def test_a_table_that_the_journal_does_not_know_is_worked_out_once(spark, frame, tmp_path, monkeypatch):
    root, passes = str(tmp_path), []
    real = etl.input_print
    monkeypatch.setattr(etl, "input_print", lambda df: (passes.append(1), real(df))[1])
    tables = Tables(dimscenario=star(frame)["dimscenario"], dimproduct=star(frame)["dimproduct"].where("ProductKey < 0"))
    first = etl.Run(spark, root)
    first.stage_raw(tables, False)
    assert passes == [] and not first.journal.kept  # written and fingerprinted in one pass
    again = etl.Run(spark, root)
    again.stage_raw(tables, False)
    assert len(passes) == 2 and again.journal.kept == {("dimscenario", RAW), ("dimproduct", RAW)}
    assert again.keys == first.keys and again.entries == first.entries


def test_a_step_whose_folder_is_gone_is_written_again(spark, frame, tmp_path):
    root = str(tmp_path)
    tables = Tables(dimscenario=star(frame)["dimscenario"])
    etl.run(spark, tables, root)
    folder = current(spark, root, RAW)["dimscenario"].folders[0]
    (tmp_path / RAW / folder / "_SUCCESS").unlink()
    rows = {(r.table_name, r.layer): r.kept for r in etl.run(spark, tables, root).collect()}
    assert not rows["dimscenario", RAW] and read_layer(spark, root, RAW, "dimscenario").count() == 2


def test_fingerprints_of_inputs(spark, frame, tmp_path):
    rows = [(1, "a", None), (1, None, "a"), (None, "x", "y"), (1, "a", None)]
    schema = "k long, s string, t string"
    assert input_print(frame(rows, schema)) == input_print(frame(rows[::-1], schema).repartition(3))
    others = [rows[:3], [*rows, rows[0]], [(1, None, "a"), *rows[1:]], [(1, "a", ""), *rows[1:]]]
    assert len({input_print(frame(r, schema)) for r in [rows, *others]}) == 5
    frame(rows, schema).write.parquet(f"{tmp_path}/t")
    files = spark.read.schema(schema).parquet(f"{tmp_path}/t")
    first = input_print(files)
    assert first == input_print(spark.read.schema(schema).parquet(f"{tmp_path}/t"))
    assert first != input_print(files.where("k = 1"))
    frame(rows[:1], schema).write.mode("append").parquet(f"{tmp_path}/t")
    assert first != input_print(spark.read.schema(schema).parquet(f"{tmp_path}/t"))


def test_row_prints_tell_nulls_and_not_zeros_apart(frame):
    df = frame([(1, None), (None, 1), (None, None)], "a long, b long")
    assert len({tuple(r) for r in df.select(*row_prints(df)).collect()}) == 3
    df = frame([(0.0, float("nan")), (-0.0, float("nan"))], "a double, `b.c` float")
    assert len({tuple(r) for r in df.select(*row_prints(df)).collect()}) == 1


# New rows


@pytest.mark.parametrize("seed", range(3))
def test_loading_new_rows_equals_a_full_load(spark, frame, tmp_path, seed):
    rng, root = random.Random(seed), str(tmp_path)
    row = lambda: (rng.choice([None, 1, 2, 3]), rng.choice([None, "", "x"]), rng.choice([None, 0.0, 1.5]))
    schema = "k long, `a.b` string, v double"
    rows: list = []
    for load in range(4):
        fresh = [row() for _ in range(rng.choice([0, 5, 40]))]
        before, rows = Counter(rows), rows + fresh
        n, added = increment.load_new_rows(frame(rows, schema).repartition(3), root, RAW, "T")
        assert n == len(fresh) and bag(added) == Counter(rows) - before
        assert bag(read_layer(spark, root, RAW, "t")) == Counter(rows)
        assert len(current(spark, root, RAW)["t"].folders) == load + 1


def test_rows_that_are_gone_stay_and_a_plain_table_can_be_added_to(spark, frame, tmp_path):
    root = str(tmp_path)
    write_layer(frame([(1,), (1,), (2,)], "k long"), root, RAW, "t")
    n, _ = increment.load_new_rows(frame([(1,), (3,), (3,)], "k long"), root, RAW, "t")
    assert n == 2 and bag(read_layer(spark, root, RAW, "t")) == Counter([(1,), (1,), (2,), (3,), (3,)])
    with pytest.raises(ValueError, match="columns"):
        increment.load_new_rows(frame([("1",)], "k string"), root, RAW, "t")


def test_stored_rows_are_not_read_or_written_again(spark, frame, tmp_path):
    root = str(tmp_path)
    increment.load_new_rows(spark.range(1000), root, RAW, "t")
    (first,) = current(spark, root, RAW)["t"].folders
    for file in (tmp_path / RAW / first).glob("*.parquet"):
        file.write_bytes(b"not read")
    n, added = increment.load_new_rows(spark.range(1010), root, RAW, "t")
    assert n == 10 and sorted(r.id for r in added.collect()) == list(range(1000, 1010))
    assert current(spark, root, RAW)["t"].folders[0] == first and current(spark, root, RAW)["t"].n_rows == 1010


def test_a_second_load_at_the_same_time_is_refused(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    increment.load_new_rows(spark.range(10), root, RAW, "t")
    real = increment.stage_new_rows
    monkeypatch.setattr(increment, "stage_new_rows", lambda *a: (real(*a), write_layer(spark.range(3), root, RAW, "t"))[0])
    with pytest.raises(Conflict):
        increment.load_new_rows(spark.range(20), root, RAW, "t")
    assert read_layer(spark, root, RAW, "t").count() == 3


def test_a_run_that_adds_new_rows(spark, frame, tmp_path):
    root, full = f"{tmp_path}/out", f"{tmp_path}/full"
    tables = star(frame)
    part = Tables(tables | {"dimproduct": tables["dimproduct"].limit(2)})
    etl.run(spark, part, root, new_rows_only=True)
    etl.run(spark, tables, root, new_rows_only=True)
    etl.run(spark, tables, full)
    assert everything(spark, root) == everything(spark, full)
    assert len(current(spark, root, RAW)["dimproduct"].folders) == 2


# The gate


def test_gate_splits_rows_by_the_state_of_their_key(spark, frame, tmp_path):
    root = str(tmp_path)
    rows = [(1, "a", "x"), (1, "a", "y"), (1, "b", "z"), (2, None, "n"), (None, None, "m"), (3, "c", "w"), (4, "d", "v"), (4, "d", "v")]
    df = frame(rows, "k long, `l.m` string, key_stat string")
    assert gate.write_gated(df, root, NORMALIZED, "t", ("k", "l.m"), "t_held") == (2, 6)
    table, held = read_layer(spark, root, NORMALIZED, "t"), read_layer(spark, root, NORMALIZED, "t_held")
    assert bag(table) == Counter([(1, "b", "z"), (3, "c", "w")]) and table.columns == df.columns
    assert bag(held.select("key_state", "key_stat")) == Counter([("repeated", "x"), ("repeated", "y"), ("null", "n"), ("null", "m"), ("repeated", "v"), ("repeated", "v")])
    assert bag(table) + bag(held.drop("key_state")) == Counter(rows)


@pytest.mark.parametrize("rows", [[], [(1,), (2,)], [(1,), (1,)], [(None,)]])
def test_gate_with_one_state_only(spark, frame, tmp_path, rows):
    good, bad = gate.write_gated(frame(rows, "k long"), str(tmp_path), NORMALIZED, "t", ("k",), "held")
    assert read_layer(spark, str(tmp_path), NORMALIZED, "t").count() == good
    assert read_layer(spark, str(tmp_path), NORMALIZED, "held").count() == bad and good + bad == len(rows)


def test_gated_run(spark, frame, tmp_path):
    root, plain = f"{tmp_path}/out", f"{tmp_path}/plain"
    tables = star(frame)
    rows = {(r.table_name, r.layer): r.n_rows for r in etl.run(spark, tables, root, gate=True).collect()}
    etl.run(spark, tables, plain)
    assert rows["dimproduct", NORMALIZED] == 1 and rows["dimproduct_quarantine", NORMALIZED] == 2
    assert rows["factfinance", NORMALIZED] == 0 and rows["factfinance_quarantine", NORMALIZED] == 3
    for name in ("dimproduct", "dimaccounts"):
        both = bag(read_layer(spark, root, NORMALIZED, name)) + bag(read_layer(spark, root, NORMALIZED, f"{name}_quarantine").drop("key_state"))
        assert both == bag(read_layer(spark, plain, NORMALIZED, name))
    assert bag(read_layer(spark, root, ERRORS, "key_violations")) == bag(read_layer(spark, plain, ERRORS, "key_violations"))
    assert all(r.kept for r in etl.run(spark, star(frame), root, gate=True).collect() if r.left_out is None)
    etl.run(spark, tables, root)
    assert "dimproduct_quarantine" not in current(spark, root, NORMALIZED)
