"""The whole run: stage raw tables, log errors, normalize, answer the questions.

Everything is written to fresh folders and becomes visible at the end, layer by layer, each in one step. A run that was
ended before goes on where it stopped: what it has finished of the same inputs is kept (see `journal`).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession

from tallyward.operators.gate import stage_gated
from tallyward.operators.increment import stage_new_rows
from tallyward.operators.rules import common_log
from tallyward.plans import charts, questions
from tallyward.plans.cleansing import all_key_violations, normalize, table_errors
from tallyward.plans.specs import spec_of
from tallyward.sources.journal import Journal, file_print, input_print
from tallyward.sources.layers import ERRORS, NORMALIZED, RAW, stage_by_year, stage_layer, write_layer
from tallyward.sources.manifest import Stored, commit, current, remove_orphans, rows_of
from tallyward.sources.reports import REPORTS, stage_report, staged_report
from tallyward.sources.tables import LackingTable, Tables

VIOLATIONS, QUARANTINE = "key_violations", "_quarantine"
SUMMARY = "table_name string, layer string, n_rows bigint, left_out string, kept boolean"
LAYERS = (RAW, ERRORS, NORMALIZED, REPORTS)


def stage(tables: Mapping[str, DataFrame], root: str) -> list[tuple[str, str, int]]:
    """Store every table untouched, each visible at once."""
    return [(name, RAW, write_layer(df, root, RAW, name)) for name, df in tables.items()]


class Run:
    """The steps of one run, and what they have left: entries and step keys by layer and table."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root, self.journal = spark, root, Journal(spark, root)
        self.entries: dict[str, dict[str, Stored]] = {layer: {} for layer in LAYERS}
        self.keys: dict[tuple[str, str], str] = {}

    def step(self, layer: str, name: str, inputs: tuple, write) -> Stored:
        entry, self.keys[layer, name] = self.journal.step(layer, name, inputs, write)
        self.entries[layer][name] = entry
        return entry

    def rows(self, layer: str, name: str) -> DataFrame:
        return rows_of(self.spark, self.root, layer, self.entries[layer][name])

    def stage_raw(self, tables: Mapping[str, DataFrame], new_rows_only: bool) -> None:
        """Every table untouched; with `new_rows_only`, what is stored stays and rows beyond it are added."""
        before = current(self.spark, self.root, RAW) if new_rows_only else {}
        begun = self.journal.tables()
        for name, df in tables.items():
            if new_rows_only:
                base = before.get(name.lower())
                inputs = (input_print(df), "new rows", base and base.folders)
                self.step(RAW, name, inputs, lambda df=df, name=name, base=base: stage_new_rows(df, self.root, RAW, name, base))
                continue
            write = lambda df, name=name: stage_layer(df, self.root, RAW, name)
            if (RAW, name.lower()) in begun or file_print(df):
                self.step(RAW, name, (input_print(df),), lambda df=df, write=write: write(df))
            else:  # nothing to go on from: one pass writes the rows and takes their fingerprint
                self.entries[RAW][name], self.keys[RAW, name] = self.journal.first_step(RAW, name, df, write)

    def cleanse(self, names: list[str], gate: bool) -> Tables:
        """Error log and normalized table of each staged table; returns the normalized tables.

        With `gate`, a table with a key holds only rows whose key is there once, and the others are in its quarantine.
        """
        normalized = Tables()
        for name in names:
            spec, above = spec_of(name), self.keys[RAW, name]
            raw = self.rows(RAW, name)
            log = common_log(table_errors(raw, spec), name, spec.row_key)
            self.step(ERRORS, name, (above,), lambda log=log, name=name: stage_layer(log, self.root, ERRORS, name, ["error_type"]))
            clean = normalize(raw, spec)
            if gate and spec.key:
                pair: dict[str, Stored] = {}

                def gated(part: str, clean=clean, spec=spec, name=name, pair=pair) -> Stored:
                    if not pair:
                        pair["table"], pair["quarantine"] = stage_gated(clean, self.root, NORMALIZED, name, spec.key)
                    return pair[part]

                self.step(NORMALIZED, name, (above, "gate"), lambda gated=gated: gated("table"))
                self.step(NORMALIZED, name + QUARANTINE, (above, "gate"), lambda gated=gated: gated("quarantine"))
            elif spec.stored_by:
                write = lambda clean=clean, spec=spec, name=name: stage_by_year(clean, self.root, NORMALIZED, name, spec.stored_by)
                self.step(NORMALIZED, name, (above,), write)
            else:
                self.step(NORMALIZED, name, (above,), lambda clean=clean, name=name: stage_layer(clean, self.root, NORMALIZED, name))
            normalized[name] = self.rows(NORMALIZED, name)
        return normalized

    def list_violations(self, keys: Mapping[str, tuple[str, ...]], gate: bool) -> None:
        """Keys that are repeated or null in normalized tables; behind a gate these are the ones in quarantine."""
        names = [n for n, key in keys.items() if key]
        if not names:
            return
        held = {n: n + QUARANTINE if gate else n for n in names}
        found = all_key_violations({n: self.rows(NORMALIZED, h) for n, h in held.items()}, {n: keys[n] for n in names})
        inputs = tuple(self.keys[NORMALIZED, h] for h in held.values())
        self.step(ERRORS, VIOLATIONS, inputs, lambda: stage_layer(found, self.root, ERRORS, VIOLATIONS))

    def publish(self) -> None:
        """Make what the run has left visible, in place of all that was there, and forget what came before."""
        for layer in LAYERS:
            commit(self.spark, self.root, layer, self.entries[layer], whole=True)
        self.journal.forget_others()
        for layer in LAYERS:
            remove_orphans(self.spark, self.root, layer)


# What the questions ask for.
SALES_YEAR, FINANCE_YEAR, PRODUCT_NAME = 2012, 2011, "Sport-100 Helmet, Red"


def answer(
    run: Run,
    tables: Tables,
    sales_year: int = SALES_YEAR,
    finance_year: int = FINANCE_YEAR,
    product_name: str = PRODUCT_NAME,
    as_of: Column | None = None,
) -> dict[str, str]:
    """Write the reports of the five questions and their charts' frames.

    Returns for each one left out which table it lacks.
    """
    reports = Tables()
    plans = {
        "qa1": lambda: questions.top_transaction_per_month(
            tables["factresellersales"], questions.products_named(tables["dimproduct"], product_name), sales_year
        ),
        "qa2": lambda: questions.lowest_revenue_per_month(
            tables["factresellersales"], tables["dimproduct"], tables["dimsalesterritory"], sales_year
        ),
        "qa3": lambda: questions.avg_amount_by_scenario(
            tables["factfinance"], tables["dimaccounts"], tables["dimscenario"], finance_year
        ),
        "qa4": lambda: questions.product_month_sales(tables["factresellersales"], tables["dimproduct"], sales_year),
        "qa5": lambda: questions.age_bands(tables["dimcustomer"], as_of),
        "chart_frames": lambda: charts.chart_frames(reports["qa1"], reports["qa2"]),
        "product_month_matrix": lambda: charts.product_month_matrix(reports["qa4"]),
        "age_bands_rollup": lambda: charts.age_bands_rollup(reports["qa5"]),
    }
    today = dt.date.today() if as_of is None else as_of
    inputs = (sales_year, finance_year, product_name, today, *[key for (layer, _), key in sorted(run.keys.items()) if layer == NORMALIZED])
    left_out = {}
    for name, plan in plans.items():
        try:
            df = plan()
        except LackingTable as lacking:
            left_out[name] = lacking.args[0]
            continue
        entry = run.step(REPORTS, name, inputs, lambda df=df, name=name: stage_report(df, run.root, name))
        reports[name] = staged_report(run.spark, run.root, entry)
    return left_out


def run(spark: SparkSession, tables: Tables, root: str, new_rows_only: bool = False, gate: bool = False, **question_options) -> DataFrame:
    """Run everything; returns one row per stored table with its rows, and per report or table left out with the reason.

    `kept` says which tables are from an earlier run that had the same inputs. With `new_rows_only`, raw tables keep what
    they hold and get the rows that the given tables have beyond it. With `gate`, rows whose key is null or repeated go
    to a quarantine instead of the normalized table.

    Tables without checks are refused before anything is written. What earlier runs stored of other tables,
    and their reports, is removed when the new ones become visible.
    """
    keys = {n: spec_of(n).key for n in tables}
    steps = Run(spark, root)
    steps.stage_raw(tables, new_rows_only)
    normalized = steps.cleanse(list(tables), gate)
    steps.list_violations(keys, gate)
    left_out = answer(steps, normalized, **question_options)
    steps.publish()
    kept = steps.journal.kept
    summary = [(name, layer, None if layer == REPORTS else entry.n_rows, None, (name, layer) in kept) for layer in LAYERS for name, entry in steps.entries[layer].items()]
    summary += [(name, RAW, None, f"not found at {path}", False) for name, path in getattr(tables, "absent", {}).items()]
    summary += [(name, REPORTS, None, reason, False) for name, reason in left_out.items()]
    return spark.createDataFrame(summary, SUMMARY)
