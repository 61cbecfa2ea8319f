"""The full run: restore state, load sources, capture changes, export state, build marts, test.

Stages hand over through tables in one warehouse (raw, warehouse, meta,
marts), never through the driver.  Staging stays lazy; marts are written.
"""

from __future__ import annotations

import sys
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costindex.functions import ntz
from pyspark.sql import types as T

from costindex.operators import quality
from costindex.operators.scd2 import DIM_SCHEMA
from costindex.plans import capture, marts, signals, staging
from costindex.plans.history import run_cdc_in_parts
from costindex.sources import loader, state
from costindex.sources.ledger import Ledger
from costindex.sources.meta import RunBook
from costindex.sources.registry import Source
from costindex.sources.tables import Audit, AuditFailed, Warehouse

FUEL_HISTORY = T.StructType([
    T.StructField("date_effective", T.DateType()),
    T.StructField("fuel_type", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("loaded_at", T.TimestampNTZType()),
])
GDP_HISTORY = T.StructType([
    T.StructField("quarter", T.StringType()),
    T.StructField("series", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("loaded_at", T.TimestampNTZType()),
])


@dataclass
class PipelineConfig:
    services: Sequence[str]
    food_categories: Sequence[str] = tuple(signals.FOOD_CATEGORIES)
    weights: Mapping[str, float] = field(default_factory=lambda: dict(marts.DEFAULT_WEIGHTS))
    state_dir: str | None = None
    ledger_dir: str | None = None    # keep histories and change log there, in parts, instead of whole versions


def _table_or_empty(wh: Warehouse, layer: str, name: str, schema: T.StructType) -> DataFrame:
    if wh.has_table(layer, name):
        return wh.read(layer, name)
    return wh.spark.createDataFrame([], schema)


#: What a history must satisfy before its new version becomes the current one.
AUDITS = {
    "fuel_price_history": Audit(capture.FUEL_KEYS, ["date_effective", "fuel_type", "price", "loaded_at"]),
    "gdp_quarterly": Audit(capture.GDP_KEYS, ["quarter", "series", "loaded_at"]),
    "dim_household_income": Audit(["geography", "version"],
                                  ["geography", "geography_type", "survey_year", "valid_from", "is_current"]),
}
HISTORIES = tuple(AUDITS)


def run_cdc(book: RunBook, at: datetime) -> DataFrame:
    """Compare the raw tables with the stored histories; write the change log, then the histories.

    New versions are written and audited first.  One that fails is logged as a
    failed run; it and its events are left out, so the next run finds the same
    changes again.  The events of a run replace themselves when the run is
    repeated with the same ``at``, and no history moves before they are written:
    a crash between the steps loses no event, and the retry doubles none.
    """
    wh = book.wh
    stamp = ntz(at)
    tables = {}

    def keep(name, df):
        if name in HISTORIES:
            tables[name] = df       # written below
            return df
        return wh.write_snapshot("warehouse", name, df)

    def in_order(name):
        return capture.in_file_order(wh.read("raw", name))

    events = {}
    if wh.has_table("raw", "fuel_prices"):
        prev = _table_or_empty(wh, "warehouse", "fuel_price_history", FUEL_HISTORY)
        events["fuel_price_history"] = capture.capture_fuel(
            in_order("fuel_prices"), prev, stamp, keep, capture.FILE_ORDER).events
    if wh.has_table("raw", "gdp_quarterly"):
        prev = _table_or_empty(wh, "warehouse", "gdp_quarterly", GDP_HISTORY)
        events["gdp_quarterly"] = capture.capture_gdp(
            in_order("gdp_quarterly"), prev, stamp, keep, capture.FILE_ORDER).events
    if wh.has_table("raw", "household_income"):
        prev = _table_or_empty(wh, "warehouse", "dim_household_income", DIM_SCHEMA)
        events["dim_household_income"] = capture.capture_income(
            in_order("household_income"), prev, F.lit(at.date()), keep, capture.FILE_ORDER).events
    if not events:
        return None
    ready = {}
    for name, df in tables.items():
        try:
            ready[name] = wh.prepare("warehouse", name, df, AUDITS[name])
        except AuditFailed as e:    # the version before stays current; the other histories go on
            book.log_run(name, at, "failed", error=str(e))
            print(f"[{name}] {e}", file=sys.stderr)
    logged = [events[name] for name in events if name in ready]
    if logged:
        book.append_changes(capture.with_detected_at(reduce(DataFrame.unionByName, logged), stamp))
    for target in ready.values():
        wh.publish(target)
    return book.changes().where(F.col("detected_at") == stamp)


def _fuel_history(wh: Warehouse, cfg: PipelineConfig) -> DataFrame:
    if cfg.ledger_dir:
        return Ledger(wh, cfg.ledger_dir).read("fuel_price_history", FUEL_HISTORY)
    return wh.read("warehouse", "fuel_price_history")


def build_marts(wh: Warehouse, cfg: PipelineConfig) -> dict[str, DataFrame]:
    """Staging views over the raw and history tables; marts written as tables."""
    stg_prices = staging.stg_prices(wh.read_partitioned("raw", "pricecatcher_prices"),
                                    wh.read("raw", "pricecatcher_items"),
                                    wh.read("raw", "pricecatcher_premises"))
    # each mart is written in its read order over all files, after its keys passed: row-group
    # statistics let month and fuel filters skip data
    price_summary = wh.write_ordered("marts", "mart_price_summary", marts.price_summary(stg_prices),
                                     marts.PRICE_SUMMARY_KEYS, audit=Audit(marts.PRICE_SUMMARY_KEYS, ["month"]))
    fuel = wh.write_ordered("marts", "mart_fuel_timeline", marts.fuel_timeline(
        staging.stg_fuel(_fuel_history(wh, cfg))), ["fuel_type", "fuel_date"])
    score = wh.write_ordered("marts", "mart_pressure_score", marts.pressure_score(
        price_summary, fuel, staging.stg_cpi(wh.read("raw", "cpi_state")),
        staging.stg_transport(wh.read("raw", "transport_ridership"), cfg.services),
        staging.stg_vehicles(wh.read("raw", "vehicle_registrations")),
        cfg.food_categories, cfg.weights,
        keep=lambda name, df: wh.write_snapshot("marts", name, df)), ["month"], audit=Audit(["month"], ["month"]))
    return {"stg_prices": stg_prices, "mart_price_summary": price_summary,
            "mart_fuel_timeline": fuel, "mart_pressure_score": score}


def run_tests(built: Mapping[str, DataFrame]) -> DataFrame:
    fuel, prices, score = (built["mart_fuel_timeline"], built["stg_prices"],
                           built["mart_pressure_score"])
    return (quality.summary("fuel_change_direction", fuel, quality.not_accepted(
                "change_direction", ["UP", "DOWN", "UNCHANGED", "FIRST"]))
            .unionByName(quality.summary("prices_positive", prices,
                                         quality.not_positive("price")))
            .unionByName(quality.summary("pulse_score_range", score,
                                         quality.out_of_range("pulse_score", 0, 100))))


def run_pipeline(wh: Warehouse, sources: Mapping[str, Source], at: datetime,
                 cfg: PipelineConfig, restore: bool = True, extract: bool = True,
                 cdc: bool = True, models: bool = True, tests: bool = True) -> dict:
    """Run the selected stages in order; returns the frames each stage produced.

    With ``cfg.ledger_dir`` the histories and the change log live in that ledger,
    which outlasts the warehouse and so needs no export; the state folder then
    carries the run log alone.
    """
    book = RunBook(wh)
    out: dict = {}
    if restore and cfg.state_dir and extract and cdc and models:
        out["restored"] = state.import_state(wh, cfg.state_dir)
    if extract:
        out["loads"] = loader.run_all(book, dict(sources), at)
    if cdc:
        out["changes"] = run_cdc_in_parts(book, Ledger(wh, cfg.ledger_dir), at) if cfg.ledger_dir else run_cdc(book, at)
        if cfg.state_dir:
            out["exported"] = state.export_state(wh, cfg.state_dir)
    if models:
        out.update(build_marts(wh, cfg))
        if tests:
            # stored: a later read of several runs' results does not join each run's prices again, all at once
            out["tests"] = wh.write_snapshot("meta", "test_results", run_tests(out))
    return out
