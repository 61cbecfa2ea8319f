"""Change capture over histories in parts: the three jobs, one manifest a run.

The same rules as ``pipeline.run_cdc``; what differs is the storage.  A batch is
compared with the parts that it falls in, only parts with changes are written
again, and the histories and the run's log appear together.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costindex.functions import ntz
from costindex.operators.cdc import change_events, keyed_changes, merge_history
from costindex.operators.scd2 import DIM_SCHEMA, scd2_apply
from costindex.plans import capture
from costindex.session import stage_table
from costindex.sources.ledger import Layout, Ledger, Prepared
from costindex.sources.meta import CHANGE_LOG, RunBook
from costindex.sources.tables import Audit, AuditFailed

LOG = "change_log"


@dataclass(frozen=True)
class Keyed:
    """A history with one value per key."""
    table: str
    keys: Sequence[str]
    value: str
    schema: T.StructType
    layout: Layout
    tolerance: float
    audit: Audit
    stamp: str = "loaded_at"


def fuel_history(schema: T.StructType, audit: Audit) -> Keyed:
    """Weekly levels: a part per month."""
    return Keyed("fuel_price_history", capture.FUEL_KEYS, "price", schema,
                 Layout("date_format(date_effective, 'yyyy-MM')"), capture.FUEL_TOLERANCE, audit)


def gdp_history(schema: T.StructType, audit: Audit) -> Keyed:
    """Quarters are revised years later, but a year at a time."""
    return Keyed("gdp_quarterly", capture.GDP_KEYS, "value", schema,
                 Layout("substring(quarter, 1, 4)"), capture.GDP_TOLERANCE, audit)


#: The income dimension: all versions of a geography are in one of these parts.
INCOME_LAYOUT = Layout(by=["geography"], spread=64)


def merge_keyed(ledger: Ledger, history: Keyed, batch: DataFrame, stamp: Column,
                order: Sequence[str] = ()) -> tuple[Prepared | None, DataFrame]:
    """Compare a batch with its parts and write those with changes again.

    Returns what to publish (None without changes) and the changes.  A key of the
    history that the batch lacks stays as it is.  The batch's keys take the history's
    types first, as a hash part depends on the type.
    """
    batch = batch.withColumns({k: F.col(k).cast(history.schema[k].dataType) for k in history.keys})
    before = ledger.read(history.table, history.schema, ledger.parts_of(batch, history.layout))
    changes = stage_table(keyed_changes(batch, before, history.keys, history.value, history.tolerance, order), "part-changes")
    parts = ledger.parts_of(changes, history.layout)
    if not parts:
        return None, changes
    return ledger.prepare(history.table, parts, history.layout, history.schema, lambda old: merge_history(
        old, changes, history.keys, history.value, history.stamp, stamp), history.audit), changes


def merge_dimension(ledger: Ledger, table: str, survey: DataFrame, run_date: Column, layout: Layout,
                    audit: Audit, order: Sequence[str] = ()) -> tuple[Prepared | None, DataFrame]:
    """Apply a survey to a dimension in parts by geography; returns what to publish and the changes."""
    after, changes = scd2_apply(survey, ledger.read(table, DIM_SCHEMA), run_date, capture.INCOME_TOLERANCE,
                                keep=lambda name, df: stage_table(df, name), order_by=order)
    parts = ledger.parts_of(changes, layout)
    if not parts:
        return None, changes
    return ledger.prepare(table, parts, layout, DIM_SCHEMA, lambda old: ledger.only(after, layout, parts), audit), changes


def run_cdc_in_parts(book: RunBook, ledger: Ledger, at: datetime) -> DataFrame | None:
    """Compare the raw tables with the histories of the ledger; publish their new parts and the run's log at once.

    A history whose audit fails is logged as a failed run and left out with its
    events.  A crash before the manifest leaves everything as it was; a run repeated
    with the same ``at`` after the manifest finds no changes and keeps its log.
    """
    from costindex.plans.pipeline import AUDITS, FUEL_HISTORY, GDP_HISTORY
    wh, stamp = book.wh, ntz(at)
    fuel = fuel_history(FUEL_HISTORY, AUDITS["fuel_price_history"])
    gdp = gdp_history(GDP_HISTORY, AUDITS["gdp_quarterly"])
    order = capture.FILE_ORDER

    def raw(name):
        return capture.in_file_order(wh.read("raw", name))

    def run_fuel():
        batch = capture.fuel_levels(raw("fuel_prices"), carry=order).select(
            F.to_date("date").alias("date_effective"), "fuel_type", "price", *order)
        ready, changes = merge_keyed(ledger, fuel, batch, stamp, order)
        return ready, change_events(changes, "fuel_prices", F.concat(
            F.col("fuel_type"), F.lit("@"), F.col("date_effective").cast("string")), "price")

    def run_gdp():
        ready, changes = merge_keyed(ledger, gdp, capture.gdp_rows(raw("gdp_quarterly"), order), stamp, order)
        return ready, change_events(changes, "gdp_quarterly", F.concat(F.col("series"), F.lit("@"), F.col("quarter")), "value")

    def run_income():
        ready, changes = merge_dimension(ledger, "dim_household_income", raw("household_income"), F.lit(at.date()),
                                         INCOME_LAYOUT, AUDITS["dim_household_income"], order)
        return ready, change_events(changes, "household_income", F.col("geography"), "income_median")

    jobs: dict[str, tuple[str, Callable]] = {"fuel_prices": ("fuel_price_history", run_fuel),
                                             "gdp_quarterly": ("gdp_quarterly", run_gdp),
                                             "household_income": ("dim_household_income", run_income)}
    present = [name for name in jobs if wh.has_table("raw", name)]
    if not present:
        return None
    ready: list[Prepared] = []
    events: list[DataFrame] = []
    for name in present:
        table, job = jobs[name]
        try:
            prepared, changed = job()
        except AuditFailed as e:    # the parts before stay current; the other histories go on
            book.log_run(table, at, "failed", error=str(e))
            print(f"[{table}] {e}", file=sys.stderr)
            continue
        if prepared is not None:
            ready.append(prepared)
            events.append(changed)
    if ready:
        log = capture.with_detected_at(reduce(DataFrame.unionByName, events), stamp)
        ready.append(ledger.prepare_run(LOG, at.strftime("%Y%m%dT%H%M%S%f"), log, CHANGE_LOG))
        ledger.publish(ready)
    return changes(ledger).where(F.col("detected_at") == stamp)


def changes(ledger: Ledger) -> DataFrame:
    """The change log of all runs."""
    return ledger.read(LOG, CHANGE_LOG)
