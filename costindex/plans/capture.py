"""The three change-capture jobs: value CDC (fuel), append + revision CDC (GDP), SCD2 (income)."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costindex.functions import number_or_null

from costindex.operators.cdc import change_events, date_key, keyed_changes, merge_history
from costindex.operators.reshape import melt_levels
from costindex.operators.scd2 import scd2_apply

# Tolerances of the three change rules.
FUEL_TOLERANCE = 0.001
GDP_TOLERANCE = 0.01
INCOME_TOLERANCE = 1.0

FUEL_KEYS = ["date_effective", "fuel_type"]
GDP_KEYS = ["quarter", "series"]


Keep = Callable[[str, DataFrame], DataFrame]


def _lazy(name: str, df: DataFrame) -> DataFrame:
    return df


@dataclass
class Capture:
    changes: DataFrame   # keys, old_value, new_value, change_type, _seq
    events: DataFrame    # source_name, entity_key, field_name, old_value, new_value, change_type
    table: DataFrame     # the history / dimension after this run


# Place of a row in the source files: what orders the rows of a key within one batch.
FILE_ORDER = ["_file", "_row"]


def in_file_order(scan: DataFrame) -> DataFrame:
    """A Parquet scan with ``FILE_ORDER`` added from its metadata."""
    return scan.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))


def fuel_levels(raw_fuel: DataFrame, series_col: str = "series_type", level: str = "level",
                carry: Sequence[str] = ()) -> DataFrame:
    """Wide weekly fuel table -> (date, fuel_type, price) price levels, positive only."""
    df = raw_fuel.where(F.col(series_col) == level) if series_col in raw_fuel.columns else raw_fuel
    long = melt_levels(df, "date", [series_col, "_month_partition"], "fuel_type", "price", carry)
    return long.where(F.col("price") > 0).select(
        date_key("date", 10).alias("date"), F.upper("fuel_type").alias("fuel_type"), "price", *carry)


def capture_fuel(raw_fuel: DataFrame, history: DataFrame, run_ts: Column,
                 keep: Keep = _lazy, order: Sequence[str] = ()) -> Capture:
    """``keep(name, df)`` may persist the change set and the new history (cuts lineage).

    ``order`` names the columns that order the rows of a key; without them the
    keys must be unique.
    """
    batch = fuel_levels(raw_fuel, carry=order).select(
        F.to_date("date").alias("date_effective"), "fuel_type", "price", *order)
    changes = keep("fuel_changes", keyed_changes(batch, history, FUEL_KEYS, "price",
                                                 FUEL_TOLERANCE, order))
    events = change_events(
        changes, "fuel_prices",
        F.concat(F.col("fuel_type"), F.lit("@"), F.col("date_effective").cast("string")), "price")
    table = keep("fuel_price_history",
                 merge_history(history, changes, FUEL_KEYS, "price", "loaded_at", run_ts))
    return Capture(changes, events, table)


def gdp_rows(raw_gdp: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Long GDP rows keyed by (quarter = first 7 characters of the date, series)."""
    cols = {c.lower(): c for c in raw_gdp.columns}
    if "series" not in cols or "value" not in cols:
        raise ValueError(f"unexpected GDP columns: {raw_gdp.columns}")
    return raw_gdp.select(
        date_key(F.col(cols["date"]), 7).alias("quarter"),
        F.col(cols["series"]).alias("series"),
        number_or_null(F.col(cols["value"])).alias("value"),
        *carry,
    ).where(F.col("value").isNotNull())


def capture_gdp(raw_gdp: DataFrame, history: DataFrame, run_ts: Column,
                keep: Keep = _lazy, order: Sequence[str] = ()) -> Capture:
    """``order`` as in ``capture_fuel``."""
    changes = keep("gdp_changes", keyed_changes(gdp_rows(raw_gdp, order), history, GDP_KEYS, "value",
                                                GDP_TOLERANCE, order))
    events = change_events(
        changes, "gdp_quarterly",
        F.concat(F.col("series"), F.lit("@"), F.col("quarter")), "value")
    table = keep("gdp_quarterly",
                 merge_history(history, changes, GDP_KEYS, "value", "loaded_at", run_ts))
    return Capture(changes, events, table)


def capture_income(raw_income: DataFrame, dim: DataFrame, run_date: Column,
                   keep: Keep = _lazy, order: Sequence[str] = ()) -> Capture:
    """``order`` names the columns that order a geography's rows of one year; without them they go by value."""
    table, changes = scd2_apply(raw_income, dim, run_date, INCOME_TOLERANCE,
                                keep=None if keep is _lazy else keep, order_by=order)
    changes = keep("income_changes", changes)
    table = keep("dim_household_income", table)
    events = change_events(changes, "household_income", F.col("geography"), "income_median")
    return Capture(changes, events, table)


def with_detected_at(events: DataFrame, detected_at: Column) -> DataFrame:
    return events.select(detected_at.alias("detected_at"), *events.columns)
