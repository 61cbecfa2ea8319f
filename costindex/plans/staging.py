"""Staging views (lazy DataFrames): typed, trimmed, filtered source rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costindex.functions import (collapse_whitespace, month_text, to_int_half_even,
                                 year_text)
from costindex.operators.joins import DEFAULT_BROADCAST_BYTES, star_join
from costindex.operators.reshape import unpivot_non_null


def _clean(c: str, all_runs: bool = False):
    return F.trim(collapse_whitespace(F.col(c), all_runs))


def stg_cpi(raw_cpi: DataFrame) -> DataFrame:
    return raw_cpi.where(F.col("date").isNotNull() & F.col("index").isNotNull()).select(
        F.to_date("date").alias("cpi_date"),
        month_text("date").alias("month"),
        F.trim("state").alias("state"),
        F.trim("division").alias("division"),
        F.col("index").cast("double").alias("cpi_value"),
    )


def stg_fuel(fuel_history: DataFrame) -> DataFrame:
    return fuel_history.where(F.col("price").isNotNull() & (F.col("price") > 0)).select(
        F.col("date_effective").alias("fuel_date"),
        month_text("date_effective").alias("month"),
        year_text("date_effective").alias("year"),
        F.upper(F.trim("fuel_type")).alias("fuel_type"),
        F.col("price"),
    )


def stg_gdp(gdp_history: DataFrame) -> DataFrame:
    return gdp_history.where(F.col("value").isNotNull()).select(
        F.col("quarter"),
        F.trim("series").alias("series_type"),
        F.col("value").alias("gdp_value"),
        F.col("loaded_at"),
    )


def stg_vehicles(raw_vehicles: DataFrame) -> DataFrame:
    r = F.col("registrations")
    return raw_vehicles.where(r.isNotNull() & (r > 0)).select(
        F.to_date("date").alias("reg_date"),
        month_text("date").alias("month"),
        F.trim("type").alias("vehicle_type"),
        F.trim("fuel").alias("fuel_type"),
        r.cast("int").alias("registrations"),
    )


def stg_transport(raw_ridership: DataFrame, services: Sequence[str]) -> DataFrame:
    long = unpivot_non_null(raw_ridership, ["date"], services, "service", "ridership")
    r = F.col("ridership")
    return long.where(r > 0).select(
        F.to_date("date").alias("ride_date"),
        month_text("date").alias("month"),
        F.col("service"),
        to_int_half_even(r).alias("ridership"),
    )


def stg_prices(raw_prices: DataFrame, raw_items: DataFrame, raw_premises: DataFrame,
               collapse_all_runs: bool = False,
               max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Price facts joined to item and premise dimensions, text cleaned.

    A left join followed by ``dim key is not null`` is an inner join, so it is
    written as one.  Dimensions are filtered and pruned before the join and
    broadcast when their checked size allows; the fact is never shuffled for them.
    """
    items = raw_items.where(F.col("item_code").isNotNull() & F.col("item").isNotNull()).select(
        F.col("item_code").alias("_i_code"),
        _clean("item", collapse_all_runs).alias("item_name"),
        _clean("unit", collapse_all_runs).alias("unit"),
        _clean("item_group", collapse_all_runs).alias("item_group"),
        _clean("item_category", collapse_all_runs).alias("item_category"),
    )
    premises = raw_premises.where(
        F.col("premise_code").isNotNull() & F.col("state").isNotNull()).select(
        F.col("premise_code").alias("_p_code"),
        _clean("premise", collapse_all_runs).alias("premise_name"),
        _clean("premise_type", collapse_all_runs).alias("premise_type"),
        _clean("state", collapse_all_runs).alias("state"),
        _clean("district", collapse_all_runs).alias("district"),
    )
    fact = raw_prices.select(
        F.to_date("date").alias("price_date"),
        F.col("_month_partition").alias("month"),
        F.col("item_code").cast("int").alias("item_code"),
        F.col("premise_code").cast("int").alias("premise_code"),
        F.col("price").cast("double").alias("price"),
    ).where(F.col("price") > 0)
    j = star_join(fact, [(items, "item_code", "_i_code"), (premises, "premise_code", "_p_code")],
                  max_broadcast_bytes)
    return j.select("price_date", "month", "item_code", "item_name", "unit", "item_group",
                    "item_category", "premise_code", "premise_name", "premise_type", "state",
                    "district", "price")
