"""Marts: monthly price summary, fuel timeline, composite pressure score."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costindex.functions import round_half_away
from costindex.operators.aggregates import group_profile
from costindex.operators.joins import keyed_outer_chain
from costindex.operators.windows import (minmax_scale, pct_change, with_previous,
                                        with_previous_bucketed)
from costindex.plans import signals

PRICE_SUMMARY_KEYS = ["month", "state", "item_category"]


def price_summary(stg_prices: DataFrame) -> DataFrame:
    """Month x state x category price statistics plus month-over-month change of the median."""
    prof = group_profile(
        stg_prices, PRICE_SUMMARY_KEYS, "price",
        quantiles={"_p25": 0.25, "_p50": 0.5, "_p75": 0.75},
        distinct={"premise_count": "premise_code", "item_count": "item_code"},
        count_name="sample_count", mean_name="_avg", min_name="_min", max_name="_max",
        stddev_name="_sd")
    stats = prof.select(
        *PRICE_SUMMARY_KEYS, "sample_count",
        round_half_away("_avg", 2).alias("avg_price"),
        round_half_away("_p50", 2).alias("median_price"),
        round_half_away("_p25", 2).alias("p25_price"),
        round_half_away("_p75", 2).alias("p75_price"),
        round_half_away("_min", 2).alias("min_price"),
        round_half_away("_max", 2).alias("max_price"),
        round_half_away("_sd", 2).alias("price_stddev"),
        "premise_count", "item_count")
    # one row per group and month: the window input is the aggregate, not the facts
    stats = with_previous(stats, ["state", "item_category"], "month", "median_price",
                          "prev_median_price")
    return stats.withColumn("mom_pct_change", pct_change("median_price", "prev_median_price", 2))


def fuel_timeline(stg_fuel: DataFrame) -> DataFrame:
    """Each fuel price with the previous one, the change, its direction and percent."""
    # bucketed by month: a fuel type with a very long history is not ranked in one task
    f = with_previous_bucketed(stg_fuel, ["fuel_type"], "fuel_date", "price", "prev_price",
                               F.col("month"))
    price, prev = F.col("price"), F.col("prev_price")
    return f.select(
        "fuel_date", "month", "year", "fuel_type", "price", "prev_price",
        round_half_away(price - F.coalesce(prev, price), 3).alias("price_change"),
        F.when(prev.isNull(), F.lit("FIRST"))
         .when(price > prev, F.lit("UP"))
         .when(price < prev, F.lit("DOWN"))
         .otherwise(F.lit("UNCHANGED")).alias("change_direction"),
        pct_change("price", "prev_price", 3).alias("change_pct"),
    )


# Component weights of the composite score (they sum to 1.0),
# in the order food, cpi, fuel, transport, ev.
DEFAULT_WEIGHTS = {
    "food_norm": 0.35,
    "cpi_norm": 0.30,
    "fuel_norm": 0.15,
    "transport_pressure_norm": 0.10,
    "ev_pressure_norm": 0.10,
}
# Band edges on the unrounded 0..1 composite and their labels.
BANDS = [(0.33, "Low Pressure"), (0.66, "Moderate Pressure")]
TOP_BAND = "High Pressure"
NEUTRAL = 0.5


def combined_signals(price_summary_df: DataFrame, fuel_timeline_df: DataFrame,
                     stg_cpi_df: DataFrame, stg_transport_df: DataFrame,
                     stg_vehicles_df: DataFrame,
                     food_categories: Sequence[str] = signals.FOOD_CATEGORIES,
                     fuel_type: str = signals.HEADLINE_FUEL,
                     ev_fuels: Sequence[str] = signals.EV_FUELS) -> DataFrame:
    """Five monthly signals side by side; months come from food, fuel or cpi."""
    food = signals.food_signal(price_summary_df, food_categories)
    fuel = signals.fuel_signal(fuel_timeline_df, fuel_type)
    cpi = signals.cpi_signal(stg_cpi_df)
    transport = signals.transport_signal(stg_transport_df)
    ev = signals.ev_share_signal(stg_vehicles_df, ev_fuels)
    return keyed_outer_chain([food, fuel, cpi, transport, ev], "month", anchors=3).select(
        "month", "national_food_median", "ron95_price", "avg_cpi", "total_ridership", "ev_share")


def normalised_signals(combined: DataFrame) -> DataFrame:
    return minmax_scale(combined, {
        "food_norm": ("national_food_median", False),
        "fuel_norm": ("ron95_price", False),
        "cpi_norm": ("avg_cpi", False),
        "transport_pressure_norm": ("total_ridership", True),
        "ev_pressure_norm": ("ev_share", True),
    })


def composite(weights: Mapping[str, float] = DEFAULT_WEIGHTS, neutral: float = NEUTRAL):
    """Weighted sum of the scaled components; a missing component counts as ``neutral``."""
    total = None
    for name, w in weights.items():
        term = F.coalesce(F.col(name), F.lit(neutral)) * F.lit(float(w))
        total = term if total is None else total + term
    return total


def band(score_01) -> "F.Column":
    expr = None
    for edge, label in BANDS:
        expr = (F.when(score_01 < F.lit(edge), F.lit(label)) if expr is None
                else expr.when(score_01 < F.lit(edge), F.lit(label)))
    return expr.otherwise(F.lit(TOP_BAND))


def pulse_score(normalised: DataFrame, weights: Mapping[str, float] = DEFAULT_WEIGHTS) -> DataFrame:
    scored = normalised.withColumn("_c", composite(weights)).withColumn(
        "_c100", F.col("_c") * F.lit(100))
    return scored.select(
        "month", "national_food_median", "ron95_price", "avg_cpi", "total_ridership", "ev_share",
        round_half_away("_c100", 1).alias("pulse_score"),
        band(F.col("_c")).alias("pressure_label"),
    )


def pressure_score(price_summary_df: DataFrame, fuel_timeline_df: DataFrame,
                   stg_cpi_df: DataFrame, stg_transport_df: DataFrame,
                   stg_vehicles_df: DataFrame,
                   food_categories: Sequence[str] = signals.FOOD_CATEGORIES,
                   weights: Mapping[str, float] = DEFAULT_WEIGHTS, keep=None) -> DataFrame:
    """``keep(name, df)`` may store the signals before they are scaled (scaling reads them twice)."""
    combined = combined_signals(price_summary_df, fuel_timeline_df, stg_cpi_df,
                                stg_transport_df, stg_vehicles_df, food_categories)
    combined = keep("combined_signals", combined) if keep else combined
    return pulse_score(normalised_signals(combined), weights)
