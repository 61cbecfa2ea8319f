"""Report datasets behind the dashboard: score delta, fuel events, food trend, heatmap, EV share,
ridership, change audit."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costindex.functions import is_in_ci, label_lookup
from costindex.operators.reshape import pivot_mean
from costindex.plans.signals import EV_FUELS

# Report labels of the food categories; other codes show as themselves.
CATEGORY_LABELS = {
    "AYAM": "Chicken",
    "TELUR": "Eggs",
    "BERAS": "Rice",
    "MINYAK DAN LEMAK": "Cooking Oil",
    "BAWANG": "Onions",
    "SAYUR-SAYURAN": "Vegetables",
    "BAHAN LAUT": "Seafood",
    "IKAN DARAT": "Freshwater Fish",
    "BUAH-BUAHAN": "Fruits",
}
# Arrows and markers shown by the report.
ARROW_UP, ARROW_DOWN = "↑", "↓"
MARK_UP, MARK_DOWN = "▲", "▼"


def latest_delta(score: DataFrame) -> DataFrame:
    """Newest month's score, the month before it, the change and its arrow (one row).

    Only the two newest rows are kept (a top-2, merged from per-partition
    top-2s); with a single month the previous score is the latest one.
    """
    top = score.select("month", "pulse_score", "pressure_label") \
        .orderBy(F.col("month").desc()).limit(2)
    s = F.struct("month", "pulse_score", "pressure_label")
    one = top.agg(F.max_by(s, "month").alias("_l"), F.min_by(s, "month").alias("_p"))
    chg = F.col("_l.pulse_score") - F.col("_p.pulse_score")
    return one.select(
        F.col("_l.month").alias("month"),
        F.col("_l.pulse_score").alias("pulse_score"),
        F.col("_p.pulse_score").alias("prev_score"),
        chg.alias("score_change"),
        F.when(chg > 0, F.lit(ARROW_UP)).otherwise(F.lit(ARROW_DOWN)).alias("arrow"),
        F.col("_l.pressure_label").alias("pressure_label"),
    )


def fuel_events(timeline: DataFrame, fuel_type: str = "RON95", last_n: int = 20) -> DataFrame:
    """The newest ``last_n`` UP / DOWN moves of one fuel, with a marker."""
    ev = timeline.where((F.col("fuel_type") == fuel_type)
                        & F.col("change_direction").isin("UP", "DOWN"))
    top = ev.orderBy(F.col("fuel_date").desc()).limit(last_n)
    return top.select(
        "fuel_date", "price", "change_direction",
        F.when(F.col("change_direction") == "UP", F.lit(MARK_UP))
         .otherwise(F.lit(MARK_DOWN)).alias("marker"))


def food_trend(price_summary: DataFrame,
               labels: Mapping[str, str] = CATEGORY_LABELS) -> DataFrame:
    """Mean of the state medians per month and category, with a readable label."""
    t = price_summary.groupBy("month", "item_category").agg(
        F.avg("median_price").alias("median_price"))
    return t.withColumn("label", label_lookup("item_category", labels))


def heatmap(price_summary: DataFrame, labels: Mapping[str, str] = CATEGORY_LABELS,
            columns: Sequence[str] | None = None) -> DataFrame:
    """State x label grid of mean median price for the newest month.

    ``columns`` are the labels shown (default: all known labels); the list is
    fixed, so the schema does not depend on the data and no job runs to find it.
    """
    columns = list(columns) if columns is not None else list(dict.fromkeys(labels.values()))
    newest = price_summary.agg(F.max("month").alias("month"))
    latest = price_summary.join(F.broadcast(newest), "month")
    cell = latest.groupBy("state", "item_category").agg(
        F.avg("median_price").alias("median_price")) \
        .withColumn("label", label_lookup("item_category", labels))
    return pivot_mean(cell, "state", "label", "median_price", columns)


def ev_share(stg_vehicles: DataFrame, ev_fuels: Sequence[str] = EV_FUELS) -> DataFrame:
    """EV share of registrations in percent and the month's total."""
    r = F.col("registrations")
    g = stg_vehicles.groupBy("month").agg(
        F.sum(F.when(is_in_ci("fuel_type", ev_fuels), r).otherwise(F.lit(0))).alias("_ev"),
        F.sum(r).alias("total_regs"))
    return g.select("month",
                    (F.col("_ev").cast("double") / F.col("total_regs").cast("double")
                     * F.lit(100.0)).alias("ev_share"),
                    "total_regs")


def ridership(stg_transport: DataFrame) -> DataFrame:
    return stg_transport.groupBy("month").agg(F.sum("ridership").cast("long").alias("ridership"))


def change_audit(change_log: DataFrame, last_n: int = 25) -> DataFrame:
    """Newest ``last_n`` change rows, time shown to the minute; ties broken by content."""
    top = change_log.orderBy(
        F.col("detected_at").desc(), "source_name", "entity_key", "change_type", "field_name",
        F.col("new_value").asc_nulls_first()).limit(last_n)
    return top.select(
        F.date_format("detected_at", "yyyy-MM-dd HH:mm").alias("detected_at"),
        "source_name", "entity_key", "field_name", "old_value", "new_value", "change_type")
