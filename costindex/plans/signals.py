"""Monthly signals feeding the composite score."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costindex.functions import is_in_ci, safe_ratio
from costindex.operators.quantiles import exact_quantiles

# The production food categories of the price survey.
FOOD_CATEGORIES = [
    "AYAM", "TELUR", "BERAS", "MINYAK DAN LEMAK",
    "BAWANG", "SAYUR-SAYURAN", "BAHAN LAUT", "IKAN DARAT", "BUAH-BUAHAN",
]
# Fuel labels counted as electric (compared lower-case).
EV_FUELS = ["electric", "ev", "bev", "phev"]
HEADLINE_FUEL = "RON95"


def food_signal(price_summary: DataFrame, categories: Sequence[str] = FOOD_CATEGORIES) -> DataFrame:
    """Median over the month's group medians, for the food categories."""
    f = price_summary.where(F.col("item_category").isin(list(categories)))
    return exact_quantiles(f, ["month"], "median_price", {"national_food_median": 0.5})


def fuel_signal(fuel_timeline: DataFrame, fuel_type: str = HEADLINE_FUEL) -> DataFrame:
    """The month's last price of one fuel (by date)."""
    f = fuel_timeline.where(F.col("fuel_type") == fuel_type)
    return f.groupBy("month").agg(F.max_by("price", "fuel_date").alias("ron95_price"))


def cpi_signal(stg_cpi: DataFrame) -> DataFrame:
    return stg_cpi.groupBy("month").agg(F.avg("cpi_value").alias("avg_cpi"))


def transport_signal(stg_transport: DataFrame) -> DataFrame:
    return stg_transport.groupBy("month").agg(
        F.sum("ridership").cast("long").alias("total_ridership"))


def ev_share_signal(stg_vehicles: DataFrame, ev_fuels: Sequence[str] = EV_FUELS) -> DataFrame:
    """Share of registrations whose fuel is electric; null when the month has none."""
    r = F.col("registrations")
    return stg_vehicles.groupBy("month").agg(
        F.sum(F.when(is_in_ci("fuel_type", ev_fuels), r).otherwise(F.lit(0))).alias("_ev"),
        F.sum(r).alias("_all"),
    ).select("month", safe_ratio("_ev", "_all").alias("ev_share"))
