"""Fixture adapters: the pipeline's source shapes, derived from the driver tables.

The real sources are public parquet datasets that are not available here, so
each source is rebuilt from the TPC-H-like tables in ``sf_dir`` with the same
columns and the edge cases the operators must handle (negative prices,
missing dimension rows, runs of spaces, null states, null measures, padded
text).  Every adapter reads only the columns it needs, so the parquet scan is
pruned; all of them grow with the driver tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from costindex.operators.joins import shuffled_if_large

# The ridership columns of the source.
SERVICES = [
    "bus_rkl", "bus_rkn", "bus_rpn",
    "rail_lrt_ampang", "rail_lrt_kj", "rail_monorail",
    "rail_mrt_kajang", "rail_mrt_pjy",
    "rail_ets", "rail_intercity", "rail_komuter", "rail_komuter_utara", "rail_tebrau",
]

# Food categories present in the fixture data (the production list is in plans.signals).
FIXTURE_FOOD_CATEGORIES = ["PROMO", "SMALL", "LARGE"]
# All categories of the fixture data; they have no label of their own.
FIXTURE_CATEGORIES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _month_of(ts: Column) -> Column:
    return F.substring(ts.cast("string"), 1, 7)


def _trunc_date(unit: str, ts: Column) -> Column:
    return F.to_date(F.date_trunc(unit, ts))


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_shipdate").alias("date"),
        F.col("l_partkey").alias("item_code"),
        F.col("l_suppkey").alias("premise_code"),
        F.when(F.col("l_linenumber") == 7, -F.col("l_extendedprice"))
         .otherwise(F.col("l_extendedprice")).alias("price"),
        _month_of(F.col("l_shipdate")).alias("_month_partition"),
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.where(F.pmod(F.col("p_partkey"), F.lit(50)) != 3).select(
        F.col("p_partkey").alias("item_code"),
        F.replace(F.col("p_name"), F.lit(" "), F.lit("   ")).alias("item"),
        F.col("p_size").cast("string").alias("unit"),
        F.col("p_brand").alias("item_group"),
        F.concat(F.lit(" "), F.col("p_type"), F.lit(" ")).alias("item_category"),
    )


def premises(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    j = s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    return j.select(
        F.col("s_suppkey").alias("premise_code"),
        F.col("s_name").alias("premise"),
        F.col("r_name").alias("premise_type"),
        F.when(F.pmod(F.col("s_suppkey"), F.lit(25)) == 4, F.lit(None).cast("string"))
         .otherwise(F.col("n_name")).alias("state"),
        F.concat(F.col("n_name"), F.lit("  "), F.col("r_name")).alias("district"),
    )


FUELS = ["ron95", "ron97", "diesel", "ron100", "kerosene"]


def fuel_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderdate", "o_orderpriority", "o_totalprice")
    week = _trunc_date("week", F.col("o_orderdate")).alias("date")
    level = o.groupBy(week).agg(
        F.max(F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice"))).alias("ron95"),
        F.max(F.when(F.col("o_orderpriority") == "2-HIGH", F.col("o_totalprice"))).alias("ron97"),
        F.max(F.when((F.col("o_orderpriority") == "5-LOW")
                     & (F.pmod(F.col("o_orderkey"), F.lit(9)) != 0),
                     F.col("o_totalprice"))).alias("diesel"),
        F.max(F.when(F.col("o_orderpriority") == "3-MEDIUM", F.col("o_totalprice"))).alias("ron100"),
        F.max(F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.col("o_totalprice"))).alias("kerosene"),
    ).select(F.lit("level").alias("series_type"), "date", *FUELS)
    change = o.select(week).distinct().select(
        F.lit("change_weekly").alias("series_type"), "date",
        *[F.lit(0.0).cast("double").alias(fuel) for fuel in FUELS])
    return level.unionByName(change)


def fuel_history_prev(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A previous run's fuel history: some keys missing, some values moved."""
    w = fuel_wide(spark, sf_dir)
    day = F.dayofmonth("date")
    return w.where((F.col("series_type") == "level") & F.col("ron95").isNotNull()
                   & (F.pmod(day, F.lit(11)) != 0)).select(
        F.col("date").alias("date_effective"),
        F.lit("RON95").alias("fuel_type"),
        F.when(F.pmod(day, F.lit(7)) == 0, F.col("ron95") + F.lit(0.0005))
         .when(F.pmod(day, F.lit(5)) == 0, F.col("ron95") + F.lit(5.0))
         .otherwise(F.col("ron95")).alias("price"),
    )


def gdp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turnover per quarter and order status (summed in cents, so the order of rows does not matter)."""
    o = table(spark, sf_dir, "orders").select("o_orderdate", "o_orderstatus", "o_totalprice")
    quarter = _trunc_date("quarter", F.col("o_orderdate")).alias("date")
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    g = o.groupBy(quarter, "o_orderstatus").agg((F.sum(cents) / F.lit(100.0)).alias("turnover"))
    return g.select(
        "date", F.concat(F.lit(" "), F.col("o_orderstatus")).alias("series"),
        F.when((F.month("date") == 10) & (F.col("o_orderstatus") == "P"),
               F.lit(None).cast("double")).otherwise(F.col("turnover")).alias("value"))


def _orders_by_customer_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_totalprice",
                                              "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return o.join(shuffled_if_large(c), o.o_custkey == c.c_custkey)


def income(spark: SparkSession, sf_dir: str) -> DataFrame:
    from costindex.operators.quantiles import exact_quantiles
    oc = _orders_by_customer_nation(spark, sf_dir)
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    keys = ["n_name", "n_nationkey", "date"]
    j = oc.join(n, oc.c_nationkey == n.n_nationkey).select(
        "n_name", "n_nationkey", _trunc_date("year", F.col("o_orderdate")).alias("date"), "o_totalprice")
    means = j.groupBy(*keys).agg(
        (F.floor(F.avg("o_totalprice") + F.lit(0.5)).cast("double")).alias("income_mean"))
    g = means.join(exact_quantiles(j, keys, "o_totalprice", {"_med": 0.5}), keys)
    nk8, year = F.pmod(F.col("n_nationkey"), F.lit(8)), F.year("date")
    return g.select(
        F.col("n_name").alias("state"), "date",
        F.when((nk8 == 1) & (year == 1995), F.lit(None).cast("double"))
         .when((nk8 == 2) & (year == 1998), F.lit(None).cast("double"))
         .otherwise(F.col("_med")).alias("income_median"),
        "income_mean")


def cpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean order value per month, region and segment; the months before 1996 have no index."""
    oc = _orders_by_customer_nation(spark, sf_dir)
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    j = oc.join(n, oc.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    g = j.groupBy(
        _trunc_date("month", F.col("o_orderdate")).alias("date"),
        F.concat(F.lit(" "), F.col("r_name")).alias("state"),
        F.col("c_mktsegment").alias("division"),
    ).agg((F.floor(F.avg("o_totalprice") + F.lit(0.5)).cast("double")).alias("mean_value"))
    return g.select("date", "state", "division",
                    F.when(F.year("date") >= 1996, F.col("mean_value")).alias("index"))


def vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    oc = _orders_by_customer_nation(spark, sf_dir)
    pr = F.col("o_orderpriority")
    fuel = (F.when(pr == "1-URGENT", F.lit("Electric")).when(pr == "2-HIGH", F.lit(" PHEV "))
            .when(pr == "5-LOW", F.lit("diesel")).otherwise(F.lit("petrol")))
    return oc.groupBy(
        _trunc_date("month", F.col("o_orderdate")).alias("date"),
        F.col("c_mktsegment").alias("type"), fuel.alias("fuel"),
    ).agg(F.count(F.lit(1)).alias("registrations"))


def ridership(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_shipdate", "l_suppkey", "l_quantity")
    m13 = F.pmod(F.col("l_suppkey"), F.lit(13))
    return li.groupBy(F.to_date("l_shipdate").alias("date")).agg(*[
        F.sum(F.when(m13 == i, F.col("l_quantity"))).alias(name)
        for i, name in enumerate(SERVICES)])


ALL = {
    "fx_prices": prices,
    "fx_items": items,
    "fx_premises": premises,
    "fx_fuel_wide": fuel_wide,
    "fx_fuel_history_prev": fuel_history_prev,
    "fx_gdp": gdp,
    "fx_income": income,
    "fx_cpi": cpi,
    "fx_vehicles": vehicles,
    "fx_ridership": ridership,
}
