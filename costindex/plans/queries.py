"""Query catalog: one Spark DataFrame per operator of the pipeline, over the driver tables.

Every builder takes (spark, sf_dir), reads the driver tables through the
fixture adapters and returns a lazy DataFrame (the loaders and state jobs
write to the shared warehouse folder first and return what they wrote).
Run stamps are parameters, so results repeat.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costindex.functions import collapse_whitespace, round_half_away
from costindex.operators import quality
from costindex.operators.scd2 import as_of, as_of_join, empty_dim
from costindex.plans import capture, marts, reports, signals, staging
from costindex.sources import fixtures as fx
from costindex.sources.tables import Warehouse, warehouse_for

# Run stamps used by the catalog (parameters of the jobs, not data).
RUN_TS = "2026-02-01 06:00:00"
PREV_TS = "2026-01-01 06:00:00"
RUN_DATE = "2026-02-01"
AS_OF_YEAR = 1998
HOT_ITEM = 7
HOT_BROADCAST = 8192  # bytes, in the query that forces dimensions above the limit
HOT_BOUND = 200  # distinct values a task ranks, in the query that forces buckets


def ts(text: str):
    return F.lit(text).cast("timestamp_ntz")


class Inputs:
    """Lazily built frames of one sf_dir (plans only; nothing runs until an action)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def wh(self) -> Warehouse:
        return warehouse_for(self.spark, self.sf_dir)

    def keep(self, layer: str):
        """Materialize a table once per session and sf_dir (marts and histories are tables).

        Serialized per warehouse, so queries run from several threads never
        write the same table version twice.
        """
        def _keep(name: str, df: DataFrame) -> DataFrame:
            with self.wh.lock:
                if self.wh.has_table(layer, name):
                    return self.wh.read(layer, name)
                return self.wh.write_snapshot(layer, name, df)
        return _keep

    def fx(self, name: str) -> DataFrame:
        return fx.ALL[name](self.spark, self.sf_dir)

    # staging --------------------------------------------------------------
    @cached_property
    def stg_prices(self) -> DataFrame:
        return staging.stg_prices(self.fx("fx_prices"), self.fx("fx_items"), self.fx("fx_premises"))

    @cached_property
    def stg_cpi(self) -> DataFrame:
        return staging.stg_cpi(self.fx("fx_cpi"))

    @cached_property
    def stg_vehicles(self) -> DataFrame:
        return staging.stg_vehicles(self.fx("fx_vehicles"))

    @cached_property
    def stg_transport(self) -> DataFrame:
        return staging.stg_transport(self.fx("fx_ridership"), fx.SERVICES)

    # change capture ------------------------------------------------------------
    @cached_property
    def fuel_prev(self) -> DataFrame:
        return self.fx("fx_fuel_history_prev").withColumn("loaded_at", ts(PREV_TS))

    @cached_property
    def gdp_prev(self) -> DataFrame:
        g = self.fx("fx_gdp").where(F.col("value").isNotNull() & (F.year("date") != 1996))
        m = F.month("date")
        return g.select(
            F.substring(F.col("date").cast("string"), 1, 7).alias("quarter"),
            "series",
            F.when(m == 4, F.col("value") + F.lit(0.005))
             .when(m == 7, F.col("value") + F.lit(100.0))
             .when((m == 10) & (F.col("series") == " F"), F.lit(None).cast("double"))
             .otherwise(F.col("value")).alias("value"),
            ts(PREV_TS).alias("loaded_at"))

    @cached_property
    def fuel(self) -> capture.Capture:
        return capture.capture_fuel(self.fx("fx_fuel_wide"), self.fuel_prev, ts(RUN_TS),
                                    self.keep("warehouse"))

    @cached_property
    def gdp(self) -> capture.Capture:
        return capture.capture_gdp(self.fx("fx_gdp"), self.gdp_prev, ts(RUN_TS),
                                   self.keep("warehouse"))

    @cached_property
    def income(self) -> capture.Capture:
        return capture.capture_income(self.fx("fx_income"), empty_dim(self.spark),
                                      F.lit(RUN_DATE).cast("date"), self.keep("warehouse"))

    @cached_property
    def events(self) -> DataFrame:
        return self.fuel.events.unionByName(self.gdp.events).unionByName(self.income.events)

    @cached_property
    def stg_fuel(self) -> DataFrame:
        return staging.stg_fuel(self.fuel.table)

    @cached_property
    def stg_gdp(self) -> DataFrame:
        return staging.stg_gdp(self.gdp.table)

    # marts -------------------------------------------------------------------
    @cached_property
    def price_summary(self) -> DataFrame:
        return self.keep("marts")("mart_price_summary", marts.price_summary(self.stg_prices))

    @cached_property
    def fuel_timeline(self) -> DataFrame:
        return self.keep("marts")("mart_fuel_timeline", marts.fuel_timeline(self.stg_fuel))

    @cached_property
    def combined(self) -> DataFrame:
        # stored: the scaling reads it twice (once for the bounds)
        return self.keep("marts")("combined_signals", marts.combined_signals(
            self.price_summary, self.fuel_timeline, self.stg_cpi, self.stg_transport,
            self.stg_vehicles, fx.FIXTURE_FOOD_CATEGORIES))

    @cached_property
    def normalised(self) -> DataFrame:
        return marts.normalised_signals(self.combined)

    @cached_property
    def score(self) -> DataFrame:
        return marts.pulse_score(self.normalised)


Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Callable[[Inputs], DataFrame]):
        _REGISTRY[name] = lambda spark, sf_dir: fn(Inputs(spark, sf_dir))
        return fn
    return deco


# ---- expressions -------------------------------------------------------------
@query("fn_first_ws")
def _fn_first_ws(i: Inputs) -> DataFrame:
    it = i.fx("fx_items")
    return it.select("item_code",
                     collapse_whitespace("item").alias("first_run"),
                     collapse_whitespace("item", all_runs=True).alias("all_runs"),
                     F.trim(collapse_whitespace("item_category")).alias("category"))


@query("fn_round_parity")
def _fn_round_parity(i: Inputs) -> DataFrame:
    p = i.fx("fx_prices").select("item_code", "premise_code", "price")
    x = F.col("price")
    return p.select("item_code", "premise_code",
                    round_half_away(x / F.lit(2.0), 2).alias("half_2"),
                    round_half_away(x * F.lit(1.5), 2).alias("x15_2"),
                    round_half_away(x / F.lit(3.0), 1).alias("third_1"),
                    round_half_away(x / F.lit(8.0), 3).alias("eighth_3"),
                    round_half_away(x, 0).alias("whole"))


# ---- staging -----------------------------------------------------------------
@query("stg_cpi")
def _stg_cpi(i: Inputs) -> DataFrame:
    return i.stg_cpi


@query("stg_fuel")
def _stg_fuel(i: Inputs) -> DataFrame:
    return i.stg_fuel


@query("stg_gdp")
def _stg_gdp(i: Inputs) -> DataFrame:
    return i.stg_gdp


@query("stg_vehicles")
def _stg_vehicles(i: Inputs) -> DataFrame:
    return i.stg_vehicles


@query("stg_transport")
def _stg_transport(i: Inputs) -> DataFrame:
    return i.stg_transport


@query("stg_prices")
def _stg_prices(i: Inputs) -> DataFrame:
    return i.stg_prices


# ---- joins -------------------------------------------------------------------
@query("join_star")
def _join_star(i: Inputs) -> DataFrame:
    """Star-join aggregate: rows and revenue per premise type and item group."""
    return i.stg_prices.groupBy("premise_type", "item_group").agg(
        F.count(F.lit(1)).alias("n_rows"),
        round_half_away(F.sum("price"), 2).alias("revenue"))


@query("join_star_hot")
def _join_star_hot(i: Inputs) -> DataFrame:
    """The star join with dimensions above the broadcast limit and a third of the facts on one item."""
    prices = i.fx("fx_prices")
    prices = prices.withColumn("item_code", F.when(F.pmod("premise_code", F.lit(3)) == 0, F.lit(HOT_ITEM)).otherwise(F.col("item_code")))
    joined = staging.stg_prices(prices, i.fx("fx_items"), i.fx("fx_premises"), max_broadcast_bytes=HOT_BROADCAST)
    return joined.groupBy("premise_type", "item_group", (F.col("item_code") == HOT_ITEM).alias("hot")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("item_name", "premise_name").alias("n_pairs"),
        F.sum(F.round(F.col("price") * 100).cast("long")).alias("cents"))


@query("join_full_outer_chain")
def _join_full_outer_chain(i: Inputs) -> DataFrame:
    return i.combined


# ---- aggregates -----------------------------------------------------------------
@query("agg_price_summary")
def _agg_price_summary(i: Inputs) -> DataFrame:
    return i.price_summary.drop("prev_median_price", "mom_pct_change")


@query("sig_food")
def _sig_food(i: Inputs) -> DataFrame:
    return signals.food_signal(i.price_summary, fx.FIXTURE_FOOD_CATEGORIES)


@query("sig_fuel")
def _sig_fuel(i: Inputs) -> DataFrame:
    return signals.fuel_signal(i.fuel_timeline)


@query("sig_cpi")
def _sig_cpi(i: Inputs) -> DataFrame:
    return signals.cpi_signal(i.stg_cpi)


@query("sig_transport")
def _sig_transport(i: Inputs) -> DataFrame:
    return signals.transport_signal(i.stg_transport)


@query("sig_ev_share")
def _sig_ev_share(i: Inputs) -> DataFrame:
    return signals.ev_share_signal(i.stg_vehicles)


# ---- windows -------------------------------------------------------------------
@query("win_mom_change")
def _win_mom_change(i: Inputs) -> DataFrame:
    return i.price_summary.select("month", "state", "item_category", "median_price",
                                  "prev_median_price", "mom_pct_change")


@query("win_fuel_timeline")
def _win_fuel_timeline(i: Inputs) -> DataFrame:
    return i.fuel_timeline.select("fuel_type", "fuel_date", "price", "prev_price")


@query("win_minmax_norm")
def _win_minmax_norm(i: Inputs) -> DataFrame:
    return i.normalised.select("month", "food_norm", "fuel_norm", "cpi_norm")


@query("win_minmax_inverse")
def _win_minmax_inverse(i: Inputs) -> DataFrame:
    return i.normalised.select("month", "transport_pressure_norm", "ev_pressure_norm")


# ---- reshape -------------------------------------------------------------------
@query("rs_unpivot")
def _rs_unpivot(i: Inputs) -> DataFrame:
    from costindex.operators.reshape import unpivot_non_null
    return unpivot_non_null(i.fx("fx_ridership"), ["date"], fx.SERVICES, "service", "ridership")


@query("rs_melt_levels")
def _rs_melt_levels(i: Inputs) -> DataFrame:
    return capture.fuel_levels(i.fx("fx_fuel_wide"))


# ---- change capture --------------------------------------------------------------
@query("cdc_value")
def _cdc_value(i: Inputs) -> DataFrame:
    return i.fuel.events


@query("cdc_append")
def _cdc_append(i: Inputs) -> DataFrame:
    return i.gdp.events


@query("cdc_scd2")
def _cdc_scd2(i: Inputs) -> DataFrame:
    return i.income.table


@query("scd2_as_of")
def _scd2_as_of(i: Inputs) -> DataFrame:
    return as_of(i.income.table, AS_OF_YEAR)


@query("scd2_as_of_join")
def _scd2_as_of_join(i: Inputs) -> DataFrame:
    """Every order with the income version in force in its year for its customer's nation."""
    o = fx.table(i.spark, i.sf_dir, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("year"))
    c = fx.table(i.spark, i.sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = fx.table(i.spark, i.sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("nation"))
    rows = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey).select("o_orderkey", "nation", "year")
    return as_of_join(rows, i.income.table, "nation", "year")


@query("cdc_merge_history")
def _cdc_merge_history(i: Inputs) -> DataFrame:
    return i.fuel.table


@query("cdc_events")
def _cdc_events(i: Inputs) -> DataFrame:
    return i.events


@query("cdc_summary")
def _cdc_summary(i: Inputs) -> DataFrame:
    return i.events.groupBy("source_name", "change_type").agg(
        F.count(F.lit(1)).alias("changes"))


# ---- marts ----------------------------------------------------------------------
@query("mart_price_summary")
def _mart_price_summary(i: Inputs) -> DataFrame:
    return i.price_summary


@query("mart_fuel_timeline")
def _mart_fuel_timeline(i: Inputs) -> DataFrame:
    return i.fuel_timeline


@query("mart_score")
def _mart_score(i: Inputs) -> DataFrame:
    return i.score


@query("score_band")
def _score_band(i: Inputs) -> DataFrame:
    return i.score.select("month", "pulse_score", "pressure_label")


# ---- data tests ---------------------------------------------------------------------
@query("dq_accepted_values")
def _dq_accepted_values(i: Inputs) -> DataFrame:
    t = i.fuel_timeline
    return quality.summary("fuel_change_direction", t, quality.not_accepted(
        "change_direction", ["UP", "DOWN", "UNCHANGED", "FIRST"]))


@query("dq_positive")
def _dq_positive(i: Inputs) -> DataFrame:
    s = i.stg_prices
    return quality.summary("prices_positive", s, quality.not_positive("price"))


@query("dq_range")
def _dq_range(i: Inputs) -> DataFrame:
    s = i.score
    return quality.summary("pulse_score_range", s, quality.out_of_range("pulse_score", 0, 100))


@query("dq_unique")
def _dq_unique(i: Inputs) -> DataFrame:
    fuel, gdp, dim = i.fuel.table, i.gdp.table, i.income.table
    cur = dim.where(F.col("is_current"))
    return (quality.unique_summary("fuel_history_key", fuel, capture.FUEL_KEYS)
            .unionByName(quality.unique_summary("gdp_history_key", gdp, capture.GDP_KEYS))
            .unionByName(quality.unique_summary("income_one_current", cur, ["geography"])))


@query("agg_quantiles_hot")
def _agg_quantiles_hot(i: Inputs) -> DataFrame:
    """Quartiles with a small bound, so that every category is split into value buckets."""
    from costindex.functions import round_half_away as r2
    from costindex.operators.quantiles import exact_quantiles
    q = exact_quantiles(i.stg_prices, ["item_category"], "price",
                        {"p25": 0.25, "p50": 0.5, "p75": 0.75}, max_values_per_task=HOT_BOUND)
    return q.select("item_category", *[r2(F.col(c), 2).alias(c) for c in ("p25", "p50", "p75")])


@query("cdc_value_repeated")
def _cdc_value_repeated(i: Inputs) -> DataFrame:
    """Text prices, one row per order: keys repeat in file order, some are NaN or no number."""
    from costindex.plans.pipeline import FUEL_HISTORY
    o = fx.table(i.spark, i.sf_dir, "orders")
    k = F.col("o_orderkey")
    raw = o.select(
        F.to_date(F.date_trunc("week", "o_orderdate")).alias("date"),
        F.when(k % 13 == 0, "n/a").when(k % 17 == 0, "NaN")
         .otherwise(F.col("o_totalprice").cast("string")).alias("ron95"),
        F.lit("orders").alias("_file"), k.alias("_row"))
    empty = i.spark.createDataFrame([], FUEL_HISTORY)
    return capture.capture_fuel(raw, empty, ts(RUN_TS), order=capture.FILE_ORDER).events


@query("dq_dirty_input")
def _dq_dirty_input(i: Inputs) -> DataFrame:
    """The data tests on unclean inputs (raw prices, premises and GDP rows): they find violations."""
    prices, premises, gdp = i.fx("fx_prices"), i.fx("fx_premises"), i.fx("fx_gdp")
    return (quality.summary("raw_prices_positive", prices, quality.not_positive("price"))
            .unionByName(quality.summary("raw_prices_range", prices, quality.out_of_range("price", 1000, 50000)))
            .unionByName(quality.unique_summary("raw_price_key", prices, ["item_code", "premise_code"]))
            .unionByName(quality.summary("raw_premises_not_null", premises, quality.any_null(["premise", "state"])))
            .unionByName(quality.summary("raw_gdp_series", gdp, quality.not_accepted("series", [" F", " O"]))))


@query("dq_not_null")
def _dq_not_null(i: Inputs) -> DataFrame:
    fuel, gdp, dim = i.fuel.table, i.gdp.table, i.income.table
    return (quality.summary("fuel_history_not_null", fuel, quality.any_null(
                ["date_effective", "fuel_type", "price", "loaded_at"]))
            .unionByName(quality.summary("gdp_history_not_null", gdp, quality.any_null(
                ["quarter", "series", "loaded_at"])))
            .unionByName(quality.summary("income_dim_not_null", dim, quality.any_null(
                ["geography", "geography_type", "survey_year", "valid_from",
                      "is_current"]))))


# ---- reports ---------------------------------------------------------------------
@query("rep_latest_delta")
def _rep_latest_delta(i: Inputs) -> DataFrame:
    return reports.latest_delta(i.score)


@query("rep_fuel_events")
def _rep_fuel_events(i: Inputs) -> DataFrame:
    return reports.fuel_events(i.fuel_timeline)


@query("rep_food_trend")
def _rep_food_trend(i: Inputs) -> DataFrame:
    return reports.food_trend(i.price_summary)


@query("rep_heatmap")
def _rep_heatmap(i: Inputs) -> DataFrame:
    return reports.heatmap(i.price_summary, columns=fx.FIXTURE_CATEGORIES)


@query("rep_ev_share")
def _rep_ev_share(i: Inputs) -> DataFrame:
    return reports.ev_share(i.stg_vehicles)


@query("rep_ridership")
def _rep_ridership(i: Inputs) -> DataFrame:
    return reports.ridership(i.stg_transport)


@query("rep_change_log")
def _rep_change_log(i: Inputs) -> DataFrame:
    return reports.change_audit(capture.with_detected_at(i.events, ts(RUN_TS)))


def registry() -> dict[str, Query]:
    from costindex.plans import loads  # noqa: F401  (registers the load/state queries)
    return dict(_REGISTRY)
