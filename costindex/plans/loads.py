"""Load, bookkeeping, state and materialization queries, with their DuckDB oracles.

Each query runs the real jobs against a fresh warehouse under the shared
checkpoint folder (the fixture tables stand in for the landing files), then
returns what was written, read back.  Run times are parameters.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costindex.functions import ntz

from costindex.plans import marts, oracle
from costindex.plans.queries import (HOT_ITEM, RUN_DATE, RUN_TS, Inputs, capture, query)
from costindex.sources import loader, state
from costindex.sources.ledger import Layout, Ledger
from costindex.sources.meta import RunBook
from costindex.sources.registry import STATIC, Source, month_window, monthly_parquet
from costindex.sources.tables import Audit, AuditFailed, Warehouse

AT = datetime.fromisoformat(RUN_TS)
STATIC_FIXTURES = {
    "pricecatcher_items": "fx_items",
    "pricecatcher_premises": "fx_premises",
    "cpi_state": "fx_cpi",
    "fuel_prices": "fx_fuel_wide",
    "gdp_quarterly": "fx_gdp",
    "vehicle_registrations": "fx_vehicles",
    "transport_ridership": "fx_ridership",
    "household_income": "fx_income",
}
MISSING_SOURCE = "cpi_national"       # its landing file is absent: logged as failed
FIRST_AS_OF = date(2001, 1, 15)       # window 1999-01 .. 2000-12
SECOND_AS_OF = date(2001, 12, 15)     # window 1999-12 .. 2001-11
REPLACED_MONTH = "2001-06"
SPLIT_FILES = 1                       # files a micro-batch in the split load
MONTH_FILES = 4                       # files a month in the landing folder


def _static_sources(i: Inputs) -> dict[str, Source]:
    out = {name: Source(name, STATIC, reader=(lambda fx_name=fx_name: i.fx(fx_name)))
           for name, fx_name in STATIC_FIXTURES.items()}

    def missing():
        raise FileNotFoundError(f"no landing file for {MISSING_SOURCE}")
    out[MISSING_SOURCE] = Source(MISSING_SOURCE, STATIC, reader=missing)
    return out


def _by_month(prices: DataFrame) -> DataFrame:
    """Rows dealt by month, so that a month has few files (else one from every task) whatever the size of the table."""
    return prices.repartition("_month_partition", F.pmod(F.xxhash64("item_code", "premise_code"), F.lit(MONTH_FILES)))


def _landing(i: Inputs) -> str:
    """Monthly price files, written once per session from the fixture (the publisher's files)."""
    path = i.wh.path("landing", "pricecatcher_prices")
    with i.wh.lock:
        if not i.wh.exists(f"{path}/_SUCCESS"):
            _by_month(i.fx("fx_prices")).write.mode("overwrite").partitionBy("_month_partition").parquet(path)
    return path


def _prices_source(i: Inputs, as_of: date) -> Source:
    from costindex.sources.registry import last_n_months
    landing = _landing(i)
    return monthly_parquet("pricecatcher_prices", landing + "/_month_partition={month}",
                           last_n_months(as_of, 24))


def _fresh(i: Inputs) -> RunBook:
    return RunBook(Warehouse(i.spark))


def _run_columns(df: DataFrame) -> DataFrame:
    return df.select("run_id", "source_name", "run_at", "status", "rows_loaded", "new_rows",
                     "error_message", "notes")


# ---- S-2 month window ---------------------------------------------------------------
@query("src_month_window")
def _src_month_window(i: Inputs) -> DataFrame:
    p = i.fx("fx_prices")
    as_of = p.agg(F.add_months(F.trunc(F.max("date"), "month"), 1).alias("as_of"))
    months = as_of.select(F.explode(month_window(F.col("as_of"), 24)).alias("month"))
    counts = p.groupBy(F.col("_month_partition").alias("month")).agg(
        F.count(F.lit(1)).alias("rows_in_month"))
    return months.join(counts, "month", "left").select(
        "month", F.coalesce("rows_in_month", F.lit(0).cast("long")).alias("rows_in_month"))


oracle.register_final("src_month_window", """
select strftime(m, '%Y-%m') as month, coalesce(c.n, 0) as rows_in_month
from (select unnest(generate_series(a - interval 24 month, a - interval 1 month, interval 1 month)) as m
      from (select date_trunc('month', max(date)) + interval 1 month as a from fx_prices) x) w
left join (select _month_partition, count(*) as n from fx_prices group by 1) c
  on c._month_partition = strftime(m, '%Y-%m')""", ["fx_prices"])


# ---- S-3 / S-4 full refresh and daily guard ----------------------------------------------
_STATIC_COUNTS = " union all ".join(
    f"select '{src}' as source_name, (select count(*) from {fx_name}) as n"
    for src, fx_name in STATIC_FIXTURES.items())
_STATIC_DEPS = list(STATIC_FIXTURES.values())


@query("src_full_refresh")
def _src_full_refresh(i: Inputs) -> DataFrame:
    book = _fresh(i)
    loader.run_all(book, _static_sources(i), AT)
    return book.runs().select("source_name", "status", "rows_loaded", "new_rows",
                              "error_message", "notes")


oracle.register_final("src_full_refresh", f"""
select source_name, 'success' as status, n as rows_loaded, n as new_rows,
       cast(null as varchar) as error_message, cast(null as varchar) as notes
from ({_STATIC_COUNTS}) c
union all
select '{MISSING_SOURCE}', 'failed', 0, 0, 'no landing file for {MISSING_SOURCE}', null""",
                      _STATIC_DEPS)


@query("src_daily_guard")
def _src_daily_guard(i: Inputs) -> DataFrame:
    """Second run the same day skips every loaded source; the next day loads again."""
    book = _fresh(i)
    sources = _static_sources(i)
    sources.pop(MISSING_SOURCE)
    loader.run_all(book, sources, AT)
    later = AT + timedelta(hours=5)
    loader.run_all(book, sources, later)
    nextday = AT + timedelta(days=1)
    loader.run_all(book, sources, nextday)
    return book.runs().where(F.col("run_at") > ntz(AT)).select(
        "source_name", F.date_format("run_at", "yyyy-MM-dd HH:mm").alias("run_at"), "status",
        "rows_loaded", "notes")


oracle.register_final("src_daily_guard", f"""
select source_name, '2026-02-01 11:00' as run_at, 'skipped' as status, 0 as rows_loaded,
       'Already loaded today' as notes from ({_STATIC_COUNTS}) c
union all
select source_name, '2026-02-02 06:00', 'success', n, null from ({_STATIC_COUNTS}) c""",
                      _STATIC_DEPS)


# ---- S-5 .. S-9 incremental monthly load, partition replace, watermarks, run log ------------
def _incremental(i: Inputs) -> RunBook:
    book = _fresh(i)
    loader.load_monthly(book, _prices_source(i, FIRST_AS_OF), AT)
    loader.load_monthly(book, _prices_source(i, SECOND_AS_OF), AT + timedelta(days=1))
    loader.load_monthly(book, _prices_source(i, SECOND_AS_OF), AT + timedelta(days=2))
    return book


@query("src_monthly_incremental")
def _src_monthly_incremental(i: Inputs) -> DataFrame:
    book = _incremental(i)
    return book.runs().select(F.to_date("run_at").alias("run_date"), "source_name", "status",
                              "rows_loaded", "new_rows", "notes")


_WIN1 = "_month_partition between '1999-01' and '2000-12'"
_WIN2 = "_month_partition between '2001-01' and '2001-11'"
oracle.register_final("src_monthly_incremental", f"""
select date '2026-02-01' as run_date, 'pricecatcher_prices' as source_name, 'success' as status,
       (select count(*) from fx_prices where {_WIN1}) as rows_loaded,
       (select count(*) from fx_prices where {_WIN1}) as new_rows,
       'Loaded up to 2000-12' as notes
union all
select date '2026-02-02', 'pricecatcher_prices', 'success',
       (select count(*) from fx_prices where {_WIN1} or {_WIN2}),
       (select count(*) from fx_prices where {_WIN2}), 'Loaded up to 2001-11'
union all
select date '2026-02-03', 'pricecatcher_prices', 'skipped', 0, 0, 'No new months after 2001-11'""",
                      ["fx_prices"])


#: What befalls a month's file, by the month of the year; the other months arrive as they should.
DAMAGES = {1: "text", 2: "missing", 3: "renamed", 4: "added", 5: "retyped", 6: "unreadable", 7: "words", 8: "mixed"}
REFUSED = {"missing", "renamed", "unreadable", "words"}


def _damaged(rows: DataFrame, damage: str | None) -> DataFrame:
    price = F.col("price")
    if damage == "text":
        return rows.withColumn("price", price.cast("string"))
    if damage == "missing":
        return rows.drop("price")
    if damage == "renamed":
        return rows.withColumnRenamed("price", "amount")
    if damage == "added":
        return rows.withColumn("note", F.lit("new"))
    if damage == "retyped":  # codes as int, price as decimal
        return rows.withColumns({"item_code": F.col("item_code").cast("int"), "price": price.cast("decimal(12,2)")})
    if damage == "words":
        return rows.withColumn("price", F.lit("twelve"))
    return rows


@query("src_month_failure")
def _src_month_failure(i: Inputs) -> DataFrame:
    """All months, many of them damaged: those that do not fit the pinned columns are refused, the others load."""
    from costindex.sources.registry import PRICES
    book = _fresh(i)
    prices = i.fx("fx_prices").select("date", F.col("premise_code").cast("long").alias("premise_code"),
                                      F.col("item_code").cast("long").alias("item_code"), "price", "_month_partition")
    staged = book.wh.path("landing", "all_prices")
    _by_month(prices).write.partitionBy("_month_partition").parquet(staged)
    months = sorted(loader.folder_values(book.wh, staged, "_month_partition"))
    landing = book.wh.path("landing", "failing_prices")
    plain = prices.drop("_month_partition").schema

    def land(month: str) -> None:
        rows = i.spark.read.schema(plain).parquet(f"{staged}/_month_partition={month}").coalesce(1)
        damage, path = DAMAGES.get(int(month[5:])), f"{landing}/{month}.parquet"
        if damage == "unreadable":
            rows.select(F.lit("no parquet").alias("value")).write.text(path)
        elif damage == "mixed":  # one file as it should be, one with text prices
            odd = F.pmod(F.col("item_code"), F.lit(2)) == 1
            rows.where(~odd).write.parquet(path)
            rows.where(odd).withColumn("price", F.col("price").cast("string")).write.mode("append").parquet(path)
        else:
            _damaged(rows, damage).write.parquet(path)

    with ThreadPoolExecutor(8) as pool:  # the publisher's files; each is a job of one task
        list(pool.map(land, months))
    loader.load_monthly(book, monthly_parquet("prices", landing + "/{month}.parquet", months, schema=PRICES), AT)
    raw = book.wh.read_partitioned("raw", "prices")
    per_month = raw.groupBy(F.col("_month_partition").alias("item")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.round(F.col("price") * 100).cast("long")).alias("cents"))
    errors = F.filter(F.split("error_message", "\n"), lambda line: line.rlike("^[0-9]{4}-[0-9]{2}: "))
    run = book.runs().select(
        F.concat_ws(" ", "status", "notes").alias("item"), F.col("rows_loaded").alias("n"),
        F.size(errors).cast("long").alias("cents"))
    return per_month.unionByName(run)


_REFUSED_MONTHS = "(" + ", ".join(f"'{m:02d}'" for m, damage in DAMAGES.items() if damage in REFUSED) + ")"
_MONTHS = f"""(select _month_partition as item, count(*) as n, sum(round(price * 100)::bigint)::bigint as cents,
  right(_month_partition, 2) in {_REFUSED_MONTHS} as refused from fx_prices group by 1) months"""
oracle.register_final("src_month_failure", f"""
select item, n, cents from {_MONTHS} where not refused
union all
select 'success Loaded up to ' || max(item) filter (not refused), (sum(n) filter (not refused))::bigint, count(*) filter (refused)
from {_MONTHS}""", ["fx_prices"])


# ---- E-10 the NaN rule ------------------------------------------------------------------------
#: Rows whose measure is NaN in the landing files (null in the oracle): Spark condition, DuckDB condition.
NAN_ROWS = {
    "fx_prices": ("price", "item_code % 11 = 5"),
    "fx_cpi": ("index", "month(date) = 3 and division = 'BUILDING'"),
    "fx_vehicles": ("registrations", "month(date) = 5 and type = 'MACHINERY'"),
    "fx_ridership": ("bus_rkl", "day(date) = 13"),
}


@query("load_nan_rule")
def _load_nan_rule(i: Inputs) -> DataFrame:
    """Sources with NaN in prices, index, registrations and ridership: loaded, staged, made into marts and scored."""
    from costindex.plans import staging
    from costindex.sources import fixtures as fxm
    from costindex.sources.registry import PRICES
    book = _fresh(i)
    wh = book.wh

    def with_nan(name: str) -> DataFrame:
        column, condition = NAN_ROWS[name]
        return i.fx(name).withColumn(column, F.when(F.expr(condition), F.lit(float("nan"))).otherwise(F.col(column).cast("double")))

    landing = wh.path("landing", "nan_prices")
    _by_month(with_nan("fx_prices").select(*[F.col(f.name).cast(f.dataType) for f in PRICES], "_month_partition")).write.partitionBy(
        "_month_partition").parquet(landing)
    months = sorted(loader.folder_values(wh, landing, "_month_partition"))
    sources = {"prices": monthly_parquet("prices", landing + "/_month_partition={month}", months, schema=PRICES)}
    for name in ("fx_cpi", "fx_vehicles", "fx_ridership"):
        sources[name] = Source(name, STATIC, reader=lambda name=name: with_nan(name))
    loader.run_all(book, sources, AT)
    prices = staging.stg_prices(wh.read_partitioned("raw", "prices"), i.fx("fx_items"), i.fx("fx_premises"))
    return marts.pressure_score(
        wh.write_snapshot("marts", "mart_price_summary", marts.price_summary(prices)), i.fuel_timeline,
        staging.stg_cpi(wh.read("raw", "fx_cpi")), staging.stg_transport(wh.read("raw", "fx_ridership"), fxm.SERVICES),
        staging.stg_vehicles(wh.read("raw", "fx_vehicles")), fxm.FIXTURE_FOOD_CATEGORIES,
        keep=lambda name, df: wh.write_snapshot("marts", name, df))


oracle.register_final("load_nan_rule", "select * from mart_score", ["mart_score"], {
    name: f"select * replace (case when {condition} then null else {column} end as {column}) from ({oracle.FIXTURES[name]}) clean"
    for name, (column, condition) in NAN_ROWS.items()})


@query("src_partition_replace")
def _src_partition_replace(i: Inputs) -> DataFrame:
    """Re-load one month twice (idempotent), then replace it with its positive rows only."""
    book = _incremental(i)
    src = _prices_source(i, SECOND_AS_OF)
    month_rows = i.spark.read.parquet(src.path_for_month(REPLACED_MONTH))
    loader.reload_month(book, src, REPLACED_MONTH, month_rows)
    loader.reload_month(book, src, REPLACED_MONTH, month_rows.where(F.col("price") > 0))
    raw = book.wh.read_partitioned("raw", "pricecatcher_prices")
    return raw.groupBy(F.col("_month_partition").alias("month")).agg(
        F.count(F.lit(1)).alias("rows_in_month"))


oracle.register_final("src_partition_replace", f"""
select _month_partition as month, count(*) as rows_in_month from fx_prices
where ({_WIN1} or {_WIN2}) and (_month_partition <> '{REPLACED_MONTH}' or price > 0)
group by 1""", ["fx_prices"])


@query("meta_watermark_upsert")
def _meta_watermark_upsert(i: Inputs) -> DataFrame:
    """Watermarks after static loads then three monthly runs: one row per source."""
    book = _incremental(i)
    sources = _static_sources(i)
    loader.run_all(book, {k: sources[k] for k in ("pricecatcher_items", "cpi_state")},
                   AT + timedelta(days=3))
    return book.watermarks().select(
        "source_name", F.date_format("last_loaded_at", "yyyy-MM-dd HH:mm").alias("last_loaded_at"),
        "last_max_date", "row_count")


oracle.register_final("meta_watermark_upsert", f"""
select 'pricecatcher_prices' as source_name, '2026-02-02 06:00' as last_loaded_at,
       '2001-11' as last_max_date, (select count(*) from fx_prices where {_WIN1} or {_WIN2}) as row_count
union all select 'pricecatcher_items', '2026-02-04 06:00', null, (select count(*) from fx_items)
union all select 'cpi_state', '2026-02-04 06:00', null, (select count(*) from fx_cpi)""",
                      ["fx_prices", "fx_items", "fx_cpi"])


@query("meta_run_log")
def _meta_run_log(i: Inputs) -> DataFrame:
    book = _incremental(i)
    return _run_columns(book.runs())


oracle.register_final("meta_run_log", f"""
select 'pricecatcher_prices__20260201T060000000000' as run_id, 'pricecatcher_prices' as source_name,
       timestamp '2026-02-01 06:00:00' as run_at, 'success' as status,
       (select count(*) from fx_prices where {_WIN1}) as rows_loaded,
       (select count(*) from fx_prices where {_WIN1}) as new_rows,
       cast(null as varchar) as error_message, 'Loaded up to 2000-12' as notes
union all
select 'pricecatcher_prices__20260202T060000000000', 'pricecatcher_prices',
       timestamp '2026-02-02 06:00:00', 'success',
       (select count(*) from fx_prices where {_WIN1} or {_WIN2}),
       (select count(*) from fx_prices where {_WIN2}), null, 'Loaded up to 2001-11'
union all
select 'pricecatcher_prices__20260203T060000000000', 'pricecatcher_prices',
       timestamp '2026-02-03 06:00:00', 'skipped', 0, 0, null, 'No new months after 2001-11'""",
                      ["fx_prices"])


# ---- S-10 change log, S-11..S-13 state and row counts ------------------------------------
def _cdc_run(i: Inputs) -> RunBook:
    """A warehouse holding one CDC run: histories, dimension and change log."""
    book = _fresh(i)
    wh = book.wh
    keep = lambda name, df: wh.write_snapshot("warehouse", name, df)
    fuel = capture.capture_fuel(i.fx("fx_fuel_wide"), i.fuel_prev, ntz(AT),
                                keep)
    gdp = capture.capture_gdp(i.fx("fx_gdp"), i.gdp_prev, ntz(AT), keep)
    inc = capture.capture_income(i.fx("fx_income"), _empty_dim(i), F.lit(RUN_DATE).cast("date"),
                                 keep)
    events = fuel.events.unionByName(gdp.events).unionByName(inc.events)
    book.append_changes(capture.with_detected_at(events, ntz(AT)))
    book.log_run("cdc", AT, "success", notes="change capture")
    return book


def _empty_dim(i: Inputs) -> DataFrame:
    from costindex.operators.scd2 import empty_dim
    return empty_dim(i.spark)


@query("meta_change_log")
def _meta_change_log(i: Inputs) -> DataFrame:
    return _cdc_run(i).changes()


oracle.register_final("meta_change_log", """
select timestamp '2026-02-01 06:00:00' as detected_at, * from all_events""", ["all_events"])


_STATE_COUNTS = """
select 'meta.pipeline_runs' as table_name, 1 as n
union all select 'meta.change_log', (select count(*) from all_events)
union all select 'warehouse.fuel_price_history', (select count(*) from fuel_hist)
union all select 'warehouse.gdp_quarterly', (select count(*) from gdp_hist)
union all select 'warehouse.dim_household_income', (select count(*) from inc_dim)"""
_STATE_DEPS = ["all_events", "fuel_hist", "gdp_hist", "inc_dim"]


@query("state_roundtrip")
def _state_roundtrip(i: Inputs) -> DataFrame:
    """Export the stateful tables, restore them into an empty warehouse, compare counts."""
    book = _cdc_run(i)
    state_dir = book.wh.path("state", "snapshot")
    exported = dict(state.export_state(book.wh, state_dir))
    fresh = Warehouse(i.spark)
    restored = {t: rows for t, _, rows in state.import_state(fresh, state_dir)}
    rows = [(t, exported[t], restored.get(t)) for t in state.STATEFUL_TABLES]
    return i.spark.createDataFrame(
        rows, "table_name string, rows_exported long, rows_restored long")


oracle.register_final("state_roundtrip", f"""
select table_name, n as rows_exported, n as rows_restored from ({_STATE_COUNTS}) s""", _STATE_DEPS)


@query("state_restore_guard")
def _state_restore_guard(i: Inputs) -> DataFrame:
    """Restore only into empty tables: a warehouse with a live change log keeps it."""
    book = _cdc_run(i)
    state_dir = book.wh.path("state", "snapshot")
    state.export_state(book.wh, state_dir)
    target = RunBook(Warehouse(i.spark))
    # the target already holds a live change log (its own copy of this run's changes)
    target.append_changes(book.changes())
    result = state.import_state(target.wh, state_dir)
    return i.spark.createDataFrame(result, "table_name string, action string, row_count long")


oracle.register_final("state_restore_guard", f"""
select table_name, case when table_name = 'meta.change_log' then 'kept_local' else 'restored' end as action,
       n as row_count
from ({_STATE_COUNTS}) s""", _STATE_DEPS)


@query("meta_row_counts")
def _meta_row_counts(i: Inputs) -> DataFrame:
    """Row count per table; null for a table that does not exist."""
    wh = _cdc_run(i).wh
    names = [("warehouse", "fuel_price_history"), ("warehouse", "gdp_quarterly"),
             ("warehouse", "dim_household_income"), ("warehouse", "labour_force_history")]
    rows = [(f"{layer}.{name}", wh.row_count(layer, name)) for layer, name in names]
    return i.spark.createDataFrame(rows, "table_name string, row_count long")


oracle.register_final("meta_row_counts", """
select 'warehouse.fuel_price_history' as table_name, (select count(*) from fuel_hist) as row_count
union all select 'warehouse.gdp_quarterly', (select count(*) from gdp_hist)
union all select 'warehouse.dim_household_income', (select count(*) from inc_dim)
union all select 'warehouse.labour_force_history', null""", ["fuel_hist", "gdp_hist", "inc_dim"])


# ---- S-15 materialization -------------------------------------------------------------
@query("marts_materialize")
def _marts_materialize(i: Inputs) -> DataFrame:
    """Marts are written as tables (read back here); staging stays lazy views."""
    wh = Warehouse(i.spark)
    fuel = wh.write_snapshot("marts", "mart_fuel_timeline", i.fuel_timeline,
                             sort_within=["fuel_type", "fuel_date"])
    return fuel.select("fuel_type", "fuel_date", "price", "change_direction")


oracle.register_final("marts_materialize", """
select fuel_type, fuel_date, price, change_direction from mart_fuel_timeline""",
                      ["mart_fuel_timeline"])


# ---- J-1 above the broadcast limit ---------------------------------------------------
oracle.register_final("join_star_hot", f"""
select premise_type, item_group, item_code = {HOT_ITEM} as hot, count(*) as n_rows,
       count(distinct (item_name, premise_name)) as n_pairs, sum(round(price * 100)::bigint)::bigint as cents
from stg_prices group by 1, 2, 3""", ["stg_prices"], {
    "fx_prices": f"select * replace (case when premise_code % 3 = 0 then {HOT_ITEM} else item_code end as item_code) "
                 f"from ({oracle.FIXTURES['fx_prices']}) dealt"})


# ---- L-1 mart order, Q-4 keys enforced -----------------------------------------------
MART_FILES = 5                        # files of the ordered mart


@query("marts_order")
def _marts_order(i: Inputs) -> DataFrame:
    """The price mart written in order over several files: each row with its place in them."""
    wh = Warehouse(i.spark)
    wh.write_ordered("marts", "mart_price_summary", i.price_summary, marts.PRICE_SUMMARY_KEYS, files=MART_FILES,
                     audit=Audit(marts.PRICE_SUMMARY_KEYS, ["month"]))
    return wh.with_position("marts", "mart_price_summary").select(*marts.PRICE_SUMMARY_KEYS, "median_price", "position")


oracle.register_final("marts_order", """
select month, state, item_category, median_price,
       row_number() over (order by month nulls last, state nulls last, item_category nulls last) as position
from mart_price_summary""", ["mart_price_summary"])


@query("publish_audited")
def _publish_audited(i: Inputs) -> DataFrame:
    """A version of the fuel history that repeats keys and lacks prices is written, refused, and the one before stays."""
    wh = Warehouse(i.spark)
    book = RunBook(wh)
    audit = Audit(capture.FUEL_KEYS, ["date_effective", "fuel_type", "price", "loaded_at"])
    fuel = wh.write_snapshot("warehouse", "fuel", i.fuel.table.where(F.col("price").isNotNull()), audit=audit)
    diesel = F.col("fuel_type") == "diesel"
    dirty = fuel.unionByName(fuel.where(diesel)).withColumn("price", F.when(diesel, F.col("price")))
    try:
        wh.write_snapshot("warehouse", "fuel", dirty, audit=audit)
        raise RuntimeError("a version with repeated keys was published")
    except AuditFailed as e:
        book.log_run("fuel", AT, "failed", error=str(e))
        found = audit.summary(i.spark.read.parquet(e.target)).select(F.col("test_name").alias("item"), F.col("failures").alias("n"))
    current = wh.read("warehouse", "fuel").agg(F.count(F.lit(1)).alias("n")).select(F.lit("current").alias("item"), "n")
    runs = book.runs().groupBy("status").agg(F.count(F.lit(1)).alias("n")).select(F.concat(F.lit("runs "), "status").alias("item"), "n")
    return found.unionByName(current).unionByName(runs)


oracle.register_final("publish_audited", """
select 'unique' as item, count(*) as n from fuel_hist where price is not null and fuel_type = 'diesel'
union all select 'not_null', count(*) from fuel_hist where price is not null and fuel_type <> 'diesel'
union all select 'current', count(*) from fuel_hist where price is not null
union all select 'runs failed', 1""", ["fuel_hist"])


# ---- histories in parts ------------------------------------------------------------------
@query("cdc_in_parts")
def _cdc_in_parts(i: Inputs) -> DataFrame:
    """The previous histories stored in parts, a run over all three sources, and a second run that finds nothing.

    Returns every history, the events per kind and the version after both runs.
    """
    from costindex.plans import history
    from costindex.plans.pipeline import AUDITS, FUEL_HISTORY, GDP_HISTORY
    from costindex.operators.scd2 import DIM_SCHEMA
    book = _fresh(i)
    wh, ledger = book.wh, Ledger(book.wh)
    fuel = history.fuel_history(FUEL_HISTORY, AUDITS["fuel_price_history"])
    gdp = history.gdp_history(GDP_HISTORY, AUDITS["gdp_quarterly"])
    ledger.publish([ledger.prepare(h.table, ledger.parts_of(rows, h.layout), h.layout, h.schema, lambda _, rows=rows: rows, h.audit)
                    for h, rows in ((fuel, i.fuel_prev), (gdp, i.gdp_prev))])
    for name in ("fuel_prices", "gdp_quarterly", "household_income"):
        wh.write_snapshot("raw", name, i.fx(STATIC_FIXTURES[name]))
    for day in (0, 1):
        history.run_cdc_in_parts(book, ledger, AT + timedelta(days=day))

    def rows(table, schema, key, sub, value, at):
        return ledger.read(table, schema).select(F.lit(table).alias("item"), F.col(key).cast("string").alias("key"), F.col(sub).cast("string").alias("sub"),
                                                 F.col(value).cast("double").alias("value"), F.col(at).cast("timestamp_ntz").alias("at"))

    events = history.changes(ledger).groupBy("source_name", "change_type", "detected_at").agg(F.count(F.lit(1)).cast("double").alias("n"))
    version = ledger.entries().agg(F.max("version").cast("double").alias("n"))
    return (rows("fuel_price_history", FUEL_HISTORY, "date_effective", "fuel_type", "price", "loaded_at")
            .unionByName(rows("gdp_quarterly", GDP_HISTORY, "quarter", "series", "value", "loaded_at"))
            .unionByName(rows("dim_household_income", DIM_SCHEMA, "geography", "version", "income_median", "valid_from"))
            .unionByName(events.select(F.lit("events").alias("item"), F.col("source_name").alias("key"), F.col("change_type").alias("sub"),
                                       F.col("n").alias("value"), F.col("detected_at").alias("at")))
            .unionByName(version.select(F.lit("version").alias("item"), F.lit(None).cast("string").alias("key"), F.lit(None).cast("string").alias("sub"),
                                        F.col("n").alias("value"), F.lit(None).cast("timestamp_ntz").alias("at"))))


oracle.register_final("cdc_in_parts", """
select 'fuel_price_history' as item, cast(date_effective as varchar) as key, fuel_type as sub, price as value, loaded_at as at from fuel_hist
union all select 'gdp_quarterly', quarter, series, value, loaded_at from gdp_hist
union all select 'dim_household_income', geography, cast(version as varchar), income_median, cast(valid_from as timestamp) from inc_dim
union all select 'events', source_name, change_type, cast(count(*) as double), timestamp '2026-02-01 06:00:00' from all_events group by source_name, change_type
union all select 'version', null, null, 2.0::double, null""", ["fuel_hist", "gdp_hist", "inc_dim", "all_events"])


@query("history_copy_on_write")
def _history_copy_on_write(i: Inputs) -> DataFrame:
    """The price of every order, in parts; a full snapshot in which the last month differs writes that month's parts again and no other."""
    from costindex.plans import history
    from costindex.sources import fixtures as fxm
    wh = Warehouse(i.spark)
    ledger = Ledger(wh)
    schema = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("month", T.StringType()),
                           T.StructField("price", T.DoubleType()), T.StructField("loaded_at", T.TimestampNTZType())])
    prices = history.Keyed("order_price", ["o_orderkey", "month"], "price", schema, Layout("month", ["o_orderkey"], 4),
                           0.001, Audit(["o_orderkey"], ["o_orderkey", "month", "price"]))
    orders = fxm.table(i.spark, i.sf_dir, "orders").select(
        F.col("o_orderkey").cast("long").alias("o_orderkey"), F.date_format("o_orderdate", "yyyy-MM").alias("month"),
        F.col("o_totalprice").cast("double").alias("price"))
    last = orders.agg(F.max("month").alias("last"))    # one row
    later = orders.join(F.broadcast(last)).select("o_orderkey", "month", (
        F.col("price") + F.when(F.col("month") == F.col("last"), 1.0).otherwise(0.0)).alias("price"))
    for batch, at in ((orders, AT), (later, AT + timedelta(days=1))):
        prepared, _ = history.merge_keyed(ledger, prices, batch, ntz(at))
        ledger.publish([prepared])
    parts = ledger.entries().groupBy(F.substring("part", 2, 7).alias("month")).agg(
        F.min("version").alias("first_version"), F.max("version").alias("last_version"), F.sum("n_rows").alias("n_rows"))
    rows = ledger.read("order_price", schema).groupBy("month").agg(F.sum(F.round(F.col("price") * 100).cast("long")).alias("cents"))
    return rows.join(F.broadcast(parts), "month")


oracle.register_final("history_copy_on_write", """
select month, if(month = last, 2, 1)::bigint as first_version, if(month = last, 2, 1)::bigint as last_version, count(*) as n_rows,
       sum(round((price + if(month = last, 1, 0)) * 100)::bigint)::bigint as cents
from (select strftime(o_orderdate, '%Y-%m') as month, o_totalprice::double as price, max(strftime(o_orderdate, '%Y-%m')) over () as last from orders) x
group by month, last""", [])


# ---- S-5 as a stream ----------------------------------------------------------------------
@query("stream_incremental_load")
def _stream_incremental_load(i: Inputs) -> DataFrame:
    """The landing files loaded by the file-source stream: rows per month in the raw table."""
    from costindex.streaming.incremental import run_incremental_stream
    book = _fresh(i)
    run_incremental_stream(book, "pricecatcher_prices", _landing(i), i.fx("fx_prices").schema,
                           book.wh.path("state", "stream_checkpoint"), AT)
    raw = book.wh.read_partitioned("raw", "pricecatcher_prices")
    return raw.groupBy(F.col("_month_partition").alias("month")).agg(
        F.count(F.lit(1)).alias("rows_in_month"))


oracle.register_final("stream_incremental_load", """
select _month_partition as month, count(*) as rows_in_month from fx_prices group by 1""",
                      ["fx_prices"])


@query("stream_incremental_load_split")
def _stream_incremental_load_split(i: Inputs) -> DataFrame:
    """Every month arrives in two drops, of two files and of one, SPLIT_FILES files a micro-batch: nothing is lost."""
    from costindex.streaming.incremental import run_incremental_stream
    book = _fresh(i)
    prices = i.fx("fx_prices")
    landing = book.wh.path("landing", "split_prices")
    late = F.pmod(F.col("item_code"), F.lit(2)) == 1
    for drop, rows in enumerate((prices.where(~late), prices.where(late))):
        # the first drop has two files a month, so a month is split between the batches of a run
        rows.repartition("_month_partition", F.pmod(F.col("premise_code"), F.lit(2 - drop))).write.mode("append").partitionBy("_month_partition").parquet(landing)
        run_incremental_stream(book, "pricecatcher_prices", landing, prices.schema,
                               book.wh.path("state", "split_checkpoint"), AT + timedelta(days=drop),
                               max_files_per_trigger=SPLIT_FILES)
    raw = book.wh.read_partitioned("raw", "pricecatcher_prices")
    return raw.groupBy(F.col("_month_partition").alias("month")).agg(
        F.count(F.lit(1)).alias("rows_in_month"),
        F.sum(F.round(F.col("price") * 100).cast("long")).alias("cents"))


oracle.register_final("stream_incremental_load_split", """
select _month_partition as month, count(*) as rows_in_month,
       sum(round(price * 100)::bigint)::bigint as cents from fx_prices group by 1""", ["fx_prices"])


# ---- the full run ----------------------------------------------------------------------------
def _landing_sources(i: Inputs, wh: Warehouse, as_of: date) -> dict[str, Source]:
    """Landing files written from the fixtures: static tables and monthly price folders."""
    from costindex.sources.registry import static_parquet
    out = {}
    for name, fx_name in STATIC_FIXTURES.items():
        path = wh.path("landing", f"{name}.parquet")
        i.fx(fx_name).write.parquet(path)
        out[name] = static_parquet(i.spark, name, path)
    out["pricecatcher_prices"] = _prices_source(i, as_of)
    return out


@query("pipeline_full_run")
def _pipeline_full_run(i: Inputs) -> DataFrame:
    """Two full runs (state restored between them): changes per run and the data tests.

    The first run inserts every fuel level, GDP value and income version; the
    second run, a day later on the same sources, finds nothing to change.
    """
    from costindex.plans.pipeline import PipelineConfig, run_pipeline
    from costindex.sources import fixtures as fxm
    first_wh = Warehouse(i.spark)
    sources = _landing_sources(i, first_wh, SECOND_AS_OF)
    cfg = PipelineConfig(services=fxm.SERVICES, food_categories=fxm.FIXTURE_FOOD_CATEGORIES,
                         state_dir=first_wh.path("state", "committed"))
    r1 = run_pipeline(first_wh, sources, AT, cfg)
    second_wh = Warehouse(i.spark)  # a new machine: only the state folder carries over
    r2 = run_pipeline(second_wh, sources, AT + timedelta(days=1), cfg)
    runs = []
    for n, r in ((1, r1), (2, r2)):
        ch = r["changes"].groupBy("source_name", "change_type").agg(
            F.count(F.lit(1)).alias("n"))
        runs.append(ch.select(F.lit(n).alias("run"), F.concat_ws(":", "source_name",
                                                                   "change_type").alias("item"), "n"))
        runs.append(r["tests"].select(F.lit(n).alias("run"), F.col("test_name").alias("item"),
                                      F.col("failures").alias("n")))
    return runs[0].unionByName(runs[1]).unionByName(runs[2]).unionByName(runs[3])


oracle.register_final("pipeline_full_run", """
select 1 as run, 'fuel_prices:INSERT' as item, (select count(*) from rs_melt_levels) as n
union all select 1, 'gdp_quarterly:INSERT', (select count(*) from fx_gdp where value is not null)
union all select 1, 'household_income:' || change_type, count(*) from inc_fold group by change_type
union all select r, t, 0 from (values (1), (2)) a(r),
  (values ('fuel_change_direction'), ('prices_positive'), ('pulse_score_range')) b(t)""",
                      ["rs_melt_levels", "fx_gdp", "inc_fold"])
