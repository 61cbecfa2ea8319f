"""Catalog queries against their DuckDB oracle on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL

FAST = ["fn_first_ws", "fn_round_parity", "stg_prices", "stg_transport", "stg_vehicles", "stg_cpi",
        "join_star", "mart_price_summary", "cdc_value", "cdc_append", "cdc_scd2", "scd2_as_of",
        "mart_fuel_timeline", "mart_score", "rep_heatmap", "rep_change_log", "src_month_window"]


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = []
    for r in rows:
        t = []
        for i in order:
            v = r[i]
            if isinstance(v, float):
                v = None if math.isnan(v) else round(v, 6)
            elif hasattr(v, "isoformat"):
                v = str(v)[:19]
            t.append(v)
        out.append(tuple(t))
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]:
        c.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    from costindex.plans.oracle import sql_all
    from costindex.plans.queries import registry
    assert set(sql_all()) == set(registry())
    assert set(sql_all()) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    cur = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _norm([tuple(r) for r in df.collect()], df.columns) == _norm(cur.fetchall(), ocols)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and "pulse_score" in df.columns
