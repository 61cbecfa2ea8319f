"""Physical plan checks: the properties the design relies on at scale."""

from costindex.plans.queries import Inputs
from costindex.session import stage_table
from conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_star_join_broadcasts_dimensions_and_prunes_the_fact(spark):
    plan = _plan(Inputs(spark, SF_SMALL).stg_prices)
    assert "SortMergeJoin" not in plan
    assert plan.count("BroadcastHashJoin") >= 2
    # the fact scan reads only the five columns it uses
    fact = [line for line in plan.splitlines() if "lineitem" in line and "FileScan" in line][0]
    assert "l_quantity" not in fact and "l_orderkey" not in fact
    assert "PushedFilters" in plan


def test_a_hot_key_is_not_shuffled_when_its_dimension_is_above_the_limit(spark):
    from costindex.operators.joins import split_hot_join, star_join
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = stage_table(spark.range(30_000).selectExpr("if(id % 3 = 0, 5, if(id % 100 = 1, null, id % 4000)) as k", "id as v"))
        dim = stage_table(spark.range(3000).selectExpr("id as d", "concat('name ', id) as name"))
        want = sorted((r.k, r.v, f"name {r.k}") for r in fact.where("k < 3000").collect())
        out = star_join(fact, [(dim, "k", "d")], max_broadcast_bytes=4096)
        assert sorted(map(tuple, out.select("k", "v", "name").collect())) == want
        plan = _plan(out)
        assert plan.count("SortMergeJoin") == 1 and "BroadcastHashJoin" in plan and "Union" in plan
        for limit in (4096, 1 << 30):  # one name for both keys: one column comes back
            same = star_join(fact, [(dim.withColumnRenamed("d", "k"), "k", "k")], max_broadcast_bytes=limit)
            assert same.columns == ["k", "v", "name"] and sorted(map(tuple, same.collect())) == want
        # a dimension that repeats the hot key too often falls back to the shuffle join
        wide = dim.unionByName(spark.range(2000).selectExpr("5L as d", "concat('other ', id) as name"))
        plain = split_hot_join(fact.where("v < 300"), wide, "k", "d", max_broadcast_bytes=4096)
        assert "Union" not in _plan(plain.select("k")).split("SortMergeJoin")[0]
        assert plain.where("k = 5").count() == 2001 * fact.where("v < 300 and k = 5").count()
        assert star_join(fact.limit(0), [(dim, "k", "d")], max_broadcast_bytes=4096).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _window_partitions(plan: str) -> list[str]:
    """The partition list of every Window node, e.g. '[month#1]' (empty: '[]')."""
    import re
    out = []
    for line in plan.splitlines():
        body = line.lstrip(" :+-*()0-9")
        if body.startswith("Window ["):
            depth, i = 0, len("Window ")
            for i in range(len("Window "), len(body)):  # skip the expression list
                depth += {"[": 1, "]": -1}.get(body[i], 0)
                if depth == 0:
                    break
            m = re.match(r", (\[[^\]]*\])", body[i + 1:])
            out.append(m.group(1) if m else "[]")  # a global window prints no lists
    return out


def test_score_has_no_single_partition_window(spark):
    from costindex.plans import marts
    from costindex.sources.fixtures import FIXTURE_FOOD_CATEGORIES
    i = Inputs(spark, SF_SMALL)
    # the frames before they are stored: the score itself reads stored tables
    signals = marts.combined_signals(i.price_summary, marts.fuel_timeline(i.stg_fuel), i.stg_cpi,
                                     i.stg_transport, i.stg_vehicles, FIXTURE_FOOD_CATEGORIES)
    parts = _window_partitions(_plan(signals))
    assert parts, "expected the quantile and lag windows"
    assert "[]" not in parts
    assert "[]" not in _window_partitions(_plan(i.score))


def test_score_reads_the_stored_signals_only(spark):
    plan = Inputs(spark, SF_SMALL).score._jdf.queryExecution().optimizedPlan().toString()
    assert "l_extendedprice" not in plan and "o_totalprice" not in plan


def test_price_summary_reads_the_fact_once(spark):
    from costindex.operators.aggregates import group_profile
    i = Inputs(spark, SF_SMALL)
    staged = group_profile(i.stg_prices, ["month", "state", "item_category"], "price",
                           quantiles={"q": 0.5}, distinct={"p": "premise_code"})
    plan = _plan(staged)
    assert "lineitem" not in plan and "Expand" not in plan and "Generate" not in plan


def test_quantiles_run_no_job_while_they_are_planned(spark):
    from costindex.operators.quantiles import exact_quantiles
    df = spark.range(1000).selectExpr("id % 7 as k", "id * 1.0d as v", "raise_error('evaluated') as e")
    failing = df.withColumn("v", df["v"] + df["e"].cast("double"))
    exact_quantiles(failing, ["k"], "v", {"m": 0.5})
    exact_quantiles(failing, ["k"], "v", {"m": 0.5}, max_values_per_task=10)


def _small_heap(monkeypatch, heap: int):
    """Bounds as of a driver with ``heap`` bytes."""
    from costindex.operators import joins
    monkeypatch.setattr(joins, "driver_bound", lambda df, max_bytes: min(max_bytes, heap // joins.DRIVER_SHARE))


def test_a_dimension_that_its_file_compresses_well_is_not_broadcast_above_the_driver_share(spark, monkeypatch):
    """The rows count, not the file: dictionary-coded columns take many times its size."""
    from costindex.operators.joins import DEFAULT_BROADCAST_BYTES, DRIVER_SHARE, driver_bound, estimated_bytes, star_join
    dim = stage_table(spark.range(0, 200_000, 1, 1).selectExpr(
        "id as d", *[f"concat('a text that repeats in column {c}, number ', id % 50) as c{c}" for c in range(6)]))
    fact = stage_table(spark.range(3000).selectExpr("id * 7 as k", "id as v"))
    heap = int(spark.sparkContext._jvm.java.lang.Runtime.getRuntime().maxMemory())
    assert driver_bound(dim, DEFAULT_BROADCAST_BYTES) == min(DEFAULT_BROADCAST_BYTES, heap // DRIVER_SHARE)
    assert "BroadcastHashJoin" in _plan(star_join(fact, [(dim, "k", "d")]))
    bound = 32 << 20    # the rows take 65 MB, the file below 1 MB
    assert estimated_bytes(dim) < bound // 8
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")    # the file's size is below Spark's own limit too
    try:
        for out in (star_join(fact, [(dim, "k", "d")], max_broadcast_bytes=bound), None):
            if out is None:
                _small_heap(monkeypatch, bound * DRIVER_SHARE)
                out = star_join(fact, [(dim, "k", "d")])
            plan = _plan(out)
            assert plan.count("SortMergeJoin") == 1, plan
            got = out.select("k", "v", "c3").collect()
            assert sorted((r.k, r.v, r.c3) for r in got) == [
                (7 * v, v, f"a text that repeats in column 3, number {7 * v % 50}") for v in range(3000)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_customers_above_the_driver_share_are_not_broadcast_by_their_file_size(spark, monkeypatch, tmp_path):
    from costindex.sources import fixtures
    spark.range(2000).selectExpr("id as o_orderkey", "id % 900 as o_custkey", "timestamp'1996-02-03' as o_orderdate", "id * 1.0d as o_totalprice",
                                 "'1-URGENT' as o_orderpriority").write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(1000).selectExpr("id as c_custkey", "cast(id % 5 as int) as c_nationkey", "'AUTOMOBILE' as c_mktsegment").write.parquet(
        f"{tmp_path}/customer.parquet")
    want = "BroadcastHashJoin", "SortMergeJoin"
    for heap, (yes, no) in ((1 << 34, want), (16 << 10, want[::-1])):
        _small_heap(monkeypatch, heap)
        out = fixtures.vehicles(spark, str(tmp_path))
        plan = _plan(out)
        assert yes in plan and no not in plan
        assert [tuple(r)[1:] for r in out.collect()] == [("AUTOMOBILE", "Electric", 2000)]
