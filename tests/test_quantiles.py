import math
import random

import pytest

from costindex.operators.aggregates import distinct_counts, group_profile
from costindex.operators.quantiles import exact_quantiles


def brute(values, p):
    vs = sorted(v for v in values if v is not None)
    if not vs:
        return None
    pos = (len(vs) - 1) * p
    lo, hi = vs[math.floor(pos)], vs[math.ceil(pos)]
    d = pos - math.floor(pos)
    return lo if (d == 0 or lo == hi) else math.fma(lo, 1 - d, hi * d)


@pytest.mark.parametrize("max_values", [2_000_000, 40])
def test_exact_quantiles_match_brute_force(spark, max_values):
    rnd = random.Random(7)
    rows = []
    for g in range(60):
        for _ in range(rnd.randint(1, 40)):
            rows.append((g % 4 if g % 3 else None, g, rnd.choice([None] + [round(rnd.uniform(1, 30), 2)] * 9)))
    for _ in range(3000):  # one hot group holding most rows
        rows.append((1, 999, round(rnd.uniform(1, 500), 2)))
    df = spark.createDataFrame(rows, "a int, g int, v double")
    probs = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    got = {(r.a, r.g): r for r in exact_quantiles(df, ["a", "g"], "v", probs,
                                                  max_values_per_task=max_values).collect()}
    groups = {}
    for a, g, v in rows:
        groups.setdefault((a, g), []).append(v)
    for k, vals in groups.items():
        if all(v is None for v in vals):
            assert k not in got
            continue
        for name, p in probs.items():
            assert getattr(got[k], name) == brute(vals, p), (k, name)


def test_distinct_counts(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "a", 2), (1, "b", 2), (2, "c", None)],
                               "k int, x string, y int")
    got = {r.k: (r.nx, r.ny) for r in distinct_counts(df, ["k"], {"nx": "x", "ny": "y"}).collect()}
    assert got == {1: (2, 2), 2: (1, None)}


def test_wide_groups_of_any_spread(spark):
    rnd = random.Random(11)
    draws = {
        "many": lambda: round(rnd.uniform(-500, 500), 4),
        "scales": lambda: rnd.choice([-1, 1]) * 10.0 ** rnd.uniform(-300, 300),
        "outlier": lambda: rnd.choice([1e300, -1e300] + [1e9 + rnd.random()] * 400),
        None: lambda: rnd.choice([0.0, -0.0, math.inf, -math.inf, 5e-324] + [rnd.gauss(0, 1)] * 40)}
    rows = [(g, draw()) for g, draw in draws.items() for _ in range(1500)]
    probs = {"least": 0.0, "p50": 0.5, "p99": 0.99, "most": 1.0}
    got = {r.g: r for r in exact_quantiles(spark.createDataFrame(rows, "g string, v double"), ["g"], "v", probs,
                                           max_values_per_task=20).collect()}
    for g in draws:
        for k, p in probs.items():
            assert getattr(got[g], k) == brute([v for h, v in rows if h == g], p), (g, k)


def test_values_look_up_no_list_of_bounds(spark):
    """A value's cost must not grow with its group's buckets: no array of bounds is searched for each row."""
    df = spark.range(10).selectExpr("id % 2 as g", "double(id) as v")
    plan = exact_quantiles(df, ["g"], "v", {"p50": 0.5}, max_values_per_task=3)._jdf.queryExecution().optimizedPlan().toString()
    assert "filter(" not in plan and "collect_list" not in plan


@pytest.mark.parametrize("max_group_rows", [100, 1_000_000])
def test_group_profile_of_small_and_large_groups(spark, max_group_rows):
    rnd = random.Random(3)
    rows = [(g, rnd.choice([None, float("nan"), 0.0, -0.0] + [round(rnd.uniform(-9, 9), 2)] * 9), rnd.choice([None, *range(30)]),
             rnd.choice(["a", "b", None])) for g, n in (("large", 400), (None, 300), ("small", 7), ("one", 1)) for _ in range(n)]
    rows += [("empty", None, None, None)] * 3
    got = group_profile(spark.createDataFrame(rows, "g string, v double, a int, b string"), ["g"], "v", {"q1": 0.25, "q2": 0.5},
                        {"na": "a", "nb": "b"}, max_group_rows=max_group_rows).collect()
    assert len(got) == 5
    for r in got:
        mine = [x for x in rows if x[0] == r.g]
        assert (r.n, r.na, r.nb) == (len(mine), *[len({x[k] for x in mine} - {None}) for k in (2, 3)])
        values = [math.inf if math.isnan(x[1]) else x[1] for x in mine if x[1] is not None]  # NaN is the greatest
        for q, p in ((r.q1, 0.25), (r.q2, 0.5)):
            assert q == brute(values, p) and (q != 0 or math.copysign(1, q) == 1)


def test_group_profile_shuffles_the_rows_of_small_groups_once(spark):
    from costindex.operators.aggregates import _sorted_measures
    rows = spark.range(10).selectExpr("id % 2 as g", "double(id) as _x", "id as a", "id as b")
    plan = _sorted_measures(rows, ["g"], {"q": 0.5}, {"na": "a", "nb": "b"})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
