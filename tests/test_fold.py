"""The ordered fold against the sequential rule, with keys cut over tasks and chunks."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from costindex.operators import fold


def sequential(rows, rule, start=None):
    """(seq, type, old, new) of the values of one key, row by row."""
    out, state = [], fold.State(start is not None, float("nan") if start is None else start[0])
    for v in rows:
        c = 0.0 if v != v and rule.null_value_as_zero else v
        if not state.present:
            change = "INSERT"
        elif state.value != state.value:
            change = "UPDATE" if not rule.null_state_blocks and v == v else None
        else:
            change = "UPDATE" if abs(state.value - c) > rule.tolerance else None
        if change:
            state.seq += 1
            out.append((state.seq, change, None if change == "INSERT" or state.value != state.value else state.value, None if v != v else v))
            state.present, state.value = True, v
    return out, state


def series(rng, n):
    kind = rng.randrange(4)
    step = {0: lambda x: rng.uniform(0, 20), 1: lambda x: x + rng.uniform(0, 2), 2: lambda x: x + rng.uniform(-1, 1), 3: lambda x: rng.choice([1.0, 1.5, 4.0])}[kind]
    x, out = 10.0, []
    for _ in range(n):
        x = round(step(x), 3)
        out.append(float("nan") if rng.random() < 0.1 else x)
    return out


RULES = [fold.Rule(t, blocks, zero) for t in (0.001, 1.0) for blocks in (False, True) for zero in (False, True)]


@pytest.mark.parametrize("rule", RULES)
def test_functions_of_chunks_compose_to_the_rule(rule):
    rng = random.Random(1)
    for _ in range(60):
        rows = series(rng, rng.randint(1, 60))
        for start in (None, (float("nan"),), (rng.uniform(0, 20),)):
            want, end = sequential(rows, rule, start)
            state = fold.State(start is not None, float("nan") if start is None else start[0])
            lo = 0
            while lo < len(rows):
                hi = lo + rng.randint(1, 12)
                state = fold.applied(rule, state, fold.Rows(rule, np.array(rows[lo:hi])).function())
                lo = hi
            assert state.seq == len(want) and state.present == end.present
            assert state.value == end.value or (state.value != state.value and end.value != end.value)


def _events(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.k, []).append((r._seq, r.change_type, r.old_value, r.new_value))
    return {k: sorted(v) for k, v in out.items()}


@pytest.mark.parametrize("rule", [fold.Rule(0.5, False, False), fold.Rule(1.0, True, True)])
@pytest.mark.parametrize("chunk", [7, fold.CHUNK])
def test_hot_key_in_several_tasks_equals_the_rule(spark, rule, chunk):
    rng = random.Random(chunk)
    hot = series(rng, 4000)
    keys = {"hot": hot, None: series(rng, 700), **{f"k{n}": series(rng, rng.randint(1, 4)) for n in range(300)}}
    starts = {k: None if rng.random() < 0.5 else (rng.choice([float("nan"), 10.0]),) for k in keys}
    none = lambda x: None if x != x else x
    rows = [(k, n, none(v), starts[k] is not None, None if starts[k] is None else none(starts[k][0]), f"{k}/{n}")
            for k, vs in keys.items() for n, v in enumerate(vs)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, n int, v double, p boolean, i double, note string")
    got = fold.deadband_fold(df, ["k"], ["n"], "v", rule.tolerance, carry=["note"], null_state_blocks=rule.null_state_blocks,
                             null_value_as_zero=rule.null_value_as_zero, init_present="p", init_value="i", chunk=chunk)
    want = {k: sequential(vs, rule, starts[k])[0] for k, vs in keys.items()}
    assert _events(got) == {k: e for k, e in want.items() if e}
    assert got.where(~F.col("note").eqNullSafe(F.concat(F.coalesce("k", F.lit("None")), F.lit("/"), "n"))).count() == 0


def test_rows_of_a_hot_key_are_replayed_in_several_tasks(spark):
    df = spark.range(20_000).select(F.lit(1).alias("k"), F.col("id").alias("n"), (F.col("id") % 97).cast("double").alias("v"))
    got = fold.deadband_fold(df, ["k"], ["n"], "v", 0.5, chunk=500)
    assert got.count() == 20_000
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    try:
        tasks = got.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    finally:
        spark.conf.set(coalesce, "true")
    assert len(tasks) > 2 and max(r["count"] for r in tasks) < 15_000
    assert got.agg(F.max("_seq"), F.countDistinct("_seq")).first() == (20_000, 20_000)


def test_no_rows(spark):
    df = spark.createDataFrame([], "k string, n int, v double")
    got = fold.deadband_fold(df, ["k"], ["n"], "v", 0.5)
    assert got.collect() == [] and got.columns == ["k", "n", "old_value", "new_value", "change_type", "_seq"]
