from pyspark.sql import functions as F

from costindex.operators import quality
from costindex.operators.joins import keyed_outer_chain
from costindex.operators.windows import minmax_scale
from costindex.plans import marts


def _sig(spark, name, months):
    return spark.createDataFrame([(m, float(m)) for m in months], f"month int, {name} double")


def test_outer_chain_keeps_anchor_months_only(spark):
    frames = [_sig(spark, "food", [2]), _sig(spark, "fuel", [1, 2]), _sig(spark, "cpi", [1, 2, 3]),
              _sig(spark, "transport", [1, 3, 9]), _sig(spark, "ev", [9])]
    out = keyed_outer_chain(frames, "month", anchors=3).orderBy("month").collect()
    assert [r.month for r in out] == [1, 2, 3]
    assert [r.transport for r in out] == [1.0, None, 3.0]


def test_flat_signal_is_neutral_and_score_banded(spark):
    rows = [("2024-01", 1.0, 5.0, 1.0, 10, 0.1), ("2024-02", 2.0, 5.0, 3.0, 20, 0.3)]
    df = spark.createDataFrame(rows, "month string, national_food_median double, ron95_price double, "
                                     "avg_cpi double, total_ridership long, ev_share double")
    scored = marts.pulse_score(marts.normalised_signals(df)).orderBy("month").collect()
    # month 1: food 0, cpi 0, fuel flat -> 0.5, transport inverse 1, ev inverse 1
    assert scored[0].pulse_score == round((0.5 * 0.15 + 0.10 + 0.10) * 100, 1)
    assert scored[0].pressure_label == "Low Pressure"
    assert scored[1].pulse_score == round((0.35 + 0.30 + 0.5 * 0.15) * 100, 1)
    assert scored[1].pressure_label == "High Pressure"


def test_minmax_inverse(spark):
    df = spark.createDataFrame([(1, 10.0), (2, 20.0), (3, None)], "k int, x double")
    out = {r.k: (r.s, r.i) for r in minmax_scale(df, {"s": ("x", False), "i": ("x", True)}).collect()}
    assert out == {1: (0.0, 1.0), 2: (1.0, 0.0), 3: (None, None)}


def test_single_row_group_has_null_stddev(spark):
    df = spark.createDataFrame(
        [("2024-01", 1, "S", "C", 5, 7, 2.5)],
        "price_date string, item_code int, state string, item_category string, premise_code int, x int, price double"
    ).withColumn("month", F.lit("2024-01"))
    r = marts.price_summary(df).first()
    assert r.sample_count == 1 and r.price_stddev is None and r.median_price == 2.5
    assert r.prev_median_price is None and r.mom_pct_change is None


def test_data_tests_fire_on_corrupted_input(spark):
    t = spark.createDataFrame([("UP", 1.0), ("SIDEWAYS", -1.0), (None, 200.0)], "d string, v double")
    assert quality.accepted_values(t, "d", ["UP", "DOWN", "UNCHANGED", "FIRST"]).count() == 1
    assert quality.positive(t, "v").count() == 1
    assert quality.outside_range(t, "v", 0, 100).count() == 2
    assert quality.duplicate_keys(t.union(t), ["d"]).count() == 3
    assert quality.nulls_in(t, ["d"]).count() == 1
    s = quality.summary("x", t, quality.not_positive("v")).first()
    assert (s.rows_checked, s.failures) == (3, 1)


def test_bucketed_lag_equals_plain_lag(spark):
    import random
    from pyspark.sql import Window
    from costindex.operators.windows import with_previous_bucketed
    rnd = random.Random(3)
    rows = [(rnd.choice(["A", "B", None]), d, float(rnd.randint(1, 50))) for d in rnd.sample(range(5000), 600)]
    df = spark.createDataFrame(rows, "k string, t int, v double")
    plain = df.withColumn("p", F.lag("v").over(Window.partitionBy("k").orderBy("t")))
    bucketed = with_previous_bucketed(df, ["k"], "t", "v", "p", F.floor(F.col("t") / 97))
    assert plain.exceptAll(bucketed.select(*plain.columns)).count() == 0
    assert bucketed.count() == 600
