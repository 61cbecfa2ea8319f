import math

from pyspark.sql import functions as F

from costindex.functions import (collapse_whitespace, interpolate, label_lookup, py_str_double,
                                 round_half_away, safe_ratio, to_int_half_even)


def _one(spark, expr, value, schema="x double"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first().r


def test_round_on_binary_value(spark):
    # 1.005 is 1.00499999999999989... in binary, so it rounds down; .125 is exact and rounds away
    cases = {1.005: 1.0, 2.675: 2.68, 0.125: 0.13, -2.675: -2.68, 27640.345: 27640.35}
    for x, want in cases.items():
        assert _one(spark, round_half_away("x", 2), x) == want, x


def test_round_matches_std_round_on_many_halves(spark):
    vals = [(k + 0.5) / 100.0 for k in range(0, 20000, 7)] + [k / 1000.0 for k in range(1, 3000, 3)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r.r for r in df.select(round_half_away("x", 2).alias("r")).collect()]
    for v, g in zip(vals, got):
        a = abs(v) * 100.0
        f = math.floor(a)
        want = math.copysign((f + (1.0 if a - f >= 0.5 else 0.0)) / 100.0, v)
        assert g == want, v


def test_first_whitespace_run_only(spark):
    assert _one(spark, collapse_whitespace("x"), "a  b   c", "x string") == "a b   c"
    assert _one(spark, collapse_whitespace("x"), "  a  b", "x string") == " a  b"
    assert _one(spark, collapse_whitespace("x", all_runs=True), "a  b \t\n c", "x string") == "a b c"
    assert _one(spark, collapse_whitespace("x"), "abc", "x string") == "abc"


def test_double_to_int_half_even(spark):
    assert [_one(spark, to_int_half_even("x"), v) for v in (10.5, 11.5, -2.5, 2.4)] == [10, 12, -2, 2]


def test_python_float_text(spark):
    for v in (309.0, 0.0005, 5e-05, 12345678.9, 1e16, 1.5e-05, 0.30000000000000004, -0.0, 123.45):
        assert _one(spark, py_str_double("x"), v) == str(v)
    assert _one(spark, py_str_double("x"), None) is None


def test_safe_ratio_and_labels(spark):
    df = spark.createDataFrame([(1, 0), (1, 4)], "a int, b int")
    assert [r.r for r in df.select(safe_ratio("a", "b").alias("r")).collect()] == [None, 0.25]
    df = spark.createDataFrame([("AYAM",), ("OTHER",)], "c string")
    got = [r.r for r in df.select(label_lookup("c", {"AYAM": "Chicken"}).alias("r")).collect()]
    assert got == ["Chicken", "OTHER"]


def test_interpolate_single_rounding(spark):
    rows = [(1.0, 1.02, 0.25), (27640.34, 27640.35, 0.5), (3.3, 7.7, 0.75), (5.0, 5.0, 0.25)]
    df = spark.createDataFrame(rows, "lo double, hi double, f double")
    got = [r.r for r in df.select(interpolate("lo", "hi", "f").alias("r")).collect()]
    want = [lo if (f == 0 or lo == hi) else math.fma(lo, 1 - f, hi * f) for lo, hi, f in rows]
    assert got == want
