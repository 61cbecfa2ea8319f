import datetime as dt

from pyspark.sql import functions as F

from costindex.operators.cdc import keyed_changes, merge_history
from costindex.operators.scd2 import as_of, empty_dim, scd2_apply


def run_date():
    return F.lit("2026-02-01").cast("date")


def test_repeated_key_in_one_batch_is_insert_then_update(spark):
    batch = spark.createDataFrame([("k", 1, 10.0), ("k", 2, 10.0005), ("k", 3, 12.0), ("j", 1, 5.0)],
                                  "key string, seq int, price double")
    prev = spark.createDataFrame([("j", 5.0)], "key string, price double")
    ev = keyed_changes(batch, prev, ["key"], "price", 0.001, order_by=["seq"]).orderBy("key", "_seq")
    got = [(r.key, r.change_type, r.old_value, r.new_value) for r in ev.collect()]
    assert got == [("k", "INSERT", None, 10.0), ("k", "UPDATE", 10.0, 12.0)]


def test_tolerance_and_null_previous(spark):
    batch = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 3.0), ("d", 4.0)], "key string, v double")
    prev = spark.createDataFrame([("a", 1.0005), ("b", 2.5), ("c", None)], "key string, v double")
    ev = {r.key: r.change_type for r in keyed_changes(batch, prev, ["key"], "v", 0.001).collect()}
    assert ev == {"b": "UPDATE", "c": "UPDATE", "d": "INSERT"}


def test_second_run_on_same_input_gives_no_events_and_unique_keys(spark):
    batch = spark.createDataFrame([(dt.date(2024, 1, d), "RON95", 2.0 + d / 100) for d in range(1, 20)],
                                  "date_effective date, fuel_type string, price double")
    empty = spark.createDataFrame([], "date_effective date, fuel_type string, price double, "
                                      "loaded_at timestamp_ntz")
    stamp = F.lit("2026-02-01 06:00:00").cast("timestamp_ntz")
    keys = ["date_effective", "fuel_type"]
    ch1 = keyed_changes(batch, empty, keys, "price", 0.001)
    hist = merge_history(empty, ch1, keys, "price", "loaded_at", stamp)
    assert ch1.count() == 19 and hist.count() == 19
    ch2 = keyed_changes(batch, hist, keys, "price", 0.001)
    assert ch2.count() == 0
    hist2 = merge_history(hist, ch2, keys, "price", "loaded_at", stamp)
    assert hist2.groupBy(*keys).count().where("count > 1").count() == 0


def _survey(spark, rows):
    return spark.createDataFrame(rows, "state string, year int, income_median double, income_mean double")


def test_scd2_fold_literals(spark):
    # 100, 100.5 (small change), 300, null (counts as 0), 500 (null current blocks)
    s = _survey(spark, [("S", 2000 + i, v, 1.0) for i, v in enumerate([100.0, 100.5, 300.0, None, 500.0])])
    dim, changes = scd2_apply(s, empty_dim(spark), run_date())
    versions = [(r.income_median, r.survey_year, r.is_current) for r in dim.orderBy("version").collect()]
    assert versions == [(100.0, 2000, False), (300.0, 2002, False), (None, 2003, True)]
    assert [r.change_type for r in changes.orderBy("_seq").collect()] == ["INSERT", "UPDATE", "UPDATE"]


def test_scd2_golden_traces(spark):
    traces = {"Sabah": [309, 493, 749, 726], "Sarawak": [260, 365, 660, 754, 819],
              "W.P. Kuala Lumpur": [645, 1217, 1180]}
    rows = [(g, 2000 + i, float(v), None) for g, vs in traces.items() for i, v in enumerate(vs)]
    rows.append(("Terengganu", 2000, None, None))
    rows.append(("Terengganu", 2001, 900.0, None))
    _, changes = scd2_apply(_survey(spark, rows), empty_dim(spark), run_date())
    got = {}
    for r in changes.orderBy("geography", "_seq").collect():
        got.setdefault(r.geography, []).append((r.change_type, r.old_value, r.new_value))
    for g, vs in traces.items():
        want = [("INSERT", None, float(vs[0]))] + [("UPDATE", float(a), float(b)) for a, b in zip(vs, vs[1:])]
        assert got[g] == want
    assert got["Terengganu"] == [("INSERT", None, None)]


def test_scd2_older_survey_ignored_and_one_current(spark):
    first, _ = scd2_apply(_survey(spark, [("A", 2010, 100.0, 1.0), ("B", 2010, 50.0, 1.0)]),
                          empty_dim(spark), run_date())
    first = spark.createDataFrame(first.collect(), first.schema)
    second, ch = scd2_apply(_survey(spark, [("A", 2005, 900.0, 1.0), ("A", 2012, 200.0, 2.0),
                                            ("B", 2011, 50.5, 1.0)]), first, run_date())
    assert [(r.geography, r.change_type) for r in ch.collect()] == [("A", "UPDATE")]
    cur = {r.geography: (r.income_median, r.version) for r in second.where("is_current").collect()}
    assert cur == {"A": (200.0, 2), "B": (50.0, 1)}
    assert {r.geography: r.survey_year for r in as_of(second, 2011).collect()} == {"A": 2010, "B": 2010}


def test_deletes_are_optional_and_leave_the_history(spark):
    batch = spark.createDataFrame([("a", 1.0)], "key string, v double")
    prev = spark.createDataFrame([("a", 1.0, None), ("b", 2.0, None)], "key string, v double, t timestamp_ntz")
    assert keyed_changes(batch, prev.drop("t"), ["key"], "v", 0.001).count() == 0
    ev = keyed_changes(batch, prev.drop("t"), ["key"], "v", 0.001, emit_deletes=True)
    assert [(r.key, r.change_type, r.old_value) for r in ev.collect()] == [("b", "DELETE", 2.0)]
    hist = merge_history(prev, ev, ["key"], "v", "t", F.lit(None).cast("timestamp_ntz"))
    assert [r.key for r in hist.collect()] == ["a"]


def test_heal_nulls_option(spark):
    s = _survey(spark, [("S", 2000, None, None), ("S", 2001, 400.0, None)])
    _, strict = scd2_apply(s, empty_dim(spark), run_date())
    _, healed = scd2_apply(s, empty_dim(spark), run_date(), heal_nulls=True)
    assert strict.count() == 1
    assert [r.change_type for r in healed.orderBy("_seq").collect()] == ["INSERT", "UPDATE"]


def test_repeated_keys_follow_file_order_and_nan_is_no_value(spark):
    from costindex.plans import capture
    from costindex.plans.pipeline import FUEL_HISTORY
    from costindex.sources.tables import Warehouse
    wh = Warehouse(spark)
    nan = float("nan")
    raw = wh.write_snapshot("raw", "fuel", spark.createDataFrame(
        [("level", "2024-01-01", 3.0), ("level", "2024-01-01", 2.0), ("level", "2024-01-08", nan)],
        "series_type string, date string, ron95 double").coalesce(1))
    keep = lambda name, df: wh.write_snapshot("warehouse", name, df)
    from pyspark.sql import functions as F
    stamp = F.lit("2026-01-01 00:00:00").cast("timestamp_ntz")
    got = capture.capture_fuel(capture.in_file_order(raw), spark.createDataFrame([], FUEL_HISTORY), stamp, keep, capture.FILE_ORDER)
    assert sorted((e.change_type, e.old_value, e.new_value) for e in got.events.collect()) == [("INSERT", None, "3.0"), ("UPDATE", "3.0", "2.0")]
    assert [r.price for r in got.table.collect()] == [2.0]


def test_null_numeric_keys_are_one_key(spark):
    from costindex.operators.fold import deadband_fold
    rows = spark.createDataFrame([(None, 1, 1.0), (None, 2, 5.0), (7, 1, 1.0)], "k int, t int, v double")
    got = deadband_fold(rows, ["k"], ["t"], "v", 0.5).collect()
    assert sorted((r.k is None, r.change_type) for r in got) == [(False, "INSERT"), (True, "INSERT"), (True, "UPDATE")]


def test_repeated_keys_need_an_order(spark):
    import pytest
    batch = spark.createDataFrame([("k", 3.0), ("k", 2.0)], "key string, v double")
    prev = spark.createDataFrame([], "key string, v double")
    with pytest.raises(ValueError, match="repeat"):
        keyed_changes(batch, prev, ["key"], "v", 0.001)


def test_unique_keys_plan_no_window_and_no_python(spark):
    batch = spark.range(100).selectExpr("cast(id as string) key", "cast(id as double) v")
    prev = spark.createDataFrame([], "key string, v double")
    plan = keyed_changes(batch, prev, ["key"], "v", 0.001)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "MapInArrow" not in plan


def test_null_keys_that_repeat_are_one_key(spark):
    batch = spark.createDataFrame([(None, 1, 1.0), (None, 2, 5.0), ("a", 3, 1.0)], "key string, n int, v double")
    prev = spark.createDataFrame([], "key string, v double")
    got = keyed_changes(batch, prev, ["key"], "v", 0.001, order_by=["n"]).collect()
    assert sorted((r.key is None, r.change_type) for r in got) == [(False, "INSERT"), (True, "INSERT"), (True, "UPDATE")]


def test_survey_rows_of_one_year_follow_the_file(spark):
    rows = [("A", 2010, 500.0, 1.0, 0), ("A", 2010, 100.0, 1.0, 1)]
    s = spark.createDataFrame(rows, "state string, year int, income_median double, income_mean double, _row int")
    dim, _ = scd2_apply(s, empty_dim(spark), run_date(), order_by=["_row"])
    assert [r.income_median for r in dim.orderBy("version").collect()] == [500.0, 100.0]


def test_as_of_join_takes_the_version_in_force(spark):
    from costindex.operators.scd2 import DIM_SCHEMA, as_of_join
    day = dt.date(2026, 1, 1)
    versions = [("A", 2010, 1.0, 1), ("A", 2012, 2.0, 2), ("A", 2012, 3.0, 3), ("A", 2020, 4.0, 4), ("B", 2015, 9.0, 1)]
    dim = spark.createDataFrame([(g, "state", None, m, y, day, None, False, v) for g, y, m, v in versions], DIM_SCHEMA)
    asked = [("A", 2009), ("A", 2010), ("A", 2011), ("A", 2012), ("A", 2019), ("A", 2030), ("B", 2014), ("B", 2016), ("C", 2016), (None, 2016), ("A", None)]
    rows = spark.createDataFrame(asked, "geo string, year int")
    got = {(r.geo, r.year): r.income_median for r in as_of_join(rows, dim, "geo", "year").collect()}
    assert got == {("A", 2009): None, ("A", 2010): 1.0, ("A", 2011): 1.0, ("A", 2012): 3.0, ("A", 2019): 3.0, ("A", 2030): 4.0,
                   ("B", 2014): None, ("B", 2016): 9.0, ("C", 2016): None, (None, 2016): None, ("A", None): None}
    assert as_of_join(rows.limit(0), dim, "geo", "year").collect() == []
