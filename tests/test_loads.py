from datetime import date, datetime

from pyspark.sql import functions as F

from costindex.sources import loader, state
from costindex.sources.meta import RunBook
from costindex.sources.registry import last_n_months, monthly_parquet
from costindex.sources.tables import Warehouse

from conftest import SF_SMALL


def test_last_n_months_excludes_current():
    assert last_n_months(date(2024, 1, 15), 3) == ["2023-10", "2023-11", "2023-12"]


def _landing(spark, wh):
    from costindex.sources import fixtures
    path = wh.path("landing", "prices")
    fixtures.prices(spark, SF_SMALL).write.partitionBy("_month_partition").parquet(path)
    return path + "/_month_partition={month}"


def test_incremental_equals_full_load(spark):
    wh_a, wh_b = Warehouse(spark), Warehouse(spark)
    tpl = _landing(spark, wh_a)
    months = last_n_months(date(2001, 12, 1), 36)
    a, b = RunBook(wh_a), RunBook(wh_b)
    loader.load_monthly(a, monthly_parquet("p", tpl, months[:20]), datetime(2026, 1, 1))
    loader.load_monthly(a, monthly_parquet("p", tpl, months), datetime(2026, 1, 2))
    loader.load_monthly(b, monthly_parquet("p", tpl, months), datetime(2026, 1, 2))
    ta = wh_a.read_partitioned("raw", "p")
    tb = wh_b.read_partitioned("raw", "p")
    assert ta.count() == tb.count() > 0
    assert ta.exceptAll(tb).count() == 0
    assert a.watermark("p").last_max_date == b.watermark("p").last_max_date == months[-1]


def test_failed_month_is_skipped_and_logged(spark):
    wh = Warehouse(spark)
    tpl = _landing(spark, wh)
    book = RunBook(wh)
    src = monthly_parquet("p", tpl, ["1990-01", "1996-01"])
    assert loader.load_monthly(book, src, datetime(2026, 1, 1)) == "success"
    assert book.watermark("p").last_max_date == "1996-01"
    assert loader.load_monthly(book, src, datetime(2026, 1, 2)) == "skipped"


def test_state_roundtrip_and_guard(spark):
    wh = Warehouse(spark)
    book = RunBook(wh)
    book.log_run("s", datetime(2026, 1, 1), "success", 1, 1)
    wh.write_snapshot("warehouse", "gdp_quarterly",
                      spark.createDataFrame([("2024-01", "x", 1.0)], "quarter string, series string, value double"))
    sd = wh.path("state", "s")
    exported = dict(state.export_state(wh, sd))
    assert exported["meta.pipeline_runs"] == 1 and exported["meta.change_log"] is None
    target = Warehouse(spark)
    RunBook(target).log_run("other", datetime(2026, 1, 1), "success")
    res = {t: (a, n) for t, a, n in state.import_state(target, sd)}
    assert res["meta.pipeline_runs"] == ("kept_local", 1)
    assert res["warehouse.gdp_quarterly"] == ("restored", 1)
    assert res["meta.change_log"][0] == "no_state_file"


def test_retry_gaps_loads_a_month_that_failed_before(spark):
    wh = Warehouse(spark)
    tpl = _landing(spark, wh)
    book = RunBook(wh)
    real = monthly_parquet("p", tpl, ["1996-01", "1996-02", "1996-03"])
    broken = monthly_parquet("p", tpl, ["1996-01", "1996-03"])  # 1996-02 failed this run
    loader.load_monthly(book, broken, datetime(2026, 1, 1))
    assert loader.load_monthly(book, real, datetime(2026, 1, 2)) == "skipped"  # parity: gap kept
    assert loader.load_monthly(book, real, datetime(2026, 1, 3), retry_gaps=True) == "success"
    months = {r[0] for r in wh.read_partitioned("raw", "p").select("_month_partition").distinct().collect()}
    assert months == {"1996-01", "1996-02", "1996-03"}
    assert book.watermark("p").last_max_date == "1996-03"


def test_failed_snapshot_write_is_ignored_and_retried(spark):
    wh = Warehouse(spark)
    df = spark.createDataFrame([(1,)], "x int")
    wh.write_snapshot("warehouse", "t", df)
    # a crashed write: folder without the commit marker
    spark.createDataFrame([(7,)], "x int").write.parquet(wh.path("warehouse", "t") + "/v=000002/part")
    assert [r.x for r in wh.read("warehouse", "t").collect()] == [1]
    wh.write_snapshot("warehouse", "t", spark.createDataFrame([(2,)], "x int"))
    assert [r.x for r in wh.read("warehouse", "t").collect()] == [2]


def test_subset_of_sources_and_unknown_kinds(spark, capsys):
    from costindex.sources.registry import STATIC, Source
    book = RunBook(Warehouse(spark))
    sources = {"a": Source("a", STATIC, reader=lambda: spark.range(3)),
               "b": Source("b", STATIC, reader=lambda: spark.range(4)),
               "c": Source("c", "web page")}
    assert loader.run_all(book, sources, datetime(2026, 1, 1), only=["b", "c"]) == {"b": "success"}
    assert "unknown source type" in capsys.readouterr().err
    assert not book.wh.has_table("raw", "a") and book.wh.row_count("raw", "b") == 4


def test_whole_error_text_is_kept(spark):
    from costindex.sources.registry import STATIC, Source
    text = "first line\n" + "x" * 2000

    def broken():
        raise ValueError(text)

    book = RunBook(Warehouse(spark))
    assert loader.load_static(book, Source("a", STATIC, reader=broken), datetime(2026, 1, 1)) == "failed"
    assert book.runs().first().error_message == text


def test_events_survive_a_crash_before_the_histories_and_are_not_doubled(spark, monkeypatch):
    from costindex.plans import pipeline
    wh = Warehouse(spark)
    wh.write_snapshot("raw", "gdp_quarterly", spark.createDataFrame(
        [("2024-01-01", "x", 1.0), ("2024-04-01", "x", 2.0)], "date string, series string, value double"))
    book, at = RunBook(wh), datetime(2026, 1, 1)

    def dies(target):
        raise OSError("lost")

    real = wh.publish
    monkeypatch.setattr(wh, "publish", dies)
    try:
        pipeline.run_cdc(book, at)
        raise AssertionError("no crash")
    except OSError:
        pass
    assert book.changes().count() == 2 and not wh.has_table("warehouse", "gdp_quarterly")
    monkeypatch.setattr(wh, "publish", real)
    assert pipeline.run_cdc(book, at).count() == 2
    assert book.changes().count() == 2 and wh.read("warehouse", "gdp_quarterly").count() == 2
    assert pipeline.run_cdc(book, datetime(2026, 1, 2)).count() == 0


def test_state_export_keeps_the_version_before(spark):
    wh = Warehouse(spark)
    sd = wh.path("state", "v")
    for n in (1, 2, 3):
        wh.write_snapshot("warehouse", "gdp_quarterly", spark.range(n).selectExpr("cast(id as string) quarter"))
        state.export_state(wh, sd)
    target = f"{sd}/warehouse.gdp_quarterly.parquet"
    assert wh.versions_at(target) == [1, 2, 3] and wh.read_at(target).count() == 3
    wh.vacuum(retain=1)
    assert wh.versions_at(wh.path("warehouse", "gdp_quarterly")) == [3]


def test_marts_are_sorted_within_their_files(spark):
    wh = Warehouse(spark)
    df = spark.range(1000).selectExpr("id * 7919 % 1000 as month").repartition(3)
    out = wh.write_snapshot("marts", "m", df, sort_within=["month"])
    assert out.rdd.glom().map(lambda rows: [r.month for r in rows] == sorted(r.month for r in rows)).reduce(lambda a, b: a and b)


def test_marts_keep_their_order_over_several_files(spark):
    wh = Warehouse(spark)
    df = spark.range(3000).selectExpr("nullif(id * 7919 % 97, 5) as month", "cast(id * 31 % 3000 as string) as state", "id").repartition(7)
    out = wh.write_ordered("marts", "o", df, ["month", "state"], files=5)
    assert len(wh.data_files(wh._newest(wh.path("marts", "o")))) >= 4
    want = sorted(((r.month is None, r.month or 0, r.state) for r in df.collect()))
    assert [(r.month is None, r.month or 0, r.state) for r in out.collect()] == want
    placed = wh.with_position("marts", "o").orderBy("position").collect()
    assert [r.position for r in placed] == list(range(1, 3001))
    assert [(r.month is None, r.month or 0, r.state) for r in placed] == want
    assert wh.write_ordered("marts", "empty", df.limit(0), ["month"]).count() == 0
    assert wh.with_position("marts", "empty").count() == 0


def test_a_version_counts_only_when_its_audit_passes(spark):
    from costindex.sources.tables import Audit, AuditFailed
    wh = Warehouse(spark)
    audit = Audit(["k"], ["k", "v"], {"positive": F.col("v") <= 0})
    good = spark.createDataFrame([(1, 1.0), (2, 2.0)], "k int, v double")
    wh.write_snapshot("warehouse", "t", good, audit=audit)
    for rows, failures in (([(1, 1.0), (1, 2.0), (None, 3.0)], {"unique": 1, "not_null": 1}), ([(3, None), (4, -1.0)], {"not_null": 1, "positive": 1})):
        try:
            wh.write_snapshot("warehouse", "t", spark.createDataFrame(rows, "k int, v double"), audit=audit)
            raise AssertionError("published")
        except AuditFailed as e:
            assert e.failures == failures
    assert wh.versions_at(wh.path("warehouse", "t")) == [1] and wh.read("warehouse", "t").count() == 2
    wh.write_snapshot("warehouse", "t", good.where("k = 1"), audit=audit)
    assert wh.versions_at(wh.path("warehouse", "t")) == [1, 4] and wh.read("warehouse", "t").count() == 1
    wh.vacuum(retain=1)
    assert wh._children(wh.path("warehouse", "t")) == ["v=000004"]


def test_a_history_with_a_null_key_stays_at_its_version_and_the_run_is_failed(spark):
    from costindex.plans import pipeline
    wh = Warehouse(spark)
    book = RunBook(wh)
    schema = "date string, series string, value double"
    wh.write_snapshot("raw", "gdp_quarterly", spark.createDataFrame([("2024-01-01", "x", 1.0)], schema))
    pipeline.run_cdc(book, datetime(2026, 1, 1))
    wh.write_snapshot("raw", "gdp_quarterly", spark.createDataFrame([("2024-01-01", "x", 2.0), ("2024-04-01", None, 3.0)], schema))
    pipeline.run_cdc(book, datetime(2026, 1, 2))
    assert [r.value for r in wh.read("warehouse", "gdp_quarterly").collect()] == [1.0]
    failed = book.runs().where("status = 'failed'").collect()
    assert [r.source_name for r in failed] == ["gdp_quarterly"] and "not_null 1" in failed[0].error_message
    assert book.changes().count() == 1  # the refused version's events are not logged
    wh.write_snapshot("raw", "gdp_quarterly", spark.createDataFrame([("2024-01-01", "x", 2.0)], schema))
    assert pipeline.run_cdc(book, datetime(2026, 1, 3)).count() == 1
    assert [r.value for r in wh.read("warehouse", "gdp_quarterly").collect()] == [2.0]


def _months(spark, wh, frames):
    base = wh.path("landing", "months")
    for month, df in frames.items():
        df.coalesce(1).write.parquet(f"{base}/{month}.parquet")
    return base + "/{month}.parquet"


def test_month_that_lacks_a_column_is_refused_with_or_without_a_pinned_schema(spark):
    from costindex.sources.registry import PRICES
    good = spark.createDataFrame([(None, 1, 2, 3.5)], PRICES)
    frames = {"2024-01": good, "2024-02": good.drop("price"), "2024-03": good.withColumn("more", F.lit(1))}
    for schema in (PRICES, None):
        wh = Warehouse(spark)
        src = monthly_parquet("p", _months(spark, wh, frames), list(frames), schema=schema)
        book = RunBook(wh)
        assert loader.load_monthly(book, src, datetime(2026, 1, 1)) == "success"
        rows = {r._month_partition: r.price for r in wh.read_partitioned("raw", "p").collect()}
        assert rows == {"2024-01": 3.5, "2024-03": 3.5}
        assert book.runs().first().error_message == "2024-02: columns missing: price"


def test_contract_of_an_unpinned_source_is_the_raw_table(spark):
    wh = Warehouse(spark)
    first = spark.createDataFrame([(1, 2.0)], "a long, b double")
    frames = {"2024-01": first, "2024-02": spark.createDataFrame([("7", 3.0)], "a string, b double"),
              "2024-03": spark.createDataFrame([(8,)], "a long")}
    template = _months(spark, wh, frames)
    book = RunBook(wh)
    loader.load_monthly(book, monthly_parquet("p", template, ["2024-01"]), datetime(2026, 1, 1))
    loader.load_monthly(book, monthly_parquet("p", template, list(frames)), datetime(2026, 1, 2))
    assert sorted((r.a, r.b) for r in wh.read_partitioned("raw", "p").collect()) == [(1, 2.0), (7, 3.0)]


def test_types_that_cannot_be_cast_are_refused_before_data_is_read(spark):
    wh = Warehouse(spark)
    frames = {"2024-01": spark.createDataFrame([(1, 2.0)], "a long, b double"),
              "2024-02": spark.createDataFrame([(1, [2.0])], "a long, b array<double>")}
    src = monthly_parquet("p", _months(spark, wh, frames), list(frames))
    contract, plans = loader.plan_months(RunBook(wh), src, "raw", {m: src.path_for_month(m) for m in frames})
    assert contract["b"].dataType.typeName() == "double"
    assert plans["2024-01"].refused is None and "CAST" in plans["2024-02"].refused.upper()


def test_nan_is_no_value_in_any_load(spark):
    from costindex.sources.registry import STATIC, Source
    nan = float("nan")
    df = spark.createDataFrame([(1, nan, "x"), (2, 1.0, None)], "a long, `b.c` double, d string")
    wh = Warehouse(spark)
    book = RunBook(wh)
    loader.load_static(book, Source("s", STATIC, reader=lambda: df), datetime(2026, 1, 1))
    assert [tuple(r) for r in wh.read("raw", "s").orderBy("a").collect()] == [(1, None, "x"), (2, 1.0, None)]
    loader.load_monthly(book, monthly_parquet("p", _months(spark, wh, {"2024-01": df}), ["2024-01"]), datetime(2026, 1, 1))
    assert [tuple(r)[:3] for r in wh.read_partitioned("raw", "p").orderBy("a").collect()] == [(1, None, "x"), (2, 1.0, None)]


def test_files_of_one_schema_are_compared_once(spark, monkeypatch, tmp_path):
    from costindex.plans.loads import MONTH_FILES, _by_month
    from costindex.sources import loader
    from costindex.sources.meta import RunBook
    from costindex.sources.registry import monthly_parquet
    from costindex.sources.tables import Warehouse
    rows = spark.range(0, 400, 1, 20).selectExpr("id as item_code", "id % 7 as premise_code", "double(id) as price",
                                                 "concat('2001-0', 1 + id % 3) as _month_partition")
    _by_month(rows).write.partitionBy("_month_partition").parquet(f"{tmp_path}/landing")
    book = RunBook(Warehouse(spark, f"{tmp_path}/wh"))
    paths = {f"2001-0{m}": f"{tmp_path}/landing/_month_partition=2001-0{m}" for m in (1, 2, 3)}
    calls, compare = [], loader._mismatch
    monkeypatch.setattr(loader, "_mismatch", lambda *a: calls.append(a) or compare(*a))
    source = monthly_parquet("prices", f"{tmp_path}/landing/_month_partition={{month}}", sorted(paths))
    _, plans = loader.plan_months(book, source, "raw", paths)
    files = [f for p in plans.values() for own in p.files.values() for f in own]
    assert len(calls) == 1 and 3 <= len(files) <= 3 * MONTH_FILES
    assert spark.read.parquet(*files).count() == 400
