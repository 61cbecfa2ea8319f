from datetime import datetime

import pytest
from pyspark.sql import functions as F

from costindex.sources import fixtures
from costindex.sources.meta import RunBook
from costindex.sources.tables import Warehouse
from costindex.streaming import incremental
from costindex.streaming.incremental import run_incremental_stream

from conftest import SF_SMALL


def test_stream_picks_up_only_new_months_and_matches_full_load(spark):
    wh = Warehouse(spark)
    book = RunBook(wh)
    prices = fixtures.prices(spark, SF_SMALL)
    landing = wh.path("landing", "p")
    ckpt = wh.path("state", "ckpt")
    prices.where("_month_partition < '1998-01'").write.partitionBy("_month_partition").parquet(landing)
    run_incremental_stream(book, "p", landing, prices.schema, ckpt, datetime(2026, 1, 1))
    first = wh.read_partitioned("raw", "p").count()
    prices.where("_month_partition >= '1998-01'").write.mode("append") \
        .partitionBy("_month_partition").parquet(landing)
    run_incremental_stream(book, "p", landing, prices.schema, ckpt, datetime(2026, 1, 2))
    raw = wh.read_partitioned("raw", "p")
    assert 0 < first < raw.count() == prices.count()
    assert raw.select("_month_partition", "price").exceptAll(
        prices.select("_month_partition", "price")).count() == 0
    assert book.watermark("p").last_max_date == prices.agg(F.max("_month_partition")).first()[0]
    assert book.runs().count() == 2


def test_a_month_in_several_files_batches_and_runs_keeps_all_rows(spark):
    wh = Warehouse(spark)
    book = RunBook(wh)
    landing, ckpt = wh.path("landing", "q"), wh.path("state", "q")
    df = spark.createDataFrame([(k, 1.0 * k, f"2000-0{1 + k % 3}") for k in range(90)],
                               "item_code int, price double, _month_partition string")
    for drop in range(2):
        part = df.where(F.pmod("item_code", F.lit(2)) == drop)
        part.repartition(3).write.mode("append").partitionBy("_month_partition").parquet(landing)
        run_incremental_stream(book, "q", landing, df.schema, ckpt, datetime(2026, 1, 1 + drop), max_files_per_trigger=1)
    raw = wh.read_partitioned("raw", "q")
    assert raw.count() == 90 and raw.agg(F.sum("price")).first()[0] == sum(range(90))


def _drop(spark, landing, keys, month="2000-01"):
    spark.createDataFrame([(k, 1.0 * k, month) for k in keys], "item_code int, price double, _month_partition string") \
        .repartition(2).write.mode("append").partitionBy("_month_partition").parquet(landing)


def test_a_month_is_rewritten_once_a_run_however_many_batches(spark, monkeypatch):
    wh = Warehouse(spark)
    book, landing, ckpt = RunBook(wh), wh.path("landing", "r"), wh.path("state", "r")
    writes, real = [], wh.replace_partitions
    monkeypatch.setattr(wh, "replace_partitions", lambda *a: (writes.append(a[1]), real(*a)))
    for k in range(3):
        _drop(spark, landing, range(10 * k, 10 * k + 10))
    schema = spark.read.parquet(landing).schema
    run_incremental_stream(book, "r", landing, schema, ckpt, datetime(2026, 1, 1), max_files_per_trigger=1)
    assert writes == ["r"] and wh.read_partitioned("raw", "r").count() == 30
    landed = spark.read.parquet(incremental._landed(ckpt))
    assert landed.select("epoch").distinct().count() == 6 and landed.agg(F.sum("rows")).first()[0] == 30
    run_incremental_stream(book, "r", landing, schema, ckpt, datetime(2026, 1, 2), max_files_per_trigger=1)
    assert writes == ["r"] and book.runs().count() == 1  # nothing new: nothing written or logged


def test_a_crash_before_publication_is_made_up_by_the_next_run(spark, monkeypatch):
    wh = Warehouse(spark)
    book, landing, ckpt = RunBook(wh), wh.path("landing", "s"), wh.path("state", "s")
    _drop(spark, landing, range(10))
    schema = spark.read.parquet(landing).schema

    def dies(*args):
        raise OSError("lost")
    with monkeypatch.context() as m:
        m.setattr(incremental, "publish", dies)
        with pytest.raises(OSError):
            run_incremental_stream(book, "s", landing, schema, ckpt, datetime(2026, 1, 1))
    assert not wh.exists(wh.path("raw", "s"))
    run_incremental_stream(book, "s", landing, schema, ckpt, datetime(2026, 1, 2))  # no new file
    assert wh.read_partitioned("raw", "s").count() == 10
    # a crash between the rows and the marker: published again, nothing doubled
    _drop(spark, landing, range(10, 20))
    real = wh.write_at
    with monkeypatch.context() as m:
        m.setattr(wh, "write_at", lambda base, *a, **k: dies() if base.endswith("published") else real(base, *a, **k))
        with pytest.raises(OSError):
            run_incremental_stream(book, "s", landing, schema, ckpt, datetime(2026, 1, 3))
    run_incremental_stream(book, "s", landing, schema, ckpt, datetime(2026, 1, 3))
    assert wh.read_partitioned("raw", "s").count() == 20
    assert book.runs().count() == 2 and book.watermark("s").row_count == 20
