"""Histories in parts: what a merge writes, what a reader sees, crashes, audits."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costindex.plans import history, pipeline
from costindex.sources.ledger import Conflict, Layout, Ledger
from costindex.sources.meta import RunBook
from costindex.sources.tables import Audit, AuditFailed, Warehouse

SCHEMA = T.StructType([T.StructField("month", T.StringType()), T.StructField("k", T.IntegerType()),
                       T.StructField("v", T.DoubleType()), T.StructField("loaded_at", T.TimestampNTZType())])
LAYOUT = Layout("month")
KEYED = history.Keyed("t", ["month", "k"], "v", SCHEMA, LAYOUT, 0.001, Audit(["month", "k"], ["month", "k"]))


def _merge(spark, ledger, rows, keyed=KEYED):
    prepared, _ = history.merge_keyed(ledger, keyed, spark.createDataFrame(rows, "month string, k int, v double"),
                                      F.lit("2026-01-01 00:00:00").cast("timestamp_ntz"))
    return prepared


def _rows(ledger, version=None, parts=None):
    return sorted((r.month, r.k, r.v) for r in ledger.read("t", SCHEMA, parts, version).collect())


def _folders(ledger):
    return {e.part: e.folder for e in ledger.entries().collect()}


def test_a_change_in_one_of_a_hundred_parts_writes_one_part(spark):
    ledger = Ledger(Warehouse(spark))
    rows = [(f"{1990 + m // 12}-{m % 12 + 1:02d}", k, float(k)) for m in range(100) for k in range(3)]
    ledger.publish([_merge(spark, ledger, rows)])
    before, first = _rows(ledger), _folders(ledger)
    assert len(first) == 100 and len(set(first.values())) == 1 and before == sorted(rows)
    changed = [(m, k, v + 10 if (m, k) == ("1993-05", 1) else v) for m, k, v in rows]
    assert ledger.publish([_merge(spark, ledger, changed)]) == 2
    after = _folders(ledger)
    assert {p for p in after if after[p] != first[p]} == {"p1993-05"}
    written = [f for f in ledger.wh.data_files(f"{ledger.base}/{after['p1993-05']}")]
    assert written and all("/ledger_part=p1993-05/" in f for f in written)
    assert _rows(ledger) == sorted(changed)
    assert _rows(ledger, version=1) == before             # the version before can still be read
    assert _rows(ledger, parts=["p1993-05"]) == [r for r in sorted(changed) if r[0] == "1993-05"]
    assert _merge(spark, ledger, changed) is None         # nothing changed: nothing to publish


def test_random_merges_equal_a_dictionary(spark):
    rng = random.Random(5)
    for spread in (1, 3):
        ledger, expected = Ledger(Warehouse(spark)), {}
        keyed = history.Keyed("t", ["month", "k"], "v", SCHEMA, Layout("month", ["k"], spread), 0.001, KEYED.audit)
        for _ in range(3):
            batch = {(f"m{rng.randrange(5)}", rng.randrange(6)): float(rng.randrange(4)) for _ in range(12)}
            expected.update(batch)
            prepared = _merge(spark, ledger, [(*key, v) for key, v in batch.items()], keyed)
            if prepared:
                ledger.publish([prepared])
            assert _rows(ledger) == sorted((*key, v) for key, v in expected.items())
            assert {e.part: e.n_rows for e in ledger.entries().collect()} == {
                r[0]: r[1] for r in ledger.read("t", SCHEMA).groupBy(keyed.layout.part()).count().collect()}


def test_keys_of_another_type_find_their_hash_part(spark):
    ledger = Ledger(Warehouse(spark))
    keyed = history.Keyed("t", ["month", "k"], "v", SCHEMA, Layout("month", ["k"], 7), 0.001, KEYED.audit)
    for kind, v in (("int", 1.0), ("long", 2.0), ("string", 3.0)):
        batch = spark.createDataFrame([("a", k, v) for k in range(9)], "month string, k int, v double").withColumn("k", F.col("k").cast(kind))
        prepared, changes = history.merge_keyed(ledger, keyed, batch, F.lit("2026-01-01 00:00:00").cast("timestamp_ntz"))
        ledger.publish([prepared])
        assert {r.change_type for r in changes.collect()} == {"INSERT" if v == 1 else "UPDATE"}
        assert _rows(ledger) == [("a", k, v) for k in range(9)]


def test_parts_can_become_empty_and_odd_periods_name_folders(spark):
    ledger = Ledger(Warehouse(spark))
    odd = [("a/b=c %", 1, 1.0), ("a/b", 2, 2.0), ("ü", 3, 3.0), ("", 4, 4.0), ("all", 5, 5.0)]
    ledger.publish([_merge(spark, ledger, odd)])
    assert _rows(ledger) == sorted(odd)
    null = spark.createDataFrame([(None, 6, 6.0, None)], SCHEMA)
    parts = ledger.parts_of(null, LAYOUT)
    ledger.publish([ledger.prepare("t", parts, LAYOUT, SCHEMA, lambda old: old.unionByName(null))])
    assert parts == ["pnull"] and ledger.read("t", SCHEMA).count() == 6
    ledger.publish([ledger.prepare("t", sorted(_folders(ledger)), LAYOUT, SCHEMA, lambda old: old.where("k = 2"))])
    assert _rows(ledger) == [("a/b", 2, 2.0)] and len(_folders(ledger)) == 1
    ledger.publish([ledger.prepare("t", sorted(_folders(ledger)), LAYOUT, SCHEMA, lambda old: old.where("false"))])
    assert _rows(ledger) == [] and not ledger.has("t") and ledger.has("t", version=3)


def test_rows_outside_their_parts_and_failed_audits_are_not_published(spark):
    ledger = Ledger(Warehouse(spark))
    ledger.publish([_merge(spark, ledger, [("a", 1, 1.0), ("b", 1, 1.0)])])
    stray = spark.createDataFrame([("c", 1, 1.0, None)], SCHEMA)
    with pytest.raises(ValueError, match="outside the parts"):
        ledger.prepare("t", ["pa"], LAYOUT, SCHEMA, lambda old: old.unionByName(stray))
    with pytest.raises(AuditFailed) as e:
        ledger.prepare("t", ["pa"], LAYOUT, SCHEMA, lambda old: old.unionByName(old), KEYED.audit)
    assert e.value.failures == {"unique": 1}
    assert ledger.version() == 1 and _rows(ledger) == [("a", 1, 1.0), ("b", 1, 1.0)]


def test_parts_of_an_older_version_are_refused(spark):
    ledger = Ledger(Warehouse(spark))
    ledger.publish([_merge(spark, ledger, [("a", 1, 1.0)])])
    one, two = _merge(spark, ledger, [("a", 1, 2.0)]), _merge(spark, ledger, [("a", 1, 3.0)])
    ledger.publish([one])
    with pytest.raises(Conflict):
        ledger.publish([two])
    assert _rows(ledger) == [("a", 1, 2.0)]


def _raw(spark, wh, gdp):
    wh.write_snapshot("raw", "gdp_quarterly", spark.createDataFrame(gdp, "date string, series string, value double").coalesce(1))
    wh.write_snapshot("raw", "household_income", spark.createDataFrame(
        [("S", "2020-01-01", 5.0, 4.0), ("S", "2022-01-01", 9.0, 8.0), ("R", "2020-01-01", 1.0, 1.0)],
        "state string, date string, income_median double, income_mean double").coalesce(1))


@pytest.mark.parametrize("step", ["prepare_run", "publish", "marker"])
def test_a_crash_between_the_steps_shows_nothing_and_the_retry_shows_all(spark, monkeypatch, step):
    wh = Warehouse(spark)
    book, ledger, at = RunBook(wh), Ledger(wh), datetime(2026, 1, 1)
    _raw(spark, wh, [("2024-01-01", "x", 1.0), ("2024-04-01", "x", 2.0)])
    history.run_cdc_in_parts(book, ledger, at)
    seen = sorted(map(tuple, history.changes(ledger).collect()), key=str)
    assert len(seen) == 5
    _raw(spark, wh, [("2024-01-01", "x", 7.0), ("2024-04-01", "x", 2.0)])
    second = datetime(2026, 1, 2)

    def dies(*args):
        raise OSError("lost")

    with monkeypatch.context() as m:
        if step == "marker":    # the manifest's files are there, its marker is not
            real = ledger.publish

            def half(prepared):
                real(prepared)
                wh.delete(f"{ledger.manifests}/v=000002/_SUCCESS")
                raise OSError("lost")
            m.setattr(ledger, "publish", half)
        else:
            m.setattr(ledger, step, dies)
        with pytest.raises(OSError):
            history.run_cdc_in_parts(book, ledger, second)
    assert ledger.version() == 1 and sorted(map(tuple, history.changes(ledger).collect()), key=str) == seen
    assert sorted(r.value for r in ledger.read("gdp_quarterly", pipeline.GDP_HISTORY).collect()) == [1.0, 2.0]
    assert history.run_cdc_in_parts(book, ledger, second).count() == 1
    assert history.run_cdc_in_parts(book, ledger, second).count() == 1    # repeated: no change, the log stays
    assert history.changes(ledger).count() == 6 and ledger.version() == 2
    assert sorted(r.value for r in ledger.read("gdp_quarterly", pipeline.GDP_HISTORY).collect()) == [2.0, 7.0]
    dim = {(r.geography, r.version): r.is_current for r in ledger.read("dim_household_income", pipeline.DIM_SCHEMA).collect()}
    assert dim == {("S", 1): False, ("S", 2): True, ("R", 1): True}
    gone = ledger.vacuum(retain=1)
    assert any("gdp_quarterly/g=" in p for p in gone) and ledger.wh.versions_at(ledger.manifests) == [2]
    assert history.changes(ledger).count() == 6 and ledger.read("gdp_quarterly", pipeline.GDP_HISTORY).count() == 2


def test_a_history_that_fails_its_audit_is_left_out_with_its_events(spark):
    wh = Warehouse(spark)
    book, ledger = RunBook(wh), Ledger(wh)
    _raw(spark, wh, [("2024-01-01", None, 1.0), ("2024-04-01", "x", 2.0)])
    changes = history.run_cdc_in_parts(book, ledger, datetime(2026, 1, 1))
    assert {r.source_name for r in changes.collect()} == {"household_income"}
    assert [(r.source_name, r.status) for r in book.runs().collect()] == [("gdp_quarterly", "failed")]
    assert not ledger.has("gdp_quarterly") and ledger.has("dim_household_income")
