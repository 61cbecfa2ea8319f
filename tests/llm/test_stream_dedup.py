"""Exact deduplication by a stream against a plain grouping."""

import hashlib

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from costindex.llm import stream_dedup as D
from costindex.session import shared_root

SCHEMA = "doc_id long, text string, digest string, n long, at string, bucket int, file string, row long, _metadata string"


def _write(spark, rows, path=None, parts=3):
    path = path or shared_root(spark) + "/docs"
    full = [(i, t, "x", 1, "y", 2, "z", 3, "m") for i, t in rows]
    spark.createDataFrame(full, SCHEMA).repartition(parts).write.mode("append").parquet(path)
    return path


def _plain(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for i, t in rows:
        ids = groups[t or ""]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


def _got(df):
    return sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in df.collect()], key=str)


ROWS = [(1, "a"), (2, "b"), (3, "a"), (4, None), (5, ""), (6, "A"), (7, "a "), (8, "x" * 300_000), (9, "x" * 300_000),
        (10, "x" * 299_999 + "y"), (None, "b"), (None, None), (None, "only"), (11, "é"), (12, "é"), (13, "b"), (13, "b")]


@pytest.mark.parametrize("digest", [D.sha256, lambda t: F.unhex(F.hex(F.length(t) % 3)), lambda t: F.unhex(F.lit("00"))],
                         ids=["sha256", "weak", "one"])
def test_equal_texts_whatever_the_digest(spark, digest):
    got = D.exact_duplicates(spark, _write(spark, ROWS), digest=digest)
    assert _got(got) == _plain(ROWS)
    kept = got.filter("kept").groupBy("text_sha256").count().collect()
    assert len(kept) == len({t or "" for _, t in ROWS}) and all(r["count"] == 1 for r in kept)
    assert got.filter("kept and not doc_id <=> keep_id").count() == 0


def test_state_goes_on_and_reads_new_files_only(spark):
    path, state = shared_root(spark) + "/docs", shared_root(spark)
    first = [(k, f"text {k % 7}") for k in range(40)]
    _write(spark, first, path)
    assert _got(D.exact_duplicates(spark, path, state, files_per_batch=1)) == _plain(first)
    more = [(k, f"text {k % 11}") for k in range(40, 70)]
    _write(spark, more, path)
    assert _got(D.exact_duplicates(spark, path, state, files_per_batch=1)) == _plain(first + more)
    entries = D.update_state(spark, path, state)  # nothing new: counts do not grow
    assert entries.agg(F.sum("n")).first()[0] == 70


def test_hot_text_is_dealt_to_several_buckets(spark):
    rows = [(k, "hot" if k % 3 else f"t{k}") for k in range(3000)]
    path = _write(spark, rows)
    entries = D.update_state(spark, path, shared_root(spark))
    docs = D._dealt(D._located(spark.read.parquet(path), "doc_id", "text", D.sha256), entries, 100)
    sizes = [r["count"] for r in docs.filter("text = 'hot'").groupBy("bucket").count().collect()]
    assert len(sizes) == 20 and max(sizes) < 200
    assert _got(D.exact_duplicates(spark, path)) == _plain(rows)


def test_empty_table(spark):
    path = _write(spark, [], parts=1)
    got = D.exact_duplicates(spark, path)
    assert got.collect() == [] and got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


def test_settings_are_put_back(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    D.update_state(spark, _write(spark, ROWS), shared_root(spark))
    assert spark.conf.get(key) == before


def test_given_documents_equal_sql(spark):
    path = f"{SF_SMALL}/documents.parquet"
    got = D.exact_duplicates(spark, path)
    rows = duckdb.sql(D.DUPLICATES_SQL.replace("from documents", f"from '{path}'")).fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(rows)
