"""Periodic runs against a scan of all periods."""

import hashlib
import random
import zlib

import numpy as np

from conftest import SF_SMALL
from costindex.llm import periodic_runs as P
from costindex.llm.queries import op13_periodic_runs


def _scan(words):
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            size = j - i + q
            if size >= max(6, 4 * q):
                own = words[i:i + size]
                if not any(own[d:] == own[:size - d] for d in range(1, q)):
                    out.append((i, size, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def _collapsed(words, runs):
    gone = {i for start, size, q in runs for i in range(start + q, start + size)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def _words(rng, n, kinds):
    w = [f"w{rng.randrange(kinds)}" for _ in range(n)]
    for _ in range(rng.randint(0, 4)):
        if n > 8:
            a = rng.randrange(n)
            p = rng.randint(1, max(1, (n - a) // 4))
            b = min(n, a + p * rng.randint(2, 8) + rng.randint(0, p))
            w[a:b] = [w[a + (i - a) % p] for i in range(a, b)]
    return w


def _same(texts):
    runs, collapsed = P.find_runs(texts)
    for text, r, c in zip(texts, runs, collapsed, strict=True):
        words = text.split()
        want = _scan(words)
        assert [(x["start"], x["length"], x["period"]) for x in r] == want
        assert c == _collapsed(words, want)


def test_random_texts():
    rng = random.Random(4)
    for _ in range(250):
        _same([" ".join(_words(rng, rng.choice([0, 1, 5, 40, 300, 700]), rng.choice([1, 2, 3, 50]))) for _ in range(rng.randint(1, 4))])


def test_periods_around_the_scales():
    rng = random.Random(5)
    for q in [1, 2, 15, 16, 17, 31, 32, 33, 63, 64, 65, 128, 129]:
        block = [f"b{k}" for k in range(q)]
        few = [f"c{rng.randrange(2)}" for _ in range(q)]
        for size in (4 * q - 1, 4 * q, 4 * q + 1, 6 * q + 3):
            for b in (block, few):
                _same([" ".join(["x", "y"] + (b * 9)[:size] + ["z"]), " ".join((b * 9)[:size])])


def test_runs_do_not_cross_texts():
    _same(["a b a b", "a b a b a b", "a b", ""])


def test_white_space_and_other_letters():
    runs, collapsed = P.find_runs([" é\té\né é é\vé\fé\ré é  é é "])
    assert [(r["start"], r["length"], r["period"]) for r in runs[0]] == [(3, 7, 1)]
    assert collapsed == ["é é é é é"]


def test_very_long_text_is_near_linear():
    rng = np.random.default_rng(1)
    words = [f"w{k}" for k in rng.integers(0, 5000, 300_000)]
    block = [f"w{k}" for k in rng.integers(0, 5000, 20_001)]
    words[50_000:130_050] = (block * 5)[:80_050]
    runs, _ = P.find_runs([" ".join(words)])
    assert {"start": 50_000, "length": 80_050, "period": 20_001} in runs[0] or any(
        r["period"] == 20_001 and r["start"] <= 50_000 and r["length"] >= 80_050 for r in runs[0])


def test_columns_pass_and_null_texts(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "y"), (2, "a a a a a a", "y"), (None, "b " * 6, "z")],
                               "doc_id long, text string, number string")
    got = sorted([(r.doc_id, [tuple(x) for x in r.runs], r.collapsed, r.number) for r in P.with_runs(df).collect()], key=str)
    assert got == sorted([(1, [], "", "x"), (2, [], "", "y"), (2, [(0, 6, 1)], "a", "y"), (None, [(0, 6, 1)], "b", "z")], key=str)
    assert P.with_runs(df.limit(0)).collect() == []


def test_planted_rows_with_nulls_and_clashing_columns(spark):
    df = spark.createDataFrame([(None, "a b c", 1), (None, None, 1), (3, None, 1)], "doc_id long, text string, number int")
    assert sorted(map(tuple, P.planted(df).collect()), key=str) == sorted([(None, "a b c"), (None, ""), (3, "")], key=str)
    assert {r.n_runs for r in P.run_digests(P.with_runs(P.planted(df))).collect()} == {0}


def test_query_equals_plain_version(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    got = {r.doc_id: tuple(r) for r in op13_periodic_runs(spark, SF_SMALL).collect()}
    assert len(got) == len(docs)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    for d in docs:
        words = [w.decode() for w in (d.text or "").encode().split()]
        h, n = zlib.crc32(str(d.doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        if n > 4000 and h % 10:
            continue  # the scan of all periods is quadratic
        runs = _scan(words)
        top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        want = (d.doc_id, len(runs), *((top[0], top[1], top[2], 1000 * top[1] // top[2]) if top else (None,) * 4),
                sha("".join(f"{a},{b},{c}\n" for a, b, c in runs)), sha(_collapsed(words, runs)))
        assert got[d.doc_id] == want
