"""Packing, BPE, token counts and WARC against the libraries and exact round trips, and the pipeline."""

import base64
import gzip
import hashlib
import io
import json
import random
import struct
import zipfile
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from costindex.llm import bpe, packing, token_counts, warc
from costindex.llm.common import stage

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ALPHABET = ["a", "b", "e", "th", "the", "ing", " ", "  ", "\n", "\t", "'s", "'T", "é", "é", "　", "\xa0", "\x85", "\x1c", " ", "​",
            "𝟙", "½", "Ⅷ", "😀", "<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>", "<|endoftext|", "<s>", "</s>", "▁", "aaaa", "zz", "1", "23", "!", "...",
            "ſ", "ß", "ñ", "İ", "Σ", "中文", "한글", "\x00", "The", "OF,", "word."]


def _random_texts(n, seed=2):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 40))) for _ in range(n)]


# ---- packing ------------------------------------------------------------------------

def test_word_ids_equal_the_tokenizer():
    t, w = Tokenizer.from_file(WORDS), packing.WordIds(WORDS)
    for x in _random_texts(3000) + ["", "It's the end. Of, e.g., lines!"]:
        assert np.frombuffer(w.text(x), "<u4").tolist() == t.encode(x, add_special_tokens=False).ids, repr(x)


@pytest.mark.parametrize("seed", range(4))
def test_patterns_cover_demand_exactly_with_few_bins(seed):
    rng = np.random.default_rng(seed)
    weights = sorted(map(int, rng.choice(np.arange(1, 25), 12, replace=False)))
    demand = [int(v) for v in rng.integers(1, 400, 12)]
    found = packing.solve_patterns(weights, demand, 64)
    assert [sum(p[k] * c for p, c in found) for k in range(12)] == demand
    assert all(sum(a * w for a, w in zip(p, weights)) <= 64 for p, _ in found)
    bound = -(-sum(w * d for w, d in zip(weights, demand)) // 64)
    assert sum(c for _, c in found) <= bound * 1.02 + 8


def test_pieces_hold_every_id_once_and_sequences_are_gapless(spark):
    rng = random.Random(6)
    texts = [" ".join(rng.choice(["alpha", "beta", "gamma,", "Delta"]) for _ in range(int(rng.paretovariate(0.6) * 5) % 9000)) for _ in range(300)]
    texts += [None, "", "x", "x", "w " * 12_287, "word " * 40_000] + ["same text here"] * 150
    docs = spark.createDataFrame([(k, t, 1) for k, t in enumerate(texts)] + [(None, "no id", 1)], "doc_id long, text string, row int")
    rows = packing.pack(docs, WORDS, fill=4).collect()
    t = Tokenizer.from_file(WORDS)
    per, seq = defaultdict(list), defaultdict(list)
    for r in rows:
        per[r.doc_id].append(r)
        seq[r.sequence_id].append(r)
    assert set(per) == {None, *range(len(texts))}
    for k, pieces in per.items():
        ids = np.array(t.encode("no id" if k is None else texts[k] or "", add_special_tokens=False).ids + [2], "<u4")
        at = 0
        for p in sorted(pieces, key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(ids)) and zlib.crc32(ids[at:at + p.length].tobytes()) == p.ids_crc32
            at += p.length
        assert at == len(ids)
    padding = 0
    for s in seq.values():
        at = 0
        for p in sorted(s, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= 4096
        padding += 0 if at & (at - 1) == 0 else 4096 - at
    assert padding <= 0.02 * sum(r.length for r in rows)


def test_packing_of_an_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), WORDS).collect() == []


# ---- BPE ----------------------------------------------------------------------------

def test_bpe_equals_the_library_on_random_texts():
    t, m = Tokenizer.from_file(BYTES), bpe.Bpe(BYTES)
    texts = _random_texts(4000, 8) + ["a" * 3000 + "é" * 2000 + "=-" * 3000 + " " * 4000]
    for x, ids in zip(texts, m.encode_batch(texts)):
        want = t.encode(x, add_special_tokens=False).ids
        assert ids == want, repr(x)
        assert m.decode(ids) == t.decode(want, skip_special_tokens=False)


def test_checks_accept_only_what_merging_gives():
    m = bpe.Bpe(BYTES)
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 50_000, 20_000), rng.integers(0, 50_000, 20_000)
    fine = m.compatible(a, b)
    merges = m.merge([m.token_bytes[x] + m.token_bytes[y] for x, y in zip(a.tolist(), b.tolist())])
    for x, y, ok, merged in zip(a.tolist(), b.tolist(), fine, merges):
        assert ok == (merged == [x, y])
    assert 0 < fine.mean() < 1


def test_decoding_any_ids_equals_the_library():
    t, m = Tokenizer.from_file(BYTES), bpe.Bpe(BYTES)
    rng = np.random.default_rng(2)
    for _ in range(500):
        ids = rng.integers(0, m.size, int(rng.integers(0, 12))).tolist()
        assert m.decode(ids) == t.decode(ids, skip_special_tokens=False)


def test_round_trip_query(spark):
    texts = _random_texts(50, 9) + [None, "", "x" * 50_000]
    docs = spark.createDataFrame([(k, t, "i") for k, t in enumerate(texts)] + [(0, texts[0], "i")], "doc_id long, text string, ids string")
    t = Tokenizer.from_file(BYTES)
    rows = bpe.round_trip(docs, BYTES).collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        ids = t.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert bpe.round_trip(docs.limit(0), BYTES).count() == 0
    back = bpe.with_decoded(bpe.with_ids(docs.select("doc_id", "text"), BYTES, out="t"), BYTES, "t", "again").collect()
    assert all(r.again == (r.text or "") for r in back)


# ---- token counts ---------------------------------------------------------------------

def test_counts_by_word_equal_sentencepiece():
    m, c = sentencepiece.SentencePieceProcessor(model_file=PIECES), token_counts.PieceCounts(PIECES)
    assert c.by_word
    for x in _random_texts(4000, 3) + ["", " ", "  ", "a ", " a", "▁", "a  ▁ b   "]:
        assert c.count(x) == len(m.encode(x)), repr(x)


@pytest.mark.parametrize("path", [PIECES, WORDS])
def test_cache_encodes_only_misses_and_keeps_versions_apart(spark, tmp_path, path):
    texts = [None, "", "one two", "one two", "word " * 5000, *_random_texts(30, 5)]
    docs = spark.createDataFrame([(k, t, 9) for k, t in enumerate(texts)], "doc_id long, text string, n_tokens int")
    cache = str(tmp_path / "cache")
    count = token_counts.counter(path).count
    for _ in range(2):  # the second run finds every count
        got = token_counts.token_counts(docs, path, cache).collect()
        assert sorted(map(tuple, got)) == sorted((k, len((t or "").encode()), count(t or ""), count(t or "") > 4096) for k, t in enumerate(texts))
        assert spark.read.parquet(cache).count() == len({t or "" for t in texts})
    more = docs.union(spark.createDataFrame([(99, "new words", 0)], docs.schema))
    assert token_counts.token_counts(more, path, cache).count() == len(texts) + 1
    stored = spark.read.parquet(cache)
    assert stored.count() == len({t or "" for t in texts}) + 1
    other = stored.selectExpr("content_digest", "'other version' tokenizer_digest", "-5L n_tokens")
    other.write.mode("append").parquet(cache)
    assert all(r.n_tokens >= 0 for r in token_counts.token_counts(more, path, cache).collect())
    assert token_counts.token_counts(docs.limit(0), path, cache).count() == 0


# ---- WARC -----------------------------------------------------------------------------

def _read(data):
    return lambda offset, length: data[offset:offset + length]


def test_zip_directory_with_zip64_prefix_and_comment():
    b = io.BytesIO()
    with zipfile.ZipFile(b, "w") as z:
        for k in range(66_000):  # more entries than the plain record can count
            z.writestr(zipfile.ZipInfo(f"m{k}"), str(k))
    for data in (b.getvalue(), b"some prefix" + b.getvalue()):
        m = warc.zip_members(_read(data), len(data))
        assert len(m) == 66_000 and all(data[a:a + n] == k[1:].encode() for k, (a, n) in m.items())
    b = io.BytesIO()
    with zipfile.ZipFile(b, "w") as z:
        z.comment = b"PK\x05\x06 in a comment" + b"x" * 30
        z.writestr(zipfile.ZipInfo("é"), b"abc")
        z.writestr(zipfile.ZipInfo("packed"), b"abc" * 100, zipfile.ZIP_DEFLATED)
    data = b.getvalue()
    m = warc.zip_members(_read(data), len(data))
    assert set(m) == {"é"} and data[m["é"][0]:][:3] == b"abc"


def test_zip64_sizes_and_offsets_in_the_extra_field():
    name, body = b"big", b"hello"
    local = struct.pack("<4sHHHHHIIIHH", b"PK\x03\x04", 45, 0, 0, 0, 0, 0, 5, 5, 3, 0) + name + body
    extra = struct.pack("<HHQQQ", 1, 24, 5, 5, 0)
    cd = struct.pack("<4sHHHHHHIIIHHHHHII", b"PK\x01\x02", 45, 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, 3, len(extra), 0, 0, 0, 0, 0xFFFFFFFF) + name + extra
    end64 = struct.pack("<4sQHHIIQQQQ", b"PK\x06\x06", 44, 45, 45, 0, 0, 1, 1, len(cd), len(local))
    tail = struct.pack("<4sIQI", b"PK\x06\x07", 0, len(local) + len(cd), 1) + struct.pack("<4sHHHHIIH", b"PK\x05\x06", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    data = local + cd + end64 + tail
    (at, size), = warc.zip_members(_read(data), len(data)).values()
    assert data[at:at + size] == body


def test_archives_round_trip(spark, tmp_path, monkeypatch):
    long = "<p>" + "x" * 2000
    rows = [(1, "http://a/b c\r\nX: y", long), (2, None, long), (3, "u", long), (3, "u", long), (None, "u", long), (5, "u", "é"), (6, "u", "é"), (7, "u", None), (8, "", ""),
            (None, "u", "y" * 1500), (9, "u", "WARC/1.1\r\n\r\nContent-Length: 5\r\n\r\n" * 50), (10, "u", "z" * 3_000_000)]
    pages = spark.createDataFrame([(*r, "d") for r in rows], "page_id long, url string, html string, digest string").repartition(3)
    manifest = warc.write_archives(pages, str(tmp_path / "w"))
    got = warc.read_archives(manifest, payload=True).collect()
    assert len(got) == len(rows) == sum(r.records for r in manifest.collect())
    html = defaultdict(set)
    for i, _, h in rows:
        html[i].add((h or "").encode())
    for r in got:
        first = 3 if (r.payload_bytes, r.payload_digest) == (len(long), hashlib.sha1(long.encode()).hexdigest()) else None
        assert r.record_type == ("revisit" if first and r.page_id != 3 else "response")
        assert r.refers_to == (first if r.record_type == "revisit" else None)
        digests = {hashlib.sha1(h).hexdigest(): h for h in html[r.page_id]}
        assert r.payload_digest in digests and r.payload_bytes == len(digests[r.payload_digest])
        if r.record_type == "response":
            assert bytes(r.payload) == digests[r.payload_digest]
    assert warc.archive_round_trip(pages.limit(0)).count() == 0


def test_damage_is_noticed():
    record = warc.make_record(1, "u", b"payload", hashlib.sha1(b"payload").hexdigest(), None)
    raw, = warc.split_members(record)
    assert warc.parse_record(raw)["payload"] == b"payload"
    with pytest.raises(ValueError):
        warc.parse_record(raw.replace(b"payload\r\n\r\n", b"paYload\r\n\r\n"))
    with pytest.raises(ValueError):
        list(warc.split_members(record[:-3]))


def _foreign_record(kind, target, http, body, label=None, packed=True, more=()):
    block = (http + "\r\n\r\n").encode() + body if http else body
    lines = ["WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{hashlib.md5(target.encode() + body).hexdigest()}>",
             "WARC-Date: 2020-01-02T03:04:05Z", f"WARC-Target-URI: {target}", *more]
    if http:
        lines.append(f"Content-Type: application/http; msgtype={'request' if kind == 'request' else 'response'}")
    if label:
        lines.append(f"WARC-Payload-Digest: {label}")
    raw = "\r\n".join([*lines, f"Content-Length: {len(block)}"]).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return gzip.compress(raw) if packed else raw


def _foreign_archive(path, damage=None):
    """Two gzip data members (one with a single gzip member for all records), one plain member without index; a gzip and a plain index."""
    def sha1(b):
        return hashlib.sha1(b)
    big = b"<p>big</p>" * 300_000
    info = _foreign_record("warcinfo", "info", "", b"software: other\r\n")
    chunked = b"5\r\nhello\r\n6;x=y\r\n world\r\n0\r\n\r\n"
    one = [_foreign_record("request", "http://a.example/", "GET / HTTP/1.1\r\nHost: a.example", b""),
           _foreign_record("response", "http://a.example/", "HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked", chunked,
                           "sha1:" + base64.b32encode(sha1(b"hello world").digest()).decode()),
           _foreign_record("response", "http://b.example/x?q=1", "HTTP/1.1 200 OK", big, "sha1:" + sha1(big).hexdigest()),
           _foreign_record("response", "http://b.example/y", "HTTP/1.1 404 Not Found\r\nContent-Length: 999", b"gone", "sha256:00")]
    two = [_foreign_record("response", "http://c.example/", "HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked", b"no chunks", packed=False),
           _foreign_record("revisit", "http://c.example/z", "HTTP/1.1 200 OK\r\nContent-Length: 11", b"", "sha1:" + sha1(b"hello world").hexdigest(),
                           packed=False, more=["WARC-Refers-To: <urn:uuid:1>"])]
    three = [_foreign_record("resource", f"urn:text:{k}", "", b"r" * k, packed=False) for k in (0, 1, 2_000_000)]
    lines, at = [], len(info)
    for k, r in enumerate(one):
        if k:  # requests are in no index
            lines.append(f'com,k{k})/ 20200102030405 {{"url": "u", "filename": "rec-1.warc.gz", "offset": "{at}", "length": "{len(r)}"}}')
        at += len(r)
    if damage == "name":
        lines[0] = lines[0].replace("rec-1", "rec-9")
    with zipfile.ZipFile(path, "w") as z:
        def put(name, data, method=zipfile.ZIP_STORED):
            z.writestr(zipfile.ZipInfo(name), data, method)
        put("datapackage.json", "{}")
        put("indexes/index.cdx.gz", gzip.compress("\n".join([" CDX header", *lines[:2]]).encode()) + gzip.compress(("\n" + lines[2]).encode()))
        put("indexes/index.idx", '!meta {"format": "cdxj-gzip-1.0"}')
        put("indexes/again.cdxj", "\n".join(lines[::-1]) + "\n", zipfile.ZIP_DEFLATED)
        put("archive/rec-1.warc.gz", info + b"".join(one), zipfile.ZIP_DEFLATED if damage == "method" else zipfile.ZIP_STORED)
        put("archive/rec-2.warc.gz", gzip.compress(b"".join(two)))
        put("archive/rec-3.warc", b"".join(three)[:-100 if damage == "cut" else None])
    return {("http://a.example/", "response", b"hello world"), ("http://b.example/x?q=1", "response", big), ("http://b.example/y", "response", b"gone"),
            ("http://c.example/", "response", b"no chunks"), ("http://c.example/z", "revisit", None),
            *((f"urn:text:{k}", "resource", b"r" * k) for k in (0, 1, 2_000_000))}


def test_archives_of_other_writers_are_read(spark, tmp_path):
    path = str(tmp_path / "other.wacz")
    want = _foreign_archive(path)
    manifest = spark.createDataFrame([(path,)], "path string")
    got = warc.read_archives(manifest, payload=True).collect()
    assert len(got) == len(want) and {(r.url, r.record_type, r.payload if r.payload is None else bytes(r.payload)) for r in got} == want
    for r in got:
        assert r.page_id is None and r.refers_to is None and r.record_id.startswith("<urn:uuid:")
        assert r.refers_to_record == ("<urn:uuid:1>" if r.record_type == "revisit" else None)
        assert r.payload_bytes == (11 if r.record_type == "revisit" else len(r.payload))
        assert r.payload_digest == hashlib.sha1(b"hello world" if r.record_type == "revisit" else r.payload).hexdigest()


@pytest.mark.parametrize("damage, message", [("name", "the index names"), ("method", "compressed in the ZIP"), ("cut", "cut off")])
def test_damaged_archives_of_other_writers_raise(tmp_path, damage, message):
    path = tmp_path / "bad.wacz"
    _foreign_archive(path, damage)
    with pytest.raises(ValueError, match=message), open(path, "rb") as f:
        for at, length, packed in warc._ranges(f, path.stat().st_size):
            list(map(warc.parse_record, warc.records_of(f, at, length, packed)))


def test_written_archives_have_the_usual_layout(spark, tmp_path):
    pages = spark.createDataFrame([(k, f"http://h{k}.Example:81/p{k}?x", "t" * k) for k in range(40)], "page_id long, url string, html string").coalesce(1)
    (path, records), = warc.write_archives(pages, str(tmp_path / "w")).collect()
    assert records == 40
    with zipfile.ZipFile(path) as z:
        assert {i.compress_type for i in z.infolist()} == {zipfile.ZIP_STORED}
        package = json.loads(z.read("datapackage.json"))
        for r in package["resources"]:
            data = z.read(r["path"])
            assert len(data) == r["bytes"] and r["hash"] == "sha256:" + hashlib.sha256(data).hexdigest()
        lines, data = z.read("indexes/index.cdx").decode().splitlines(), z.read("archive/data.warc.gz")
    assert len(lines) == 40 and lines == sorted(lines) and lines[0].startswith("example,h0:81)/p0?x 19700101000000 {")
    for line in lines:
        e = json.loads(line.split(" ", 2)[2])
        raw = gzip.decompress(data[int(e["offset"]):int(e["offset"]) + int(e["length"])])
        assert warc.parse_record(raw)["url"] == e["url"] and e["filename"] == "data.warc.gz"


# ---- pipeline -----------------------------------------------------------------------

def test_pipeline_stages_take_effect(spark):
    import corpus_pipeline
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    sizes = [docs.count()]
    for name, function in corpus_pipeline.STAGES[:-1]:
        out = stage(function(spark, docs, sf), f"test-{name}")
        assert out.dtypes == docs.dtypes, name
        docs = out
        sizes.append(docs.count())
    assert sizes[0] > sizes[1] > sizes[2] == sizes[3]
    changed = docs.filter("text like '%[EMAIL]%'")
    assert changed.count() and changed.filter("n_chars != length(text)").count() == 0
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert packed.select("doc_id").distinct().count() == sizes[3]


def _binomial_tail(n, risk, k):
    from math import comb
    return 1.0 if n == 0 or k >= n * risk else sum(comb(n, i) * risk ** i * (1 - risk) ** (n - i) for i in range(k + 1))


def _judged_good(docs, quality):
    """Ids of the documents that the base rule and the cutoffs certified on the labels keep."""
    from costindex.llm import quality_rules as Q
    passed, scores = {}, {}
    for i, text, lang, *_ in docs:
        c = dict(zip(Q.COUNTS, Q.text_counts(text)))
        if c["n_words"] >= 50 and 100 * c["n_repeat_words"] <= 50 * c["n_words"]:
            passed[i] = lang
            scores[i] = {r: c[top] * 1000 // c[bottom] for r, (top, bottom, _) in Q.RULES.items()}
    known = {i: quality[i] for i in passed if i in quality}
    level = 0.05 / (4 * len({passed[i] for i, q in known.items() if q}))
    keep = set(passed)
    for lang in set(passed.values()):
        good, bad = ([i for i, q in known.items() if q == v and passed[i] == lang] for v in (1, 0))
        for rule, (_, _, cuts) in Q.RULES.items():
            best, gain = None, 0
            for cut in sorted(cuts, reverse=True):
                k, b = (sum(scores[i][rule] > cut for i in x) for x in (good, bad))
                if _binomial_tail(len(good), 0.005, k) > level:
                    break
                if b - k > gain:
                    best, gain = cut, b - k
            if best is not None:
                keep -= {i for i in passed if passed[i] == lang and scores[i][rule] > best}
    return keep


def _fingerprint(text):
    import xxhash
    words = text.encode().lower().split()
    h = [xxhash.xxh64_intdigest(b" ".join(words[i:i + 3]), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def _least_of_each_group(docs):
    prints = {i: _fingerprint(t) for i, t in docs.items()}
    least = {}
    for i in sorted(docs):
        if i not in least:
            found, new = {i}, [i]
            while new:
                new = [j for j in docs if j not in found and any((prints[j] ^ prints[k]).bit_count() <= 3 for k in new)]
                found |= set(new)
            least |= dict.fromkeys(found, i)
    return set(least.values())


def test_pipeline_run_against_a_plain_version(spark, tmp_path):
    import corpus_pipeline
    rng = random.Random(12)
    marks = {"[EMAIL]": "ann.lee@mail.example.org", "[PHONE]": "+49 30 1234 5678", "[IP]": "10.20.30.40", "[CARD]": "4111 1111 1111 1111",
             "[IBAN]": "ES91 2100 0418 4502 0005 1332"}
    words = [a + b for a in ("lo", "mi", "ta", "re", "su") for b in ("rem", "na", "ver", "dol", "stan", "quel", "bur", "fi")]
    plain = [" ".join(rng.choice(words) for _ in range(60)) for _ in range(60)]
    docs, want, quality = [], {}, {}

    def add(template, lang="en", label=None):
        i = len(docs) + 1
        text = template
        for mark, value in marks.items():
            text = text.replace(mark, value)
        docs.append((i, text, lang, "s", len(text)))
        want[i] = template
        if label is not None:
            quality[i] = label

    for k in range(1300):
        add(plain[k % 40], label=1)                                            # enough labels, many exact copies
    for k in range(40):
        add(" ".join(f"{w}##" for w in plain[k].split()), label=0 if k < 30 else None)  # certified away in en
    for k in range(4):
        add(" ".join(f"{w}##" for w in plain[40 + k].split()), "de", 0)        # but not in de
    for k in range(40, 60):
        add(plain[k] + " write to [EMAIL] or call [PHONE] now", "de")
        add(plain[k] + " write to [EMAIL] or call [PHONE] then", "fr")         # near copies
    add(f"{plain[3][::-1]} host [IP], card [CARD]; pay [IBAN] EUR", "de")
    add("too short", "en")
    add("over and over again " * 40, "en")
    keep = _judged_good(docs, quality)
    assert not keep & set(range(1301, 1341)) and set(range(1341, 1345)) <= keep
    left = _least_of_each_group({i: t for i, t, *_ in docs if i in keep})
    assert 40 < len(left) < len(keep)
    rng.shuffle(docs)
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(list(quality.items()), "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    pieces = defaultdict(list)
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        pieces[r.doc_id].append(r)
    assert set(pieces) == left
    t = Tokenizer.from_file(WORDS)
    for i, own in pieces.items():
        ids, at = np.array(t.encode(want[i], add_special_tokens=False).ids + [2], "<u4"), 0
        for p in sorted(own, key=lambda p: p.start):
            assert (p.start, p.doc_tokens, p.ids_crc32) == (at, len(ids), zlib.crc32(ids[at:at + p.length].tobytes()))
            at += p.length
        assert at == len(ids)
