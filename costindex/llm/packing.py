"""Packing documents into training sequences by cutting-stock column generation.

1. Every document is encoded once.  Its whole sequences (``SEQUENCE`` tokens) fill
   sequences of their own; the rest, shorter than a sequence, is an item.
2. Items are counted by length class (``class_sizes``: a fixed, bounded histogram).
   A linear program over packing patterns is solved by column generation on that
   histogram: the duals price a pattern by a knapsack dynamic program, until no
   pattern improves.  The rounded-down solution and a first-fit-decreasing of
   the few items left over give patterns with copies.
3. Items are ranked within their class, and the rank alone tells pattern copy and
   so the sequence, with no search and no shuffle.
4. An item may be shorter than its class, which leaves a gap.  One document in
   ``FILL`` (by hash) is kept out as filler: gaps and fillers are laid out on one
   axis by running totals, and the overlap of a gap and a filler is a piece.
   Filler beyond the gaps fills further sequences; the tail is cut into lengths
   that are powers of two, which need no padding.  If there is less filler than
   gap, the remaining gaps are padding.

Only the histogram (at most ``len(class_sizes())`` rows) reaches the driver.

Defined results: a null or empty text is one token (the end id); repeated rows
and null ids are documents of their own; an empty table gives no pieces.
"""

from __future__ import annotations

import os
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from costindex.llm.bpe import byte_alphabet
from costindex.llm.common import WordCache, number_rows, partitions, stage

SEQUENCE = 4096
END_ID = 2
FILL = 16
#: Length classes: steps of FINE up to FINE_TO, of COARSE beyond.
FINE, FINE_TO, COARSE = 8, 256, 32
#: Words in each generation of a worker's caches.
CACHE = 160_000
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def class_sizes() -> list[int]:
    return [*range(FINE, FINE_TO + 1, FINE), *range(FINE_TO + COARSE, SEQUENCE + 1, COARSE)]


# ---- encoding -------------------------------------------------------------------

def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class WordIds:
    """Ids of texts as little-endian unsigned 32-bit, word by word.

    The tokenizer drops white space and splits there first, so a text's ids are
    its words' ids in order.  A word of letters up to U+00FF with punctuation
    behind is looked up in two parts, as the tokenizer splits it there too, and
    its letters go to the model directly: there lower-casing is all that the
    normaliser does.  Any other word goes through the whole tokenizer.
    """

    def __init__(self, path: str, limit: int = CACHE):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        # U+00C0 to U+00FF without the two signs among them, in UTF-8
        self.plain = re.compile(rb"((?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+)([.,!?;:#$%&*]*)")
        shown = {b: c for c, b in byte_alphabet().items()}
        self.shown = [shown[b] for b in range(256)]
        self.words = WordCache(self._word, limit)
        self.letters = WordCache(self._letters, limit)
        self.others = WordCache(self._encode, limit // 10)

    def _word(self, word: bytes) -> bytes:
        m = self.plain.fullmatch(word)
        if not m:
            return self._encode(word)
        ids = self.letters[m[1].decode("utf-8").lower()]
        return ids + self.others[m[2]] if m[2] else ids

    def _letters(self, letters: str) -> bytes:
        if not letters.isascii():
            letters = "".join(map(self.shown.__getitem__, letters.encode("utf-8")))
        return _packed([t.id for t in self.model.tokenize(letters)])

    def _encode(self, word: bytes) -> bytes:
        ids = self.tokenizer.encode(word.decode("utf-8"), add_special_tokens=False).ids
        return _packed(ids)

    def text(self, text: str) -> bytes:
        return b"".join(map(self.words.__getitem__, text.encode("utf-8").split()))


_WORDS: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    if path not in _WORDS:
        _WORDS[path] = WordIds(path)
    return _WORDS[path]


def encoded(docs: DataFrame, id_col: str, text_col: str, path: str, fill: int = FILL) -> DataFrame:
    """Stored rows: doc_id, n, whole (checksums of whole sequences), rest, rest_crc, rest_ids (fillers only), row."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                      (F.pmod(F.xxhash64(F.col(id_col).cast("long"), F.length(text_col)), F.lit(fill)) == 0).alias("filler"))
    step = SEQUENCE * 4
    end = END_ID.to_bytes(4, "little")

    def run(batches):
        words = word_ids(path)
        for b in batches:
            out = {k: [] for k in ("n", "whole", "rest", "rest_crc", "rest_ids")}
            for text, filler in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                ids = words.text(text or "") + end
                cut = len(ids) // step * step
                rest = ids[cut:]
                out["n"].append(len(ids) // 4)
                out["whole"].append([zlib.crc32(ids[i:i + step]) for i in range(0, cut, step)])
                out["rest"].append(len(rest) // 4)
                out["rest_crc"].append(zlib.crc32(rest))
                out["rest_ids"].append(rest if filler and rest else None)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(out["n"], pa.int64()), pa.array(out["whole"], pa.list_(pa.int64())),
                 pa.array(out["rest"], pa.int64()), pa.array(out["rest_crc"], pa.int64()), pa.array(out["rest_ids"], pa.binary())],
                names=["doc_id", *out])

    schema = "doc_id long, n long, whole array<long>, rest long, rest_crc long, rest_ids binary"
    return stage(src.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id()), "packing-encoded")


# ---- the linear program (driver, on a bounded histogram) ---------------------------

def _knapsack(weights: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Most valuable pattern within ``capacity`` (any number of each class)."""
    best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for c in range(1, capacity + 1):
        fits = weights <= c
        got = np.where(fits, best[np.maximum(c - weights, 0)] + values, -1.0)
        k = int(got.argmax())
        if got[k] > best[c - 1] + 1e-12:
            best[c], last[c] = got[k], k
        else:
            best[c] = best[c - 1]
    pattern, c = np.zeros(len(weights)), capacity
    while c > 0:
        if last[c] < 0:
            c -= 1
        else:
            pattern[last[c]] += 1
            c -= weights[last[c]]
    return float(best[capacity]), pattern


def solve_patterns(weights: list[int], demand: list[int], capacity: int, rounds: int = 4000) -> list[tuple[tuple[int, ...], int]]:
    """(items per class, copies) whose slots cover ``demand`` exactly."""
    w, d = np.array(weights, np.int64), np.array(demand, float)
    m = len(w)
    if m == 0:
        return []
    basis = np.diag((capacity // w).astype(float))
    x = d / np.diag(basis)
    for _ in range(rounds):
        duals = np.linalg.solve(basis.T, np.ones(m))
        value, pattern = _knapsack(w, duals, capacity)
        if value <= 1 + 1e-7:
            break
        along = np.linalg.solve(basis, pattern)
        ratio = np.full(m, np.inf)
        up = along > 1e-9
        ratio[up] = np.maximum(x[up], 0) / along[up]
        out = int(ratio.argmin())
        if not np.isfinite(ratio[out]):
            break
        x = x - ratio[out] * along
        x[out] = ratio[out]
        basis[:, out] = pattern
    copies = np.floor(np.maximum(x, 0) + 1e-9).astype(np.int64)
    a = basis.astype(np.int64)
    left = np.array(demand, np.int64) - a @ copies
    while (left < 0).any():  # rounding noise: give back a copy
        short = int(np.flatnonzero(left < 0)[0])
        p = int(np.flatnonzero((a[short] > 0) & (copies > 0))[0])
        copies[p] -= 1
        left += a[:, p]
    found = [(tuple(map(int, a[:, p])), int(copies[p])) for p in range(m) if copies[p]]
    bins: list[list] = []  # [free, items]: the rounding's remainder, first-fit-decreasing
    for k in sorted(range(m), key=lambda k: -w[k]):
        for _ in range(int(left[k])):
            home = next((b for b in bins if b[0] >= w[k]), None)
            if home is None:
                bins.append(home := [capacity, [0] * m])
            home[0] -= int(w[k])
            home[1][k] += 1
    return found + [(tuple(items), 1) for _, items in bins]


def slots(patterns: list[tuple[tuple[int, ...], int]]) -> tuple[dict[int, tuple[np.ndarray, ...]], int]:
    """Per class: first ranks, items a copy and first sequences of the patterns that use it; and the number of sequences."""
    per: dict[int, list] = {}
    used: dict[int, int] = {}
    base = 0
    for items, copies in patterns:
        for k, a in enumerate(items):
            if a:
                per.setdefault(k, []).append((used.get(k, 0), a, base))
                used[k] = used.get(k, 0) + a * copies
        base += copies
    return {k: tuple(np.array(v, np.int64).T) for k, v in per.items()}, base


# ---- assignment ---------------------------------------------------------------------

def _ranked(items: DataFrame) -> DataFrame:
    """Add ``rank`` within the class: ranks in hash buckets plus the buckets' offsets, so a hot class is many tasks."""
    spark = items.sparkSession
    buckets = max(partitions(spark), items.count() // 50_000)
    dealt = items.withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(buckets)))
    before = (dealt.groupBy("class", "bucket").agg(F.count(F.lit(1)).alias("size"))
              .withColumn("before", F.sum("size").over(W.partitionBy("class").orderBy("bucket")) - F.col("size"))
              .select("class", "bucket", "before"))
    own = F.row_number().over(W.partitionBy("class", "bucket").orderBy("row")) - 1
    return (dealt.withColumn("own", own).join(before, ["class", "bucket"])
            .select("row", "doc_id", "n", "rest", "rest_crc", "class", (F.col("own") + F.col("before")).alias("rank")))


def _placed(ranked: DataFrame, table: dict[int, tuple[np.ndarray, ...]]) -> DataFrame:
    """Add ``sequence`` from class and rank."""
    schema = ranked.select("*", F.lit(None).cast("long").alias("sequence")).schema
    cls, rank = ranked.columns.index("class"), ranked.columns.index("rank")

    def run(batches):
        for b in batches:
            c = b.column(cls).to_numpy(zero_copy_only=False)
            r = b.column(rank).to_numpy(zero_copy_only=False)
            seq = np.zeros(len(c), np.int64)
            for k in np.unique(c):
                at = c == k
                first, each, base = table[int(k)]
                p = np.searchsorted(first, r[at], side="right") - 1
                seq[at] = base[p] + (r[at] - first[p]) // each[p]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(seq)], names=[*b.schema.names, "sequence"])

    return ranked.mapInArrow(run, schema)


def _overlaps(gaps: DataFrame, fillers: DataFrame) -> DataFrame:
    """Pieces (row, from_rest, length, sequence, offset): overlaps of gap and filler intervals on one axis.

    Both are cut by blocks of ``SEQUENCE`` positions; a pair is kept in the block of its first position.
    """
    def blocks(at: str, size: str):
        return F.explode(F.sequence(F.floor(F.col(at) / SEQUENCE), F.floor((F.col(at) + F.col(size) - 1) / SEQUENCE)))

    g = gaps.withColumn("block", blocks("gap_at", "gap"))
    f = fillers.withColumn("block", blocks("fill_at", "rest"))
    lo, hi = F.greatest("gap_at", "fill_at"), F.least(F.col("gap_at") + F.col("gap"), F.col("fill_at") + F.col("rest"))
    return (g.join(f, "block").filter((lo < hi) & (F.floor(lo / SEQUENCE) == F.col("block")))
            .select("row", (lo - F.col("fill_at")).alias("from_rest"), (hi - lo).alias("length"),
                    "sequence", (F.col("used") + lo - F.col("gap_at")).alias("offset")))


def _with_crc(pieces: DataFrame, tokens: DataFrame) -> DataFrame:
    """Checksums of filler pieces from the fillers' stored ids."""
    joined = pieces.join(tokens.filter("rest_ids is not null").select("row", "doc_id", "n", "rest", "rest_ids"), "row").select(
        "doc_id", (F.col("n") - F.col("rest") + F.col("from_rest")).alias("start"), "length", "n", "sequence", "offset", "from_rest", "rest_ids")

    def run(batches):
        for b in batches:
            crcs = [zlib.crc32(ids[a * 4:(a + k) * 4]) for a, k, ids in
                    zip(*(b.column(c).to_pylist() for c in ("from_rest", "length", "rest_ids")))]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("start"), b.column("length"), pa.array(crcs, pa.int64()),
                 b.column("n"), b.column("sequence"), b.column("offset")],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    return joined.mapInArrow(run, PIECES)


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", fill: int = FILL) -> DataFrame:
    """The pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    tokens = encoded(docs, id_col, text_col, tokenizer_path, fill)
    sizes = class_sizes()
    cls = F.when(F.col("rest") <= FINE_TO, F.ceil(F.col("rest") / FINE) - 1).otherwise(
        F.ceil((F.col("rest") - FINE_TO) / COARSE) + FINE_TO // FINE - 1).cast("int")
    items = tokens.filter("rest > 0 and rest_ids is null").select("row", "doc_id", "n", "rest", "rest_crc", cls.alias("class"))

    counts = {r["class"]: r["count"] for r in items.groupBy("class").count().collect()}
    present = sorted(counts)
    patterns = solve_patterns([sizes[k] // FINE for k in present], [counts[k] for k in present], SEQUENCE // FINE)
    by_index, n_packed = slots(patterns)
    placed = stage(_placed(_ranked(items), {present[k]: v for k, v in by_index.items()}), "packing-placed")
    in_order = W.partitionBy("sequence").orderBy(F.desc("rest"), "row").rowsBetween(W.unboundedPreceding, W.currentRow)
    item_pieces = placed.withColumn("offset", F.sum("rest").over(in_order) - F.col("rest")).select(
        "doc_id", (F.col("n") - F.col("rest")).alias("start"), F.col("rest").alias("length"),
        F.col("rest_crc").alias("ids_crc32"), F.col("n").alias("doc_tokens"), F.col("sequence").alias("sequence_id"), "offset")

    whole = stage(tokens.filter("size(whole) > 0").select("row", "doc_id", "n", "whole", F.size("whole").cast("long").alias("count")), "packing-whole")
    numbered = number_rows(whole, "count", "first", "row")
    n_whole = whole.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    whole_pieces = numbered.select("doc_id", "n", "first", F.posexplode("whole").alias("k", "crc")).select(
        "doc_id", (F.col("k") * F.lit(SEQUENCE)).cast("long").alias("start"), F.lit(SEQUENCE).cast("long").alias("length"),
        F.col("crc").alias("ids_crc32"), F.col("n").alias("doc_tokens"),
        (F.lit(n_packed) + F.col("first") + F.col("k")).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))

    gaps = stage(placed.groupBy("sequence").agg(F.sum("rest").alias("used"))
                 .withColumn("gap", F.lit(SEQUENCE) - F.col("used")).filter("gap > 0"), "packing-gaps")
    fillers = stage(tokens.filter("rest_ids is not null").select("row", "rest"), "packing-fillers")
    gap_total = gaps.agg(F.coalesce(F.sum("gap"), F.lit(0))).first()[0]
    fill_total = fillers.agg(F.coalesce(F.sum("rest"), F.lit(0))).first()[0]
    gap_rows = number_rows(gaps, "gap", "gap_at", "sequence").select("sequence", "used", "gap", "gap_at")
    fill_rows = number_rows(fillers, "rest", "fill_at", "row").select("row", "rest", "fill_at")
    extra, tail = divmod(max(0, fill_total - gap_total), SEQUENCE)
    n_used = n_packed + n_whole
    more = spark.range(extra).select((F.col("id") + n_used).alias("sequence"), F.lit(0).cast("long").alias("used"),
                                     F.lit(SEQUENCE).cast("long").alias("gap"), (F.col("id") * SEQUENCE + gap_total).alias("gap_at"))
    powers, at = [], gap_total + extra * SEQUENCE
    for bit in reversed(range(SEQUENCE.bit_length())):
        if tail >> bit & 1:
            powers.append((n_used + extra + len(powers), 0, 1 << bit, at))
            at += 1 << bit
    last = spark.createDataFrame(powers, "sequence long, used long, gap long, gap_at long")
    fill_pieces = _with_crc(_overlaps(gap_rows.unionByName(more).unionByName(last), fill_rows), tokens)
    return item_pieces.unionByName(whole_pieces).unionByName(fill_pieces)
