"""Periodic runs of words: stretches that repeat a block of words several times.

A run is a stretch of consecutive words with smallest period q (words q apart
are equal), at least ``MIN_EXPONENT`` periods and ``MIN_LENGTH`` words long, that
no neighbouring word extends.

Periods up to ``SHORT`` are found by direct lag scans.  Longer ones come from
multi-scale minimizers.  At the scale of periods in (s, 2s], every word starts a
gram of 2s words, named exactly (two grams have one name when their words are
equal; names of double length are made of pairs of names).  The least gram, in a
fixed random order, of every window of s neighbouring grams is a minimizer.
Inside a run the windows repeat at distance q, so their minima do, and as a gram
at least as long as the period recurs at no shorter distance, neighbouring
occurrences of one minimizer are q apart: such pairs seed the extension.  Scales
end when no gram repeats.

Texts of a batch are scanned as one array of word numbers with a number of its
own between any two texts, which no run can cross.  Work grows with the words
times the scales, that is with n log n.

Defined results: words are ``[^\\x20\\x09-\\x0D]+``; a null or empty text has no words
and no runs, and its collapsed text is empty; equal words are equal bytes; rows
are independent, so ties and repeated rows need no rule; a very long text is a
batch of its own; an empty table gives an empty one; new columns get free names
from the caller (``runs_col``, ``collapsed_col`` must not be columns already).
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from costindex.llm.common import append_columns

MIN_EXPONENT = 4
MIN_LENGTH = 6
#: Longest period found by direct lag scans.
SHORT = 16
#: Texts are scanned together up to this many bytes.
BLOCK_BYTES = 2_000_000

RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
RUNS = "array<struct<start:long,length:long,period:long>>"


def least_length(period: int) -> int:
    return max(MIN_LENGTH, MIN_EXPONENT * period)


def _prime_factors(n: int) -> list[int]:
    found, f = [], 2
    while f * f <= n:
        if n % f == 0:
            found.append(f)
            while n % f == 0:
                n //= f
        f += 1
    return found + [n] if n > 1 else found


def _is_smallest(w: np.ndarray, start: int, period: int) -> bool:
    """Whether a stretch with this period, at least two periods long, has no smaller one.

    Two periods whose sum is at most the length have their greatest common
    divisor as a period too, so a smaller one would divide this one.
    """
    block = w[start:start + 2 * period]
    return not any(np.array_equal(block[:period], block[period // f:period // f + period]) for f in _prime_factors(period))


def _stretches(equal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of True."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], equal.view(np.int8), [0]))))
    return edge[::2], edge[1::2]


def _short_runs(w: np.ndarray, longest: int) -> Iterator[tuple[int, int, int]]:
    for q in range(1, longest + 1):
        if len(w) < least_length(q):
            return
        starts, ends = _stretches(w[q:] == w[:-q])
        for i in np.flatnonzero(ends - starts >= least_length(q) - q):
            if _is_smallest(w, starts[i], q):
                yield int(starts[i]), int(ends[i] - starts[i]) + q, q


def _named(gram: np.ndarray, size: int, kinds: int) -> tuple[np.ndarray, int]:
    """Names of the grams twice as long: those below the returned number recur, every other one is alone.

    A gram with a part that is alone is alone itself, so only pairs of parts
    that recur are sorted.
    """
    a, b = gram[:-size], gram[size:]
    both = np.flatnonzero((a < kinds) & (b < kinds))
    _, number, times = np.unique(a[both] * kinds + b[both], return_inverse=True, return_counts=True)
    recurs = times > 1
    new = np.cumsum(recurs) - 1
    again = recurs[number]
    kinds = int(recurs.sum())
    named = np.arange(kinds, kinds + len(a))
    named[both[again]] = new[number[again]]
    return named, kinds


def _mixed(names: np.ndarray) -> np.ndarray:
    """A fixed random order of the names (a one-to-one mix of 64 bits)."""
    x = names.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def _minimizers(order: np.ndarray, window: int) -> np.ndarray:
    """Positions that hold the least of some ``window`` neighbours (a power of two), the first of equal ones."""
    best, at, size = order, np.arange(len(order)), 1
    while size < window and len(best):
        left, right = best[:-size], best[size:]
        first = left <= right
        at = np.where(first, at[:-size], at[size:])
        best = np.where(first, left, right)
        size *= 2
    return np.unique(at)


def _reach(w: np.ndarray, at: int, lag: int, step: int) -> int:
    """How many places from ``at``, going by ``step``, have a word equal to the one ``lag`` further."""
    done, size = 0, 64
    while True:
        if step > 0:
            lo, hi = at + done, min(at + done + size, len(w) - lag)
            differ = np.flatnonzero(w[lo:hi] != w[lo + lag:hi + lag]) if hi > lo else np.empty(0)
            n = max(0, hi - lo)
        else:
            hi = at - done
            lo = max(0, hi - size)
            differ = np.flatnonzero((w[lo:hi] != w[lo + lag:hi + lag])[::-1])
            n = hi - lo
        if len(differ):
            return done + int(differ[0])
        if n < size:
            return done + n
        done, size = done + n, size * 2


def _extended(w: np.ndarray, seeds: np.ndarray, q: int) -> Iterator[tuple[int, int, int]]:
    """Runs of period q that hold a seed; seeds are ascending places with equal grams q apart."""
    covered = -1
    for s in seeds.tolist():
        if s < covered:
            continue
        start = s - _reach(w, s, q, -1)
        end = s + _reach(w, s, q, 1)
        covered = end
        if end - start + q >= least_length(q) and _is_smallest(w, start, q):
            yield start, end - start + q, q


def _long_runs(w: np.ndarray, longest: int) -> Iterator[tuple[int, int, int]]:
    scale = SHORT
    gram, kinds, size = w, int(w.max(initial=-1)) + 1, 1
    while scale < longest:
        while size < 2 * scale:
            if len(gram) <= size:
                return
            gram, kinds = _named(gram, size, kinds)
            size *= 2
            if not kinds:  # no gram recurs, nor does any longer one
                return
        # all grams of a run recur, and there are more than two periods of them
        starts, ends = _stretches(gram < kinds)
        wide = ends - starts > 2 * scale
        starts, sizes = starts[wide], (ends - starts)[wide]
        place = np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        at = place[_minimizers(_mixed(gram[place]), scale)]
        by_name = at[np.lexsort((at, gram[at]))]
        lag = np.diff(by_name)
        near = np.flatnonzero((gram[by_name[1:]] == gram[by_name[:-1]]) & (lag > scale) & (lag <= 2 * scale))
        for q in np.unique(lag[near]).tolist():
            yield from _extended(w, np.sort(by_name[near[lag[near] == q]]), q)
        scale *= 2


def runs_of(w: np.ndarray, longest_text: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of an array of word numbers, by start, then period."""
    longest = longest_text // MIN_EXPONENT
    return sorted([*_short_runs(w, min(SHORT, longest)), *_long_runs(w, longest)], key=lambda r: (r[0], r[2]))


def _block(texts: list[bytes]) -> Iterator[tuple[list[dict], str]]:
    """Runs and collapsed text of each text, scanned together."""
    words = [t.split() for t in texts]  # bytes.split() splits at the six ASCII white space characters
    sizes = np.array([len(x) for x in words])
    starts = np.concatenate(([0], np.cumsum(sizes + 1)))[:-1]
    number: defaultdict[bytes, int] = defaultdict(count().__next__)
    w = np.empty(int(sizes.sum()) + len(texts), dtype=np.int64)
    for at, x in zip(starts.tolist(), words):
        w[at:at + len(x)] = [number[word] for word in x]
    w[starts + sizes] = np.arange(len(number), len(number) + len(texts))  # between texts
    found = runs_of(w, int(sizes.max(initial=0)))
    drop = np.zeros(len(w) + 1, dtype=np.int32)
    for start, length, q in found:
        drop[start + q] += 1
        drop[start + length] -= 1
    keep = np.cumsum(drop) == 0
    of = np.searchsorted(starts, [r[0] for r in found], side="right") - 1
    runs: dict[int, list[dict]] = {}
    for text, (start, length, q) in zip(of.tolist(), found):
        runs.setdefault(text, []).append({"start": start - int(starts[text]), "length": length, "period": q})
    for k, x in enumerate(words):
        if k in runs:
            x = [x[i] for i in np.flatnonzero(keep[starts[k]:starts[k] + len(x)]).tolist()]
        yield runs.get(k, []), b" ".join(x).decode()


def _blocks(texts: list[str]) -> Iterator[list[bytes]]:
    block, size = [], 0
    for t in texts:
        t = t.encode()
        if block and size + len(t) > BLOCK_BYTES:
            yield block
            block, size = [], 0
        block.append(t)
        size += len(t)
    if block:
        yield block


def find_runs(texts: list[str]) -> list[Iterable]:
    """The runs and the collapsed text of each text."""
    found = [x for block in _blocks(texts) for x in _block(block)]
    return [[r for r, _ in found], [c for _, c in found]]


def with_runs(df: DataFrame, text_col: str = "text", runs_col: str = "runs", collapsed_col: str = "collapsed") -> DataFrame:
    """Add the runs of each text, by start, then period, and the text with every run cut to its first period.

    A word goes when any run holds it after that run's first period; the words
    left are joined by one space.
    """
    return append_columns(df, text_col, [(runs_col, RUN, RUNS), (collapsed_col, pa.string(), "string")], find_runs)


def repeated_tail(text: str, number: int) -> str:
    """The damage of the registered query: for some numbers, the words from a place on repeat a block."""
    if number % 10:
        return text
    words, g = text.encode().split(), number // 10
    n = len(words)
    if not n:
        return text
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return b" ".join(words[:a] + [words[a + (i - a) % p] for i in range(a, n)]).decode()


def planted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and text of all documents, with a repeated tail planted by the crc32 of the id in about one of ten."""
    number = F.crc32(F.col(id_col).cast("string")).alias("number")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, texts, numbers = b.columns
            # a null id has no number and is left as it is
            changed = [repeated_tail(t or "", 1 if h is None else h) for t, h in zip(texts.to_pylist(), numbers.to_pylist())]
            yield pa.RecordBatch.from_arrays([ids, pa.array(changed, pa.string())], names=["doc_id", "text"])

    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), number)
    return d.mapInArrow(run, d.select("doc_id", "text").schema)


def run_digests(runs: DataFrame) -> DataFrame:
    """From doc_id, runs and collapsed: the number of runs, the longest one, and digests of all."""
    longest = F.array_max(F.transform("runs", lambda r: F.struct(  # ties: least start, then period
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(
        ",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))), "")
    top: Column = F.col("longest")
    return runs.withColumn("longest", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-top["start"]).alias("start"), top["length"].alias("length"),
        (-top["period"]).alias("period"), F.floor(1000 * top["length"] / -top["period"]).cast("long").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
