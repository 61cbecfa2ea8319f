"""SimHash near-duplicate detection: 64-bit fingerprints, compared exactly in tiles.

Fingerprint: lower-case A-Z, words separated by ASCII white space, shingles of
``shingle`` words joined by a space (a shorter text is one shingle, no words: a
fingerprint of zero), each hashed by XXH64 (seed 42); a bit is 1 when it is set
in more than half of the hashes, repeats included.

Comparison: equal fingerprints are collapsed first.  Distinct fingerprints are
range-partitioned by (population count, population count of the low half) and
cut into tiles of one population count each.  A pair of tiles is compared only
when the counts differ by at most the radius, as a differing bit changes the
count by one; the same holds for the two halves together, for tiles and inside
a pair.  Neighbouring tiles form groups, and a task compares two groups: it reads
each of their tiles once and forms the pairs itself, so what is shuffled is a
group per group it may meet, not a tile per tile.  The comparison is numpy
exclusive-or and bit count over blocks.  A task returns a spanning forest of its
links, never all of them, and the forests are joined by connected components.

Defined results: a null or empty text has fingerprint zero and links like any
other; repeated rows are rows of their own with the same component; a null id
takes part but never names a component, unless all ids of the component are
null; an empty table gives an empty one.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from costindex.llm.common import append_columns, free_name, partitions, stage, unite
from costindex.llm.components import connected_components

RADIUS = 3
SHINGLE = 3
SEED = 42
#: Most fingerprints in one tile (8 bytes each).
TILE = 1 << 15
#: Most tiles in one group; a power of two.  A task holds two groups.
GROUP = 32
#: Elements compared at once inside a task.
BLOCK = 1 << 20


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    words = text.encode("utf-8", "surrogatepass").lower().split()
    n = len(words)
    if n == 0:
        return 0
    joined = b" ".join(words)
    if n <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    digest = xxhash.xxh64_intdigest
    ends = [e - 1 for e in accumulate(len(w) + 1 for w in words)]
    starts = [0, *[e + 1 for e in ends]]
    m = n - shingle + 1
    counts = np.zeros(64, np.int64)
    for lo in range(0, m, 1 << 16):
        hi = min(m, lo + (1 << 16))
        h = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts[lo:hi], ends[lo + shingle - 1:hi + shingle - 1])),
                        np.uint64, hi - lo)
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > m, bitorder="little").view(np.uint64)[0])


def with_fingerprint(df: DataFrame, text_col: str = "text", out: str = "fp", shingle: int = SHINGLE) -> DataFrame:
    """Add the fingerprint as a signed long."""
    def kernel(texts):
        return [np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64)]

    return append_columns(df, text_col, [(out, pa.int64(), "long")], kernel)


def _tiles(prints: DataFrame, tile: int, group: int) -> DataFrame:
    """Pack distinct fingerprints (fp, pop, low) into stored rows (tile_group, pop, low_min, low_max, prints) of one population count."""
    spark = prints.sparkSession
    dealt = prints.repartitionByRange(partitions(spark), "pop", "low", "fp").sortWithinPartitions("pop", "low")

    def pack(batches):
        held, pop = [], None

        def row():
            values = np.concatenate(held)
            low = _halves(values[[0, -1]].view(np.uint64))
            return pa.RecordBatch.from_arrays(
                [pa.array([pop], pa.int32()), pa.array(low[:1], pa.int32()), pa.array(low[1:], pa.int32()), pa.array([values.tobytes()], pa.binary())],
                names=["pop", "low_min", "low_max", "prints"])

        for b in batches:
            fp = b.column(0).to_numpy(zero_copy_only=False)
            pops = b.column(1).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(np.diff(pops)) + 1
            for part, value in zip(np.split(fp, cuts), pops[np.r_[0, cuts]] if len(pops) else []):
                for lo in range(0, len(part), tile):
                    piece = part[lo:lo + tile]
                    if held and (value != pop or sum(map(len, held)) + len(piece) > tile):
                        yield row()
                        held = []
                    pop = int(value)
                    held.append(piece)
        if held:
            yield row()

    packed = dealt.select("fp", "pop").mapInArrow(pack, "pop int, low_min int, low_max int, prints binary")
    # the id counts the rows of a partition, which are in order; groups do not cross partitions
    number = F.monotonically_increasing_id()
    return stage(packed.withColumn("tile", number).withColumn("tile_group", F.col("tile") - F.pmod("tile", F.lit(group))).drop("tile"), "simhash-tiles")


def _halves(v: np.ndarray) -> np.ndarray:
    return np.bitwise_count(v & np.uint64(0xFFFFFFFF)).astype(np.int64)


def compare(a: np.ndarray, b: np.ndarray, same: bool, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within one pair of tiles as (fingerprint, least linked fingerprint of its set) of a spanning forest.

    Both are sorted by the population count of the low half and have one total each.
    """
    nodes = a if same else np.concatenate([a, b])
    at = 0 if same else len(a)
    root = np.arange(len(nodes))
    low_a, low_b = _halves(a), _halves(b)
    total = int(np.bitwise_count(b[0])) - int(np.bitwise_count(a[0]))
    for value in np.unique(low_a):
        rows = np.arange(*np.searchsorted(low_a, [value, value + 1]))
        # the halves' counts may differ by d and total - d: |d| + |total - d| <= radius
        spread = [d for d in range(-radius, radius + 1) if abs(d) + abs(total - d) <= radius]
        lo, hi = np.searchsorted(low_b, [value + spread[0], value + spread[-1] + 1])
        if lo == hi:
            continue
        step = max(1, BLOCK // (hi - lo))
        for k in range(0, len(rows), step):
            r = rows[k:k + step]
            i, j = np.nonzero(np.bitwise_count(a[r][:, None] ^ b[lo:hi][None, :]) <= radius)
            if same:
                later = r[i] < j + lo
                i, j = i[later], j[later]
            if len(i):
                root = unite(root, r[i], j + lo + at)
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[moved], nodes[root[moved]]


def _may_link(total, low_a: tuple, low_b: tuple, radius: int, greatest=max):
    """Whether fingerprints whose counts differ by ``total`` (not negative), with low halves in these ranges, can be near.

    The low counts differ by some d of a range and the high ones by total - d;
    |d| + |total - d| is total plus twice the distance of d from [0, total].
    """
    return total + 2 * greatest(total * 0, low_b[0] - low_a[1] - total, low_a[0] - low_b[1]) <= radius


def group_pairs(tiles: DataFrame, radius: int) -> DataFrame:
    """Pairs (a, b), a <= b, of tile groups that may hold links; a row per group and count is all it looks at."""
    ranges = stage(tiles.groupBy("tile_group", "pop").agg(F.min("low_min").alias("lo"), F.max("low_max").alias("hi")), "simhash-groups")
    a = ranges.select(F.col("tile_group").alias("a"), F.col("pop").alias("pop_a"), F.col("lo").alias("lo_a"), F.col("hi").alias("hi_a"),
                      F.explode(F.sequence("pop", F.col("pop") + F.lit(radius))).alias("pop_b"))
    b = ranges.select(F.col("tile_group").alias("b"), F.col("pop").alias("pop_b"), F.col("lo").alias("lo_b"), F.col("hi").alias("hi_b"))
    near = _may_link(F.col("pop_b") - F.col("pop_a"), (F.col("lo_a"), F.col("hi_a")), (F.col("lo_b"), F.col("hi_b")), radius, F.greatest)
    # groups are numbered in the order of the counts, so a larger count never has a smaller number
    return a.join(b, "pop_b").filter(near & (F.col("a") <= F.col("b"))).select("a", "b").distinct()


def compare_groups(left: list[tuple], right: list[tuple] | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Forest links between two groups of tiles (pop, low_min, low_max, prints); ``right`` is None for a group with itself."""
    us, vs = [], []
    for i, x in enumerate(left):
        for j, y in enumerate(left if right is None else right):
            if right is None and j < i:
                continue
            p, q = (x, y) if x[0] <= y[0] else (y, x)
            if _may_link(q[0] - p[0], p[1:3], q[1:3], radius):
                u, v = compare(p[3], q[3], right is None and i == j, radius)
                us.append(u)
                vs.append(v)
    if not us:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    u, v = np.concatenate(us), np.concatenate(vs)
    nodes = np.unique(np.concatenate([u, v]))
    root = unite(np.arange(len(nodes)), np.searchsorted(nodes, u), np.searchsorted(nodes, v))
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[moved], nodes[root[moved]]


def _links(prints: DataFrame, radius: int, tile: int, group: int) -> DataFrame:
    """Forest links (u, v) between distinct fingerprints at most ``radius`` bits apart."""
    tiles = _tiles(prints, tile, group)
    pairs = stage(group_pairs(tiles, radius), "simhash-pairs")
    needed = pairs.select("a", "b", F.explode(F.array_distinct(F.array("a", "b"))).alias("tile_group"))
    # dealt by number, as the sizes say nothing about the work; a task holds two groups at a time
    full = needed.join(tiles, "tile_group").repartition(partitions(prints.sparkSession), "a", "b")

    def run(table):
        groups: dict[int, list[tuple]] = {}
        for g, *counts, held in zip(*(table.column(c).to_pylist() for c in ("tile_group", "pop", "low_min", "low_max", "prints"))):
            groups.setdefault(g, []).append((*counts, np.frombuffer(held, np.uint64)))
        a, b = table.column("a")[0].as_py(), table.column("b")[0].as_py()
        u, v = compare_groups(groups[a], None if a == b else groups[b], radius)
        return pa.table([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])

    return full.groupBy("a", "b").applyInArrow(run, "u long, v long")


def components_of(prints: DataFrame, id_col: str, fp_col: str, radius: int = RADIUS, tile: int = TILE,
                  out: str = "component_id", group: int = GROUP) -> DataFrame:
    """Add to every row the least id reachable over fingerprints at most ``radius`` bits apart.

    ``prints`` must be stored: it is read several times.
    """
    reps = stage(
        prints.select(F.col(fp_col).alias("fp"), F.col(id_col).alias("rep")).groupBy("fp").agg(F.min("rep").alias("rep"))
        .withColumn("pop", F.bit_count("fp").cast("int"))
        .withColumn("low", F.bit_count(F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))).cast("int")), "simhash-distinct")
    sets = connected_components(_links(reps, radius, tile, group))
    linked = stage(reps.join(sets, reps.fp == sets.node).select("fp", "rep", "component"), "simhash-linked")
    least = stage(linked.groupBy("component").agg(F.min("rep").alias("least")), "simhash-least")
    named = linked.join(least, "component").select("fp", "least")
    key = free_name(prints, "same_print")
    of_print = stage(reps.join(named, "fp", "left")
                     .select(F.col("fp").alias(key), F.coalesce("least", "rep").alias(out)), "simhash-components")
    return prints.join(of_print, prints[fp_col] == of_print[key], "left").drop(key)


def hex_print(col) -> F.Column:
    return F.lower(F.lpad(F.hex(col), 16, "0"))


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row per row of ``docs``: id, fingerprint (16 hex digits), component_id, kept (the row with the least id)."""
    ids = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    prints = stage(with_fingerprint(ids, "text", "fp", shingle).select("doc_id", "fp"), "simhash-prints")
    found = components_of(prints, "doc_id", "fp", radius)
    return found.select("doc_id", hex_print("fp").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one document of each near-duplicate group: the one whose id is least.

    Rows that repeat that id within the group are reduced to one; a group
    without any id keeps one row.
    """
    row, fp, comp = (free_name(docs, n) for n in ("row_no", "row_print", "row_component"))
    keyed = stage(with_fingerprint(docs, text_col, fp, shingle).withColumn(row, F.monotonically_increasing_id()), "simhash-docs")
    found = components_of(keyed.select(F.col(id_col).alias("own_id"), row, fp), row, fp, radius, out=comp)
    first = found.groupBy(comp).agg(F.min(F.struct(F.col("own_id").isNull(), "own_id", row)).alias("first"))
    return keyed.join(first.select(F.col(f"first.{row}").alias(row)), row, "left_semi").select(*docs.columns)
