"""Embedding near-duplicates by an inverted multi-index.

Vectors of one label whose cosine reaches the threshold are linked.  Equal
vectors are collapsed first.  Unit vectors are split in two halves; each half has
its own codebook (k-means on a bounded sample), and the pair of nearest
centroids is a cell of the product grid.  A vector is stored in its home cell and
visits other cells in the order of a lower bound on the distance to anything
stored there (multi-sequence traversal of the two sorted lists).  The bound of a
half is its distance to the plane between the centroids, so with

    bound(i)^2 + bound(j)^2 > 2 - 2 * threshold

no link can lie in cell (i, j) or any later one: at ``target_recall`` 1 the
traversal stops there and the result is complete.  For a lower target the stop
is the quantile of the bounds of the sample's own links.  Candidates are
verified by their cosine in double precision.

Each pair of vectors meets once (cells are visited upwards only).  The rows of a
large cell are dealt to chunks, and a task compares two chunks; it returns
weighted link counts and a spanning forest, never all pairs.  Components are
found by joins (``components``).

Defined results: vectors that are null, zero, or hold null or non-finite
components, and rows without label, link with nothing; vectors of different
length have no cosine and are not linked; repeated rows are vectors of their own
(each other's links); rows without an id count as links but do not name a
component unless none has an id; an empty table gives an empty one.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from costindex.llm.common import stage, unite
from costindex.llm.components import connected_components

THRESHOLD = 0.98
TARGET_RECALL = 1.0
#: Vectors that the codebooks are fitted on (those with the least hashes).
SAMPLE = 8192
#: Wished vectors per cell and label, and most centroids per half.
PER_CELL, MOST_CENTROIDS = 256, 256
#: Most vectors of one side in a task.
CHUNK = 512


def unit(v: np.ndarray) -> np.ndarray:
    v = v.astype(np.float64)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _squares(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    d = (x * x).sum(1)[:, None] - 2 * x @ centroids.T + (centroids * centroids).sum(1)[None, :]
    return np.maximum(d, 0)


def kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = _squares(x, c).argmin(1)
        size = np.bincount(near, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        used = size > 0
        c[used] = total[used] / size[used, None]
    return np.unique(c, axis=0)


class Grid:
    """Two codebooks and the traversal of their product grid."""

    def __init__(self, sample: np.ndarray, k: int, threshold: float, target_recall: float):
        self.half = sample.shape[1] // 2
        self.books = (kmeans(sample[:, :self.half], k), kmeans(sample[:, self.half:], k)) if len(sample) and self.half else (
            np.zeros((1, self.half)), np.zeros((1, sample.shape[1] - self.half)))
        self.apart = [np.sqrt(_squares(c, c)) for c in self.books]
        self.limit = (2 - 2 * threshold) * (1 + 1e-9) + 1e-12
        if target_recall < 1:
            self.limit = self._calibrate(sample, threshold, target_recall)

    def bounds(self, x: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per half: home centroid and squared bounds to every centroid's region."""
        out = []
        for v, c, apart in zip((x[:, :self.half], x[:, self.half:]), self.books, self.apart):
            d = _squares(v, c)
            home = d.argmin(1)
            gap = apart[home]
            with np.errstate(divide="ignore", invalid="ignore"):
                b = np.where(gap > 0, (d - d[np.arange(len(d)), home][:, None]) / (2 * gap), 0)
            out.append((home, np.maximum(b - 1e-9, 0) ** 2))
        return out

    def _calibrate(self, sample, threshold, target):
        (h1, b1), (h2, b2) = self.bounds(sample)
        found = []
        for lo in range(0, len(sample), 1024):
            i, j = np.nonzero(sample[lo:lo + 1024] @ sample.T >= threshold)
            i += lo
            found.append((b1[i, h1[j]] + b2[i, h2[j]])[i != j])
        found = np.concatenate(found) if found else np.zeros(0)
        return min(self.limit, float(np.quantile(found, target)) * (1 + 1e-9) + 1e-12) if len(found) else self.limit

    def visit(self, x: np.ndarray):
        """Per vector: home cell and the later cells to visit, nearest first."""
        (h1, b1), (h2, b2) = self.bounds(x)
        width = len(self.books[1])
        for r in range(len(x)):
            home = int(h1[r]) * width + int(h2[r])
            c1, c2 = np.flatnonzero(b1[r] <= self.limit), np.flatnonzero(b2[r] <= self.limit)
            c1, c2 = c1[np.argsort(b1[r, c1], kind="stable")], c2[np.argsort(b2[r, c2], kind="stable")]
            s1, s2 = b1[r, c1], b2[r, c2]
            cells, heap, seen = [], [(float(s1[0] + s2[0]), 0, 0)], {(0, 0)}
            while heap:
                bound, p, q = heapq.heappop(heap)
                if bound > self.limit:
                    break
                cell = int(c1[p]) * width + int(c2[q])
                if cell > home:
                    cells.append(cell)
                for n in ((p + 1, q), (p, q + 1)):
                    if n[0] < len(s1) and n[1] < len(s2) and n not in seen:
                        seen.add(n)
                        heapq.heappush(heap, (float(s1[n[0]] + s2[n[1]]), *n))
            yield home, cells


def _cells(reps: DataFrame, grids: dict[int, Grid]) -> DataFrame:
    """Rows (label, dim, cell, probe, node, copies, vector): each vector at home and in the cells it visits."""
    def run(batches):
        for b in batches:
            labels, nodes, copies = (b.column(k).to_pylist() for k in ("label", "node", "copies"))
            raw = b.column("embedding")
            vectors = raw.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(raw.value_lengths().to_numpy(zero_copy_only=False))
            dims = np.diff(ends, prepend=0)
            rows = []
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                own = np.stack([vectors[ends[k] - dim:ends[k]] for k in at])
                grid = grids.get(int(dim))
                visits = grid.visit(unit(own)) if grid else ((0, []) for _ in at)
                for k, v, (home, cells) in zip(at, own, visits):
                    data = v.tobytes()
                    rows += [(labels[k], int(dim), c, p, nodes[k], copies[k], data) for c, p in [(home, False), *[(c, True) for c in cells]]]
            for lo in range(0, len(rows), 10_000):
                cols = list(zip(*rows[lo:lo + 10_000]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, (labels_type, pa.int32(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.binary()))],
                    names=["label", "dim", "cell", "probe", "node", "copies", "vector"])

    labels_type = pa.int64()
    return reps.select(F.col("label").cast("long").alias("label"), "node", "copies", "embedding").mapInArrow(
        run, "label long, dim int, cell long, probe boolean, node long, copies long, vector binary")


def _links(placed: DataFrame, kind: np.dtype, threshold: float, chunk: int) -> DataFrame:
    """Rows (node, links, root): weighted links within one task, and the least node of the task's set."""
    cell = ["label", "dim", "cell"]
    sizes = stage(placed.groupBy(*cell).agg(F.count_if(~F.col("probe")).alias("homes"), F.count_if("probe").alias("probes"))
                  .filter("homes > 0").select(*cell, F.ceil(F.col("homes") / chunk).cast("int").alias("h"),
                                              F.ceil(F.col("probes") / chunk).cast("int").alias("p")), "embedding-cells")
    dealt = placed.join(sizes, cell).withColumn(
        "own", F.when(F.col("probe"), F.col("h") + F.pmod(F.xxhash64("node"), F.col("p"))).otherwise(F.pmod(F.xxhash64("node"), F.col("h"))).cast("int"))
    others = F.when(F.col("probe"), F.sequence(F.lit(0), F.col("h") - 1)).otherwise(F.sequence(F.lit(0), F.col("h") + F.col("p") - 1))
    tasks = dealt.withColumn("other", F.explode(others)).select(
        *cell, F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"),
        (F.col("own") <= F.col("other")).alias("first"), "node", "copies", "vector")

    def compare(table: pa.Table) -> pa.Table:
        same = table.column("a")[0].as_py() == table.column("b")[0].as_py()
        first = table.column("first").to_numpy(zero_copy_only=False)
        nodes, weight = table.column("node").to_numpy(), table.column("copies").to_numpy()
        x = unit(np.stack([np.frombuffer(v, kind) for v in table.column("vector").to_pylist()]))
        left, right = np.flatnonzero(first), np.flatnonzero(first if same else ~first)
        order = np.argsort(nodes, kind="stable")
        place = np.empty(len(nodes), np.int64)
        place[order] = np.arange(len(nodes))       # so that the least index is the least node
        root, links = np.arange(len(nodes)), np.zeros(len(nodes), np.int64)
        if len(left) and len(right):
            hit = x[left] @ x[right].T >= threshold
            if same:
                np.fill_diagonal(hit, False)
            links[left] += hit @ weight[right]
            if not same:
                links[right] += hit.T @ weight[left]
            i, j = np.nonzero(hit)
            root = unite(root, place[left[i]], place[right[j]])
        some = np.flatnonzero(links)
        return pa.table({"node": pa.array(nodes[some]), "links": pa.array(links[some]), "root": pa.array(nodes[order[root[place[some]]]])})

    return tasks.groupBy(*cell, "a", "b").applyInArrow(compare, "node long, links long, root long")


def centroids(total: float | None, squares: float | None, per_cell: int) -> int:
    """Centroids per half, from the sums of the labels' sizes and of their squares.

    The label of the mean vector has squares / total vectors: many tiny labels do not hide a large one.
    """
    return int(np.clip(np.ceil(np.sqrt((squares or 0) / (total or 1) / per_cell)), 1, MOST_CENTROIDS))


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, target_recall: float = TARGET_RECALL, id_col: str = "vec_id",
                    vector_col: str = "embedding", label_col: str = "label", sample: int = SAMPLE, chunk: int = CHUNK, per_cell: int = PER_CELL) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept.  Labels are integers."""
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("embedding"), F.col(label_col).alias("label"))
    element = rows.schema["embedding"].dataType.elementType.simpleString()
    kind = np.dtype("<f4" if element == "float" else "<f8")
    if kind == np.dtype("<f8"):
        rows = rows.withColumn("embedding", F.col("embedding").cast("array<double>"))
    fine = (F.col("label").isNotNull() & F.col("embedding").isNotNull()
            & F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
            & F.exists("embedding", lambda v: v != 0))
    valid = F.coalesce(fine, F.lit(False))
    reps = stage(rows.filter(valid).groupBy("label", "embedding").agg(F.min("vec_id").alias("least_id"), F.count(F.lit(1)).alias("copies"))
                 .withColumn("node", F.monotonically_increasing_id()), "embedding-distinct")
    n = F.col("count").cast("double")
    k = centroids(*reps.groupBy("label").count().agg(F.sum(n), F.sum(n * n)).first(), per_cell)
    drawn = [r[0] for r in reps.select("embedding").orderBy(F.xxhash64("embedding"), "embedding").limit(sample).collect()]
    grids = {}
    for dim in sorted({len(v) for v in drawn}):
        grids[dim] = Grid(unit(np.array([v for v in drawn if len(v) == dim], kind)), k, threshold, target_recall)
    placed = stage(_cells(reps, grids), "embedding-placed")
    found = stage(_links(placed, kind, threshold, chunk), "embedding-links")
    sets = connected_components(found.select(F.col("node").alias("u"), F.col("root").alias("v")))
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    linked = stage(sets.join(reps.select("node", "least_id"), "node"), "embedding-linked")
    least = stage(linked.groupBy("component").agg(F.min("least_id").alias("component_id")), "embedding-least")
    named = linked.join(least, "component").join(counts, "node").select("node", "component_id", "links")
    result = stage(reps.join(named, "node", "left").select(
        F.col("label").alias("rep_label"), F.col("embedding").alias("rep_embedding"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("rep_links"),
        F.when(F.col("links").isNull(), F.col("least_id")).otherwise(F.col("component_id")).alias("rep_component"), F.lit(True).alias("known")), "embedding-result")
    on = valid & (F.col("label") == F.col("rep_label")) & (F.col("embedding") == F.col("rep_embedding"))
    component = F.when(F.col("known"), F.col("rep_component")).otherwise(F.col("vec_id"))
    return (rows.join(result, on, "left")
            .select("vec_id", F.coalesce("rep_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"))
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))


LINKS_SQL = f"""
with recursive v as (
  select row_number() over () as k, vec_id, label, embedding::double[] as e,
    label is not null and embedding is not null and len(embedding) > 0
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
      and len(list_filter(embedding, lambda x: x <> 0)) > 0 as fine
  from embeddings),
pairs as (
  select a.k as a, b.k as b from v a join v b on a.label = b.label and a.k <> b.k
  where a.fine and b.fine and len(a.e) = len(b.e) and list_cosine_similarity(a.e, b.e) >= {THRESHOLD}),
reached(k, id) as (select k, vec_id from v union select p.b, r.id from reached r join pairs p on p.a = r.k),
least as (select k, min(id) as component_id from reached group by k),
counted as (select a as k, count(*) as n from pairs group by a)
select vec_id, coalesce(n, 0)::bigint as n_links, component_id, vec_id is not distinct from component_id as kept
from v join least using (k) left join counted using (k)"""
