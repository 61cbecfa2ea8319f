"""Components, SimHash and embedding near-dedup against brute force."""

from collections import defaultdict

import numpy as np
import pytest
import xxhash

from pyspark.sql import functions as F

from costindex.llm import embedding_dedup as E, simhash as S
from costindex.llm.components import connected_components


def _sets(n, pairs):
    root = list(range(n))

    def find(a):
        while root[a] != a:
            root[a] = root[root[a]]
            a = root[a]
        return a

    for a, b in pairs:
        root[find(a)] = find(b)
    groups = defaultdict(list)
    for k in range(n):
        groups[find(k)].append(k)
    return [groups[find(k)] for k in range(n)]


def test_components_of_chains_stars_and_random_links(spark):
    rng = np.random.default_rng(1)
    pairs = [(k, k + 1) for k in range(0, 40)] + [(100, 100 + k) for k in range(1, 60)]
    pairs += [tuple(map(int, p)) for p in rng.integers(200, 400, (120, 2))] + [(500, 500), (100, 101)]
    got = dict(connected_components(spark.createDataFrame(pairs, "u long, v long")).collect())
    sets = _sets(600, pairs)
    linked = {a for p in pairs if p[0] != p[1] for a in p}
    assert got == {k: min(sets[k]) for k in linked}


def test_components_of_nothing(spark):
    assert connected_components(spark.createDataFrame([], "u long, v long")).collect() == []


def _print(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    if not grams:
        return 0
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def _texts():
    rng = np.random.default_rng(3)
    words = [f"w{k}" for k in range(400)]
    base = [" ".join(rng.choice(words, 120)) for _ in range(30)]
    near = []
    for t in base[:10]:
        for _ in range(4):
            w = t.split()
            w[int(rng.integers(len(w)))] = "changed"
            near.append(" ".join(w))
    return base + near + base[:5] + [None, "", " \t\n", "One", "one two", "ONE TWO", "é è", "É è", base[0].upper(), "x " * 30000]


def test_simhash_groups_match_all_pairs(spark):
    texts = _texts()
    rows = [(1000 - k, t, "x") for k, t in enumerate(texts)] + [(1000, texts[0], "x"), (None, texts[1], "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = S.simhash_groups(docs).collect()
    prints = [_print(t) for _, t, _ in rows]
    sets = _sets(len(rows), [(a, b) for a in range(len(rows)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 3])
    want = sorted((str(i), f"{p:016x}", min(rows[k][0] for k in s if rows[k][0] is not None)) for (i, _, _), p, s in zip(rows, prints, sets))
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in got) == want
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({w[2] for w in want})


def test_tiles_lose_no_link():
    rng = np.random.default_rng(5)
    prints = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    prints = np.unique(np.concatenate([prints, prints ^ np.uint64(1 << 40), prints ^ np.uint64(0b111), prints ^ np.uint64((1 << 5) | (1 << 50))]))
    pops = np.bitwise_count(prints)
    tiles = [np.array(sorted(prints[pops == p], key=lambda v: (int(v) & 0xFFFFFFFF).bit_count()), np.uint64) for p in np.unique(pops)]
    cut = [t[k:k + 7] for t in tiles for k in range(0, len(t), 7)]
    edges = []
    for a in range(len(cut)):
        for b in range(a, len(cut)):
            d = int(np.bitwise_count(cut[b][0])) - int(np.bitwise_count(cut[a][0]))
            if 0 <= d <= 3:
                u, v = S.compare(cut[a], cut[b], a == b, 3)
                edges += list(zip(u.tolist(), v.tolist()))
    at = {int(p): k for k, p in enumerate(prints)}
    brute = _sets(len(prints), [(i, j) for i, j in zip(*np.nonzero(np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 3))])
    assert _sets(len(prints), [(at[a], at[b]) for a, b in edges]) == brute


def test_groups_of_tiles_lose_no_link_and_meet_only_near_groups(spark):
    rng = np.random.default_rng(11)
    base = np.concatenate([rng.integers(0, 1 << 64, 250, dtype=np.uint64), np.array([0, (1 << 64) - 1, 7, 1 << 63], np.uint64)])
    flips = [0, 1 << 40, 0b111, (1 << 5) | (1 << 50), 0b1111, (1 << 63) | (1 << 31)]
    prints = np.unique(np.concatenate([base ^ np.uint64(f) for f in flips]))
    table = S.stage(spark.createDataFrame([(k, int(v)) for k, v in enumerate(prints.view(np.int64))], "id long, print long"), "prints")
    brute = _sets(len(prints), [(i, j) for i, j in zip(*np.nonzero(np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 3))])
    for tile, group in ((5, 2), (5, 32), (1 << 15, 1)):
        got = {r.id: r.component_id for r in S.components_of(table, "id", "print", tile=tile, group=group).collect()}
        assert got == {k: min(s) for k, s in enumerate(brute)}
    reps = table.select(F.col("print").alias("fp"), F.bit_count("print").cast("int").alias("pop"),
                        F.bit_count(F.col("print").bitwiseAND(F.lit(0xFFFFFFFF))).cast("int").alias("low"))
    tiles = S._tiles(reps, 5, 2)
    held = {}
    for r in tiles.collect():
        values = np.frombuffer(r.prints, np.uint64)
        low = np.bitwise_count(values & np.uint64(0xFFFFFFFF))
        assert (np.bitwise_count(values) == r.pop).all() and (low.min(), low.max()) == (r.low_min, r.low_max)
        held.setdefault(r.tile_group, []).append(values)
    assert sum(len(v) for g in held.values() for v in g) == len(prints) and max(map(len, held.values())) == 2
    groups = {g: np.concatenate(v) for g, v in held.items()}
    pairs = {(r.a, r.b) for r in S.group_pairs(tiles, 3).collect()}
    near = {(a, b) for a in groups for b in groups if a <= b and (np.bitwise_count(groups[a][:, None] ^ groups[b][None, :]) <= 3).any()}
    assert near <= pairs and len(pairs) < len(groups) * (len(groups) + 1) / 4


def test_simhash_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert S.simhash_groups(docs).count() == 0 and S.keep_one(docs).count() == 0


def _vectors():
    rng = np.random.default_rng(9)
    rows, at = [], 0
    for label in (1, 2, 3):
        centres = rng.normal(size=(12, 32))
        for c in centres:
            for k in range(int(rng.integers(1, 9))):
                rows.append((at, [float(x) for x in c + rng.normal(size=32) * 0.12 * k / 4], label))
                at += 1
    hot = rng.normal(size=32)
    rows += [(at + k, [float(x) for x in hot + rng.normal(size=32) * 0.05], 2) for k in range(150)]
    one = [1.0] * 32
    nan, inf = float("nan"), float("inf")
    return rows + [(-1, one, 3), (-1, one, 3), (-2, one, 3), (-3, [2.0] * 32, 3), (None, one, 3), (-4, one, None), (-5, None, 3), (-6, [0.0] * 32, 3),
                   (-7, [nan] * 32, 3), (-8, [inf] * 32, 3), (-9, [None, *one[1:]], 3), (-10, [1.0] * 5, 3), (-11, [1.0] * 5, 3), (-12, [], 3)]


def _brute(rows, threshold):
    ok = [r[2] is not None and bool(r[1]) and all(v is not None and np.isfinite(v) for v in r[1]) and any(r[1]) for r in rows]
    pairs = []
    for a in range(len(rows)):
        for b in range(a):
            if ok[a] and ok[b] and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                x, y = (np.array(rows[k][1], np.float32).astype(float) for k in (a, b))
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                    pairs.append((a, b))
    links = np.zeros(len(rows), int)
    for a, b in pairs:
        links[a] += 1
        links[b] += 1
    out = []
    for k, s in enumerate(_sets(len(rows), pairs)):
        ids = [rows[j][0] for j in s if rows[j][0] is not None]
        out.append((str(rows[k][0]), int(links[k]), str(min(ids) if ids else None)))
    return sorted(out)


@pytest.mark.parametrize("chunk", [512, 16])
def test_embedding_links_match_all_pairs(spark, chunk):
    rows = _vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = E.near_duplicates(df, chunk=chunk).collect()
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in got) == _brute(rows, 0.98)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


@pytest.mark.parametrize("chunk", [512, 8])
def test_embedding_links_across_cells_match_all_pairs(spark, monkeypatch, chunk):
    grids, kept = [], E.Grid.__init__

    def noted(self, sample, k, threshold, target_recall):
        kept(self, sample, k, threshold, target_recall)
        grids.append(self)

    monkeypatch.setattr(E.Grid, "__init__", noted)
    rows = _vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = E.near_duplicates(df, chunk=chunk, per_cell=4).collect()
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in got) == _brute(rows, 0.98)
    x = E.unit(np.array([r[1] for r in rows if r[0] is not None and r[0] >= 0]))
    grid = next(g for g in grids if g.half == 16)
    visits = list(grid.visit(x))
    assert min(map(len, grid.books)) >= 4 and len({home for home, _ in visits}) > 4 and any(cells for _, cells in visits)


def test_grid_size_follows_the_large_label():
    tiny, hot = [1] * 200_000, 100_000
    assert E.centroids(hot + len(tiny), hot ** 2 + len(tiny), 256) >= 10
    assert E.centroids(5120, 20 * 256 ** 2, 256) == 1 and E.centroids(None, None, 256) == 1


def test_traversal_visits_every_cell_that_can_hold_a_link_and_reaches_a_lower_target():
    rng = np.random.default_rng(2)
    centres = E.unit(rng.normal(size=(60, 16)))
    x = E.unit(np.repeat(centres, 20, axis=0) + rng.normal(size=(1200, 16)) * 0.03)
    i, j = np.nonzero(x @ x.T >= 0.98)
    for target in (1.0, 0.9):
        grid = E.Grid(x[::2], 6, 0.98, target)
        (h1, _), (h2, _) = grid.bounds(x)
        width = len(grid.books[1])
        home = h1 * width + h2
        visited = [{h, *cells} for h, cells in grid.visit(x)]
        met = np.mean([home[b] in visited[a] or home[a] in visited[b] for a, b in zip(i, j)])
        assert met == 1.0 if target == 1.0 else met >= 0.9


def test_embeddings_of_an_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert E.near_duplicates(df).collect() == []
