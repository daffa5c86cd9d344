"""Neighbours, spanning trees, density clusters and outliers against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from corvane.operators import density


def blobs(seed=0, n=260, d=5):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(4, d)) * 4
    x = np.concatenate([centres[i % 4] + rng.normal(size=(1, d)) * (0.2 + 0.2 * (i % 4)) for i in range(n)] + [rng.normal(size=(40, d)) * 6])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def frame(spark, x):
    return spark.createDataFrame([(i * 3 + 1, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(5)


def tree_by_force(x, samples):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    core = np.sort(d, axis=1)[:, samples]
    w = np.maximum(np.maximum(d, core[:, None]), core[None])
    edges = sorted((w[i, j], i, j) for i in range(len(x)) for j in range(i + 1, len(x)))
    up, out = list(range(len(x))), []

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for c, i, j in edges:
        a, b = root(i), root(j)
        if a != b:
            up[a] = b
            out.append((c, i, j))
    return out


def clusters_by_force(tree, n, least):
    """Top down: cut the heaviest edge, look at both sides; then choose by excess of mass."""
    made = []  # of each cluster: birth, mass, children, points

    def sides(points, edges):
        cut, rest = edges[-1], edges[:-1]
        near = {p: [] for p in points}
        for _, i, j in rest:
            near[i].append(j)
            near[j].append(i)
        seen, todo = {cut[1]}, [cut[1]]
        while todo:
            for q in near[todo.pop()]:
                if q not in seen:
                    seen.add(q)
                    todo.append(q)
        return 1 / cut[0], seen, [e for e in rest if e[1] in seen], points - seen, [e for e in rest if e[1] not in seen]

    def grow(points, edges, birth):
        me = {"birth": birth, "mass": 0.0, "below": [], "points": set(points)}
        made.append(me)
        while len(points) >= least:
            if not edges:
                break
            lam, p, e, q, f = sides(points, edges)
            if len(p) >= least and len(q) >= least:
                me["mass"] += (lam - birth) * len(points)
                me["below"] = [grow(p, e, lam), grow(q, f, lam)]
                break
            if len(p) < least and len(q) < least:
                me["mass"] += (lam - birth) * len(points)
                break
            small = p if len(p) < least else q
            me["mass"] += (lam - birth) * len(small)
            points, edges = (q, f) if small is p else (p, e)
        return me

    top = grow(set(range(n)), sorted(tree), 0.0)

    def best(c):
        below = [best(x) for x in c["below"]]
        total = sum(v for v, _ in below)
        if c is not top and c["mass"] >= total:
            return c["mass"], [c]
        return total, [y for _, x in below for y in x]

    label = [-1] * n
    for i, c in enumerate(sorted(best(top)[1], key=lambda c: min(c["points"]))):
        for p in c["points"]:
            label[p] = i
    return label


@pytest.mark.parametrize("size", [1000, 40])
def test_neighbours(spark, monkeypatch, size):
    monkeypatch.setattr(density, "BLOCK", size)
    x = blobs()
    of = density.blocks(frame(spark, x))
    got = {}
    for r in density.neighbours(of, 7).collect():
        got.setdefault(r.id, []).append((r.rank, r.distance))
    d = np.sort(np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2)), axis=1)
    assert len(got) == len(x) and (of.count() > 5) == (size == 40)
    for i in range(len(x)):
        assert np.allclose([v for _, v in sorted(got[i * 3 + 1])], d[i, 1:8], atol=1e-9)


def test_bound_leaves_blocks_out(spark, monkeypatch):
    """Rows in far corners: blocks of other corners are not compared."""
    monkeypatch.setattr(density, "BLOCK", 6)
    rng = np.random.default_rng(1)
    x = np.repeat(np.eye(6) * 50, 30, axis=0) + rng.normal(size=(180, 6)) * 0.01
    told = density.blocks(frame(spark, x), unit=False)
    meta = told.selectExpr("block", "cell", "pivot", "lo", "hi")
    close = meta.alias("a").join(meta.alias("b"), density._apart("a", "b") < 1).count()
    assert close < meta.count() ** 2 / 3


@pytest.mark.parametrize("size", [1000, 60])
def test_spanning_tree(spark, monkeypatch, size):
    monkeypatch.setattr(density, "BLOCK", size)
    x = blobs(2)
    of = density.blocks(frame(spark, x))
    if size == 60:
        monkeypatch.setattr(density, "FEW_LINKS", 3)  # components by rounds over tables
    got = sorted(((r.a - 1) // 3, (r.b - 1) // 3, round(r.w, 9)) for r in density.spanning_tree(of, density.neighbours(of, 5 if size == 60 else 15), 5).collect())
    want = sorted((i, j, round(c, 9)) for c, i, j in tree_by_force(x, 5))
    assert len(got) == len(x) - 1 and [round(sum(v[2] for v in t), 6) for t in (got, want)][0] == round(sum(v[2] for v in want), 6)
    assert sorted(v[2] for v in got) == pytest.approx(sorted(v[2] for v in want), abs=1e-8)  # reachabilities tie, weights don't differ


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("least", [4, 10])
def test_condensed_tree(seed, least):
    x = blobs(seed, 150, 3)
    tree = tree_by_force(x, 4)
    a, b, w = (np.array([e[k] for e in tree]) for k in (1, 2, 0))
    assert density.condensed(a, b, w, len(x), least).tolist() == clusters_by_force(tree, len(x), least)


def test_density_clusters(spark):
    x = blobs(3, n=200)
    got = {r.vec_id: r.cluster for r in density.density_clusters(frame(spark, x)).collect()}
    tree = tree_by_force(x, 5)
    want = clusters_by_force(tree, len(x), 10)
    if sum(c < 0 for c in want) / len(want) > 0.4:
        want = clusters_by_force(tree_by_force(x, 3), len(x), 5)
    assert [got[i * 3 + 1] for i in range(len(x))] == want and max(want) >= 2


def test_all_noise_and_retry(spark):
    x = np.random.default_rng(5).normal(size=(60, 6))  # nothing dense: noise, and a second try
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    first = clusters_by_force(tree_by_force(x, 5), len(x), 10)
    assert first.count(-1) > 24
    got = {r.vec_id: r.cluster for r in density.density_clusters(frame(spark, x)).collect()}
    assert [got[i * 3 + 1] for i in range(60)] == clusters_by_force(tree_by_force(x, 3), len(x), 5)
    few = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (None, [1.0, 1.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in density.density_clusters(few).collect()] == [(1, -1)]
    assert density.density_clusters(few.where("false")).count() == 0


def test_isolation():
    rng = np.random.default_rng(0)
    x = np.r_[rng.normal(size=(255, 3)), [[9.0, 9.0, 9.0]]]
    tree = density.isolation_tree(x, 1)
    got = density.path_lengths(x, tree)
    dim, cut, left, right, length = tree

    def walk(row, at=0):
        return length[at] if dim[at] < 0 else walk(row, left[at] if row[dim[at]] <= cut[at] else right[at])

    assert got.tolist() == [walk(r) for r in x] and max(length) <= 8 + density.mean_path(256)
    mean = np.mean([density.path_lengths(x, density.isolation_tree(x, s)) for s in range(60)], axis=0)
    assert mean.argmin() == 255 and density.mean_path(256) == pytest.approx(10.244, abs=1e-3)


def test_outliers(spark):
    rng = np.random.default_rng(8)
    x = np.r_[rng.normal(size=(120, 4)), rng.normal(size=(3, 4)) + 12]
    rows = {(r.vec_id - 1) // 3: r for r in density.outliers(frame(spark, x)).collect()}
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    order = np.argsort(d, axis=1)[:, 1:21]
    far = np.take_along_axis(d, order, axis=1)
    reach = np.maximum(far[:, -1][order], far)
    lrd = 1 / (reach.mean(axis=1) + 1e-12)
    lof = lrd[order].mean(axis=1) / lrd
    assert np.allclose([rows[i].lof for i in range(len(x))], lof, rtol=1e-8)
    iso = np.array([rows[i].isolation for i in range(len(x))])
    scale = lambda v: (v - v.min()) / (v.max() - v.min())
    assert np.allclose([rows[i].ood_score for i in range(len(x))], 0.5 * scale(lof) + 0.5 * scale(iso))
    assert set(np.argsort([-rows[i].ood_score for i in range(len(x))])[:3]) == {120, 121, 122}
    topics = spark.createDataFrame([(1, 7), (4, 7), (361, 8)], "vec_id long, topic_id int")
    told = {r.topic_id: r for r in density.topic_outliers(density.outliers(frame(spark, x)), topics).collect()}
    assert told[7].n == 2 and told[8].ood_max == told[8].ood_mean == rows[120].ood_score
    assert {r.ood_score for r in density.outliers(frame(spark, x[:20])).collect()} == {0.0}


def test_blocks_go_once_to_each_pair_of_tiles(spark):
    """Not once for each pair of blocks; every pair is met once."""
    import pandas as pd

    n = 40
    rows = spark.createDataFrame([(f"{i}", i) for i in range(n)], "block string, v int")
    pairs = spark.createDataFrame([(f"{i}", f"{j}") for i in range(n) for j in range(n)], "a string, b string")

    def work(blocks, met):
        return pd.DataFrame({"a": [a for a, _ in met], "b": [b for _, b in met], "sent": [len(blocks)] + [0] * (len(met) - 1), "v": [blocks[a]["v"] * 1000 + blocks[b]["v"] for a, b in met]})

    got = density._by_tiles(pairs, rows, work, "a string, b string, sent int, v int").collect()
    assert sorted((r.a, r.b) for r in got) == sorted((f"{i}", f"{j}") for i in range(n) for j in range(n))
    assert all(r.v == int(r.a) * 1000 + int(r.b) for r in got)
    assert n < sum(r.sent for r in got) <= n * density.LEAST_TILES


def test_pairs_of_blocks_are_searched_for_what_is_within_reach(spark, monkeypatch):
    """Before, each pair of blocks was sorted by its rows' nearest and least edges, whatever had been found; and neighbours were sought for both sets of clusters."""
    rng = np.random.default_rng(4)
    v, u = rng.normal(size=(200, 8)), rng.normal(size=(300, 8))
    exact = np.sqrt(((v[:, None] - u[None]) ** 2).sum(axis=2))
    most = np.sort(exact, axis=1)[:, 3] - np.r_[np.zeros(100), np.full(100, 9.0)]
    got = {(r, c) for r, c in zip(*density._within(v, u, most, 5)[:2], strict=True)}
    assert got == {(r, c) for r, c in zip(*np.nonzero(exact <= most[:, None]), strict=True)} and len(got) == 400
    c, d = rng.integers(0, 3, 200), rng.integers(0, 3, 300)
    for t in (np.full(300, -1.0), np.where(rng.random(300) < 0.1, 1.2, -1), np.full(300, 1.1)):
        s = np.where(rng.random(200) < 0.3, 1.2, -1)
        row, col = density._crossing(v, u, c, d, s, t)
        want = {(int(r), int(k)) for r, k in zip(*np.nonzero((exact <= np.maximum(s[:, None], t)) & (c[:, None] != d)), strict=True)}
        assert want and {(int(r), int(k)) for r, k in zip(row, col, strict=True)} == want
    assert density._crossing(v, u, c, d, np.full(200, np.inf), t)[0] is None
    calls, neighbours = [], density.neighbours
    monkeypatch.setattr(density, "MANY", 1)
    monkeypatch.setattr(density, "BLOCK", 20)
    monkeypatch.setattr(density, "neighbours", lambda of, k: calls.append(k) or neighbours(of, k))
    x = rng.normal(size=(90, 6))
    density.density_clusters(frame(spark, x), noise=-1.0).count()
    assert calls == [15]
    x = x / np.linalg.norm(x, axis=1)[:, None]
    far = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    for r in neighbours(density.blocks(frame(spark, x)), 7).groupBy("id").agg(F.sort_array(F.collect_list("distance")).alias("d")).collect():
        assert np.allclose(r.d, np.sort(far[(r.id - 1) // 3])[1:8])
