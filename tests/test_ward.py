"""Ward's clusters against a naive agglomeration."""

import numpy as np
import pytest

from corvane.operators import ward as W


def naive(x):
    """Merge the pair with the least growth of the squared error, from all pairs each time."""
    parts, heights, cuts = [[i] for i in range(len(x))], [], {}
    error = lambda p: ((x[p] - x[p].mean(axis=0)) ** 2).sum()
    while True:
        cuts[len(parts)] = {frozenset(p) for p in parts}
        if len(parts) == 1:
            return heights, cuts
        grown, i, j = min((error(a + b) - error(a) - error(b), i, j) for i, a in enumerate(parts) for j, b in enumerate(parts) if i < j)
        heights.append(np.sqrt(2 * max(grown, 0)))
        parts = [p for k, p in enumerate(parts) if k not in (i, j)] + [parts[i] + parts[j]]


def groups(labels):
    return {frozenset(np.flatnonzero(labels == k).tolist()) for k in set(labels.tolist())}


@pytest.mark.parametrize("seed", range(4))
def test_tree(seed):
    x = np.random.default_rng(seed).normal(size=(40, 3 + seed))
    heights, cuts = naive(x)
    merges = W.tree(x)
    assert np.allclose(merges[:, 2], heights) and (np.diff(merges[:, 2]) >= 0).all()
    for k in (1, 2, 5, 13, 40):
        labels = W.cut(merges, 40, k)
        assert groups(labels) == cuts[k] and labels[0] == 0


def test_repeated_rows_and_ties():
    x = np.repeat(np.eye(4), 6, axis=0)
    merges = W.tree(x)
    assert np.allclose(merges[:20, 2], 0) and len(merges) == 23
    assert groups(W.cut(merges, 24, 4)) == {frozenset(range(i, i + 6)) for i in range(0, 24, 6)}
    grid = np.array([[a, b] for a in range(5) for b in range(5)], float)  # many equal distances: ends, and heights never fall
    assert len(W.tree(grid)) == 24 and W.tree(np.zeros((1, 2))).shape == (0, 3)


def test_silhouette():
    rng = np.random.default_rng(3)
    x, labels = rng.normal(size=(30, 4)), rng.integers(0, 4, 30)
    labels[0] = 9  # alone
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    want = []
    for i in range(30):
        own = (labels == labels[i]) & (np.arange(30) != i)
        if not own.any():
            want.append(0.0)
            continue
        a, b = d[i, own].mean(), min(d[i, labels == k].mean() for k in set(labels.tolist()) - {labels[i]})
        want.append((b - a) / max(a, b))
    assert W.silhouette(x, labels) == pytest.approx(np.mean(want)) and W.silhouette(x, np.zeros(30)) == -1


def test_ward_clusters(spark):
    rng = np.random.default_rng(7)
    centres = np.linalg.qr(rng.normal(size=(16, 10)))[0].T
    truth = rng.integers(0, 10, 400)
    x = centres[truth] * rng.uniform(0.5, 3, (400, 1)) + rng.normal(0, 0.03, (400, 16))
    rows = [(i, v.tolist(), "extra") for i, v in enumerate(x)] + [(900, None, "x"), (None, x[0].tolist(), "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, cluster string")
    for sample in (150, 10_000):
        got = {r.vec_id: r for r in W.ward_clusters(df, sample=sample).collect()}
        assert set(got) == set(range(400)) and sum(r.sampled for r in got.values()) == min(sample, 400)
        assert len({(truth[i], got[i].cluster) for i in got}) == 10 == len({r.cluster for r in got.values()})
    # of the whole table, the tree of all rows
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    merges = W.tree(unit)
    assert groups(np.array([got[i].cluster for i in range(400)])) == groups(W.cut(merges, 400, 10))


def test_small_tables(spark):
    schema = "vec_id long, embedding array<float>"
    assert W.ward_clusters(spark.createDataFrame([], schema)).count() == 0
    assert W.ward_clusters(spark.createDataFrame([(i, [1.0, float(i)]) for i in range(4)], schema)).count() == 0
    same = W.ward_clusters(spark.createDataFrame([(i % 3, [0.0, 0.0]) for i in range(8)], schema)).collect()
    assert len(same) == 8
