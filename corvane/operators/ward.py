"""Hierarchical clusters by Ward's criterion on a bounded sample, and all rows to the nearest centroid."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import settle
from .density import _unit

#: Rows that the tree is made of (one task holds them, and no distances), and of these the rows that judge a cut.
SAMPLE, JUDGES = 10_000, 2_000


def tree(x: np.ndarray) -> np.ndarray:
    """Merges ``(a, b, height)`` by rising height; ``a`` and ``b`` are rows of ``x`` that stand for their clusters.

    Nearest-neighbour chains: a chain goes from a cluster to its nearest until two are each other's nearest, which then merge. Ward's
    distance comes from centroids and sizes, so memory stays in proportion to the rows.
    """
    n = len(x)
    centre, size, alive = x.astype(float).copy(), np.ones(n), np.ones(n, bool)
    square = (centre**2).sum(axis=1)
    merges, chain = [], []
    live = np.arange(n)
    for _ in range(n - 1):
        if alive[live].sum() < 0.7 * len(live):
            live = live[alive[live]]
        if not chain:
            chain = [int(live[np.argmax(alive[live])])]
        while True:
            a = chain[-1]
            d = np.maximum(square[live] + square[a] - 2 * centre[live] @ centre[a], 0) * (2 * size[live] * size[a] / (size[live] + size[a]))
            d[~alive[live] | (live == a)] = np.inf
            b = int(live[np.argmin(d)])
            if len(chain) > 1:  # the one before stays the nearest among equals, so that a chain ends
                before = chain[-2]
                at = int(np.searchsorted(live, before))
                if d[at] <= d.min() * (1 + 1e-12) + 1e-15:
                    b = before
            if len(chain) > 1 and b == chain[-2]:
                break
            chain.append(b)
        a, b = sorted(chain[-2:])
        gap = ((centre[a] - centre[b]) ** 2).sum() * 2 * size[a] * size[b] / (size[a] + size[b])
        merges.append((a, b, float(np.sqrt(gap))))
        del chain[-2:]
        centre[a] = (size[a] * centre[a] + size[b] * centre[b]) / (size[a] + size[b])
        size[a] += size[b]
        square[a] = (centre[a] ** 2).sum()
        alive[b] = False
    merges.sort(key=lambda m: m[2])
    return np.array(merges).reshape(-1, 3)


def cut(merges: np.ndarray, n: int, k: int) -> np.ndarray:
    """Labels from 0, in the order of first rows, of the ``k`` clusters that are left before the highest ``k - 1`` merges."""
    up = np.arange(n)

    def root(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for a, b, _ in merges[: max(n - k, 0)]:
        lo, hi = sorted((root(int(a)), root(int(b))))
        up[hi] = lo
    return np.unique([root(i) for i in range(n)], return_inverse=True)[1]


def silhouette(x: np.ndarray, labels: np.ndarray) -> float:
    """The mean over rows of how much nearer the own cluster is than the nearest other one; 0 for a row alone."""
    d = np.sqrt(np.maximum((x**2).sum(axis=1)[:, None] + (x**2).sum(axis=1) - 2 * x @ x.T, 0))
    np.fill_diagonal(d, 0)
    kinds, own = np.unique(labels, return_inverse=True)
    if len(kinds) < 2:
        return -1.0
    member = np.eye(len(kinds))[own]
    count = member.sum(axis=0)
    sums = d @ member
    rows = np.arange(len(x))
    inner = sums[rows, own] / np.maximum(count[own] - 1, 1)
    mean = sums / count
    mean[rows, own] = np.inf
    outer = mean.min(axis=1)
    return float(np.where(count[own] > 1, (outer - inner) / np.maximum(np.maximum(outer, inner), 1e-300), 0.0).mean())


def ward_clusters(vectors: DataFrame, choices: tuple[int, ...] = (5, 10, 15, 20, 25, 30), key: str = "vec_id", vector: str = "embedding", sample: int = SAMPLE, judges: int = JUDGES) -> DataFrame:
    """``KEY, cluster, sampled``: Ward's clusters of unit vectors, as many as the best silhouette of ``choices`` has.

    The tree is made of at most ``sample`` rows (by a hash of the key), the silhouette of ``judges`` of them; rows of the tree keep their
    cluster, others go to the centroid with the largest cosine. Rows without a vector or key are left out; under 5 rows there
    are no clusters. Repeated rows meet at height 0.
    """
    rows = settle(vectors.where(F.col(vector).isNotNull() & F.col(key).isNotNull()).select(F.col(key).alias("id"), _unit(vector).alias("v"), F.monotonically_increasing_id().alias("place")))
    picked = rows.orderBy(F.xxhash64("id"), "id", "place").limit(sample)  # a bounded sample, for one task

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"place": pd.Series(dtype="int64"), "cluster": pd.Series(dtype="int32")})
        if len(pdf) < 5:
            return empty
        pdf = pdf.sort_values(["hash", "id", "place"])
        x = np.array(pdf["v"].tolist())
        merges, best = tree(x), (-1.0, None)
        for k in choices:
            if k < len(x):
                labels = cut(merges, len(x), k)
                score = silhouette(x[:judges], labels[:judges])
                if score > best[0]:
                    best = score, labels
        labels = cut(merges, len(x), min(5, len(x))) if best[1] is None else best[1]
        return pd.DataFrame({"place": pdf["place"].to_numpy(), "cluster": labels.astype("int32")})

    told = settle(picked.withColumn("hash", F.xxhash64("id")).groupBy().applyInPandas(work, "place long, cluster int"))
    sums = rows.join(F.broadcast(told), "place").select("cluster", F.posexplode("v").alias("i", "x")).groupBy("cluster", "i").agg(F.avg("x").alias("x"))
    centroids: dict[int, dict[int, float]] = {}
    for r in sums.collect():  # a row a cluster and dimension
        centroids.setdefault(r.cluster, {})[r.i] = r.x
    kind = rows.schema["id"].dataType.simpleString()
    names = np.array(sorted(centroids), dtype="int32")
    c = np.array([[centroids[k][i] for i in sorted(centroids[k])] for k in names])
    if len(names):
        c = c / np.maximum(np.sqrt((c**2).sum(axis=1, keepdims=True)), 1e-300)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(names):
                yield pdf.assign(near=names[(np.array(pdf["v"].tolist()) @ c.T).argmax(axis=1)])[["id", "place", "near"]]

    near = rows.mapInPandas(assign, f"id {kind}, place long, near int")
    own = near.join(F.broadcast(told), "place", "left")  # at most ``sample`` rows
    return own.select(F.col("id").alias(key), F.coalesce("cluster", "near").alias("cluster"), F.col("cluster").isNotNull().alias("sampled"))
