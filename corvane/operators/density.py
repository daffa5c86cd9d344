"""Neighbours of all vectors, density clusters from their spanning tree, and outlier scores.

Vectors are dealt to cells around pivots (a bounded sample), cells are cut into blocks of about ``BLOCK`` rows. What a block
cannot hold nearer than what is known already is not compared: the distance of two pivots less the blocks' radii bounds the
distance of their rows, so only pairs of blocks that the bound lets through meet, by one matrix product each. They meet in
tasks of two tiles of blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.tables import settle
from . import graph

#: Rows of a block; pivots at the most.
BLOCK, MOST_PIVOTS = 1000, 1024
#: Blocks of a tile, about; a task holds two tiles. Tiles at the least, if there are as many blocks.
TILE, LEAST_TILES = 32, 10
#: Neighbours found, as a multiple of those sought, after which only nearer ones are looked for.
MANY = 8
#: Points whose tree one task condenses (24 bytes each); more raise.
MOST_POINTS = 20_000_000
#: Trees of an isolation forest, rows a tree sees, and rows that the trees draw from.
TREES, SAMPLE, POOL = 100, 256, 25_600


def _unit(vector: str) -> Column:
    v = F.col(vector).cast("array<double>")
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))
    return F.when(norm > 0, F.transform(v, lambda x: x / norm)).otherwise(v)


def blocks(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", unit: bool = True) -> DataFrame:
    """``block, pivot, lo, hi, ids, vs``: rows with a vector, with the least and largest distance to their pivot. Settled.

    ``unit`` scales vectors to length 1, so that distances go as cosines do.
    """
    rows = settle(vectors.where(F.col(vector).isNotNull() & F.col(key).isNotNull()).select(F.col(key).alias("id"), (_unit(vector) if unit else F.col(vector).cast("array<double>")).alias("v")))
    n = rows.count()
    pivots = np.array([r.v for r in rows.orderBy(F.xxhash64("id"), "id").limit(max(1, min(MOST_PIVOTS, -(-n // BLOCK)))).collect()])  # a bounded sample

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            v = np.array(pdf["v"].tolist())
            near = ((pivots**2).sum(axis=1) - 2 * v @ pivots.T).argmin(axis=1)
            yield pdf.assign(cell=near.astype("int32"), r=np.sqrt(((v - pivots[near]) ** 2).sum(axis=1)))

    kind = rows.schema["id"].dataType.simpleString()
    dealt = settle(rows.mapInPandas(assign, f"id {kind}, v array<double>, cell int, r double"))
    cuts = dealt.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).alias("cuts"))  # a row a pivot
    block = F.concat_ws("-", "cell", F.pmod(F.xxhash64("id"), F.col("cuts")))
    each = dealt.join(cuts, "cell").groupBy(block.alias("block"), "cell").agg(F.min("r").alias("lo"), F.max("r").alias("hi"), F.sort_array(F.collect_list(F.struct("id", "v"))).alias("x"))
    places = rows.sparkSession.createDataFrame([(i, p.tolist()) for i, p in enumerate(pivots)], "cell int, pivot array<double>")
    each = each.join(F.broadcast(places), "cell")  # at most MOST_PIVOTS rows
    return settle(each.select("block", "cell", "pivot", "lo", "hi", F.transform("x", lambda s: s["id"]).alias("ids"), F.transform("x", lambda s: s["v"]).alias("vs")))


def _apart(a: str, b: str) -> Column:
    """No row of one block is nearer to one of the other than this."""
    d = F.sqrt(F.aggregate(F.zip_with(f"{a}.pivot", f"{b}.pivot", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))
    ring = F.greatest(F.col(f"{a}.lo") - F.col(f"{b}.hi"), F.col(f"{b}.lo") - F.col(f"{a}.hi"))
    return F.greatest(F.when(F.col(f"{a}.cell") == F.col(f"{b}.cell"), ring).otherwise(d - F.col(f"{a}.hi") - F.col(f"{b}.hi")), F.lit(0.0)) - 1e-9


def between(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of rows, the same to the last bit whichever side comes first."""
    return np.sqrt(((a - b) ** 2).sum(axis=1))


def _rough(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((a**2).sum(axis=1)[:, None] + (b**2).sum(axis=1)[None, :] - 2 * a @ b.T, 0))


def _nearest(q: np.ndarray, v: np.ndarray, k: int, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each row of ``q`` the ``k`` nearest rows of ``v``, not itself if they are the ``same``: rows, places and distances, flat."""
    d = _rough(q, v)
    if same:
        np.fill_diagonal(d, np.inf)
    k = min(k, d.shape[1] - same)
    if k <= 0:
        return (np.zeros(0, int),) * 2 + (np.zeros(0),)
    at = np.argpartition(d, k - 1, axis=1)[:, :k].ravel()
    row = np.repeat(np.arange(len(q)), k)
    return row, at, between(q[row], v[at])


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of rows, but for rounding, by one product."""
    one = np.ones((len(a), 1)), np.ones((len(b), 1))
    return np.hstack([-2 * a, (a**2).sum(axis=1)[:, None], one[0]]) @ np.hstack([b, one[1], (b**2).sum(axis=1)[:, None]]).T


def _reach(most: np.ndarray) -> np.ndarray:
    """Squares that no row within ``most`` exceeds, rounding included; below 0 nothing is."""
    return np.where(most < 0, -np.inf, most * most * (1 + 1e-9) + 1e-9)


def _within(q: np.ndarray, v: np.ndarray, most: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each row of ``q`` the rows of ``v`` that are not further than ``most``: rows, places and distances, flat. Where these are many, the ``k``
    nearest of each row are enough."""
    d = _squares(q, v)
    near = d <= _reach(most)[:, None]
    if k < len(v) and np.count_nonzero(near) > k * len(q):
        row, at = np.repeat(np.arange(len(q)), k), np.argpartition(d, k - 1, axis=1)[:, :k].ravel()
    else:
        row, at = np.nonzero(near)
    return row, at, between(q[row], v[at])


def _by_tiles(pairs: DataFrame, rows: DataFrame, work: Callable[[dict, list], pd.DataFrame], schema: str) -> DataFrame:
    """``work`` on all ``pairs`` (``a, b``) of blocks, by pairs of tiles: a block's row is sent once to each pair of tiles that needs it, not once
    for each pair. ``work`` takes the rows by block and its pairs. ``rows``: one a block, settled."""
    n = rows.count()
    tiles = max(1, min(n, max(LEAST_TILES, -(-n // TILE))))
    a, b = (F.pmod(F.xxhash64(c), F.lit(tiles)).cast("int") for c in ("a", "b"))
    pairs = settle(pairs.select("a", "b", F.least(a, b).alias("p"), F.greatest(a, b).alias("q")))
    sent = rows.join(pairs.select(F.explode(F.array("a", "b")), "p", "q").distinct().toDF("block", "s", "t"), "block")

    def run(blocks: pd.DataFrame, met: pd.DataFrame) -> pd.DataFrame:
        return work({r["block"]: r for r in blocks.to_dict("records")}, list(zip(met["a"], met["b"], strict=True)))

    return sent.groupBy("s", "t").cogroup(pairs.groupBy("p", "q")).applyInPandas(run, schema)


def neighbours(of: DataFrame, k: int) -> DataFrame:
    """``id, other, distance, rank``: the ``k`` nearest of every row, exactly, from ``blocks``. Among equally far ones those of the own
    block come first. Settled."""
    kind = of.schema["ids"].dataType.elementType.simpleString()

    def known(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            theta = []
            for vs in pdf["vs"]:
                v = np.array(vs.tolist())
                row, _, d = _nearest(v, v, k, True)
                theta.append(np.full(len(v), np.inf) if len(d) < k * len(v) else d.reshape(len(v), k).max(axis=1))
            yield pdf.assign(theta=theta)

    told = settle(of.mapInPandas(known, T.StructType([*of.schema.fields, T.StructField("theta", T.ArrayType(T.DoubleType()))])))  # the k-th nearest within the block
    meta = told.select("block", "cell", "pivot", "lo", "hi", F.array_max("theta").alias("most"))
    pairs = meta.alias("a").join(meta.alias("b"), (F.col("a.block") == F.col("b.block")) | (_apart("a", "b") < F.col("a.most"))).select(F.col("a.block").alias("a"), F.col("b.block").alias("b"))  # a row a block, not a row a vector

    def nearest(found: list) -> pd.DataFrame:
        found = pd.concat(found)[["row", "other", "distance", "away"]].sort_values(["row", "distance", "away", "other"])
        found = found.assign(at=found.groupby("row").cumcount())
        return found[found["at"] < k]

    def search(rows: dict, met: list) -> pd.DataFrame:
        vectors = {c: np.array(r["vs"].tolist()) for c, r in rows.items()}
        out = []
        for a, group in groupby(sorted(met, key=lambda x: (x[0], x[0] != x[1], x[1])), key=lambda x: x[0]):
            first, theta, found, size = np.asarray(rows[a]["theta"]), np.array(rows[a]["theta"]), [], 0
            for _, b in group:
                row, at, d = _nearest(vectors[a], vectors[b], k, True) if a == b else _within(vectors[a], vectors[b], theta, k)
                fits = (d < first[row]) | (a == b)
                found.append(pd.DataFrame({"row": row[fits], "other": np.asarray(rows[b]["ids"])[at[fits]], "distance": d[fits], "away": int(a != b)}))
                size += len(found[-1])
                if size > MANY * k * len(first):  # what comes later has to be as near as the nearest so far
                    found = [nearest(found)]
                    size, last = len(found[0]), found[0][found[0]["at"] == k - 1]
                    theta[last["row"]] = np.minimum(theta[last["row"]], last["distance"])
            found = nearest(found)
            out.append(found.assign(id=np.asarray(rows[a]["ids"])[found["row"].to_numpy()])[["id", "other", "distance", "away"]])
        return pd.concat(out)

    met = _by_tiles(pairs, told.select("block", "ids", "vs", "theta"), search, f"id {kind}, other {kind}, distance double, away int")
    order = Window.partitionBy("id").orderBy("distance", "away", "other")
    return settle(met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("id", "other", "distance", "rank"))


#: Links that one task joins; more go by rounds over tables.
FEW_LINKS = 200_000


def _joined(links: DataFrame) -> DataFrame:
    """``node, component`` of links ``a, b``."""
    if links.count() > FEW_LINKS:
        return graph.components(links)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        up: dict = {}

        def root(x):
            while up.setdefault(x, x) != x:
                up[x] = up[up[x]]
                x = up[x]
            return x

        for pdf in batches:
            for x, y in zip(pdf["a"].tolist(), pdf["b"].tolist(), strict=True):
                x, y = root(x), root(y)
                up[max(x, y)] = min(x, y)
        yield pd.DataFrame({"node": list(up), "component": [root(x) for x in up]})

    kind = links.schema["a"].dataType.simpleString()
    return settle(links.coalesce(1).mapInPandas(work, f"node {kind}, component {kind}"))


def _crossing(v: np.ndarray, u: np.ndarray, c: np.ndarray, d: np.ndarray, s: np.ndarray, t: np.ndarray) -> tuple[np.ndarray | None, np.ndarray | None]:
    """Rows and columns of different components (``c``, ``d``) that are not further than what either side searches (``s``, ``t``; below 0: not at all).
    None where these are many."""
    own, other, n = np.flatnonzero(s >= 0), np.flatnonzero(t >= 0), 8 * (len(s) + len(t))
    if len(own) + len(other) >= len(s) / 2 + len(t) / 2:
        own, other = np.arange(len(s)), other[:0]
        limits = np.maximum(_reach(s)[:, None], _reach(t)) if (t >= 0).any() else _reach(s)[:, None]
    else:
        limits = _reach(s[own])[:, None]
    x, y = np.nonzero((_squares(v[own], u) <= limits) & (c[own][:, None] != d))
    row, col = own[x], y
    if len(row) <= n and len(other):
        x, y = np.nonzero((_squares(v, u[other]) <= _reach(t[other])) & (c[:, None] != d[other]))
        row, col = np.r_[row, x], np.r_[col, other[y]]
    return (row, col) if len(row) <= n else (None, None)


def _least(v: np.ndarray, u: np.ndarray, e: np.ndarray, f: np.ndarray, c: np.ndarray, d: np.ndarray, s: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each row and column what is least, but for rounding, and not beyond what its component has."""
    w = np.maximum(np.maximum(_rough(v, u), e[:, None]), f[None, :])
    w[c[:, None] == d[None, :]] = np.inf
    fits = ((w <= w.min(axis=1, keepdims=True) + 1e-9) & (w <= s[:, None] + 1e-9)) | ((w <= w.min(axis=0, keepdims=True) + 1e-9) & (w <= t[None, :] + 1e-9))
    return np.nonzero(fits & np.isfinite(w))


def spanning_tree(of: DataFrame, near: DataFrame, samples: int) -> DataFrame:
    """``a, b, w`` (a < b): the minimum spanning tree of all rows by mutual reachability, exactly.

    Reachability is the largest of the distance and of both rows' distances to their ``samples``-th neighbour. Rounds of Borůvka: each
    component takes its least edge to another one (edges are ordered by weight, then by both ids, so there is one tree). Edges to
    known neighbours give an upper bound; rows whose neighbours are known up to it search no further, and blocks that cannot hold a lighter
    edge are not searched.
    """
    kind = of.schema["ids"].dataType.elementType.simpleString()
    n = of.agg(F.sum(F.size("ids"))).first()[0] or 0
    most = near.agg(F.max("rank")).first()[0] or 0
    all_known = F.lit(float("inf")) if n <= most + 1 else F.max("distance")  # beyond this a row's neighbours are not known
    core = near.groupBy("id").agg(F.max(F.when(F.col("rank") <= samples, F.col("distance"))).alias("core"), all_known.alias("kth"))
    points = of.select("block", F.explode(F.arrays_zip("ids", "vs")).alias("x")).select("block", F.col("x.ids").alias("id"), F.col("x.vs").alias("v"))
    points = settle(points.join(core, "id", "left").withColumn("core", F.coalesce("core", F.lit(0.0))).withColumn("kth", F.coalesce("kth", F.lit(0.0))))
    meta = of.select("block", "cell", "pivot", "lo", "hi")
    known = near.join(points.select("id", "core"), "id").join(points.select(F.col("id").alias("other"), F.col("core").alias("far")), "other")
    known = settle(known.select(F.least("id", "other").alias("x"), F.greatest("id", "other").alias("y"), F.greatest("distance", "core", "far").alias("w")).distinct())
    labels = points.select("id", F.col("id").alias("c"))
    tree = None
    while True:
        labels = settle(labels)
        ends = known.join(labels.toDF("x", "cx"), "x").join(labels.toDF("y", "cy"), "y").where("cx <> cy")
        found = ends.select(F.explode(F.array(F.struct(F.col("cx").alias("c"), F.col("cy").alias("o")), F.struct(F.col("cy").alias("c"), F.col("cx").alias("o")))).alias("e"), "w", "x", "y").select("e.c", "e.o", "w", "x", "y")
        found = settle(found.groupBy("c").agg(F.min(F.struct("w", "x", "y", "o")).alias("m")))
        here = points.join(labels, "id").join(found.select("c", F.col("m.w").alias("bound")), "c", "left").withColumn("bound", F.coalesce("bound", F.lit(float("inf"))))
        here = here.withColumn("bound", F.when(F.col("kth") <= F.col("bound"), F.col("bound")).otherwise(-1.0))  # a row with a lighter edge than any unknown one searches none
        here = settle(here.groupBy("block").agg(F.collect_list(F.struct("id", "v", "core", "c", "bound")).alias("p"), F.max("bound").alias("most"), F.min("core").alias("core"), F.min("c").alias("c0"), F.max("c").alias("c1")))
        m = here.select("block", "most", "core", "c0", "c1").join(meta, "block")
        may = (F.col("a.block") <= F.col("b.block")) & (F.greatest(_apart("a", "b"), F.col("a.core"), F.col("b.core")) <= F.greatest("a.most", "b.most")) & ~((F.col("a.c0") == F.col("a.c1")) & (F.col("b.c0") == F.col("b.c1")) & (F.col("a.c0") == F.col("b.c0")))
        pairs = m.alias("a").join(m.alias("b"), may).select(F.col("a.block").alias("a"), F.col("b.block").alias("b"))  # rows are blocks

        def lightest(rows: dict, met: list) -> pd.DataFrame:
            sides = {b: tuple(np.array([x[k] for x in r["p"]]) for k in ("id", "v", "core", "c", "bound")) for b, r in rows.items()}
            out = []
            for p, q in met:
                (i, v, e, c, s), (j, u, f, d, t) = sides[p], sides[q]
                row, col = _crossing(v, u, c, d, s, t)
                if row is None:
                    row, col = _least(v, u, e, f, c, d, s, t)
                exact = np.maximum(np.maximum(between(v[row], u[col]), e[row]), f[col])
                lo, hi = np.minimum(i[row], j[col]), np.maximum(i[row], j[col])
                both = pd.DataFrame({"c": np.r_[c[row], d[col]], "w": np.r_[exact, exact], "x": np.r_[lo, lo], "y": np.r_[hi, hi], "o": np.r_[d[col], c[row]]})
                out.append(both.sort_values(["c", "w", "x", "y"]).drop_duplicates("c"))
            return pd.concat(out).sort_values(["c", "w", "x", "y"]).drop_duplicates("c")

        more = _by_tiles(pairs, here.select("block", "p"), lightest, f"c {kind}, w double, x {kind}, y {kind}, o {kind}").select("c", F.struct("w", "x", "y", "o").alias("m"))
        best = settle(found.unionByName(more).groupBy("c").agg(F.min("m").alias("m")).select("c", "m.*"))
        if best.isEmpty():
            break
        edges = best.select(F.col("x").alias("a"), F.col("y").alias("b"), "w").distinct()
        tree = settle(edges if tree is None else tree.unionByName(edges))
        to = _joined(best.select(F.col("c").alias("a"), F.col("o").alias("b")))
        labels = labels.join(to.select(F.col("node").alias("c"), F.col("component").alias("to")), "c", "left").select("id", F.coalesce("to", "c").alias("c"))
    return points.sparkSession.createDataFrame([], f"a {kind}, b {kind}, w double") if tree is None else tree


def condensed(a: np.ndarray, b: np.ndarray, w: np.ndarray, n: int, least: int) -> np.ndarray:
    """Cluster of each of ``n`` points, -1 for noise, from tree edges in order of weight: the condensed tree's clusters with the most
    excess of mass. Points are 0 to n - 1; clusters are numbered by their first point.

    A component splits into two clusters where both sides have ``least`` points; a smaller side falls out. The whole is no cluster.
    """
    # merges: nodes n, n + 1, ... in order of weight
    parent = np.arange(2 * n - 1)
    size = np.r_[np.ones(n, np.int64), np.zeros(n - 1, np.int64)]
    child = np.zeros((max(n - 1, 0), 2), np.int64)

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, (x, y) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
        x, y = root(x), root(y)
        child[i] = x, y
        parent[x] = parent[y] = n + i
        size[n + i] = size[x] + size[y]
    lam = 1 / np.maximum(w, 1e-12)
    # downwards: the cluster of each node; a split makes two, what is too small falls out of its cluster at that level
    of = np.full(2 * n - 1, -1, np.int64)
    born, up, mass = [0.0], [-1], [0.0]
    of[2 * n - 2] = 0
    for i in range(n - 2, -1, -1):
        c, sides = of[n + i], child[i]
        big = size[sides] >= least
        for x, own in zip(sides.tolist(), big.tolist(), strict=True):
            if own and big.all():
                of[x] = len(born)
                born.append(lam[i])
                up.append(c)
                mass.append(0.0)
            else:
                of[x] = c
        # points leave at the level of the last node of their cluster that has them: a small side whole, both where none is large
        if big.all():
            mass[c] += (lam[i] - born[c]) * int(size[n + i])
        else:
            for x, own in zip(sides.tolist(), big.tolist(), strict=True):
                if not own and size[n + i] >= least:
                    mass[c] += (lam[i] - born[c]) * int(size[x])
    # upwards: a cluster stands if it has more than what its descendants have together
    chosen, below = np.ones(len(born), bool), np.zeros(len(born))
    for c in range(len(born) - 1, 0, -1):
        if below[c] > mass[c]:
            chosen[c] = False
        below[up[c]] += max(mass[c], below[c])
    chosen[0] = False
    stands = np.full(len(born), -1, np.int64)
    for c in range(1, len(born)):
        stands[c] = stands[up[c]] if stands[up[c]] >= 0 else (c if chosen[c] else -1)
    label = stands[of[:n]]
    kept, first = np.unique(label[label >= 0], return_index=True)
    number = {int(c): i for i, c in enumerate(kept[np.argsort(first)])}
    return np.array([number.get(int(x), -1) for x in label], np.int64)


def labelled(points: DataFrame, tree: DataFrame, least: int) -> DataFrame:
    """``id, cluster`` of each of ``points`` (``id``). One task condenses the tree: its edges, no vectors; over ``MOST_POINTS`` raise."""
    n = points.count()
    if n > MOST_POINTS:
        raise ValueError(f"{n} points; one task condenses trees of {MOST_POINTS} at the most")
    kind = points.schema["id"].dataType.simpleString()
    rows = points.select(F.col("id").alias("a"), F.lit(None).cast(kind).alias("b"), F.lit(0.0).alias("w")).unionByName(tree)

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        edge = pdf["b"].notna()
        ids = np.sort(pdf.loc[~edge, "a"].to_numpy())
        e = pdf.loc[edge, ["a", "b", "w"]].astype({"b": pdf["a"].dtype}).sort_values(["w", "a", "b"])
        if len(ids) < 2:
            return pd.DataFrame({"id": ids, "cluster": -1})
        return pd.DataFrame({"id": ids, "cluster": condensed(np.searchsorted(ids, e["a"]), np.searchsorted(ids, e["b"]), e["w"].to_numpy(), len(ids), least)})

    return settle(rows.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(work, f"id {kind}, cluster long"))


def density_clusters(vectors: DataFrame, least: int = 10, samples: int = 5, noise: float = 0.4, retry: tuple[int, int] = (5, 3), key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``KEY, cluster``: density clusters of all rows with a vector by HDBSCAN, -1 is noise; with more than a share ``noise`` of it
    clusters of ``retry`` (least size, samples) are taken. Distances are those of vectors of length 1."""
    of = blocks(vectors.dropDuplicates([key]), key, vector)
    points = of.select(F.explode("ids").alias("id"))
    near, out = neighbours(of, 2 * max(samples, retry[1]) + 5), None  # more neighbours than asked for: fewer searches
    for size, s in ((least, samples), retry):
        out = labelled(points, spanning_tree(of, near, s), size)
        share = out.agg(F.avg((F.col("cluster") < 0).cast("double")).alias("x")).first()[0]
        if share is None or share <= noise:
            break
    return out.select(F.col("id").alias(key), "cluster")


# -- outliers


def isolation_tree(x: np.ndarray, seed: int) -> tuple[list[int], list[float], list[int], list[int], list[float]]:
    """Random cuts of a sample as arrays: dimension (-1 in leaves), cut, left and right node, and path length in leaves."""
    rng = np.random.default_rng(seed)
    dim, cut, left, right, length = [], [], [], [], []
    limit = int(np.ceil(np.log2(max(len(x), 2))))
    todo = [(np.arange(len(x)), 0, -1, False)]
    while todo:
        rows, depth, above, is_right = todo.pop()
        here = len(dim)
        if above >= 0:
            (right if is_right else left)[above] = here
        lo, hi = x[rows].min(axis=0), x[rows].max(axis=0)
        open_ = np.flatnonzero(hi > lo)
        leaf = len(rows) <= 1 or depth >= limit or not len(open_)
        d = -1 if leaf else int(rng.choice(open_))
        c = 0.0 if leaf else float(rng.uniform(lo[d], hi[d]))
        for column, value in zip((dim, cut, left, right, length), (d, c, -1, -1, depth + mean_path(len(rows)) if leaf else 0.0), strict=True):
            column.append(value)
        if not leaf:
            below = x[rows, d] <= c
            todo += [(rows[~below], depth + 1, here, True), (rows[below], depth + 1, here, False)]
    return dim, cut, left, right, length


def mean_path(n: int) -> float:
    """The mean path of a search that fails in a binary tree of ``n``."""
    return 0.0 if n <= 1 else 1.0 if n == 2 else 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n


def path_lengths(x: np.ndarray, tree: tuple) -> np.ndarray:
    """All rows walk down at once."""
    dim, cut, left, right, length = map(np.asarray, tree)
    at = np.zeros(len(x), np.int64)
    while True:
        go = np.flatnonzero(dim[at] >= 0)
        if not len(go):
            return length[at]
        node = at[go]
        at[go] = np.where(x[go, dim[node]] <= cut[node], left[node], right[node])


def isolation(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", trees: int = TREES, seed: int = 42) -> DataFrame:
    """``KEY, isolation``: how soon random cuts part a row from the others (0 to 1, higher is sooner); one row a row with a vector.

    Each tree sees ``SAMPLE`` rows of a pool of ``POOL``, both by a hash of the key; trees are grown apart, each in a group of its sample,
    and walked as arrays over all rows.
    """
    rows = settle(vectors.where(F.col(vector).isNotNull() & F.col(key).isNotNull()).select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v")))
    pool = settle(rows.orderBy(F.xxhash64("id"), "id").limit(POOL))
    drawn = pool.select("id", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"))
    drawn = drawn.withColumn("k", F.row_number().over(Window.partitionBy("tree").orderBy(F.xxhash64("id", "tree"), "id"))).where(F.col("k") <= SAMPLE)

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        t = int(pdf["tree"].iloc[0])
        grown = isolation_tree(np.array(pdf.sort_values("k")["v"].tolist()), seed + t)
        return pd.DataFrame({"tree": [t], "n": [len(pdf)], **{c: [v] for c, v in zip(("dim", "cut", "left", "right", "length"), grown, strict=True)}})

    grown = drawn.join(pool, "id").groupBy("tree").applyInPandas(grow, "tree int, n long, dim array<int>, cut array<double>, left array<int>, right array<int>, length array<double>")
    forest = [(r.n, (r.dim, r.cut, r.left, r.right, r.length)) for r in grown.orderBy("tree").collect()]  # at most 2 * SAMPLE nodes a tree
    kind = rows.schema["id"].dataType.simpleString()

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x = np.array(pdf["v"].tolist())
            mean = sum(path_lengths(x, t) for _, t in forest) / len(forest)
            yield pd.DataFrame({"id": pdf["id"], "isolation": 2.0 ** (-mean / max(mean_path(forest[0][0]), 1e-12))})

    if not forest:
        return rows.select(F.col("id").alias(key), F.lit(0.0).alias("isolation"))
    return rows.mapInPandas(walk, f"id {kind}, isolation double").withColumnRenamed("id", key)


def outliers(vectors: DataFrame, k: int = 20, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``KEY, lof, isolation, ood_score`` of every row with a vector: the local outlier factor over ``k`` neighbours and the isolation score,
    both scaled to 0 to 1 over all rows, and their mean; 0 for up to ``k`` rows. Rows that repeat a key count once."""
    from .signals import local_outlier_factor

    vectors = vectors.dropDuplicates([key])
    scores = isolation(vectors, key, vector)
    of = blocks(vectors, key, vector, unit=False)
    factor = local_outlier_factor(neighbours(of, k)).select(F.col("id").alias(key), "lof")
    both = settle(scores.join(factor, key, "left").withColumn("lof", F.coalesce("lof", F.lit(0.0))))
    ends = both.agg(F.count("*").alias("n"), *(f(c).alias(f"{name}_{c}") for c in ("lof", "isolation") for name, f in (("lo", F.min), ("hi", F.max))))
    scaled = lambda c: F.when(F.col(f"hi_{c}") > F.col(f"lo_{c}"), (F.col(c) - F.col(f"lo_{c}")) / (F.col(f"hi_{c}") - F.col(f"lo_{c}"))).otherwise(0.0)
    score = F.when(F.col("n") > k, 0.5 * scaled("lof") + 0.5 * scaled("isolation")).otherwise(0.0)
    return both.crossJoin(F.broadcast(ends)).select(key, "lof", "isolation", score.alias("ood_score"))  # one row


def topic_outliers(scores: DataFrame, topics: DataFrame, key: str = "vec_id", topic: str = "topic_id") -> DataFrame:
    """``TOPIC, n, ood_max, ood_mean``: a topic's score is its articles' largest and mean one."""
    return topics.select(key, topic).join(scores.select(key, "ood_score"), key).groupBy(topic).agg(F.count("*").alias("n"), F.max("ood_score").alias("ood_max"), F.avg("ood_score").alias("ood_mean"))
