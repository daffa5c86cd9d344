"""Graphs as edge tables: degree, PageRank, components, breadth-first depth, communities."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from ..sources.tables import settle


def degree(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return both.groupBy(F.col("a").alias("node")).agg(F.count("*").alias("degree"))


def pagerank(edges: DataFrame, damping: float = 0.85, rounds: int = 100, tolerance: float = 1e-6, every: int = 4) -> DataFrame:
    """``node, rank`` of weighted edges ``src, dst, weight``; the mass of nodes without edges out goes to all alike.

    Stops once ranks move less than ``tolerance`` in sum over ``every`` rounds, after which the lineage is cut.
    """
    out = Window.partitionBy("src")
    flow = settle(edges.groupBy("src", "dst").agg(F.sum("weight").alias("weight")).withColumn("part", F.col("weight") / F.sum("weight").over(out)).select("src", "dst", "part"))
    nodes = settle(flow.select(F.col("src").alias("node")).unionByName(flow.select(F.col("dst").alias("node"))).distinct())
    n = nodes.count()
    if not n:
        return nodes.withColumn("rank", F.lit(0.0))
    leaves = settle(nodes.join(flow.select(F.col("src").alias("node")).distinct(), "node", "left_anti").withColumn("leaf", F.lit(True)))
    nodes = settle(nodes.join(leaves, "node", "left"))
    ranks = before = nodes.select("node", "leaf", F.lit(1.0 / n).alias("rank"))
    leaky = not leaves.isEmpty()
    for i in range(1, rounds + 1):
        come = flow.join(ranks, flow.src == ranks.node).groupBy("dst").agg(F.sum(F.col("part") * F.col("rank")).alias("come"))
        new = nodes.join(come, nodes.node == come.dst, "left")
        if leaky:  # reads the ranks twice, so they are settled in every round
            new = new.crossJoin(F.broadcast(ranks.agg(F.coalesce(F.sum(F.when(F.col("leaf"), F.col("rank"))), F.lit(0.0)).alias("lost"))))  # one row
        lost = F.col("lost") if leaky else F.lit(0.0)
        new = new.select("node", "leaf", ((1 - damping) / n + damping * (F.coalesce("come", F.lit(0.0)) + lost / n)).alias("rank"))
        look = i % every == 0 or i == rounds
        if leaky or look:
            new = settle(new)
        if look:
            moved = new.join(before.select("node", F.col("rank").alias("old")), "node").agg(F.sum(F.abs(F.col("rank") - F.col("old")))).first()[0]
            if moved < tolerance:
                break
            before = new
        ranks = new
    return new.select("node", "rank")


#: Edges that a task unites at once; a longer partition is united piece by piece.
AT_ONCE = 1_000_000


def roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For each of the nodes 0 to n - 1 the smallest node of its component under the edges ``a, b``."""
    up = np.arange(n)
    while len(a):
        a, b = up[a], up[b]
        apart = a != b
        a, b = a[apart], b[apart]
        np.minimum.at(up, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(further := up[up], up):
            up = further
    return up


def forest(edges: DataFrame) -> DataFrame:
    """Edges ``a, b`` of one atomic type, without nulls, with the same nodes and components: each task unites its own, ``AT_ONCE`` at a time, and
    passes on one edge for each of their nodes, to a node of its component (itself if it has no other)."""

    def united(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        ends = pa.chunked_array([b.column(i) for i in (0, 1) for b in batches]).combine_chunks().dictionary_encode()
        at, names = ends.indices.to_numpy(zero_copy_only=False), ends.dictionary
        up = roots(at[: len(at) // 2], at[len(at) // 2 :], len(names))
        node = np.flatnonzero((up != np.arange(len(up))) | (np.bincount(up, minlength=len(up)) == 1))
        return pa.RecordBatch.from_arrays([names.take(pa.array(node)), names.take(pa.array(up[node]))], schema=batches[0].schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some: list[pa.RecordBatch] = []
        for b in batches:
            some.append(b)
            if sum(x.num_rows for x in some) >= AT_ONCE:
                yield united(some)
                some = []
        if sum(x.num_rows for x in some):
            yield united(some)

    return edges.mapInArrow(work, edges.schema)


def components(edges: DataFrame, rounds: int = 200) -> DataFrame:
    """``node, component`` (its smallest node) of undirected edges ``a, b``: labels move along edges and then jump to their own label's.

    Tasks first unite the edges they have, so that the rounds go over few edges for each node where many are near each other. Edges may be
    repeated; those with a null link nothing.
    """
    e = edges.select("a", "b").where("a is not null and b is not null")
    both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if isinstance(kind := both.schema["a"].dataType, AtomicType):
        e = settle(forest(e.select(F.col("a").cast(kind).alias("a"), F.col("b").cast(kind).alias("b"))))
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = both.distinct()
    both = settle(both)
    labels = settle(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("component")))
    for _ in range(rounds):
        near = both.join(labels, both.b == labels.node).groupBy(F.col("a").alias("n")).agg(F.min("component").alias("m"))
        step = labels.join(near, F.col("node") == F.col("n")).select("node", F.least("component", "m").alias("c"))
        jump = step.alias("s").join(step.select(F.col("node").alias("k"), F.col("c").alias("j")), F.col("s.c") == F.col("k"), "left")
        new = settle(jump.select("node", F.least("c", F.coalesce("j", "c")).alias("component")))
        moved = new.join(labels.select("node", F.col("component").alias("o")), "node").where("component <> o").isEmpty()
        labels = new
        if moved:
            return labels
    raise RuntimeError("labels did not settle")


def density(edges: DataFrame, by: str) -> DataFrame:
    """Nodes, edges, density and mean degree of each group's graph, with the change from the group before."""
    e = edges.select(by, "a", "b").distinct()
    n = e.select(by, F.explode(F.array("a", "b")).alias("x")).groupBy(by).agg(F.countDistinct("x").alias("nodes"))
    out = e.groupBy(by).agg(F.count("*").alias("edges")).join(n, by)
    out = out.withColumn("density", F.when(F.col("nodes") > 1, 2 * F.col("edges") / (F.col("nodes") * (F.col("nodes") - 1))).otherwise(0.0)).withColumn("mean_degree", 2 * F.col("edges") / F.col("nodes"))
    w = Window.orderBy(by)  # one row a group
    return out.withColumn("density_change", F.col("density") - F.lag("density").over(w)).withColumn("edges_change", F.col("edges") - F.lag("edges").over(w))


def depth(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """``root, depth``: the longest of the shortest paths from each node without edges in, along ``src, dst``.

    Rounds of frontiers: each (root, node) is met once, at its least depth, however many walks lead there.
    """
    e = settle(edges.select("src", "dst").where("src is not null and dst is not null").distinct())
    front = settle(e.select("src").distinct().join(e.select(F.col("dst").alias("src")).distinct(), "src", "left_anti").select(F.col("src").alias("root"), F.col("src").alias("node"), F.lit(0).alias("d")))
    seen = front
    for d in itertools.count(1):
        new = front.join(e, F.col("node") == F.col("src")).select("root", F.col("dst").alias("node")).distinct()
        front = settle(new.join(seen.select("root", "node"), ["root", "node"], "left_anti").withColumn("d", F.lit(d)))
        if front.isEmpty():
            break
        seen = settle(seen.unionByName(front))
    return seen.groupBy("root").agg(F.max("d").cast("long").alias("depth"))


def betweenness(edges: DataFrame, sources: int = 500) -> DataFrame:
    """``node, betweenness`` of an undirected graph, normalised, from shortest paths of ``sources`` nodes (chosen by a hash of the
    node; all of them if there are fewer, and then exact).

    Frontiers go out from all sources at once (``source, node, paths``) and come back level by level with the shares that each node has
    of the paths through it. Rows are sources times nodes; each level meets only the two before it.
    """
    both = settle(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct())
    nodes = settle(both.select(F.col("a").alias("node")).distinct())
    n = nodes.count()
    chosen = nodes.orderBy(F.xxhash64("node"), "node").limit(sources)
    levels = [settle(chosen.select(F.col("node").alias("s"), "node", F.lit(1.0).alias("paths")))]
    used = levels[0].count()
    while True:
        step = levels[-1].join(both, F.col("node") == F.col("a")).groupBy("s", F.col("b").alias("node")).agg(F.sum("paths").alias("paths"))
        for old in levels[-2:]:
            step = step.join(old.select("s", "node"), ["s", "node"], "left_anti")
        step = settle(step)
        if step.isEmpty():
            break
        levels.append(step)
    total, below = None, None
    for level in reversed(levels[1:]):
        here = level.withColumn("share", F.lit(0.0)) if below is None else level.join(below, ["s", "node"], "left").withColumn("share", F.coalesce("share", F.lit(0.0)))
        here = settle(here)
        total = here.select("node", "share") if total is None else total.unionByName(here.select("node", "share"))
        up = levels[levels.index(level) - 1]
        met = here.select("s", F.col("node").alias("w"), F.col("paths").alias("pw"), "share").join(both, F.col("w") == F.col("b")).join(up.select("s", F.col("node").alias("a"), F.col("paths").alias("pv")), ["s", "a"])
        below = met.groupBy("s", F.col("a").alias("node")).agg(F.sum(F.col("pv") / F.col("pw") * (1 + F.col("share"))).alias("share"))
    if total is None:
        return nodes.withColumn("betweenness", F.lit(0.0))
    scale = n / max(used, 1) / max((n - 1) * (n - 2), 1)
    return nodes.join(total.groupBy("node").agg((F.sum("share") * scale).alias("betweenness")), "node", "left").select("node", F.coalesce("betweenness", F.lit(0.0)).alias("betweenness"))


def weekly_pagerank(edges: DataFrame, damping: float = 0.85) -> DataFrame:
    """``week, node, rank``: PageRank of each week's weighted undirected graph (``week, a, b, n``), all weeks in one run.

    Graphs without an edge between them only share out the jumps, so ranks over the union are each graph's own times its share of the nodes.
    """
    node = lambda c: F.struct(F.col("week"), F.col(c).alias("node"))
    both = edges.select(node("a").alias("src"), node("b").alias("dst"), F.col("n").alias("weight")).unionByName(edges.select(node("b").alias("src"), node("a").alias("dst"), F.col("n").alias("weight")))
    ranks = pagerank(both, damping).select("node.week", "node.node", "rank")
    return ranks.withColumn("rank", F.col("rank") / F.sum("rank").over(Window.partitionBy("week")))


#: Edges whose communities one task finds.
FEW_EDGES = 200_000


def louvain(edges: DataFrame, resolution: float = 1.0) -> DataFrame:
    """``node, community`` (its smallest node) of weighted undirected edges ``a, b, n`` by modularity: nodes move to the community
    around them with the largest gain, then communities become nodes, until no move gains.

    Rounds are synchronous: in each another half of the nodes, by a hash, may move, so that neighbours do not swap for ever; a round's
    moves are kept while modularity rises. Results depend on the hash as a seeded run depends on its seed. Once no more than
    ``FEW_EDGES`` edges are left, of the graph or between its communities, one task goes on with them, node by node.
    """
    e = settle(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.col("n").cast("double").alias("n")).groupBy("a", "b").agg(F.sum("n").alias("n")))
    total = e.agg(F.sum("n")).first()[0] or 0.0
    names = settle(e.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("community", F.col("node")))
    few = False
    while not few:
        few = e.count() <= FEW_EDGES
        moved = _moves_in_one(e, resolution) if few else _moves(e, total, resolution)
        if moved is None:
            break
        names = settle(names.join(moved.select(F.col("node").alias("community"), F.col("community").alias("to")), "community").select("node", F.col("to").alias("community")))
        if few:
            break
        left, right = moved.toDF("a", "ca"), moved.toDF("b", "cb")
        e = settle(e.join(left, "a").join(right, "b").select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b"), "n").groupBy("a", "b").agg(F.sum("n").alias("n")))
    least = names.groupBy("community").agg(F.min("node").alias("least"))
    return names.join(least, "community").select("node", F.col("least").alias("community"))


def moved_in_turn(links: list[dict[int, float]], loops: list[float], resolution: float = 1.0) -> list[int]:
    """The community of each node (numbers of nodes) of an undirected weighted graph: nodes move in turn to the best community around them
    (the own one, then the smallest among equals) until none gains, then communities are the nodes of the next level."""
    total = sum(loops) + sum(sum(near.values()) for near in links) / 2
    names = list(range(len(links)))
    while total > 0:
        k = [sum(near.values()) + 2 * loop for near, loop in zip(links, loops, strict=True)]
        at, size, any_move, moving = list(range(len(links))), list(k), False, True
        while moving:
            moving = False
            for v, near in enumerate(links):
                own, weight = at[v], {}
                for u, w in near.items():
                    weight[at[u]] = weight.get(at[u], 0.0) + w
                size[own] -= k[v]
                gain = lambda c: weight.get(c, 0.0) - resolution * k[v] * size[c] / (2 * total)  # noqa: B023, E731
                best, most = own, gain(own)
                for c in sorted(weight):
                    if gain(c) > most + 1e-9:
                        best, most = c, gain(c)
                size[best] += k[v]
                if best != own:
                    at[v], moving, any_move = best, True, True
        if not any_move:
            break
        new = {c: i for i, c in enumerate(sorted(set(at)))}
        names = [new[at[v]] for v in names]
        merged: list[dict[int, float]] = [{} for _ in new]
        inner = [0.0] * len(new)
        for v, near in enumerate(links):
            a = new[at[v]]
            inner[a] += loops[v]
            for u, w in near.items():
                b = new[at[u]]
                if a == b:
                    inner[a] += w / 2
                else:
                    merged[a][b] = merged[a].get(b, 0.0) + w
        links, loops = merged, inner
    return names


def _moves_in_one(e: DataFrame, resolution: float) -> DataFrame:
    """All levels of a graph of few edges: ``node, community``, by one task."""
    kind = e.schema["a"].dataType.simpleString()

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["a", "b"])
        nodes = sorted(set(pdf["a"]) | set(pdf["b"]))
        number = {v: i for i, v in enumerate(nodes)}
        links: list[dict[int, float]] = [{} for _ in nodes]
        loops = [0.0] * len(nodes)
        for a, b, n in zip(pdf["a"].map(number), pdf["b"].map(number), pdf["n"], strict=True):
            if a == b:
                loops[a] += n
            else:
                links[a][b] = links[b][a] = n
        of = moved_in_turn(links, loops, resolution)
        first: dict[int, int] = {}
        for i, c in enumerate(of):
            first.setdefault(c, i)
        return pd.DataFrame({"node": nodes, "community": [nodes[first[c]] for c in of]})

    return settle(e.groupBy().applyInPandas(work, f"node {kind}, community {kind}"))


def _moves(e: DataFrame, total: float, resolution: float) -> DataFrame | None:
    """One level of moves over edges (loops are inner weight): ``node, community``, or none if nothing gains."""
    both = settle(e.where("a <> b").unionByName(e.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"), "n")))
    ends = settle(e.select(F.explode(F.array(F.struct(F.col("a").alias("node"), "n"), F.struct(F.col("b").alias("node"), "n"))).alias("x")).groupBy("x.node").agg(F.sum("x.n").alias("k")))
    labels, best, any_move = settle(ends.select("node", F.col("node").alias("community"))), None, False
    value = lambda at: modularity(e, at.select("node", "community")).first()[0] or 0.0
    best, still = value(labels), 0
    for i in itertools.count():  # modularity rises or the rounds end
        of = settle(labels.join(ends, "node"))
        sums = of.groupBy("community").agg(F.sum("k").alias("total"))
        near = both.join(of.select(F.col("node").alias("b"), "community"), "b").groupBy(F.col("a").alias("node"), "community").agg(F.sum("n").alias("w"))
        near = near.join(of.select("node", "k", F.col("community").alias("own")), "node").join(sums, "community")
        gain = F.col("w") - resolution * F.col("k") * (F.col("total") - F.when(F.col("community") == F.col("own"), F.col("k")).otherwise(0.0)) / (2 * total)
        best_of = near.groupBy("node").agg(F.max(F.when(F.col("community") == F.col("own"), gain)).alias("stay"), F.min(F.struct((-F.round(gain, 9)).alias("g"), "community")).alias("m"))
        own = of.join(sums, "community").select("node", (-resolution * F.col("k") * (F.col("total") - F.col("k")) / (2 * total)).alias("alone"))
        turn = F.pmod(F.xxhash64("node", F.lit(i)), F.lit(2)) == 0
        goes = turn & (-F.col("m.g") > F.coalesce("stay", "alone") + 1e-9)
        new = settle(labels.join(best_of, "node", "left").join(own, "node").select("node", F.when(goes, F.col("m.community")).otherwise(F.col("community")).alias("community")))
        now = value(new)
        if now > best + 1e-9:
            labels, best, any_move, still = new, now, True, 0
        else:
            still += 1
            if still == 4:  # both halves have had their turn, more than once
                break
    return labels if any_move else None


def communities(edges: DataFrame, rounds: int = 200) -> DataFrame:
    """``node, community``: each node takes the label with most weight around it (its own among equals, then the smallest).

    Synchronous rounds from the node's own name until no node would move; another half of the nodes, by a hash, may move
    in each round, which keeps pairs from swapping labels for ever.
    """
    both = settle(edges.select("a", "b", "n").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"), "n")))
    labels = settle(both.select(F.col("a").alias("node")).distinct().withColumn("community", F.col("node")))
    for i in range(rounds):
        votes = both.join(labels, both.b == labels.node).groupBy(F.col("a").alias("v"), "community").agg(F.sum("n").alias("w"))
        votes = votes.join(labels.select(F.col("node").alias("v"), F.col("community").alias("own")), "v")
        best = votes.groupBy("v").agg(F.min(F.struct((-F.col("w")).alias("w"), (F.col("community") != F.col("own")).alias("o"), "community")).alias("m"))
        turn = F.pmod(F.xxhash64("node", F.lit(i)), F.lit(2)) == 0
        new = labels.join(best, F.col("node") == F.col("v")).select("node", F.when(turn, F.col("m.community")).otherwise(F.col("community")).alias("community"), (F.col("m.community") != F.col("community")).alias("moves"))
        new = settle(new)
        labels = new.drop("moves")
        if new.where("moves").isEmpty():
            return labels
    raise RuntimeError("labels did not settle")


def modularity(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """One row: the modularity of a partition of weighted undirected edges."""
    e = edges.join(labels.toDF("a", "ca"), "a").join(labels.toDF("b", "cb"), "b")
    total = e.agg(F.sum("n").alias("m"))
    inner = e.where("ca = cb").groupBy(F.col("ca").alias("c")).agg(F.sum("n").alias("inside"))
    ends = e.select(F.explode(F.array(F.struct(F.col("ca").alias("c"), "n"), F.struct(F.col("cb").alias("c"), "n"))).alias("x")).groupBy("x.c").agg(F.sum("x.n").alias("ends"))
    return ends.join(inner, "c", "left").crossJoin(F.broadcast(total)).agg(F.sum(F.coalesce("inside", F.lit(0)) / F.col("m") - (F.col("ends") / (2 * F.col("m"))) ** 2).alias("modularity"))  # one row
