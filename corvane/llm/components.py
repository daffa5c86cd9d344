"""Union-find over links that no single machine holds.

Every task first unites the links it has and passes on a spanning forest; then rounds of large-star and small-star
contraction let each node meet the smallest node of its component. All state between rounds is a table in the shared
folder; the driver sees two numbers a round.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import settle

#: Links that a task unites at once; a longer partition is united piece by piece.
AT_ONCE = 500_000


class Union:
    """Union-find; the smallest member is the root."""

    def __init__(self) -> None:
        self.up: dict = {}

    def root(self, x):
        up = self.up
        while (y := up.get(x, x)) != x:
            up[x] = x = up.get(y, y)
        return x

    def join(self, a, b) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        if b < a:
            a, b = b, a
        self.up[b] = a
        return True

    def forest(self) -> list[tuple]:
        return [(x, r) for x in list(self.up) if (r := self.root(x)) != x]


def forest(links: DataFrame) -> DataFrame:
    """Links ``u, v`` (u > v) with the components that each task's links have, fewer than its nodes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, n, schema = Union(), 0, None

        def out():
            pairs = sets.forest()
            return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], schema.field(i).type) for i in (0, 1)], ["u", "v"])

        for b in batches:
            schema = b.schema
            for x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                sets.join(x, y)
            if (n := n + b.num_rows) >= AT_ONCE:
                yield out()
                sets, n = Union(), 0
        if n:
            yield out()

    return links.mapInArrow(work, links.schema)


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``node, component`` for every node of ``links`` (two columns of one orderable type); component: smallest node.

    Rows with a null or with twice the same node link nothing (such nodes are missing from the result, as are all
    nodes of an empty table). Repeated links count once.
    """
    a, b = links.columns
    e = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    e, before = settle(forest(e)), None
    for _ in range(most_rounds):
        said = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(said) == before or not said[0]:
            break
        before = tuple(said)
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # settled, so that the join has shuffles of its own and splits a node with very many links
        least = settle(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        e = settle(both.join(least, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = settle(e.groupBy("u").agg(F.min("v").alias("m")))
        e = e.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        e = settle(e.distinct())
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
