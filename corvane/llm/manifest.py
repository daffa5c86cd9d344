"""A Merkle manifest of a dataset: a tree of hashes for each language, one over their roots, and a proof for each row.

Nodes of a tree come in aligned blocks of ``BLOCK`` = ``ARITY ** LEVELS`` consecutive ones. A block is one row and one
task's work, whatever language it is of; its root is a node of the next tree up, and so on until a tree is one block:
roots go up in as many rounds as the tree has levels of blocks, then the proofs come down the same way.

Within a block paths are made by fractal traversal: the block's levels are cut into strata of ``STRATUM`` levels; of each stratum
the existing subtree over the current leaf is kept, and below the top one the desired subtree that follows is grown by
one leaf's share with every path given out, so that it is there when it is wanted. A worker holds one block's digests and
the nodes of two subtrees a stratum. The proof of what is above the block comes with the block's row, once.

A node's place is its rank: ranges of rows are sorted apart, counted, and the counts of the ranges before are added, so
that no tree and no language is one task.

Cases: nulls of any column are hashed as ``-``; rows with a null id come first; rows that repeat an id are leaves of their own, in order of
their hashes; a null language is a tree of its own, the first; without rows there is no manifest, no row. Times and
other columns are no part of a leaf.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import settle

ARITY, LEVELS, STRATUM = 8, 4, 2
BLOCK = ARITY**LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Siblings of a node, level by level: its place in its run, and the others' digests one after the other.
PATH = "array<struct<at:int,siblings:string>>"
#: Rows of a batch that goes back to Spark.
ROWS = 2048


def h(x: str) -> str:
    return hashlib.sha256(x.encode()).hexdigest()


def leaf(text: str = "text") -> Column:
    """The digest of a row: every field as its number of UTF-8 bytes, a colon and its value, ``-`` for null."""

    def say(c: str) -> Column:
        v = F.col(text if c == "text" else c).cast("string")
        return F.when(v.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v))

    return F.sha2(F.concat(*(say(c) for c in FIELDS)), 256)


def height(n: int) -> int:
    """Levels of runs until one node of ``n`` remains."""
    k = 0
    while n > 1:
        n, k = -(-n // ARITY), k + 1
    return k


def grown(nodes: list[str]) -> list[str]:
    """The level above: the digest of each run."""
    return [h("".join(nodes[i : i + ARITY])) for i in range(0, len(nodes), ARITY)]


def block_root(digests: list[str], levels: int) -> str:
    for _ in range(levels):
        digests = grown(digests)
    return digests[0]


class Subtree:
    """``levels`` levels of nodes above the nodes ``lo`` to ``hi`` of a level, grown node by node.

    ``nodes[i]`` are those known of its level i, ``nodes[0]`` its leaves; ``tail`` holds what a run still lacks.
    """

    def __init__(self, lo: int, hi: int, levels: int):
        self.lo, self.hi, self.levels = lo, hi, levels
        self.nodes: list[list[str]] = [[] for _ in range(levels + 1)]

    def add(self, digest: str) -> None:
        """Take the next leaf; complete the runs that end with it."""
        self.nodes[0].append(digest)
        last = self.lo + len(self.nodes[0]) == self.hi
        for i in range(self.levels):
            level, up = self.nodes[i], self.nodes[i + 1]
            if len(level) % ARITY and not last:
                return
            start = len(up) * ARITY
            if start < len(level):
                up.append(h("".join(level[start : start + ARITY])))

    def siblings(self, at: int, level: int) -> tuple[int, str]:
        """Of the node over leaf ``at`` (of the whole level): its place in its run and the run's others."""
        i = (at - self.lo) // ARITY**level
        start = i - i % ARITY
        run = self.nodes[level][start : start + ARITY]
        return i - start, "".join(run[: i - start] + run[i - start + 1 :])


def traverse(digests: list[str], levels: int, stratum: int = STRATUM) -> Iterator[list[tuple[int, str]]]:
    """The path of each leaf of a block in order, up to the block's root: place in the run and siblings of each level.

    Fractal traversal: an existing subtree for each stratum, and a desired one for each but the top.
    """
    strata = [(lo, min(stratum, levels - lo)) for lo in range(0, levels, stratum)]  # lowest level, how many
    of, level = [], digests  # of each stratum's lowest level: what its subtrees take as leaves
    for lo, n in strata:
        of.append(level)
        for _ in range(n):
            level = grown(level) if (lo, n) != strata[-1] else level

    def fresh(i: int, start: int) -> Subtree:
        return Subtree(start, min(start + ARITY ** strata[i][1], len(of[i])), strata[i][1])

    existing, desired = [], []
    for i in range(len(strata)):
        tree = fresh(i, 0)
        for d in of[i][: tree.hi]:
            tree.add(d)
        existing.append(tree)
        desired.append(fresh(i, tree.hi) if tree.hi < len(of[i]) else None)
    for at in range(len(digests)):
        path = []
        for i, (lo, n) in enumerate(strata):
            place = at // ARITY**lo
            if place == existing[i].hi:  # the next subtree is there by now
                existing[i] = desired[i]
                desired[i] = fresh(i, existing[i].hi) if existing[i].hi < len(of[i]) else None
            path += [existing[i].siblings(place, j) for j in range(n)]
        yield path
        for i, tree in enumerate(desired):  # as many leaves as have been left behind below
            if tree is not None:
                done = tree.lo + len(tree.nodes[0])
                due = tree.lo + (at + 1) // ARITY ** strata[i][0] - existing[i].lo
                for d in of[i][done : min(due, tree.hi)]:
                    tree.add(d)


def numbered(rows: DataFrame, by: str, order: list[str]) -> DataFrame:
    """``rows`` with ``pos`` (from 0, in ``order`` within ``by``) and ``n`` (rows of ``by``).

    Rows are dealt in ranges of (``by``, ``order``) and sorted there; the counts of the ranges before are added.
    """
    w = settle(rows.repartitionByRange(by, *order).sortWithinPartitions(by, *order).withColumn("_at", F.monotonically_increasing_id()))
    w = w.withColumn("_part", F.shiftright("_at", 33))
    first = w.groupBy("_part", by).agg(F.min("_at").alias("_first"), F.count("*").alias("_c"))  # a row for each range and tree in it
    each = Window.partitionBy(by)
    first = first.withColumn("n", F.sum("_c").over(each)).withColumn("_before", F.sum("_c").over(each.orderBy("_part")) - F.col("_c"))
    first = settle(first.select("_part", by, "n", (F.col("_before") - F.col("_first")).alias("_shift")))
    return w.join(first, ["_part", by]).select(*rows.columns, (F.col("_at") + F.col("_shift")).alias("pos"), "n")


def blocks(nodes: DataFrame, more: list[str] = ()) -> DataFrame:
    """``tree, block, n, items``: nodes in blocks of at most ``BLOCK``, as ``struct<pos, digest, more...>``. Settled."""
    of = nodes.groupBy("tree", F.expr(f"pos div {BLOCK}").alias("block")).agg(F.max("n").alias("n"), F.collect_list(F.struct("pos", "digest", *more)).alias("items"))
    return settle(of)


def roots(of: DataFrame) -> DataFrame:
    """``tree, pos, n, digest``: the blocks' roots as the nodes of the trees one round up. Settled."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                digests = [d for _, d in sorted(zip(b.column(3)[i].as_py(), b.column(4)[i].as_py(), strict=True))]
                n = b.column(2)[i].as_py()
                root = block_root(digests, min(LEVELS, height(n)))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, 1), b.column(1).slice(i, 1), pa.array([-(-n // BLOCK)], pa.int64()), pa.array([root])], ["tree", "pos", "n", "digest"])

    flat = of.select("tree", "block", "n", "items.pos", "items.digest")
    return settle(flat.mapInArrow(work, "tree string, pos long, n long, digest string"))


def paths(nodes: DataFrame) -> DataFrame:
    """``tree, pos, path, top``: of each node (``tree, pos, n, digest``) its path to its tree's root, and that root."""
    if nodes.where("n > 1").isEmpty():
        return nodes.select("tree", "pos", F.array().cast(PATH).alias("path"), F.col("digest").alias("top"))
    of = blocks(nodes)
    above = paths(roots(of))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                items = sorted((x["pos"], x["digest"]) for x in row["items"])
                made = []
                for (pos, _), path in zip(items, traverse([d for _, d in items], min(LEVELS, height(row["n"]))), strict=True):
                    made.append({"tree": row["tree"], "pos": pos, "path": [{"at": a, "siblings": s} for a, s in path] + row["path"], "top": row["top"]})
                    if len(made) == ROWS:
                        yield pa.RecordBatch.from_pylist(made, _PATHS)
                        made = []
                if made:
                    yield pa.RecordBatch.from_pylist(made, _PATHS)

    joined = of.join(above.withColumnRenamed("pos", "block"), ["tree", "block"])
    return settle(joined.select("tree", "n", "items", "path", "top").mapInArrow(work, f"tree string, pos long, path {PATH}, top string"))


_PATHS = pa.schema([("tree", pa.string()), ("pos", pa.int64()), ("path", pa.list_(pa.struct([("at", pa.int32()), ("siblings", pa.string())]))), ("top", pa.string())])


def folded(digest: str, path: list[tuple[int, str]]) -> str:
    """The root that a digest and the siblings on its path give."""
    for at, others in path:
        digest = h(others[: 64 * at] + digest + others[64 * at :])
    return digest


def leaves(docs: DataFrame) -> DataFrame:
    """``tree, doc_id, digest, tampered, row``: each row's digest, and its digest with A-Z of the text lowered where 3 divides the
    crc32 of the id (else null). ``tree``: the language behind ``=``, null is the empty name, which sorts first."""
    rows = docs.select(*FIELDS, F.translate(F.col("text").cast("string"), _UPPER, _UPPER.lower()).alias("_low"))
    tree = F.when(F.col("lang").isNull(), "").otherwise(F.concat(F.lit("="), F.col("lang").cast("string")))
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, leaf("_low"))
    return settle(rows.select(tree.alias("tree"), "doc_id", leaf().alias("digest"), tampered.alias("tampered"), F.monotonically_increasing_id().alias("row")))


def manifest(docs: DataFrame) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` for each row of ``docs``: its proof, checked against the
    tampered rows."""
    kind = docs.schema["doc_id"].dataType
    of = blocks(numbered(leaves(docs), "tree", ["doc_id", "digest", "row"]), ["doc_id", "tampered"])
    up = paths(roots(of))  # of each block
    tops = settle(up.select(F.lit("").alias("all"), "tree", "top").distinct())  # a row for each language
    names = numbered(tops, "all", ["tree"])
    top = paths(names.select(F.col("all").alias("tree"), "pos", "n", F.col("top").alias("digest"))).select("pos", F.col("path").alias("_path"), F.col("top").alias("root"))
    top = names.select("tree", "pos").join(top, "pos").drop("pos")
    up = up.join(top, "tree").select("tree", F.col("pos").alias("block"), F.concat("path", "_path").alias("path"), F.col("top").alias("subroot"), "root")
    out = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                one = b.slice(i, 1)
                n, items, path, subroot, root = (one.column(c) for c in ("n", "items", "path", "subroot", "root"))
                block = items.flatten()
                block = block.take(pa.compute.sort_indices(block.field("pos")))
                above = [(x["at"], x["siblings"]) for x in path[0].as_py()]
                more = "".join(s for _, s in above)
                digests, tampered = block.field("digest").to_pylist(), block.field("tampered").to_pylist()
                subroot, root = subroot[0].as_py(), root[0].as_py()
                proof, fold = [], []
                for d, t, own in zip(digests, tampered, traverse(digests, min(LEVELS, height(n[0].as_py()))), strict=True):
                    proof.append(h("".join(s for _, s in own) + more))
                    fold.append(folded(t or d, own + above))
                m = len(digests)
                yield pa.RecordBatch.from_arrays([block.field("doc_id"), block.field("digest"), pa.array([subroot] * m), pa.array([root] * m), pa.array(proof), pa.array(fold), pa.array([f == root for f in fold])], out)

    import pyarrow.compute  # noqa: F401

    joined = of.join(up, ["tree", "block"]).select("n", "items", "path", "subroot", "root")
    return joined.mapInArrow(work, f"doc_id {kind.simpleString()}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


def oracle(levels: int = 8) -> str:
    """The same in SQL for DuckDB over ``documents``, with trees of at most ``levels`` levels (``ARITY ** levels`` leaves)."""
    say = lambda c, v: f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(({v})::VARCHAR) || ':' || ({v})::VARCHAR END"
    digest = lambda text: "sha256(" + " || ".join(say(c, text if c == "text" else c) for c in FIELDS) + ")"
    byte = "list_reduce([xor(c, x)] || [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda a, b: xor(a >> 1, 3988292384::BIGINT * (a & 1)))"
    crc = f"xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda y: ascii(y)::BIGINT), lambda c, x: {byte}), 4294967295::BIGINT)"
    parts = []

    def tree(name: str, first: str) -> str:
        """Levels of trees (``g, pos, n, d``) and, for each node of level i, what stands before and behind it in its run."""
        made = [f"{name}0 AS MATERIALIZED ({first})"]
        for i in range(levels):
            run = "PARTITION BY g, pos // 8 ORDER BY pos"
            made.append(f"""{name}s{i} AS MATERIALIZED (SELECT g, pos, n > 1 AS run, coalesce(string_agg(d, '') OVER ({run} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS b, coalesce(string_agg(d, '') OVER ({run} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS e FROM {name}{i})""")
            made.append(f"""{name}{i + 1} AS MATERIALIZED (SELECT g, pos // 8 AS pos, (any_value(n) + 7) // 8 AS n, CASE WHEN any_value(n) > 1 THEN sha256(string_agg(d, '' ORDER BY pos)) ELSE any_value(d) END AS d FROM {name}{i} GROUP BY g, pos // 8)""")
        return ", ".join(made)

    def up(name: str, source: str, g: str) -> tuple[str, str]:
        """From a table with ``p`` (place), ``proof`` and ``fold``: the same, one tree up."""
        made, at = [], source
        for i in range(levels):
            to = f"{name}u{i}"
            made.append(f"""{to} AS MATERIALIZED (SELECT x.* REPLACE (x.proof || CASE WHEN s.run THEN s.b || s.e ELSE '' END AS proof, CASE WHEN s.run THEN sha256(s.b || x.fold || s.e) ELSE x.fold END AS fold, x.p // 8 AS p) FROM {at} x JOIN {name}s{i} s ON s.g = x.{g} AND s.pos = x.p)""")
            at = to
        return ", ".join(made), at

    low = f"translate(text, '{_UPPER}', '{_UPPER.lower()}')"
    parts.append(f"leafs AS MATERIALIZED (SELECT doc_id, CASE WHEN lang IS NULL THEN '' ELSE '=' || lang END AS g, {digest('text')} AS d, CASE WHEN doc_id IS NOT NULL AND {crc} % 3 = 0 THEN {digest(low)} END AS t FROM documents)")
    parts.append("ranked AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, d) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM leafs)")
    parts.append(tree("a", "SELECT g, pos, n, d FROM ranked"))
    parts.append(f"subs AS MATERIALIZED (SELECT g AS lang, 'all' AS g, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n, d FROM a{levels})")
    parts.append(tree("b", "SELECT g, pos, n, d FROM subs"))
    parts.append("start AS (SELECT doc_id, g, 'all' AS every, d AS leaf, pos AS p, '' AS proof, coalesce(t, d) AS fold FROM ranked)")
    one, at = up("a", "start", "g")
    parts.append(one)
    parts.append(f"middle AS (SELECT x.* REPLACE (subs.pos AS p), subs.d AS subroot FROM {at} x JOIN subs ON subs.lang = x.g)")
    two, at = up("b", "middle", "every")
    parts.append(two)
    return f"WITH {', '.join(parts)} SELECT doc_id, leaf, subroot, b{levels}.d AS root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = b{levels}.d AS verified FROM {at}, b{levels}"
