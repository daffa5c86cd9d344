"""Near-duplicate documents: SuperMinHash signatures, banding, exact verification and union-find grouping.

A signature's entry is the least value that any shingle has there; a shingle's values are its rank in a random
permutation of the entries plus a random fraction, so ranks are dealt out without repetition (lower variance than
independent hashes), and a document is done at the first rank at which every entry is filled (early stopping).

Texts with equal shingle sets are one from the start. Sets that agree on all rows of a band fall into one candidate
group; all sets of a group are compared exactly, by matrix products over blocks of sets, so a link is never judged by
signatures and pairs are never rows. With 50 bands of 5 rows a pair at similarity 0.8 shares no band with probability
3e-9. Shingles are compared as 64-bit hashes.

Groups of any size are whole: a group of k sets is cut into blocks by number and by bytes, and each task gets the sets
of two blocks, at most 16 copies of each set while k is below 32,768 and the sets are of common length. A block by itself
gives a forest; two blocks give only links between components of the one and of the other.

Cases: null and empty texts, or texts without words, have an empty set and are linked with nothing; fewer words than a
shingle has make one shingle; rows with a null id are kept and linked with nothing; rows that repeat an id are rows of
their own, joined under that id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkit as tk
from .components import Union, components
from .store import settle

BANDS, ROWS = 50, 5
#: Sets in a block: a sixteenth of the group, within these bounds.
BLOCK_LEAST, BLOCK_MOST, BLOCKS = 128, 2048, 16
#: Shingles in a block (16 MB of hashes), on average.
BLOCK_SHINGLES = 2 << 20
_NONE = np.uint64(2**64 - 1)


def shingle_sets(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted within the row, and the rows' offsets."""
    words = tk.Words(column, tk.SPACED, lower=True)
    h = words.hash()
    g = tk.grams(h, k)
    n = len(words.offs) - 1
    start, size = words.first[:-1], words.counts
    few = np.flatnonzero((size > 0) & (size < k))
    to = np.where(size >= k, size - k + 1, 0)
    values = g[tk.gram_rows(words, k)]
    offs = np.r_[0, np.cumsum(to)]
    for r in range(n):
        values[offs[r] : offs[r + 1]].sort()
    keep = np.ones(len(values), bool)
    keep[1:] = values[1:] != values[:-1]
    keep[offs[:-1][to > 0]] = True
    kept = np.r_[0, np.cumsum(keep)]
    values, offs = values[keep], kept[offs]
    if len(few):
        whole = np.array([tk.mix(np.array([int(np.bitwise_xor.reduce(h[start[r] : start[r] + size[r]] * tk.powers(size[r] + 1)[0][: size[r]])) ^ int(size[r])], np.uint64))[0] for r in few], np.uint64)
        values, offs = np.insert(values, offs[few], whole), offs + np.r_[0, np.cumsum((size > 0) & (size < k))]
    return values, offs


def signatures(values: np.ndarray, offs: np.ndarray, m: int) -> np.ndarray:
    """SuperMinHash signatures (rows x m) of the sets; a value's upper half is the rank."""
    n = len(offs) - 1
    h = np.full((n, m), _NONE, np.uint64)
    flat, row = h.ravel(), np.repeat(np.arange(n), np.diff(offs))
    live, elements, drawn, perm = np.flatnonzero(np.diff(offs)), values, [], None
    for j in range(m):
        x = tk.mix(elements + np.uint64((j + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1)))
        k = j + (((x >> np.uint64(32)) * np.uint64(m - j)) >> np.uint64(32)).astype(np.int64)
        if perm is None and j == 12:  # from here on the permutations themselves are cheaper than the draws
            perm, at = np.tile(np.arange(m, dtype=np.int16), (len(elements), 1)), np.arange(len(elements))
            for i, d in enumerate(drawn):
                perm[at, d], perm[:, i] = perm[:, i].copy(), perm[at, d]
        if perm is None:
            pos = k
            for i in range(j - 1, -1, -1):
                pos = np.where(pos == drawn[i], i, pos)
            drawn.append(k)
        else:
            at = np.arange(len(elements))
            pos = perm[at, k].astype(np.int64)
            perm[at, k] = perm[:, j]
        np.minimum.at(flat, row * m + pos, (x & np.uint64(0xFFFFFFFF)) | np.uint64(j << 32))
        left = (h[live] == _NONE).any(axis=1)
        if not left.all():
            done = np.zeros(n, bool)
            done[live[~left]] = True
            live = live[left]
            if not len(live):
                break
            keep = ~done[row]
            row, elements = row[keep], elements[keep]
            drawn = [d[keep] for d in drawn] if perm is None else drawn
            perm = perm[keep] if perm is not None else None
    return h


def band_keys(h: np.ndarray, bands: int, rows: int) -> np.ndarray:
    out = np.empty((len(h), bands), np.uint64)
    for b in range(bands):
        acc = np.full(len(h), b + 1, np.uint64)
        for i in range(rows):
            acc = tk.mix(acc ^ h[:, b * rows + i]) + np.uint64(b)
        out[:, b] = acc
    return out


def sketch(docs: DataFrame, k: int, least: int, bands: int, rows: int) -> DataFrame:
    """``doc_id, n_shingles, d1, d2`` (a digest of the set) and ``bands`` (none for sets under ``least``)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in tk.slices(batches):
            values, offs = shingle_sets(b.column(1), k)
            n = np.diff(offs)
            sums = []
            for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F):
                total = np.r_[np.zeros(1, np.uint64), np.cumsum(tk.mix(values ^ np.uint64(salt)))]
                sums.append((total[offs[1:]] - total[offs[:-1]]).view(np.int64))
            full = n >= least
            some = np.repeat(full, n)
            keys = band_keys(signatures(values[some], np.r_[0, np.cumsum(n[full])], bands * rows), bands, rows)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(sums[0]), pa.array(sums[1]), tk.lists(pa.array(keys.ravel().view(np.int64)), np.r_[0, np.cumsum(np.where(full, bands, 0))])],
                ["doc_id", "n_shingles", "d1", "d2", "bands"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(work, f"doc_id {kind}, n_shingles long, d1 long, d2 long, bands array<long>")


def links(sets: list[np.ndarray], num: int, den: int) -> np.ndarray:
    """Which of ``sets`` are linked, den * |a & b| >= num * |a | b|, as a symmetric matrix."""
    n, size = len(sets), np.array([len(s) for s in sets])
    rows = np.repeat(np.arange(n), size)
    _, column, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    several = seen > 1
    number, shared = np.cumsum(several) - 1, int(several.sum())
    keep = several[column]
    rows, column = rows[keep], number[column[keep]]
    total, width = np.zeros((n, n), np.float32), max(1, (16 << 20) // (4 * n))
    order = np.argsort(column, kind="stable")
    rows, column = rows[order], column[order]
    for lo in range(0, shared, width):
        a, z = np.searchsorted(column, (lo, lo + width))
        block = np.zeros((n, min(width, shared - lo)), np.float32)
        block[rows[a:z], column[a:z] - lo] = 1
        total += block @ block.T
    hit = np.zeros((n, n), bool)
    for r in range(n):
        both = total[r].astype(np.int64)
        hit[r] = (den * both >= num * (size[r] + size - both)) & (both > 0)
    return hit


def least_linked(hit: np.ndarray) -> np.ndarray:
    """For each row of a symmetric matrix of links, the first row of its component."""
    label = np.full(len(hit), -1)
    for start in range(len(hit)):
        front = np.array([start] if label[start] < 0 else [], np.int64)
        while len(front):
            label[front] = start
            front = np.flatnonzero(hit[front].any(axis=0) & (label < 0))
    return label


def united(ids: list, left: np.ndarray, sets: list[np.ndarray], num: int, den: int) -> list[tuple]:
    """What a pair of blocks adds: of one block (``left`` all true) its forest, each member once at most; of two blocks
    only links between a component of the one and a component of the other, by their smallest members, so that links
    stay in proportion to members however many pairs a member takes part in."""
    order = sorted(range(len(ids)), key=ids.__getitem__)
    ids, left = [ids[x] for x in order], left[order]
    hit = links([sets[x] for x in order], num, den)
    own = least_linked(hit & (left[:, None] == left[None, :]))
    if left.all():
        return [(ids[x], ids[r]) for x, r in enumerate(own.tolist()) if x != r]
    a, b = np.nonzero(hit & (left[:, None] & ~left[None, :]))
    union = Union()
    for x, y in np.unique(np.column_stack([own[a], own[b]]), axis=0).tolist():
        union.join(ids[x], ids[y])
    return union.forest()


def verify(sets: DataFrame, num: int, den: int) -> DataFrame:
    """What each pair of blocks adds to the links (see ``united``): ``u, v``. ``sets``: key, i, j, block, doc_id, items (bytes)."""

    def of(rows: list[tuple]) -> list[tuple]:
        i, j = rows[0][1], rows[0][2]
        left = np.array([r[3] == i for r in rows])
        if len(rows) < 2 or i != j and (left.all() or not left.any()):
            return []
        return united([r[4] for r in rows], left, [np.frombuffer(r[5], np.uint64) for r in rows], num, den)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        found: list[tuple] = []
        kind = None
        for b in batches:
            kind = b.schema.field("doc_id").type
            for r in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if rows and rows[0][:3] != r[:3]:
                    found += of(rows)
                    rows = []
                rows.append(r)
            if len(found) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array([p[x] for p in found], kind) for x in (0, 1)], ["u", "v"])
                found = []
        if rows:
            found += of(rows)
        if found:
            yield pa.RecordBatch.from_arrays([pa.array([p[x] for p in found], kind) for x in (0, 1)], ["u", "v"])

    kind = sets.schema["doc_id"].dataType.simpleString()
    keyed = sets.select("key", "i", "j", "block", "doc_id", "items").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return keyed.mapInArrow(work, f"u {kind}, v {kind}")


def with_sets(members: DataFrame, k: int) -> DataFrame:
    """``members`` (with text) with ``items``, the bytes of the shingle set, in place of the text."""
    rest = [c for c in members.columns if c != "text"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in tk.slices(batches):
            values, offs = shingle_sets(b.column(b.schema.get_field_index("text")), k)
            items = tk.strings(values.view(np.uint8), offs * 8, pa.binary())
            yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(c)) for c in rest), items], [*rest, "items"])

    return members.mapInArrow(work, members.select(rest).schema.add("items", "binary"))


def near_duplicates(docs: DataFrame, k: int = 5, similarity: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for each row of ``docs`` (``doc_id``, ``text``; others are ignored).

    Documents are linked at 100 * |a & b| >= ``similarity`` * |a | b| of their sets of ``k``-word shingles;
    ``component_id`` is the smallest id that links lead to, ``kept`` marks the row whose id that is. Shuffles: digests
    and bands (16 bytes a band), and the texts once for the members of candidate groups.
    """
    docs = docs.select("doc_id", "text")
    least = -(-similarity // (100 - similarity)) if similarity < 100 else 1 << 62  # smaller sets are linked only if equal
    own = settle(sketch(docs, k, least, bands, rows))
    digest = ["n_shingles", "d1", "d2"]
    # aggregates are settled before they are joined back: a join with shuffles of its own splits a hot key
    first = settle(own.where("n_shingles > 0 and doc_id is not null").groupBy(*digest).agg(F.min("doc_id").alias("rep")))
    rep = F.when(F.col("doc_id").isNotNull(), F.col("rep"))
    own_rep = settle(own.join(first, digest, "left").select("doc_id", "n_shingles", rep.alias("rep"), F.when(F.col("doc_id") == F.col("rep"), F.col("bands")).alias("bands")))
    keyed = own_rep.where("bands is not null").select("doc_id", F.explode("bands").alias("band"))
    star = settle(keyed.groupBy("band").agg(F.min("doc_id").alias("center"), F.count("*").alias("n")).where("n > 1").drop("n"))
    groups = settle(components(keyed.join(star, "band").where("doc_id <> center").select("doc_id", "center")))
    sized = own_rep.where("bands is not null").groupBy("doc_id").agg(F.max("n_shingles").alias("size"))
    groups = settle(groups.join(sized, groups["node"] == sized["doc_id"]).select("doc_id", "component", "size"))
    sizes = settle(groups.groupBy("component").agg(F.count("*").alias("n"), F.sum("size").alias("shingles")))
    block = F.least(F.greatest(F.ceil(F.col("n") / BLOCKS), F.lit(BLOCK_LEAST)), F.lit(BLOCK_MOST))
    blocks = F.greatest(F.ceil(F.col("n") / block), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    members = groups.join(sizes, "component").select("doc_id", F.col("component").alias("key"), blocks.alias("blocks"))
    members = members.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
    # however few the members are in a small corpus, their number grows with it: the texts go by a shuffle at every size
    sets = with_sets(docs.hint("merge").join(members, "doc_id"), k)
    pairs = sets.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "doc_id", "items")
    labels = components(verify(pairs, similarity, 100)).withColumnRenamed("node", "rep")
    out = own_rep.select("doc_id", "n_shingles", "rep").join(labels, "rep", "left")
    out = out.select("doc_id", "n_shingles", F.coalesce("component", "rep", "doc_id").alias("component_id"))
    return out.select("*", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))
