"""SimHash fingerprints, their likeness, and the search for all fingerprints within a Hamming radius.

Terms are pairs of consecutive words (a single word is its own term), weighted by their length in bytes, so that pairs
of short common words count little, times one plus the logarithm of how often they occur; a term votes with its weight
on the bits of its 128-bit hash. The search cuts fingerprints into ``radius + free`` blocks of which at least ``free``
agree when they differ in ``radius`` bits at most; each of the tables has another choice of ``free`` blocks permuted to
the front as its key, and every match is then counted bit by bit. More free blocks make longer keys, and so fewer
candidates, in more tables.

Cases: null and empty texts, or texts without words, have the fingerprint of no votes (zeros); equal texts have equal
fingerprints; whole numbers as ids go by value, others by their text; a missing id sorts after all others (all rows
without one go through one task, as a stream); rows that repeat an id go by their text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from . import textkit as tk
from .store import settle

BITS, MOST_WEIGHT = 128, 32
#: Text of a range of ids, on average.
RANGE_BYTES = 32 << 20
LEAST = -(2**63)


def fingerprints(column: pa.Array) -> np.ndarray:
    """Packed fingerprints, 16 bytes a text."""
    w = tk.Words(column, tk.SPACED, lower=True)
    h, n = w.hash(), len(w.offs) - 1
    inside = tk.gram_rows(w, 2)
    terms, row = tk.grams(h, 2)[inside], w.row[: len(inside)][inside]
    weight = np.minimum((w.end[1:] - w.start[:-1])[: len(inside)][inside], MOST_WEIGHT).astype(np.float32)
    alone = w.first[:-1][w.counts == 1]
    terms, row, weight = np.r_[terms, h[alone]], np.r_[row, w.row[alone]], np.r_[weight, np.ones(len(alone), np.float32)]
    _, first, seen = np.unique(tk.mix(terms ^ tk.mix(row.astype(np.uint64))), return_index=True, return_counts=True)
    order = np.argsort(row[first], kind="stable")
    first, seen = first[order], seen[order]
    terms, row, weight = terms[first], row[first], weight[first] * (1 + np.log(seen)).astype(np.float32)
    bits = np.unpackbits(np.column_stack([terms, tk.mix(terms ^ np.uint64(0xD6E8FEB86659FD93))]).view(np.uint8), axis=1)
    at = np.searchsorted(row, np.arange(n + 1))
    out = np.zeros((n, BITS), np.uint8)
    for r in np.flatnonzero(np.diff(at)):
        v = weight[at[r] : at[r + 1]]
        out[r] = 2 * (v @ bits[at[r] : at[r + 1]]) > v.sum()
    return np.packbits(out, axis=1)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The cosine that the share of differing bits stands for; below zero is 0."""
    differ = np.bitwise_count(a ^ b).sum(axis=1)
    return np.clip(np.cos(np.pi * differ / BITS), 0, 1)


def fingerprint(docs: DataFrame) -> DataFrame:
    """``docs`` without ``text``, with ``fingerprint`` (32 hex digits)."""
    rest = [c for c in docs.columns if c not in ("text", "fingerprint")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in tk.slices(batches, most=1 << 20):
            made = [x.tobytes().hex() for x in fingerprints(b.column(len(rest)))]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(made, pa.string())], [*rest, "fingerprint"])

    return docs.select(*rest, F.col("text").cast("string").alias("text")).mapInArrow(work, docs.select(rest).schema.add("fingerprint", "string"))


def _tables(rows: DataFrame, name: str, radius: int, free: int) -> DataFrame:
    """``key`` and the fingerprint (as two longs, ``name`` with ``_0`` and ``_1``) once for each block table."""
    digits, blocks = BITS // 4, radius + free
    if not 0 < blocks <= digits:
        raise ValueError("radius and free blocks have to fit the fingerprint's hex digits")
    at = [round(i * digits / blocks) for i in range(blocks + 1)]
    cut = [F.substring("fingerprint", lo + 1, hi - lo) for lo, hi in zip(at[:-1], at[1:], strict=True)]
    keys = [F.xxhash64(F.lit(n), *(cut[i] for i in chosen)) for n, chosen in enumerate(combinations(range(blocks), free))]
    half = [F.shiftleft(F.conv(F.substring("fingerprint", x, 8), 16, 10).cast("long"), 32).bitwiseOR(F.conv(F.substring("fingerprint", x + 8, 8), 16, 10).cast("long")) for x in (1, 17)]
    return rows.select(half[0].alias(f"{name}_0"), half[1].alias(f"{name}_1"), F.explode(F.array(*keys)).alias("key"))


def matches(prints: DataFrame, queries: DataFrame, radius: int = 3, free: int = 2) -> DataFrame:
    """``q, p, distance``: for each different fingerprint of ``queries`` those of ``prints`` within ``radius`` bits.

    Equal fingerprints go through the tables as one, so that copies of a document do not crowd a key.
    """
    own, asked = prints.select("fingerprint").distinct(), queries.select("fingerprint").distinct()
    pairs = _tables(asked, "q", radius, free).join(_tables(own, "p", radius, free), "key")
    differ = sum((F.bit_count(F.col(f"q_{i}").bitwiseXOR(F.col(f"p_{i}"))) for i in (0, 1)), F.lit(0))
    pairs = pairs.withColumn("distance", differ).where(F.col("distance") <= radius).drop("key").distinct()
    hexed = lambda x: F.lower(F.concat(*(F.lpad(F.hex(F.col(f"{x}_{i}")), 16, "0") for i in (0, 1))))
    return pairs.select(hexed("q").alias("q"), hexed("p").alias("p"), "distance")


def within(prints: DataFrame, queries: DataFrame, radius: int = 3, free: int = 2) -> DataFrame:
    """``query_id, doc_id, distance``: for each row of ``queries`` all rows of ``prints`` (both: ``doc_id, fingerprint``)
    within ``radius`` bits, once; a query finds itself if it is in ``prints``. Rows of copies are all told: where copies
    are many, ``neighbours`` counts them instead.
    """
    out = matches(prints, queries, radius, free).join(queries.select(F.col("doc_id").alias("query_id"), F.col("fingerprint").alias("q")), "q")
    return out.join(prints.select("doc_id", F.col("fingerprint").alias("p")), "p").select("query_id", "doc_id", "distance")


def neighbours(prints: DataFrame, queries: DataFrame, radius: int = 3, free: int = 2) -> DataFrame:
    """``queries`` with ``n_near``: how many rows of ``prints`` are within ``radius`` bits (itself too, if it is there)."""
    count = prints.groupBy("fingerprint").agg(F.count("*").alias("n"))
    near = matches(count, queries, radius, free).join(count.withColumnRenamed("fingerprint", "p"), "p").groupBy("q").agg(F.sum("n").alias("n_near"))
    return queries.join(near.withColumnRenamed("q", "fingerprint"), "fingerprint", "left").select(*(c for c in queries.columns if c != "n_near"), F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"))


def _ranges(ids: DataFrame, parts: int) -> list:
    """The largest ``k`` of each of about ``parts`` ranges that hold like numbers of rows, ascending: one value a range."""
    ranged = ids.repartitionByRange(parts, "k").select("k", F.spark_partition_id().alias("part"))
    return sorted(r.k for r in ranged.groupBy("part").agg(F.max("k").alias("k")).collect())


def edited_pairs(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """Each document's fingerprint beside that of its edited text and of the next document, descending by id.

    ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``. The last
    ``n_chars // 3`` code points of the edited text come from the next document's beginning; the last document's next
    is the first. One shuffle of the texts by ranges of ids, each range a task of ``RANGE_BYTES`` of text, if ``parts``
    does not give their number; the first row of a range goes to its neighbour as well.
    """
    spark, kind = docs.sparkSession, docs.schema["doc_id"].dataType.simpleString()
    whole = isinstance(docs.schema["doc_id"].dataType, IntegralType)
    k = F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST)) if whole else F.coalesce(F.concat(F.lit("="), F.col("doc_id").cast("string")), F.lit(""))
    docs = docs.select(k.alias("k"), "doc_id", F.col("text").cast("string").alias("text"))
    if not parts:
        size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        parts = max(spark.sparkContext.defaultParallelism, -(-size // RANGE_BYTES))
    heads = _ranges(docs.select("k"), parts)
    told_schema = f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    if not heads:
        return spark.createDataFrame([], told_schema)
    starts = np.array(heads, np.int64 if whole else object)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            k = b.column(0).to_numpy(zero_copy_only=False)
            part = np.searchsorted(starts, k)
            first = np.flatnonzero(starts[part] == k)
            names = ["part", "tail", "k", "doc_id", "text"]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(np.zeros(len(k), np.int32)), *b.columns], names)
            if len(first):
                also = b.take(pa.array(first))
                yield pa.RecordBatch.from_arrays([pa.array((part[first] + 1) % len(starts), pa.int32()), pa.array(np.ones(len(first), np.int32)), *also.columns], names)

    out = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def told(rows: list[tuple], nxt: tuple, id_type: pa.DataType) -> pa.RecordBatch:
        texts = [r[4] or "" for r in rows] + [nxt[4] or ""]
        edited = []
        for a, b in zip(texts[:-1], texts[1:], strict=True):
            n = len(a) // 3
            edited.append(a[: len(a) - n] + b[:n])
        own, other = fingerprints(pa.array(texts, pa.string())), fingerprints(pa.array(edited, pa.string()))
        hexed = lambda p: pa.array([x.tobytes().hex() for x in p], pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array([r[3] for r in rows], id_type), pa.array([len(t) for t in texts[:-1]], pa.int64()), pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()), hexed(own[:-1]), hexed(other), pa.array(likeness(own[:-1], other)), pa.array(likeness(own[:-1], own[1:]))], out
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # rows of one range that wait for the next one
        size, tailed = 0, None
        for big in batches:
            id_type = big.schema.field("doc_id").type
            for b in tk.slices(iter([big]), most=1 << 18):
                for r in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    if r[1]:
                        if held and tailed != r[0]:
                            yield told(held, r, id_type)
                        held, size, tailed = [], 0, r[0]
                        continue
                    if size > 1 << 18:
                        yield told(held, r, id_type)
                        held, size = [], 0
                    held.append(r)
                    size += len(r[4] or "")

    dealt = docs.mapInArrow(deal, f"part int, tail int, k {'long' if whole else 'string'}, doc_id {kind}, text string")
    return dealt.repartitionById(len(heads), "part").sortWithinPartitions("part", "tail", F.desc("k"), "text").mapInArrow(work, told_schema)


def fingerprint_query(docs: DataFrame, radius: int = 3) -> DataFrame:
    """``edited_pairs`` with ``n_near``: for documents whose id is divisible by 100, the number of documents whose
    fingerprint is within ``radius`` bits; null for others, which are not asked for."""
    told = settle(edited_pairs(docs))
    asked = F.coalesce(F.col("doc_id").cast("string").try_cast("long") % 100 == 0, F.lit(False))
    near = neighbours(told.select("fingerprint"), told.where(asked), radius)
    return told.where(~asked).withColumn("n_near", F.lit(None).cast("long")).unionByName(near)
