"""Repeated passages across documents, found by FM-indexes over shards of the corpus.

A window of consecutive words that a document with a smaller id has too is a repeat; the words that repeats cover are
removed. Sharding is by content, so that a document streams only through the shards that can hold its passages: each
window has an anchor, the k-word gram of least hash in it, and equal windows have equal anchors. Consecutive windows
with equal anchors make a segment, and all segments of an anchor meet in one shard. Anchors of a single document drop out
before any text moves; equal segments, and documents with equal words, are streamed once, for their smallest id.

Within a shard the index's suffix intervals tell for every window the smallest document that has it. An anchor of more
than ``HOT`` different segments (a passage's edge in very many documents) is not one shard: its segments are cut again by anchors of longer
grams, and what is too much there still goes by single windows, whose smallest document is an ordinary aggregate.
All ways are exact up to collisions of 64-bit hashes of words, segments and windows.

Cases: null and empty texts have no words; texts shorter than the window keep all; a passage twice in one document
stays if no smaller document has it; rows that repeat an id are rows of their own, each judged by its own text (none of
them has a smaller id than another); rows with a null id are kept whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkit as tk
from .fmindex import FMIndex
from .store import settle

#: Different segments of an anchor that one shard takes; words of a shard.
HOT, SHARD_WORDS = 512, 150_000
#: Shards that one task builds, and tasks at the most.
TASK_SHARDS, MOST_TASKS = 4, 20_000
#: An owner behind all documents: what streams for it meets the whole index.
LATER = np.int64(2**62)
#: Windows in a segment; more of one anchor (a word or a phrase again and again) make several.
LONGEST = 128
SPANS = "array<struct<s:int,e:int>>"


def sliding_least(g: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The least of each ``width`` consecutive values, and where it stands first."""
    value, at, k = g, np.arange(len(g)), 1
    while True:
        step = min(k, width - k)
        if not step:
            return value, at
        right = value[step:] < value[:-step]
        value, at = np.where(right, value[step:], value[:-step]), np.where(right, at[step:], at[:-step])
        k += step


class Segmented:
    """Segments of a slice of texts: word positions ``a`` to ``b`` (flat), ``row`` and ``anchor`` of each.

    With grams of ``k`` = ``window`` words each window is a segment of its own.
    """

    def __init__(self, column: pa.Array, window: int, k: int):
        self.words = w = tk.Words(column)
        self.h = w.hash() | np.uint64(1)  # never 0
        self.a = self.b = self.row = np.zeros(0, np.int64)
        self.anchor = np.zeros(0, np.uint64)
        n = len(w) - window + 1
        if n <= 0:
            return
        row = w.row
        inside = row[:n] == row[window - 1 :]
        anchor, _ = sliding_least(tk.grams(self.h, k), window - k + 1)
        same = np.r_[False, inside[1:] & inside[:-1] & (anchor[1:] == anchor[:-1])]
        run = np.flatnonzero(~same)
        same &= (np.arange(n) - np.repeat(run, np.diff(np.r_[run, n]))) % LONGEST != 0
        if k >= window:  # each window by itself: equal windows in a row (of one word) are equal parts, not a longer one
            same[:] = False
        first = np.flatnonzero(inside & ~same)
        last = np.flatnonzero(inside & ~np.r_[same[1:], False])
        self.a, self.b, self.row, self.anchor = first, last + window, row[first], anchor[first]

    def content(self, a: np.ndarray, b: np.ndarray, salt: int = 0) -> np.ndarray:
        """Hashes of word sequences."""
        up, down = tk.powers(len(self.h) + 1)
        total = np.r_[np.zeros(1, np.uint64), np.cumsum((tk.mix(self.h ^ np.uint64(salt)) if salt else self.h) * up[: len(self.h)])]
        return tk.mix((total[b] - total[a]) * down[a] + (b - a).astype(np.uint64))


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with the hash of its text as ``_text_key``: with the id, what a row's result is known by."""
    return docs.withColumn("_text_key", F.xxhash64("text"))


def _scan(docs: DataFrame, window: int, k: int) -> DataFrame:
    """``doc_id, _text_key, n_words, d1, d2`` (of the word sequence) and ``anchors``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in tk.slices(batches):
            s = Segmented(b.column(2), window, k)
            first = s.words.first
            d = [s.content(first[:-1], first[1:], salt).view(np.int64) for salt in (0, 0x2545F4914F6CDD1D)]
            offs = np.r_[0, np.cumsum(np.bincount(s.row, minlength=b.num_rows))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(s.words.counts, pa.int64()), *map(pa.array, d), tk.lists(pa.array(s.anchor.view(np.int64)), offs)], ["doc_id", "_text_key", "n_words", "d1", "d2", "anchors"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "_text_key", "text").mapInArrow(work, f"doc_id {kind}, _text_key long, n_words long, d1 long, d2 long, anchors array<long>")


def _segments(docs: DataFrame, window: int, k: int) -> DataFrame:
    """The segments whose anchor is in ``wanted``: ``doc_id, _text_key, start, n, anchor, content, words`` (their text)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in tk.slices(batches):
            s = Segmented(b.column(2), window, k)
            wanted = b.column(3)
            rows = np.repeat(np.arange(b.num_rows), wanted.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            keys = wanted.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            here = np.isin(tk.mix(s.anchor ^ tk.mix(s.row.astype(np.uint64))), tk.mix(keys ^ tk.mix(rows.astype(np.uint64))))
            a, z, row, w = s.a[here], s.b[here], s.row[here], s.words
            if not len(a):
                continue
            lo, hi = w.start[a], w.end[z - 1]
            text = tk.strings(tk.gather(w.data, lo, hi), np.r_[0, np.cumsum(hi - lo)])
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(row)), b.column(1).take(pa.array(row)), pa.array(a - w.first[row], pa.int32()), pa.array(z - a, pa.int32()), pa.array(s.anchor[here].view(np.int64)), pa.array(s.content(a, z, 0x1B873593CC9E2D51).view(np.int64)), text],
                ["doc_id", "_text_key", "start", "n", "anchor", "content", "words"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "_text_key", "text", "wanted").mapInArrow(work, f"doc_id {kind}, _text_key long, start int, n int, anchor long, content long, words string")


def _spans(starts: np.ndarray, window: int) -> list[dict]:
    """The union of the windows at sorted starts, as spans."""
    if not len(starts):
        return []
    new = np.r_[True, np.diff(starts) > window]
    first = np.flatnonzero(new)
    last = np.r_[first[1:], len(starts)] - 1
    return [{"s": int(s), "e": int(e) + window} for s, e in zip(starts[first], starts[last], strict=True)]


def _shards(segments: DataFrame, window: int) -> DataFrame:
    """``anchor, content, first, spans, later``: of each different segment, its first document, what documents before
    that have, and what its later documents have to give up (for segments with ``several``). Rows sorted by anchor.

    Each segment is in its shard's index once and is streamed once for its first document, and once for all later ones.
    """
    names = ["anchor", "content", "first", "spans", "later"]

    def search(shard: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(shard).combine_chunks()
        w = tk.Words(t.column("words"))
        counts = w.counts
        h = w.hash() | np.uint64(1)
        symbols = np.insert(h, w.first[1:], np.uint64(0))
        ids = t.column("doc_id").combine_chunks().dictionary_encode()
        rank = np.argsort(np.argsort(np.array(ids.dictionary.to_pylist(), object)))
        owner = rank[ids.indices.to_numpy()]
        index = FMIndex(symbols, np.repeat(owner, counts + 1), window)
        start = np.r_[0, np.cumsum(counts + 1)][:-1]
        # an anchor's only segment meets no other one: it is streamed for its later documents alone
        _, at, of = np.unique(t.column("anchor").to_numpy(), return_inverse=True, return_counts=True)
        first, several = np.flatnonzero(of[at] > 1), np.flatnonzero(t.column("several").to_numpy().astype(bool))
        which = np.r_[first, several]
        found = [_spans(x, window) for x in index.stream(symbols, start[which], (start + counts)[which], np.r_[owner[first], np.full(len(several), LATER)])]
        spans, later = [[] for _ in owner], [[] for _ in owner]
        for x, y in zip(first.tolist(), found[: len(first)], strict=True):
            spans[x] = y
        for x, y in zip(several.tolist(), found[len(first) :], strict=True):
            later[x] = y
        some = np.flatnonzero([bool(x or y) for x, y in zip(spans, later, strict=True)])
        t = t.take(pa.array(some))
        return pa.RecordBatch.from_arrays([*(t.column(c).combine_chunks() for c in ("anchor", "content", "doc_id")), *(pa.array([of[i] for i in some], kind) for of in (spans, later))], names)

    kind = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard: list[pa.RecordBatch] = []
        size, last = 0, None
        for big in batches:
            anchors = big.column(1).to_numpy(zero_copy_only=False)
            cuts = np.r_[0, np.flatnonzero(np.diff(anchors)) + 1, big.num_rows]
            for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                if size >= SHARD_WORDS and anchors[lo] != last:
                    yield search(shard)
                    shard, size = [], 0
                last = anchors[lo]
                part = big.slice(lo, hi - lo)
                shard.append(part)
                size += int(pa.compute.sum(part.column(4)).as_py())
        if shard:
            yield search(shard)

    import pyarrow.compute  # noqa: F401

    # a shard's work is far more than its bytes say: as many tasks as there are words for
    total = segments.agg(F.sum("n")).first()[0] or 0
    tasks = max(1, min(MOST_TASKS, -(-total // (TASK_SHARDS * SHARD_WORDS))))
    rows = segments.select("doc_id", "anchor", "content", "words", "n", "several").repartition(tasks, "anchor").sortWithinPartitions("anchor")
    return rows.mapInArrow(work, f"anchor long, content long, first {segments.schema['doc_id'].dataType.simpleString()}, spans {SPANS}, later {SPANS}")


def _parts(segments: DataFrame, window: int, k: int) -> DataFrame:
    """The segments cut anew by longer grams: ``doc_id, p_anchor, p_content`` (whose), ``start, n, anchor, content, words``.

    At ``k`` = ``window`` a part is a window, keyed by its own content, and goes without its words.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in tk.slices(batches, "words", 1 << 18):
            s = Segmented(b.column(3), window, k)
            w, lo, hi = s.words, s.words.start[s.a], s.words.end[s.b - 1]
            text = tk.strings(tk.gather(w.data, lo, hi), np.r_[0, np.cumsum(hi - lo)]) if k < window else pa.nulls(len(s.a), pa.string())
            take = pa.array(s.row)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i).take(take) for i in range(3)), pa.array(s.a - w.first[s.row], pa.int32()), pa.array(s.b - s.a, pa.int32()), pa.array(s.anchor.view(np.int64)), pa.array(s.content(s.a, s.b, 0x1B873593CC9E2D51).view(np.int64)), text],
                ["doc_id", "p_anchor", "p_content", "start", "n", "anchor", "content", "words"],
            )

    kind = segments.schema["doc_id"].dataType.simpleString()
    return segments.select("doc_id", "anchor", "content", "words").mapInArrow(work, f"doc_id {kind}, p_anchor long, p_content long, start int, n int, anchor long, content long, words string")


def _resolve(found: DataFrame, owner: list[str], window: int, grams: list[int]) -> DataFrame:
    """``owner`` columns and ``spans``: what of each owner's segments smaller documents have, relative to the owner.

    ``grams`` are the longer grams that anchors of too many different segments are cut by, one after the other.
    """
    key = ["anchor", "content"]
    # settled, so that the joins below have shuffles of their own and split a key that very many documents share
    firsts = settle(found.groupBy(*key).agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.min_by("start", "doc_id").alias("first_start")))
    all_of_it = F.array(F.struct(F.lit(0).alias("s"), F.col("n").alias("e"))).cast(SPANS)
    if not grams:  # a segment is a window here
        own = found.join(firsts.where("first < last").select(*key, "first"), key).where("doc_id > first").withColumn("spans", all_of_it)
    else:
        crowded = settle(firsts.groupBy("anchor").agg(F.count("*").alias("contents")).where(F.col("contents") > HOT).select("anchor"))  # few: a row for more than HOT segments
        distinct = found.join(firsts, key).where("doc_id = first and start = first_start")
        distinct = settle(distinct.select("doc_id", *key, "words", "n", (F.col("first") < F.col("last")).alias("several")).dropDuplicates(key))
        of = _shards(distinct.join(crowded, "anchor", "left_anti"), window)
        hot = distinct.join(crowded, "anchor", "left_semi")
        if not crowded.isEmpty():
            parts = settle(_parts(hot, window, grams[0]))
            within = _resolve(parts, ["doc_id", "p_anchor", "p_content"], window, grams[1:]).select(F.col("p_anchor").alias("anchor"), F.col("p_content").alias("content"), "spans")
            hot = hot.select(*key, F.col("doc_id").alias("first"), F.when(F.col("several"), all_of_it).alias("later")).join(within, key, "left")
            of = of.unionByName(hot.select(*key, "first", "spans", "later"))
        own = found.drop("words").join(settle(of), key)  # one join alone, which splits a key with very many rows
        own = own.withColumn("spans", F.when(F.col("doc_id") > F.col("first"), F.col("later")).otherwise(F.col("spans"))).where("size(spans) > 0")
    spans = own.select(*owner, F.transform("spans", lambda x: F.struct((x["s"] + F.col("start")).alias("s"), (x["e"] + F.col("start")).alias("e"))).cast(SPANS).alias("spans"))
    return spans.groupBy(*owner).agg(F.flatten(F.collect_list("spans")).alias("spans"))


def repeats(docs: DataFrame, window: int = 50) -> DataFrame:
    """``doc_id, _text_key, whole, spans`` for documents with repeats: word spans to remove, or all of it (``whole``, a
    copy). One row for each id and text that has some."""
    k = max(1, window // 3)
    docs = keyed(docs.select("doc_id", F.col("text").cast("string").alias("text")).where("doc_id is not null"))
    own = settle(_scan(docs, window, k)).where(F.col("n_words") >= window)
    digest, row = ["n_words", "d1", "d2"], ["doc_id", "_text_key"]
    own = own.join(settle(own.groupBy(*digest).agg(F.min("doc_id").alias("first"))), digest)
    copies = own.where("doc_id > first").select(row).distinct()
    marks = settle(own.where("doc_id = first").dropDuplicates(row).select(*row, F.explode(F.array_distinct("anchors")).alias("anchor")))
    shared = settle(marks.groupBy("anchor").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi").select("anchor"))
    wanted = marks.join(shared, "anchor").groupBy(row).agg(F.collect_list("anchor").alias("wanted"))
    found = settle(_segments(docs.hint("merge").join(wanted, row), window, k))
    spans = _resolve(found, row, window, sorted({max(k, 2 * window // 3), window}))
    whole = copies.select(*row, F.lit(True).alias("whole"), F.lit(None).cast(SPANS).alias("spans"))
    return whole.unionByName(spans.select(*row, F.lit(False).alias("whole"), "spans"))


def removed(docs: DataFrame, found: DataFrame, digest: bool = False) -> DataFrame:
    """``docs`` without the repeats ``found``: the columns of ``docs`` with ``n_words`` and ``n_removed`` (words before, and
    removed), where a text that loses words becomes its kept words joined by one space and others stay as they are.
    With ``digest``: ``doc_id, n_words, n_removed, kept_sha256`` only, of the kept words joined by one space.
    """
    names = [c for c in docs.columns if c not in ("text", "n_words", "n_removed")]
    rest = ["doc_id"] if digest else names
    own = [f"_c{i}" for i in range(len(rest))]  # whatever the columns are called
    rows = docs.select(*(F.col(f"`{c}`").alias(o) for c, o in zip(rest, own, strict=True)), F.col("doc_id").alias("_id"), F.col("text").cast("string").alias("text"))
    told = found.select(F.col("doc_id").alias("_id"), "_text_key", F.col("whole").alias("_whole"), F.col("spans").alias("_spans"))
    rows = keyed(rows).hint("merge").join(told, ["_id", "_text_key"], "left").select(*own, "text", "_whole", "_spans")
    out = [*rest, "n_words", "n_removed", "kept_sha256" if digest else "text"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in tk.slices(batches):
            column, whole, spans = (b.column(b.schema.get_field_index(c)) for c in ("text", "_whole", "_spans"))
            w = tk.Words(column)
            first, counts = w.first, w.counts
            cut = np.zeros(len(w) + 1, np.int32)
            size = spans.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            if size.sum():
                parts, row = spans.flatten(), np.repeat(np.arange(b.num_rows), size)
                for name, by in (("s", 1), ("e", -1)):
                    np.add.at(cut, np.minimum(first[row] + parts.field(name).to_numpy(), first[row + 1]), by)
            gone = np.cumsum(cut[:-1]) > 0
            gone |= np.repeat(whole.fill_null(False).to_numpy(zero_copy_only=False).astype(bool), counts)
            lost = np.diff(np.r_[0, np.cumsum(gone)][first])
            keep = np.flatnonzero(~gone)
            # words with a space behind, except the last of a row
            last = np.zeros(len(w), bool)
            row = w.row[keep]
            last[keep[np.flatnonzero(np.r_[row[1:] != row[:-1], len(row) > 0])]] = True  # a slice may keep no word
            size = (w.end - w.start)[keep] + ~last[keep]
            to = np.cumsum(size)
            data = np.full(to[-1] if len(to) else 0, 0x20, np.uint8)
            bare = (w.end - w.start)[keep]
            at = np.repeat((to - size) - (np.cumsum(bare) - bare), bare) + np.arange(bare.sum())
            data[at] = tk.gather(w.data, w.start[keep], w.end[keep])
            offs = np.r_[0, to][np.searchsorted(row, np.arange(b.num_rows + 1))]
            kept = [data[lo:hi] for lo, hi in zip(offs[:-1], offs[1:], strict=True)]
            if digest:
                last_column = pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string())
            else:
                last_column = pa.array([x.tobytes().decode() if n else t for x, n, t in zip(kept, lost.tolist(), column.to_pylist(), strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns[: len(rest)], pa.array(counts, pa.int64()), pa.array(lost, pa.int64()), last_column], out)

    schema = docs.select(rest).schema.add("n_words", "long").add("n_removed", "long").add(out[-1], "string")
    return rows.mapInArrow(work, schema)
