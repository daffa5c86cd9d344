"""TF-IDF without a row for a term: documents stay in batches, and what goes through a shuffle is one hash for each different
term of a batch and, back, the number of documents that have it.

A batch keeps its documents as places in a sorted list of its words, so a pair of words is a number, and numbers are in the order of
the terms. Hashes are dealt to buckets of about ``HASHES`` by their leading bits; a bucket counts them over all batches. Batches, sorted
hashes (as differences) and counts travel compressed. Terms are told apart by hashes
of 64 bits: among n different ones the chance that any two are one is n * n / 3.7e19 (0.03 for 1e9 terms).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.tables import settle

#: Words of a batch (a document is never cut), and hashes of a bucket, on average at the most.
WORDS, HASHES = 300_000, 1 << 21


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _hashed(names: list[str]) -> np.ndarray:
    return pd.util.hash_array(np.array(names, object), categorize=False) if names else np.zeros(0, np.uint64)


def _pack(x: np.ndarray) -> bytes:
    """Numbers by the place of their bytes, so that leading zeros of all come together."""
    return pa.compress(np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.itemsize).T.tobytes(), codec="zstd", asbytes=True)


def _unpack(data: bytes, n: int, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(data, n * size, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(size, n).T).view(kind).ravel()


def _changes(column: pa.ChunkedArray) -> np.ndarray:
    """Where a value differs from the one before; nulls are equal."""
    at = column.combine_chunks().dictionary_encode(null_encoding="encode")
    at = (at.combine_chunks() if isinstance(at, pa.ChunkedArray) else at).indices.to_numpy(zero_copy_only=False)
    return np.r_[True, at[1:] != at[:-1]] if len(at) else np.zeros(0, bool)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows in order, about ``WORDS`` words at once; rows of equal keys that follow each other stay together."""
    held = None
    for b in batches:
        t = pa.Table.from_batches([b])
        held = t if held is None else pa.concat_tables([held, t])
        words = np.cumsum(np.r_[0, pc.fill_null(pc.list_value_length(held.column("words")), 0).to_numpy()])
        starts, at = np.flatnonzero(_changes(held.column("k"))), 0
        while (to := np.flatnonzero((words[starts] - words[at] >= WORDS) & (starts > at))).size:
            yield held.slice(at, starts[to[0]] - at)
            at = int(starts[to[0]])
        held = held.slice(at)
    if held is not None and held.num_rows:
        yield held


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for t in _pieces(batches):
        told = t.column("words").combine_chunks()
        flat, size = told.flatten(), pc.fill_null(pc.list_value_length(told), 0).to_numpy(zero_copy_only=False)
        coded = flat.dictionary_encode()
        order = pc.sort_indices(coded.dictionary).to_numpy()
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order), dtype=np.int32)
        seq = place[coded.indices.to_numpy(zero_copy_only=False)] if len(flat) else np.zeros(0, np.int32)
        bys = t.column("by").combine_chunks().dictionary_encode()
        ns = np.zeros(len(bys.dictionary), np.int64)
        ns[bys.indices.to_numpy()] = t.column("n").to_numpy()
        row = [t.column("k").combine_chunks(), pa.array(np.cumsum(_changes(t.column("k"))) - 1, pa.int32()), bys.indices, pa.array(size, pa.int32()), bys.dictionary, pa.array(ns), coded.dictionary.take(pa.array(order)), pa.array(seq)]
        names = ["keys", "doc", "by", "size", "bys", "ns", "words", "seq"]
        row = pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in row], names)
        with pa.BufferOutputStream() as out:
            with pa.ipc.new_stream(out, row.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                w.write_batch(row)
            packed = out.getvalue().to_pybytes()
        yield pa.RecordBatch.from_arrays([pa.array([packed], pa.binary()), pa.array([len(seq)], pa.int64())], ["packed", "n"])


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, dict]]:
    """A batch's arrays, and the columns beside them."""
    for b in batches:
        for i in range(b.num_rows):
            row = pa.ipc.open_stream(b.column("packed")[i].as_buffer()).read_next_batch()
            yield {c: row.column(c)[0].values for c in row.schema.names}, {c: b.column(c)[i].as_py() for c in b.schema.names if c != "packed"}


class Terms:
    """The terms of a batch: for each document and term of it ``doc``, ``which`` and ``tf``, and for each different term its ``code``, ``by``, ``df`` and ``hash``."""

    def __init__(self, row: dict[str, pa.Array], longest: int):
        arr = {c: row[c].to_numpy(zero_copy_only=False) for c in ("doc", "by", "size", "seq")}
        self.words, of = row["words"].to_pylist(), np.repeat(np.arange(len(arr["size"])), arr["size"])
        seq, self.step = arr["seq"].astype(np.int64), len(self.words) + 1
        code, at = seq * self.step, of
        if longest == 2:
            next_to = np.flatnonzero(of[1:] == of[:-1])
            code, at = np.r_[code, seq[next_to] * self.step + seq[next_to + 1] + 1], np.r_[of, of[next_to]]
        span = self.step * self.step
        doc, by = arr["doc"].astype(np.int64), arr["by"].astype(np.int64)
        owner, back = np.unique(doc * (by.max(initial=0) + 1) + by, return_inverse=True)  # rows of one key and vocabulary are one document
        each, self.tf = np.unique(back[at] * span + code, return_counts=True)
        owner_doc, owner_by = owner // (by.max(initial=0) + 1), owner % (by.max(initial=0) + 1)
        self.doc, term = owner_doc[each // span], owner_by[each // span] * span + each % span
        different, self.which, self.df = np.unique(term, return_inverse=True, return_counts=True)
        self.by, self.code = different // span, different % span
        words, bys = _mix(_hashed(self.words)), _mix(_hashed(row["bys"].to_pylist()))
        first, second = self.code // self.step, self.code % self.step
        after = np.where(second > 0, words[np.maximum(second - 1, 0)] * np.uint64(0x9E3779B97F4A7C15) if len(words) else np.uint64(0), np.uint64(0))
        self.hash = _mix(words[first] + after + bys[self.by] * np.uint64(0xC2B2AE3D27D4EB4F)) if len(different) else np.zeros(0, np.uint64)

    def dealt(self, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """The order of terms by hash, and their buckets, which ascend as hashes do."""
        order = np.argsort(self.hash, kind="stable")
        return order, ((self.hash[order] >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)

    def named(self, which: np.ndarray) -> list[str]:
        pairs = zip((self.code[which] // self.step).tolist(), (self.code[which] % self.step).tolist(), strict=True)
        return [self.words[i] + (" " + self.words[j - 1] if j else "") for i, j in pairs]


def _count(t: pa.Table) -> pa.Table:
    """A bucket's hashes over all batches: for each of them how many documents have it."""
    sizes = t.column("n").to_numpy()
    h = np.concatenate([np.cumsum(_unpack(x.as_py(), n, np.uint64), dtype=np.uint64) for x, n in zip(t.column("hash"), sizes.tolist(), strict=True)])
    c = np.concatenate([_unpack(x.as_py(), n, np.int32) for x, n in zip(t.column("df"), sizes.tolist(), strict=True)])
    _, which = np.unique(h, return_inverse=True)
    df = np.bincount(which, weights=c).astype(np.int64)[which]
    packed = [_pack(x) for x in np.split(df, np.cumsum(sizes)[:-1])]
    return pa.table([t.column("batch"), t.column("bucket"), t.column("n"), pa.array(packed, pa.binary())], ["batch", "bucket", "n", "df"])


def weights(docs: DataFrame, words, longest: int, least: int, most: float, top: int) -> DataFrame:
    """``k, term, weight, rank`` of ``k, by, n, text``: ``n`` is the number of documents of a vocabulary ``by``; ``words`` makes words of the text."""
    kind = docs.schema["k"].dataType
    if not docs.groupBy("k").agg(F.count("*").alias("c")).where("c > 1").isEmpty():
        docs = docs.repartition("k").sortWithinPartitions("k")  # rows of one key are one document
    coded = docs.select("k", "by", "n", words(F.col("text")).alias("words")).mapInArrow(_encode, "packed binary, n long")
    coded = settle(coded.withColumn("batch", F.monotonically_increasing_id()))
    buckets = max(1, -(-(coded.agg(F.sum("n")).first()[0] or 0) * longest // HASHES))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, more in _unpacked(batches):
            t = Terms(row, longest)
            order, bucket = t.dealt(buckets)
            own, at, n = np.unique(bucket, return_index=True, return_counts=True)
            hashes = [_pack(np.diff(x, prepend=np.uint64(0))) for x in np.split(t.hash[order], at[1:])]
            counts = [_pack(x) for x in np.split(t.df[order].astype(np.int32), at[1:])]
            if len(own):
                yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(np.full(len(own), more["batch"])), pa.array(n, pa.int64()), pa.array(hashes, pa.binary()), pa.array(counts, pa.binary())], ["bucket", "batch", "n", "hash", "df"])

    asked = coded.select("batch", "packed").mapInArrow(ask, "bucket long, batch long, n long, hash binary, df binary")
    told = asked.groupBy("bucket").applyInArrow(_count, "batch long, bucket long, n long, df binary")
    told = told.groupBy("batch").agg(F.sort_array(F.collect_list(F.struct("bucket", "n", "df"))).alias("told"))  # a batch's different terms
    told = coded.select("batch", "packed").join(told, "batch")

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, more in _unpacked(batches):
            t = Terms(row, longest)
            df = np.empty(len(t.hash), np.int64)
            df[t.dealt(buckets)[0]] = np.concatenate([_unpack(x["df"], x["n"], np.int64) for x in more["told"]])
            n = row["ns"].to_numpy()[t.by]
            idf = np.where((df >= least) & (df <= most * n), np.log((1 + n) / (1 + df)) + 1, 0.0)
            fits = np.flatnonzero(idf[t.which] > 0)
            doc, which = t.doc[fits], t.which[fits]
            w = (1 + np.log(t.tf[fits])) * idf[which]
            weight = w / np.sqrt(np.bincount(doc, weights=w * w))[doc] if len(w) else w
            order = np.lexsort((t.code[which], -np.round(weight, 9), doc))
            rank = np.arange(len(order)) - np.searchsorted(doc[order], doc[order]) + 1
            order, rank = order[rank <= top], rank[rank <= top]
            first = np.searchsorted(row["doc"].to_numpy(), np.arange(doc.max(initial=-1) + 1))  # rows are in order of documents
            yield pa.RecordBatch.from_arrays([row["keys"].take(pa.array(first[doc[order]])), pa.array(t.named(which[order]), pa.string()), pa.array(weight[order]), pa.array(rank, pa.int32())], ["k", "term", "weight", "rank"])

    return told.mapInArrow(weigh, T.StructType([T.StructField("k", kind), T.StructField("term", T.StringType()), T.StructField("weight", T.DoubleType()), T.StructField("rank", T.IntegerType())]))
