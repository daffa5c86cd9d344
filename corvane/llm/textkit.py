"""Vectorised work on whole texts: words, their hashes and shingles, over the bytes of Arrow columns.

All functions take texts as one flat byte array with row offsets, so that no Python object is made per word.
Null texts are empty ones. Work goes by slices of rows of a few MB, whatever the size of Arrow's batches; a text
longer than that is a slice of its own and is never cut.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text worked on at once; arrays of eight bytes for each byte of text are made.
SLICE_BYTES = 1 << 20
_SEED = np.random.default_rng(20240229)
#: Random values for each byte; a word's hash is a polynomial over them, modulo 2**64, then mixed.
BYTE_VALUES = _SEED.integers(0, 2**64, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_UNBASE = np.uint64(pow(int(_BASE), -1, 2**64))
_POWERS: dict[str, np.ndarray] = {}

#: White space that parts words: blank and tab, line feed, vertical tab, form feed, carriage return.
SPACED = np.ones(256, bool)
SPACED[[0x20, 9, 10, 11, 12, 13]] = False
#: Letters and digits of ASCII and all bytes of other characters.
LETTERED = np.zeros(256, bool)
LETTERED[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 256)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least ``n`` of each."""
    if not _POWERS or len(_POWERS["up"]) < n:
        n = max(n, SLICE_BYTES + 1024)
        for name, base in (("up", _BASE), ("down", _UNBASE)):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            _POWERS[name] = np.multiply.accumulate(p)
    return _POWERS["up"], _POWERS["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offs[0] : offs[-1]], offs - offs[0]


def release() -> None:
    """Give freed memory back to the system: workers outlive their tasks, and an executor's idle ones would keep it."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int | None = None) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in order, as batches whose texts have ``most`` bytes at the most, or of one row."""
    most = most or SLICE_BYTES
    for batch in batches:
        offs = flat(batch.column(batch.schema.get_field_index(column)))[1]
        at, n = 0, batch.num_rows
        while at < n:
            to = max(at + 1, int(np.searchsorted(offs, offs[at] + most, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to
    release()


class Words:
    """Words of a slice of texts, all rows together.

    ``start`` and ``end`` are byte positions in ``data``; ``first`` has for each row the index of its first word, and
    one more entry for the end; ``hash`` (on demand) is a 64-bit value of each word's bytes.
    """

    def __init__(self, column: pa.Array, letters: np.ndarray = SPACED, lower: bool = False):
        self.data, self.offs = flat(column)
        if lower:
            self.data = LOWER[self.data]
        inside = np.zeros(len(self.data) + 2, bool)
        inside[1:-1] = letters[self.data]
        before = inside[:-1].copy()  # a row's end parts words too
        before[self.offs[:-1]] = False
        start = inside[1:] & ~before
        after = inside[1:].copy()
        after[self.offs[1:]] = False
        end = inside[:-1] & ~after
        self.start, self.end = np.flatnonzero(start), np.flatnonzero(end)
        self.first = np.searchsorted(self.start, self.offs)

    def __len__(self) -> int:
        return len(self.start)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def row(self) -> np.ndarray:
        """For each word, its row."""
        return np.repeat(np.arange(len(self.offs) - 1), self.counts)

    def hash(self) -> np.ndarray:
        return span_hash(self.data, self.start, self.end)


def span_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans; equal bytes have equal hashes wherever they stand."""
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUES[data] * up[: len(data)], out=total[1:])
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the ``k`` consecutive words from each word on; the last ``k - 1`` entries are missing."""
    if len(h) < k:
        return np.zeros(0, np.uint64)
    up, down = powers(len(h) + 1)
    total = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * up[: len(h)], out=total[1:])
    return mix((total[k:] - total[:-k]) * down[: len(h) - k + 1])


def gram_rows(words: Words, k: int) -> np.ndarray:
    """Marks the entries of ``grams`` that lie in one row."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, bool)
    row = words.row
    return row[:n] == row[k - 1 :]


def gather(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The bytes (or other entries) of the spans, one after the other."""
    size = (end - start).astype(np.int64)
    to = np.cumsum(size)
    at = np.repeat(start - (to - size), size)
    at += np.arange(to[-1] if len(to) else 0)
    return data[at]


def strings(data: np.ndarray, offs: np.ndarray, kind: pa.DataType = pa.string()) -> pa.Array:
    """An Arrow column of texts (or byte strings) from flat bytes; offsets have to fit 32 bits."""
    return pa.Array.from_buffers(kind, len(offs) - 1, [None, pa.py_buffer(np.ascontiguousarray(offs, np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def lists(values: pa.Array, offs: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.ascontiguousarray(offs, np.int32)), values)
