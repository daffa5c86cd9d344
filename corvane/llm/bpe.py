"""Byte-level BPE encoding and decoding by batched numpy merge rounds.

A slice of texts is parted into pretokens by character classes, equal pretokens are encoded once, and all new ones of a
slice are merged together: their symbols stand in one flat array, and each round looks up the adjacent pairs by binary
search in the sorted pair keys, then merges the lowest-ranked pair of every word. Results equal the ``tokenizers``
library's for files with a byte-level pre-tokenizer, no normaliser and a BPE model.

Cases: null and empty texts have no tokens and decode to the empty text; the text of an added token becomes that token
wherever it stands; texts of any length are encoded whole; further columns of the input are passed on by the caller.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textkit as tk

LETTER, NUMBER, SPACE, OTHER = 0, 1, 2, 3
#: What may follow an apostrophe as one pretoken.
CONTRACTED = ("s", "t", "re", "ve", "m", "ll", "d")
#: Pretokens that a Python worker remembers; beyond it starts anew.
REMEMBERED = 400_000


@lru_cache(1)
def char_classes() -> np.ndarray:
    """The class of every code point, as the Unicode properties of the pattern say."""
    import regex

    out = np.full(0x110000, OTHER, np.uint8)
    every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for m in regex.finditer(pattern, every):
            lo, hi = ord(m[0][0]), ord(m[0][-1])
            if hi - lo == len(m[0]) - 1:
                out[lo : hi + 1] = kind
            else:
                out[[ord(c) for c in m[0]]] = kind
    return out


def byte_chars() -> dict[str, int]:
    """The printable character that stands for each byte in vocabulary files, and its byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Codec:
    """A vocabulary file, ready for arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or pre["type"] != "ByteLevel" or pre.get("add_prefix_space") or spec.get("normalizer") or model.get("ignore_merges"):
            raise ValueError("not a plain byte-level BPE file")
        vocab, chars = model["vocab"], byte_chars()
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens") or ()}
        size = max([*vocab.values(), *self.added.values()]) + 1
        pieces: list[bytes] = [b""] * size
        for token, i in vocab.items():
            pieces[i] = bytes(chars[c] for c in token) if all(c in chars for c in token) else token.encode()
        for token, i in self.added.items():
            pieces[i] = token.encode()
        self.of_byte = np.zeros(256, np.int64)
        for c, b in chars.items():
            self.of_byte[b] = vocab[c]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([(vocab[a] << 32) | vocab[b] for a, b in merges], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank = keys[order], order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int64)
        self.piece_bytes = np.frombuffer(b"".join(pieces), np.uint8)
        self.piece_at = np.concatenate([[0], np.cumsum([len(p) for p in pieces])]).astype(np.int64)
        said = [b"%d," % i for i in range(size)]
        self.said_bytes = np.frombuffer(b"".join(said), np.uint8)
        self.said_at = np.concatenate([[0], np.cumsum([len(p) for p in said])]).astype(np.int64)
        self.special = re.compile("|".join(re.escape(t) for t in sorted(self.added, key=len, reverse=True))) if self.added else None
        self.forget()

    def forget(self) -> None:
        """Start anew with what is remembered of earlier pretokens: sorted hashes, and where each one's ids stand."""
        self.known, self.known_at = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.known_n, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int32)

    def merge(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge the symbols (flat, ``word`` says whose) until no pair of any word is in the table."""
        done_s, done_w = [], []
        while len(symbols):
            pair = (symbols[:-1] << 32) | symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
            rank = np.where((self.keys[at] == pair) & (word[:-1] == word[1:]), self.rank[at], len(self.keys))
            rank = np.append(rank, len(self.keys))
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            sizes = np.diff(np.r_[first, len(word)])
            least = np.minimum.reduceat(rank, first)
            open_ = least < len(self.keys)
            if not open_.all():
                keep = np.repeat(open_, sizes)
                done_s.append(symbols[~keep])
                done_w.append(word[~keep])
                symbols, word, rank, least, sizes = symbols[keep], word[keep], rank[keep], least[open_], sizes[open_]
                if not len(symbols):
                    break
            hit = rank == np.repeat(least, sizes)
            # of overlapping hits (a a a) those at an even distance from the run's start merge
            at = np.arange(len(hit))
            run = np.maximum.accumulate(np.where(hit & ~np.r_[False, hit[:-1]], at, 0))
            hit &= (at - run) % 2 == 0
            symbols = symbols.copy()
            symbols[hit] = self.merged[rank[hit]]
            left = np.r_[True, ~hit[:-1]]
            symbols, word = symbols[left], word[left]
        s, w = np.concatenate([*done_s, symbols]), np.concatenate([*done_w, word])
        order = np.argsort(w, kind="stable")
        return s[order], w[order]

    def learn(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, h: np.ndarray) -> None:
        """Encode the given spans (different ones, sorted by hash) and remember them."""
        symbols = self.of_byte[tk.gather(data, start, end)]
        word = np.repeat(np.arange(len(start)), end - start)
        ids, word = self.merge(symbols, word)
        n = np.bincount(word, minlength=len(start)).astype(np.int64)
        at = len(self.ids) + np.cumsum(n) - n
        self.ids = np.concatenate([self.ids, ids.astype(np.int32)])
        to = np.searchsorted(self.known, h)
        self.known, self.known_at, self.known_n = np.insert(self.known, to, h), np.insert(self.known_at, to, at), np.insert(self.known_n, to, n)

    def pretokens(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Byte starts and ends of the pretokens; ``offs`` are the bounds of separate texts."""
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        if not len(points):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        byte_at = np.flatnonzero((data & 0xC0) != 0x80)
        kind = char_classes()[points]
        begin = np.zeros(len(points) + 1, bool)
        begin[np.searchsorted(byte_at, offs)] = True  # texts start here
        begin = begin[:-1]
        last = np.r_[begin[1:], True]  # texts end here
        new = begin | np.r_[True, kind[1:] != kind[:-1]]
        space = kind == SPACE
        follows = ~last & np.r_[~space[1:], False]  # a character that isn't space comes next in the text
        # the last space before something else stands alone, or leads what follows if it is a blank
        new |= space & follows
        lead = space & follows & (points == 0x20)
        new[1:][lead[:-1]] = False
        # an apostrophe that starts a pretoken takes its contracted letters
        mark = np.flatnonzero((points == 0x27) & new & ~last)
        for tail in sorted(CONTRACTED, key=len):
            fits = mark + len(tail) < len(points)
            for j, c in enumerate(tail, 1):
                at = np.minimum(mark + j, len(points) - 1)
                fits &= (points[at] == ord(c)) & ~begin[at]
            at = mark[fits]
            new[at + 1] = False
            if len(tail) == 2:
                new[at + 2] = False
            to = at + 1 + len(tail)
            new[to[to < len(points)]] = True
        start = byte_at[np.flatnonzero(new)]
        return start, np.r_[start[1:], len(data)]

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, flat, and where each text's ids start (and the last end)."""
        data, offs = tk.flat(column)
        cuts, tokens = self._added(data, offs)
        if len(cuts):  # the bounds of added tokens are bounds of texts, and what stands between is no text
            start, end = self.pretokens(data, np.unique(np.concatenate([offs, cuts.ravel()])))
            inside = np.searchsorted(cuts[:, 0], start, "right") - 1
            plain = (inside < 0) | (start >= cuts[np.maximum(inside, 0), 1])
            start, end = start[plain], end[plain]
        else:
            start, end = self.pretokens(data, offs)
        h = tk.span_hash(data, start, end)
        if len(self.known) > REMEMBERED:
            self.forget()
        once, first, back = np.unique(h, return_index=True, return_inverse=True)  # sorted keys are found faster
        at = np.searchsorted(self.known, once)
        new = np.ones(len(once), bool)
        if len(self.known):
            new = self.known[np.minimum(at, len(self.known) - 1)] != once
        if new.any():
            self.learn(data, start[first[new]], end[first[new]], once[new])
            at = np.searchsorted(self.known, once)
        at = at[back]
        n, of = self.known_n[at], self.known_at[at]
        if len(cuts):
            start, n, of = np.r_[start, cuts[:, 0]], np.r_[n, np.ones(len(cuts), np.int64)], np.r_[of, len(self.ids) + np.arange(len(cuts))]
            order = np.argsort(start, kind="stable")
            start, n, of = start[order], n[order], of[order]
            ids = tk.gather(np.concatenate([self.ids, tokens]), of, of + n)
        else:
            ids = tk.gather(self.ids, of, of + n)
        total = np.r_[0, np.cumsum(n)]
        return ids, total[np.searchsorted(start, offs)]

    def _added(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cuts, ids = [], []
        if self.special:
            raw = data.tobytes()
            if any(t.encode() in raw for t in self.added):
                for lo, hi in zip(offs[:-1], offs[1:], strict=True):
                    text = raw[lo:hi]
                    if any(t.encode() in text for t in self.added):
                        for m in re.compile(self.special.pattern.encode()).finditer(text):
                            cuts.append((lo + m.start(), lo + m.end()))
                            ids.append(self.added[m[0].decode()])
        return np.array(cuts, np.int64).reshape(-1, 2), np.array(ids, np.int32)

    def decode(self, ids: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of the tokens, flat, and where each text starts: before invalid UTF-8 is replaced."""
        data = tk.gather(self.piece_bytes, self.piece_at[ids], self.piece_at[ids + 1])
        total = np.r_[0, np.cumsum(self.piece_at[ids + 1] - self.piece_at[ids])]
        return data, total[offs]


@lru_cache(4)
def codec(path: str) -> Codec:
    return Codec(path)


def encode(docs: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids`` (array of int): the tokens of each text. Columns of that name are replaced."""
    docs = docs.drop("ids")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(vocabulary)
        for b in tk.slices(batches, text):
            ids, offs = c.encode(b.column(b.schema.get_field_index(text)))
            yield pa.RecordBatch.from_arrays([*b.columns, tk.lists(pa.array(ids.astype(np.int32)), offs)], [*b.schema.names, "ids"])

    schema = docs.select("*").schema.add("ids", T.ArrayType(T.IntegerType()))
    return docs.mapInArrow(work, schema)


def decode(encoded: DataFrame, vocabulary: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its tokens; a null array is empty, invalid UTF-8 becomes U+FFFD."""
    encoded = encoded.drop(out)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(vocabulary)
        for big in batches:
            for i in range(0, big.num_rows, 256):
                b = big.slice(i, 256)
                rows = b.column(b.schema.get_field_index(ids)).fill_null([])
                data, offs = c.decode(rows.flatten().to_numpy(zero_copy_only=False), np.r_[0, np.cumsum(rows.value_lengths().to_numpy(zero_copy_only=False))])
                texts = [data[lo:hi].tobytes().decode("utf-8", "replace") for lo, hi in zip(offs[:-1], offs[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], [*b.schema.names, out])

    return encoded.mapInArrow(work, encoded.select("*").schema.add(out, "string"))


def digest(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: encodes and decodes in one pass, without moving ids or texts.

    A narrow pass over ``doc_id`` and ``text``; any number of rows, nothing is shuffled.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(vocabulary)
        for b in tk.slices(batches):
            ids, offs = c.encode(b.column(1))
            said = tk.gather(c.said_bytes, c.said_at[ids], c.said_at[ids + 1])
            said_at = np.r_[0, np.cumsum(c.said_at[ids + 1] - c.said_at[ids])][offs]
            back, back_at = c.decode(ids, offs)
            sums, texts = [], []
            for r in range(b.num_rows):
                sums.append(hashlib.sha256(said[said_at[r] : max(said_at[r], said_at[r + 1] - 1)]).hexdigest())
                text = back[back_at[r] : back_at[r + 1]].tobytes().decode("utf-8", "replace")
                texts.append(hashlib.sha256(text.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.diff(offs), pa.int64()), pa.array(sums, pa.string()), pa.array(texts, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(work, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
