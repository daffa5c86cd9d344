"""Language identification: known words by their per-language log frequency, unseen ones by shorter and shorter n-grams.

A word is a run of letters, in lower case. A word of the model adds its log frequency for each language; another one
backs off to its 5-grams (word ends count as characters), and if the model has none of them to 4-grams, and so on down
to single letters; the mean over its n-grams stands for the word. The language with the largest sum wins.

Fitting takes at most about ``most_texts`` different labelled texts of each language (chosen by a hash of the text, all
of them if there are fewer), so that neither a common language nor a text with very many copies crowds out a rare one;
the model has every word and n-gram of that sample. Counts are a distributed aggregate. Scoring is one narrow pass.

Cases: null texts and texts without a letter are ``und`` with score 0; without any labelled document everything is
``und``; ties go to the language that sorts first; further columns are passed on, those of the result's names replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkit as tk
from .bpe import LETTER, char_classes

LONGEST = 5
#: Stand for a word's begin and end in n-grams.
BEGIN, END = 2, 3
#: A word's or n-gram's least frequency: this over the largest language's number of them.
SMOOTH = 0.1


class LetterWords:
    """Distinct words of a slice of texts; ``of`` and ``row`` give each occurrence."""

    def __init__(self, column: pa.Array):
        texts = [(t or "").lower() for t in column.to_pylist()]
        sizes = np.array([len(t) for t in texts], np.int64)
        points = np.frombuffer("".join(texts).encode("utf-32-le", "replace"), np.uint32)
        offs = np.r_[0, np.cumsum(sizes)]
        letter = np.zeros(len(points) + 2, bool)
        letter[1:-1] = char_classes()[points] == LETTER
        before = letter[:-1].copy()
        before[offs[:-1]] = False
        after = letter[1:].copy()
        after[offs[1:]] = False
        start, end = np.flatnonzero(letter[1:] & ~before), np.flatnonzero(letter[:-1] & ~after)
        self.row = np.searchsorted(offs, start, "right") - 1
        up, down = tk.powers(len(points) + 1)
        total = np.r_[np.zeros(1, np.uint64), np.cumsum(tk.mix(points.astype(np.uint64)) * up[: len(points)])]
        h = tk.mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))
        self.hash, once, self.of = np.unique(h, return_index=True, return_inverse=True)
        self.points, self.start, self.end = points, start[once], end[once]
        self.rows = len(texts)

    def grams(self, which: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For n from long to short: n, hashes of the n-grams of the chosen words, and to which of them each belongs.

        The caller sends back what words are still open, as marks.
        """
        size = (self.end - self.start)[which] + 2
        first = np.cumsum(size) - size
        marked = np.full(size.sum(), BEGIN, np.uint64)
        marked[first + size - 1] = END
        inner = np.ones(len(marked), bool)
        inner[first] = inner[first + size - 1] = False
        marked[inner] = tk.gather(self.points, self.start[which], self.end[which])
        word, left = np.repeat(np.arange(len(which)), size), np.repeat(size, size) - (np.arange(len(marked)) - np.repeat(first, size))
        marked, acc = tk.mix(marked), {}
        h = np.zeros(len(marked), np.uint64)
        for n in range(1, LONGEST + 1):
            nxt = np.zeros(len(marked), np.uint64)
            nxt[: max(0, len(marked) - n + 1)] = marked[n - 1 :]
            h = tk.mix(h * np.uint64(0x100000001B3) + nxt + np.uint64(n))
            acc[n] = h
        for n in range(LONGEST, 0, -1):
            fits = left >= n if n > 1 else inner
            yield n, acc[n][fits], word[fits]


@dataclass
class Model:
    languages: list[str]
    words: np.ndarray  # sorted hashes
    word_logs: np.ndarray  # their log frequency in each language
    grams: np.ndarray
    gram_logs: np.ndarray

    def word_scores(self, w: LetterWords) -> np.ndarray:
        """The log frequencies of each distinct word of ``w``."""
        out = np.zeros((len(w.hash), len(self.languages)))
        at, known = find(self.words, w.hash)
        out[known] = self.word_logs[at[known]]
        open_ = np.flatnonzero(~known)
        if len(open_) and len(self.grams):
            left = np.ones(len(open_), bool)
            for _, h, word in w.grams(open_):
                use = left[word]
                h, word = h[use], word[use]
                at, hit = find(self.grams, h)
                word, at = word[hit], at[hit]
                n = np.bincount(word, minlength=len(open_))
                got = n > 0
                for i in range(len(self.languages)):
                    sums = np.bincount(word, self.gram_logs[at, i], minlength=len(open_))
                    out[open_[got], i] = sums[got] / n[got]
                left &= ~got
                if not left.any():
                    break
        return out

    def predict(self, column: pa.Array) -> tuple[list[str], np.ndarray]:
        w = LetterWords(column)
        if not self.languages:
            return ["und"] * w.rows, np.zeros(w.rows)
        scores = self.word_scores(w)
        total = np.stack([np.bincount(w.row, scores[w.of, i], minlength=w.rows) for i in range(len(self.languages))], axis=1)
        some = np.bincount(w.row, minlength=w.rows) > 0
        best = total.argmax(axis=1)
        score = 1 / np.exp(np.maximum(total - total.max(axis=1, keepdims=True), -700)).sum(axis=1)
        return [self.languages[i] if s else "und" for i, s in zip(best.tolist(), some.tolist(), strict=True)], np.where(some, score, 0.0)


def find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(table):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys


def sample(docs: DataFrame, most_texts: int) -> DataFrame:
    """``text, lang``: about ``most_texts`` different texts of each language at the most; one row a text and language."""
    docs = docs.withColumn("h", F.xxhash64("text"))
    sizes = docs.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).collect()  # one row a language
    full = 1 << 30
    shares = [F.when(F.col("lang") == r.lang, F.lit(int(most_texts / r.n * full))) for r in sizes if r.n > most_texts]
    return docs.where(F.pmod("h", F.lit(full)) < F.coalesce(*shares, F.lit(full))).dropDuplicates(["lang", "h"]).select("text", "lang")


def fit(docs: DataFrame, most_texts: int = 2_000, text: str = "text", lang: str = "lang") -> Model:
    """Learn from the rows of ``docs`` whose text and language are not null."""
    docs = sample(docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang")), most_texts)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in tk.slices(batches):
            w = LetterWords(b.column(0))
            langs = b.column(1).dictionary_encode()
            codes, names = langs.indices.to_numpy(), langs.dictionary
            kinds, hashes, rows, counts = [], [], [], []
            for i in range(len(names)):
                seen = np.bincount(w.of, codes[w.row] == i, minlength=len(w.hash)).astype(np.int64)
                here = np.flatnonzero(seen)
                if not len(here):
                    continue
                parts = [(0, w.hash[here], seen[here])]
                for n_, h, word in w.grams(here):
                    u, back = np.unique(h, return_inverse=True)
                    parts.append((n_, u, np.bincount(back, seen[here][word]).astype(np.int64)))
                for kind, h, c in parts:
                    kinds.append(np.full(len(h), min(kind, 1), np.int32))
                    hashes.append(h.view(np.int64))
                    counts.append(c)
                    rows.append(np.full(len(h), i))
            if kinds:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(kinds)), pa.array(np.concatenate(hashes)), names.take(pa.array(np.concatenate(rows))), pa.array(np.concatenate(counts))], ["kind", "h", "lang", "n"])

    each = docs.mapInArrow(work, "kind int, h long, lang string, n long").groupBy("kind", "h", "lang").agg(F.sum("n").alias("n")).toArrow()
    each = each.set_column(2, "lang", each.column("lang").combine_chunks().dictionary_encode())
    at = each.column("lang").combine_chunks()
    names = at.dictionary.to_pylist()
    order = np.argsort(np.array(names, object), kind="stable")
    place = np.empty(len(names), np.int64)
    place[order] = np.arange(len(names))
    which, kinds, hashes, counts = place[at.indices.to_numpy()], each.column("kind").to_numpy(), each.column("h").to_numpy().view(np.uint64), each.column("n").to_numpy()
    out = []
    for kind in (0, 1):
        here = kinds == kind
        h, row = np.unique(hashes[here], return_inverse=True)
        logs = np.zeros((len(h), len(names)), np.float32)
        logs[row, which[here]] = counts[here]
        total = np.bincount(which[here], counts[here], minlength=len(names))
        logs /= np.maximum(total, 1).astype(np.float32)
        logs += np.float32(SMOOTH / max(1, total.max(initial=0)))  # what is unseen weighs the same in a rare language as in a common one
        out += [h, np.log(logs, out=logs)]
    return Model([names[i] for i in order], *out)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (the probability of that language, 0 to 1)."""
    names = [c for c in docs.columns if c not in ("lang_pred", "score")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in tk.slices(batches):
            langs, scores = model.predict(b.column(b.schema.get_field_index("text")))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], [*names, "lang_pred", "score"])

    docs = docs.select(names).withColumn("text", F.col("text").cast("string"))
    return docs.mapInArrow(work, docs.select("*").schema.add("lang_pred", "string").add("score", "double"))


def part(modulus: int) -> F.Column:
    """A document's part by the checksum of its id."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(modulus))


def language_query(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score``: learns from all documents but those whose part of 4 is 2."""
    held = F.coalesce(part(4) == 2, F.lit(False))
    model = fit(docs.where(~held))
    return identify(docs.select("doc_id", "text"), model).select("doc_id", held.alias("held_out"), "lang_pred", "score")
