"""Quality scores: histogram gradient-boosted trees over document statistics.

Statistics of whole texts come from one narrow pass over their bytes. Trees are grown on binned statistics, level by
level, and then flattened into arrays (feature, threshold, two children for each node), through which all rows of a
batch step at once. Fitting takes at most about ``most_rows`` labelled documents (chosen by a hash of the id).

Cases: null and empty texts have statistics of zero and get a score like any other; without labels (or with one kind
only) every score is the share of label 1, or 0.5; labels for unknown ids, null labels and null ids teach nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkit as tk
from .langid import part
from .store import settle

#: Kinds of bytes that are counted: single marks, and classes.
MARKS = "#$%&*|!?.,;:'\"-_/\\<>(){}[]=+@~^`"
CLASSES = ["lower", "upper", "digit", "space", "newline", "control", "high", *MARKS]
FEATURES = [
    "bytes", "words", "word_mean", "word_std", "word_most", "short_words", "long_words", "distinct_words", "top_word", "distinct_pairs", "marked_words", "upper_words", "digit_words",
    "lines", "line_mean", "distinct_lines", "line_most", *(f"share_{c}" for c in CLASSES),
]


def _classes() -> np.ndarray:
    out = np.zeros(256, np.int64)
    out[:] = CLASSES.index("high")
    for i in range(128):
        c = chr(i)
        name = "lower" if c.islower() else "upper" if c.isupper() else "digit" if c.isdigit() else "newline" if c == "\n" else "space" if c.isspace() else c if c in MARKS else "control"
        out[i] = CLASSES.index(name)
    return out


def statistics(column: pa.Array) -> np.ndarray:
    """One row of ``FEATURES`` for each text."""
    w = tk.Words(column)
    n, k = len(w.offs) - 1, len(CLASSES)
    size, counts, row = np.diff(w.offs), w.counts, w.row
    kind = _classes()[w.data]
    at = np.repeat(np.arange(n), size)
    shares = np.bincount(at * k + kind, minlength=n * k).reshape(n, k)
    length = (w.end - w.start).astype(float)
    sums = lambda x: np.bincount(row, x, minlength=n)
    over = lambda x, y: np.divide(x, y, out=np.zeros(n), where=np.asarray(y) > 0)
    h = w.hash()

    def distinct(h: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Different values of each row, and how often the commonest is there."""
        _, first, seen = np.unique(tk.mix(h ^ tk.mix(row.astype(np.uint64) + np.uint64(1))), return_index=True, return_counts=True)
        most = np.zeros(n)
        np.maximum.at(most, row[first], seen)
        return np.bincount(row[first], minlength=n), most

    words, top = distinct(h, row)
    inside = tk.gram_rows(w, 2)
    pairs = tk.grams(h, 2)[inside]
    pair_row = row[: len(inside)][inside]
    pair, _ = distinct(pairs, pair_row)
    mean = over(sums(length), counts)
    deep = np.r_[0, np.cumsum(kind >= CLASSES.index(MARKS[0]))]
    high = np.r_[0, np.cumsum(kind == CLASSES.index("upper"))]
    digit = np.r_[0, np.cumsum(kind == CLASSES.index("digit"))]
    in_word = lambda c: c[w.end] - c[w.start]
    # lines
    line = np.flatnonzero(w.data == 10)
    starts = np.unique(np.r_[w.offs[:-1][size > 0], line + 1])
    starts = starts[starts < len(w.data)]
    ends = np.r_[starts[1:], len(w.data)] if len(starts) else starts
    line_row = np.searchsorted(w.offs, starts, "right") - 1
    lines = np.bincount(line_row, minlength=n)
    line_distinct, line_top = distinct(tk.span_hash(w.data, starts, ends), line_row)
    out = [
        np.log1p(size), np.log1p(counts), mean, np.sqrt(np.maximum(over(sums(length**2), counts) - mean**2, 0)), over(np.maximum.reduceat(np.r_[length, 0], np.minimum(w.first[:-1], len(length))) * (counts > 0), 1 + 0 * counts),
        over(sums(length <= 3), counts), over(sums(length >= 12), counts), over(words, counts), over(top, counts), over(pair, np.maximum(counts - 1, 0)),
        over(sums(in_word(deep) >= 2), counts), over(sums(in_word(high) >= 2), counts), over(sums(in_word(digit) >= 1), counts),
        np.log1p(lines), over(size, lines), over(line_distinct, lines), over(line_top, lines),
    ]
    return np.column_stack([*out, shares / np.maximum(size, 1)[:, None]])


@dataclass
class Trees:
    """Flattened trees: a leaf leads to itself."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        total, rows = np.full(len(x), self.base), np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                node = np.where(x[rows, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
            total += self.value[node]
        return 1 / (1 + np.exp(-np.clip(total, -50, 50)))


def grow(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.12, bins: int = 48, least: int = 8, ridge: float = 2.0) -> Trees:
    """Boost trees on the log loss; splits are chosen from histograms of the gradients."""
    share = float(np.clip(y.mean(), 0.001, 0.999)) if len(y) else 0.5
    base = float(np.log(share / (1 - share)))
    nodes: dict[str, list] = {k: [] for k in ("feature", "threshold", "left", "right", "value")}
    roots: list[int] = []

    def node(value: float) -> int:
        i = len(nodes["value"])
        for k, v in (("feature", 0), ("threshold", np.inf), ("left", i), ("right", i), ("value", value)):
            nodes[k].append(v)
        return i

    if len(np.unique(y)) == 2:
        cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
        codes = np.column_stack([np.searchsorted(c, v, "left") for c, v in zip(cuts, x.T, strict=True)])
        width, features = bins + 1, x.shape[1]
        flat = codes + np.arange(features) * width
        score = np.full(len(y), base)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-score))
            g, h = y - p, np.maximum(p * (1 - p), 1e-9)
            at = np.full(len(y), node(rate * g.sum() / (h.sum() + ridge)))  # each row's node
            roots.append(int(at[0]))
            level = [int(at[0])]
            for _ in range(depth):
                slot = np.full(len(nodes["value"]), -1)
                slot[level] = np.arange(len(level))
                rows = np.flatnonzero(slot[at] >= 0)
                where = slot[at[rows]]
                cell = (flat[rows] + (where * features * width)[:, None]).ravel()
                sums = [np.bincount(cell, np.repeat(v[rows], features), minlength=len(level) * features * width).reshape(len(level), features, width).cumsum(axis=2) for v in (g, h, np.ones(len(y)))]
                (gl, hl, nl), (gt, ht, nt) = sums, (s[:, :, -1:] for s in sums)
                gr, hr = gt - gl, ht - hl
                gain = gl**2 / (hl + ridge) + gr**2 / (hr + ridge) - gt**2 / (ht + ridge)
                gain[(nl < least) | (nt - nl < least)] = -1
                split = {}
                for i, (top, best) in enumerate(zip(level, gain.reshape(len(level), -1).argmax(axis=1).tolist(), strict=True)):
                    f, b = divmod(best, width)
                    if gain[i, f, b] > 1e-6 and b < len(cuts[f]):
                        kids = [node(rate * float(gs[i, f, b]) / (float(hs[i, f, b]) + ridge)) for gs, hs in ((gl, hl), (gr, hr))]
                        nodes["feature"][top], nodes["threshold"][top], nodes["left"][top], nodes["right"][top] = f, float(cuts[f][b]), *kids
                        split[top] = (f, b, kids)
                for top, (f, b, kids) in split.items():
                    here = rows[at[rows] == top]
                    at[here] = np.where(codes[here, f] <= b, *kids)
                level = [k for _, _, kids in split.values() for k in kids]
                if not level:
                    break
            score += np.array(nodes["value"])[at]
    return Trees(base, *(np.array(nodes[k]) for k in ("feature", "threshold", "left", "right", "value")), np.array(roots, np.int64), depth)


def features(docs: DataFrame) -> DataFrame:
    """``doc_id, x``: the statistics of each text as an array of ``FEATURES``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in tk.slices(batches):
            x = statistics(b.column(1)).astype(np.float32)
            yield pa.RecordBatch.from_arrays([b.column(0), tk.lists(pa.array(x.ravel()), np.arange(b.num_rows + 1) * x.shape[1])], ["doc_id", "x"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(work, f"doc_id {kind}, x array<float>")


def fit(stats: DataFrame, labels: DataFrame, label: str = "quality", most_rows: int = 40_000) -> Trees:
    """Grow trees from the statistics of the documents in ``labels`` (``doc_id``, ``label``)."""
    labels = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", (F.col(label) >= 1).alias("y"))
    n = labels.count()
    if n > most_rows:
        labels = labels.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(most_rows / n * (1 << 30)))
    rows = stats.join(labels, "doc_id").orderBy("doc_id").select("x", F.col("y").cast("double")).toArrow()
    if not rows.num_rows:
        return grow(np.zeros((0, len(FEATURES))), np.zeros(0))
    x = rows.column(0).combine_chunks().flatten().to_numpy().reshape(rows.num_rows, -1).astype(float)
    return grow(x, rows.column(1).to_numpy())


def score(stats: DataFrame, trees: Trees, cut: float = 0.3) -> DataFrame:
    """``doc_id, score, predicted`` (1 from ``cut`` on)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = trees.score(b.column(1).flatten().to_numpy().reshape(b.num_rows, -1).astype(float))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.float64()), pa.array((s >= cut).astype(np.int32))], ["doc_id", "score", "predicted"])

    kind = stats.schema["doc_id"].dataType.simpleString()
    return stats.mapInArrow(work, f"doc_id {kind}, score double, predicted int")


def quality_query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted``: learns from the labels whose part of 5 is not 0."""
    held = F.coalesce(part(5) == 0, F.lit(False))
    stats = settle(features(docs))
    return score(stats, fit(stats, labels.where(~held))).select("doc_id", held.alias("held_out"), "score", "predicted")
