"""Names from a dimension by one automaton, and key phrases that are relevant without repeating each other."""

from __future__ import annotations

import re
import zlib
from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Names of a dimension at the most: the automaton is made on the driver and goes to every task.
MOST_NAMES = 500_000
#: Words are runs of letters and digits; scripts without spaces, and Hangul with its particles, go by characters.
TOKEN = re.compile(r"[ᄀ-ᇿ぀-ヿ㐀-䶿一-鿿가-힯豈-﫿]|[^\W_ᄀ-ᇿ぀-ヿ㐀-䶿一-鿿가-힯豈-﫿]+")


class Automaton:
    """A trie of token sequences with failure links: all names that end at a token are known there, in one pass."""

    def __init__(self, names: list[str]):
        self.go: list[dict[str, int]] = [{}]
        self.own: list[int] = [-1]  # which name ends here
        self.depth = [0]
        for i, name in enumerate(names):
            node = 0
            for t in TOKEN.findall(name.lower()):
                if t not in self.go[node]:
                    self.go[node][t] = len(self.go)
                    self.go.append({})
                    self.own.append(-1)
                    self.depth.append(self.depth[node] + 1)
                node = self.go[node][t]
            if node and self.own[node] < 0:
                self.own[node] = i
        self.fail, self.next = [0] * len(self.go), [0] * len(self.go)  # the longest suffix; the longest suffix that is a name
        todo = deque(self.go[0].values())
        while todo:
            node = todo.popleft()
            for t, child in self.go[node].items():
                f = self.fail[node]
                while f and t not in self.go[f]:
                    f = self.fail[f]
                self.fail[child] = self.go[f].get(t, 0) if self.go[f].get(t, 0) != child else 0
                todo.append(child)
            f = self.fail[node]
            self.next[node] = f if self.own[f] >= 0 else self.next[f]

    def find(self, text: str) -> list[tuple[int, int, int]]:
        """``start, end, name``: leftmost and among these longest matches that do not overlap; places are characters."""
        go, met, at = self.go, [], []
        node = 0
        for k, m in enumerate(TOKEN.finditer(text)):
            at.append(m.span())
            t = m.group().lower()
            while node and t not in go[node]:
                node = self.fail[node]
            node = go[node].get(t, 0)
            here = node if self.own[node] >= 0 else self.next[node]
            while here:
                met.append((k - self.depth[here] + 1, -k, self.own[here]))
                here = self.next[here]
        out, end = [], -1
        for first, last, name in sorted(met):
            if first > end:
                end = -last
                out.append((at[first][0], at[end][1], name))
        return out


def names_in(docs: DataFrame, names: DataFrame, key: str = "doc_id", text: str = "text", name: str = "name", kind: str = "kind") -> DataFrame:
    """``KEY, name, kind, start, matched``: names of the dimension (``name, kind``) in texts, whole tokens without regard to case, leftmost and
    longest, none inside another. Names that are equal but for case are the first one; null texts have none. More than ``MOST_NAMES`` raise.
    """
    told = names.where(F.col(name).isNotNull()).select(name, kind).distinct().orderBy(name, kind).limit(MOST_NAMES + 1).collect()  # a checked bound
    if len(told) > MOST_NAMES:
        raise ValueError(f"over {MOST_NAMES} names: split the dimension and union the results")
    automaton, kinds, words = Automaton([r[0] for r in told]), [r[1] for r in told], [r[0] for r in told]

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(k, words[n], kinds[n], lo, t[lo:hi]) for k, t in zip(pdf["k"], pdf["t"], strict=True) if t for lo, hi, n in automaton.find(t)]
            yield pd.DataFrame(rows, columns=["k", "name", "kind", "start", "matched"])

    of = docs.schema[key].dataType.simpleString()
    found = docs.where(F.col(key).isNotNull()).select(F.col(key).alias("k"), F.col(text).alias("t")).mapInPandas(work, f"k {of}, name string, kind string, start long, matched string")
    return found.withColumnRenamed("k", key)


def trigram_vectors(phrases: list[str], size: int = 128) -> np.ndarray:
    """Unit vectors of phrases from their character trigrams: what stands for a sentence encoder where none is given."""
    out = np.zeros((len(phrases), size))
    for i, p in enumerate(phrases):
        padded = f" {p} "
        for j in range(len(padded) - 2):
            x = zlib.crc32(padded[j : j + 3].encode())
            out[i, (x >> 1) % size] += 1 - 2 * (x & 1)
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return np.divide(out, norm, out=out, where=norm > 0)


def chosen(relevance: np.ndarray, alike: np.ndarray, top: int, diversity: float) -> list[int]:
    """Greedy choice: first the most relevant, then what has the most relevance less likeness to what is chosen; the first of equals."""
    if not len(relevance):
        return []
    out = [int(np.argmax(np.round(relevance, 12)))]
    while len(out) < min(top, len(relevance)):
        score = np.round((1 - diversity) * relevance - diversity * alike[:, out].max(axis=1), 12)
        score[out] = -np.inf
        out.append(int(np.argmax(score)))
    return out


def key_phrases(candidates: DataFrame, key: str = "doc_id", top: int = 10, diversity: float = 0.5, encode: Callable[[list[str]], np.ndarray] = trigram_vectors) -> DataFrame:
    """``KEY, rank, term, relevance``: of each document's candidate phrases (``KEY, term, weight, rank``, the leading ones) the ``top`` by maximal
    marginal relevance. ``encode`` gives unit vectors; a phrase's relevance is its cosine with the candidates' weighted mean."""
    rows = candidates.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("rank", "term", "weight"))).alias("c"))  # the leading terms of a document

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            made = []
            for k, c in zip(pdf[key], pdf["c"], strict=True):
                terms = [x["term"] for x in c]
                v = encode(terms)
                mean = np.array([x["weight"] for x in c]) @ v
                size = np.linalg.norm(mean)
                relevance = v @ (mean / size if size else mean)
                made += [(k, r + 1, terms[i], float(relevance[i])) for r, i in enumerate(chosen(relevance, v @ v.T, top, diversity))]
            yield pd.DataFrame(made, columns=[key, "rank", "term", "relevance"])

    return rows.mapInPandas(work, f"{key} {candidates.schema[key].dataType.simpleString()}, rank int, term string, relevance double")
