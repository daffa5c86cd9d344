"""Topics by non-negative factorisation of term weights: documents stay in their blocks, only sums over them are reduced.

With term weights of the topics given, each document's shares are a small least-squares problem of its own, solved from scratch in every
round, so nothing about documents is kept between rounds. A round reduces topics x topics and topics x terms sums; both are
bounded by the number of topics and the size of the vocabulary, and so is what goes back to the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import settle


@dataclass
class Topics:
    """``terms`` in order of index, ``h`` (topics x terms), and the loss before each round's update."""

    terms: list[str]
    h: np.ndarray
    losses: list[float]


def shares(x: np.ndarray, h: np.ndarray, passes: int = 200) -> np.ndarray:
    """Rows w >= 0 with the least squares of x - w h, by coordinate descent over all rows at once."""
    g, b = h @ h.T, x @ h.T
    w = np.zeros_like(b)
    live = np.flatnonzero(np.diag(g) > 1e-12)
    for _ in range(passes):
        moved = 0.0
        for j in live:
            new = np.maximum(0, w[:, j] + (b[:, j] - w @ g[:, j]) / g[j, j])
            moved = max(moved, float(np.abs(new - w[:, j]).max(initial=0)))
            w[:, j] = new
        if moved < 1e-10:
            break
    return w


def better(h: np.ndarray, a: np.ndarray, c: np.ndarray, passes: int = 20) -> np.ndarray:
    """Term weights with less loss, from the sums a = w'w and c = w'x."""
    h = h.copy()
    for _ in range(passes):
        for j in np.flatnonzero(np.diag(a) > 1e-12):
            h[j] = np.maximum(0, h[j] + (c[j] - a[j] @ h) / a[j, j])
    return h


def _dense(rows: pd.DataFrame, size: int) -> np.ndarray:
    x = np.zeros((len(rows), size))
    for i, (at, w) in enumerate(zip(rows["at"], rows["w"], strict=True)):
        x[i, at] = w
    return x


#: Documents that are made dense at once.
CHUNK = 500


def indexed(weights: DataFrame, key: str, vocabulary: int) -> tuple[list[str], DataFrame]:
    """The ``vocabulary`` heaviest terms, and ``KEY, at, w`` of each document: indexes and weights of its terms. Settled."""
    weights = settle(weights)  # read twice
    heavy = weights.groupBy("term").agg(F.sum("weight").alias("all")).orderBy(F.desc(F.round("all", 9)), "term").limit(vocabulary)
    heavy = settle(heavy.withColumn("i", F.row_number().over(Window.orderBy("term")) - 1).select("term", "i"))  # at most the vocabulary
    docs = weights.join(heavy, "term").groupBy(key).agg(F.sort_array(F.collect_list(F.struct("i", "weight"))).alias("x"))  # a document's leading terms
    docs = docs.select(key, F.transform("x", lambda s: s["i"]).alias("at"), F.transform("x", lambda s: s["weight"]).alias("w"))
    return [r.term for r in heavy.orderBy("i").collect()], settle(docs)


def fit(docs: DataFrame, terms: list[str], k: int = 20, rounds: int = 200, tolerance: float = 1e-4, seed: int = 42) -> Topics | None:
    """Factorise ``docs`` (``at, w``) until a round lowers the loss by less than ``tolerance`` of the first one; none with fewer than three documents."""
    size = len(terms)
    k = min(k, docs.count() - 1)
    if k < 2 or not size:
        return None
    h, losses = np.random.default_rng(seed).random((k, size)), []

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a, c, x2 = np.zeros((k, k)), np.zeros((k, size)), 0.0
        for pdf in batches:
            for lo in range(0, len(pdf), CHUNK):
                x = _dense(pdf.iloc[lo : lo + CHUNK], size)
                w = shares(x, h)
                a += w.T @ w
                c += w.T @ x
                x2 += float((x * x).sum())
        flat = np.r_[a.ravel(), c.ravel(), x2]
        at = np.flatnonzero(flat)
        yield pd.DataFrame({"at": at, "s": flat[at]})

    for _ in range(rounds):
        got = docs.select("at", "w").mapInPandas(step, "at long, s double").groupBy("at").agg(F.sum("s").alias("s")).toArrow()  # topics x (topics + terms) at the most
        flat = np.zeros(k * k + k * size + 1)
        flat[got.column("at").to_numpy()] = got.column("s").to_numpy()
        a, c, x2 = flat[: k * k].reshape(k, k), flat[k * k : -1].reshape(k, size), flat[-1]
        losses.append(float(x2 - 2 * (c * h).sum() + (a * (h @ h.T)).sum()) / 2)
        if len(losses) > 1 and losses[-2] - losses[-1] < tolerance * losses[0]:
            break
        h = better(h, a, c)
    return Topics(terms, h, losses)


def assign(docs: DataFrame, model: Topics, key: str) -> DataFrame:
    """``KEY, topic_id, weight``: each document's heaviest topic (the first of equals) and its share of the weight; -1 without any."""
    h, size = model.h, len(model.terms)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for lo in range(0, len(pdf), CHUNK):
                part = pdf.iloc[lo : lo + CHUNK]
                w = shares(_dense(part, size), h)
                total = w.sum(axis=1)
                yield pd.DataFrame({key: part[key], "topic_id": np.where(total > 0, w.argmax(axis=1), -1).astype("int32"), "weight": np.divide(w.max(axis=1), total, out=np.zeros(len(w)), where=total > 0)})

    return docs.mapInPandas(work, f"{key} {docs.schema[key].dataType.simpleString()}, topic_id int, weight double")


def leading_terms(model: Topics, top: int = 10) -> list[list[str]]:
    """The heaviest terms of each topic."""
    return [[model.terms[i] for i in np.lexsort((np.arange(len(row)), -row))[:top] if row[i] > 0] for row in model.h]


def factorised(weights: DataFrame, k: int = 20, vocabulary: int = 10_000, key: str = "doc_id", rounds: int = 200) -> DataFrame:
    """``KEY, topic_id, weight`` of documents by their term weights (``KEY, term, weight``, as ``features.tfidf`` gives them)."""
    terms, docs = indexed(weights, key, vocabulary)
    model = fit(docs, terms, k, rounds)
    if model is None:
        return docs.select(key, F.lit(-1).alias("topic_id"), F.lit(0.0).alias("weight"))
    return assign(docs, model, key)
