"""Topics of texts by online variational Bayes, with a model that is a table.

A row of the model is a term with its weight in each topic; the driver has sums over all terms only. Documents go in blocks; each
block meets the rows of its own terms, so that neither tasks nor driver hold a vocabulary. The start of a term comes from its hash and is made
where it is needed. Terms are told apart by 64-bit hashes. Of a round only a row for each of
its terms stays on disk, and only until later ones are added to it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import drop, settle

#: Documents in a block, at most about, and in a batch of few blocks; tables of sums that are kept apart before they are added up; batches that
#: meet the whole model at once.
SIZE, FEW, APART, TOGETHER = 2000, 250, 4, 4
# How fast a round's weight falls, as Spark's online optimiser has it.
TAU, KAPPA = 1024, 0.51


_SIX = np.arange(6.0)


def digamma(x: np.ndarray) -> np.ndarray:
    x = np.asarray(x, float)
    early, x = (1 / (x[..., None] + _SIX)).sum(-1), x + 6
    y = 1 / (x * x)
    return np.log(x) - 0.5 / x - y * (1 / 12 - y * (1 / 120 - y * (1 / 252 - y * (1 / 240 - y / 132)))) - early


def trigamma(x: np.ndarray) -> np.ndarray:
    x, out = np.array(x, float), np.zeros(np.shape(x))
    for _ in range(6):
        out, x = out + 1 / (x * x), x + 1
    y = 1 / (x * x)
    return out + 1 / x + y / 2 + y / x * (1 / 6 - y * (1 / 30 - y * (1 / 42 - y / 30)))


def _even(x: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) from the bits of others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(float) / (1 << 53) + 2.0**-54


def start(ids: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Terms x topics, spread like a gamma of shape 100 and mean 1."""
    x = ids.view(np.uint64)[:, None] + np.arange(1, k + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed * 0xC2B2AE3D27D4EB4F & 0xFFFFFFFFFFFFFFFF)
    z = np.sqrt(-2 * np.log(_even(x))) * np.cos(2 * np.pi * _even(x ^ np.uint64(0x5851F42D4C957F2D)))
    return (1 - 1 / 900 + z / 30) ** 3


def infer(counts: np.ndarray, beta: np.ndarray, alpha: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A document's topic weights, and topics' shares of its terms before they are multiplied by ``beta`` (its terms x topics).

    Steps are repeated until they move weights by less than 0.001 in the mean; after every two of them one leaps along the way that they
    take (squared extrapolation), which gets to the same place in a fraction of the steps."""

    def step(gamma: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        told = digamma(np.append(gamma, gamma.sum()))
        theta = np.exp(told[:-1] - told[-1])
        part = counts / (beta @ theta + 1e-100)
        return theta * (part @ beta) + alpha, theta, part

    gamma = np.ones(len(alpha))
    while True:
        one, *_ = step(gamma)
        two, theta, part = step(one)
        if np.abs(two - one).mean() <= 1e-3:
            return two, part[:, None] * theta
        moved, bent = one - gamma, two - 2 * one + gamma
        leap = np.sqrt((moved @ moved) / max(bent @ bent, 1e-300))
        far = gamma + 2 * leap * moved + leap * leap * bent
        gamma = far if leap > 1 and (far >= alpha).all() else two


def _kept(df: DataFrame) -> DataFrame:
    """``df`` settled; what it shuffled is of no use after that and goes from the executors' disks."""
    conf, name = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(name)
    conf.set(name, "true")
    try:
        return settle(df)
    finally:
        conf.set(name, before)


def counted(docs: DataFrame, words: Column, key: str, rounds: int, seed: int) -> DataFrame:
    """``KEY, batch, block, ids, counts``: the terms of each document as hashes. Every document is in one batch, each batch in blocks. Settled."""
    kind = docs.schema[key].dataType.simpleString()
    each = docs.count() / rounds
    blocks = max(1, math.ceil(each / SIZE), min(16, math.ceil(each / FEW)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat, ends = b.column("h").flatten().to_numpy(), np.cumsum([0, *(len(x) if x else 0 for x in b.column("h").to_pylist())])
            told = [np.unique(flat[lo:hi], return_counts=True) for lo, hi in zip(ends[:-1], ends[1:], strict=True)]
            at = pa.array(np.cumsum([0, *(len(x) for x, _ in told)]), pa.int32())
            ids, n = (np.concatenate([t[c] for t in told] or [flat]) for c in (0, 1))
            lists = [pa.ListArray.from_arrays(at, pa.array(ids, pa.int64())), pa.ListArray.from_arrays(at, pa.array(n.astype(np.int32)))]
            yield pa.RecordBatch.from_arrays([b.column(key), b.column("batch"), b.column("block"), *lists], [key, "batch", "block", "ids", "counts"])

    place = F.xxhash64(F.col(key), F.lit(seed))
    batch = F.pmod(place, F.lit(rounds)).cast("int")
    rows = docs.select(key, batch.alias("batch"), (batch * blocks + F.pmod(F.shiftright(place, 20), F.lit(blocks))).cast("long").alias("block"), F.transform(words, lambda w: F.xxhash64(w)).alias("h"))
    return _kept(rows.mapInArrow(work, f"{key} {kind}, batch int, block long, ids array<bigint>, counts array<int>").repartitionByRange("batch", "block").sortWithinPartitions("batch"))


def topics(docs: DataFrame, words: Column, k: int, key: str, least: int = 2, most: float = 0.95, rounds: int = 20, seed: int = 42) -> DataFrame:
    """``KEY, topic_id``: each document's likeliest topic (the first of equals; 0 without terms) by all terms of ``least`` documents or more and a share of at most ``most``."""
    kind, names = docs.schema[key].dataType.simpleString(), [f"s{i}" for i in range(k)]
    d = counted(docs, words, key, rounds, seed)
    n = d.count()
    vocabulary = _kept(d.select(F.explode("ids").alias("id")).groupBy("id").agg(F.count("*").alias("df")).where((F.col("df") >= least) & (F.col("df") <= most * n)).select("id"))

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x = start(b.column(0).to_numpy(), k, seed).sum(0)
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), *(pa.array([v]) for v in x)], ["c", *names])

    numbers = ", ".join(f"{c} double" for c in names)
    size, *first = vocabulary.mapInArrow(begin, f"c long, {numbers}").agg(F.sum("c"), *(F.sum(c) for c in names)).first()
    if not size:
        return docs.select(key, F.lit(0).alias("topic_id"))
    first, added, alpha, sums, tables = np.array(first), np.zeros(k), np.full(k, 1 / k), [], []
    kept, even = 1.0, 0.0  # weights of the start and, alike in all terms, of the prior

    def met(part: DataFrame):
        """Blocks of documents and the rows of their terms."""
        terms = part.select(F.col("block").alias("of"), F.explode("ids").alias("id")).distinct().join(vocabulary, "id")
        if sums:
            terms = terms.join(added_up(), "id", "left")
        else:
            terms = terms.select("*", *(F.lit(None).cast("double").alias(c) for c in names))
        return part.groupBy("block").cogroup(terms.groupBy("of"))

    def added_up() -> DataFrame:
        out = sums[0]
        for s in sums[1:]:
            out = out.unionByName(s)
        return out.groupBy("id").agg(*(F.sum(c).alias(c) for c in names)) if len(sums) > 1 else out

    def each(kept: float, even: float, total: np.ndarray, alpha: np.ndarray, docs: pa.Table, model: pa.Table):
        """What ``infer`` tells for each document of a block, with its terms' places in the sorted ids."""
        ids = model.column("id").to_numpy()
        order = np.argsort(ids)
        ids = ids[order]
        own = np.column_stack([np.nan_to_num(model.column(c).to_numpy()) for c in names])[order] if len(ids) else np.zeros((0, k))
        beta = np.exp(digamma(kept * (start(ids, k, seed) + own) + even) - digamma(total)) if len(ids) else own
        for terms, counts in zip(docs.column("ids").to_pylist(), docs.column("counts").to_pylist(), strict=True):
            terms, counts = np.array(terms, np.int64), np.array(counts, float)
            at = np.searchsorted(ids, terms)
            there = (ids[np.minimum(at, len(ids) - 1)] == terms) if len(ids) else np.zeros(len(terms), bool)
            at, counts = at[there], counts[there]
            yield (at, beta, ids, *infer(counts, beta[at], alpha)) if len(at) else None

    def learn(*model):
        def work(docs: pa.Table, rows: pa.Table) -> pa.Table:
            found, log, seen = np.zeros((rows.num_rows, k)), np.zeros(k), 0
            ids = beta = None
            for told in each(*model, docs, rows):
                if told:
                    at, beta, ids, gamma, share = told
                    found[at] += share
                    log, seen = log + digamma(gamma) - digamma(gamma.sum()), seen + 1
            if ids is None:
                ids, beta = np.zeros(0, np.int64), found[:0]
            found = np.vstack([found[: len(ids)] * beta, log])
            return pa.table([pa.array([*ids.tolist(), None], pa.int64()), pa.array([0] * len(ids) + [seen], pa.int64()), *(pa.array(c) for c in found.T.copy())], ["id", "seen", *names])

        return work

    def assign(*model):
        def work(docs: pa.Table, rows: pa.Table) -> pa.Table:
            return pa.table([docs.column(key), pa.array([int(told[3].argmax()) if told else 0 for told in each(*model, docs, rows)], pa.int32())], [key, "topic_id"])

        return work

    total = lambda: kept * (first + added) + size * even
    for t in range(rounds):
        # a row a term, not one for each of its blocks
        found = met(d.where(F.col("batch") == t)).applyInArrow(learn(kept, even, total(), alpha), f"id long, seen long, {numbers}")
        found = _kept(found.groupBy("id").agg(F.sum("seen").alias("seen"), *(F.sum(c).alias(c) for c in names)))
        rho = (TAU + t + 1) ** -KAPPA
        kept, even = kept * (1 - rho), even * (1 - rho) + rho / k
        scale = rho / kept * rounds
        said = {r.own: r for r in found.groupBy(F.col("id").isNull().alias("own")).agg(F.sum("seen").alias("seen"), *(F.sum(c).alias(c) for c in names)).collect()}  # two rows
        if False in said:
            added = added + scale * np.array([said[False][c] for c in names])
            tables.append(found)
            sums.append(found.where("id is not null").select("id", *((F.col(c) * F.lit(scale)).alias(c) for c in names)))
            if len(sums) > APART:
                whole = _kept(added_up())
                for old in tables:
                    drop(old)
                tables[:], sums[:] = [whole], [whole]
        if True in said and said[True].seen:
            alpha = _concentration(alpha, said[True].seen, np.array([said[True][c] for c in names]) / said[True].seen, rho)
    if len(sums) > 1:
        sums[:] = [_kept(added_up())]
        for old in tables:
            drop(old)
    out = None
    for t in range(0, rounds, TOGETHER):  # not all documents are on the disks with the rows of their terms at once
        part = d.where(F.col("batch").between(t, t + TOGETHER - 1))
        told = _kept(met(part).applyInArrow(assign(kept, even, total(), alpha), f"{key} {kind}, topic_id int"))
        out = told if out is None else out.unionByName(told)
    return out


def _concentration(alpha: np.ndarray, n: int, log: np.ndarray, rho: float) -> np.ndarray:
    """A Newton step of the topics' prior towards the mean logarithms of documents' shares, if it stays above 0."""
    slope, c, q = n * (log - digamma(alpha) + digamma(alpha.sum())), n * trigamma(alpha.sum()), -n * trigamma(alpha)
    step = -rho * (slope - (slope / q).sum() / (1 / c + (1 / q).sum())) / q
    return alpha + step if (alpha + step > 0).all() else alpha
