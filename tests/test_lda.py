"""Topics against the same steps over dense matrices, and whatever the blocks."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corvane.operators import features, lda


def corpus(spark, n=120):
    rng, rows = random.Random(2), []
    for i in range(n):
        words = [chr(97 + i % 3) * 3 + chr(97 + w) for w in range(20)]
        rows.append((i, " ".join([*rng.choices(words, k=40), "every", f"only{chr(97 + i % 26)}{i // 26 * 'x'}"]) if i % 10 else [None, "", "12 ab"][i % 3]))
    return spark.createDataFrame(rows, "doc_id long, text string")


def by_force(rows, k, rounds, seed):
    """Online variational Bayes with all terms in one matrix."""
    ids = np.array(sorted({x for r in rows for x in r.ids}), np.int64)
    x = np.array([[dict(zip(r.ids, r.counts)).get(i, 0) for i in ids] for r in rows], float)
    df = (x > 0).sum(0)
    ids, x = ids[(df >= 2) & (df <= 0.95 * len(rows))], x[:, (df >= 2) & (df <= 0.95 * len(rows))]
    weights, alpha = lda.start(ids, k, seed), np.full(k, 1 / k)
    beta = lambda: np.exp(lda.digamma(weights) - lda.digamma(weights.sum(0)))
    for t in range(rounds):
        b, found, logs = beta(), np.zeros_like(weights), []
        for r, c in zip(rows, x):
            if r.batch == t and c.any():
                gamma, share = lda.infer(c[c > 0], b[c > 0], alpha)
                found[c > 0] += share * b[c > 0]
                logs.append(lda.digamma(gamma) - lda.digamma(gamma.sum()))
        rho = (lda.TAU + t + 1) ** -lda.KAPPA
        weights = (1 - rho) * weights + rho * (1 / k + rounds * found)
        if logs:
            alpha = lda._concentration(alpha, len(logs), np.mean(logs, 0), rho)
    b = beta()
    return {r.doc_id: int(lda.infer(c[c > 0], b[c > 0], alpha)[0].argmax()) if c.any() else 0 for r, c in zip(rows, x)}


def test_topics_by_blocks(spark, monkeypatch):
    docs, words = corpus(spark), F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}{3,}"), 0)
    want = by_force(lda.counted(docs, words, "doc_id", 4, 42).collect(), 3, 4, 42)
    for size in (7, 4000):
        monkeypatch.setattr(lda, "SIZE", size)
        got = lda.topics(docs, words, 3, "doc_id", rounds=4).collect()
        assert len(got) == 120 and {r.doc_id: r.topic_id for r in got} == want
    assert all(want[i] == 0 for i in range(0, 120, 10)) and len(set(want.values())) > 1


def test_rounds_leave_a_row_a_term_and_are_dropped(spark, monkeypatch):
    """Before, each round left a row for each block and term, and tables that had been added up stayed."""
    docs, words = corpus(spark, 60), F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}{3,}"), 0)
    rows, gone, settle, drop = [], [], lda.settle, lda.drop

    def kept(df):
        out = settle(df)
        if "seen" in out.columns:
            rows.append((out.count(), out.select("id").distinct().count()))
        return out

    monkeypatch.setattr(lda, "settle", kept)
    monkeypatch.setattr(lda, "drop", lambda df: gone.append((df, drop(df))))
    monkeypatch.setattr(lda, "SIZE", 7)
    monkeypatch.setattr(lda, "APART", 1)
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting)
    assert lda.topics(docs, words, 3, "doc_id", rounds=3).count() == 60 and spark.conf.get(setting) == before
    assert len(rows) == 3 and all(n == ids for n, ids in rows) and len(gone) >= 2
    for df, _ in gone:
        with pytest.raises(Exception, match="(?i)not.?exist|not.?found"):
            spark.read.schema(df.schema).parquet(df.inputFiles()[0]).count()
    with pytest.raises(ValueError, match="no settled table"):
        drop(spark.read.parquet("/root/testdata/sf0.001/nation.parquet"))


def test_no_vocabulary_on_the_driver(spark, monkeypatch):
    """Before, all words were collected and the model was a matrix there."""
    import pyspark.ml.feature

    monkeypatch.delattr(pyspark.ml.feature, "CountVectorizer")
    assert features.topics(corpus(spark, 12), k=2).count() == 12
    assert features.topics(spark.createDataFrame([(1, "a b")], "doc_id long, text string")).collect() == [(1, 0)]
