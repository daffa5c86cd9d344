"""Features of topics against brute force, and the layers they lead to."""

import datetime

import numpy as np
import pytest

from corvane.operators import signals
from corvane.operators import topicfeatures as T
from corvane.operators.series import EMOTIONS

DAY = datetime.date(2024, 1, 1)
ARTICLE = "article_id long, topic_id int, day date, source string, steeps_category string, sentiment_score double, " + ", ".join(f"emotion_{e} double" for e in EMOTIONS)
VECTOR = "article_id long, embedding array<float>"


def article(i, topic, day, source="s", code="E", joy=0.5):
    return (i, topic, None if day is None else DAY + datetime.timedelta(day), source, code, 0.0, joy, *[0.1] * 7)


def test_drift(spark):
    rng = np.random.default_rng(5)
    rows = [article(i, int(rng.integers(-1, 4)), int(rng.integers(0, 3)) if i % 9 else None) for i in rng.permutation(120).tolist()]
    rows += [article(500 + i, 7, 0) for i in range(40)]  # one day holds all
    rows += [article(600 + i, 8, i) for i in range(3)] + [article(700 + i, 9, i) for i in range(4)]
    x = {r[0]: rng.normal(size=5).astype("float32").tolist() for r in rows if r[0] % 7}
    x |= {k: [0.0] * 5 for k in x if k >= 700}
    vectors = [(k, v) for k, v in x.items()] + [(9000, [1.0] * 5), (rows[0][0] - rows[0][0] % 7, None)]
    got = {r.topic_id: r.embedding_drift for r in T.drift(spark.createDataFrame(rows, ARTICLE), spark.createDataFrame(vectors, VECTOR)).collect()}
    for topic in {r[1] for r in rows} - {-1}:
        own = [np.array(x[r[0]]) for r in sorted((r for r in rows if r[1] == topic and r[0] in x), key=lambda r: (r[2] or datetime.date(2000, 1, 1), r[0]))]
        want = 0.0
        if len(own) >= 4 and np.abs(own).max() > 0:
            a, b = np.mean(own[: len(own) // 2], axis=0), np.mean(own[len(own) // 2 :], axis=0)
            want = 1 - a @ b / np.linalg.norm(a) / np.linalg.norm(b)
        assert got[topic] == pytest.approx(want, abs=1e-9)
    assert -1 not in got and got[8] == 0 == got[9]


def features(spark, rows, vectors=(), scores=(), edges=(), shifts=()):
    made = T.topic_features(
        spark.createDataFrame(rows, ARTICLE), spark.createDataFrame(list(vectors), VECTOR), spark.createDataFrame(list(scores), "article_id long, ood_score double"),
        spark.createDataFrame(list(edges), "a string, b string, n long"), spark.createDataFrame(list(shifts), "topic_id int, day date, kl double, changed boolean"),
    )
    return made, {r.topic_id: r for r in made.collect()}


def test_topic_features(spark):
    ids = iter(range(100_000))
    rows = []
    for d in range(40):
        rows += [article(next(ids), 0, d, f"s{i}", "SEPT"[i % 4]) for i in range(2 if d < 39 else 30)]  # bursts on the last day
        rows += [article(next(ids), 1, d, joy=0.2 if d < 36 else 0.9) for _ in range(4 if d < 20 else 12)]
        rows += [article(next(ids), -1, d) for _ in range(3)]
    rows += [article(next(ids), 2, 39) for _ in range(2)]
    scores = [(r[0], 0.9 if r[0] % 5 == 0 else 0.1) for r in rows if r[1] == 1]
    edges = [("a", "b", 3), ("b", "c", 3), ("x", "y", 3), ("y", "z", 3), ("c", "x", 1)]
    made, got = features(spark, rows, scores=scores, edges=edges, shifts=[(1, DAY, 0.4, True), (0, DAY, 0.1, False)])
    assert set(got) == {0, 1, 2}
    a, b, c = got[0], got[1], got[2]
    assert (a.article_count, a.source_count, a.cross_domain_count, a.steeps_shift, a.span_days) == (108, 30, 4, True, 39)
    x = np.array([2.0] * 39 + [30])
    assert a.volume_zscore == pytest.approx((30 - x.mean()) / x.std()) and a.burst_score > 2
    assert a.growth == pytest.approx((34 / 3 - 2) / 2) and a.bertrend_state == "emerging" and a.bertrend_transition == 1
    assert b.growth == pytest.approx(2.0) and b.changepoint_significance > 0.8 and b.emotion_shift and not a.emotion_shift
    assert b.ood_score == 0.9 and b.novelty_score == pytest.approx(np.mean([s for _, s in scores])) and a.ood_score == 0
    assert b.frame_divergence and not a.frame_divergence and not c.frame_divergence
    assert c.bertrend_state == "noise" and c.bertrend_transition == 0 and c.span_days == 0
    assert a.modularity_delta == pytest.approx(12 / 13 - 2 * 0.25) and a.network_anomaly == pytest.approx(0.9) and c.network_anomaly == pytest.approx(0.9 * 2 / 6)
    assert a.entropy_spike == b.entropy_spike == c.entropy_spike and 0 <= a.entropy_spike <= 1
    assert {r.topic_id: r.signal_layer for r in signals.best(signals.classify(made)).collect()} == {0: "L1_fad"}


def test_empty_tables(spark):
    assert features(spark, [])[1] == {}
    only = features(spark, [article(1, 3, None)])[1][3]
    assert only.article_count == 1 and only.modularity_delta == 0 and only.network_anomaly == 0 and only.embedding_drift == 0 and not only.emotion_shift
