"""Causal links, factors, names and key phrases against brute force and made-up truth."""

import datetime
import re

import numpy as np
import pandas as pd
import pytest

from corvane.operators import causal, factors, phrases


def series(x, names="abcdefghij"):
    day = datetime.date(2024, 1, 1)
    return [(names[i], day + datetime.timedelta(t), float(x[t, i])) for i in range(x.shape[1]) for t in range(len(x))]


def driven(n=300, seed=3):
    """b follows a by two days, c follows b by one; d is alone."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4))
    for t in range(2, n):
        x[t, 0] += 0.5 * x[t - 1, 0]
        x[t, 1] += 0.8 * x[t - 2, 0]
        x[t, 2] += 0.7 * x[t - 1, 1]
    return x + 20


def test_partial_correlation():
    x = driven()
    a, b, given = (0, 2), (1, 0), [(2, 1), (0, 1), (3, 3)]
    r, p = causal.partial(x, a, b, given, 6)
    cols = np.column_stack([x[6 - k : len(x) - k, v] for v, k in (a, b, *given)])
    inv = np.linalg.inv(np.corrcoef(cols.T))
    assert r == pytest.approx(-inv[0, 1] / np.sqrt(inv[0, 0] * inv[1, 1]), abs=1e-10) and p < 1e-10
    rng = np.random.default_rng(1)  # without a link p-values are even
    even = [causal.partial(rng.normal(size=(60, 3)), (0, 1), (1, 0), [(2, 1)], 2)[1] for _ in range(400)]
    assert abs(np.mean(even) - 0.5) < 0.05 and abs(np.mean(np.array(even) < 0.1) - 0.1) < 0.05
    assert causal.partial(np.ones((30, 2)), (0, 1), (1, 0), [], 2) == (0.0, 1.0)


def test_parents():
    x = driven()
    assert causal.parents(x, 1, 7, 0.01)[0] == (0, 2) and causal.parents(x, 2, 7, 0.01)[0] == (1, 1)


def test_pcmci(spark):
    rows = series(driven())
    got = {(r.cause, r.effect, r.lag): r for r in causal.pcmci(spark.createDataFrame(rows, "series string, day date, value double")).collect()}
    assert len(got) == 4 * 3 * 7 and all(r.lags == 7 for r in got.values())
    found = {k for k, r in got.items() if r.significant}
    assert {("a", "b", 2), ("b", "c", 1)} <= found and len(found) <= 4
    assert not got["a", "c", 3].significant  # through b only
    p = sorted(r.p for r in got.values())
    for r in got.values():
        assert r.q == pytest.approx(min(1.0, min(v * len(p) / (i + 1) for i, v in enumerate(p) if v >= r.p)), rel=1e-9)
    # the matrix of all gives the same as one target at a time
    x = driven()
    of = [causal.parents(x, j, 7, 0.05) for j in range(4)]
    assert {(i, lag): (r, p) for i, lag, r, p in causal.momentary(x, 2, of, 7)}[1, 1] == (got["b", "c", 1].correlation, got["b", "c", 1].p)


def test_pcmci_short_and_few(spark):
    kind = "series string, day date, value double"
    assert {r.lags for r in causal.pcmci(spark.createDataFrame(series(driven(22)), kind)).collect()} == {3}
    assert causal.pcmci(spark.createDataFrame(series(driven(12)), kind)).count() == 0
    assert causal.pcmci(spark.createDataFrame(series(driven(60)[:, :1]), kind)).count() == 0
    assert causal.pcmci(spark.createDataFrame([], kind)).count() == 0
    two = causal.pcmci(spark.createDataFrame(series(driven(60) * [1, 5, 1, 9]), kind), top=2)
    assert {(r.cause, r.effect) for r in two.collect()} == {("b", "d"), ("d", "b")}


def planted(k=4, docs=120, per=6, seed=0):
    """Documents of one topic's terms each."""
    rng = np.random.default_rng(seed)
    return [(d, f"t{d % k}_{i}", float(rng.uniform(0.5, 1))) for d in range(docs) for i in rng.choice(per, 4, replace=False)]


def test_nmf(spark):
    rows = planted()
    w = spark.createDataFrame(rows, "doc_id long, term string, weight double").repartition(6)
    terms, docs = factors.indexed(w, "doc_id", 10_000)
    assert terms == sorted({t for _, t, _ in rows})
    model = factors.fit(docs, terms, k=4, rounds=60)
    assert all(b <= a + 1e-9 for a, b in zip(model.losses, model.losses[1:], strict=False)) and model.losses[-1] < 0.5 * model.losses[0]
    # the same in numpy, over the whole matrix at once
    x = np.zeros((120, len(terms)))
    for d, t, v in rows:
        x[d, terms.index(t)] = v
    h, losses = np.random.default_rng(42).random((4, len(terms))), []
    for _ in model.losses:
        s = factors.shares(x, h)
        losses.append(((x - s @ h) ** 2).sum() / 2)
        h = factors.better(h, s.T @ s, s.T @ x)
    assert np.allclose(losses, model.losses, rtol=1e-6)
    told = {r.doc_id: r for r in factors.assign(docs, model, "doc_id").collect()}
    groups = [{told[d].topic_id for d in range(i, 120, 4)} for i in range(4)]
    assert all(len(g) == 1 for g in groups) and len(set.union(*groups)) == 4 and all(0.9 < r.weight <= 1 for r in told.values())
    assert {frozenset(t[:2] for t in top) for top in factors.leading_terms(model, 5)} == {frozenset({f"t{i}"}) for i in range(4)}


def test_shares_are_optimal():
    rng = np.random.default_rng(2)
    h, x = rng.random((5, 30)), rng.random((20, 30))
    w = factors.shares(x, h, 5000)
    slope = (w @ h - x) @ h.T  # of the loss: 0 where w > 0, not below where w = 0
    assert (w >= 0).all() and np.abs(slope[w > 1e-9]).max() < 1e-6 and slope[w <= 1e-9].min() > -1e-6


def test_nmf_few(spark):
    w = spark.createDataFrame([(1, "a", 1.0), (2, "b", 1.0)], "doc_id long, term string, weight double")
    assert sorted((r.doc_id, r.topic_id) for r in factors.factorised(w).collect()) == [(1, -1), (2, -1)]
    assert factors.factorised(w.where("false")).count() == 0


NAMES = ["Bank of Japan", "Bank", "bank of", "Japan Post", "Post Office", "New York", "York New", "a b a", "b a b a c", "서울", "서울 시청", "日本", "日本銀行", "O'Neil", "x-1", "...", "of japan post office"]


def found_by_force(text):
    tokens = [(m.group().lower(), *m.span()) for m in phrases.TOKEN.finditer(text)]
    names = [[t.lower() for t in phrases.TOKEN.findall(n)] for n in NAMES]
    at, out = 0, []
    while at < len(tokens):
        fits = [(len(n), NAMES[i]) for i, n in enumerate(names) if n and [t for t, *_ in tokens[at : at + len(n)]] == n]
        if fits:
            size, name = max(fits, key=lambda f: f[0])
            out.append((tokens[at][1], tokens[at + size - 1][2], name))
            at += size
        else:
            at += 1
    return out


def test_automaton():
    rng = np.random.default_rng(0)
    a = phrases.Automaton(NAMES)
    words = "bank of japan post office new york a b a b a c x 1 O Neil 서울 시청 에서 日 本 日本銀行 z".split(" ")
    texts = ["", "BANK OF JAPAN", "서울에서 日本銀行の", "embankment of", "O'Neil x-1 Bank, of; Japan Post Office", "a b a b a c"] + [" ".join(rng.choice(words, 60)) for _ in range(300)]
    for t in texts:
        assert [(lo, hi, NAMES[n]) for lo, hi, n in a.find(t)] == found_by_force(t)


def test_names_in(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "The Bank of Japan and the bank."), (2, None), (3, ""), (None, "Bank"), (4, "Japan Post Office " * 20_000)], "doc_id long, text string")
    names = spark.createDataFrame([(n, "org") for n in NAMES] + [(None, "org"), ("Bank", "org")], "name string, kind string")
    got = phrases.names_in(docs, names).collect()
    assert sorted((r.doc_id, r.start, r.name, r.kind, r.matched) for r in got if r.doc_id == 1) == [(1, 4, "Bank of Japan", "org", "Bank of Japan"), (1, 26, "Bank", "org", "bank")]
    assert sum(r.doc_id == 4 for r in got) == 20_000 and {r.doc_id for r in got} == {1, 4}
    monkeypatch.setattr(phrases, "MOST_NAMES", 3)
    with pytest.raises(ValueError, match="names"):
        phrases.names_in(docs, names)


def chosen_by_force(relevance, alike, top, diversity):
    left, out = list(range(len(relevance))), []
    while left and len(out) < top:
        best = max(left, key=lambda i: (round(relevance[i] if not out else (1 - diversity) * relevance[i] - diversity * max(alike[i][j] for j in out), 12), -i))
        out.append(best)
        left.remove(best)
    return out


def test_key_phrases(spark):
    rng = np.random.default_rng(4)
    for _ in range(50):
        v = rng.normal(size=(rng.integers(1, 21), 6))
        v /= np.linalg.norm(v, axis=1, keepdims=True)
        r = v @ v.mean(axis=0)
        assert phrases.chosen(r, v @ v.T, 10, 0.5) == chosen_by_force(r, v @ v.T, 10, 0.5)
    rows = [(1, t, w, i + 1) for i, (t, w) in enumerate([("interest rate", 0.5), ("interest rates", 0.49), ("rates", 0.4), ("election", 0.3)])] + [(2, "one", 1.0, 1)]
    got = pd.DataFrame([r.asDict() for r in phrases.key_phrases(spark.createDataFrame(rows, "doc_id long, term string, weight double, rank int"), top=3).collect()]).sort_values(["doc_id", "rank"])
    first = got[got.doc_id == 1].term.tolist()
    assert len(first) == 3 and "election" in first[:2] and got[got.doc_id == 2].term.tolist() == ["one"]  # not the same word again
    assert got[got.doc_id == 2].relevance.tolist() == pytest.approx([1.0])
    assert re.fullmatch(r"interest rates?", first[0])
