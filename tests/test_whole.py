"""Whole jobs against brute force, where a cut would lose rows."""

import random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from corvane.functions import text
from corvane.operators import graph, questions, titles
from corvane.plans import registry
from corvane.plans.standins import table


def _alike(spark, forms):
    """All pairs that ``titles_alike`` links, without candidates."""
    t = spark.createDataFrame([(f,) for f in sorted(set(forms))], "form string").where("form <> ''")
    x = t.toDF("a").crossJoin(t.toDF("b")).where("a < b").where(text.titles_alike(F.col("a"), F.col("b")))
    return {tuple(r) for r in x.collect()}


def _made_titles():
    rng, out = random.Random(3), []
    vocabulary = ["".join(rng.choices("abcdeghilmnorst", k=rng.randint(2, 9))) for _ in range(60)]
    for _ in range(60):
        w = rng.choices(vocabulary, k=rng.randint(1, 14))
        t = " ".join(w)
        out += [t, t + " now", " ".join(w[::-1]), t[: int(len(t) * 0.8)], " ".join([*w, rng.choice(vocabulary)]), "a" + t[1:], "".join(c if rng.random() > 0.15 else "z" for c in t)]
    return [" ".join(t.split()) for t in out] + ["", "a", "ab", "bcdef", "bcdefg", "budget", "budgets", "aaaaaaaaaaaaaaaaaaaaaaaaa", "aaaaaaaaaaaaaaaaaaaaaaaaaaaa", "한국 은행 금리 인상 발표", "한국 은행 금리 인하 발표"]


def test_alike_titles_are_all_found(spark, monkeypatch):
    monkeypatch.setattr(titles, "TILE", 40)
    forms = _made_titles()
    want = _alike(spark, forms)
    got = [tuple(r) for r in titles.alike(spark.createDataFrame([(f,) for f in forms], "form string")).collect()]
    assert len(want) > 100 and len(got) == len(set(got)) and set(got) == want


def test_long_titles_meet_by_hashes(spark):
    """Lines of 40,000 characters: before, each of 12,000 beginnings was a row with the whole title (0.5 GB a title), and each word one too."""
    rng = random.Random(5)
    longs = [" ".join("".join(rng.choices("abcdeghilmnorst", k=6)) for _ in range(5700)) for _ in range(3)]
    forms = [*longs, longs[0][:36_000], "z" + longs[1][1:]]
    t = spark.createDataFrame([(f,) for f in forms], "form string").select(F.xxhash64("form").alias("id"), "form")
    assert titles._by_words(t, 0.8).columns == titles._by_prefix(t).columns == ["i", "j"]
    got = {tuple(r) for r in titles.alike(t.select("form")).collect()}
    assert got == {tuple(sorted(p)) for p in ((forms[0], forms[3]), (forms[1], forms[4]))}


def test_pieces_never_exceed_the_distance():
    """What is left out is further apart: against edit distance in full."""
    rng = random.Random(1)

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for k, y in enumerate(b, 1):
                new.append(min(row[k] + 1, new[-1] + 1, row[k - 1] + (x != y)))
            row = new
        return row[-1]

    a, b = [], []
    for n in (1, 3, 20, 63, 64, 65, 130, 200) * 4:
        a.append("".join(rng.choices("abc ", k=n)))
        b.append("".join(c if rng.random() > 0.2 else rng.choice(["", "x", c + "y"]) for c in a[-1]) or "x")
    i, j = (x.ravel() for x in np.meshgrid(range(len(a)), range(0, len(a), 4), indexing="ij"))
    d = np.array([distance(a[x], b[y]) for x, y in zip(i, j, strict=True)])
    assert len(titles._within(a, b, i, j, d)[0]) == len(i) and len(titles._within(a, b, i, j, d // 2)[0]) < len(i) / 2


def _distance(a, b):
    """Edit distance by Myers' bits over the whole of ``a``."""
    full, top, score = (1 << len(a)) - 1, 1 << (len(a) - 1), len(a)
    up, down, at = full, 0, {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    for c in b:
        same = at.get(c, 0)
        v, h = same | down, (((same & up) + up) ^ up) | same
        more, less = down | ~(h | up) & full, up & h
        score += bool(more & top) - bool(less & top)
        more, less = (more << 1 | 1) & full, (less << 1) & full
        up, down = less | ~(v | more) & full, more & v
    return score


def test_tiles_lose_no_title_of_any_length(monkeypatch):
    """Trigrams, characters, and characters in steps: each pair within a fifth of edits is left, whichever way its length goes; few others are."""
    monkeypatch.setattr(titles, "STEPS", 300)
    monkeypatch.setattr(titles, "ROWS", 30)
    rng = random.Random(8)
    for n in (40, 105, 150, 250, 450, 900):
        made = ["".join(rng.choices("abcdeghilmnorst ", weights=[9, 2, 2, 3, 12, 2, 2, 8, 4, 2, 7, 7, 6, 6, 9, 15], k=n + rng.randint(0, n // 10))) for _ in range(12)]
        forms = list({f for m in made for f in [m, *("".join(c if rng.random() > share else rng.choice(["", "e", c + "t"]) for c in m) for share in (0.1, 0.2, 0.26, 0.3)), m[n // 8 :], "re " * (n // 20) + m]})
        d = {(i, j): _distance(a, b) < 0.2 * max(len(a), len(b)) for i, a in enumerate(forms) for j, b in enumerate(forms) if i != j}
        half = len(forms) // 2
        for s, t in ((1, 0), (0, 1)):  # two tiles, and one with itself
            g = pd.DataFrame({"id": range(len(forms)), "form": forms, "s": [0] * half + [s] * (len(forms) - half), "t": 0, "s1": 0, "t1": 0, "s2": s, "t2": 0})
            got = {tuple(sorted(p)) for p in zip(*(titles._tile(g, 0.2)[c] for c in "ij"), strict=True)}
            want = {(i, j) for (i, j), near in d.items() if near and i < j and (t or (i < half) != (j < half))}
            assert want <= got and len(got) < len(want) + len(d) / 20, n


def test_pieces_of_strangers_are_few(monkeypatch):
    """Before, a piece met all that is within the edits on either side, 1,664 columns instead of 865."""
    rng, met = random.Random(9), []
    a, b = (["".join(rng.choices("abcdeghilmnorst ", k=4000)) for _ in range(n)] for n in (10, 30))
    i, j = (x.ravel() for x in np.meshgrid(range(10), range(30), indexing="ij"))
    near = titles._near
    monkeypatch.setattr(titles, "_near", lambda *x: met.append(x[0].shape[0] * len(x[4]) * (64 + x[-1])) or near(*x))
    assert len(titles._within(a, b, i, j, np.full(300, 800))[0]) == 0 and 0 < sum(met) < 300 * 30 * 870


def test_titles_of_all_documents(spark, small):
    first = F.regexp_extract("text", "^[^\n]*", 0)
    forms = [r[0] for r in table(spark, small, "documents").select(text.title_form(first)).collect()]
    want = _alike(spark, forms)
    assert want and {tuple(r) for r in registry.queries()["f21_titles_alike"](spark, small).select("a", "b").collect()} == want


def test_components_of_all_parts(spark, small):
    """Against union-find over every edge of lineitem."""
    edges = [tuple(r) for r in table(spark, small, "lineitem").select("l_suppkey", "l_partkey").distinct().collect()]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((root(a), root(-1 - b)))
        parent[y] = x
    got = {r.node: r.component for r in registry.queries()["g16_components_whole"](spark, small).collect()}
    assert got == {n: root(n) for n in list(parent)}


def test_setters_know_all_history(spark):
    """A pair of twenty days ago is not new; the place and code that history lacks are."""
    import datetime

    day, rows = datetime.date(2024, 1, 30), []
    for back, place, code, i in ((0, "US", "ECO", 1), (0, "KR", "POL", 2), (20, "US", "ECO", 8), (31, "KR", "POL", 9)):
        rows.append((i, day - datetime.timedelta(back), "s", "major", place, [code]))
    a = spark.createDataFrame(rows, "article_id long, day date, source string, source_tier string, geo_focus_primary string, steeps_all array<string>")
    assert [tuple(r) for r in questions.setters(a, day).collect()] == [("s", "major", 1)]


def test_setters_query_is_over_the_whole_table(spark, small):
    from corvane.plans.standins import articles

    a = articles(spark, small)
    want = {tuple(r) for r in questions.setters(a, a.selectExpr("max(day)").first()[0]).collect()}
    assert {tuple(r) for r in registry.queries()["q11_setters_history"](spark, small).select("source", "source_tier", "n").collect()} == want


def _graph(spark, small):
    from corvane.operators import entities
    from corvane.plans.standins import articles

    return {(r.a, r.b): r.n for r in entities.cooccurrence(articles(spark, small), ["entities_person", "entities_org"]).collect()}


def test_pagerank_of_all_links(spark, small):
    """Against power iteration over every link of three articles until it stands still."""
    edges = _graph(spark, small)
    nodes = sorted({x for e in edges for x in e})
    at = {x: i for i, x in enumerate(nodes)}
    m = np.zeros((len(nodes), len(nodes)))
    for (a, b), n in edges.items():
        m[at[a], at[b]] = m[at[b], at[a]] = n
    m = m / m.sum(1, keepdims=True)
    r = np.full(len(nodes), 1 / len(nodes))
    for _ in range(500):
        r = 0.15 / len(nodes) + 0.85 * r @ m
    got = {x.node: x.rank for x in registry.queries()["g19_pagerank"](spark, small).collect()}
    assert set(got) == set(nodes) and max(abs(got[x] - r[at[x]]) for x in nodes) < 3e-6


def test_communities_of_all_links_are_settled(spark, small):
    """Every node has a label with most weight around it."""
    edges, got = _graph(spark, small), {x.node: x.community for x in registry.queries()["g21_communities"](spark, small).collect()}
    weight = {}
    for (a, b), n in edges.items():
        for v, u in ((a, b), (b, a)):
            weight.setdefault(v, {}).setdefault(got[u], 0)
            weight[v][got[u]] += n
    assert set(got) == set(weight)
    assert all(w.get(got[v], 0) == max(w.values()) for v, w in weight.items())


def test_labels_spread_along_long_paths(spark):
    e = [(f"n{i:02}", f"n{i + 1:02}", 100 - i) for i in range(30)]
    got = {r.node: r.community for r in graph.communities(spark.createDataFrame(e, "a string, b string, n long")).collect()}
    assert len(got) == 31 and all(got[a] == got[b] for a, b, n in e[:2])


def test_features_of_all_documents(spark, small):
    q, ids = registry.queries(), {r[0] for r in table(spark, small, "documents").select("doc_id").collect()}
    for name in ("f22_simhash", "a25_hashed_embeddings", "a33_topics"):
        assert {r[0] for r in q[name](spark, small).select("doc_id").collect()} == ids
    assert {r[0] for r in q["a25_hashed_embeddings"](spark, small).selectExpr("size(embedding)").distinct().collect()} == {64}
    assert {r[0] for r in q["a26_tfidf_documents"](spark, small).select("doc_id").distinct().collect()} <= ids


def test_clusters_and_lags_are_the_operators_own(spark, small, monkeypatch):
    from corvane.operators import features, grouped
    from corvane.plans import advanced, more

    seen = []
    monkeypatch.setattr(more.features, "clusters", lambda v, *a, f=features.clusters, **k: seen.append((a, k)) or f(v, *a, **k))
    monkeypatch.setattr(advanced.P, "causality", lambda s, *a, f=grouped.causality, **k: seen.append((a, k)) or f(s, *a, **k))
    registry.queries()["a34_kmeans"](spark, small)
    registry.queries()["s6_causality"](spark, small)
    assert seen == [((), {}), ((), {})]


def test_findings_have_all_leanings_of_half_a_percent(spark, small):
    """Means between 0.005 and 0.05 are findings too."""
    got = registry.queries()["m7_findings"](spark, small).collect()
    assert sorted(r.module for r in got) == ["mood"] * 5 + ["names"] * 5
    assert any(abs(r.magnitude) < 0.05 for r in got)
