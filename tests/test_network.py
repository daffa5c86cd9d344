"""Graphs, series tests, vectors, streams and checks against brute force."""

import datetime
import itertools
import math
import random
from collections import deque

import numpy as np
import pytest
from pyspark.sql import functions as F

from corvane.operators import checks, features, graph, grouped, search
from corvane.plans import network
from corvane.streaming import windows


def made_edges(seed, n=24, p=0.12):
    rng = random.Random(seed)
    return [(i, j, rng.randrange(1, 5)) for i, j in itertools.combinations(range(n), 2) if rng.random() < p or i // 6 == j // 6 and rng.random() < 0.6]


def brandes(edges, nodes):
    near = {v: set() for v in nodes}
    for a, b, _ in edges:
        near[a].add(b)
        near[b].add(a)
    out = dict.fromkeys(nodes, 0.0)
    for s in nodes:
        order, paths, dist, before, todo = [], {s: 1.0}, {s: 0}, {}, deque([s])
        while todo:
            v = todo.popleft()
            order.append(v)
            for w in near[v]:
                if w not in dist:
                    dist[w] = dist[v] + 1
                    todo.append(w)
                if dist[w] == dist[v] + 1:
                    paths[w] = paths.get(w, 0) + paths[v]
                    before.setdefault(w, []).append(v)
        share = dict.fromkeys(order, 0.0)
        for w in reversed(order):
            for v in before.get(w, []):
                share[v] += paths[v] / paths[w] * (1 + share[w])
            if w != s:
                out[w] += share[w]
    n = len(nodes)
    return {v: x / ((n - 1) * (n - 2)) for v, x in out.items()}


def test_betweenness(spark):
    edges = made_edges(1)
    nodes = sorted({x for a, b, _ in edges for x in (a, b)})
    got = {r.node: r.betweenness for r in graph.betweenness(spark.createDataFrame(edges, "a int, b int, n int")).collect()}
    want = brandes(edges, nodes)
    assert got.keys() == want.keys() and all(abs(got[v] - want[v]) < 1e-9 for v in nodes)


@pytest.mark.parametrize("few", [0, 20, graph.FEW_EDGES])
def test_louvain(spark, few, monkeypatch):
    """Planted groups are found by rounds, by one task, and by one task after a round's contraction."""
    monkeypatch.setattr(graph, "FEW_EDGES", few)
    edges = [(i, j, 1) for g in range(4) for i, j in itertools.combinations(range(6 * g, 6 * g + 6), 2)] + [(0, 6, 1), (7, 12, 1), (13, 18, 1)]
    df = spark.createDataFrame(edges, "a int, b int, n int")
    made = {r.node: r.community for r in graph.louvain(df).collect()}
    assert made == {v: v // 6 * 6 for v in range(24)}
    assert graph.louvain(df.where("false")).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_moves_in_turn(seed):
    """At the end no node gains by moving to another community or out of all."""
    edges = made_edges(seed, 30, 0.15)
    links, loops = [{} for _ in range(30)], [float(v % 3) for v in range(30)]
    for a, b, n in edges:
        links[a][b] = links[b][a] = float(n)
    of = graph.moved_in_turn(links, loops)
    total = sum(loops) + sum(n for _, _, n in edges)
    k = [2 * loop + sum(near.values()) for near, loop in zip(links, loops, strict=True)]

    def modularity(of):
        inside = sum(n for a, b, n in edges if of[a] == of[b]) + sum(loops)
        return inside / total - sum((sum(k[v] for v in range(30) if of[v] == c) / (2 * total)) ** 2 for c in set(of))

    best = modularity(of)
    assert best > modularity(list(range(30))) and len(set(of)) < 30
    parts = sorted(set(of))
    for a, b in itertools.combinations(parts, 2):  # nor does a merger of two
        assert modularity([a if c == b else c for c in of]) <= best + 1e-9


def test_weekly_pagerank(spark):
    rows = [(w, a, b, n) for w, seed in ((1, 3), (2, 4)) for a, b, n in made_edges(seed, 10, 0.3)]
    got = {(r.week, r.node): r["rank"] for r in graph.weekly_pagerank(spark.createDataFrame(rows, "week int, a int, b int, n int")).collect()}
    for week in (1, 2):
        own = [(a, b, n) for w, a, b, n in rows if w == week]
        both = [(a, b, float(n)) for a, b, n in own] + [(b, a, float(n)) for a, b, n in own]
        alone = {r.node: r["rank"] for r in graph.pagerank(spark.createDataFrame(both, "src int, dst int, weight double")).collect()}
        assert all(abs(got[week, v] - x) < 1e-4 for v, x in alone.items()) and sum(k[0] == week for k in got) == len(alone)


def test_depth_of_dense_graphs(spark):
    """Every node leads to all later ones: as many walks as subsets, but each node is met once."""
    edges = list(itertools.combinations(range(26), 2)) + [(30, 31), (31, 30), (29, 30)]
    got = {r.root: r.depth for r in graph.depth(spark, spark.createDataFrame(edges, "src int, dst int")).collect()}
    assert got == {0: 1, 29: 2}


def test_unit_roots():
    rng = np.random.default_rng(3)
    noise, walk = rng.normal(size=300), np.cumsum(rng.normal(size=300))
    assert grouped.unit_root(noise)[2] and not grouped.unit_root(walk)[2] and grouped.unit_root(np.diff(walk))[2]
    assert grouped.unit_root(np.ones(20)) == (0.0, 0, False)
    hits = [grouped.unit_root(np.cumsum(np.random.default_rng(i).normal(size=120)))[2] for i in range(200)]
    assert 0.01 < np.mean(hits) < 0.11  # a level of 5 %


def days(n):
    return [datetime.date(2024, 1, 1) + datetime.timedelta(i) for i in range(n)]


def test_stationarity_and_cascades(spark):
    rng = np.random.default_rng(5)
    a = rng.poisson(20, 60).astype(float)
    series = {"a": a, "b": np.r_[20.0, a[:-1]] + rng.normal(0, 0.1, 60), "walk": np.cumsum(rng.normal(0, 1, 60)) + 500, "rare": np.r_[np.zeros(50), np.ones(10)], "tiny": np.ones(60) * 0.1}
    df = spark.createDataFrame([(k, d, float(x)) for k, v in series.items() for d, x in zip(days(60), v, strict=True)], "series string, day date, value double")
    told = {r.series: (r.stationary, r.differenced) for r in grouped.stationarity(df).collect()}
    assert told["a"] == (True, False) and told["walk"][1] or not told["walk"][0]
    got = {(r.cause, r.effect): (r.lag, r.p) for r in grouped.cascades(df, top=4).collect()}
    assert got["a", "b"][1] < 1e-6 and all("rare" not in k and "tiny" not in k for k in got)
    for (x, y), (lag, p) in got.items():
        assert (p, lag) == min((grouped.granger(series[x], series[y], k), k) for k in range(1, 8)) and p < 0.05


def test_shift_points(spark):
    kl = [0.1] * 10 + [5.0] * 10
    df = spark.createDataFrame([(1, d, x) for d, x in zip(days(21), [None, *kl], strict=True)], "topic_id int, day date, kl double")
    got = [r.day for r in grouped.shift_points(df).where("changed").collect()]
    assert got == [days(21)[11]]


def test_dtw_by_diagonals():
    rng = np.random.default_rng(0)
    for n, m in ((5, 7), (1, 4), (9, 9)):
        x, y = rng.normal(size=n), rng.normal(size=m)
        z = lambda v: (v - v.mean()) / (v.std() or 1.0)
        acc = np.full((n + 1, m + 1), np.inf)
        acc[0, 0] = 0
        for i in range(1, n + 1):
            for j in range(1, m + 1):
                acc[i, j] = abs(z(x)[i - 1] - z(y)[j - 1]) + min(acc[i - 1, j], acc[i, j - 1], acc[i - 1, j - 1])
        assert abs(grouped.dtw(x, y) - acc[-1, -1]) < 1e-12


def test_vectors_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(search, "BLOCK", 7)
    rng = np.random.default_rng(1)
    v = np.vstack([rng.normal(size=(40, 6)), np.zeros((1, 6)), np.ones((3, 6))])
    df = spark.createDataFrame([(i, [float(y) for y in x]) for i, x in enumerate(v)] + [(99, None)], "vec_id long, embedding array<double>")
    size = np.linalg.norm(v, axis=1, keepdims=True)
    u = np.divide(v, size, out=np.zeros_like(v), where=size > 0)
    c = u @ u.T
    got = {}
    for r in search.nearest(df, df.where("vec_id % 5 = 0"), 4).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == {q: [j for j in sorted(range(len(v)), key=lambda j: (-round(c[q, j], 12), j)) if j != q][:4] for q in range(0, len(v), 5)}
    alike = {r.vec_id: r.n_alike for r in search.alike(df, df.where("vec_id % 2 = 1")).collect()}
    assert alike == {q: max(1, sum(c[q, j] > 0.75 for j in range(len(v)) if j != q)) for q in range(1, len(v), 2)} | {99: 1}


def test_search_of_a_written_index(spark, tmp_path):
    docs = spark.createDataFrame([(1, "solar wind power"), (2, "wind solar farms solar"), (3, "the wind"), (4, None), (5, "")], "doc_id long, text string")
    search.index(docs).write.partitionBy("term").parquet(str(tmp_path / "i"))
    sizes = docs.select(F.size(search.tokens(F.col("text"))).alias("length")).agg(F.count("*").alias("n"), F.avg("length").alias("mean"))
    for options in ({}, {"every": False}, {"phrase": True}):
        a = search.search(docs, ["solar", "wind"], **options).collect()
        b = search.search_index(spark.read.parquet(str(tmp_path / "i")), sizes, ["solar", "wind"], **options).collect()
        assert [r.doc_id for r in a] == [r.doc_id for r in b] and all(abs(x.score - y.score) < 1e-12 for x, y in zip(a, b, strict=True))


def test_contradictions_with_a_model(spark):
    import pandas as pd

    rows = [(1, i, f"s{i % 2}", f"text {i}", [1.0, i / 10]) for i in range(6)]
    df = spark.createDataFrame(rows, "topic_id int, article_id int, source string, text string, embedding array<double>")

    def entails(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([0.9 if x.endswith("0") else 0.1 for x in a])

    assert {(r.a, r.b, r.score) for r in features.alike_but_opposed(df, entails).collect()} == {(0, 1, 0.9), (0, 3, 0.9), (0, 5, 0.9)}
    assert features.alike_but_opposed(df).count() == 9


def test_breakers(spark, tmp_path):
    rng, rows = random.Random(8), []
    for site in "abc":
        t = 0
        for _ in range(80):
            t += rng.choice([1, 5, 100, 400])
            rows.append((site, datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=t), rng.random() < 0.45))
    df = spark.createDataFrame(rows, "site string, ts timestamp, ok boolean")
    want = {}
    for site, ts, ok in rows:
        state, opened = want.get(site, (windows.CLOSED, 0))
        new = windows.breaker_step(state, ts.timestamp(), ok, failures=3)
        want[site] = (new, opened + (new[0] == "open" and new[3] != state[3]))
    got = {r.site: ((r.state, r.failed, r.good, r.since), r.opened) for r in windows.breakers(df, failures=3).collect()}
    assert {s: (v[0][0], v[0][1], v[1]) for s, v in got.items()} == {s: (v[0][0], v[0][1], v[1]) for s, v in want.items()} and {v[1] > 0 for v in want.values()} == {True}
    df.repartition(1).write.parquet(str(tmp_path / "calls"))
    live = spark.readStream.schema(df.schema).parquet(str(tmp_path / "calls"))
    told = windows.run_once(windows.breaker(live, failures=3), "breakers", "update").collect()
    assert {r.site: (r.state, r.failed) for r in told} == {s: (v[0][0], v[0][1]) for s, v in want.items()}
    assert windows.breaker_step(("open", 5, 0, 100.0), 399.0, True) == ("open", 5, 0, 100.0) and windows.breaker_step(("open", 5, 0, 100.0), 400.0, True) == ("half_open", 5, 1, 100.0)


def test_stream_dismisses(spark, tmp_path):
    first = datetime.date(2024, 1, 1)
    batches = [[("old", first), ("new", first)], [("new", first + datetime.timedelta(10))], [("new", first + datetime.timedelta(30))], [("late", first + datetime.timedelta(31))]]
    for i, b in enumerate(batches):
        spark.createDataFrame(b, "signal string, day date").coalesce(1).write.parquet(str(tmp_path / f"d{i}"))
    import shutil

    (tmp_path / "in").mkdir()
    for i in range(len(batches)):
        for f in (tmp_path / f"d{i}").glob("*.parquet"):
            shutil.copy(f, tmp_path / "in" / f"{i}.parquet")
            import os

            os.utime(tmp_path / "in" / f"{i}.parquet", (1_700_000_000 + 100 * i,) * 2)
    live = spark.readStream.schema("signal string, day date").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    told = [tuple(r) for r in windows.run_once(windows.portfolio(live), "dismissals", "update").collect()]
    assert ("old", 1, "dismissed") in told and not any(s == "late" and x == "dismissed" for s, _, x in told)


def test_append_once(spark, tmp_path):
    spark.range(50).write.parquet(str(tmp_path / "in"))
    live = spark.readStream.schema("id long").parquet(str(tmp_path / "in"))
    windows.append_once(live, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    windows.append_once(live, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 50
    done = spark.range(40).withColumnRenamed("id", "url_key")
    assert windows.unseen(spark.createDataFrame([(39,), (41,), (41,), (None,)], "url_key long"), done).count() == 2


def test_availability_and_assembly(spark, tmp_path):
    day = datetime.date(2024, 1, 10)
    rows = [(day - datetime.timedelta(i), 1) for i in range(4) for _ in range(3)]
    spark.createDataFrame(rows, "crawl_date date, x int").write.partitionBy("crawl_date").parquet(str(tmp_path / "t"))
    files = checks.catalogue(spark, str(tmp_path / "t"), "articles")
    assert {r.day for r in files.collect()} == {d for d, _ in rows}
    told = checks.availability(files, day, 6, ["articles", "topics"], ["articles"])
    assert {r.day: r.status for r in told.collect()} == {day - datetime.timedelta(i): "available" if i < 4 else "missing" for i in range(6)}
    assert checks.assemble(spark, str(tmp_path / "t"), told).count() == 12
    with pytest.raises(ValueError, match="4 of 6"):
        checks.assemble(spark, str(tmp_path / "t"), told, 0.9)


def test_checks(spark):
    df = spark.createDataFrame([(1, 0.5, "a"), (2, math.nan, "z"), (None, 1.5, None), (4, None, "a")], "id int, x double, k string")
    got = {(r.check, r.column): r.bad for r in checks.out_of_range(df, {"x": (0.0, 1.0)}, {"k": ["a", "b"]}, ["id"]).collect()}
    assert got == {("range", "x"): 2, ("allowed", "k"): 2, ("needed", "id"): 1}
    assert {r.bad for r in checks.out_of_range(df.where("false"), {"x": (0.0, None)}).collect()} == {0}
    none = {r.metric: (r.value, r.passed) for r in checks.success(spark.createDataFrame([], "site string, before long, after long, seconds double, memory double")).collect()}
    assert none["dedup_effectiveness"] == (None, False) and none["total_articles"] == (0.0, False)
    assert checks.converged(1, 1000) and checks.converged(4, 10) and not checks.converged(30, 1000)


def test_entries_are_registered():
    assert network.louvain and network.breakers


def test_alike_pairs_are_made_inside_runs(spark, monkeypatch):
    """No join makes rows of pairs, and pairs across the ends of runs are there; nulls and vectors of another length meet nothing."""
    rows = [(i % 2, i, f"s{i % 3}" if i % 11 else None, "t", [1.0, float(i % 5)] if i % 7 else [[1.0], None][i % 2]) for i in range(120)]
    df = spark.createDataFrame(rows, "topic_id int, article_id long, source string, text string, embedding array<double>")
    want = set()
    for topic in (0, 1):
        own = [r for r in rows if r[0] == topic]
        for n, x in enumerate(own):
            for y in own[n + 1 : n + 5]:
                if x[2] and y[2] and x[2] != y[2] and x[4] and y[4] and len(x[4]) == len(y[4]):
                    u, v = np.array(x[4]), np.array(y[4])
                    if u @ v / np.linalg.norm(u) / np.linalg.norm(v) >= 0.6:
                        want.add((topic, x[1], y[1]))
    for run in (6, 5000):
        monkeypatch.setattr(features, "RUN", run)
        out = features.alike_but_opposed(df, reach=5)
        assert "Join" not in out._jdf.queryExecution().executedPlan().toString()
        got = [(r.topic_id, r.a, r.b) for r in out.collect()]
        assert len(got) == len(set(got)) and set(got) == want
