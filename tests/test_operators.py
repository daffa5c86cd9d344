"""Operators on small made-up rows, and brute-force versions of the numeric ones."""

import datetime
import itertools
import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane.functions import text, urls
from corvane.operators import economy, graph, grouped, narrative, questions, search
from corvane.sources import tables
from corvane.streaming import windows


def one(spark, column, **values):
    return spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items())).select(column).first()[0]


@pytest.mark.parametrize(
    ("url", "want"),
    [
        ("http://WWW.Example.com:80/a/../b/./c/?utm_source=x&b=2&a=1#top", "https://example.com/b/c?a=1&b=2"), ("https://u:p@example.org:8443/%7Ex%2Fy", "https://example.org:8443/~x%2Fy"),
        ("https://example.org", "https://example.org"), ("https://example.org/?ref=1", "https://example.org"), ("/relative", None), ("", None), (None, None),
    ],
)
def test_normal_url(spark, url, want):
    df = spark.createDataFrame([(url,)], "u string").select(urls.normalize(F.col("u")))
    assert df.first()[0] == want


def test_clean_text(spark):
    assert one(spark, text.clean(F.col("x")), x="<b>a &amp; b</b>  see https://x.y/z or me@x.org") == "a & b see or"
    assert one(spark, text.visible(F.col("x")), x="<p>one</p><script>var t='</p>';</script><p>two</p>") == "one\ntwo"


def test_titles(spark):
    rows = [("storm hits the coast", "storm hits the coast today", False), ("a b c d e f g h i j", "a b c d e f g h i x", False), ("market rally continues now", "market rally continue now", True), ("", "", False)]
    df = spark.createDataFrame(rows, "a string, b string, w boolean")
    for r in df.select("w", text.titles_alike(F.col("a"), F.col("b")).alias("g"), "a").collect():
        assert r.g == r.w or r.a.startswith(("storm", "a b"))


def test_simhash(spark):
    a = "the quick brown fox jumps over the lazy dog near the river bank today and tomorrow"
    rows = [(a,), (a,), ("short",), (None,)]
    got = [r[0] for r in spark.createDataFrame(rows, "t string").select(text.simhash64(F.col("t"))).collect()]
    import hashlib

    w = a.split()
    grams = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)]
    sums = [0] * 64
    for g in grams:
        h = int.from_bytes(hashlib.sha256(g.encode()).digest()[:8], "big")
        for i in range(64):
            sums[i] += 1 if h >> i & 1 else -1
    want = sum(1 << i for i in range(64) if sums[i] > 0)
    assert got[0] == got[1] and got[0] % 2**64 == want and got[2] == 0


def test_kleinberg_and_pelt():
    x = np.array([2, 2, 3, 2, 20, 22, 25, 2, 3, 2, 2, 2.0])
    s = grouped.kleinberg(x)
    assert s[4:7].min() >= 1 and s[:4].max() == 0 and s[7:].max() == 0
    best = min(itertools.product(range(3), repeat=6), key=lambda p: _cost(x[2:8], p))
    assert tuple(np.minimum(grouped.kleinberg(x[2:8]), 2)) == best or _cost(x[2:8], tuple(grouped.kleinberg(x[2:8]))) <= _cost(x[2:8], best) + 1e-9
    y = np.r_[np.zeros(10), np.ones(10) * 5] + np.sin(np.arange(20)) * 0.1
    assert grouped.pelt(y) == [10] and grouped.pelt(np.ones(20)) == [] and grouped.pelt(np.ones(3)) == []


def _cost(x, path, base=2.0):
    mean, k = max(x.mean(), 1e-9), 10
    rates = mean * base ** np.arange(k)
    total, before = 0.0, 0
    for v, s in zip(x, path, strict=True):
        total += rates[s] - v * math.log(rates[s]) + math.log(len(x)) * max(s - before, 0)
        before = s
    return total


def test_pelt_is_optimal():
    rng = np.random.default_rng(1)
    x = np.r_[rng.normal(0, 1, 7), rng.normal(4, 1, 6), rng.normal(-3, 1, 5)]
    z = (x - x.mean()) / x.std()
    cost = lambda cuts: sum(((p - p.mean()) ** 2).sum() for p in np.split(z, cuts)) + math.log(len(x)) * len(cuts)
    choices = [c for r in range(4) for c in itertools.combinations(range(3, 16), r) if all(b - a >= 3 for a, b in zip((0, *c), (*c, 18), strict=True))]
    assert cost(grouped.pelt(x)) <= min(map(cost, map(list, choices))) + 1e-9


def test_distributions():
    assert abs(grouped.f_tail(4.0, 2, 10) - 0.05310) < 2e-4 and abs(grouped.f_tail(1.0, 5, 5) - 0.5) < 1e-9
    rng = np.random.default_rng(0)
    x = rng.normal(size=200)
    y = np.r_[0, x[:-1]] + 0.1 * rng.normal(size=200)
    assert grouped.granger(x, y, 2) < 1e-6 < grouped.granger(y, x, 2)
    assert grouped.dtw(x[:20], x[:20]) == 0
    trend, season, rest = grouped.decompose(np.arange(28) + np.tile([3, 0, 0, 0, 0, 0, -3], 4))
    assert np.allclose(trend + season + rest, np.arange(28) + np.tile([3, 0, 0, 0, 0, 0, -3], 4)) and season[0] > 1.5 > -1.5 > season[6]


def test_graph(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (5, 6), (6, 5), (9, 9)], "a long, b long")
    assert {tuple(r) for r in graph.components(e).collect()} == {(1, 1), (2, 1), (3, 1), (5, 5), (6, 5), (9, 9)}
    r = {x.node: x["rank"] for x in graph.pagerank(spark.createDataFrame([("a", "b", 1.0), ("b", "c", 1.0)], "src string, dst string, weight double")).collect()}
    assert abs(sum(r.values()) - 1) < 1e-6 and r["c"] > r["b"] > r["a"]
    assert graph.pagerank(spark.createDataFrame([], "src string, dst string, weight double")).count() == 0


def test_search(spark):
    d = spark.createDataFrame([(1, "solar wind power"), (2, "wind solar farms"), (3, "the wind"), (4, None)], "doc_id long, text string")
    assert [r.doc_id for r in search.search(d, ["solar", "wind"], phrase=True).collect()] == [1]
    assert {r.doc_id for r in search.search(d, ["solar", "wind"]).collect()} == {1, 2}
    assert [r.doc_id for r in search.search(d, ["the", "solar"], every=False).collect()][0] == 3


def test_tables(spark, tmp_path):
    (tmp_path / "2026-01-02").mkdir()
    row = {f.name: None for f in tables.RAW} | {"url": "u", "title": "t"}
    (tmp_path / "2026-01-02" / "a.jsonl").write_text(json.dumps(row) + "\n\n{broken\n" + json.dumps(row | {"url": "v"}) + "\n")
    got = tables.read_jsonl(spark, str(tmp_path / "2026-01-02"), dated=True)
    assert sorted((r.url, r.data_date) for r in got.collect()) == [("u", "2026-01-02"), ("v", "2026-01-02")]
    schema = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("x", T.FloatType())])
    good = spark.createDataFrame([(1, 1.0), (2, None)], "id int, x double").withColumn("crawl_date", F.lit("2026-01-02").cast("date"))
    tables.write_table(good, str(tmp_path / "t"), schema, ["crawl_date"])
    assert tables.read_window(spark, str(tmp_path / "t"), "2026-01-03", 2).count() == 2
    assert tables.read_window(spark, str(tmp_path / "t"), "2026-01-09", 2).count() == 0
    assert tables.latest(spark, str(tmp_path / "t")).count() == 2
    with pytest.raises(ValueError, match="null"):
        tables.write_table(spark.createDataFrame([(None, 1.0)], "id int, x double"), str(tmp_path / "bad"), schema)
    with pytest.raises(ValueError, match="missing"):
        tables.write_table(good.drop("x"), str(tmp_path / "bad"), schema)


def test_momentum_ends(spark):
    d = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 4.0), ("a", 3, 9.0), ("b", 1, 5.0)], "k string, t int, v double")
    got = {(r.k, r.t): (r.velocity, r.acceleration) for r in economy.momentum(d, "v", ["k"], "t").collect()}
    assert got == {("a", 1): (3.0, 1.0), ("a", 2): (4.0, 1.0), ("a", 3): (5.0, 1.0), ("b", 1): (0.0, 0.0)}


def test_flow_crosses_buckets(spark):
    t = lambda h: datetime.datetime(2024, 1, 1) + datetime.timedelta(hours=h)
    a = spark.createDataFrame([(1, "x", t(23)), (1, "y", t(25)), (1, "z", t(60)), (2, "y", t(24))], "topic_id int, source string, published_at timestamp")
    assert [tuple(r) for r in narrative.information_flow(a, F.lit(True)).collect()] == [("x", "y", 1)]


def test_flow_of_equal_titles_is_counted_without_pairs(spark):
    t = lambda s: datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=s, microseconds=s % 7)
    rows = [(i % 3 - 1, None if i % 41 == 0 else f"s{i * 7 % 4}", None if i % 37 == 0 else t(i * 7919 % 200 * 2160), None if i % 43 == 0 else f"t{i % 2}") for i in range(400)]
    a = spark.createDataFrame(rows, "topic_id int, source string, published_at timestamp, title string")
    want = {(r.src, r.dst): r.weight for r in narrative.information_flow(a, F.col("a.title") == F.col("b.title")).collect()}
    counted = narrative.information_flow(a, same=["title"])
    assert {(r.src, r.dst): r.weight for r in counted.collect()} == want and len(want) == 4
    assert "Join" not in counted._jdf.queryExecution().executedPlan().toString()


def test_portfolio(spark):
    day = datetime.date(2024, 1, 30)
    rows = [("a", day - datetime.timedelta(i)) for i in range(8)] + [("b", day - datetime.timedelta(i)) for i in range(3)] + [("c", day)] + [("d", day - datetime.timedelta(20))]
    got = {r.signal: r.status for r in questions.portfolio(spark.createDataFrame(rows, "signal string, day date"), day).collect()}
    assert got == {"a": "confirmed", "b": "emerging", "c": "watching", "d": "dismissed"}


def test_streams_equal_batches(spark, small, tmp_path):
    events = spark.read.parquet(f"{small}/events.parquet")
    events.repartition(3).write.parquet(str(tmp_path / "e"))
    live = windows.stream(spark, str(tmp_path / "e"))
    got = windows.run_once(windows.tumbling(live), "tumbled").withColumn("value", F.round("value", 6))
    want = windows.tumbling(events.withColumn("ts", F.col("ts").cast("timestamp"))).withColumn("value", F.round("value", 6))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    seen = live.select(F.col("event_type").alias("signal"), F.col("ts").cast("date").alias("day"))
    states = windows.run_once(windows.portfolio(seen), "states", "update").groupBy("signal").agg(F.max("days").alias("days"))
    assert all(r.days >= 7 for r in states.collect())


def test_loess_by_least_squares():
    rng = np.random.default_rng(0)
    x, y, w = np.arange(40.0), rng.normal(size=40), rng.uniform(0.1, 1, 40)
    got = grouped.loess(x, y, 9, weights=w)
    for i in range(40):
        d = np.abs(x - i)
        near = np.argsort(d, kind="stable")[:9]
        k = np.sqrt(np.clip(1 - (d / (d[near].max() * 1.001)) ** 3, 0, None) ** 3 * w)
        a = np.column_stack([np.ones(40), x - i])
        assert abs(got[i] - np.linalg.lstsq(a * k[:, None], y * k, rcond=None)[0][0]) < 1e-8


def test_robust_decomposition():
    t = np.arange(84.0)
    week = np.tile([4, 1, 0, 0, -1, -1, -3.0], 12)
    x = 50 + 0.3 * t + week + np.random.default_rng(1).normal(size=84) * 0.2
    spoilt = x.copy()
    spoilt[[20, 45]] += [60, -80]
    trend, season, rest = grouped.decompose(spoilt)
    assert np.allclose(trend + season + rest, spoilt)
    assert np.abs(rest[[20, 45]] - [60, -80]).max() < 2 and np.abs(trend - (50 + 0.3 * t)).max() < 1.5 and np.abs(season - week).max() < 1.5
    plain = grouped.decompose(spoilt, robust=0)
    assert np.abs(plain[1] - week).max() > 5  # without weights the outliers bend the season
    flat = grouped.decompose(np.full(30, 5.0))
    assert np.allclose(flat[0], 5) and np.allclose(flat[1], 0) and np.allclose(flat[2], 0)


def test_kernel_pelt_is_optimal():
    import itertools

    rng = np.random.default_rng(4)
    for x in (np.r_[rng.normal(size=10), rng.normal(size=10) * 6, rng.normal(size=11) + 3], rng.normal(size=23), np.ones(30)):
        of, n, penalty = grouped.kernel_cost(x), len(x), np.log(len(x))
        d = (x[:, None] - x[None]) ** 2
        gram = np.exp(-np.clip(d / (np.median(d[np.triu_indices(n, 1)]) or 1), 1e-2, 1e2) * (d > 0))
        assert abs(of(3, 14) - (np.trace(gram[3:14, 3:14]) - gram[3:14, 3:14].sum() / 11)) < 1e-9
        total = lambda cuts: sum(of(a, b) for a, b in itertools.pairwise([0, *cuts, n])) + penalty * len(cuts)  # noqa: B023, E731
        choices = [c for k in range(5) for c in itertools.combinations(range(5, n, 5), k) if all(b - a >= 3 for a, b in itertools.pairwise([0, *c, n]))]
        got = grouped.pelt(x, cost=grouped.kernel_cost, jump=5)
        assert total(got) <= min(map(total, choices)) + 1e-9 and all(c % 5 == 0 for c in got)
    spread = np.r_[rng.normal(size=60) * 0.2, rng.normal(size=60) * 5]  # same mean, other spread: a kernel sees it
    assert grouped.pelt(spread, cost=grouped.kernel_cost, jump=5) == [60]
