"""Upserts into partitioned tables and numbering without one task for a group."""

import random

import pytest
from pyspark.sql import functions as F

from corvane.operators import features
from corvane.sources import tables

KIND = "id long, v string, day string"


def files(path):
    return {p: p.stat().st_mtime_ns for p in path.rglob("*.parquet")}


def test_upsert(spark, tmp_path):
    path = tmp_path / "index"
    put = lambda rows: tables.upsert(spark.createDataFrame(rows, KIND), str(path), ["id"], "day")
    have = lambda: sorted(tuple(r) for r in spark.read.schema(KIND).parquet(str(path)).select("id", "v", "day").collect())
    put([(1, "a", "d1"), (2, "b", "d1"), (1, "c", "d2"), (7, None, "d3")])
    before = files(path)
    put([(2, "B", "d1"), (3, "x", "d1"), (3, "x", "d1"), (9, "n", None)])
    want = [(1, "a", "d1"), (1, "c", "d2"), (2, "B", "d1"), (3, "x", "d1"), (7, None, "d3")]
    assert have() == sorted(want)
    after = files(path)
    assert {p: t for p, t in before.items() if "d1" not in str(p)} == {p: t for p, t in after.items() if "d1" not in str(p)}  # other days are not written
    put([(2, "B", "d1"), (3, "x", "d1")])
    assert have() == sorted(want)  # again: no change
    fail = F.udf(lambda v: 1 / 0 if v == "Z" else v)
    with pytest.raises(Exception, match="ZeroDivision"):
        tables.upsert(spark.createDataFrame([(1, "y", "d2"), (5, "Z", "d1")], KIND).withColumn("v", fail("v")), str(path), ["id"], "day")
    assert have() == sorted(want)  # a run that fails on the way leaves all as it was
    put([(1, "y", "d2"), (5, "Z", "d1")])
    assert (1, "y", "d2") in have() and len(have()) == 6
    put([])
    assert len(have()) == 6


def test_numbered(spark):
    rng = random.Random(0)
    rows = [("big" if i % 3 else f"g{i % 11}", rng.randrange(50), i) for i in range(2000)]
    df = spark.createDataFrame(rows, "g string, x int, i int").repartition(6)
    got = {r.i: r.k for r in tables.numbered(df, "g", ["x", "i"]).collect()}
    want = {}
    for g in {r[0] for r in rows}:
        for k, (_, i) in enumerate(sorted((x, i) for h, x, i in rows if h == g)):
            want[i] = k + 1
    assert got == want
    assert tables.numbered(df.where("false"), "g", ["x"]).count() == 0


def test_no_window_over_a_topic(spark):
    """Neighbours in order, vocabularies and frames: no plan sorts a group in one task or joins all sources with all terms."""
    rows = spark.createDataFrame([(1, i, f"s{i % 3}", 0.5 - (i % 2)) for i in range(50)], "topic_id int, article_id long, source string, sentiment_score double")
    plan = features.contradictions(rows)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    counts = spark.createDataFrame([("a", "t", 1), ("b", "t", 2), ("c", "u", 3)], "source string, term string, n long")
    got = {(r.a, r.b): r.kl for r in features.frame_divergence(counts).collect()}
    full = lambda p, q: sum((x - y) * __import__("math").log(x / y) for x, y in zip([v + 1e-10 for v in p], [v + 1e-10 for v in q], strict=True)) / 2
    assert got == {("a", "b"): pytest.approx(0, abs=1e-9), ("a", "c"): pytest.approx(full([1, 0], [0, 1])), ("b", "c"): pytest.approx(full([1, 0], [0, 1]))}
