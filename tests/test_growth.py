"""Steps whose memory or time grew with all rows: what they pass on, and that results stay the same."""

import hashlib
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corvane.functions import text
from corvane.operators import entities, graph


def _union(edges):
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        up[y] = x
    return {x: root(x) for x in list(up)}


def test_components_pass_on_few_edges_for_each_node(spark, monkeypatch):
    rng = random.Random(3)
    edges = [(rng.randrange(100) + 1000 * k, -1 - rng.randrange(100) - 1000 * k) for k in range(3) for _ in range(6000)]
    seen, settle = [], graph.settle
    monkeypatch.setattr(graph, "settle", lambda df: seen.append(settle(df)) or seen[-1])
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long").repartition(2)).collect()}
    assert got == _union(edges) and max(x.count() for x in seen) <= 4 * len(got)


@pytest.mark.parametrize("kind", ["string", "long", "struct<x: long>"])
def test_components_of_pieces(spark, monkeypatch, kind):
    """Paths over many pieces, repeated edges, loops, nulls, and nodes that are no atoms."""
    monkeypatch.setattr(graph, "AT_ONCE", 7)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 5)
    try:
        rng = random.Random(4)
        edges = [(f"n{i:03}", f"n{i + 1:03}") for i in range(60)] + [(f"é{i % 5}", f"é{i % 7}") for i in range(40)] + [("z", "z")] * 3 + [(f"r{rng.randrange(90)}", f"r{rng.randrange(90)}") for _ in range(60)]
        rng.shuffle(edges)
        number = {x: i for i, x in enumerate(sorted({x for e in edges for x in e}))}
        made = [(number[a], number[b]) for a, b in edges] if kind != "string" else edges
        df = spark.createDataFrame([*made, (made[0][0], None), (None, made[1][0])], "a string, b string" if kind == "string" else "a long, b long").repartition(3)
        if kind.startswith("struct"):
            df = df.select(*(F.when(F.col(c).isNotNull(), F.struct(F.col(c).alias("x"))).alias(c) for c in "ab"))
        got = [(r.node, r.component) for r in graph.components(df).collect()]
        got = [(a.x, b.x) for a, b in got] if kind.startswith("struct") else got
        assert dict(got) == _union(made) and len(got) == len(dict(got))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_components_of_no_edges(spark):
    assert graph.components(spark.createDataFrame([], "a long, b int")).count() == 0
    assert graph.components(spark.createDataFrame([(1, None)], "a long, b int")).count() == 0


def _simhash(texts):
    """What the fingerprint is, for plain lower case words and for characters."""
    out = []
    for t, by_characters in texts:
        w = t.split()
        c = "".join(w)
        grams = [c[i : i + 2] for i in range(len(c) - 1)] if by_characters else [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else w
        sums = [0] * 64
        for g in grams:
            h = int.from_bytes(hashlib.sha256(g.encode()).digest()[:8], "big")
            for i in range(64):
                sums[i] += 1 if h >> i & 1 else -1
        v = sum(1 << i for i in range(64) if sums[i] > 0)
        out.append(v - (1 << 64) if v >> 63 else v)
    return out


def test_fingerprints_over_arrow_batches(spark):
    """Words, characters, few words, no words, very many grams, and scripts that share letters of both kinds."""
    rng = random.Random(5)
    many = " ".join(rng.choices(["a", "bc", "déf", "ghij", "klm"], k=70_000))
    plain = [(many, False), ("x" * 60, False), ("ab " * 20 + "ñandú", False), ("반도체 수출이 크게 늘어 경제가 성장했다 " * 3, True), ("𠀀漢字かな交じり文 " * 8, True), ("latin letters and only some 漢字 here, as in most of this text".replace(",", ""), False), ("one\ttwo\nthree\x0bfour\x0cfive\rsix " * 4, False)]
    odd = [("!?…" * 30, 0), (None, None), ("short", 0), ("", 0), ("ONE, two;  THREE four! " * 5, _simhash([("one two three four " * 5, False)])[0])]
    rows = [(i, t) for i, (t, _) in enumerate([*plain, *odd])]
    df = spark.createDataFrame(rows, "i int, t string").select("i", text.simhash64(F.col("t")).alias("s"))
    assert {r.i: r.s for r in df.collect()} == dict(enumerate([*_simhash(plain), *(x for _, x in odd)]))
    said = df._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in said and "transform" not in said and "aggregate(" not in said


def test_letters_are_those_of_java(spark):
    """Python and Java agree on which characters that a fingerprint keeps are letters, but for three of Han that Java 17 does not know yet."""
    df = spark.createDataFrame(pa.table({"id": (ids := [i for i in range(0x110000) if not 0xD800 <= i <= 0xDFFF]), "c": [chr(i) for i in ids]}))
    df = df.where(F.col("c").rlike(r"^[\p{L}\p{N}_\s\x{3001}-\x{9FFF}\x{AC00}-\x{D7AF}]$")).select("id", "c", F.col("c").rlike(r"^\p{L}$").alias("letter"))
    ids, _, letters = df.toArrow().to_pydict().values()
    assert len(ids) > 100_000 and {i for i, letter in zip(ids, letters, strict=True) if letter != chr(i).isalpha()} <= {0x9FFD, 0x9FFE, 0x9FFF}


OLD_SCORES = r"\b\d{1,3}\s*[-:]\s*\d{1,3}\b|(?:win|loss|defeat|beat|scored)\b|(?:승리|패배|득점|무승부|승|패)\b|(?:シュート|得点|勝|敗|引き分け)\b|(?:ganó|perdió|empate|gol)\b"
OLD_CLOSING = r"(?:마감|종가|종합지수|코스피|코스닥|나스닥|다우)|(?:close[sd]|closing|market\s+wrap)|(?:\+|-)\s*\d+\.?\d*\s*%|(?:포인트|bp|bps)\s+(?:상승|하락|올랐|내렸)"


def test_noise_rules_are_those_of_one_pattern_each(spark):
    """Against the patterns as one each, over texts of pieces of their words in all cases; rules are not tried where nothing begins."""
    rng = random.Random(6)
    words = [*"win loss defeat beat scored ganó perdió empate gol closes closed closing market wrap bp bps 승리 패배 득점 무승부 승 패 シュート 得点 勝 敗 引き分け 마감 종가 종합지수 코스피 코스닥 나스닥 다우 포인트 상승 하락 올랐 내렸".split(), "3:1", "12 - 7", "-2.5 %", "+3%", "٣:٤", "ſcored", "wın", "WİN", "marKet  wrap", "cloſed"]
    pieces = [*words, *(w[:-1] for w in words), *(w.upper() for w in words), *(w.title() for w in words), "é", "x", "_", "7", "%", "-", ":", ".", "\n", "\u00a0", "\u3000", "\u2028"]
    rows = [(i, "".join(rng.choice(pieces) + rng.choice(["", " ", "  ", "의", "s"]) for _ in range(rng.randrange(1, 4))), "") for i in range(3000)]
    rows += [(i + 3000, w, rng.choice(["", None, " a"])) for i, w in enumerate(pieces)]
    df = spark.createDataFrame(rows, "i int, t string, b string")
    got = df.select(text.noise(F.col("t"), F.col("b"), F.lit("FULL")).alias("n"), "t", "b")
    both = F.concat_ws(" ", "t", F.substring("b", 1, 500))
    hit = lambda c, p: F.when(c.rlike(f"(?iU){p}"), 1).otherwise(0)
    short = (F.length(F.trim("t")) < 15) & (F.length(F.regexp_replace(F.trim("t"), "[^0-9]", "")) > 0.4 * F.length(F.trim("t")))
    n = F.length(F.trim("b"))
    want = 0.35 * hit(both, OLD_SCORES) + 0.30 * hit(both, OLD_CLOSING) + 0.40 * hit(F.col("t"), text.WEATHER) + 0.35 * hit(F.col("t"), text.NOTICES) + F.when(short, 0.25).otherwise(0) + F.when(n < 150, 0.45).when(n < 400, 0.2).otherwise(0)
    said = got.withColumn("w", F.least(want, F.lit(1.0))).collect()
    assert [(r.t, r.b, r.n, r.w) for r in said if abs(r.n - r.w) > 1e-9] == [] and len({round(r.n, 6) for r in said}) > 5
    assert "(?=[" in got._jdf.queryExecution().optimizedPlan().toString()


def test_letters_that_java_takes_for_those_that_words_begin_with(spark):
    df = spark.createDataFrame(pa.table({"c": [chr(i) for i in range(0x20, 0x110000) if not 0xD800 <= i <= 0xDFFF]}))
    assert {r.c for r in df.where(F.col("c").rlike("(?iU)^[wldbgpescoaim]$")).collect()} == set("wldbgpescoaimWLDBGPESCOAIM\u017f\u0130\u0131")


def test_profiles_make_groups_before_anything_is_sorted(spark):
    """Against sums in Python, with nulls; mentions are neither sorted nor repeated below the first exchange."""
    rng = random.Random(7)
    some = lambda *x: rng.choice([*x, None])
    rows = [(some(*range(400)), some(-0.5, -0.1, 0.0, 0.1, 0.7) if i % 5 else None, some(1, 2, 3), some("s", "t"), [some("a", "b", "c"), some("d", "e")], [some("a", "d"), f"o{i % 40}"] if i % 7 else None) for i in range(600)]
    rows += [(i, None, None, None, ["quiet"], []) for i in range(12)]
    df = spark.createDataFrame(rows, "article_id long, sentiment_score double, topic_id int, source string, entities_person array<string>, entities_org array<string>").repartition(3)
    found = entities.profiles(df)
    m = {}
    for a, s, t, o, p, g in rows:
        for kind, names in (("person", p), ("org", g)):
            for e in names or []:
                if e is not None:
                    m.setdefault(e, []).append((a, s, t, o, kind))
    want = {}
    for e, x in m.items():
        s, n = [y[1] for y in x if y[1] is not None], len(x)
        share = lambda f: sum(map(f, s)) / len(s) if s else None  # noqa: B023, E731
        first = min((y[0] is not None, y[0] or 0, y[4]) for y in x)
        want[e] = (n, share(float), share(lambda v: v < -0.1), share(lambda v: v > 0.1), len({y[2] for y in x} - {None}), len({y[3] for y in x} - {None}), first[2])
    want = {e: v for e, v in want.items() if v[0] >= 10}
    got = {r.entity: tuple(r)[1:] for r in found.collect()}
    assert set(got) == set(want) and "quiet" in got
    for e, v in want.items():
        assert all(x == y or abs(x - y) < 1e-9 for x, y in zip(got[e], v, strict=True)), e
    lines = found._jdf.queryExecution().sparkPlan().toString().split("\n")
    at = next(i for i, x in enumerate(lines) if "Generate" in x)
    below = lines[max(i for i, x in enumerate(lines[:at]) if "Aggregate" in x) : at]
    assert not any("Expand" in x or "SortAggregate" in x for x in below) and any("HashAggregate" in x for x in below)
