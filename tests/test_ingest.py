"""From raw rows, feeds and logs to articles."""

import datetime
import re

from pyspark.sql import functions as F

from corvane.operators import features, pipeline, signals
from corvane.sources import feeds, tables

BODY = "The minister presented the long awaited budget to parliament on Tuesday and answered questions for more than two hours. "


def raw(spark, rows):
    names = tables.RAW.names
    return spark.createDataFrame([tuple(({"url": "http://x.org/a", "title": "T", "body": BODY, "source_id": "s", "source_name": "S", "language": "en", "published_at": "2026-01-02T03:04:05+09:00"} | r).get(n) for n in names) for r in rows], tables.RAW)


def test_accept(spark):
    rows = [{}, {"title": " "}, {"url": ""}, {"language": "xx", "source_id": "k"}, {"is_paywall_truncated": True}, {"published_at": "nonsense", "category": '["a","b"]'}, {"category": '{"name": "n"}'}, {"category": "plain", "body": None}]
    got = pipeline.accept(raw(spark, rows), {"k": "ko"}).collect()
    assert len(got) == 6
    assert got[0].published_at == datetime.datetime(2026, 1, 1, 18, 4, 5) and got[0].category == "uncategorized" and got[0].evidence_id.startswith("ev:")
    assert got[1].language == "ko" and got[2].body == "" and got[2].content_hash == "" and got[3].published_at is None and got[3].category == "a" and got[3].evidence_id is None
    assert got[4].category == "n" and got[5].category == "plain" and got[5].word_count == 1
    assert pipeline.fresh(pipeline.accept(raw(spark, rows)), "2026-01-03 00:00:00").count() == 1


def test_deduplicate(spark):
    other = "Entirely different words about a football match in the rain that nobody will remember after the weekend ends. "
    rows = [
        {"url": "http://x.org/a?utm_source=1", "title": "Budget passes after debate"}, {"url": "https://www.x.org/a", "title": "Other title here now", "published_at": "2026-01-03T00:00:00Z"},
        {"url": "http://x.org/b", "title": "[Breaking] Budget passes after debate | Site", "published_at": "2026-01-03T00:00:00Z", "body": other},
        {"url": "http://x.org/c", "title": "Something else entirely today", "published_at": "2026-01-04T00:00:00Z"}, {"url": "http://x.org/d", "title": "Rain stops play", "body": other + "x", "published_at": None},
    ]
    a = pipeline.accept(raw(spark, rows))
    assert sorted(r.url for r in pipeline.deduplicate(a).collect()) == ["http://x.org/a?utm_source=1", "http://x.org/d"]
    seen = pipeline.deduplicate(a).select("url_key")
    assert "http://x.org/d" not in {r.url for r in pipeline.deduplicate(a, seen).collect()}


def test_merge_and_enrich(spark):
    a = spark.createDataFrame([("1", "s", "x" * 600), ("2", "t", "short")], "article_id string, source string, body string")
    analysis = spark.createDataFrame([("1", 0.5), ("1", 0.1), (None, 0.9)], "article_id string, sentiment_score double")
    named = spark.createDataFrame([("2", ["p"])], "article_id string, entities_person array<string>")
    sources = spark.createDataFrame([("s", "US", "Americas", "major", False)], "source string, source_country string, source_region string, source_tier string, is_paywall boolean")
    got = {r.article_id: r for r in pipeline.enrich(a, analysis, named, sources).collect()}
    assert got["1"].sentiment_score == 0.1 and got["1"].body_quality == "FULL" and got["2"].source_country == "UNKNOWN" and got["2"].sentiment_label == "neutral" and got["2"].entities_person == ["p"]


def test_feeds(spark):
    rss = "<rss><channel><item><title><![CDATA[A & B]]></title><link>http://x.org/1</link><pubDate>Tue, 06 Jan 2026 10:00:00 GMT</pubDate><description>d</description></item><item><title>no link</title></item></channel></rss>"
    atom = '<feed><entry><title>C</title><link href="http://x.org/2"/><updated>2026-01-01T00:00:00Z</updated></entry></feed>'
    df = spark.createDataFrame([(rss,), (atom,), (None,)], "xml string")
    got = sorted((r.title, r.url, str(r.published_at)) for r in feeds.feed_entries(df).collect())
    assert got == [("A & B", "http://x.org/1", "2026-01-06 10:00:00"), ("C", "http://x.org/2", "2026-01-01 00:00:00")]
    assert feeds.feed_entries(df, since="2026-01-05").count() == 1
    site = "<urlset><url><loc>http://x.org/2026/01/05/a</loc></url><url><loc>http://x.org/b</loc><lastmod>2026-01-04</lastmod></url></urlset><sitemapindex><sitemap><loc>http://x.org/m.xml</loc></sitemap></sitemapindex>"
    got = {r.url: (str(r.modified)[:10], r.is_index) for r in feeds.sitemap_urls(spark.createDataFrame([(site,)], "xml string")).collect()}
    assert got == {"http://x.org/2026/01/05/a": ("2026-01-05", False), "http://x.org/b": ("2026-01-04", False), "http://x.org/m.xml": ("None", True)}


def test_diagnose(spark):
    lines = ["12:00 ERROR site=a HTTP 403 forbidden", "12:01 ERROR site=a timed out", "12:02 INFO site=a ok", "12:03 WARNING site=b weird", "ERROR no site"]
    got = {r.site: r for r in feeds.diagnose(spark.createDataFrame([(x,) for x in lines], "value string")).collect()}
    assert (got["a"].blocked, got["a"].timeout, got["b"].other) == (1, 1, 1) and len(got) == 2


def test_outliers_and_states(spark):
    rows = [(i, j, float(abs(i - j))) for i in range(6) for j in range(6) if i != j and abs(i - j) <= 2] + [(9, 4, 50.0), (9, 5, 49.0)]
    lof = {r.id: r.lof for r in signals.local_outlier_factor(spark.createDataFrame(rows, "id int, other int, distance double")).collect()}
    assert max(lof, key=lof.get) == 9 and lof[9] > 5
    got = spark.createDataFrame([(2, 0.0), (8, 0.1), (8, 0.9), (50, 0.0)], "n int, g double").select(signals.bertrend(F.col("n"), F.col("g"))).collect()
    assert [r[0] for r in got] == ["noise", "weak", "emerging", "strong"]


def test_provider(spark):
    df = spark.createDataFrame([("boom and growth",), ("crisis",), ("nothing",)], "text string")
    assert [r.s for r in features.provide(df, "s", "double", None, features.lexicon_sentiment(F.col("text"))).collect()] == [1.0, -1.0, 0.0]


def test_hashed_embedding(spark):
    texts = ["boom and growth", "", None, "word " * 70_000, "Äpfel, äpfel; und-birnen 12", "..."] + [" ".join(f"w{i * j % 97}" for i in range(300)) for j in range(1, 6)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    hashed = spark.createDataFrame([(i, w) for i, t in enumerate(texts) for w in re.split(r"[\W_]+", (t or "").lower()) if w], "doc_id int, w string").select("doc_id", F.xxhash64("w").alias("x"), F.hash("w").alias("h")).collect()
    want = [[0.0] * 8 for _ in texts]
    for r in hashed:
        want[r.doc_id][r.x % 8] += -1.0 if r.h % 2 else 1.0
    for r in features.hashed_embedding(df, size=8).collect():
        v = want[r.doc_id]
        n = sum(x * x for x in v) ** 0.5
        assert r.embedding == [x / n if n else 0.0 for x in v]


def test_deduplicate_loses_no_pair(spark):
    """Titles whose first word has changed, fingerprints at 4 to 10 bits over all blocks, and both from an earlier run."""
    import random

    rng = random.Random(5)
    prints = [rng.getrandbits(63) for _ in range(20)]
    prints += [p ^ sum(1 << b for b in rng.sample(range(63), k)) for p in prints for k in (4, 7, 10, 11)]
    got = {tuple(r) for r in pipeline._near(spark.createDataFrame([(p,) for p in prints], "fingerprint long"), 10).collect()}
    assert got == {(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 10} and got
    rows = [
        {"url": "http://x.org/a", "title": "alpha budget passes after long debate today", "body": ""}, {"url": "http://x.org/b", "title": "alphas budget passes after long debate today", "published_at": "2026-01-03T00:00:00Z", "body": ""},
        {"url": "http://x.org/c", "title": "completely other matters of the sea", "published_at": "2026-01-03T00:00:00Z", "body": ""},
    ]
    a = pipeline.accept(raw(spark, rows))
    kept = pipeline.deduplicate(a)
    assert kept.count() == 2
    late = pipeline.accept(raw(spark, [{"url": "http://x.org/z", "title": "zalpha budget passes after long debate today", "body": ""}, {"url": "http://x.org/y", "title": "nothing like it", "body": ""}]))
    assert [r.url for r in pipeline.deduplicate(late, kept.select("url_key", "form", "fingerprint")).collect()] == ["http://x.org/y"]


def test_enriched_rules(spark):
    from corvane.operators import checks

    good = {c: "x" for c in checks.ENRICHED_NEEDED} | {"body_quality": "FULL", "steeps_primary": "ECO", "signal_type": "TREND", "sentiment_score": 0.1, "extra": 1}
    schema = ", ".join(f"{c} {'double' if c == 'sentiment_score' else 'int' if c == 'extra' else 'string'}" for c in good)
    make = lambda *rows: spark.createDataFrame([tuple((good | r).values()) for r in rows], schema)
    told = lambda df: {(r.rule, r.column): (r.value, r.passed) for r in checks.enriched_report(df).collect()}
    fine = told(make({}, {}))
    assert len(fine) == 2 + 11 + 3 + 2 and all(passed for _, passed in fine.values())
    bad = told(make({"url": None}, {"body_quality": None}, {"body_quality": "?", "geo_focus_primary": "UNKNOWN"}, {"sentiment_score": None}))
    assert {k: v for k, v in bad.items() if not v[1]} == {("EN3", "url"): (1, False), ("EN3", "body_quality"): (1, False), ("EN4", "body_quality"): (2, False)}
    assert bad["EN7", "geo_focus_primary"] == (0.25, True) and bad["EN8", "sentiment_score"] == (0.25, True)
    most = told(make(*[{"geo_focus_primary": "UNKNOWN", "sentiment_score": None}] * 3, {}))
    assert not most["EN7", "geo_focus_primary"][1] and not most["EN8", "sentiment_score"][1]
    assert told(make({}).where("false")) == {("EN1", None): (0, True), ("EN2", None): (1, False)}
    assert told(None) == {("EN1", None): (0, False)}
    less = told(make({}).drop("url", "signal_type", "sentiment_score"))
    assert less["EN3", "url"] == (None, False) and ("EN6", "signal_type") not in less and ("EN8", "sentiment_score") not in less
    values = spark.createDataFrame([(v, None) for v in "aabbbccddeeffgghhiij"] + [("", "")], "a string, b string")
    assert [(r.value, r.n) for r in checks.commonest(values, ["a", "b", "none"]).orderBy(F.desc("n"), "value").collect()] == [("b", 3)] + [(v, 2) for v in "acdefgh"]
