"""Queries over features, findings and merged tables."""

from pyspark.sql import functions as F

from ..operators import crosslingual, economy, entities, features, pipeline, synthesis
from .registry import query
from .standins import articles, sql, table


def _p(n, digits=6):
    return (F.round(n, digits) + F.lit(0.0)).alias(n)


@query("a26_tfidf", """
WITH w AS (SELECT item_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]{2,}')) AS term FROM benchmark), t AS (SELECT item_id, term, count(*) AS tf FROM w GROUP BY 1, 2), n AS (SELECT count(*) AS n FROM benchmark),
d AS (SELECT term, ln((1 + n) / (1 + count(*))) + 1 AS idf FROM t, n GROUP BY term, n HAVING count(*) >= 2 AND count(*) <= 0.95 * n), x AS (SELECT item_id, t.term, (1 + ln(tf)) * idf AS w FROM t JOIN d ON d.term = t.term),
y AS (SELECT item_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY item_id)) AS weight FROM x), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY round(weight, 9) DESC, term) AS INT) AS rank FROM y)
SELECT item_id, term, round(weight, 6) AS weight, rank FROM r WHERE rank <= 20""")
def tfidf(spark, sf):
    return features.tfidf(table(spark, sf, "benchmark"), key="item_id").withColumn("weight", F.round("weight", 6))


@query("a26_tfidf_documents", """
WITH w AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]{2,}')) AS term FROM documents), t AS (SELECT doc_id, term, count(*) AS tf FROM w GROUP BY 1, 2), n AS (SELECT count(*) AS n FROM documents),
d AS (SELECT term, ln((1 + n) / (1 + count(*))) + 1 AS idf FROM t, n GROUP BY term, n HAVING count(*) >= 2 AND count(*) <= 0.95 * n), x AS (SELECT doc_id, t.term, (1 + ln(tf)) * idf AS w FROM t JOIN d ON d.term = t.term),
y AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM x), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY round(weight, 9) DESC, term) AS INT) AS rank FROM y)
SELECT doc_id, term, round(weight, 6) AS weight, rank FROM r WHERE rank <= 20""")
def tfidf_documents(spark, sf):
    """The corpus; a26_tfidf is over the benchmark's items."""
    return features.tfidf(table(spark, sf, "documents")).withColumn("weight", F.round("weight", 6))


@query("f38_frame_divergence", sql("""
n AS (SELECT source, title AS term, count(*) AS n FROM articles GROUP BY 1, 2), p AS (SELECT source, term, n / sum(n) OVER (PARTITION BY source) AS p FROM n),
f AS (SELECT s.source, t.term, coalesce(p, 0) + 1e-10 AS p FROM (SELECT DISTINCT source FROM n) s CROSS JOIN (SELECT DISTINCT term FROM n) t LEFT JOIN p ON p.source = s.source AND p.term = t.term)
SELECT x.source AS a, y.source AS b, round(sum((x.p - y.p) * ln(x.p / y.p)) / 2, 5) AS kl, round(ln(1 + sum((x.p - y.p) * ln(x.p / y.p)) / 2) / ln(26), 6) AS strength FROM f x JOIN f y ON x.term = y.term AND x.source < y.source GROUP BY 1, 2"""))
def frame_divergence(spark, sf):
    n = articles(spark, sf).groupBy("source", F.col("title").alias("term")).agg(F.count("*").alias("n"))
    return features.frame_divergence(n).select("a", "b", _p("kl", 5), _p("strength"))


@query("a23_evidence_chains", sql("""
e AS (SELECT topic_id, article_id, unnest(list_distinct(list_concat(entities_person, entities_org))) AS e FROM articles WHERE topic_id >= 0), n AS (SELECT topic_id, e, count(*) AS n FROM e GROUP BY 1, 2 HAVING count(*) >= 3),
r AS (SELECT *, row_number() OVER (PARTITION BY topic_id ORDER BY n DESC, e) AS k FROM n)
SELECT topic_id, string_agg(e, '|' ORDER BY k) AS entities, CAST(sum(n) AS BIGINT) AS n, round(least(1, ln(1 + sum(n)) / ln(51)), 6) + 0.0 AS strength FROM r WHERE k <= 5 GROUP BY topic_id"""))
def chains(spark, sf):
    return features.evidence_chains(articles(spark, sf)).withColumn("strength", F.round("strength", 6))


@query("a24_contradictions", sql("""
r AS (SELECT topic_id, article_id, source, sentiment_score AS s, row_number() OVER (PARTITION BY topic_id ORDER BY article_id) AS k FROM articles WHERE topic_id >= 0)
SELECT x.topic_id, x.article_id AS a, y.article_id AS b, round(abs(x.s - y.s) / 2, 6) AS score FROM r x JOIN r y ON x.topic_id = y.topic_id AND y.k > x.k AND y.k < x.k + 20 AND x.source <> y.source AND x.s * y.s < 0 AND abs(x.s - y.s) / 2 >= 0.6"""))
def contradictions(spark, sf):
    return features.contradictions(articles(spark, sf)).withColumn("score", F.round("score", 6))


@query("a29_lexicon_sentiment", sql("""h AS (SELECT article_id, len(regexp_extract_all(lower(title), '\\b(boom|growth|recovery)\\b')) AS p, len(regexp_extract_all(lower(title), '\\b(crisis|crash|war|uncertainty|inflation)\\b')) AS n FROM articles)
SELECT article_id, CASE WHEN p + n > 0 THEN round((p - n) / (p + n), 6) ELSE 0 END + 0.0 AS score FROM h"""))
def lexicon(spark, sf):
    return articles(spark, sf).select("article_id", (F.round(features.lexicon_sentiment(F.col("title")), 6) + F.lit(0.0)).alias("score"))


@query("a34_kmeans")
def kmeans(spark, sf):
    return features.clusters(table(spark, sf, "embeddings")).select("vec_id", "cluster")


@query("a33_topics")
def topics(spark, sf):
    return features.topics(table(spark, sf, "documents"))


@query("a25_hashed_embeddings")
def embedded(spark, sf):
    return features.hashed_embedding(table(spark, sf, "documents"))


@query("m7_findings", sql("""
g AS (SELECT CAST(topic_id AS VARCHAR) AS subject, avg(sentiment_score) AS magnitude FROM articles GROUP BY topic_id), b AS (SELECT entity AS subject, count(*) / (SELECT count(*) FROM articles) AS magnitude FROM (SELECT unnest(entities_org) AS entity FROM articles) GROUP BY 1),
u AS (SELECT 'mood' AS module, * FROM g WHERE abs(magnitude) >= 0.005 UNION ALL SELECT 'names', * FROM b WHERE abs(magnitude) >= 0.005), r AS (SELECT *, row_number() OVER (PARTITION BY module ORDER BY abs(magnitude) DESC, subject) AS k FROM u)
SELECT module, subject, round(magnitude, 9) + 0.0 AS magnitude FROM r WHERE k <= 5"""))
def findings(spark, sf):
    a = articles(spark, sf)
    mood = a.groupBy(F.col("topic_id").alias("subject")).agg(F.avg("sentiment_score").alias("magnitude"))
    n = a.agg(F.count("*").alias("c"))
    names = entities.mentions(a, {"entities_org": "org"}, []).groupBy(F.col("entity").alias("subject")).agg(F.count("*").alias("n")).crossJoin(F.broadcast(n)).select("subject", (F.col("n") / F.col("c")).alias("magnitude"))  # one row
    return synthesis.findings({"mood": mood, "names": names}, least=0.005).select("module", "subject", _p("magnitude", 9))


@query("m7_alerts")
def alerts(spark, sf):
    a = articles(spark, sf)
    return synthesis.alerts(entities.tensions(a), economy.uncertainty(a), economy.sector_sentiment(a), entities.weekly_trajectory(a))


@query("m7_extremes", sql("m AS (SELECT topic_id, avg(importance_score) AS v FROM articles GROUP BY topic_id) SELECT round(avg(v), 6) AS mean, arg_max(topic_id, {'v': v, 't': topic_id}) AS most, arg_min(topic_id, {'v': v, 't': topic_id}) AS \"least\" FROM m"))
def extremes(spark, sf):
    m = articles(spark, sf).groupBy("topic_id").agg(F.avg("importance_score").alias("v"))
    return synthesis.extremes(m, "topic_id", "v").withColumn("mean", F.round("mean", 6))


@query("c121_source_report", sql("SELECT source, count(*) AS n, count(DISTINCT day) AS days, round(avg(word_count), 6) AS words, CAST(sum(CAST(word_count >= 500 AS INT)) AS BIGINT) AS \"full\" FROM articles GROUP BY source"))
def report(spark, sf):
    return articles(spark, sf).groupBy("source").agg(F.count("*").alias("n"), F.countDistinct("day").alias("days"), F.round(F.avg("word_count"), 6).alias("words"), F.sum((F.col("word_count") >= 500).cast("int")).alias("full"))


@query("v62_topic_report", sql("n AS (SELECT topic_id, count(*) AS n FROM articles GROUP BY topic_id) SELECT round(max(n) / sum(n), 6) AS largest, round(sum(CASE WHEN topic_id = -1 THEN n ELSE 0 END) / sum(n), 6) AS noise, max(n) / sum(n) > 0.6 AS too_large, sum(CASE WHEN topic_id = -1 THEN n ELSE 0 END) / sum(n) > 0.5 AS too_noisy FROM n"))
def topic_report(spark, sf):
    return pipeline.topic_report(articles(spark, sf)).withColumn("largest", F.round("largest", 6)).withColumn("noise", F.round("noise", 6))


@query("v61_coverage", sql("SELECT 'source_lean' AS \"column\", round(avg(CAST(source_lean <> 'UNKNOWN' AS INT)), 6) AS share FROM articles UNION ALL SELECT 'signal_type', round(avg(CAST(signal_type <> 'NOISE' AS INT)), 6) FROM articles"))
def coverage(spark, sf):
    return pipeline.coverage(articles(spark, sf), {"source_lean": ["UNKNOWN"], "signal_type": ["NOISE"]}).withColumn("share", F.round("share", 6))


@query("m1_jaccard_sources", sql("s AS (SELECT DISTINCT source, topic_id FROM articles), l AS (SELECT DISTINCT source FROM s) SELECT a.source AS a, b.source AS b, round((SELECT count(*) FROM s x JOIN s y ON x.topic_id = y.topic_id WHERE x.source = a.source AND y.source = b.source) / (SELECT count(DISTINCT topic_id) FROM s WHERE source IN (a.source, b.source)), 6) AS jaccard FROM l a JOIN l b ON a.source < b.source"))
def jaccard_sources(spark, sf):
    return entities.jaccard_of_sets(articles(spark, sf), "source", "topic_id").withColumn("jaccard", F.round("jaccard", 6))


@query("m1_frequent_share", sql("SELECT language, round(count(*) / (SELECT count(*) FROM articles), 6) AS share FROM articles GROUP BY language"))
def frequent_share(spark, sf):
    a = crosslingual.frequent_languages(articles(spark, sf), 1)
    n = a.agg(F.count("*").alias("c"))
    return a.groupBy("language").agg(F.count("*").alias("n")).crossJoin(F.broadcast(n)).select("language", F.round(F.col("n") / F.col("c"), 6).alias("share"))  # one row
