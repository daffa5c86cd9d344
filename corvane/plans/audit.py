"""Queries that check inputs and outputs, and small aggregates of reports."""

import datetime

from pyspark.sql import functions as F

from ..operators import checks as K
from ..operators import entities, pipeline, rollups
from ..operators import series as S
from ..sources import tables
from .registry import query
from .standins import CODES, EMOTIONS, articles, sql, table

_FILES = ["click", "error", "view", "purchase"]


@query("s7_availability", """
WITH c AS (SELECT CAST(unnest(generate_series(DATE '2024-02-03' - INTERVAL 39 DAY, DATE '2024-02-03', INTERVAL 1 DAY)) AS DATE) AS day), f AS (SELECT CAST(ts AS DATE) AS day, event_type AS f FROM events GROUP BY 1, 2 HAVING sum(value) > 0),
h AS (SELECT day, count(*) FILTER (f IN ('click', 'error', 'view', 'purchase')) AS n, count(*) FILTER (f IN ('click', 'error')) AS e FROM f GROUP BY day)
SELECT c.day, coalesce(n, 0) AS n_files, CASE WHEN coalesce(e, 0) = 2 AND n >= 3 THEN 'available' WHEN coalesce(n, 0) > 0 THEN 'incomplete' ELSE 'missing' END AS status FROM c LEFT JOIN h ON h.day = c.day""")
def availability(spark, sf):
    files = table(spark, sf, "events").groupBy(F.col("ts").cast("date").alias("day"), F.col("event_type").alias("file")).agg(F.sum("value").alias("size"))
    return K.availability(files, datetime.date(2024, 2, 3), 40, _FILES, _FILES[:2])


def _bad(pairs):
    return " UNION ALL ".join(f"SELECT '{kind}' AS \"check\", '{c}' AS \"column\", CAST(coalesce(sum(CAST({bad} AS INT)), 0) AS BIGINT) AS bad FROM {of}" for kind, c, bad, of in pairs)


@query("s57_analysis_report", sql("""x AS (SELECT *, 1 AS one FROM articles) """ + _bad(
    [("range", "sentiment_score", "sentiment_score < -1 OR sentiment_score > 1", "x"), ("range", "importance_score", "importance_score < 0 OR importance_score > 100", "x")] + [("range", f"emotion_{e}", f"emotion_{e} < 0 OR emotion_{e} > 1", "x") for e in EMOTIONS]
    + [("allowed", "steeps_category", "steeps_category NOT IN ('S', 'T', 'E', 'En', 'P')", "x"), ("needed", "article_id", "article_id IS NULL", "x")]
) + """ UNION ALL SELECT 'distribution', 'sentiment_score', CAST(CASE WHEN count(*) > 10 AND avg(CAST(abs(sentiment_score) <= 0.1 AS INT)) > 0.95 THEN 1 ELSE 0 END AS BIGINT) FROM x
UNION ALL SELECT 'coverage', 'steeps_category', CASE WHEN count(*) > 50 THEN 5 - count(DISTINCT steeps_category) FILTER (steeps_category <> 'Se') ELSE 0 END FROM x"""))  # fmt: skip
def analysis_report(spark, sf):
    """With one code that is not known, so that a check fails."""
    return K.analysis_report(articles(spark, sf), EMOTIONS, CODES[:5])


@query("s58_ranges", _bad([("range", "quality", "quality < 0 OR quality > 0", "labels"), ("range", "toxic", "toxic < 0 OR toxic > 1", "labels"), ("needed", "doc_id", "doc_id IS NULL", "labels"), ("needed", "quality", "quality IS NULL", "labels")]))
def ranges(spark, sf):
    return K.out_of_range(table(spark, sf, "labels"), {"quality": (0, 0), "toxic": (0, 1)}, needed=["doc_id", "quality"])


@query("s59_metric_ranges", sql("""h AS (SELECT topic_id, entity, count(*) AS n FROM (SELECT topic_id, unnest(entities_person) AS entity FROM articles) GROUP BY ALL), s AS (SELECT topic_id, sum(n * n) / (sum(n) * sum(n)) AS hhi FROM h GROUP BY topic_id)
""" + _bad([("range", "hhi", "hhi < 0 OR hhi > 0.045", "s")])))  # fmt: skip
def metric_ranges(spark, sf):
    n = articles(spark, sf).select("topic_id", F.explode("entities_person").alias("e")).groupBy("topic_id", "e").agg(F.count("*").alias("n"))
    hhi = n.groupBy("topic_id").agg((F.sum(F.col("n") * F.col("n")) / (F.sum("n") * F.sum("n"))).alias("hhi"))
    return K.out_of_range(hhi, {"hhi": (0.0, 0.045)})


@query("s122_success", """
WITH s AS (SELECT user_id, count(*) AS before, count(*) FILTER (event_type <> 'error') AS after, sum(value) AS seconds, max(value) / 100 AS memory FROM events GROUP BY user_id),
m AS (SELECT round(count(*) FILTER (after > 0) / greatest(count(*), 44) * 100, 2) AS success_rate, CAST(sum(after) AS DOUBLE) AS total_articles, round((sum(before) - sum(after)) / sum(before) * 100, 2) AS dedup_effectiveness, round(avg(seconds) FILTER (seconds > 0), 2) AS avg_crawl_time, round(max(memory), 3) AS peak_memory FROM s)
SELECT 'success_rate' AS metric, success_rate AS value, 80.0::DOUBLE AS mark, success_rate >= 80 AS passed FROM m UNION ALL SELECT 'total_articles', total_articles, 500, total_articles >= 500 FROM m UNION ALL SELECT 'dedup_effectiveness', dedup_effectiveness, 90, dedup_effectiveness >= 90 FROM m
UNION ALL SELECT 'avg_crawl_time', avg_crawl_time, 300, avg_crawl_time <= 300 FROM m UNION ALL SELECT 'peak_memory', peak_memory, 10, peak_memory <= 10 FROM m""")
def success(spark, sf):
    e = F.col("event_type")
    s = table(spark, sf, "events").groupBy(F.col("user_id").alias("site")).agg(F.count("*").alias("before"), F.count(F.when(e != "error", 1)).alias("after"), F.sum("value").alias("seconds"), (F.max("value") / 100).alias("memory"))
    return K.success(s)


@query("s87_group_sums", sql("n AS (SELECT source, count(*) AS n FROM articles GROUP BY source), g(source, \"group\") AS (VALUES ('src0', 'A'), ('src1', 'A'), ('src2', 'B')) SELECT coalesce(g.\"group\", '?') AS \"group\", CAST(sum(n) AS BIGINT) AS n FROM n LEFT JOIN g ON g.source = n.source GROUP BY 1"))
def group_sums(spark, sf):
    groups = spark.createDataFrame([("src0", "A"), ("src1", "A"), ("src2", "B")], "source string, group string")
    n = articles(spark, sf).groupBy("source").agg(F.count("*").alias("n"))
    return rollups.group_sums(n, groups)


@query("s93_source_topics", sql("SELECT source, topic_id, count(*) AS n, min(article_id) AS \"first\", CAST(sum(article_id) AS BIGINT) AS ids FROM articles WHERE topic_id <> -1 GROUP BY ALL"))
def source_topics(spark, sf):
    return rollups.source_topics(articles(spark, sf))


@query("s95_emotion_delta", sql("""d AS (SELECT source, day, """ + ", ".join(f"avg(emotion_{e}) AS {e}" for e in EMOTIONS) + """ FROM articles GROUP BY ALL)
SELECT a.source, a.day, """ + ", ".join(f"round(a.{e} - b.{e}, 9) + 0.0 AS {e}" for e in EMOTIONS) + " FROM d a JOIN d b ON b.source = a.source AND b.day = a.day - 7"))
def emotion_delta(spark, sf):
    d = rollups.emotion_delta(articles(spark, sf))
    return d.select("source", "day", *((F.round(e, 9) + F.lit(0.0)).alias(e) for e in EMOTIONS))


@query("s162_largest", sql("""n AS (SELECT topic_id, count(*) AS n FROM articles WHERE topic_id <> -1 GROUP BY topic_id ORDER BY n DESC, CAST(topic_id AS VARCHAR) LIMIT 3)
SELECT CAST(topic_id AS VARCHAR) AS series, CAST(n AS DOUBLE) AS volume FROM n UNION ALL SELECT 'all', CAST(count(*) AS DOUBLE) FROM articles"""))
def largest(spark, sf):
    kept = S.largest(S.daily(articles(spark, sf)), 3)
    return kept.where("metric = 'volume'").groupBy("series").agg(F.sum("value").alias("volume"))


@query("s70_trajectories", sql("""m AS (SELECT day, language, unnest(entities_org) AS entity FROM articles), t AS (SELECT entity, count(*) AS n FROM m GROUP BY entity), r AS (SELECT entity, count(DISTINCT language) AS languages FROM m WHERE day >= DATE '2024-01-20' AND language <> 'es' GROUP BY entity)
SELECT t.entity, n, coalesce(languages, 0) AS languages FROM t LEFT JOIN r ON r.entity = t.entity"""))
def with_reach(spark, sf):
    m = entities.mentions(articles(spark, sf), {"entities_org": "org"}, ["day", "language"])
    reach = m.where("day >= date'2024-01-20' and language <> 'es'").groupBy("entity").agg(F.countDistinct("language").alias("languages"))
    return rollups.filled(m.groupBy("entity").agg(F.count("*").alias("n")), [reach], "entity", {"languages": 0})


@query("s63_views", sql("SELECT source, topic_id, count(*) AS n FROM articles WHERE language = 'ko' AND source IN ('src1', 'src5', 'src9') AND day BETWEEN DATE '2024-01-08' AND DATE '2024-01-14' GROUP BY ALL"))
def views(spark, sf):
    from ..operators.weekly import period

    return period(articles(spark, sf), "week", "2024-01-10").where(F.col("language") == "ko").where(F.col("source").isin("src1", "src5", "src9")).groupBy("source", "topic_id").agg(F.count("*").alias("n"))


@query("s67_suffixed", sql("SELECT article_id, day AS day_article, day + 1 AS day_part, coalesce(day, day + 1) AS day, topic_id FROM articles"))
def suffixed(spark, sf):
    a = articles(spark, sf)
    return pipeline.inner(a.select("article_id", "day"), a.select("article_id", F.date_add("day", 1).alias("day"), "topic_id")).withColumn("day", F.coalesce("day_article", "day_part"))


@query("s68_four_way", sql("SELECT article_id, sentiment_score, topic_id, len(entities_person) AS n FROM articles WHERE article_id % 2 = 0 AND article_id % 3 = 0 AND article_id % 5 <> 1"))
def four_way(spark, sf):
    a = articles(spark, sf)
    parts = [a.where("article_id % 2 = 0").select("article_id", "sentiment_score"), a.where("article_id % 3 = 0").select("article_id", "topic_id"), a.where("article_id % 5 <> 1").select("article_id", F.size("entities_person").cast("bigint").alias("n"))]
    return pipeline.inner(a.select("article_id"), *parts)


@query("s33_checksum", "SELECT count(*) AS n FROM lineitem")
def checksum(spark, sf):
    return tables.checksum(table(spark, sf, "lineitem")).select("n")


@query("s34_digest", """
WITH r AS (SELECT ('0x' || substr(sha256(concat_ws('|', coalesce(CAST(c_custkey AS VARCHAR), '-'), coalesce(c_name, '-'), coalesce(CAST(c_nationkey AS VARCHAR), '-'), coalesce(c_mktsegment, '-'))), 1, 12))::BIGINT AS h FROM customer)
SELECT count(*) AS n, CAST(sum(h) AS VARCHAR) AS digest FROM r""")
def digest(spark, sf):
    return tables.digest(table(spark, sf, "customer"), ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"])


# An enriched table with what goes wrong in one: missing addresses, codes that nobody knows, places that are not told.
_ENRICHED = """SELECT CONCAT('e', article_id) AS evidence_id, CASE WHEN article_id % 50 <> 0 THEN CONCAT('https://', source, '.org/', article_id) END AS url, source AS source_id, title, language,
  CASE article_id % 11 WHEN 0 THEN 'BROKEN' WHEN 1 THEN NULL WHEN 2 THEN 'PAYWALL' WHEN 3 THEN 'TITLE_ONLY' WHEN 4 THEN 'PARTIAL' ELSE 'FULL' END AS body_quality, source_tier,
  CASE WHEN article_id % 4 < 3 THEN 'UNKNOWN' ELSE geo_focus_primary END AS geo_focus_primary, steeps_primary, CASE WHEN article_id % 3 <> 1 THEN sentiment_score END AS sentiment_score,
  CASE WHEN sentiment_score > 0.1 THEN 'positive' WHEN sentiment_score < -0.1 THEN 'negative' ELSE 'neutral' END AS sentiment_label, signal_type FROM articles"""


def _enriched(spark, sf):
    return spark.sql(_ENRICHED.replace("FROM articles", "FROM {articles}"), articles=articles(spark, sf))


def _rules():
    """The eight rules, each as a SELECT of its own."""
    row = "SELECT '{}' AS rule, {} AS \"column\", CAST({} AS DOUBLE) AS value, '{}' AS level, {} <= {} AS passed FROM e"
    parts = [row.format("EN1", "NULL", "0", "error", "0", 0), row.format("EN2", "NULL", "CAST(count(*) = 0 AS INT)", "error", "CAST(count(*) = 0 AS INT)", 0)]
    for c in K.ENRICHED_NEEDED:
        parts.append(row.format("EN3", f"'{c}'", f"count(*) - count({c})", "error", f"count(*) - count({c})", 0))
    for rule, (c, allowed) in K.ENRICHED_ALLOWED.items():
        known = "count(*) - count(*) FILTER ({} IN ({}))".format(c, ", ".join(f"'{v}'" for v in allowed))
        parts.append(row.format(rule, f"'{c}'", known, "error", known, 0))
    for rule, c, share, most in (("EN7", "geo_focus_primary", "count(*) FILTER (geo_focus_primary = 'UNKNOWN') / count(*)", 0.7), ("EN8", "sentiment_score", "1 - count(sentiment_score) / count(*)", 0.5)):
        parts.append(row.format(rule, f"'{c}'", f"round({share}, 9)", "warning", share, most))
    return " UNION ALL ".join(parts).replace("SELECT 'EN1' AS rule, NULL AS", "SELECT 'EN1' AS rule, CAST(NULL AS VARCHAR) AS").replace("FROM e", "FROM (SELECT count(*) FROM e)", 1)


@query("v60_enriched_rules", sql(f"e AS ({_ENRICHED}) {_rules()}"))
def enriched_rules(spark, sf):
    return K.enriched_report(_enriched(spark, sf)).withColumn("value", F.round("value", 9))


@query("v60_enriched_values", sql(f"e AS ({_ENRICHED}), u AS (" + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {c} AS value FROM e" for c in K.ENRICHED_TOLD) + """),
n AS (SELECT "column", value, count(*) AS n FROM u WHERE value <> '' GROUP BY ALL) SELECT "column", value, n FROM n QUALIFY row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) <= 8"""))
def enriched_values(spark, sf):
    return K.commonest(_enriched(spark, sf), K.ENRICHED_TOLD)
