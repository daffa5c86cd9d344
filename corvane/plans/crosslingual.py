"""Queries over the cross-language measures."""

from pyspark.sql import functions as F

from ..operators import crosslingual as X
from .registry import query
from .standins import LANGS, articles, sql


@query("m1_language_filter", sql("""
k AS (SELECT language FROM articles GROUP BY language HAVING count(*) >= 100)
SELECT language, count(*) AS n FROM articles WHERE language IN (SELECT language FROM k) GROUP BY language"""))
def language_filter(spark, sf):
    return X.frequent_languages(articles(spark, sf), 100).groupBy("language").agg(F.count("*").alias("n"))


_JSD = """
n AS (SELECT day, language, topic_id, count(*) AS n FROM articles WHERE topic_id >= 0 GROUP BY ALL),
s AS (SELECT day, language, topic_id, n / sum(n) OVER (PARTITION BY day, language) AS p FROM n),
l AS (SELECT DISTINCT day, language FROM s), t AS (SELECT DISTINCT day, topic_id FROM s),
f AS (SELECT a.day, a.language AS lang_a, b.language AS lang_b, coalesce(x.p, 0) AS p, coalesce(y.p, 0) AS q
  FROM l a JOIN l b ON a.day = b.day AND a.language < b.language JOIN t ON t.day = a.day
  LEFT JOIN s x ON x.day = a.day AND x.language = a.language AND x.topic_id = t.topic_id
  LEFT JOIN s y ON y.day = a.day AND y.language = b.language AND y.topic_id = t.topic_id),
j AS (SELECT day, lang_a, lang_b, sum((CASE WHEN p > 0 THEN p * ln(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * ln(2 * q / (p + q)) ELSE 0 END) / 2) AS jsd FROM f GROUP BY ALL)"""


@query("m1_topic_divergence", sql(_JSD + " SELECT day, lang_a, lang_b, round(jsd, 6) AS jsd FROM j"))
def divergence(spark, sf):
    return X.divergence(articles(spark, sf)).withColumn("jsd", F.round("jsd", 6))


@query("m1_divergence_spikes", sql(_JSD + """, b AS (SELECT *, avg(jsd) OVER (PARTITION BY lang_a, lang_b ORDER BY day ROWS BETWEEN 13 PRECEDING AND CURRENT ROW) AS baseline FROM j)
SELECT day, lang_a, lang_b, round(baseline, 6) AS baseline, round(jsd - baseline, 5) + 0.0 AS delta, jsd - baseline > 0.15 AS is_spike FROM b"""))
def spikes(spark, sf):
    return X.spikes(X.divergence(articles(spark, sf))).select("day", "lang_a", "lang_b", F.round("baseline", 6).alias("baseline"), (F.round("delta", 5) + F.lit(0.0)).alias("delta"), "is_spike")


@query("m1_sentiment_distance", sql("""
n AS (SELECT topic_id, language, sentiment_score AS x, count(*) AS n FROM articles WHERE topic_id >= 0 GROUP BY ALL),
m AS (SELECT *, sum(n) OVER (PARTITION BY topic_id, language) AS total FROM n), k AS (SELECT * FROM m WHERE total >= 10),
l AS (SELECT DISTINCT topic_id, language FROM k),
p AS (SELECT a.topic_id, a.language AS lang_a, b.language AS lang_b FROM l a JOIN l b ON a.topic_id = b.topic_id AND a.language < b.language),
s AS (SELECT p.topic_id, lang_a, lang_b, x, sum(CASE WHEN language = lang_a THEN n / total ELSE -n / total END) AS step
  FROM p JOIN k ON k.topic_id = p.topic_id AND k.language IN (lang_a, lang_b) GROUP BY ALL),
w AS (SELECT topic_id, lang_a, lang_b, abs(sum(step) OVER v) AS gap, lead(x) OVER v - x AS width FROM s WINDOW v AS (PARTITION BY topic_id, lang_a, lang_b ORDER BY x))
SELECT topic_id, lang_a, lang_b, round(coalesce(sum(gap * width), 0), 6) AS distance, coalesce(sum(gap * width), 0) > 0.15 AS significant FROM w GROUP BY ALL"""))
def sentiment_distance(spark, sf):
    return X.sentiment_distance(articles(spark, sf)).withColumn("distance", F.round("distance", 6))


_ATT = ", ".join(f"count(*) FILTER (language = '{x}') / sum(count(*) FILTER (language = '{x}')) OVER () AS attention_{x}" for x in LANGS)
_L = sorted(LANGS)
_BEST = lambda f: f"CASE {f}({', '.join('attention_' + x for x in _L)}) " + " ".join(f"WHEN attention_{x} THEN '{x}'" for x in _L) + " END"


@query("m1_attention_gaps", sql(f"""
s AS (SELECT topic_id, {_ATT} FROM articles WHERE topic_id >= 0 GROUP BY topic_id)
SELECT topic_id, {', '.join(f'round(attention_{x}, 6) AS attention_{x}' for x in LANGS)}, {_BEST('greatest')} AS most, {_BEST('least')} AS "least",
  round(greatest({', '.join('attention_' + x for x in _L)}) - least({', '.join('attention_' + x for x in _L)}), 6) AS gap,
  concat_ws(',', {', '.join(f"CASE WHEN attention_{x} < 0.105 THEN '{x}' END" for x in _L)}) AS blind_spots FROM s"""))
def attention_gaps(spark, sf):
    out = X.attention_gaps(articles(spark, sf), LANGS, blind=0.105)
    return out.select("topic_id", *(F.round(f"attention_{x}", 6).alias(f"attention_{x}") for x in LANGS), "most", "least", F.round("gap", 6).alias("gap"), "blind_spots")


@query("m1_filter_bubble", sql("""
k AS (SELECT language, topic_id FROM articles WHERE topic_id >= 0 GROUP BY ALL HAVING count(*) >= 75),
l AS (SELECT DISTINCT language FROM articles),
i AS (SELECT a.language AS lang_a, b.language AS lang_b,
  (SELECT count(*) FROM k x JOIN k y ON x.topic_id = y.topic_id WHERE x.language = a.language AND y.language = b.language) AS i,
  (SELECT count(DISTINCT topic_id) FROM k WHERE language IN (a.language, b.language)) AS u FROM l a JOIN l b ON a.language < b.language)
SELECT lang_a, lang_b, CASE WHEN u > 0 THEN round(i / u, 6) ELSE 0 END AS jaccard FROM i"""))
def filter_bubble(spark, sf):
    return X.filter_bubble(articles(spark, sf), 75).withColumn("jaccard", F.round("jaccard", 6))
