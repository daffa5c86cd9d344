"""Queries over signals, grouped numeric work, windows in event time, and the documented ad-hoc SQL."""

from pyspark.sql import functions as F

from ..operators import grouped as P
from ..operators import series as S
from ..operators import signals as L
from ..streaming import windows as W
from .registry import query
from .standins import articles, sql, table


def _volume(spark, sf):
    return S.daily(articles(spark, sf)).where("metric = 'volume'").select("series", "day", "value")


@query("s5_bursts")
def bursts(spark, sf):
    return P.bursts(_volume(spark, sf))


@query("s5_changepoints")
def changepoints(spark, sf):
    """Of every measure's daily series."""
    daily = S.daily(articles(spark, sf)).select(F.concat_ws(":", "series", "metric").alias("series"), "day", "value")
    return P.changepoints(daily)


@query("s5_decomposition")
def decomposition(spark, sf):
    return P.decomposition(_volume(spark, sf)).select("series", "day", *(F.round(c, 6).alias(c) for c in ("trend", "seasonal", "residual")))


@query("m4_cycles")
def cycles(spark, sf):
    return P.cycles(_volume(spark, sf))


@query("s6_causality")
def causality(spark, sf):
    return P.causality(_volume(spark, sf).where("series <> 'all'")).withColumn("p", F.round("p", 9)).withColumn("strength", F.round("strength", 9))


@query("s6_alignment")
def alignment(spark, sf):
    return P.alignment(_volume(spark, sf).where("series <> 'all'"))


_F = """f AS (SELECT topic_id, CAST(count(*) % 7 AS DOUBLE) AS volume_zscore, CAST(count(*) % 5 AS DOUBLE) AS burst_score, CAST(count(*) % 11 AS DOUBLE) AS days_above, CAST(count(*) % 10 AS DOUBLE) / 10 AS changepoint_significance,
  0.2::DOUBLE AS modularity_delta, 0.4::DOUBLE AS embedding_drift, 100.0::DOUBLE AS dominant_period, max(novelty_score) AS novelty_score, CAST(count(DISTINCT steeps_category) AS DOUBLE) AS cross_domain_count, CAST(count(*) % 9 AS DOUBLE) / 9 AS ood_score,
  CAST(count(*) % 2 AS DOUBLE) AS bertrend_transition, 0.6::DOUBLE AS entropy_spike, CAST(count(*) % 3 AS DOUBLE) / 3 AS network_anomaly, 30.0::DOUBLE AS span_days FROM articles GROUP BY topic_id),
c AS (SELECT *, least(1, 0.20 * ood_score + 0.15 * changepoint_significance + 0.20 * cross_domain_count / 6 + 0.15 * bertrend_transition + 0.10 * entropy_spike + 0.10 * novelty_score + 0.10 * network_anomaly) AS composite,
  CAST(ood_score > 0.7 OR novelty_score > 0.7 AS INT) + CAST(changepoint_significance > 0.8 AS INT) + CAST(bertrend_transition = 1 AND cross_domain_count / 6 > 0.3 AS INT) AS pathways FROM f),
l AS (SELECT *, CASE WHEN novelty_score > 0.7 AND cross_domain_count >= 2 AND composite >= 0.65 AND pathways >= 2 THEN 'L5_singularity' WHEN days_above >= 7 THEN 'L2_short' WHEN volume_zscore > 3 AND burst_score > 2 THEN 'L1_fad' END AS signal_layer FROM c)"""


@query("s7_layers", sql(_F + """ SELECT topic_id, signal_layer, round(composite, 6) AS composite, pathways,
  round(least(1, 0.5 + 0.5 * CASE signal_layer WHEN 'L5_singularity' THEN (composite - 0.65) / 0.65 WHEN 'L2_short' THEN (days_above - 7) / 7 ELSE (volume_zscore - 3) / 3 END), 6) + 0.0 AS confidence FROM l WHERE signal_layer IS NOT NULL"""))
def layers(spark, sf):
    n = F.count("*")
    f = articles(spark, sf).groupBy("topic_id").agg(
        (n % 7).cast("double").alias("volume_zscore"), (n % 5).cast("double").alias("burst_score"), (n % 11).cast("double").alias("days_above"), ((n % 10).cast("double") / 10).alias("changepoint_significance"),
        F.lit(0.2).alias("modularity_delta"), F.lit(0.4).alias("embedding_drift"), F.lit(100.0).alias("dominant_period"), F.max("novelty_score").alias("novelty_score"), F.countDistinct("steeps_category").cast("double").alias("cross_domain_count"),
        ((n % 9).cast("double") / 9).alias("ood_score"), (n % 2).cast("double").alias("bertrend_transition"), F.lit(0.6).alias("entropy_spike"), ((n % 3).cast("double") / 3).alias("network_anomaly"), F.lit(30.0).alias("span_days"),
    )
    f = f.withColumns({"ma_signal": F.lit("rising"), "steeps_shift": F.lit(False), "frame_divergence": F.lit(False), "emotion_shift": F.lit(True)})
    return L.best(L.classify(f)).select("topic_id", "signal_layer", F.round("composite", 6).alias("composite"), "pathways", (F.round("confidence", 6) + F.lit(0.0)).alias("confidence"))


@query("s7_survival", """
WITH d AS (SELECT user_id, CAST(max(CAST(ts AS DATE)) - min(CAST(ts AS DATE)) AS INT) AS t, max(CAST(ts AS DATE)) < DATE '2024-01-30' AS ended FROM events WHERE event_type = 'error' GROUP BY 1),
n AS (SELECT t, CAST(sum(CAST(ended AS INT)) AS BIGINT) AS deaths, count(*) AS gone FROM d GROUP BY t), r AS (SELECT *, CAST(sum(gone) OVER (ORDER BY t DESC) AS BIGINT) AS at_risk FROM n)
SELECT t, at_risk, deaths, round(CASE WHEN max(CAST(deaths = at_risk AS INT)) OVER (ORDER BY t) = 1 THEN 0 ELSE exp(sum(CASE WHEN deaths = at_risk THEN 0 ELSE ln(1 - deaths / at_risk) END) OVER (ORDER BY t)) END, 6) AS survival FROM r""")
def survival(spark, sf):
    day = F.col("ts").cast("date")
    d = table(spark, sf, "events").where("event_type = 'error'").groupBy("user_id").agg(F.datediff(F.max(day), F.min(day)).alias("duration"), (F.max(day) < F.lit("2024-01-30").cast("date")).alias("ended"))
    return L.survival(d).withColumn("survival", F.round("survival", 6))


def _events(spark, sf):
    return table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))


@query("t7_tumbling", "SELECT CAST(ts AS DATE) AS start, event_type, count(*) AS n, round(sum(value), 4) AS value FROM events GROUP BY 1, 2")
def tumbling(spark, sf):
    return W.tumbling(_events(spark, sf)).select(F.col("start").cast("date").alias("start"), "event_type", "n", F.round("value", 4).alias("value"))


@query("t7_sliding", """WITH d AS (SELECT CAST(ts AS DATE) AS day, event_type FROM events), s AS (SELECT CAST(unnest(generate_series(day - INTERVAL 6 DAY, day, INTERVAL 1 DAY)) AS DATE) AS start, event_type FROM d) SELECT start, event_type, count(*) AS n FROM s GROUP BY 1, 2""")
def sliding(spark, sf):
    return W.sliding(_events(spark, sf)).withColumn("start", F.col("start").cast("date"))


@query("t7_sessions", """
WITH l AS (SELECT user_id, ts, coalesce(ts - lag(ts) OVER w >= INTERVAL 30 MINUTE, true) AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), s AS (SELECT *, sum(CAST(new AS INT)) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM l)
SELECT user_id, epoch_us(min(ts)) AS start, epoch_us(max(ts)) + 1800000000 AS "end", count(*) AS n FROM s GROUP BY user_id, k""")
def sessions(spark, sf):
    return W.sessions(_events(spark, sf)).select("user_id", F.unix_micros("start").alias("start"), F.unix_micros("end").alias("end"), "n")


@query("t2_unique", "SELECT user_id, event_type FROM events GROUP BY 1, 2")
def unique(spark, sf):
    return W.unique(_events(spark, sf), ["user_id", "event_type"]).select("user_id", "event_type")


# The documented ad-hoc SQL, as Spark runs it.
_ADHOC = {
    "sql_sentiment_by_source": "SELECT source, CASE WHEN sentiment_score > 0.1 THEN 'positive' WHEN sentiment_score < -0.1 THEN 'negative' ELSE 'neutral' END AS sentiment_label, count(*) AS n FROM articles GROUP BY ALL ORDER BY n DESC",
    "sql_positive_top": "SELECT article_id, title, sentiment_score FROM articles WHERE sentiment_score > 0.1 ORDER BY sentiment_score DESC, article_id LIMIT 10",
    "sql_topic_counts": "SELECT topic_id, topic_label, count(*) AS n FROM articles WHERE topic_id <> -1 GROUP BY topic_id, topic_label",
    "sql_daily_rollup": "SELECT source_region, language, count(*) AS n FROM articles GROUP BY ROLLUP (source_region, language)",
    "sql_cube": "SELECT source_tier, source_lean, count(*) AS n FROM articles GROUP BY CUBE (source_tier, source_lean)",
    "sql_title_filter": "SELECT title, count(*) AS n FROM articles WHERE title LIKE '%market%' GROUP BY title",
}
for _name, _text in _ADHOC.items():

    def _run(spark, sf, _text=_text):
        return spark.sql(_text.replace("FROM articles", "FROM {articles}"), articles=articles(spark, sf))

    query(_name, sql(_text))(_run)


@query("s179_failures_by_type", "SELECT user_id, count(*) FILTER (event_type = 'error') AS errors, count(*) AS n, count(*) FILTER (event_type = 'error') / count(*) >= 0.25 AS blocked FROM events GROUP BY user_id")
def failures(spark, sf):
    e = F.col("event_type") == "error"
    return table(spark, sf, "events").groupBy("user_id").agg(F.sum(e.cast("int")).alias("errors"), F.count("*").alias("n")).withColumn("blocked", F.col("errors") / F.col("n") >= 0.25)


@query("r1_weekly_index", """WITH d AS (SELECT CAST(ts AS DATE) AS day, round(avg(value), 6) AS v FROM events GROUP BY 1), w AS (SELECT isoyear(day) * 100 + weekofyear(day) AS w, * FROM d)
SELECT CAST(w AS BIGINT) AS week, round(avg(v), 5) AS mean, arg_max(day, {'v': v, 'd': day}) AS peak, CASE WHEN arg_max(v, day) - arg_min(v, day) > 3 THEN 'up' WHEN arg_max(v, day) - arg_min(v, day) < -3 THEN 'down' ELSE 'flat' END AS trend FROM w GROUP BY w""")
def weekly_index(spark, sf):
    d = table(spark, sf, "events").groupBy(F.col("ts").cast("date").alias("day")).agg(F.round(F.avg("value"), 6).alias("v"))
    d = d.withColumn("week", (F.extract(F.lit("YEAROFWEEK"), F.col("day")) * 100 + F.extract(F.lit("WEEK"), F.col("day"))).cast("bigint"))
    change = F.max_by("v", "day") - F.min_by("v", "day")
    return d.groupBy("week").agg(F.round(F.avg("v"), 5).alias("mean"), F.max_by("day", F.struct("v", "day")).alias("peak"), F.when(change > 3, "up").when(change < -3, "down").otherwise("flat").alias("trend"))


@query("r13_answer_history", "SELECT CAST(ts AS DATE) AS day, count(*) FILTER (event_type = 'click') AS click, count(*) FILTER (event_type = 'error') AS error, count(*) FILTER (event_type = 'view') AS \"view\" FROM events GROUP BY 1")
def answer_history(spark, sf):
    return table(spark, sf, "events").groupBy(F.col("ts").cast("date").alias("day")).pivot("event_type", ["click", "error", "view"]).count().na.fill(0)
