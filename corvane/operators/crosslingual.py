"""Cross-language measures: divergence of topic shares, sentiment distance, attention gaps, filter bubbles."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import stats


def frequent_languages(articles: DataFrame, least: int) -> DataFrame:
    """The articles of languages that have ``least`` articles or more."""
    kept = articles.groupBy("language").count().where(F.col("count") >= least).select("language")
    return articles.join(F.broadcast(kept), "language", "left_semi")  # one row a language


def divergence(articles: DataFrame) -> DataFrame:
    """``day, lang_a, lang_b, jsd``: Jensen-Shannon divergence of the languages' topic shares (outliers aside) by day."""
    n = articles.where("topic_id >= 0").groupBy("day", "language", "topic_id").agg(F.count("*").alias("n"))
    share = n.withColumn("p", F.col("n") / F.sum("n").over(Window.partitionBy("day", "language"))).select("day", "language", "topic_id", "p")
    langs = share.select("day", "language").distinct()
    pairs = langs.toDF("day", "lang_a").join(langs.toDF("day", "lang_b"), "day").where("lang_a < lang_b")
    topics = share.select("day", "topic_id").distinct()
    full = pairs.join(topics, "day")
    full = full.join(share.toDF("day", "lang_a", "topic_id", "p"), ["day", "lang_a", "topic_id"], "left").join(share.toDF("day", "lang_b", "topic_id", "q"), ["day", "lang_b", "topic_id"], "left")
    return full.groupBy("day", "lang_a", "lang_b").agg(F.sum(stats.jsd_term(F.coalesce("p", F.lit(0.0)), F.coalesce("q", F.lit(0.0)))).alias("jsd"))


def spikes(jsd: DataFrame, rows: int = 14, cut: float = 0.15) -> DataFrame:
    """``baseline`` (mean of this and the preceding rows of the pair), ``delta`` and ``is_spike``."""
    w = Window.partitionBy("lang_a", "lang_b").orderBy("day").rowsBetween(1 - rows, 0)
    out = jsd.withColumn("baseline", F.avg("jsd").over(w))
    return out.withColumn("delta", F.col("jsd") - F.col("baseline")).withColumn("is_spike", F.col("delta") > cut)


def sentiment_distance(articles: DataFrame, least: int = 10, cut: float = 0.15) -> DataFrame:
    """``topic_id, lang_a, lang_b, distance, significant``: Wasserstein-1 distance of sentiment samples with ``least`` articles each.

    From cumulative shares over the merged values; values are counted before they meet.
    """
    n = articles.where("topic_id >= 0 and sentiment_score is not null").groupBy("topic_id", "language", F.col("sentiment_score").alias("x")).agg(F.count("*").alias("n"))
    n = n.withColumn("total", F.sum("n").over(Window.partitionBy("topic_id", "language"))).where(F.col("total") >= least)
    langs = n.select("topic_id", "language").distinct()
    pairs = langs.toDF("topic_id", "lang_a").join(langs.toDF("topic_id", "lang_b"), "topic_id").where("lang_a < lang_b")
    both = pairs.join(n, "topic_id").where("language = lang_a or language = lang_b")
    both = both.withColumn("step", F.when(F.col("language") == F.col("lang_a"), F.col("n") / F.col("total")).otherwise(-F.col("n") / F.col("total")))
    at = both.groupBy("topic_id", "lang_a", "lang_b", "x").agg(F.sum("step").alias("step"))
    w = Window.partitionBy("topic_id", "lang_a", "lang_b").orderBy("x")
    at = at.withColumn("gap", F.abs(F.sum("step").over(w))).withColumn("width", F.lead("x").over(w) - F.col("x"))
    out = at.groupBy("topic_id", "lang_a", "lang_b").agg(F.coalesce(F.sum(F.col("gap") * F.col("width")), F.lit(0.0)).alias("distance"))
    return out.withColumn("significant", F.col("distance") > cut)


def attention_gaps(articles: DataFrame, languages: list[str], blind: float = 0.005) -> DataFrame:
    """Share of each language's articles that a topic has: ``attention_LANG`` columns, ``gap``, ``most``, ``least`` and ``blind_spots``."""
    n = articles.where("topic_id >= 0").groupBy("topic_id").pivot("language", languages).count().na.fill(0)
    w = Window.partitionBy()  # one row a topic
    shares = n.select("topic_id", *((F.col(x) / F.sum(x).over(w)).alias(f"attention_{x}") for x in languages))
    each = F.array(*(F.struct(F.col(f"attention_{x}").alias("share"), F.lit(x).alias("language")) for x in sorted(languages)))
    best = F.array_sort(each, lambda a, b: F.when(a["share"] < b["share"], 1).when(a["share"] > b["share"], -1).when(a["language"] > b["language"], 1).otherwise(-1))
    worst = F.array_sort(each)
    out = shares.withColumn("most", best[0]["language"]).withColumn("least", worst[0]["language"]).withColumn("gap", best[0]["share"] - worst[0]["share"])
    return out.withColumn("blind_spots", F.array_join(F.transform(F.filter(each, lambda x: x["share"] < blind), lambda x: x["language"]), ","))


def filter_bubble(articles: DataFrame, least: int = 5) -> DataFrame:
    """``lang_a, lang_b, jaccard``: overlap of the topics with ``least`` articles in each language."""
    kept = articles.where("topic_id >= 0").groupBy("language", "topic_id").count().where(F.col("count") >= least)
    sets = articles.select("language").distinct().join(kept.groupBy("language").agg(F.collect_set("topic_id").alias("t")), "language", "left").withColumn("t", F.coalesce("t", F.array().cast("array<int>")))
    pairs = sets.toDF("lang_a", "a").join(sets.toDF("lang_b", "b"), F.col("lang_a") < F.col("lang_b"))
    return pairs.select("lang_a", "lang_b", stats.jaccard(F.col("a"), F.col("b")).alias("jaccard"))
