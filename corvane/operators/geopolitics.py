"""Relations between countries and languages: bilateral index, soft power, agenda setting, velocity, conflict."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import stats
from . import entities, narrative

EMOTIONS = ["joy", "trust", "fear", "surprise", "sadness", "disgust", "anger", "anticipation"]


def bilateral(articles: DataFrame, least: int = 10) -> DataFrame:
    """Per unordered country pair with ``least`` articles: how many, mean sentiment, mean emotions."""
    emotions = [f"emotion_{e}" for e in EMOTIONS]
    p = entities.pairs(articles, ["entities_location"], ["sentiment_score", *emotions])
    return p.groupBy("a", "b").agg(F.count("*").alias("n"), *(F.avg(c).alias(c) for c in ["sentiment_score", *emotions])).where(F.col("n") >= least)


def conflict(pairs: DataFrame) -> DataFrame:
    """``ratio`` of (anger + fear) over (trust + anticipation), and its label."""
    ratio = (F.col("emotion_anger") + F.col("emotion_fear")) / (F.col("emotion_trust") + F.col("emotion_anticipation") + 1e-6)
    return pairs.withColumn("ratio", ratio).withColumn("stance", F.when(F.col("ratio") > 1, "conflict").otherwise("cooperation"))


def soft_power(articles: DataFrame) -> DataFrame:
    """A country's visibility, sentiment, frame diversity and degree, weighted .25, .30, .20, .25."""
    named = articles.select("steeps_category", "sentiment_score", F.explode(F.array_distinct("entities_location")).alias("country"))
    base = named.groupBy("country").agg(F.count("*").alias("n"), F.avg("sentiment_score").alias("sentiment"))
    frames = narrative.diversity(named, ["country"], "steeps_category").select("country", F.least(F.lit(1.0), F.col("entropy") / F.log2(F.lit(6.0))).alias("frames"))
    p = entities.pairs(articles, ["entities_location"]).distinct()
    degree = p.select("a").unionByName(p.select(F.col("b").alias("a"))).groupBy(F.col("a").alias("country")).agg(F.count("*").alias("degree"))
    out = base.join(frames, "country").join(degree, "country", "left").withColumn("degree", F.coalesce("degree", F.lit(0)))
    w = Window.partitionBy()  # one row a country
    most = F.max("degree").over(w)
    out = out.withColumn("visibility", F.col("n") / F.max("n").over(w)).withColumn("centrality", F.when(most > 0, F.col("degree") / most).otherwise(0.0))
    return out.withColumn("soft_power", 0.25 * F.col("visibility") + 0.30 * (F.col("sentiment") + 1) / 2 + 0.20 * F.col("frames") + 0.25 * F.col("centrality"))


def agenda_setting(articles: DataFrame) -> DataFrame:
    """Which language is first on topics: topics led and compared, ``leader_score`` and the followers' mean lag in hours."""
    first = articles.where("topic_id >= 0").groupBy("topic_id", "language").agg(F.min("published_at").alias("t"))
    w = Window.partitionBy("topic_id")
    first = first.withColumn("leader", F.min(F.struct("t", "language")).over(w)).withColumn("n", F.count("*").over(w)).where("n >= 2")
    lag = (F.unix_micros("t") - F.unix_micros("leader.t")) / 3.6e9
    leads = F.col("language") == F.col("leader.language")
    return first.groupBy("language").agg(F.sum(leads.cast("int")).alias("led"), F.count("*").alias("compared"), F.avg(F.when(~leads, lag)).alias("mean_lag")).withColumn("leader_score", F.col("led") / F.col("compared"))


def velocity(articles: DataFrame, hours: int = 72) -> DataFrame:
    """Per language pair: topics that reach the second within ``hours`` of the first, and the mean lag."""
    first = articles.where("topic_id >= 0").groupBy("topic_id", "language").agg(F.min("published_at").alias("t"))
    lag = (F.unix_micros("b.t") - F.unix_micros("a.t")) / 3.6e9
    p = first.alias("a").join(first.alias("b"), F.col("a.topic_id") == F.col("b.topic_id")).where((F.col("a.language") != F.col("b.language")) & (lag >= 0) & (lag <= hours))
    return p.groupBy(F.col("a.language").alias("src"), F.col("b.language").alias("dst")).agg(F.count("*").alias("topics"), F.avg(lag).alias("mean_lag"))
