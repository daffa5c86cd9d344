"""What the signal layers are judged by: a row a topic, joined from the topic's series, network, vectors and articles."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import settle
from . import graph, grouped, models, signals
from . import series as S


def drift(articles: DataFrame, vectors: DataFrame, least: int = 4, key: str = "article_id", vector: str = "embedding") -> DataFrame:
    """``topic_id, embedding_drift``: one less the cosine of the centroids of a topic's earlier and later half of articles with a vector.

    The order is day, then key; the middle article belongs to the later half; 0 under ``least`` articles. Only the articles of the day on
    which the middle falls are numbered, so that no topic is sorted in one task.
    """
    rows = articles.where("topic_id >= 0").select("topic_id", F.coalesce("day", F.lit("2000-01-01").cast("date")).alias("day"), key).join(vectors.where(F.col(vector).isNotNull()).select(key, F.col(vector).cast("array<double>").alias("v")), key)
    rows = settle(rows)
    per_day = rows.groupBy("topic_id", "day").agg(F.count("*").alias("n"))
    by_day = Window.partitionBy("topic_id").orderBy("day")  # a row a day
    per_day = per_day.withColumn("before", F.sum("n").over(by_day) - F.col("n")).withColumn("all", F.sum("n").over(Window.partitionBy("topic_id"))).withColumn("middle", F.floor(F.col("all") / 2))
    placed = rows.join(per_day, ["topic_id", "day"])
    whole = placed.where("before + n <= middle or before >= middle").withColumn("late", F.col("before") >= F.col("middle"))
    split = placed.where("before < middle and before + n > middle")
    at = F.row_number().over(Window.partitionBy("topic_id", "day").orderBy(key)) - 1 + F.col("before")
    halves = whole.unionByName(split.withColumn("late", at >= F.col("middle")))
    means = halves.select("topic_id", "all", "late", F.posexplode("v").alias("i", "x")).groupBy("topic_id", "all", "i").agg(F.avg(F.when(~F.col("late"), F.col("x"))).alias("a"), F.avg(F.when(F.col("late"), F.col("x"))).alias("b"))
    norms = means.groupBy("topic_id", "all").agg(F.sum(F.col("a") * F.col("b")).alias("ab"), F.sqrt(F.sum(F.col("a") * F.col("a"))).alias("aa"), F.sqrt(F.sum(F.col("b") * F.col("b"))).alias("bb"))
    apart = F.when((F.col("all") >= least) & (F.col("aa") > 1e-10) & (F.col("bb") > 1e-10), 1 - F.col("ab") / (F.col("aa") * F.col("bb"))).otherwise(0.0)
    return norms.select("topic_id", apart.alias("embedding_drift"))


def network(edges: DataFrame) -> DataFrame:
    """One row: ``modularity`` of the graph's communities and ``nodes``."""
    labels = graph.louvain(edges)
    return graph.modularity(edges, labels).crossJoin(labels.agg(F.count("*").alias("nodes")))  # one row each


def growth(volume: DataFrame) -> DataFrame:
    """``series, growth, declining, trend_strength, dominant_period``: the last three days against the first half of the series, the trend's
    deviation over the series', and the wavelet period of the most energy (0 if the series is too short)."""

    def work(x, days):
        rate, down = 0.0, False
        if len(x) >= 3:
            late, early = x[-3:].mean(), x[: max(1, len(x) // 2)].mean()
            rate, down = (late - early) / early if early > 0 else 0.0, late < 0.5 * early
        strength = float(np.std(grouped.decompose(x)[0]) / x.std()) if x.std() > 1e-10 else 0.0
        return pd.DataFrame({"growth": [rate], "declining": [bool(down)], "trend_strength": [strength], "dominant_period": [models.wavelet(x)[2] or 0.0]})

    return grouped.per_series(volume, work, "growth double, declining boolean, trend_strength double, dominant_period double")


def lifecycle() -> Column:
    """State of a topic by its articles, growth and trend."""
    n, g = F.col("article_count"), F.col("growth")
    return F.when(F.col("declining"), "declining").when(n <= 3, "noise").when(n <= 10, "weak").when(g >= 0.5, "emerging").when(F.col("trend_strength") > 0.5, "strong").otherwise("emerging")


def topic_features(articles: DataFrame, vectors: DataFrame, scores: DataFrame, edges: DataFrame, shifts: DataFrame, recent: int = 7) -> DataFrame:
    """A row a topic with all that ``signals.classify`` reads, and ``article_count, source_count, growth, trend_strength, bertrend_state``.

    ``vectors``: ``article_id, embedding``; ``scores``: ``article_id, ood_score``; ``edges``: weighted links of names; ``shifts``: as
    ``grouped.shift_points`` gives them. Articles outside topics count for nothing. A topic's frames diverge if one of its shifts is a change of level; its
    emotions shift if the short average of one has crossed the long one in the last ``recent`` days of the series. What a table does not
    tell is 0 or false.
    """
    inside = articles.where("topic_id >= 0")
    base = inside.groupBy("topic_id").agg(
        F.count("*").alias("article_count"), F.countDistinct("source").alias("source_count"), F.countDistinct("steeps_category").cast("double").alias("cross_domain_count"),
        F.coalesce(F.datediff(F.max("day"), F.min("day")), F.lit(0)).cast("double").alias("span_days"),
    ).withColumn("steeps_shift", F.col("cross_domain_count") >= 3)
    daily = settle(S.daily(inside).where("series <> 'all'"))
    volume = daily.where("metric = 'volume'")
    plain = volume.select("series", "day", "value")
    crossed = settle(S.crossover(daily.where("metric <> 'sentiment'")))
    end = crossed.agg(F.date_sub(F.max("day"), recent).alias("from"))
    moods = crossed.where("metric <> 'volume' and ma_signal <> 'neutral'").crossJoin(F.broadcast(end)).where("day > from")  # one row
    parts = [
        S.zscore_of_last(volume).select("series", F.abs("z").alias("volume_zscore")),
        S.last_state(crossed.where("metric = 'volume'")).select("series", "ma_signal", F.col("days_above").cast("double").alias("days_above")),
        grouped.bursts(plain).groupBy("series").agg(F.max("burst_score").alias("burst_score")),
        grouped.changepoints(plain).groupBy("series").agg(F.max("significance").alias("changepoint_significance")),
        growth(plain),
        moods.select("series").distinct().withColumn("emotion_shift", F.lit(True)),
    ]
    out = base.withColumn("series", F.col("topic_id").cast("string"))
    for part in parts:
        out = out.join(part, "series", "left")
    odd = inside.join(scores, "article_id", "left").groupBy("topic_id").agg(F.max(F.coalesce("ood_score", F.lit(0.0))).alias("ood_score"), F.avg(F.coalesce("ood_score", F.lit(0.0))).alias("novelty_score"))
    frames = shifts.where("changed").select("topic_id").distinct().withColumn("frame_divergence", F.lit(True))
    spike = S.entropy_spike(inside.select(F.lit(0).alias("whole"), "day", "topic_id"), "whole", "topic_id").select(F.col("spike").alias("entropy_spike"))
    out = out.join(odd, "topic_id", "left").join(drift(articles, vectors), "topic_id", "left").join(frames, "topic_id", "left")
    out = out.crossJoin(F.broadcast(spike)).crossJoin(F.broadcast(network(edges)))  # one row each
    new = F.when(F.col("nodes") > 0, F.least(F.lit(1.0), F.col("article_count") / F.col("nodes"))).otherwise(0.0)
    out = out.withColumn("network_anomaly", new * 0.9).withColumn("modularity_delta", F.coalesce("modularity", F.lit(0.0)))  # as many new links as 0.8 of the new nodes
    out = out.na.fill(0.0, ["growth", "trend_strength"]).na.fill(False, ["declining"]).withColumn("bertrend_state", lifecycle())
    moves = (F.col("bertrend_state") == "weak") & (F.col("growth") > 0) | (F.col("bertrend_state") == "emerging") & (F.col("growth") >= 0.5)
    out = out.withColumn("bertrend_transition", moves.cast("double")).na.fill(0.0, signals.FEATURES).na.fill(False, ["frame_divergence", "emotion_shift"])
    return out.select("topic_id", "article_count", "source_count", "growth", "trend_strength", "bertrend_state", "ma_signal", *signals.FEATURES, "steeps_shift", "frame_divergence", "emotion_shift")
