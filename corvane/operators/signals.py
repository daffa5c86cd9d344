"""Signal layers: the composite of seven indicators, three pathways, five layers, confidence, one signal a topic and layer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.stats import clamp, finite

# Weights of the indicators.
WEIGHTS = {"ood_score": 0.20, "changepoint_significance": 0.15, "cross_domain": 0.20, "bertrend_transition": 0.15, "entropy_spike": 0.10, "novelty_score": 0.10, "network_anomaly": 0.10}
FEATURES = ["volume_zscore", "burst_score", "days_above", "changepoint_significance", "modularity_delta", "embedding_drift", "dominant_period", "novelty_score", "cross_domain_count", "ood_score", "bertrend_transition", "entropy_spike", "network_anomaly", "span_days"]


def composite(domains: int = 6) -> Column:
    values = {k: F.col(k) for k in WEIGHTS} | {"cross_domain": F.col("cross_domain_count") / domains}
    return clamp(sum((w * clamp(values[k]) for k, w in WEIGHTS.items()), F.lit(0.0)))


def pathways(domains: int = 6) -> Column:
    """How many of the three independent pathways are open."""
    a = (F.col("ood_score") > 0.7) | (F.col("novelty_score") > 0.7)
    b = (F.col("changepoint_significance") > 0.8) & ((F.col("entropy_spike") > 0.5) | (F.col("network_anomaly") > 0.5))
    c = (F.col("bertrend_transition") == 1) & (F.col("cross_domain_count") / domains > 0.3)
    return a.cast("int") + b.cast("int") + c.cast("int")


def layer(domains: int = 6) -> Column:
    """The first of five layers that fits, from singularity down to fad; null if none does."""
    c = F.col
    return (
        F.when((c("novelty_score") > 0.7) & (c("cross_domain_count") >= 2) & (composite(domains) >= 0.65) & (pathways(domains) >= 2), "L5_singularity")
        .when((c("embedding_drift") > 0.3) & (c("dominant_period") > 90) & c("steeps_shift") & (c("span_days") >= 365), "L4_long")
        .when((c("changepoint_significance") > 0.8) & (c("modularity_delta") > 0.1) & c("frame_divergence") & (c("span_days") >= 90), "L3_mid")
        .when((c("days_above") >= 7) & (c("ma_signal") == "rising") & c("emotion_shift") & (c("span_days") >= 14), "L2_short")
        .when((c("volume_zscore") > 3.0) & (c("burst_score") > 2.0), "L1_fad")
    )


def classify(features: DataFrame, domains: int = 6) -> DataFrame:
    """``topic_id, signal_layer, composite, pathways, confidence`` of topics that make a signal.

    Missing and infinite numbers are 0, missing marks false. Confidence is how far the layer's own measure is past its
    bound, 0.5 to 1.
    """
    f = features.select("topic_id", "ma_signal", *(finite(F.col(c)).alias(c) for c in FEATURES), *(F.coalesce(c, F.lit(False)).alias(c) for c in ("steeps_shift", "frame_divergence", "emotion_shift")))
    f = f.withColumn("composite", composite(domains)).withColumn("pathways", pathways(domains)).withColumn("signal_layer", layer(domains)).where("signal_layer is not null")
    by = {"L5_singularity": (F.col("composite"), 0.65), "L4_long": (F.col("embedding_drift"), 0.3), "L3_mid": (F.col("changepoint_significance"), 0.8), "L2_short": (F.col("days_above"), 7.0), "L1_fad": (F.col("volume_zscore"), 3.0)}
    confidence = F.lit(0.5)
    for name, (x, bound) in by.items():
        confidence = F.when(F.col("signal_layer") == name, F.least(F.lit(1.0), 0.5 + 0.5 * (x - bound) / bound)).otherwise(confidence)
    return f.select("topic_id", "signal_layer", "composite", "pathways", confidence.alias("confidence"))


def best(signals: DataFrame) -> DataFrame:
    """The most confident signal of each layer and topic."""
    w = Window.partitionBy("signal_layer", "topic_id").orderBy(F.desc("confidence"), F.desc("composite"))
    return signals.withColumn("k", F.row_number().over(w)).where("k = 1").drop("k")


def index_rows(signals: DataFrame) -> DataFrame:
    """Rows of the signals index, one a signal: its id from layer, topic and day, and how many articles it names (``article_ids``)."""
    key = F.concat_ws("|", "signal_layer", F.col("topic_id").cast("string"), F.col("day").cast("string"))
    n = F.coalesce(F.size("article_ids"), F.lit(0)).cast("long")
    return signals.select(F.sha2(key, 256).alias("signal_id"), "signal_layer", "topic_id", "day", "confidence", n.alias("article_count"))


def bertrend(count: Column, growth: Column) -> Column:
    """State of a trend: noise up to 3 articles, weak up to 10, then by growth."""
    return F.when(count <= 3, "noise").when((count <= 10) & (growth < 0.5), "weak").when(growth >= 0.5, "emerging").otherwise("strong")


def survival(durations: DataFrame) -> DataFrame:
    """Kaplan-Meier: ``t, at_risk, deaths, survival`` of ``duration, ended``. The product is a sum of logarithms."""
    n = durations.groupBy(F.col("duration").alias("t")).agg(F.sum(F.col("ended").cast("int")).alias("deaths"), F.count("*").alias("gone"))
    w = Window.orderBy("t")  # one row a different duration in days
    n = n.withColumn("at_risk", F.sum("gone").over(Window.orderBy(F.desc("t"))))
    step = F.when(F.col("deaths") == F.col("at_risk"), None).otherwise(F.log(1 - F.col("deaths") / F.col("at_risk")))
    n = n.withColumn("dead", F.max((F.col("deaths") == F.col("at_risk")).cast("int")).over(w)).withColumn("logs", F.sum(F.coalesce(step, F.lit(0.0))).over(w))
    return n.select("t", "at_risk", "deaths", F.when(F.col("dead") == 1, 0.0).otherwise(F.exp("logs")).alias("survival"))


def local_outlier_factor(neighbours: DataFrame) -> DataFrame:
    """``id, lof`` from each point's nearest neighbours ``id, other, distance`` (k of them a point)."""
    reach = neighbours.groupBy("id").agg(F.max("distance").alias("k_distance"))
    n = neighbours.join(reach.select(F.col("id").alias("other"), "k_distance"), "other").withColumn("reach", F.greatest("k_distance", "distance"))
    density = n.groupBy("id").agg((1 / (F.avg("reach") + 1e-12)).alias("lrd"))
    return n.join(density.select(F.col("id").alias("other"), F.col("lrd").alias("near")), "other").join(density, "id").groupBy("id").agg((F.avg("near") / F.first("lrd")).alias("lof"))
