"""Findings across modules: thresholds, ranking, alerts, weekly views."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def findings(modules: dict[str, DataFrame], top: int = 5, least: float = 0.05) -> DataFrame:
    """``module, subject, magnitude``: of each module (``subject, magnitude``) the ``top`` ones over ``least``, all by magnitude."""
    out = None
    for name, df in modules.items():
        part = df.where(F.abs("magnitude") >= least).select(F.lit(name).alias("module"), F.col("subject").cast("string").alias("subject"), F.col("magnitude").cast("double").alias("magnitude"))
        out = part if out is None else out.unionByName(part)
    w = Window.partitionBy("module").orderBy(F.desc(F.abs("magnitude")), "subject")
    return out.withColumn("k", F.row_number().over(w)).where(F.col("k") <= top).drop("k")


def alerts(tensions: DataFrame, uncertainty: DataFrame, sectors: DataFrame, trajectories: DataFrame, crisis: float = -0.40, epu: float = 0.40, chaos: float = 0.80) -> DataFrame:
    """``alert, subject, value`` of four rules: crisis of a pair, uncertainty of a language, every sector negative, mostly bursts."""
    pair = tensions.where(F.col("sentiment") < crisis).select(F.lit("escalation").alias("alert"), F.concat_ws("-", "a", "b").alias("subject"), F.col("sentiment").alias("value"))
    economy = uncertainty.groupBy("language").agg(F.avg("epu").alias("value")).where(F.col("value") > epu).select(F.lit("uncertainty").alias("alert"), F.col("language").alias("subject"), "value")
    means = sectors.groupBy("sector").agg(F.avg("sentiment").alias("s"))
    off = means.agg(F.max("s").alias("value")).where("value < 0").select(F.lit("risk_off").alias("alert"), F.lit("sectors").alias("subject"), "value")
    share = trajectories.agg((F.sum((F.col("trajectory") == "burst").cast("int")) / F.sum(F.col("trajectory").isin("burst", "plateau").cast("int"))).alias("value")).where(F.col("value") > chaos).select(F.lit("chaos").alias("alert"), F.lit("entities").alias("subject"), "value")
    return pair.unionByName(economy).unionByName(off).unionByName(share)


def extremes(df: DataFrame, subject: str, value: str) -> DataFrame:
    """One row: the mean, and which subject has the largest and the least value."""
    return df.agg(F.avg(value).alias("mean"), F.max_by(subject, F.struct(value, subject)).alias("most"), F.min_by(subject, F.struct(value, subject)).alias("least"))


def weekly_shifts(trends: DataFrame, top: int = 5) -> DataFrame:
    """``code, rising, falling`` days of ``day, code, trend``: the ``top`` ones by both."""
    n = trends.groupBy("code").agg(F.sum((F.col("trend") == "rising").cast("int")).alias("rising"), F.sum((F.col("trend") == "falling").cast("int")).alias("falling"))
    return n.orderBy(F.desc(F.col("rising") + F.col("falling")), "code").limit(top)


def status_history(answers: DataFrame, states: list[str]) -> DataFrame:
    """Number of answers of each status by day, one column a status."""
    return answers.groupBy("day").pivot("status", states).count().na.fill(0)
