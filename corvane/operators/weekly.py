"""The week's view over daily answers: means, counts of days, sums and top lists, each a table of a few rows.

Daily answers come as tables with a ``day``; a week is whatever days the caller passes on (``period`` picks them).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def period(df: DataFrame, kind: str, ref: str, day: str = "day") -> DataFrame:
    """Rows of the ``day``, ``week``, ``month``, ``quarter`` or ``year`` that ``ref`` (a date) lies in; a plain range of days, so that
    partitions outside are not read."""
    if kind == "day":
        return df.where(F.col(day) == F.lit(ref).cast("date"))
    step = {"week": "7 days", "month": "1 month", "quarter": "3 months", "year": "1 year"}[kind]
    start = F.date_trunc(kind, F.lit(ref).cast("date")).cast("date")
    return df.where((F.col(day) >= start) & (F.col(day) < (start + F.expr(f"interval {step}")).cast("date")))


def mean_bursts(daily: DataFrame) -> DataFrame:
    """``code, mean_burst`` of ``day, code, burst``."""
    return daily.groupBy("code").agg(F.avg("burst").alias("mean_burst"))


def top_signals(signals: DataFrame, top: int = 8) -> DataFrame:
    """The ``top`` signals of the days by novelty (ties by id)."""
    return signals.orderBy(F.desc("novelty_score"), "article_id").limit(top)


def shift_sums(daily: DataFrame) -> DataFrame:
    """One row: how many crossing articles and how many places in several languages all days had together (``day, crossing,
    multilingual``)."""
    return daily.agg(F.coalesce(F.sum("crossing"), F.lit(0)).cast("long").alias("crossing"), F.coalesce(F.sum("multilingual"), F.lit(0)).cast("long").alias("multilingual"))


def days_in_top(daily: DataFrame, subject: str, by: str, each_day: int, top: int) -> DataFrame:
    """``SUBJECT, days``: on how many days a subject was among the ``each_day`` best by ``by``; the ``top`` most frequent ones."""
    w = Window.partitionBy("day").orderBy(F.desc(by), subject)
    best = daily.withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= each_day)
    return best.groupBy(subject).agg(F.count("*").alias("days")).orderBy(F.desc("days"), subject).limit(top)


def days_with(daily: DataFrame, subject: str, flag: str, top: int) -> DataFrame:
    """``SUBJECT, days``: on how many days a subject has ``flag``; the ``top`` most frequent ones."""
    return daily.where(flag).groupBy(subject).agg(F.countDistinct("day").alias("days")).orderBy(F.desc("days"), subject).limit(top)


def top_by_type(daily: DataFrame, top: int = 6) -> DataFrame:
    """``type, entity, mentions``: sums over the days of ``day, type, entity, n``, the ``top`` ones of each type."""
    n = daily.groupBy("type", "entity").agg(F.sum("n").alias("mentions"))
    w = Window.partitionBy("type").orderBy(F.desc("mentions"), "entity")
    return n.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)


def outlook(trends: DataFrame, last: int = 3) -> DataFrame:
    """``code, days``: codes that rose on one of the ``last`` days there are (``day, code, trend``)."""
    days = trends.select("day").distinct().orderBy(F.desc("day")).limit(last)  # a few rows
    return trends.where("trend = 'rising'").join(F.broadcast(days), "day", "left_semi").groupBy("code").agg(F.countDistinct("day").alias("days"))


def coupled(findings: DataFrame) -> DataFrame:
    """``signal, n``: patterns that need findings of two modules or several of one; ``findings``: ``module, metric``."""
    n = lambda *modules: F.sum(F.col("module").isin(*modules).cast("int"))
    one = findings.agg(n("geopolitical").alias("geo"), n("economic").alias("eco"), F.sum(((F.col("module") == "crosslingual") & F.col("metric").startswith("CL-4")).cast("int")).alias("silo"), n("narrative").alias("narr"), n("entity").alias("ent"), n("temporal").alias("temp"))
    rules = [("conflict_economy", F.when((F.col("geo") > 0) & (F.col("eco") > 0), F.col("geo") + F.col("eco"))), ("language_silos", F.when(F.col("silo") >= 3, F.col("silo"))), ("voices_entities", F.when((F.col("narr") > 0) & (F.col("ent") > 0), F.col("narr") + F.col("ent"))), ("fast_propagation", F.when(F.col("temp") >= 3, F.col("temp")))]
    return one.select(F.explode(F.array(*(F.struct(F.lit(name).alias("signal"), value.cast("long").alias("n")) for name, value in rules))).alias("x")).select("x.*").where("n is not null")
