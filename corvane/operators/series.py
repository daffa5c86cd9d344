"""Daily series and their windows: densified counts and means, moving averages, crossovers, z-scores, entropy spikes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import pairs

EMOTIONS = ["joy", "trust", "fear", "surprise", "sadness", "disgust", "anger", "anticipation"]
METRICS = ["volume", "sentiment", *EMOTIONS]


def daily(articles: DataFrame, back: int = 90) -> DataFrame:
    """``series, day, metric, value`` for each topic and for ``all`` articles, every day of the last ``back``.

    A day without articles has volume 0 and no other value. Articles without a date belong to 2000-01-01.
    """
    a = articles.select(F.coalesce("day", F.lit("2000-01-01").cast("date")).alias("day"), F.col("topic_id").cast("string").alias("topic"), "sentiment_score", *(f"emotion_{e}" for e in EMOTIONS))
    n = a.groupingSets([["topic", "day"], ["day"]], "topic", "day").agg(
        F.grouping("topic").alias("whole"), F.count("*").cast("double").alias("volume"), F.avg(F.nanvl("sentiment_score", F.lit(None))).alias("sentiment"), *(F.avg(f"emotion_{e}").alias(e) for e in EMOTIONS)
    )
    n = n.withColumn("series", F.when(F.col("whole") == 1, "all").otherwise(F.col("topic"))).where("whole = 1 or topic <> '-1'").drop("topic", "whole")
    span = n.agg(F.max("day").alias("hi"), F.min("day").alias("lo"))
    days = span.select(F.explode(F.expr(f"sequence(greatest(lo, date_add(hi, -{back - 1})), hi)")).alias("day"))
    grid = n.select("series").distinct().crossJoin(F.broadcast(days))  # at most ``back`` days
    full = grid.join(n, ["series", "day"], "left").withColumn("volume", F.coalesce("volume", F.lit(0.0)))
    return full.unpivot(["series", "day"], METRICS, "metric", "value")


def moving(value: str, rows: int, by: list[str], order: str = "day") -> Column:
    """Mean over ``rows`` rows; null until there are so many, nulls inside don't count."""
    w = Window.partitionBy(*by).orderBy(order)
    return F.when(F.row_number().over(w) >= rows, F.avg(value).over(w.rowsBetween(1 - rows, 0)))


def crossover(series: DataFrame, short: int = 3, long: int = 14) -> DataFrame:
    """``ma_short``, ``ma_long`` and ``ma_signal`` of each series and metric."""
    by = ["series", "metric"]
    w = Window.partitionBy(*by).orderBy("day")
    out = series.withColumn("ma_short", moving("value", short, by)).withColumn("ma_long", moving("value", long, by))
    gap = F.col("ma_short") - F.col("ma_long")
    out = out.withColumn("gap", gap).withColumn("before", F.lag("gap").over(w))
    signal = F.when(F.col("gap").isNull(), None).when((F.col("before") <= 0) & (F.col("gap") > 0), "rising").when((F.col("before") >= 0) & (F.col("gap") < 0), "declining").otherwise("neutral")
    return out.withColumn("ma_signal", signal).drop("gap", "before")


def last_state(crossed: DataFrame) -> DataFrame:
    """Per series and metric: the last signal there is, and the days with the short average above the long one."""
    return crossed.groupBy("series", "metric").agg(F.max_by("ma_signal", F.when(F.col("ma_signal").isNotNull(), F.col("day"))).alias("ma_signal"), F.sum((F.coalesce(F.col("ma_short") > F.col("ma_long"), F.lit(False))).cast("int")).alias("days_above"))


def zscore_of_last(series: DataFrame) -> DataFrame:
    """Per series and metric the last value's distance from the mean in population deviations; 0 under three points."""
    last = F.max_by("value", "day")
    out = series.where("value is not null").groupBy("series", "metric").agg(F.count("*").alias("points"), last.alias("last"), F.avg("value").alias("mean"), F.stddev_pop("value").alias("deviation"))
    return out.select("series", "metric", F.when((F.col("points") >= 3) & (F.col("deviation") > 0), (F.col("last") - F.col("mean")) / F.col("deviation")).otherwise(0.0).alias("z"))


def entropy_spike(articles: DataFrame, by: str, value: str, days: int = 30) -> DataFrame:
    """Per group: how unusual the last day's entropy of ``value`` is against up to ``days`` before it, 0 to 1."""
    n = articles.groupBy(by, "day", value).agg(F.count("*").alias("n")).withColumn("total", F.sum("n").over(Window.partitionBy(by, "day")))
    e = n.groupBy(by, "day").agg((-F.sum(F.col("n") / F.col("total") * F.log2(F.col("n") / F.col("total")))).alias("e"))
    w = Window.partitionBy(by).orderBy("day")
    base = w.rowsBetween(-days, -1)
    e = e.select(by, "day", "e", F.avg("e").over(base).alias("mean"), F.stddev_samp("e").over(base).alias("deviation"), F.count("e").over(base).alias("points"))
    z = F.when((F.col("points") >= 2) & (F.col("deviation") > 0), (F.col("e") - F.col("mean")) / F.col("deviation")).otherwise(0.0)
    return e.groupBy(by).agg(F.max_by(F.greatest(F.lit(0.0), F.least(F.lit(1.0), z / 5)), "day").alias("spike"))


def peak(series: DataFrame) -> DataFrame:
    """Per series and metric: the first day of the largest value."""
    return series.where("value is not null").groupBy("series", "metric").agg(F.min(F.struct((-F.col("value")).alias("v"), "day")).alias("p")).select("series", "metric", F.col("p.day").alias("day"), (-F.col("p.v")).alias("value"))


def decay_fit(series: DataFrame, least: float = 0.7) -> DataFrame:
    """Fits of what follows a series' peak: a power law (log-log regression) and an exponential (log-linear), each with the R squared of
    its own logarithms, and the class that they give: ``flash`` where the exponential is the better one, ``sustained`` where the
    power law is, ``irregular`` under ``least`` or with fewer than three points."""
    v = series.where("metric = 'volume' and value > 0")
    after = v.join(peak(v).select("series", F.col("day").alias("peak")), "series").where("day >= peak").withColumn("t", F.datediff("day", "peak").cast("double")).withColumn("x", F.log(F.col("t") + 1)).withColumn("y", F.log("value"))
    out = after.groupBy("series").agg(F.count("*").alias("points"), F.regr_slope("y", "x").alias("exponent"), F.regr_r2("y", "x").alias("r2"), F.regr_slope("y", "t").alias("rate"), F.regr_r2("y", "t").alias("exp_r2"))
    power, fast = F.when(F.col("exponent") < 0, F.col("r2")), F.when(F.col("rate") < 0, F.col("exp_r2"))
    flash = (F.round(fast, 9) >= F.round(F.coalesce(power, F.lit(0.0)), 9)) & (fast > least)
    return out.withColumn("decay", F.when(F.col("points") < 3, "irregular").when(flash, "flash").when(power > least, "sustained").otherwise("irregular"))


def lead_lag(series: DataFrame, most: int = 7, least: float = 0.1) -> DataFrame:
    """Per pair of series the lag (days, within ``most``) of the largest absolute correlation over ``least``, and who leads."""
    best = pairs.lead_lag(series.where("metric = 'volume' and series <> 'all'"), most, least)
    return best.withColumn("leader", F.when(F.col("lag") > 0, F.col("a")).when(F.col("lag") < 0, F.col("b")))


def baseline_shift(articles: DataFrame, value: str = "topic_id", days: int = 30) -> DataFrame:
    """One row: ``kl``, how far the last day's shares of ``value`` are from those of the first ``days`` days there are."""
    span = articles.agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
    n = articles.crossJoin(F.broadcast(span)).groupBy(value).agg(F.sum((F.col("day") == F.col("hi")).cast("int")).alias("now"), F.sum((F.col("day") < F.date_add("lo", days)).cast("int")).alias("base"))  # one row
    w = Window.partitionBy()  # a row for each value
    p = n.select((F.col("now") / F.sum("now").over(w)).alias("p"), (F.col("base") / F.sum("base").over(w) + 1e-10).alias("q"))
    p = p.withColumn("q", F.col("q") / F.sum("q").over(w))
    return p.agg(F.greatest(F.lit(0.0), F.sum(F.when(F.col("p") > 0, F.col("p") * F.log(F.col("p") / F.col("q"))).otherwise(0.0))).alias("kl"))


def zipf_deviation(counts: DataFrame, by: str, most: int = 1000) -> DataFrame:
    """``BY, terms, deviation``: how far the frequencies of a group's ``most`` commonest terms (``BY, term, n``) are from one over the
    rank: 1 - exp(-divergence); 0 under five terms."""
    w = Window.partitionBy(by)
    r = counts.withColumn("rank", F.row_number().over(w.orderBy(F.desc("n"), "term"))).where(F.col("rank") <= most)
    r = r.withColumn("p", F.col("n") / F.sum("n").over(w)).withColumn("q", 1 / F.col("rank") / F.sum(1 / F.col("rank")).over(w))
    out = r.groupBy(by).agg(F.count("*").alias("terms"), F.sum(F.col("p") * F.log(F.col("p") / F.col("q"))).alias("kl"))
    return out.select(by, "terms", F.when(F.col("terms") < 5, 0.0).otherwise(F.greatest(F.lit(0.0), 1 - F.exp(-F.col("kl")))).alias("deviation"))


def largest(series: DataFrame, top: int) -> DataFrame:
    """The rows of the ``top`` series by their whole volume, and of the aggregate (``all``)."""
    n = series.where("metric = 'volume' and series <> 'all'").groupBy("series").agg(F.sum("value").alias("v")).orderBy(F.desc("v"), "series").limit(top)  # a few rows
    return series.join(F.broadcast(n.select("series")), "series", "left_semi").unionByName(series.where("series = 'all'"))
