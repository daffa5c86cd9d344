"""The daily questions, the composite index over their answers, and the signal portfolio.

All take ``articles`` (today's and earlier ones) and a ``today``; history is what came before it. Ties go by name.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import stats
from . import entities

TOP = 10


def _days(articles: DataFrame, today: datetime.date, back: int, until: int = 0) -> DataFrame:
    """Articles of the days today - ``back`` to today - ``until``."""
    return articles.where((F.col("day") >= today - datetime.timedelta(back)) & (F.col("day") <= today - datetime.timedelta(until)))


def _top(df: DataFrame, by: list[Column], within: list[str], k: int) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*within).orderBy(*by))).where(F.col("rank") <= k)


def burst(a: DataFrame, today, days: int = 30, code: str = "steeps_primary") -> DataFrame:
    """Q01: today's count over the mean count of the history's days that have any; null without history."""
    now = _days(a, today, 0).groupBy(code).agg(F.count("*").alias("n"))
    old = _days(a, today, days, 1).groupBy(code, "day").count().groupBy(code).agg(F.avg("count").alias("usual"))
    return now.join(old, code, "left").withColumn("ratio", F.col("n") / F.col("usual"))


def trend(a: DataFrame, today, days: int = 7, code: str = "steeps_primary") -> DataFrame:
    """Q02: a code's last day against the mean of the days before it."""
    n = _days(a, today, days).groupBy(code, "day").agg(F.count("*").alias("n"))
    last = F.max("day").over(Window.partitionBy(code))
    n = n.withColumn("last", F.col("day") == last).groupBy(code).agg(F.max(F.when(F.col("last"), F.col("n"))).alias("n"), F.avg(F.when(~F.col("last"), F.col("n"))).alias("before"))
    n = n.withColumn("change", (F.col("n") - F.col("before")) / F.col("before"))
    return n.withColumn("trend", F.when(F.col("change") > 0.2, "rising").when(F.col("change") < -0.2, "falling").otherwise("stable"))


def before_after(a: DataFrame, today, days: int = 30, split: int = 7, code: str = "steeps_primary") -> DataFrame:
    """Q03: counts before and since today - ``split``, and the change in percent of the former (of 1 if there was none)."""
    since = F.col("day") >= today - datetime.timedelta(split)
    n = _days(a, today, days).groupBy(code).agg(F.sum((~since).cast("int")).alias("before"), F.sum(since.cast("int")).alias("after"))
    return n.withColumn("change", (F.col("after") - F.col("before")) / F.when(F.col("before") == 0, 1).otherwise(F.col("before")) * 100)


def framing(a: DataFrame, today, stop: list[str], least: int = 3, k: int = 8) -> DataFrame:
    """Q04: each language's most frequent title words (stop words aside), of languages with ``least`` articles."""
    t = _days(a, today, 0).withColumn("articles", F.count("*").over(Window.partitionBy("language"))).where(F.col("articles") >= least)
    w = t.select("language", F.explode(F.regexp_extract_all(F.lower("title"), F.lit(r"[a-z]{3,}"), 0)).alias("word")).where(~F.col("word").isin(stop))
    return _top(w.groupBy("language", "word").agg(F.count("*").alias("n")), [F.desc("n"), F.asc("word")], ["language"], k)


def country_sentiment(a: DataFrame, today) -> DataFrame:
    """Q05: the countries with most articles, their mean sentiment and its label."""
    n = _days(a, today, 0).groupBy("source_country").agg(F.count("*").alias("n"), F.avg("sentiment_score").alias("sentiment"))
    return n.withColumn("label", stats.label(F.col("sentiment"))).orderBy(F.desc("n"), "source_country").limit(TOP)


def dark_corners(a: DataFrame, today, cut: float = 0.03) -> DataFrame:
    """Q06: coverage of each region and whether it is under ``cut``."""
    n = _days(a, today, 0).groupBy("source_region").agg(F.count("*").alias("n"), F.countDistinct("source").alias("sources"))
    return n.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy())).withColumn("dark", F.col("share") < cut)  # one row a region


def country_pairs(a: DataFrame, today, k: int | None = TOP) -> DataFrame:
    """Q07: country pairs in focus together: how often, and the mean sentiment."""
    p = entities.pairs(_days(a, today, 0).withColumn("codes", F.filter("geo_focus_all", lambda c: F.length(c) == 2)), ["codes"], ["sentiment_score"])
    n = p.groupBy("a", "b").agg(F.count("*").alias("n"), F.avg("sentiment_score").alias("sentiment"))
    return n.orderBy(F.desc("n"), F.desc(F.abs("sentiment")), "a", "b").limit(k) if k else n


def weak_signals(a: DataFrame, today, cut: float = 0.60, fallback: int = 5) -> DataFrame:
    """Q08: weak signals; if there are none, the most novel articles."""
    t = _days(a, today, 0)
    weak = t.where((F.col("signal_type") == "WEAK_SIGNAL") | (F.col("novelty_score") >= cut))
    none = weak.agg(F.count("*").alias("c")).where("c = 0").select(F.lit(fallback).alias("k"))
    best = t.orderBy(F.desc("novelty_score"), "article_id").limit(fallback).join(F.broadcast(none), how="left_semi")  # one row or none
    return weak.unionByName(best).select("article_id", "title", "novelty_score", "signal_type").orderBy(F.desc("novelty_score"), "article_id").limit(TOP)


def paradigms(a: DataFrame, today) -> DataFrame:
    """Q09: places that three languages or more cover, and how many articles cross domains there."""
    t = _days(a, today, 0)
    crossing = F.array_contains("steeps_all", "CRS") & (F.size("steeps_all") >= 2)
    return t.groupBy("geo_focus_primary").agg(F.countDistinct("language").alias("languages"), F.sum(crossing.cast("int")).alias("crossing"), F.count("*").alias("n")).where("languages >= 3")


def migration(a: DataFrame, today, days: int = 30) -> DataFrame:
    """Q10: mean number of sources a day, second half of the code's days over the first."""
    n = _days(a, today, days).groupBy("steeps_primary", "day").agg(F.countDistinct("source").alias("s"))
    w = Window.partitionBy("steeps_primary")
    n = n.withColumn("at", F.row_number().over(w.orderBy("day"))).withColumn("all", F.count("*").over(w))
    first = F.col("at") <= F.floor(F.col("all") / 2)
    n = n.groupBy("steeps_primary").agg(F.avg(F.when(first, F.col("s"))).alias("early"), F.avg(F.when(~first, F.col("s"))).alias("late")).withColumn("ratio", F.col("late") / F.col("early"))
    return n.withColumn("move", F.when(F.col("ratio") > 1.2, "spreading").when(F.col("ratio") < 0.8, "shrinking").otherwise("stable"))


def setters(a: DataFrame, today, days: int = 30) -> DataFrame:
    """Q11: by source and tier, today's (place, code) pairs that the history lacks."""
    old = _days(a, today, days, 1).select("geo_focus_primary", F.explode("steeps_all").alias("code")).distinct()
    now = _days(a, today, 0).select("source", "source_tier", "geo_focus_primary", F.explode("steeps_all").alias("code"))
    return now.join(old, ["geo_focus_primary", "code"], "left_anti").groupBy("source", "source_tier").agg(F.count("*").alias("n"))


def leaning(a: DataFrame, today, k: int = 5) -> DataFrame:
    """Q12: the leading codes of each classified lean."""
    n = _days(a, today, 0).where("source_lean in ('LEFT', 'CENTER', 'RIGHT')").groupBy("source_lean", "steeps_primary").agg(F.count("*").alias("n"))
    return _top(n, [F.desc("n"), F.asc("steeps_primary")], ["source_lean"], k)


def exclusive(a: DataFrame, today) -> DataFrame:
    """Q13: (place, code) subjects that one language alone has."""
    t = _days(a, today, 0).select("language", F.concat_ws("/", "geo_focus_primary", "steeps_primary").alias("subject")).distinct()
    return t.groupBy("subject").agg(F.count("*").alias("c"), F.min("language").alias("language")).where("c = 1").select("language", "subject")


def agenda_overlap(a: DataFrame, today) -> DataFrame:
    """Q13: Jaccard of the languages' subjects."""
    return entities.jaccard_of_sets(_days(a, today, 0).select("language", F.concat_ws("/", "geo_focus_primary", "steeps_primary").alias("subject")), "language", "subject")


def coverage_gap(a: DataFrame, today) -> DataFrame:
    """Q14: difference of the languages' numbers of sources, as a share of the larger."""
    n = _days(a, today, 0).groupBy("language").agg(F.countDistinct("source").alias("s"))
    return n.toDF("a", "x").join(n.toDF("b", "y"), F.col("a") < F.col("b")).select("a", "b", "x", "y", (F.abs(F.col("x") - F.col("y")) / F.greatest("x", "y")).alias("gap"))


def economic_series(a: DataFrame, today, days: int = 30) -> DataFrame:
    """Q15: the daily mean sentiment of economic articles."""
    return _days(a, today, days - 1).where("steeps_primary = 'ECO'").groupBy("day").agg(F.avg("sentiment_score").alias("sentiment"), F.count("*").alias("n"))


def code_pairs(a: DataFrame, today, days: int = 7) -> DataFrame:
    """Q16: code pairs of sources (CRS aside): today's count over the largest of the days before; convergent over 1.3."""
    sets = _days(a, today, days).where("steeps_primary <> 'CRS'").groupBy("source", "day").agg(F.collect_set("steeps_primary").alias("codes"))
    n = entities.pairs(sets, ["codes"], ["day"]).groupBy("a", "b", "day").agg(F.count("*").alias("n"))
    now = F.col("day") == today
    out = n.groupBy("a", "b").agg(F.max(F.when(now, F.col("n"))).alias("n"), F.max(F.when(~now, F.col("n"))).alias("most")).where("n is not null")
    return out.withColumn("ratio", F.col("n") / F.col("most")).withColumn("convergent", F.coalesce(F.col("ratio") > 1.3, F.lit(True)))


def clusters(a: DataFrame, today, k: int = 5, first: int = 3) -> DataFrame:
    """Q17: each code's articles, sentiment, languages, sources and leading people (the ``first`` ones of an article)."""
    t = _days(a, today, 0)
    n = t.groupBy("steeps_primary").agg(F.count("*").alias("n"), F.avg("sentiment_score").alias("sentiment"), F.array_join(F.sort_array(F.collect_set("language")), ",").alias("languages"), F.countDistinct("source").alias("sources"))
    p = t.select("steeps_primary", F.explode(F.slice("entities_person", 1, first)).alias("e")).groupBy("steeps_primary", "e").agg(F.count("*").alias("c"))
    p = _top(p, [F.desc("c"), F.asc("e")], ["steeps_primary"], k).groupBy("steeps_primary").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "e"))), lambda x: x["e"]), ",").alias("people"))
    return n.join(p, "steeps_primary", "left")


def entity_map(a: DataFrame, today, first: int = 5) -> DataFrame:
    """Q18: the most named entities: sentiment (0 if unknown), modal code and place."""
    t = _days(a, today, 0)
    for c in entities.ALL:
        t = t.withColumn(c, F.slice(c, 1, first))
    m = entities.mentions(t, entities.ALL, ["sentiment_score", "steeps_primary", "geo_focus_primary"])
    n = m.groupBy("entity", "kind").agg(F.count("*").alias("n"), F.coalesce(F.avg("sentiment_score"), F.lit(0.0)).alias("sentiment"), F.mode("steeps_primary", True).alias("code"), F.mode("geo_focus_primary", True).alias("place"))
    return n.orderBy(F.desc("n"), "entity", "kind").limit(TOP)


def index(a: DataFrame, today, hot: list[str]) -> DataFrame:
    """The composite index, 0 to 100: skew of coverage (.40), hot spots and their negative sentiment (.35), tension of pairs (.25)."""
    w = Window.partitionBy()  # one row a region
    r = dark_corners(a, today).withColumn("at", F.row_number().over(w.orderBy("share"))).withColumn("down", F.row_number().over(w.orderBy(F.desc("share"))))
    g1 = r.agg(
        F.sum((2 * F.col("at") - 1) * F.col("share")).alias("ranked"), F.count("*").alias("m"), F.sum(F.when(F.col("down") <= 3, F.col("share"))).alias("top3"), F.avg(F.col("dark").cast("double")).alias("dark")
    ).select(F.round(F.least(F.lit(100.0), (F.col("ranked") / F.col("m") - 1) * 50 + F.col("top3") * 30 + F.col("dark") * 20), 2).alias("g1"))
    c = country_sentiment(a, today).withColumn("hot", F.col("source_country").isin(hot))
    g2 = c.agg(F.sum(F.when(F.col("hot"), F.col("n")).otherwise(0)).alias("h"), F.sum("n").alias("t"), F.avg(F.when(F.col("hot"), -F.least(F.col("sentiment"), F.lit(0.0)))).alias("neg")).select(F.round(F.least(F.lit(100.0), F.col("h") / F.col("t") * 60 + F.coalesce("neg", F.lit(0.0)) * 40), 2).alias("g2"))
    p = country_pairs(a, today).withColumn("tension", F.greatest(-F.col("sentiment"), F.lit(0.0)) * F.when(F.col("a").isin(hot) | F.col("b").isin(hot), 1.5).otherwise(1.0))
    g3 = p.agg(F.round(F.least(F.lit(100.0), F.coalesce(F.avg("tension"), F.lit(0.0)) * 100), 2).alias("g3"))
    out = g1.crossJoin(g2).crossJoin(g3).withColumn("score", F.round(0.40 * F.col("g1") + 0.35 * F.col("g2") + 0.25 * F.col("g3"), 2))  # one row each
    return out.withColumn("label", F.when(F.col("score") < 30, "low").when(F.col("score") < 60, "moderate").when(F.col("score") < 80, "high").otherwise("critical"))


def portfolio(seen: DataFrame, today, emerging: int = 3, confirmed: int = 7, dismiss: int = 14) -> DataFrame:
    """The state of each signal (``signal, day``) today: watching, emerging, confirmed, or dismissed after ``dismiss`` days unseen."""
    n = seen.where(F.col("day") <= today).groupBy("signal").agg(F.countDistinct("day").alias("days"), F.min("day").alias("first_seen"), F.max("day").alias("last_seen"))
    status = F.when(F.datediff(F.lit(today), "last_seen") >= dismiss, "dismissed").when(F.col("days") >= confirmed, "confirmed").when(F.col("days") >= emerging, "emerging").otherwise("watching")
    return n.withColumn("status", status)


def slug(text: Column, most: int = 60) -> Column:
    return F.substring(F.regexp_replace(F.regexp_replace(F.lower(text), r"[^\w\s]", ""), r"\s+", "_"), 1, most)
