"""Narrative measures: frames over time, voices, media health, source credibility, information flow."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import stats


def frame_shares(articles: DataFrame, codes: list[str]) -> DataFrame:
    """``topic_id, topic_label, day``, the number of articles and each code's share (``frame_CODE``)."""
    n = articles.where("topic_id >= 0").groupBy("topic_id", "topic_label", "day").pivot("steeps_category", codes).count().na.fill(0)
    total = sum((F.col(c) for c in codes), F.lit(0))
    return n.select("topic_id", "topic_label", "day", total.alias("n"), *((F.col(c) / total).alias(f"frame_{c}") for c in codes))


def frame_shift(shares: DataFrame, codes: list[str]) -> DataFrame:
    """``kl``: divergence of a day's frames from those of the topic's day before it (null on the first)."""
    w = Window.partitionBy("topic_id").orderBy("day")
    now = F.array(*(F.col(f"frame_{c}") for c in codes))
    return shares.select("topic_id", "day", now.alias("now"), F.lag(now).over(w).alias("before")).select("topic_id", "day", F.when(F.col("before").isNotNull(), stats.kl(F.col("now"), F.col("before"))).alias("kl"))


def voices(articles: DataFrame, columns: tuple[str, ...] = ("entities_person", "entities_org"), high: float = 0.25, low: float = 0.10) -> DataFrame:
    """Who is named in a topic: ``hhi``, its class, the leading entity with its share, and how many there are."""
    named = articles.where("topic_id >= 0").select("topic_id", F.explode(F.concat(*columns)).alias("entity")).groupBy("topic_id", "entity").agg(F.count("*").alias("n"))
    named = named.withColumn("total", F.sum("n").over(Window.partitionBy("topic_id")))
    out = named.groupBy("topic_id").agg(stats.hhi().alias("hhi"), F.min(F.struct((-F.col("n")).alias("n"), "entity")).alias("top"), F.first("total").alias("total"), F.count("*").alias("entities"))
    kind = F.when(F.col("hhi") >= high, "oligopoly").when(F.col("hhi") <= low, "healthy").otherwise("moderate")
    return out.select("topic_id", "hhi", kind.alias("structure"), F.col("top.entity").alias("top_entity"), (-F.col("top.n") / F.col("total")).alias("top_share"), "entities")


def diversity(articles: DataFrame, by: list[str], value: str) -> DataFrame:
    """Entropy in bits of a column's values in each group, and how many different ones there are."""
    n = articles.groupBy(*by, value).agg(F.count("*").alias("n")).withColumn("total", F.sum("n").over(Window.partitionBy(*by)))
    return n.groupBy(*by).agg(stats.entropy2().alias("entropy"), F.count("*").alias("kinds"))


def media_health(articles: DataFrame, frames: int = 6) -> DataFrame:
    """``health`` of a topic's coverage: 0.4 source diversity + 0.3 frame diversity + 0.3 (1 - voice concentration); grade A, B or C."""
    a = articles.where("topic_id >= 0")
    source = diversity(a, ["topic_id"], "source").select("topic_id", F.when(F.col("kinds") > 1, F.col("entropy") / F.log2("kinds")).otherwise(0.0).alias("sources"))
    frame = diversity(a, ["topic_id"], "steeps_category").select("topic_id", (F.col("entropy") / F.log2(F.lit(float(frames)))).alias("frames"))
    out = source.join(frame, "topic_id").join(voices(articles).select("topic_id", "hhi"), "topic_id")
    out = out.withColumn("health", 0.4 * F.col("sources") + 0.3 * F.col("frames") + 0.3 * (1 - F.col("hhi")))
    return out.withColumn("grade", F.when(F.col("health") >= 0.7, "A").when(F.col("health") >= 0.4, "B").otherwise("C"))


def credibility(articles: DataFrame, singles: bool = False) -> DataFrame:
    """Share of a source's (topic, day) claims that another source makes too. Claims of a single source count only with ``singles``."""
    claims = articles.where("topic_id >= 0").select("topic_id", "day", "source").distinct()
    claims = claims.withColumn("shared", F.count("*").over(Window.partitionBy("topic_id", "day")) >= 2)
    if not singles:
        claims = claims.where("shared")
    return claims.groupBy("source").agg(F.count("*").alias("claims"), F.sum(F.col("shared").cast("int")).alias("corroborated")).withColumn("credibility", F.col("corroborated") / F.col("claims"))


def information_flow(articles: DataFrame, similar: Column | None = None, hours: int = 24, same: list[str] | None = None) -> DataFrame:
    """``src, dst, weight``: how often ``dst`` follows ``src`` on a topic within ``hours`` with a similar article.

    ``similar`` is a predicate over the sides ``a`` (earlier) and ``b``. A band join: articles meet by topic and time
    bucket (their own and the one before), not all articles of a topic. Where articles are similar if they are equal in the columns
    ``same``, pairs are counted and not made.
    """
    if similar is None:
        return _flow_counts(articles, hours * 3600, same or [])
    bucket = F.floor(F.unix_timestamp("published_at") / (hours * 3600))
    b = articles.where("topic_id >= 0").withColumn("bucket", bucket).alias("b")
    a = articles.where("topic_id >= 0").withColumn("bucket", F.explode(F.array(bucket, bucket + 1))).alias("a")
    near = (F.col("a.topic_id") == F.col("b.topic_id")) & (F.col("a.bucket") == F.col("b.bucket")) & (F.col("a.source") != F.col("b.source"))
    later = (F.col("a.published_at") < F.col("b.published_at")) & (F.unix_timestamp("b.published_at") - F.unix_timestamp("a.published_at") <= hours * 3600)
    return a.join(b, near & later & similar).groupBy(F.col("a.source").alias("src"), F.col("b.source").alias("dst")).agg(F.count("*").alias("weight"))
def _flow_counts(articles: DataFrame, reach: int, same: list[str]) -> DataFrame:
    """Each article counts the earlier ones of every other source by places in sorted times."""
    known = F.col("topic_id") >= 0
    for c in ("source", "published_at", *same):
        known = known & F.col(c).isNotNull()
    keys = [F.col(c).alias(f"same_{i}") for i, c in enumerate(same)]
    at = F.col("published_at").cast("timestamp")
    n = articles.where(known).select("topic_id", *keys, "source", F.unix_timestamp(at).alias("s"), F.unix_micros(at).alias("t")).groupBy("topic_id", *(f"same_{i}" for i in range(len(same))), "source", "s", "t").agg(F.count("*").alias("n"))
    bucket = F.floor(F.col("s") / reach)
    sides = F.array(F.struct(bucket.alias("bucket"), F.lit(True).alias("own")), F.struct((bucket + 1).alias("bucket"), F.lit(False).alias("own")))
    dealt = n.withColumn("k", F.explode(sides)).select("*", "k.*").drop("k")

    def work(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("t")
        out = []
        later = {x: (p["s"].to_numpy(), p["t"].to_numpy(), p["n"].to_numpy()) for x, p in g[g["own"]].groupby("source")}
        for src, p in g.groupby("source"):
            s, t, sums = p["s"].to_numpy(), p["t"].to_numpy(), np.r_[0, np.cumsum(p["n"].to_numpy())]
            for dst, (bs, bt, m) in later.items():
                if src != dst:
                    many = int(((sums[np.searchsorted(t, bt)] - sums[np.searchsorted(s, bs - reach)]) * m).sum())
                    if many:
                        out.append((src, dst, many))
        return pd.DataFrame(out, columns=["src", "dst", "weight"])

    kind = articles.schema["source"].dataType.simpleString()
    found = dealt.groupBy("topic_id", "bucket", *(f"same_{i}" for i in range(len(same)))).applyInPandas(work, f"src {kind}, dst {kind}, weight long")
    return found.groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


