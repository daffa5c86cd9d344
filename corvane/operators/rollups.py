"""Small aggregates of reports: sums of groups, topics of sources, changes of emotions, joined trajectories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .series import EMOTIONS


def group_sums(counts: DataFrame, groups: DataFrame, key: str = "source", group: str = "group", value: str = "n", other: str = "?") -> DataFrame:
    """``counts`` by ``key`` as sums by the group that ``groups`` (a row a key) gives it; keys that it lacks, and null ones, are ``other``."""
    named = counts.join(groups.where(F.col(key).isNotNull()).select(key, group), key, "left")
    return named.groupBy(F.coalesce(group, F.lit(other)).alias(group)).agg(F.sum(value).alias(value))


def source_topics(articles: DataFrame) -> DataFrame:
    """What the nesting of articles in topics in sources holds: an aggregate by both keys, since a topic's list has no bound. Articles of
    no topic (-1) are left out."""
    told = articles.where("topic_id <> -1").groupBy("source", "topic_id")
    return told.agg(F.count("*").alias("n"), F.min("article_id").alias("first"), F.sum("article_id").alias("ids"))


def emotion_delta(articles: DataFrame, days: int = 7) -> DataFrame:
    """``source, day`` and each emotion's mean less that of ``days`` days before, where both days have articles."""
    means = articles.groupBy("source", "day").agg(*(F.avg(f"emotion_{e}").alias(e) for e in EMOTIONS))
    past = means.select("source", F.date_add("day", days).alias("day"), *(F.col(e).alias(f"past_{e}") for e in EMOTIONS))
    return means.join(past, ["source", "day"]).select("source", "day", *((F.col(e) - F.col(f"past_{e}")).alias(e) for e in EMOTIONS))


def filled(base: DataFrame, parts: list[DataFrame], key: str, defaults: dict) -> DataFrame:
    """``base`` with the columns of ``parts`` (a row a key each); what a part lacks has its default."""
    for part in parts:
        base = base.join(part, key, "left")
    return base.na.fill(defaults)
