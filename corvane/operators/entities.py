"""Entities over time: reach, emergence, trajectories, hidden connections, co-occurrence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import stats


def mentions(articles: DataFrame, columns: dict[str, str], keep: list[str]) -> DataFrame:
    """One row for each mention: ``keep``, ``entity`` and its ``kind``. ``columns``: kind by array column; null arrays have none."""
    def marked(column: str, kind: str) -> Column:
        return F.transform(F.coalesce(F.col(column), F.array().cast("array<string>")), lambda e: F.struct(e.alias("entity"), F.lit(kind).alias("kind")))

    each = F.flatten(F.array(*(marked(c, kind) for c, kind in columns.items())))
    return articles.select(*keep, F.explode(each).alias("m")).select(*keep, "m.entity", "m.kind").where("entity is not null")


ALL = {"entities_person": "person", "entities_org": "org", "entities_location": "location"}


def iso_week(day: str) -> Column:
    return F.format_string("%d-W%02d", F.extract(F.lit("YEAROFWEEK"), F.col(day)), F.extract(F.lit("WEEK"), F.col(day)))


def reach(articles: DataFrame) -> DataFrame:
    """Weekly reach of an entity: languages (number and list) and mentions."""
    m = mentions(articles, ALL, ["language", "day"]).withColumn("week", iso_week("day"))
    return m.groupBy("entity", "week").agg(F.countDistinct("language").alias("n_languages"), F.array_join(F.sort_array(F.collect_set("language")), ",").alias("languages"), F.count("*").alias("mentions"))


def emergence(articles: DataFrame, days: int = 14) -> DataFrame:
    """An entity's first days: mentions so far, slope, and acceleration (twice the quadratic coefficient of a fit over the profile)."""
    daily = mentions(articles, ALL, ["day"]).groupBy("entity", "day").agg(F.count("*").alias("n"))
    first = daily.groupBy("entity").agg(F.min("day").alias("first_day"))
    grid = first.select("entity", "first_day", F.posexplode(F.expr(f"sequence(first_day, date_add(first_day, {days - 1}))")).alias("x", "day"))
    full = grid.join(daily, ["entity", "day"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    full = full.withColumn("so_far", F.sum("n").over(Window.partitionBy("entity").orderBy("x")))
    # orthogonal polynomials on 0..days-1 give the quadratic coefficient in closed form
    x, mean = F.col("x").cast("double"), (days - 1) / 2
    spread = (days**2 - 1) / 12
    p2 = (x - mean) ** 2 - spread
    norm = sum(((i - mean) ** 2 - spread) ** 2 for i in range(days))
    return full.groupBy("entity").agg(F.first("first_day").alias("first_day"), F.sum("n").alias("mentions"), F.regr_slope(F.col("so_far").cast("double"), x).alias("slope"), (2 * F.sum(F.col("so_far") * p2) / norm).alias("acceleration"))


def pairs(articles: DataFrame, columns: list[str], keep: list[str] | None = None) -> DataFrame:
    """Unordered pairs of different entities of an article, each once: ``a < b``. Built within the row, without a join."""
    names = F.array_sort(F.array_distinct(F.filter(F.flatten(F.array(*(F.coalesce(F.col(c), F.array().cast("array<string>")) for c in columns))), lambda e: e.isNotNull())))
    both = F.flatten(F.transform(names, lambda x, i: F.transform(F.slice(names, i + 2, F.greatest(F.size(names) - i - 1, F.lit(0))), lambda y: F.struct(x.alias("a"), y.alias("b")))))
    return articles.select(*(keep or []), F.explode(both).alias("p")).select(*(keep or []), "p.a", "p.b")


def cooccurrence(articles: DataFrame, columns: list[str], least: int = 3) -> DataFrame:
    """``a, b, n`` of entity pairs with ``least`` articles in common."""
    return pairs(articles, columns).groupBy("a", "b").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def hidden_connections(edges: DataFrame, top: int = 200, least: float = 0.3) -> DataFrame:
    """Pairs of the ``top`` best connected entities that share neighbours but aren't linked: ``a, b, common, jaccard``.

    Common neighbours are counted by a join on the neighbour; the number of entities that take part is bounded by ``top``.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    degree = both.groupBy("a").agg(F.count("*").alias("degree"))
    best = degree.orderBy(F.desc("degree"), "a").limit(top)
    near = both.join(F.broadcast(best), "a")
    common = near.alias("x").join(near.alias("y"), F.col("x.b") == F.col("y.b")).where("x.a < y.a").groupBy(F.col("x.a").alias("a"), F.col("y.a").alias("b"), F.col("x.degree").alias("da"), F.col("y.degree").alias("db")).agg(F.count("*").alias("common"))
    common = common.withColumn("jaccard", F.col("common") / (F.col("da") + F.col("db") - F.col("common"))).where(F.col("jaccard") >= least)
    return common.join(edges.select("a", "b"), ["a", "b"], "left_anti").select("a", "b", "common", "jaccard")


def weekly_trajectory(articles: DataFrame, top: int = 50) -> DataFrame:
    """Weekly share of mentions of the commonest entities, with slope and variation, and the class they make."""
    m = mentions(articles, ALL, ["day"]).withColumn("week", iso_week("day"))
    best = m.groupBy("entity").count().orderBy(F.desc("count"), "entity").limit(top).select("entity")
    weeks = m.groupBy("week").agg(F.count("*").alias("total")).withColumn("x", F.row_number().over(Window.orderBy("week")) - 1)  # one row a week
    n = m.join(F.broadcast(best), "entity", "left_semi").groupBy("entity", "week").agg(F.count("*").alias("n"))
    full = best.crossJoin(F.broadcast(weeks)).join(n, ["entity", "week"], "left").withColumn("share", F.coalesce("n", F.lit(0)) / F.col("total"))
    out = full.groupBy("entity").agg(F.regr_slope("share", F.col("x").cast("double")).alias("slope"), F.avg("share").alias("mean"), (F.stddev_pop("share") / (F.avg("share") + 1e-10)).alias("variation"))
    kind = F.when(F.col("variation") > 0.5, "burst").when(F.col("slope") / F.col("mean") > 0.05, "rising").when(F.col("slope") / F.col("mean") < -0.05, "fading").otherwise("plateau")
    return out.withColumn("trajectory", kind)


def profiles(articles: DataFrame, least: int = 10, top: int = 100) -> DataFrame:
    """The ``top`` entities by articles: mean sentiment, share of negative over positive, topics, sources, first kind."""
    m = mentions(articles, {"entities_person": "person", "entities_org": "org"}, ["article_id", "sentiment_score", "topic_id", "source"])
    # a row for each entity, kind, topic and source comes first, with numbers only: hash tables hold these groups, while mentions are neither sorted nor repeated
    score = F.col("sentiment_score")
    some = m.groupBy("entity", "kind", "topic_id", "source").agg(
        F.count("*").alias("n"), F.count(score).alias("scored"), F.sum(score).alias("sum"), F.sum((score < -0.1).cast("long")).alias("below"), F.sum((score > 0.1).cast("long")).alias("above"),
        F.min("article_id").alias("first"), F.max(F.col("article_id").isNull()).alias("unknown"),
    )
    first = F.struct(F.when(~F.col("unknown"), F.col("first")), "kind")
    out = some.groupBy("entity").agg(
        F.sum("n").alias("n"), (F.sum("sum") / F.sum("scored")).alias("sentiment"), (F.sum("below") / F.sum("scored")).alias("negative"), (F.sum("above") / F.sum("scored")).alias("positive"),
        F.countDistinct("topic_id").alias("topics"), F.countDistinct("source").alias("sources"), F.min_by("kind", first).alias("kind"),
    )
    return out.where(F.col("n") >= least).orderBy(F.desc("n"), "entity").limit(top)


def tensions(articles: DataFrame, top: int = 30, least: int = 3) -> DataFrame:
    """Pairs among the ``top`` entities with ``least`` articles in common: mean sentiment, negative share, modal source, first title."""
    best = profiles(articles, 1, top).select("entity")
    p = pairs(articles, ["entities_person", "entities_org"], ["article_id", "sentiment_score", "source", "title"])
    p = p.join(F.broadcast(best.toDF("a")), "a", "left_semi").join(F.broadcast(best.toDF("b")), "b", "left_semi")
    out = p.groupBy("a", "b").agg(F.count("*").alias("n"), F.avg("sentiment_score").alias("sentiment"), F.avg((F.col("sentiment_score") < -0.1).cast("double")).alias("negative"), F.mode("source", True).alias("source"), F.min_by("title", "article_id").alias("title"))
    return out.where(F.col("n") >= least)


def jaccard_of_sets(rows: DataFrame, key: str, item: str) -> DataFrame:
    """Jaccard of the item sets of all key pairs (few keys)."""
    sets = rows.groupBy(key).agg(F.collect_set(item).alias("s"))
    return sets.toDF("a", "x").join(sets.toDF("b", "y"), F.col("a") < F.col("b")).select("a", "b", stats.jaccard(F.col("x"), F.col("y")).alias("jaccard"))
