"""Queries of the week's view, over daily answers that the articles give."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import weekly as V
from .registry import query
from .standins import articles, sql

_WEEK = "BETWEEN DATE '2024-01-22' AND DATE '2024-01-28'"
_BURSTS = """d AS (SELECT day, steeps_primary AS code, count(*) AS n FROM articles GROUP BY ALL),
b AS (SELECT *, n / avg(n) OVER w AS burst, CASE WHEN n > lag(n) OVER v THEN 'rising' WHEN n < lag(n) OVER v THEN 'falling' ELSE 'stable' END AS trend FROM d WINDOW w AS (PARTITION BY code ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), v AS (PARTITION BY code ORDER BY day))"""


def _bursts(spark, sf):
    n = articles(spark, sf).groupBy("day", F.col("steeps_primary").alias("code")).agg(F.count("*").alias("n"))
    w = Window.partitionBy("code").orderBy("day")
    before = F.lag("n").over(w)
    return n.select("day", "code", (F.col("n") / F.avg("n").over(w.rowsBetween(-7, -1))).alias("burst"), F.when(F.col("n") > before, "rising").when(F.col("n") < before, "falling").otherwise("stable").alias("trend"))


@query("r2_weekly_bursts", sql(_BURSTS + f" SELECT code, round(avg(burst), 6) AS mean_burst FROM b WHERE day {_WEEK} GROUP BY code"))
def weekly_bursts(spark, sf):
    return V.mean_bursts(V.period(_bursts(spark, sf), "week", "2024-01-25")).withColumn("mean_burst", F.round("mean_burst", 6))


@query("r3_weekly_shifts", sql(_BURSTS + f" SELECT code, CAST(sum(CAST(trend = 'rising' AS INT)) AS BIGINT) AS rising, CAST(sum(CAST(trend = 'falling' AS INT)) AS BIGINT) AS falling FROM b WHERE day {_WEEK} GROUP BY code ORDER BY sum(CAST(trend <> 'stable' AS INT)) DESC, code LIMIT 5"))
def weekly_shifts(spark, sf):
    from ..operators.synthesis import weekly_shifts

    return weekly_shifts(V.period(_bursts(spark, sf), "week", "2024-01-25"))


@query("r4_top_signals", sql(f"SELECT article_id, day, novelty_score FROM articles WHERE day {_WEEK} AND signal_type = 'WEAK_SIGNAL' ORDER BY novelty_score DESC, article_id LIMIT 8"))
def top_signals(spark, sf):
    return V.top_signals(V.period(articles(spark, sf), "week", "2024-01-28").where("signal_type = 'WEAK_SIGNAL'")).select("article_id", "day", "novelty_score")


@query("r5_shift_sums", sql(f"""c AS (SELECT day, sum(CAST(list_contains(steeps_all, 'CRS') AS INT)) AS c FROM articles WHERE day {_WEEK} GROUP BY day),
p AS (SELECT day, geo_focus_primary FROM articles WHERE day {_WEEK} GROUP BY ALL HAVING count(DISTINCT language) >= 3) SELECT CAST((SELECT sum(c) FROM c) AS BIGINT) AS crossing, (SELECT count(*) FROM p) AS multilingual"""))
def shift_sums(spark, sf):
    a = V.period(articles(spark, sf), "week", "2024-01-22")
    crossing = a.groupBy("day").agg(F.sum(F.array_contains("steeps_all", "CRS").cast("int")).alias("crossing"))
    places = a.groupBy("day", "geo_focus_primary").agg(F.countDistinct("language").alias("k")).groupBy("day").agg(F.sum((F.col("k") >= 3).cast("int")).alias("multilingual"))
    return V.shift_sums(crossing.join(places, "day"))


@query("r6_setter_days", sql(f"""n AS (SELECT day, source, count(*) AS n FROM articles WHERE day {_WEEK} GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY day ORDER BY n DESC, source) AS k FROM n)
SELECT source, count(*) AS days FROM r WHERE k <= 3 GROUP BY source ORDER BY days DESC, source LIMIT 8"""))
def setter_days(spark, sf):
    n = V.period(articles(spark, sf), "week", "2024-01-25").groupBy("day", "source").agg(F.count("*").alias("n"))
    return V.days_in_top(n, "source", "n", 3, 8)


@query("r6_dark_days", sql(f"""c AS (SELECT day, source_region AS region, geo_focus_primary AS place, count(*) AS c FROM articles WHERE day {_WEEK} GROUP BY day, source_region, geo_focus_primary), n AS (SELECT *, c / sum(c) OVER (PARTITION BY day) AS share FROM c)
SELECT region || '/' || place AS subject, count(DISTINCT day) AS days FROM n WHERE share < 0.03 GROUP BY 1 ORDER BY days DESC, subject LIMIT 12"""))
def dark_days(spark, sf):
    n = V.period(articles(spark, sf), "week", "2024-01-25").groupBy("day", F.concat_ws("/", "source_region", "geo_focus_primary").alias("subject")).agg(F.count("*").alias("n"))
    n = n.withColumn("dark", F.col("n") / F.sum("n").over(Window.partitionBy("day")) < 0.03)
    return V.days_with(n, "subject", "dark", 12)


@query("r7_top_names", sql(f"""m AS (SELECT 'PERSON' AS type, unnest(entities_person) AS entity FROM articles WHERE day {_WEEK} UNION ALL SELECT 'ORG', unnest(entities_org) FROM articles WHERE day {_WEEK} UNION ALL SELECT 'GPE', unnest(entities_location) FROM articles WHERE day {_WEEK}),
n AS (SELECT type, entity, count(*) AS mentions FROM m GROUP BY ALL), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY type ORDER BY mentions DESC, entity) AS INT) AS rank FROM n) SELECT * FROM r WHERE rank <= 6"""))
def top_names(spark, sf):
    a = V.period(articles(spark, sf), "week", "2024-01-25")
    types = F.array(*(F.struct(F.lit(t).alias("type"), F.col(c).alias("e")) for t, c in (("PERSON", "entities_person"), ("ORG", "entities_org"), ("GPE", "entities_location"))))
    daily = a.select("day", F.explode(types).alias("x")).select("day", "x.type", F.explode("x.e").alias("entity")).groupBy("day", "type", "entity").agg(F.count("*").alias("n"))
    return V.top_by_type(daily)


@query("r8_outlook", sql(_BURSTS + ", l AS (SELECT DISTINCT day FROM b ORDER BY day DESC LIMIT 3) SELECT code, count(DISTINCT day) AS days FROM b WHERE trend = 'rising' AND day IN (SELECT day FROM l) GROUP BY code"))
def outlook(spark, sf):
    return V.outlook(_bursts(spark, sf))


_MODULES = "CASE event_id % 6 WHEN 0 THEN 'geopolitical' WHEN 1 THEN 'economic' WHEN 2 THEN 'crosslingual' WHEN 3 THEN 'narrative' WHEN 4 THEN 'entity' ELSE 'temporal' END"


@query("r10_coupled", f"""
WITH f AS (SELECT {_MODULES} AS m, CASE WHEN event_id % 4 = 2 THEN 'CL-4' ELSE 'X' END AS k FROM events), n AS (SELECT count(*) FILTER (m = 'geopolitical') AS g, count(*) FILTER (m = 'economic') AS e, count(*) FILTER (m = 'crosslingual' AND k = 'CL-4') AS s, count(*) FILTER (m = 'narrative') AS a, count(*) FILTER (m = 'entity') AS b, count(*) FILTER (m = 'temporal') AS t FROM f)
SELECT 'conflict_economy' AS signal, g + e AS n FROM n WHERE g > 0 AND e > 0 UNION ALL SELECT 'language_silos', s FROM n WHERE s >= 3 UNION ALL SELECT 'voices_entities', a + b FROM n WHERE a > 0 AND b > 0 UNION ALL SELECT 'fast_propagation', t FROM n WHERE t >= 3""")
def coupled(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet")
    return V.coupled(e.select(F.expr(_MODULES).alias("module"), F.when(F.col("event_id") % 4 == 2, "CL-4").otherwise("X").alias("metric")))


for _kind, _range in (("day", "= DATE '2024-01-17'"), ("week", "BETWEEN DATE '2024-01-15' AND DATE '2024-01-21'"), ("month", "BETWEEN DATE '2024-01-01' AND DATE '2024-01-31'"), ("quarter", "BETWEEN DATE '2024-01-01' AND DATE '2024-03-31'"), ("year", "BETWEEN DATE '2024-01-01' AND DATE '2024-12-31'")):

    def _period(spark, sf, kind=_kind):
        return V.period(articles(spark, sf), kind, "2024-01-17").groupBy("source").agg(F.count("*").alias("n"), F.countDistinct("day").alias("days"))

    query(f"r14_{_kind}", sql(f"SELECT source, count(*) AS n, count(DISTINCT day) AS days FROM articles WHERE day {_range} GROUP BY source"))(_period)
