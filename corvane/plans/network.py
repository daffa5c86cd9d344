"""Queries over graphs, series tests, vectors and the streams' bounded forms that came later than the first ones."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import entities, features, graph, grouped, narrative, search
from ..operators import series as S
from ..streaming import windows
from .registry import query
from .standins import CODES, articles, sql, table


def _p(n, digits=6):
    return (F.round(n, digits) + F.lit(0.0)).alias(n)


def _edges(spark, sf):
    return entities.cooccurrence(articles(spark, sf), ["entities_person", "entities_org"])


@query("a14_cooccurrence", sql("""e AS (SELECT article_id, unnest(list_distinct(steeps_all)) AS x FROM articles), n AS (SELECT x, count(*) AS n FROM e GROUP BY x),
p AS (SELECT a.x AS a, b.x AS b, count(*) AS shared FROM e a JOIN e b ON a.article_id = b.article_id AND a.x < b.x GROUP BY ALL)
SELECT a, b, shared, round(shared / (x.n + y.n - shared), 6) AS jaccard FROM p JOIN n x ON x.x = a JOIN n y ON y.x = b WHERE shared / (x.n + y.n - shared) >= 0.001"""))
def cooccurrence(spark, sf):
    return features.cooccurring(articles(spark, sf), labels="steeps_all").withColumn("jaccard", F.round("jaccard", 6))


@query("a16_betweenness")
def betweenness(spark, sf):
    return graph.betweenness(_edges(spark, sf)).withColumn("betweenness", F.round("betweenness", 9))


@query("a18_weekly_pagerank")
def weekly_pagerank(spark, sf):
    a = articles(spark, sf).withColumn("week", entities.iso_week("day"))
    pairs = entities.pairs(a, ["entities_person", "entities_org"], ["week"]).groupBy("week", "a", "b").agg(F.count("*").alias("n"))
    return graph.weekly_pagerank(pairs).withColumn("rank", F.round("rank", 6))


@query("a21_louvain")
def louvain(spark, sf):
    return graph.louvain(_edges(spark, sf))


def _volume(spark, sf):
    return S.daily(articles(spark, sf)).where("metric = 'volume'").select("series", "day", "value")


@query("a8_stationarity")
def stationarity(spark, sf):
    return grouped.stationarity(_volume(spark, sf)).withColumn("statistic", F.round("statistic", 6))


@query("a10_cascades")
def cascades(spark, sf):
    return grouped.cascades(_volume(spark, sf).where("series <> 'all'")).withColumn("p", F.round("p", 9))


@query("a4_shift_points")
def shift_points(spark, sf):
    shares = narrative.frame_shares(articles(spark, sf), CODES)
    return grouped.shift_points(narrative.frame_shift(shares, CODES)).withColumn("kl", F.round("kl", 9))


@query("f39_baseline_shift", sql("""n AS (SELECT topic_id, count(*) FILTER (day = (SELECT max(day) FROM articles)) AS now, count(*) AS base FROM articles GROUP BY topic_id),
p AS (SELECT now / sum(now) OVER () AS p, base / sum(base) OVER () + 1e-10 AS q FROM n), r AS (SELECT p, q / sum(q) OVER () AS q FROM p) SELECT round(greatest(0, sum(CASE WHEN p > 0 THEN p * ln(p / q) ELSE 0 END)), 8) + 0.0 AS kl FROM r"""))
def baseline_shift(spark, sf):
    return S.baseline_shift(articles(spark, sf)).withColumn("kl", F.round("kl", 8))


@query("f39_zipf", """
WITH w AS (SELECT lang, unnest(regexp_extract_all(lower(text), '\\p{L}{3,}')) AS term FROM documents), n AS (SELECT lang, term, count(*) AS n FROM w GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, term) AS rank FROM n),
k AS (SELECT lang, n / sum(n) OVER (PARTITION BY lang) AS p, 1 / rank / sum(1 / rank) OVER (PARTITION BY lang) AS q FROM r WHERE rank <= 1000)
SELECT lang, count(*) AS terms, round(CASE WHEN count(*) < 5 THEN 0 ELSE greatest(0, 1 - exp(-sum(p * ln(p / q)))) END, 6) AS deviation FROM k GROUP BY lang""")
def zipf(spark, sf):
    w = table(spark, sf, "documents").select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}{3,}"), F.lit(0))).alias("term"))
    return S.zipf_deviation(w.groupBy("lang", "term").agg(F.count("*").alias("n")), "lang").withColumn("deviation", F.round("deviation", 6))


@query("f41_coverage", """
WITH q AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id % 100 = 0), v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings)
SELECT q.vec_id, greatest(count(*) FILTER (v.vec_id <> q.vec_id AND list_cosine_similarity(q.e, v.e) > 0.75), 1) AS n_alike FROM q, v GROUP BY q.vec_id""")
def coverage(spark, sf):
    v = table(spark, sf, "embeddings")
    return search.alike(v, v.where("vec_id % 100 = 0"))


_VEC = ", ".join(f"emotion_{e}" for e in S.EMOTIONS)


@query("a24_alike_but_opposed", sql(f"""r AS (SELECT topic_id, article_id, source, [{_VEC}]::DOUBLE[] AS e, row_number() OVER (PARTITION BY topic_id ORDER BY article_id) AS k FROM articles WHERE topic_id >= 0),
p AS (SELECT x.topic_id, x.article_id AS a, y.article_id AS b, list_cosine_similarity(x.e, y.e) AS s FROM r x JOIN r y ON x.topic_id = y.topic_id AND y.k > x.k AND y.k < x.k + 20 AND x.source <> y.source)
SELECT topic_id, a, b, round(s, 6) AS similarity, round(s / 2, 6) AS score FROM p WHERE s >= 0.6 AND NOT isnan(s)"""))
def alike_but_opposed(spark, sf):
    """Emotions stand for a vector."""
    v = articles(spark, sf).select("topic_id", "article_id", "source", F.col("title").alias("text"), F.array(*(F.col(f"emotion_{e}") for e in S.EMOTIONS)).alias("embedding"))
    return features.alike_but_opposed(v).withColumn("similarity", F.round("similarity", 6)).withColumn("score", F.round("score", 6))


_TERMS = """w AS (SELECT doc_id, coalesce(lang, '') AS lang, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]{2,}') AS w FROM documents), e AS (SELECT doc_id, lang, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS term FROM w),
t AS (SELECT doc_id, lang, term, count(*) AS tf FROM e GROUP BY ALL), n AS (SELECT coalesce(lang, '') AS lang, count(*) AS n FROM documents GROUP BY 1), d AS (SELECT t.lang, term, ln((1 + n) / (1 + count(*))) + 1 AS idf FROM t JOIN n ON n.lang IS NOT DISTINCT FROM t.lang GROUP BY t.lang, term, n HAVING count(*) >= 2 AND count(*) <= 0.95 * n),
x AS (SELECT doc_id, t.term, (1 + ln(tf)) * idf AS w FROM t JOIN d ON d.term = t.term AND d.lang = t.lang), y AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM x),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY round(weight, 9) DESC, term) AS INT) AS rank FROM y)"""


def _pairs_of_words(spark, sf, top):
    return features.tfidf(table(spark, sf, "documents"), longest=2, by=F.coalesce("lang", F.lit("")), top=top)


@query("a26_word_pairs", "WITH " + _TERMS + " SELECT doc_id, term, round(weight, 6) AS weight, rank FROM r WHERE rank <= 20")
def word_pairs(spark, sf):
    """Words and pairs of words, with a vocabulary for each language."""
    return _pairs_of_words(spark, sf, 20).withColumn("weight", F.round("weight", 6))


@query("a28_keywords", "WITH " + _TERMS + " SELECT doc_id, string_agg(term, '|' ORDER BY rank) AS keywords FROM r WHERE rank <= 10 GROUP BY doc_id")
def keywords(spark, sf):
    """The ten leading terms: what is taken where no model ranks phrases."""
    k = _pairs_of_words(spark, sf, 10).groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("rank", "term"))).alias("k"))  # ten at the most
    return k.select("doc_id", F.array_join(F.transform("k", lambda x: x["term"]), "|").alias("keywords"))


@query("a36_sparse", "WITH " + _TERMS + """, v AS (SELECT DISTINCT term FROM r WHERE rank <= 20), i AS (SELECT term, row_number() OVER (ORDER BY term) - 1 AS i FROM v)
SELECT doc_id, (SELECT count(*) FROM v) AS size, count(*) AS entries, CAST(sum(i) AS BIGINT) AS indexes, round(sum(weight), 6) AS weights FROM r JOIN i ON i.term = r.term WHERE rank <= 20 GROUP BY doc_id""")
def sparse(spark, sf):
    s = features.sparse(_pairs_of_words(spark, sf, 20))
    total = lambda f: F.aggregate("entries", F.lit(0).cast("long") if f == "index" else F.lit(0.0), lambda acc, x: acc + x[f])
    return s.select("doc_id", "size", F.size("entries").cast("bigint").alias("entries"), total("index").alias("indexes"), F.round(total("weight"), 6).alias("weights"))


@query("a31_topics_over_time", sql("""w AS (SELECT topic_id, day, unnest(regexp_extract_all(lower(headline), '[\\p{L}\\p{N}]{2,}')) AS term FROM articles WHERE topic_id >= 0), t AS (SELECT topic_id, day, term, count(*) AS tf FROM w GROUP BY ALL),
s AS (SELECT *, sum(tf) OVER (PARTITION BY topic_id, day) AS size, sum(tf) OVER (PARTITION BY term) AS f FROM t), m AS (SELECT avg(size) AS mean FROM (SELECT sum(tf) AS size FROM t GROUP BY topic_id, day)),
c AS (SELECT topic_id, day, term, tf / size * ln(1 + mean / f) AS w FROM s, m), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY topic_id, day ORDER BY round(w, 9) DESC, term) AS INT) AS rank FROM c), n AS (SELECT topic_id, day, count(*) AS n FROM articles GROUP BY ALL)
SELECT r.topic_id, r.day, n, term, round(w, 6) AS weight, rank FROM r JOIN n ON n.topic_id = r.topic_id AND n.day = r.day WHERE rank <= 10"""))
def topics_over_time(spark, sf):
    a = articles(spark, sf).where("topic_id >= 0")
    return features.topics_over_time(a, text="headline").withColumn("weight", F.round("weight", 6))


@query("t5_breakers")
def breakers(spark, sf):
    e = table(spark, sf, "events").select(F.col("user_id").alias("site"), F.col("ts").cast("timestamp").alias("ts"), (F.col("event_type") != "error").alias("ok"))
    return windows.breakers(e)


@query("t4_unseen", "SELECT DISTINCT user_id AS url_key FROM events WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'error' AND value > 99)")
def unseen(spark, sf):
    e = table(spark, sf, "events").withColumnRenamed("user_id", "url_key")
    return windows.unseen(e, e.where("event_type = 'error' and value > 99")).select("url_key")


@query("a81_cross_lingual", sql(f"""v AS (SELECT language AS l, topic_id AS t, [{', '.join(f'avg(emotion_{e})' for e in S.EMOTIONS)}] AS v FROM articles WHERE topic_id >= 0 GROUP BY ALL),
p AS (SELECT x.l AS a, x.t AS ta, y.l AS b, y.t AS tb, list_cosine_similarity(x.v, y.v) AS s FROM v x JOIN v y ON x.l < y.l)
SELECT a, ta, b, tb, round(s, 6) AS cosine FROM p WHERE s >= CASE WHEN (SELECT max(s) FROM p) >= 0.7 THEN 0.7 ELSE 0.5 END"""))
def cross_lingual(spark, sf):
    c = articles(spark, sf).where("topic_id >= 0").groupBy("language", "topic_id").agg(F.array(*(F.avg(f"emotion_{e}") for e in S.EMOTIONS)).alias("c"))
    return features.cross_lingual(c).withColumn("cosine", F.round("cosine", 6))


@query("a16_strength", sql("""x AS (SELECT article_id, unnest(list_distinct(list_concat(entities_person, entities_org))) AS a FROM articles), p AS (SELECT x.a AS a, y.a AS b, count(*) AS n FROM x JOIN x y ON x.article_id = y.article_id AND x.a < y.a GROUP BY ALL HAVING count(*) >= 3)
SELECT a, b, n, round(least(1, ln(1 + n) / 10), 6) AS strength FROM p"""))
def strength(spark, sf):
    return _edges(spark, sf).select("a", "b", "n", F.round(F.least(F.lit(1.0), F.log1p("n") / 10), 6).alias("strength"))


@query("f48_states", sql("""d AS (SELECT topic_id, day, count(*) AS n FROM articles GROUP BY ALL), g AS (SELECT *, (n - lag(n) OVER w) / lag(n) OVER w AS g FROM d WINDOW w AS (PARTITION BY topic_id ORDER BY day))
SELECT topic_id, day, CASE WHEN n <= 3 THEN 'noise' WHEN n <= 10 AND coalesce(g, 0) < 0.5 THEN 'weak' WHEN coalesce(g, 0) >= 0.5 THEN 'emerging' ELSE 'strong' END AS state FROM g"""))
def states(spark, sf):
    from ..operators.signals import bertrend

    d = articles(spark, sf).groupBy("topic_id", "day").agg(F.count("*").alias("n"))
    before = F.lag("n").over(Window.partitionBy("topic_id").orderBy("day"))
    d = d.withColumn("g", F.coalesce((F.col("n") - before) / before, F.lit(0.0)))
    return d.select("topic_id", "day", bertrend(F.col("n"), F.col("g")).alias("state"))
