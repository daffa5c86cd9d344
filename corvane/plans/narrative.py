"""Queries over narratives and entities."""

from pyspark.sql import functions as F

from ..operators import entities as E
from ..operators import narrative as N
from .registry import query
from .standins import CODES, articles, sql


def _r(*names, digits=6):
    return [F.round(n, digits).alias(n) for n in names]


_FR = ", ".join(f"count(*) FILTER (steeps_category = '{c}') / count(*) AS frame_{c}" for c in CODES)


@query("m2_frame_shares", sql(f"SELECT topic_id, topic_label, day, count(*) AS n, {', '.join(f'round({x}, 6) AS {y}' for x, y in (p.split(' AS ') for p in _FR.split(', ')))} FROM articles WHERE topic_id >= 0 GROUP BY ALL"))
def frames(spark, sf):
    return N.frame_shares(articles(spark, sf), CODES).select("topic_id", "topic_label", "day", "n", *_r(*(f"frame_{c}" for c in CODES)))


_S = lambda c: f"(frame_{c} + 1e-10) / (1 + {len(CODES)}e-10)"
_LAG = lambda c: f"(lag(frame_{c}) OVER w + 1e-10) / (1 + {len(CODES)}e-10)"


@query("m2_frame_shift", sql(f"""
f AS (SELECT topic_id, day, {_FR} FROM articles WHERE topic_id >= 0 GROUP BY ALL)
SELECT topic_id, day, round({' + '.join(f'{_S(c)} * ln({_S(c)} / ({_LAG(c)}))' for c in CODES)}, 5) AS kl FROM f WINDOW w AS (PARTITION BY topic_id ORDER BY day)"""))
def shift(spark, sf):
    return N.frame_shift(N.frame_shares(articles(spark, sf), CODES), CODES).withColumn("kl", F.round("kl", 5))


_VOICES = """
m AS (SELECT topic_id, unnest(list_concat(entities_person, entities_org)) AS entity FROM articles WHERE topic_id >= 0),
n AS (SELECT topic_id, entity, count(*) AS n, sum(count(*)) OVER (PARTITION BY topic_id) AS total FROM m GROUP BY topic_id, entity),
v AS (SELECT topic_id, sum((n / total) * (n / total)) AS hhi, arg_min(entity, {'c': -n, 'e': entity}) AS top_entity, max(n) / max(total) AS top_share, count(*) AS entities FROM n GROUP BY topic_id)"""


@query("m2_voices", sql(_VOICES + """
SELECT topic_id, round(hhi, 6) AS hhi, CASE WHEN hhi >= 0.25 THEN 'oligopoly' WHEN hhi <= 0.1 THEN 'healthy' ELSE 'moderate' END AS structure, top_entity, round(top_share, 6) AS top_share, entities FROM v"""))
def voices(spark, sf):
    return N.voices(articles(spark, sf)).select("topic_id", *_r("hhi", "top_share"), "structure", "top_entity", "entities")


@query("m2_media_health", sql(_VOICES + """,
s AS (SELECT topic_id, source, count(*) AS n, sum(count(*)) OVER (PARTITION BY topic_id) AS t FROM articles WHERE topic_id >= 0 GROUP BY 1, 2),
se AS (SELECT topic_id, CASE WHEN count(*) > 1 THEN -sum(n / t * log2(n / t)) / log2(count(*)) ELSE 0 END AS sources FROM s GROUP BY topic_id),
f AS (SELECT topic_id, steeps_category, count(*) AS n, sum(count(*)) OVER (PARTITION BY topic_id) AS t FROM articles WHERE topic_id >= 0 GROUP BY 1, 2),
fe AS (SELECT topic_id, -sum(n / t * log2(n / t)) / log2(6) AS frames FROM f GROUP BY topic_id),
h AS (SELECT *, 0.4 * sources + 0.3 * frames + 0.3 * (1 - hhi) AS health FROM se JOIN fe USING (topic_id) JOIN v USING (topic_id))
SELECT topic_id, round(sources, 6) AS sources, round(frames, 6) AS frames, round(hhi, 6) AS hhi, round(health, 6) AS health, CASE WHEN health >= 0.7 THEN 'A' WHEN health >= 0.4 THEN 'B' ELSE 'C' END AS grade FROM h"""))
def health(spark, sf):
    return N.media_health(articles(spark, sf)).select("topic_id", *_r("sources", "frames", "hhi", "health"), "grade")


@query("m2_source_credibility", sql("""
c AS (SELECT DISTINCT topic_id, day, source FROM articles WHERE topic_id >= 0),
s AS (SELECT *, count(*) OVER (PARTITION BY topic_id, day) >= 2 AS shared FROM c)
SELECT source, count(*) AS claims, CAST(sum(CAST(shared AS INT)) AS BIGINT) AS corroborated, round(sum(CAST(shared AS INT)) / count(*), 6) AS credibility FROM s GROUP BY source"""))
def credibility(spark, sf):
    return N.credibility(articles(spark, sf), singles=True).withColumn("credibility", F.round("credibility", 6))


_FLOW = """
f AS (SELECT a.source AS src, b.source AS dst, count(*) AS weight FROM articles a JOIN articles b ON a.topic_id = b.topic_id AND a.source <> b.source
  AND a.published_at < b.published_at AND epoch(date_trunc('second', b.published_at)) - epoch(date_trunc('second', a.published_at)) <= 86400
  AND a.title = b.title AND a.topic_id >= 0 GROUP BY ALL)"""


@query("m2_information_flow", sql(_FLOW + " SELECT * FROM f"))
def flow(spark, sf):
    return N.information_flow(articles(spark, sf).select("topic_id", "source", "published_at", "title"), same=["title"])


_M = """
m AS (SELECT article_id, language, day, topic_id, source, sentiment_score, unnest(entities_person) AS entity, 'person' AS kind FROM articles
  UNION ALL SELECT article_id, language, day, topic_id, source, sentiment_score, unnest(entities_org), 'org' FROM articles
  UNION ALL SELECT article_id, language, day, topic_id, source, sentiment_score, unnest(entities_location), 'location' FROM articles)"""


@query("m3_reach", sql(_M + """
SELECT entity, printf('%d-W%02d', CAST(isoyear(day) AS INT), CAST(weekofyear(day) AS INT)) AS week, count(DISTINCT language) AS n_languages, string_agg(DISTINCT language, ',' ORDER BY language) AS languages, count(*) AS mentions FROM m GROUP BY ALL"""))
def reach(spark, sf):
    return E.reach(articles(spark, sf))


@query("m3_emergence", sql(_M + """,
d AS (SELECT entity, day, count(*) AS n FROM m GROUP BY ALL), f AS (SELECT entity, min(day) AS first_day FROM d GROUP BY entity),
g AS (SELECT entity, first_day, x, CAST(first_day + CAST(x AS INT) AS DATE) AS day FROM f, range(14) AS r(x)),
c AS (SELECT g.entity, first_day, CAST(x AS DOUBLE) AS x, coalesce(n, 0) AS n, sum(coalesce(n, 0)) OVER (PARTITION BY g.entity ORDER BY x) AS s FROM g LEFT JOIN d ON d.entity = g.entity AND d.day = g.day)
SELECT entity, first_day, CAST(sum(n) AS BIGINT) AS mentions, round(regr_slope(CAST(s AS DOUBLE), x), 5) AS slope,
  round(2 * sum(s * ((x - 6.5) * (x - 6.5) - 16.25)) / 2912, 5) + 0.0 AS acceleration FROM c GROUP BY ALL"""))
def emergence(spark, sf):
    return E.emergence(articles(spark, sf)).select("entity", "first_day", "mentions", F.round("slope", 5).alias("slope"), (F.round("acceleration", 5) + F.lit(0.0)).alias("acceleration"))


_CO = """
e AS (SELECT article_id, sentiment_score, source, title, list_sort(list_distinct(list_concat(entities_person, entities_org))) AS l FROM articles),
x AS (SELECT article_id, sentiment_score, source, title, unnest(l) AS a, l FROM e), p AS (SELECT * EXCLUDE (b), b FROM (SELECT * EXCLUDE (l), unnest(l) AS b FROM x) WHERE a < b)"""


@query("graph_cooccurrence", sql(_CO + " SELECT a, b, count(*) AS n FROM p GROUP BY ALL HAVING count(*) >= 3"))
def cooccurrence(spark, sf):
    return E.cooccurrence(articles(spark, sf), ["entities_person", "entities_org"])


@query("m3_hidden_connections", sql(_CO + """,
g AS (SELECT a, b, count(*) AS n FROM p GROUP BY ALL HAVING count(*) >= 3), o AS (SELECT a, b FROM g UNION ALL SELECT b, a FROM g),
d AS (SELECT a, count(*) AS degree FROM o GROUP BY a ORDER BY degree DESC, a LIMIT 200), k AS (SELECT o.a, o.b, degree FROM o JOIN d ON o.a = d.a),
c AS (SELECT x.a AS a, y.a AS b, x.degree AS da, y.degree AS db, count(*) AS common FROM k x JOIN k y ON x.b = y.b AND x.a < y.a GROUP BY ALL)
SELECT a, b, common, round(common / (da + db - common), 6) AS jaccard FROM c WHERE common / (da + db - common) >= 0.3 AND (a, b) NOT IN (SELECT (a, b) FROM g)"""))
def hidden(spark, sf):
    edges = E.cooccurrence(articles(spark, sf), ["entities_person", "entities_org"])
    return E.hidden_connections(edges).withColumn("jaccard", F.round("jaccard", 6))


@query("m3_hidden_connections_whole", sql(_CO + """,
g AS (SELECT a, b, count(*) AS n FROM p GROUP BY ALL HAVING count(*) >= 3), o AS (SELECT a, b FROM g UNION ALL SELECT b, a FROM g),
d AS (SELECT a, count(*) AS degree FROM o GROUP BY a ORDER BY degree DESC, a LIMIT 200), k AS (SELECT o.a, o.b, degree FROM o JOIN d ON o.a = d.a),
c AS (SELECT x.a AS a, y.a AS b, x.degree AS da, y.degree AS db, count(*) AS common FROM k x JOIN k y ON x.b = y.b AND x.a < y.a GROUP BY ALL)
SELECT a, b, common, round(common / (da + db - common), 6) AS jaccard FROM c WHERE common / (da + db - common) >= 0.3 AND (a, b) NOT IN (SELECT (a, b) FROM g)"""))
def hidden_whole(spark, sf):
    """The same as m3_hidden_connections, under the name that earlier figures have."""
    return E.hidden_connections(E.cooccurrence(articles(spark, sf), ["entities_person", "entities_org"])).withColumn("jaccard", F.round("jaccard", 6))


@query("m3_trajectories", sql(_M + """,
w AS (SELECT *, isoyear(day) * 100 + weekofyear(day) AS week FROM m), b AS (SELECT entity FROM w GROUP BY entity ORDER BY count(*) DESC, entity LIMIT 50),
t AS (SELECT week, count(*) AS total, row_number() OVER (ORDER BY week) - 1 AS x FROM w GROUP BY week), n AS (SELECT entity, week, count(*) AS n FROM w GROUP BY ALL),
f AS (SELECT b.entity, x, coalesce(n, 0) / total AS share FROM b, t LEFT JOIN n ON n.entity = b.entity AND n.week = t.week),
s AS (SELECT entity, regr_slope(share, x) AS slope, avg(share) AS mean, stddev_pop(share) / (avg(share) + 1e-10) AS variation FROM f GROUP BY entity)
SELECT entity, round(slope, 7) + 0.0 AS slope, round(mean, 6) AS mean, round(variation, 5) AS variation,
  CASE WHEN variation > 0.5 THEN 'burst' WHEN slope / mean > 0.05 THEN 'rising' WHEN slope / mean < -0.05 THEN 'fading' ELSE 'plateau' END AS trajectory FROM s"""))
def trajectories(spark, sf):
    return E.weekly_trajectory(articles(spark, sf)).select("entity", (F.round("slope", 7) + F.lit(0.0)).alias("slope"), F.round("mean", 6).alias("mean"), F.round("variation", 5).alias("variation"), "trajectory")


_PROF = """
q AS (SELECT entity, count(*) AS n, avg(sentiment_score) AS sentiment, avg(CAST(sentiment_score < -0.1 AS INT)) AS negative, avg(CAST(sentiment_score > 0.1 AS INT)) AS positive,
  count(DISTINCT topic_id) AS topics, count(DISTINCT source) AS sources, arg_min(kind, {'a': article_id, 'k': kind}) AS kind FROM m WHERE kind <> 'location' GROUP BY entity)"""


@query("m7_entity_profiles", sql(_M + "," + _PROF + """
SELECT entity, n, round(sentiment, 6) AS sentiment, round(negative, 6) AS negative, round(positive, 6) AS positive, topics, sources, kind FROM q WHERE n >= 10 ORDER BY n DESC, entity LIMIT 100"""))
def profiles(spark, sf):
    return E.profiles(articles(spark, sf)).select("entity", "n", *_r("sentiment", "negative", "positive"), "topics", "sources", "kind")


@query("m7_pair_tensions", sql(_M + "," + _PROF + "," + _CO + """, b AS (SELECT entity FROM q ORDER BY n DESC, entity LIMIT 30),
s AS (SELECT a, b, source, count(*) AS c FROM p GROUP BY ALL), o AS (SELECT a, b, arg_min(source, {'c': -c, 's': source}) AS source FROM s GROUP BY ALL)
SELECT p.a, p.b, count(*) AS n, round(avg(sentiment_score), 9) + 0.0 AS sentiment, round(avg(CAST(sentiment_score < -0.1 AS INT)), 6) AS negative, any_value(o.source) AS source, arg_min(title, article_id) AS title
FROM p JOIN o ON o.a = p.a AND o.b = p.b WHERE p.a IN (SELECT entity FROM b) AND p.b IN (SELECT entity FROM b) GROUP BY ALL HAVING count(*) >= 3"""))
def tensions(spark, sf):
    return E.tensions(articles(spark, sf)).select("a", "b", "n", (F.round("sentiment", 9) + F.lit(0.0)).alias("sentiment"), *_r("negative"), "source", "title")
