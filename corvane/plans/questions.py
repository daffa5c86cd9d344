"""The daily questions over the derived articles; today is the last day there is."""

import datetime

from pyspark.sql import functions as F

from ..operators import questions as Q
from .registry import query
from .standins import articles, sql

TODAY = datetime.date(2024, 1, 30)
_H = "hist AS (SELECT * FROM articles WHERE day >= DATE '2023-12-31' AND day < DATE '2024-01-30'), "
_T = "today AS (SELECT * FROM articles WHERE day = DATE '2024-01-30')"
HOT = ["US", "KR"]


def _p(n, digits=6):
    return (F.round(n, digits) + F.lit(0.0)).alias(n)


def _daily(name, text, f, rounded=(), digits=6):
    @query(name, sql(text))
    def run(spark, sf):
        df = f(articles(spark, sf), TODAY)
        return df.select(*(_p(c, digits) if c in rounded else c for c in df.columns))

    return run


_daily("q01_burst", _H + _T + """, n AS (SELECT steeps_primary, count(*) AS n FROM today GROUP BY 1),
o AS (SELECT steeps_primary, avg(c) AS usual FROM (SELECT steeps_primary, day, count(*) AS c FROM hist GROUP BY 1, 2) GROUP BY 1)
SELECT n.steeps_primary, n, round(usual, 6) AS usual, round(n / usual, 6) AS ratio FROM n LEFT JOIN o ON o.steeps_primary = n.steeps_primary""", Q.burst, ("usual", "ratio"))
_daily("q02_trend", """d AS (SELECT steeps_primary, day, count(*) AS n FROM articles WHERE day BETWEEN DATE '2024-01-23' AND DATE '2024-01-30' GROUP BY 1, 2),
l AS (SELECT *, day = max(day) OVER (PARTITION BY steeps_primary) AS l FROM d), g AS (SELECT steeps_primary, max(n) FILTER (l) AS n, avg(n) FILTER (NOT l) AS before FROM l GROUP BY 1)
SELECT steeps_primary, n, round(before, 6) AS before, round((n - before) / before, 6) + 0.0 AS change, CASE WHEN (n - before) / before > 0.2 THEN 'rising' WHEN (n - before) / before < -0.2 THEN 'falling' ELSE 'stable' END AS trend FROM g""", Q.trend, ("before", "change"))
_daily("q03_before_after", """g AS (SELECT steeps_primary, CAST(sum(CAST(day < DATE '2024-01-23' AS INT)) AS BIGINT) AS before, CAST(sum(CAST(day >= DATE '2024-01-23' AS INT)) AS BIGINT) AS after FROM articles WHERE day BETWEEN DATE '2023-12-31' AND DATE '2024-01-30' GROUP BY 1)
SELECT *, round((after - before) / CASE WHEN before = 0 THEN 1 ELSE before END * 100, 6) + 0.0 AS change FROM g""", Q.before_after, ("change",))
_daily("q04_framing", _T + """, k AS (SELECT *, count(*) OVER (PARTITION BY language) AS c FROM today), w AS (SELECT language, unnest(regexp_extract_all(lower(title), '[a-z]{3,}')) AS word FROM k WHERE c >= 3),
n AS (SELECT language, word, count(*) AS n FROM w WHERE word NOT IN ('the', 'and', 'oil') GROUP BY 1, 2), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY language ORDER BY n DESC, word) AS INT) AS rank FROM n)
SELECT * FROM r WHERE rank <= 8""", lambda a, t: Q.framing(a, t, ["the", "and", "oil"]))
_LABEL = "CASE WHEN sentiment > 0.1 THEN 'positive' WHEN sentiment < -0.1 THEN 'negative' ELSE 'neutral' END"
_C = "cs AS (SELECT source_country, count(*) AS n, avg(sentiment_score) AS sentiment FROM today GROUP BY 1 ORDER BY n DESC, source_country LIMIT 10)"
_daily("q05_country_sentiment", _T + ", " + _C + f" SELECT source_country, n, round(sentiment, 9) + 0.0 AS sentiment, {_LABEL} AS label FROM cs", Q.country_sentiment, ("sentiment",), 9)
_R = "rs AS (SELECT source_region, count(*) AS n, count(DISTINCT source) AS sources, count(*) / sum(count(*)) OVER () AS share, count(*) / sum(count(*)) OVER () < 0.03 AS dark FROM today GROUP BY 1)"
_daily("q06_dark_corners", _T + ", " + _R + " SELECT source_region, n, sources, round(share, 6) AS share, dark FROM rs", Q.dark_corners, ("share",))
_P = "cp AS (SELECT l[1] AS a, l[2] AS b, count(*) AS n, avg(sentiment_score) AS sentiment FROM (SELECT *, list_sort(list_distinct(geo_focus_all)) AS l FROM today) WHERE len(l) = 2 GROUP BY 1, 2 ORDER BY n DESC, abs(avg(sentiment_score)) DESC, a, b LIMIT 10)"
_daily("q07_country_pairs", _T + ", " + _P + " SELECT a, b, n, round(sentiment, 9) + 0.0 AS sentiment FROM cp", Q.country_pairs, ("sentiment",), 9)
_daily("q08_weak_signals", _T + """ SELECT article_id, title, novelty_score, signal_type FROM today WHERE signal_type = 'WEAK_SIGNAL' OR novelty_score >= 0.6 ORDER BY novelty_score DESC, article_id LIMIT 10""", Q.weak_signals)
_daily("q09_paradigms", _T + """ SELECT geo_focus_primary, count(DISTINCT language) AS languages, CAST(sum(CAST(list_contains(steeps_all, 'CRS') AS INT)) AS BIGINT) AS crossing, count(*) AS n FROM today GROUP BY 1 HAVING count(DISTINCT language) >= 3""", Q.paradigms)
_daily("q10_migration", """n AS (SELECT steeps_primary, day, count(DISTINCT source) AS s FROM articles WHERE day BETWEEN DATE '2023-12-31' AND DATE '2024-01-30' GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY steeps_primary ORDER BY day) <= count(*) OVER (PARTITION BY steeps_primary) // 2 AS f FROM n), g AS (SELECT steeps_primary, avg(s) FILTER (f) AS early, avg(s) FILTER (NOT f) AS late FROM r GROUP BY 1)
SELECT steeps_primary, round(early, 6) AS early, round(late, 6) AS late, round(late / early, 6) AS ratio, CASE WHEN late / early > 1.2 THEN 'spreading' WHEN late / early < 0.8 THEN 'shrinking' ELSE 'stable' END AS "move" FROM g""", Q.migration, ("early", "late", "ratio"))
_daily("q11_setters", """o AS (SELECT DISTINCT geo_focus_primary, unnest(steeps_all) AS code FROM articles WHERE day BETWEEN DATE '2023-12-31' AND DATE '2024-01-29'),
t AS (SELECT source, source_tier, geo_focus_primary, unnest(steeps_all) AS code FROM articles WHERE day = DATE '2024-01-30')
SELECT source, source_tier, count(*) AS n FROM t WHERE (geo_focus_primary, code) NOT IN (SELECT (geo_focus_primary, code) FROM o) GROUP BY 1, 2""", Q.setters)
_daily("q11_setters_history", """o AS (SELECT DISTINCT geo_focus_primary, unnest(steeps_all) AS code FROM articles WHERE day BETWEEN DATE '2023-12-31' AND DATE '2024-01-29'),
t AS (SELECT source, source_tier, geo_focus_primary, unnest(steeps_all) AS code FROM articles WHERE day = DATE '2024-01-30')
SELECT source, source_tier, count(*) AS n FROM t WHERE (geo_focus_primary, code) NOT IN (SELECT (geo_focus_primary, code) FROM o) GROUP BY 1, 2""", Q.setters)  # the same, under the name that earlier figures have
_daily("q12_leaning", _T + """, n AS (SELECT source_lean, steeps_primary, count(*) AS n FROM today WHERE source_lean <> 'UNKNOWN' GROUP BY 1, 2), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY source_lean ORDER BY n DESC, steeps_primary) AS INT) AS rank FROM n) SELECT * FROM r WHERE rank <= 5""", Q.leaning)
_S = _T + ", s AS (SELECT DISTINCT language, geo_focus_primary || '/' || steeps_primary AS subject FROM today)"
_daily("q13_exclusive", _S + " SELECT min(language) AS language, subject FROM s GROUP BY subject HAVING count(*) = 1", Q.exclusive)
_daily("q13_overlap", _S + """, l AS (SELECT DISTINCT language FROM s) SELECT a.language AS a, b.language AS b,
  round((SELECT count(*) FROM s x JOIN s y ON x.subject = y.subject WHERE x.language = a.language AND y.language = b.language) / (SELECT count(DISTINCT subject) FROM s WHERE language IN (a.language, b.language)), 6) AS jaccard FROM l a JOIN l b ON a.language < b.language""", Q.agenda_overlap, ("jaccard",))
# Places that today alone has, each in one language.
_PLANTED = "CASE WHEN day = DATE '2024-01-30' AND article_id % 7 = 0 THEN CONCAT('new-', language) ELSE geo_focus_primary END"
_N = f"p AS (SELECT * REPLACE ({_PLANTED} AS geo_focus_primary) FROM articles), "


def _planted(a):
    return a.withColumn("geo_focus_primary", F.expr(_PLANTED))


_daily("q11_new_places", _N + """o AS (SELECT DISTINCT geo_focus_primary, unnest(steeps_all) AS code FROM p WHERE day BETWEEN DATE '2023-12-31' AND DATE '2024-01-29'),
t AS (SELECT source, source_tier, geo_focus_primary, unnest(steeps_all) AS code FROM p WHERE day = DATE '2024-01-30')
SELECT source, source_tier, count(*) AS n FROM t WHERE (geo_focus_primary, code) NOT IN (SELECT (geo_focus_primary, code) FROM o) GROUP BY 1, 2""", lambda a, t: Q.setters(_planted(a), t))
_daily("q13_own_places", _N + "s AS (SELECT DISTINCT language, geo_focus_primary || '/' || steeps_primary AS subject FROM p WHERE day = DATE '2024-01-30') SELECT min(language) AS language, subject FROM s GROUP BY subject HAVING count(*) = 1", lambda a, t: Q.exclusive(_planted(a), t))
_daily("q14_coverage_gap", _T + """, n AS (SELECT language, count(DISTINCT source) AS s FROM today GROUP BY 1) SELECT a.language AS a, b.language AS b, a.s AS x, b.s AS y, round(abs(a.s - b.s) / greatest(a.s, b.s), 6) AS gap FROM n a JOIN n b ON a.language < b.language""", Q.coverage_gap, ("gap",))
_daily("q15_economic_series", """e AS (SELECT * FROM articles WHERE day BETWEEN DATE '2024-01-01' AND DATE '2024-01-30' AND steeps_primary = 'ECO') SELECT day, round(avg(sentiment_score), 9) + 0.0 AS sentiment, count(*) AS n FROM e GROUP BY day""", Q.economic_series, ("sentiment",), 9)
_daily("q16_code_pairs", """s AS (SELECT DISTINCT source, day, steeps_primary AS c FROM articles WHERE day BETWEEN DATE '2024-01-23' AND DATE '2024-01-30' AND steeps_primary <> 'CRS'),
n AS (SELECT x.c AS a, y.c AS b, x.day, count(*) AS n FROM s x JOIN s y ON x.source = y.source AND x.day = y.day AND x.c < y.c GROUP BY 1, 2, 3),
g AS (SELECT a, b, max(n) FILTER (day = DATE '2024-01-30') AS n, max(n) FILTER (day <> DATE '2024-01-30') AS most FROM n GROUP BY 1, 2)
SELECT a, b, n, most, round(n / most, 6) AS ratio, coalesce(n / most > 1.3, true) AS convergent FROM g WHERE n IS NOT NULL""", Q.code_pairs, ("ratio",))
_daily("q17_clusters", _T + """, n AS (SELECT steeps_primary, count(*) AS n, avg(sentiment_score) AS s, string_agg(DISTINCT language, ',' ORDER BY language) AS languages, count(DISTINCT source) AS sources FROM today GROUP BY 1),
p AS (SELECT steeps_primary, e, count(*) AS c FROM (SELECT steeps_primary, unnest(entities_person[1:3]) AS e FROM today) GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY steeps_primary ORDER BY c DESC, e) AS k FROM p),
q AS (SELECT steeps_primary, string_agg(e, ',' ORDER BY k) AS people FROM r WHERE k <= 5 GROUP BY 1)
SELECT n.steeps_primary, n, round(s, 9) + 0.0 AS sentiment, languages, sources, people FROM n LEFT JOIN q ON q.steeps_primary = n.steeps_primary""", Q.clusters, ("sentiment",), 9)
_daily("q18_entity_map", _T + """, m AS (SELECT unnest(entities_person) AS entity, 'person' AS kind, * FROM today UNION ALL SELECT unnest(entities_org), 'org', * FROM today UNION ALL SELECT unnest(entities_location), 'location', * FROM today),
c AS (SELECT entity, kind, arg_min(steeps_primary, {'c': -c, 's': steeps_primary}) AS code FROM (SELECT entity, kind, steeps_primary, count(*) AS c FROM m GROUP BY 1, 2, 3) GROUP BY 1, 2),
g AS (SELECT entity, kind, arg_min(geo_focus_primary, {'c': -c, 's': geo_focus_primary}) AS place FROM (SELECT entity, kind, geo_focus_primary, count(*) AS c FROM m GROUP BY 1, 2, 3) GROUP BY 1, 2)
SELECT m.entity, m.kind, count(*) AS n, round(avg(sentiment_score), 9) + 0.0 AS sentiment, any_value(code) AS code, any_value(place) AS place FROM m JOIN c ON c.entity = m.entity AND c.kind = m.kind JOIN g ON g.entity = m.entity AND g.kind = m.kind
GROUP BY 1, 2 ORDER BY n DESC, m.entity, m.kind LIMIT 10""", Q.entity_map, ("sentiment",), 9)
_daily("gti_index", _T + ", " + _C + ", " + _R + ", " + _P + """,
r AS (SELECT *, row_number() OVER (ORDER BY share) AS k, row_number() OVER (ORDER BY share DESC) AS d FROM rs),
g1 AS (SELECT round(least(100, (sum((2 * k - 1) * share) / count(*) - 1) * 50 + sum(share) FILTER (d <= 3) * 30 + avg(CAST(dark AS INT)) * 20), 2) AS g1 FROM r),
g2 AS (SELECT round(least(100, sum(CASE WHEN source_country IN ('US', 'KR') THEN n ELSE 0 END) / sum(n) * 60 + coalesce(avg(-least(sentiment, 0)) FILTER (source_country IN ('US', 'KR')), 0) * 40), 2) AS g2 FROM cs),
g3 AS (SELECT round(least(100, coalesce(avg(greatest(-sentiment, 0) * CASE WHEN a IN ('US', 'KR') OR b IN ('US', 'KR') THEN 1.5 ELSE 1 END), 0) * 100), 2) AS g3 FROM cp),
x AS (SELECT g1, g2, g3, round(0.40 * g1 + 0.35 * g2 + 0.25 * g3, 2) AS score FROM g1, g2, g3)
SELECT *, CASE WHEN score < 30 THEN 'low' WHEN score < 60 THEN 'moderate' WHEN score < 80 THEN 'high' ELSE 'critical' END AS label FROM x""", lambda a, t: Q.index(a, t, HOT))
_daily("portfolio_states", """s AS (SELECT title || ' ' || geo_focus_primary AS t, day FROM articles WHERE signal_type = 'WEAK_SIGNAL' AND day <= DATE '2024-01-30'),
g AS (SELECT replace(lower(t), ' ', '_') AS signal, count(DISTINCT day) AS days, min(day) AS first_seen, max(day) AS last_seen FROM s GROUP BY 1)
SELECT *, CASE WHEN DATE '2024-01-30' - last_seen >= 14 THEN 'dismissed' WHEN days >= 7 THEN 'confirmed' WHEN days >= 3 THEN 'emerging' ELSE 'watching' END AS status FROM g""", lambda a, t: Q.portfolio(a.where("signal_type = 'WEAK_SIGNAL'").select(Q.slug(F.concat_ws(" ", "title", "geo_focus_primary")).alias("signal"), "day"), t))
