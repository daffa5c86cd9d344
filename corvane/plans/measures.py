"""Queries over countries, the economy and daily series."""

from pyspark.sql import functions as F

from ..operators import economy as C
from ..operators import geopolitics as G
from ..operators import series as S
from .registry import query
from .standins import EMOTIONS, articles, sql


def _p(n, digits=6):
    return (F.round(n, digits) + F.lit(0.0)).alias(n)


_EM = ", ".join(f"avg(emotion_{e}) AS emotion_{e}" for e in EMOTIONS)
_GEO = f"""
e AS (SELECT *, list_sort(list_distinct(entities_location)) AS l FROM articles WHERE len(list_distinct(entities_location)) = 2),
b AS (SELECT l[1] AS a, l[2] AS b, count(*) AS n, avg(sentiment_score) AS sentiment_score, {_EM} FROM e GROUP BY 1, 2 HAVING count(*) >= 10)"""


@query("m5_bilateral", sql(_GEO + f" SELECT a, b, n, round(sentiment_score, 9) + 0.0 AS sentiment_score, {', '.join(f'round(emotion_{e}, 9) AS emotion_{e}' for e in EMOTIONS)} FROM b"))
def bilateral(spark, sf):
    return G.bilateral(articles(spark, sf)).select("a", "b", "n", _p("sentiment_score", 9), *(F.round(f"emotion_{e}", 9).alias(f"emotion_{e}") for e in EMOTIONS))


@query("m5_conflict", sql(_GEO + ", r AS (SELECT a, b, (emotion_anger + emotion_fear) / (emotion_trust + emotion_anticipation + 1e-6) AS ratio FROM b) SELECT a, b, round(ratio, 6) AS ratio, CASE WHEN ratio > 1 THEN 'conflict' ELSE 'cooperation' END AS stance FROM r"))
def conflict(spark, sf):
    return G.conflict(G.bilateral(articles(spark, sf))).select("a", "b", _p("ratio"), "stance")


@query("m5_soft_power", sql("""
m AS (SELECT steeps_category, sentiment_score, unnest(list_distinct(entities_location)) AS country FROM articles),
b AS (SELECT country, count(*) AS n, avg(sentiment_score) AS s FROM m GROUP BY country),
f AS (SELECT country, steeps_category, count(*) AS n, sum(count(*)) OVER (PARTITION BY country) AS t FROM m GROUP BY 1, 2),
g AS (SELECT country, least(1, -sum(n / t * log2(n / t)) / log2(6)) AS frames FROM f GROUP BY country),
p AS (SELECT DISTINCT list_sort(list_distinct(entities_location)) AS l FROM articles WHERE len(list_distinct(entities_location)) = 2),
d AS (SELECT country, count(*) AS degree FROM (SELECT unnest(l) AS country FROM p) GROUP BY country)
SELECT b.country, n, coalesce(degree, 0) AS degree, round(frames, 6) AS frames,
  round(0.25 * n / max(n) OVER () + 0.30 * (s + 1) / 2 + 0.20 * frames + 0.25 * coalesce(degree, 0) / max(degree) OVER (), 6) AS soft_power FROM b JOIN g ON g.country = b.country LEFT JOIN d ON d.country = b.country"""))
def soft_power(spark, sf):
    return G.soft_power(articles(spark, sf)).select("country", "n", "degree", _p("frames"), _p("soft_power"))


_FIRST = "f AS (SELECT topic_id, language, min(published_at) AS t FROM articles WHERE topic_id >= 0 GROUP BY ALL)"


@query("m5_agenda_setting", sql(_FIRST + """,
l AS (SELECT *, min({'t': t, 'l': language}) OVER (PARTITION BY topic_id) AS k, count(*) OVER (PARTITION BY topic_id) AS n FROM f),
m AS (SELECT language, language = k.l AS led, (epoch_us(t) - epoch_us(k.t)) / 3.6e9 AS lag FROM l WHERE n >= 2)
SELECT language, CAST(sum(CAST(led AS INT)) AS BIGINT) AS led, count(*) AS compared, round(avg(lag) FILTER (NOT led), 6) AS mean_lag, round(sum(CAST(led AS INT)) / count(*), 6) AS leader_score FROM m GROUP BY language"""))
def agenda(spark, sf):
    return G.agenda_setting(articles(spark, sf)).select("language", "led", "compared", _p("mean_lag"), _p("leader_score"))


@query("m4_velocity", sql(_FIRST + """
SELECT a.language AS src, b.language AS dst, count(*) AS topics, round(avg((epoch_us(b.t) - epoch_us(a.t)) / 3.6e9), 6) AS mean_lag FROM f a JOIN f b ON a.topic_id = b.topic_id AND a.language <> b.language
WHERE epoch_us(b.t) >= epoch_us(a.t) AND (epoch_us(b.t) - epoch_us(a.t)) / 3.6e9 <= 72 GROUP BY ALL"""))
def velocity(spark, sf):
    return G.velocity(articles(spark, sf)).select("src", "dst", "topics", _p("mean_lag"))


def _re(words, lang):
    """The same alternation for an engine without look-around: bounds are characters or ends."""
    p = C.pattern(words, lang)
    return p.replace("(?iu)(?<![\\p{L}\\p{N}_])", "(?i)(?:^|[^\\p{L}\\p{N}_])").replace("(?![\\p{L}\\p{N}_])", "(?:$|[^\\p{L}\\p{N}_])")


_EPU = " ".join(f"WHEN '{lang}' THEN regexp_matches(headline, '{_re(w, lang)}')" for lang, w in C.UNCERTAINTY.items())


@query("m6_uncertainty", sql(f"SELECT language, day, count(*) AS n, round(avg(CAST(CASE language {_EPU} END AS INT)), 6) AS epu FROM articles WHERE language IN ({', '.join(repr(x) for x in C.UNCERTAINTY)}) GROUP BY ALL"))
def uncertainty(spark, sf):
    return C.uncertainty(articles(spark, sf), text="headline").select("language", "day", "n", _p("epu"))


_HITS = {s: " + ".join(f"len(regexp_extract_all(headline, '{C.pattern(w, lang)}'))" for lang, w in by.items()) for s, by in C.SECTORS.items()}


@query("m6_sector_sentiment", sql(f"""
h AS (SELECT day, sentiment_score, {', '.join(f'{h} AS h_{s}' for s, h in _HITS.items())} FROM articles WHERE steeps_category = 'E'),
s AS (SELECT *, CASE WHEN greatest({', '.join('h_' + s for s in _HITS)}) = 0 THEN NULL {' '.join(f"WHEN h_{s} = greatest({', '.join('h_' + x for x in _HITS)}) THEN '{s}'" for s in _HITS)} END AS sector FROM h)
SELECT sector, day, count(*) AS n, round(avg(sentiment_score), 9) + 0.0 AS sentiment FROM s WHERE sector IS NOT NULL AND (SELECT count(*) FROM s WHERE sector IS NOT NULL) >= 50 GROUP BY ALL"""))
def sectors(spark, sf):
    return C.sector_sentiment(articles(spark, sf), text="headline").select("sector", "day", "n", _p("sentiment", 9))


_NARR = " UNION ALL ".join(f"SELECT '{k}' AS narrative, language, day, sentiment_score, regexp_matches(headline, '{_re(w, lang)}') AS hit FROM articles WHERE language = '{lang}'" for k, by in C.NARRATIVES.items() for lang, w in by.items())


@query("m6_narratives", sql(f"""
x AS ({_NARR}),
n AS (SELECT narrative, language, day, CAST(sum(CAST(hit AS INT)) AS BIGINT) AS matches, avg(CAST(hit AS INT)) AS prevalence, coalesce(avg(sentiment_score) FILTER (hit), 0) AS sentiment FROM x GROUP BY ALL)
SELECT narrative, language, day, matches, round(prevalence, 6) AS prevalence, round(sentiment, 9) + 0.0 AS sentiment, round(avg(matches) OVER w, 6) AS matches_mean, round(avg(sentiment) OVER w, 9) + 0.0 AS sentiment_mean
FROM n WINDOW w AS (PARTITION BY narrative, language ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"""))
def narratives(spark, sf):
    return C.narratives(articles(spark, sf), text="headline").select("narrative", "language", "day", "matches", _p("prevalence"), _p("sentiment", 9), _p("matches_mean"), _p("sentiment_mean", 9))


_GRAD = lambda x: f"CASE WHEN lag({x}) OVER w IS NOT NULL AND lead({x}) OVER w IS NOT NULL THEN (lead({x}) OVER w - lag({x}) OVER w) / 2.0 WHEN lead({x}) OVER w IS NOT NULL THEN lead({x}) OVER w - {x} WHEN lag({x}) OVER w IS NOT NULL THEN {x} - lag({x}) OVER w ELSE 0 END"


@query("m6_momentum", sql(f"""
n AS (SELECT topic_id, day, CAST(count(*) AS DOUBLE) AS n FROM articles GROUP BY ALL),
v AS (SELECT *, {_GRAD('n')} AS velocity FROM n WINDOW w AS (PARTITION BY topic_id ORDER BY day)),
a AS (SELECT *, {_GRAD('velocity')} AS acceleration FROM v WINDOW w AS (PARTITION BY topic_id ORDER BY day))
SELECT topic_id, day, velocity, acceleration, velocity > 0 AND acceleration < 0 AS warning FROM a"""))
def momentum(spark, sf):
    n = articles(spark, sf).groupBy("topic_id", "day").agg(F.count("*").cast("double").alias("n"))
    return C.momentum(n, "n", ["topic_id"], "day").drop("n")


@query("m6_hype", sql("""
m AS (SELECT day, sentiment_score, unnest(entities_org) AS entity FROM articles), d AS (SELECT entity, day, count(*) AS n, avg(sentiment_score) AS s, row_number() OVER (PARTITION BY entity ORDER BY day) - 1 AS x FROM m GROUP BY entity, day),
h AS (SELECT entity, CAST(sum(n) AS BIGINT) AS mentions, coalesce(regr_slope(n, x), 0) AS v, avg(s) AS s FROM d GROUP BY entity)
SELECT entity, mentions, round(v, 6) + 0.0 AS volume_slope, round(s, 6) + 0.0 AS sentiment, CASE WHEN v > 0.10 AND s > 0.20 THEN 'peak' WHEN v > 0.10 THEN 'trigger' WHEN v < -0.05 AND s < -0.10 THEN 'trough' WHEN v < -0.05 THEN 'decline'
  WHEN abs(v) < 0.02 AND abs(s) < 0.10 THEN 'plateau' ELSE 'slope' END AS phase FROM h WHERE mentions >= 10"""))
def hype(spark, sf):
    return C.hype(articles(spark, sf)).select("entity", "mentions", _p("volume_slope"), _p("sentiment"), "phase")


_DAILY = f"""
n AS (SELECT CASE WHEN grouping(topic_id) = 1 THEN 'all' ELSE CAST(topic_id AS VARCHAR) END AS series, day, CAST(count(*) AS DOUBLE) AS volume, avg(sentiment_score) AS sentiment, {', '.join(f'avg(emotion_{e}) AS {e}' for e in EMOTIONS)}
  FROM articles GROUP BY GROUPING SETS ((topic_id, day), (day)) HAVING grouping(topic_id) = 1 OR topic_id <> -1),
d AS (SELECT CAST(unnest(generate_series(greatest(min(day), max(day) - 89), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM n),
g AS (SELECT s.series, d.day, coalesce(volume, 0) AS volume, sentiment, {', '.join(EMOTIONS)} FROM (SELECT DISTINCT series FROM n) s CROSS JOIN d LEFT JOIN n ON n.series = s.series AND n.day = d.day),
s AS ({' UNION ALL '.join(f"SELECT series, day, '{m}' AS metric, {m} AS value FROM g" for m in S.METRICS)})"""


@query("s5_daily_series", sql(_DAILY + " SELECT series, day, metric, round(value, 9) + 0.0 AS value FROM s"))
def daily(spark, sf):
    return S.daily(articles(spark, sf)).select("series", "day", "metric", _p("value", 9))


_MA = _DAILY + """,
m AS (SELECT *, CASE WHEN row_number() OVER w >= 3 THEN avg(value) OVER (PARTITION BY series, metric ORDER BY day ROWS 2 PRECEDING) END AS ma_short,
  CASE WHEN row_number() OVER w >= 14 THEN avg(value) OVER (PARTITION BY series, metric ORDER BY day ROWS 13 PRECEDING) END AS ma_long FROM s WINDOW w AS (PARTITION BY series, metric ORDER BY day)),
l AS (SELECT *, ma_short - ma_long AS gap, lag(ma_short - ma_long) OVER (PARTITION BY series, metric ORDER BY day) AS before FROM m),
c AS (SELECT *, CASE WHEN gap IS NULL THEN NULL WHEN before <= 0 AND gap > 0 THEN 'rising' WHEN before >= 0 AND gap < 0 THEN 'declining' ELSE 'neutral' END AS ma_signal FROM l)"""


@query("s5_crossover", sql(_MA + " SELECT series, day, metric, round(ma_short, 8) + 0.0 AS ma_short, round(ma_long, 8) + 0.0 AS ma_long, ma_signal FROM c WHERE metric = 'volume'"))
def crossover(spark, sf):
    return S.crossover(S.daily(articles(spark, sf)).where("metric = 'volume'")).select("series", "day", "metric", _p("ma_short", 8), _p("ma_long", 8), "ma_signal")


@query("s7_last_state", sql(_MA + " SELECT series, metric, arg_max(ma_signal, day) FILTER (ma_signal IS NOT NULL) AS ma_signal, CAST(sum(CAST(coalesce(ma_short > ma_long, false) AS INT)) AS BIGINT) AS days_above FROM c WHERE metric = 'volume' GROUP BY ALL"))
def last_state(spark, sf):
    return S.last_state(S.crossover(S.daily(articles(spark, sf)).where("metric = 'volume'")))


@query("s7_volume_zscore", sql(_DAILY + """
SELECT series, metric, CASE WHEN count(*) >= 3 AND stddev_pop(value) > 0 THEN round((arg_max(value, day) - avg(value)) / stddev_pop(value), 6) + 0.0 ELSE 0 END AS z FROM s WHERE value IS NOT NULL AND metric = 'volume' GROUP BY ALL"""))
def zscore(spark, sf):
    return S.zscore_of_last(S.daily(articles(spark, sf)).where("metric = 'volume'")).select("series", "metric", _p("z"))


@query("s7_entropy_spike", sql("""
n AS (SELECT topic_id, day, source, count(*) AS n, sum(count(*)) OVER (PARTITION BY topic_id, day) AS t FROM articles GROUP BY topic_id, day, source),
e AS (SELECT topic_id, day, -sum(n / t * log2(n / t)) AS e FROM n GROUP BY ALL),
b AS (SELECT *, avg(e) OVER w AS m, stddev_samp(e) OVER w AS s, count(e) OVER w AS c FROM e WINDOW w AS (PARTITION BY topic_id ORDER BY day ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING))
SELECT topic_id, round(arg_max(greatest(0, least(1, CASE WHEN c >= 2 AND s > 0 THEN (e - m) / s ELSE 0 END / 5)), day), 6) + 0.0 AS spike FROM b GROUP BY topic_id"""))
def entropy(spark, sf):
    return S.entropy_spike(articles(spark, sf), "topic_id", "source").select("topic_id", _p("spike"))


@query("s5_peak", sql(_DAILY + " SELECT series, metric, arg_min(day, {'v': -value, 'd': day}) AS day, max(value) AS value FROM s WHERE metric = 'volume' GROUP BY ALL"))
def peak(spark, sf):
    return S.peak(S.daily(articles(spark, sf)).where("metric = 'volume'"))


@query("m4_decay", sql(_DAILY + """,
v AS (SELECT * FROM s WHERE metric = 'volume' AND value > 0), p AS (SELECT series, arg_min(day, {'v': -value, 'd': day}) AS peak FROM v GROUP BY series),
a AS (SELECT v.series, day - peak AS t, ln(day - peak + 1) AS x, ln(value) AS y FROM v JOIN p ON p.series = v.series WHERE day >= peak),
f AS (SELECT series, count(*) AS points, regr_slope(y, x) AS exponent, regr_r2(y, x) AS r2, regr_slope(y, t) AS rate, regr_r2(y, t) AS exp_r2 FROM a GROUP BY series)
SELECT series, points, round(exponent, 6) + 0.0 AS exponent, round(r2, 6) AS r2, round(rate, 6) + 0.0 AS rate, round(exp_r2, 6) AS exp_r2,
  CASE WHEN points < 3 THEN 'irregular' WHEN rate < 0 AND exp_r2 > 0.7 AND round(exp_r2, 9) >= CASE WHEN exponent < 0 THEN round(r2, 9) ELSE 0 END THEN 'flash' WHEN exponent < 0 AND r2 > 0.7 THEN 'sustained' ELSE 'irregular' END AS decay FROM f"""))
def decay(spark, sf):
    return S.decay_fit(S.daily(articles(spark, sf))).select("series", "points", _p("exponent"), F.round("r2", 6).alias("r2"), _p("rate"), F.round("exp_r2", 6).alias("exp_r2"), "decay")


@query("s6_lead_lag", sql(_DAILY + """,
v AS (SELECT series, day, value FROM s WHERE metric = 'volume' AND series <> 'all'),
c AS (SELECT a.series AS a, b.series AS b, CAST(b.day - a.day AS INT) AS lag, corr(a.value, b.value) AS r, count(*) AS n FROM v a JOIN v b ON a.series < b.series AND abs(b.day - a.day) <= 7 GROUP BY ALL),
m AS (SELECT a, b, arg_min({'lag': lag, 'r': r}, {'k': -abs(round(r, 9)), 'd': abs(lag), 'l': lag}) AS m FROM c WHERE n >= 3 AND r IS NOT NULL AND NOT isnan(r) GROUP BY ALL)
SELECT a, b, m.lag AS lag, round(m.r, 6) AS r, CASE WHEN m.lag > 0 THEN a WHEN m.lag < 0 THEN b END AS leader FROM m WHERE abs(m.r) > 0.1"""))
def lead_lag(spark, sf):
    return S.lead_lag(S.daily(articles(spark, sf))).select("a", "b", "lag", F.round("r", 6).alias("r"), "leader")
