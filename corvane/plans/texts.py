"""Queries over text, addresses, search, duplicates and tables of the corpus."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import stats, text, urls
from ..operators import entities, graph, search, titles
from ..sources import tables
from .registry import query
from .standins import articles, sql, table


@query("f29_normal_urls", """
WITH p AS (SELECT page_id, regexp_replace(url, '#.*$', '') AS u FROM pages),
x AS (SELECT page_id, regexp_replace(lower(regexp_extract(u, '^[a-z]+://([^/?]*)', 1)), '^www\\.', '') AS host, rtrim(regexp_extract(u, '^[a-z]+://[^/?]*([^?]*)', 1), '/') AS path,
  list_sort(list_filter(string_split(regexp_extract(u, '\\?(.*)$', 1), '&'), lambda q: q <> '' AND NOT list_contains([""" + ", ".join(f"'{t}'" for t in urls.TRACKING) + """], split_part(q, '=', 1)))) AS q FROM p)
SELECT page_id, 'https://' || host || path || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END AS url FROM x""")
def normal_urls(spark, sf):
    return table(spark, sf, "pages").select("page_id", urls.normalize(F.col("url")).alias("url"))


@query("f30_equivalent_urls", """
WITH n AS (SELECT lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)) AS host, count(*) AS n FROM pages GROUP BY 1) SELECT host, n FROM n""")
def hosts(spark, sf):
    return table(spark, sf, "pages").groupBy(F.lower(F.regexp_extract("url", "^[a-z]+://([^/?#]*)", 1)).alias("host")).agg(F.count("*").alias("n"))


_BARE = "regexp_replace(regexp_replace(url, '#.*$', ''), '^https?://(www[.])?', '')"  # address without a scheme and fragment
_SAME, _OTHER = f"'HTTP://WWW.' || {_BARE} || CASE WHEN contains(url, '?') THEN '&' ELSE '/./?' END || 'utm_source=feed&fbclid=1#top'", f"'https://' || {_BARE} || CASE WHEN contains(url, '?') THEN '&' ELSE '?' END || 'more=1'"


@query("f30_url_keys", """
WITH p AS (SELECT page_id, regexp_replace(url, '#.*$', '') AS u FROM pages),
x AS (SELECT page_id, regexp_replace(lower(regexp_extract(u, '^[a-z]+://([^/?]*)', 1)), '^www\\.', '') AS host, rtrim(regexp_extract(u, '^[a-z]+://[^/?]*([^?]*)', 1), '/') AS path,
  list_sort(list_filter(string_split(regexp_extract(u, '\\?(.*)$', 1), '&'), lambda q: q <> '' AND NOT list_contains([""" + ", ".join(f"'{t}'" for t in urls.TRACKING) + """], split_part(q, '=', 1)))) AS q FROM p)
SELECT page_id, sha256('https://' || host || path || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END) AS url_key, true AS same, false AS other FROM x""")
def url_keys(spark, sf):
    """Keys, and whether another spelling of an address, and another address, is equivalent to it."""
    p = table(spark, sf, "pages")
    return p.select("page_id", urls.key(F.col("url")).alias("url_key"), urls.equivalent(F.col("url"), F.expr(_SAME)).alias("same"), urls.equivalent(F.col("url"), F.expr(_OTHER)).alias("other"))


@query("s19_page_links", """SELECT page_id, CAST(len(regexp_extract_all(html, '(?i)href\\s*=\\s*["'']([^"''#][^"'']*)["'']')) AS INT) AS n FROM pages""")
def page_links(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.size(urls.links(F.col("html"))).alias("n"))


@query("s22_visible_text")
def visible(spark, sf):
    return table(spark, sf, "pages").select("page_id", text.visible(F.col("html")).alias("body")).select("page_id", F.length("body").alias("n"), F.sha2("body", 256).alias("h"))


@query("f32_content_hash", """SELECT doc_id, CASE WHEN trim(regexp_replace(lower(text), '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g')) = '' THEN '' ELSE sha256(trim(regexp_replace(lower(text), '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g'))) END AS content_hash FROM documents""")
def content_hash(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.content_hash(F.col("text")).alias("content_hash"))


@query("f7_word_count", """SELECT doc_id, CAST(len(list_filter(regexp_split_to_array(text, '[ \\t\\n\\x0B\\f\\r]+'), lambda w: w <> '')) AS INT) AS words FROM documents""")
def word_count(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.word_count(F.col("text")).alias("words"))


@query("d165_word_frequencies", """
WITH w AS (SELECT unnest(regexp_extract_all(lower(text), '[a-z]{3,}')) AS word FROM documents WHERE lang = 'en')
SELECT word, count(*) AS n FROM w WHERE word NOT IN ('the', 'and', 'for') GROUP BY word ORDER BY n DESC, word LIMIT 30""")
def word_frequencies(spark, sf):
    w = table(spark, sf, "documents").where("lang = 'en'").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{3,}"), 0)).alias("word"))
    return w.where(~F.col("word").isin("the", "and", "for")).groupBy("word").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "word").limit(30)


@query("f52_body_quality", """SELECT CASE WHEN length(trim(text)) >= 500 THEN 'FULL' WHEN length(trim(text)) >= 100 THEN 'PARTIAL' ELSE 'TITLE_ONLY' END AS quality, count(*) AS n FROM documents GROUP BY 1""")
def body_quality(spark, sf):
    return table(spark, sf, "documents").groupBy(text.body_quality(F.col("text"), F.lit(False)).alias("quality")).agg(F.count("*").alias("n"))


# The same rules for an engine whose word ends know ASCII alone: a word ends before what is no letter, digit or underscore.
_END, _START = r"(?:[^\p{L}\p{N}_]|$)", r"(?:^|[^\p{L}\p{N}_])"
_SCORES = rf"(?i){_START}\d{{1,3}}\s*[-:]\s*\d{{1,3}}{_END}|(?:win|loss|defeat|beat|scored|승리|패배|득점|무승부|승|패|シュート|得点|勝|敗|引き分け|ganó|perdió|empate|gol){_END}"
_CLOSING = r"(?i)마감|종가|종합지수|코스피|코스닥|나스닥|다우|close[sd]|closing|market\s+wrap|[+-]\s*\d+\.?\d*\s*%|(?:포인트|bp|bps)\s+(?:상승|하락|올랐|내렸)"
_WEATHER = r"(?i)날씨|기온|강수|강설|맑음|흐림|weather\s+forecast|temperature|\d{1,2}°[CF]"
_NOTICES = r"(?i)오늘의\s+일정|일정\s+안내|공고|고시|press\s+release|media\s+advisory|embargo|agenda\s+for|schedule\s+for\s+(?:today|tomorrow)"


def _noise_sql(key, source):
    """SQL over a table ``d`` of the key, a title ``t`` and a body ``b``."""
    return f"""{source},
q AS (SELECT *, CASE WHEN length(trim(b)) >= 500 THEN 'FULL' WHEN length(trim(b)) >= 100 THEN 'PARTIAL' ELSE 'TITLE_ONLY' END AS q, t || ' ' || left(b, 500) AS c FROM d)
SELECT {key}, round(least(1, CASE WHEN q = 'TITLE_ONLY' OR length(trim(b)) < 150 THEN 0.45 WHEN length(trim(b)) < 400 THEN 0.20 ELSE 0 END
  + CASE WHEN regexp_matches(c, '{_SCORES}') THEN 0.35 ELSE 0 END + CASE WHEN regexp_matches(c, '{_CLOSING}') THEN 0.30 ELSE 0 END
  + CASE WHEN regexp_matches(t, '{_WEATHER}') THEN 0.40 ELSE 0 END + CASE WHEN regexp_matches(t, '{_NOTICES}') THEN 0.35 ELSE 0 END
  + CASE WHEN length(trim(t)) < 15 AND length(regexp_replace(trim(t), '[^0-9]', '', 'g')) > 0.4 * length(trim(t)) THEN 0.25 ELSE 0 END), 6) + 0.0::DOUBLE AS noise FROM q"""


def _noise(d, key):
    return d.select(key, F.round(text.noise(F.col("t"), F.col("b"), text.body_quality(F.col("b"), F.lit(False))), 6).alias("noise"))


@query("f17_noise_score", _noise_sql("doc_id", "WITH d AS (SELECT doc_id, left(text, 12) AS t, text AS b FROM documents)"))
def noise_score(spark, sf):
    return _noise(table(spark, sf, "documents").select("doc_id", F.substring("text", 1, 12).alias("t"), F.col("text").alias("b")), "doc_id")


#: What articles in several languages add to their headline, by id.
_ADDED = ["", "팀이 3:1 승리", "승리했다", "코스피 마감", "10 bps 상승", "FCが得点", "El equipo ganó", "오늘의  일정", "25°C 맑음", "the team scored.", "GANÓ", "공고 12", "Press  Release", "7-0x"]
_ADDING = "CASE article_id % 14 " + " ".join(f"WHEN {i} THEN '{x}'" for i, x in enumerate(_ADDED)) + " END"


@query("f17_noise_headlines", sql(_noise_sql("article_id", f"d AS (SELECT article_id, headline || ' ' || {_ADDING} AS t, repeat(headline || ' ', CAST(article_id % 40 AS INT)) AS b FROM articles)")))
def noise_headlines(spark, sf):
    """Korean, Japanese, Spanish and English headlines."""
    a = articles(spark, sf)
    return _noise(a.select("article_id", F.concat_ws(" ", "headline", F.expr(_ADDING)).alias("t"), F.expr("repeat(headline || ' ', CAST(article_id % 40 AS INT))").alias("b")), "article_id")


_NOV = """round(least(1, CASE WHEN word_count >= 800 THEN 0.10 ELSE 0 END + CASE WHEN list_contains(steeps_all, 'CRS') OR len(steeps_all) >= 3 THEN 0.25 WHEN len(steeps_all) = 2 THEN 0.10 ELSE 0 END
  + CASE WHEN len(list_distinct(geo_focus_all)) >= 3 THEN 0.20 WHEN len(list_distinct(geo_focus_all)) = 2 THEN 0.10 ELSE 0 END + 0.20 + CASE WHEN regexp_matches(title, '(?i)surprise') THEN 0.15 ELSE 0 END), 6)"""


@query("f18_novelty_score", sql(f"SELECT article_id, {_NOV} + 0.0::DOUBLE AS novelty FROM articles"))
def novelty_score(spark, sf):
    a = articles(spark, sf)
    named = F.size("entities_person") + F.size("entities_org") + F.size("entities_location")
    return a.select("article_id", F.round(text.novelty(F.col("title"), F.lit(""), F.when(F.col("word_count") >= 800, "FULL").otherwise("PARTIAL"), F.col("steeps_all"), F.col("geo_focus_all"), named), 6).alias("novelty"))


_TITLED = "headline || CASE article_id % 6 WHEN 0 THEN ' 사상 최초' WHEN 1 THEN ' FIRST TIME' WHEN 2 THEN ' 반전' ELSE '' END"


@query("f18_novelty_headlines", sql(f"""n AS (SELECT *, {_TITLED} AS t FROM articles)
SELECT article_id, {_NOV.replace("regexp_matches(title, '(?i)surprise')", "regexp_matches(t, '(?i)처음|최초|역대|사상|unprecedented|first time|new high|new low|reversal|surprise|unexpected|반전|충격|돌파|전례없는')")} + 0.0::DOUBLE AS novelty FROM n"""))
def novelty_headlines(spark, sf):
    a = articles(spark, sf)
    named = F.size("entities_person") + F.size("entities_org") + F.size("entities_location")
    return a.select("article_id", F.round(text.novelty(F.expr(_TITLED), F.lit(""), F.when(F.col("word_count") >= 800, "FULL").otherwise("PARTIAL"), F.col("steeps_all"), F.col("geo_focus_all"), named), 6).alias("novelty"))


@query("f14_steeps_scores", sql("""
h AS (SELECT article_id, 3 * len(regexp_extract_all(title, '(?i)\\b(bank|market|budget)\\b')) AS e, 3 * len(regexp_extract_all(title, '(?i)\\b(chip)\\b')) AS t, 3 * len(regexp_extract_all(title, '(?i)\\b(election|policy|war)\\b')) AS p FROM articles)
SELECT article_id, CASE WHEN e + t + p = 0 THEN 'ECO' WHEN e >= p AND e >= t THEN 'ECO' WHEN p >= t THEN 'POL' ELSE 'TEC' END AS code, CASE WHEN e + t + p = 0 THEN 0 ELSE round(greatest(e, t, p) / (e + t + p), 6) END + 0.0::DOUBLE AS score FROM h"""))
def steeps_scores(spark, sf):
    s = text.keyword_scores(F.col("title"), F.lit(""), {"ECO": ["bank", "market", "budget"], "TEC": ["chip"], "POL": ["election", "policy", "war"]})
    return articles(spark, sf).select("article_id", s[0]["code"].alias("code"), F.round(s[0]["score"], 6).alias("score"))


def _simhash_sql(key, source):
    """SQL over a table ``d`` of the key and a ``text``."""
    return source + rf""",
t AS (SELECT {key}, text, regexp_replace(lower(text), '[^\p{{L}}\p{{N}}_\s\x{{3001}}-\x{{9FFF}}\x{{AC00}}-\x{{D7AF}}]', ' ', 'g') AS t FROM d WHERE length(text) >= 50),
w AS (SELECT *, list_filter(regexp_split_to_array(t, '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w, regexp_replace(t, '[ \t\n\x0B\f\r]', '', 'g') AS c,
  length(regexp_replace(t, '[^{text.CJK}]', '', 'g')) > {text.CJK_SHARE} * length(regexp_replace(t, '[^\p{{L}}]', '', 'g')) AS cjk FROM t),
g AS (SELECT {key}, unnest(CASE WHEN cjk THEN CASE WHEN length(c) > 1 THEN list_transform(range(1, length(c)), lambda i: substr(c, i, 2)) ELSE [c] END
  WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) ELSE w END) AS g FROM w),
h AS (SELECT {key}, ('0x' || substr(sha256(g), 1, 16))::UBIGINT AS h FROM g), b AS (SELECT {key}, i, sum(CASE WHEN (h >> i) & 1 = 1 THEN 1 ELSE -1 END) AS v FROM h, range(64) r(i) GROUP BY ALL),
s AS (SELECT {key}, sum(CASE WHEN v > 0 THEN CASE WHEN i = 63 THEN -9223372036854775808::HUGEINT ELSE (1::HUGEINT << i) END ELSE 0 END) AS s FROM b GROUP BY {key})
SELECT d.{key}, CAST(coalesce(s, CASE WHEN text IS NOT NULL THEN 0 END) AS BIGINT) AS simhash FROM d LEFT JOIN s ON s.{key} = d.{key}"""


@query("f22_simhash", _simhash_sql("doc_id", "WITH d AS (SELECT doc_id, text FROM documents)"))
def simhash(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.simhash64(F.col("text")).alias("simhash"))


_REPEATED = "repeat(headline || ' ' || title || '!' || headline || '、' || headline, CAST(1 + article_id % 3 AS INT))"


@query("f22_simhash_headlines", sql(_simhash_sql("article_id", f"d AS (SELECT article_id, {_REPEATED} AS text FROM articles)")))
def simhash_headlines(spark, sf):
    """Korean, Japanese, Spanish and English, with English and punctuation between."""
    return articles(spark, sf).select("article_id", F.expr(_REPEATED).alias("text")).select("article_id", text.simhash64(F.col("text")).alias("simhash"))


@query("f21_titles_alike")
def titles_alike(spark, sf):
    """All titles of all documents; f21_similar_titles has the names of all parts, which SQL can follow."""
    return titles.alike(table(spark, sf, "documents").select(text.title_form(F.regexp_extract("text", "^[^\n]*", 0)).alias("form")))


_BM = """WITH w AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) AS term FROM documents), l AS (SELECT doc_id, count(*) AS n FROM w GROUP BY 1),
s AS (SELECT (SELECT count(*) FROM documents) AS n, (SELECT sum(n) FROM l) / (SELECT count(*) FROM documents) AS mean), tf AS (SELECT doc_id, term, count(*) AS tf FROM w WHERE term IN ('ernt', 'hand') GROUP BY 1, 2),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1)"""


@query("f28_search_bm25", _BM + """, r AS (SELECT tf.doc_id, sum(ln(1 + (s.n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * l.n / mean))) AS score, count(*) AS c FROM tf JOIN df ON df.term = tf.term JOIN l ON l.doc_id = tf.doc_id, s GROUP BY 1)
SELECT doc_id, round(score, 6) AS score FROM r WHERE c = 2 ORDER BY r.score DESC, doc_id LIMIT 20""")
def bm25(spark, sf):
    return search.search(table(spark, sf, "documents"), ["ernt", "hand"]).withColumn("score", F.round("score", 6))


@query("f28_inverted_index", """WITH w AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) AS term FROM documents) SELECT term, count(DISTINCT doc_id) AS documents, count(*) AS occurrences FROM w GROUP BY term""")
def inverted(spark, sf):
    return search.index(table(spark, sf, "documents").select("doc_id", "text")).groupBy("term").agg(F.count("*").alias("documents"), F.sum("tf").alias("occurrences"))


@query("v_nearest_vectors", """
WITH p AS (SELECT a.vec_id AS query_id, b.vec_id, list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS c FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY c DESC, vec_id) AS INT) AS rank FROM p) SELECT query_id, vec_id, round(c, 6) AS cosine, rank FROM r WHERE rank <= 10""")
def nearest(spark, sf):
    v = table(spark, sf, "embeddings")
    return search.nearest(v, v.where("vec_id % 100 = 0")).withColumn("cosine", F.round("cosine", 6))


@query("f40_centroid_similarity", """
WITH e AS (SELECT label, unnest(CAST(embedding AS DOUBLE[])) AS x, unnest(range(64)) AS i FROM embeddings), c AS (SELECT label, i, avg(x) AS x FROM e GROUP BY 1, 2),
d AS (SELECT a.label AS a, b.label AS b, sum(a.x * b.x) AS ab FROM c a JOIN c b ON a.i = b.i GROUP BY 1, 2)
SELECT p.a, p.b, round(p.ab / (sqrt(x.ab) * sqrt(y.ab)), 5) AS cosine FROM d p JOIN d x ON x.a = p.a AND x.b = p.a JOIN d y ON y.a = p.b AND y.b = p.b WHERE p.a < p.b""")
def centroids(spark, sf):
    e = table(spark, sf, "embeddings").select("label", F.posexplode("embedding").alias("i", "x")).groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    c = e.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("c"))
    return c.toDF("a", "u").join(c.toDF("b", "v"), F.col("a") < F.col("b")).select("a", "b", F.round(stats.cosine(F.col("u"), F.col("v")), 5).alias("cosine"))


@query("j64_left_join_first", """
WITH l AS (SELECT o_custkey, o_orderkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS k FROM orders)
SELECT c_custkey, o_orderkey, o_totalprice FROM customer LEFT JOIN l ON c_custkey = o_custkey AND k = 1""")
def left_first(spark, sf):
    c, o = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey")), table(spark, sf, "orders")
    return tables.left_join_first(c, o, "o_custkey", ["o_orderkey", "o_totalprice"], [F.asc("o_orderdate"), F.asc("o_orderkey")]).withColumnRenamed("o_custkey", "c_custkey")


@query("s10_keep_last", "SELECT user_id, arg_max(event_id, {'t': ts, 'e': event_id}) AS event_id FROM events GROUP BY user_id")
def keep_last(spark, sf):
    return tables.keep_one(table(spark, sf, "events"), ["user_id"], [F.desc("ts"), F.desc("event_id")]).select("user_id", "event_id")


@query("j71_densify", """
WITH d AS (SELECT CAST(unnest(generate_series((SELECT min(CAST(ts AS DATE)) FROM events), (SELECT max(CAST(ts AS DATE)) FROM events), INTERVAL 1 DAY)) AS DATE) AS day), u AS (SELECT DISTINCT user_id FROM events),
n AS (SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1, 2) SELECT u.user_id, d.day, coalesce(n, 0) AS n FROM u CROSS JOIN d LEFT JOIN n ON n.user_id = u.user_id AND n.day = d.day""")
def densify(spark, sf):
    e = table(spark, sf, "events").select("user_id", F.col("ts").cast("date").alias("day"), F.lit(1).alias("n"))
    return tables.densify(e, "user_id", "day", "n")


@query("j75_semi", "SELECT lang, count(*) AS n FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 0) GROUP BY lang")
def semi(spark, sf):
    return table(spark, sf, "documents").join(table(spark, sf, "labels").where("quality = 0"), "doc_id", "left_semi").groupBy("lang").agg(F.count("*").alias("n"))


@query("j76_anti", "SELECT source, count(*) AS n FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY source")
def anti(spark, sf):
    return table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left_anti").groupBy("source").agg(F.count("*").alias("n"))


@query("q56_quality_report", """SELECT count(*) AS n, CAST(sum(CAST(doc_id IS NULL AS INT)) AS BIGINT) AS null_keys, count(doc_id) - count(DISTINCT doc_id) AS repeated_keys,
  avg(CAST(quality IS NULL AS INT)) + 0.0 AS null_quality, avg(CAST(toxic IS NULL AS INT)) + 0.0 AS null_toxic, (SELECT count(*) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)) AS orphans FROM labels""")
def quality_report(spark, sf):
    labels = table(spark, sf, "labels").select("doc_id", "quality", "toxic")
    n = tables.quality(labels, "doc_id")
    return n.crossJoin(labels.join(table(spark, sf, "documents"), "doc_id", "left_anti").agg(F.count("*").alias("orphans")))  # one row each


@query("a89_histogram", sql("SELECT CAST(least(floor((sentiment_score + 1) / 0.04) + 1, 51) AS BIGINT) AS bin, count(*) AS n FROM articles GROUP BY 1"))
def histogram(spark, sf):
    return articles(spark, sf).groupBy(F.least(F.floor((F.col("sentiment_score") + 1) / F.lit(0.04)) + 1, F.lit(51)).cast("bigint").alias("bin")).agg(F.count("*").alias("n"))


@query("a97_distribution", sql("SELECT steeps_category, avg(importance_score) AS mean, round(stddev_samp(importance_score), 6) AS std, min(importance_score) AS lo, max(importance_score) AS hi, round(quantile_cont(importance_score, 0.5), 6) AS median FROM articles GROUP BY 1").replace("avg(importance_score) AS mean", "round(avg(importance_score), 6) AS mean"))
def distribution(spark, sf):
    x = "importance_score"
    return articles(spark, sf).groupBy("steeps_category").agg(F.round(F.avg(x), 6).alias("mean"), F.round(F.stddev_samp(x), 6).alias("std"), F.min(x).alias("lo"), F.max(x).alias("hi"), F.round(F.percentile(x, 0.5), 6).alias("median"))


@query("a90_topic_index", sql("""c AS (SELECT topic_id, steeps_category, count(*) AS n FROM articles GROUP BY ALL)
SELECT topic_id, CAST(sum(n) AS BIGINT) AS n, arg_min(steeps_category, {'n': -n, 'l': steeps_category}) AS label FROM c GROUP BY topic_id"""))
def topic_index(spark, sf):
    return articles(spark, sf).groupBy("topic_id").agg(F.count("*").alias("n"), F.mode("steeps_category", True).alias("label"))


@query("a94_mood", sql("""e AS (SELECT source, day, count(*) AS n, avg(sentiment_score) AS s, """ + ", ".join(f"avg(emotion_{e}) AS e_{i}" for i, e in enumerate(["joy", "trust", "fear", "surprise", "sadness", "disgust", "anger", "anticipation"])) + """ FROM articles GROUP BY 1, 2),
t AS (SELECT *, """ + " + ".join(f"e_{i}" for i in range(8)) + """ AS t FROM e) SELECT source, day, n, round(s * (1 + (""" + " + ".join(f"CASE WHEN e_{i} > 0 THEN e_{i} / t * log2(e_{i} / t) ELSE 0 END" for i in range(8)) + """) / 3), 8) + 0.0 AS mood FROM t"""))
def mood(spark, sf):
    names = [f"emotion_{e}" for e in ("joy", "trust", "fear", "surprise", "sadness", "disgust", "anger", "anticipation")]
    a = articles(spark, sf).groupBy("source", "day").agg(F.count("*").alias("n"), F.avg("sentiment_score").alias("s"), *(F.avg(c).alias(c) for c in names))
    total = sum((F.col(c) for c in names), F.lit(0.0))
    entropy = -sum((F.when(F.col(c) > 0, F.col(c) / total * F.log2(F.col(c) / total)).otherwise(0.0) for c in names), F.lit(0.0))
    return a.select("source", "day", "n", (F.round(F.col("s") * (1 - entropy / 3), 8) + F.lit(0.0)).alias("mood"))


@query("w155_capped_ranks", sql("""r AS (SELECT steeps_category, article_id, importance_score, row_number() OVER (PARTITION BY steeps_category ORDER BY importance_score DESC, article_id) AS k FROM articles)
SELECT steeps_category, article_id, importance_score FROM r WHERE k <= 3 ORDER BY importance_score DESC, article_id LIMIT 10"""))
def capped(spark, sf):
    w = Window.partitionBy("steeps_category").orderBy(F.desc("importance_score"), "article_id")
    return articles(spark, sf).select("steeps_category", "article_id", "importance_score", F.row_number().over(w).alias("k")).where("k <= 3").orderBy(F.desc("importance_score"), "article_id").limit(10).drop("k")


@query("m7_evidence", sql("""e AS (SELECT topic_id, article_id, 0.4 * importance_score + 0.3 * abs(sentiment_score) + 0.1 * least(word_count / 1000, 1) + 0.2 * least(1.5 * importance_score, 1) AS s FROM articles WHERE topic_id >= 0),
r AS (SELECT *, row_number() OVER (PARTITION BY topic_id ORDER BY s DESC, article_id) AS k FROM e) SELECT topic_id, article_id, round(s, 6) AS score FROM r WHERE k <= 5"""))
def evidence(spark, sf):
    s = articles(spark, sf).where("topic_id >= 0").select("topic_id", "article_id", stats.evidence(F.col("importance_score"), F.col("sentiment_score"), F.col("word_count")).alias("s"))
    return s.withColumn("k", F.row_number().over(Window.partitionBy("topic_id").orderBy(F.desc("s"), "article_id"))).where("k <= 5").select("topic_id", "article_id", F.round("s", 6).alias("score"))


@query("f42_importance", sql("""SELECT article_id, round(greatest(0, least(100, 0.25 * 50 + 0.20 * least(6 * 1000.0 / word_count, 100) + 0.25 * least((article_id % 20) * 500.0 / 100, 100)
  + 15 * exp(-0.0289 * (article_id % 48)) + 15 * abs(sentiment_score) - CASE WHEN article_id % 9 = 0 THEN 20 ELSE 0 END)), 2) + 0.0::DOUBLE AS importance FROM articles"""))
def importance(spark, sf):
    i = F.col("article_id")
    return articles(spark, sf).select("article_id", stats.importance(F.lit(50.0), F.lit(6), F.col("word_count"), i % 20, F.lit(100), i % 48, F.col("sentiment_score"), i % 9 == 0).alias("importance"))


_EDGES = """e AS (SELECT article_id, list_sort(list_distinct(list_concat(entities_person, entities_org))) AS l FROM articles), x AS (SELECT article_id, unnest(l) AS a, l FROM e), p AS (SELECT a, unnest(l) AS b FROM x),
g AS (SELECT a, b, count(*) AS n FROM p WHERE a < b GROUP BY 1, 2 HAVING count(*) >= 3)"""


def _edges(spark, sf):
    return entities.cooccurrence(articles(spark, sf), ["entities_person", "entities_org"])


@query("g16_degree", sql(_EDGES + ", o AS (SELECT a AS node FROM g UNION ALL SELECT b FROM g) SELECT node, count(*) AS degree FROM o GROUP BY node"))
def degree(spark, sf):
    return graph.degree(_edges(spark, sf))


@query("g17_density", sql("""e AS (SELECT isoyear(day) * 100 + weekofyear(day) AS w, list_sort(list_distinct(list_concat(entities_person, entities_org))) AS l FROM articles), x AS (SELECT w, unnest(l) AS a, l FROM e), p AS (SELECT w, a, unnest(l) AS b FROM x),
g AS (SELECT DISTINCT w, a, b FROM p WHERE a < b), v AS (SELECT w, count(DISTINCT n) AS nodes FROM (SELECT w, a AS n FROM g UNION ALL SELECT w, b FROM g) GROUP BY w), c AS (SELECT w, count(*) AS edges FROM g GROUP BY w)
SELECT CAST(c.w AS BIGINT) AS week, edges, nodes, round(2 * edges / (nodes * (nodes - 1)), 6) AS density, round(2 * edges / nodes, 6) AS mean_degree, edges - lag(edges) OVER (ORDER BY c.w) AS edges_change FROM c JOIN v ON v.w = c.w"""))
def density(spark, sf):
    a = articles(spark, sf).withColumn("week", (F.extract(F.lit("YEAROFWEEK"), F.col("day")) * 100 + F.extract(F.lit("WEEK"), F.col("day"))).cast("bigint"))
    return graph.density(entities.pairs(a, ["entities_person", "entities_org"], ["week"]), "week").select("week", "edges", "nodes", F.round("density", 6).alias("density"), F.round("mean_degree", 6).alias("mean_degree"), "edges_change")


@query("g16_components", """
WITH RECURSIVE e AS (SELECT DISTINCT c_custkey AS a, -1 - c_nationkey AS b FROM customer), o AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r(node, c) AS (SELECT a, a FROM o UNION SELECT o.b, r.c FROM r JOIN o ON o.a = r.node)
SELECT node, min(c) AS component FROM r GROUP BY node""")
def components(spark, sf):
    """All customers and their nations: a component for each nation that has customers."""
    return graph.components(table(spark, sf, "customer").select(F.col("c_custkey").alias("a"), (-1 - F.col("c_nationkey")).alias("b")))


@query("g16_components_whole", """
WITH RECURSIVE e AS (SELECT DISTINCT l_suppkey AS a, -1 - l_partkey AS b FROM lineitem), o AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r(node, c) AS (SELECT a, a FROM o UNION SELECT o.b, r.c FROM r JOIN o ON o.a = r.node)
SELECT node, min(c) AS component FROM r GROUP BY node""")
def components_whole(spark, sf):
    """All edges of lineitem; parts are negative, so that no number of suppliers meets them."""
    return graph.components(table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("a"), (-1 - F.col("l_partkey")).alias("b")))


@query("g22_depth", """
WITH RECURSIVE e AS (SELECT DISTINCT user_id AS s, user_id // 3 + 1 AS d FROM events), w(root, node, k) AS (SELECT DISTINCT s, s, 0 FROM e WHERE s NOT IN (SELECT d FROM e) UNION ALL SELECT root, e.d, k + 1 FROM w JOIN e ON e.s = w.node WHERE k < 20),
n AS (SELECT root, node, min(k) AS k FROM w GROUP BY 1, 2) SELECT root, CAST(max(k) AS BIGINT) AS depth FROM n GROUP BY root""")
def depth(spark, sf):
    e = table(spark, sf, "events").select(F.col("user_id").alias("src"), (F.floor(F.col("user_id") / 3) + 1).alias("dst")).distinct()
    return graph.depth(spark, e)


@query("g19_pagerank")
def pagerank(spark, sf):
    e = _edges(spark, sf)
    both = e.select(F.col("a").alias("src"), F.col("b").alias("dst"), F.col("n").alias("weight")).unionByName(e.select(F.col("b").alias("src"), F.col("a").alias("dst"), F.col("n").alias("weight")))
    return graph.pagerank(both).withColumn("rank", F.round("rank", 6))


@query("g21_communities")
def communities(spark, sf):
    return graph.communities(_edges(spark, sf))


@query("g16_modularity", sql(_EDGES + """, m AS (SELECT sum(n) AS m FROM g), i AS (SELECT left(a, 1) AS c, sum(n) AS inside FROM g WHERE left(a, 1) = left(b, 1) GROUP BY 1),
d AS (SELECT c, sum(n) AS ends FROM (SELECT left(a, 1) AS c, n FROM g UNION ALL SELECT left(b, 1), n FROM g) GROUP BY 1)
SELECT round(sum(coalesce(inside, 0) / m - (ends / (2 * m)) * (ends / (2 * m))), 6) AS modularity FROM d LEFT JOIN i ON i.c = d.c, m"""))
def modularity(spark, sf):
    e = _edges(spark, sf)
    nodes = e.select("a").unionByName(e.select(F.col("b").alias("a"))).distinct().withColumn("c", F.substring("a", 1, 1))
    return graph.modularity(e, nodes).withColumn("modularity", F.round("modularity", 6))
