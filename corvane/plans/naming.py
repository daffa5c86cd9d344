"""Queries over names, places and raw text, and the sources that articles come from."""

from pyspark.sql import functions as F

from ..functions import text, urls
from ..operators import names as N
from ..operators import pipeline, titles
from .registry import query
from .standins import HEADLINES, articles, sql, table

_VALID = f"""length(name) BETWEEN 2 AND 50 AND length(regexp_replace(name, '[^0-9]', '', 'g')) <= 0.8 * length(name)
  AND NOT (language = 'ko' AND (regexp_matches(name, '{N.KO_ENDINGS}') OR regexp_matches(name, '{N.KO_PARTICLES}') OR (contains(name, ' ') AND length(name) > 20)))"""


@query("s50_valid_names", sql(f"n AS (SELECT language, unnest(names) AS name FROM articles) SELECT language, name, {_VALID} AS valid, count(*) AS n FROM n GROUP BY ALL"))
def valid_names(spark, sf):
    n = articles(spark, sf).select("language", F.explode("names").alias("name"))
    return n.withColumn("valid", N.valid(F.col("name"), F.col("language"))).groupBy("language", "name", "valid").agg(F.count("*").alias("n"))


_NORMAL = r"trim(regexp_replace(regexp_replace(trim(name), '^(?i:Mr\.?|Ms\.?|Mrs\.?|Dr\.?|Prof\.?|Sr\.?|Jr\.?)\s+', ''), '\s+', ' ', 'g'))"


@query("f9_normal_names", sql(f"n AS (SELECT unnest(names) AS name FROM articles) SELECT {_NORMAL} AS name, count(*) AS n FROM n GROUP BY 1"))
def normal_names(spark, sf):
    return articles(spark, sf).select(F.explode("names").alias("name")).groupBy(N.normal(F.col("name")).alias("name")).agg(F.count("*").alias("n"))


@query("f9_distinct_names")
def distinct_names(spark, sf):
    return articles(spark, sf).select("article_id", N.distinct(F.col("names")).alias("names"))


_NODE = "CASE WHEN length({0}) <= 1 OR lower({0}) IN (" + ", ".join(f"'{x}'" for x in N.NOISE) + ") THEN '' ELSE {0} END"


@query("f10_relations", sql(f"""
p AS (SELECT trim(regexp_replace(names[1], '\\s+', ' ', 'g')) AS a, trim(regexp_replace(names[2], '\\s+', ' ', 'g')) AS b FROM articles), q AS (SELECT {_NODE.format('a')} AS a, {_NODE.format('b')} AS b FROM p)
SELECT a, b, CASE WHEN regexp_matches(lower(a), '{'|'.join(N.PLACE_WORDS)}') OR regexp_matches(lower(b), '{'|'.join(N.PLACE_WORDS)}') THEN 'located_in' WHEN regexp_matches(lower(a), '{'|'.join(N.ORG_WORDS)}') OR regexp_matches(lower(b), '{'|'.join(N.ORG_WORDS)}') THEN 'works_at' ELSE 'mentioned_with' END AS relation,
  count(*) AS n FROM q WHERE a <> '' AND b <> '' GROUP BY ALL"""))
def relations(spark, sf):
    p = articles(spark, sf).select(N.node(F.get("names", F.lit(0))).alias("a"), N.node(F.get("names", F.lit(1))).alias("b")).where("a <> '' and b <> ''")
    return p.groupBy("a", "b").agg(F.count("*").alias("n")).withColumn("relation", N.relation(F.col("a"), F.col("b")))


_COUNTRY_NAMES = [("US", "USA"), ("KR", "KOR"), ("JP", "JPN"), ("DE", "DEU")]


@query("f16_countries", sql(f"d(name, code) AS (VALUES {', '.join(map(str, _COUNTRY_NAMES))}) SELECT article_id, list_sort(list_filter(list_distinct([(SELECT code FROM d WHERE name = trim(entities_location[1])), (SELECT code FROM d WHERE name = trim(entities_location[2]))]), lambda x: x IS NOT NULL)) AS countries FROM articles"))
def countries(spark, sf):
    dimension = spark.createDataFrame(_COUNTRY_NAMES, "name string, code string")
    return N.countries(articles(spark, sf), dimension)


ALIASES = {"seoul": "KR", "samsung": "KR", "한국은행": "KR", "정부": "KR", "world": "UN", "bank": "UN", "world bank": "UN", "chip": "TW", "war": "UA", "europea": "EU"}


@query("f15_place_focus")
def place_focus(spark, sf):
    a = articles(spark, sf).withColumn("body", F.array_join("names", ", "))
    return N.place_focus(a, ALIASES, title="headline", named="names").withColumn("share", F.round("share", 6))


@query("s96_named", sql("SELECT article_id, CAST(len(entities_person) + len(entities_org) + len(entities_location) AS BIGINT) AS n FROM articles"))
def named(spark, sf):
    return articles(spark, sf).select("article_id", N.named_count("entities_person", "entities_org", "entities_location").alias("n"))


@query("r9_source_tiers", sql("""s AS (SELECT source, lower(max(source_country)) AS region, substr('ABCDEFGHIJ', CAST(substr(source, 4) AS INT) % 10 + 1, 1) AS "group", count(*) / count(DISTINCT day) AS daily FROM articles GROUP BY source)
SELECT source, CASE WHEN region = '' THEN 'UNKNOWN' WHEN upper(region) = 'ME' THEN 'ME_REGION' ELSE upper(region) END AS country,
  CASE WHEN source = 'src1' THEN 'GLOBAL' WHEN source = 'src2' OR "group" = 'D' THEN 'NICHE' WHEN "group" = 'E' AND daily >= 40 THEN 'GLOBAL' WHEN "group" IN ('F', 'G', 'H', 'I', 'J') AND daily <= 10 THEN 'REGIONAL' ELSE 'NATIONAL' END AS tier FROM s"""))
def source_tiers(spark, sf):
    s = articles(spark, sf).groupBy("source").agg(F.lower(F.max("source_country")).alias("region"), (F.count("*") / F.countDistinct("day")).alias("daily"))
    group = F.substring(F.lit("ABCDEFGHIJ"), F.substring("source", 4, 9).cast("int") % 10 + 1, F.lit(1))
    return s.select("source", N.country_of_region(F.col("region")).alias("country"), N.tier(F.col("source"), group, F.col("daily"), ["src1"], ["src2"]).alias("tier"))


# Raw text.


@query("f1_normal_forms")
def normal_forms(spark, sf):
    """The cleaned text of every page in the Unicode form of its language."""
    p = table(spark, sf, "pages")
    return p.select("page_id", F.sha2(text.unicode_form(text.clean(F.col("html")), F.regexp_extract("html", 'lang="([a-z]+)"', 1)), 256).alias("sha256"))


@query("f2_decoded", "SELECT doc_id, sha256(coalesce(text, '')) AS sha256 FROM documents")
def decoded(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.sha2(text.decoded(F.coalesce("text", F.lit("")).cast("binary")), 256).alias("sha256"))


_KOREAN = "CASE headline " + " ".join(f"WHEN '{h}' THEN unhex('{h.encode('euc-kr').hex()}')" for h in HEADLINES["ko"]) + " END"


@query("f2_decoded_headlines", sql("SELECT article_id, headline AS body FROM articles"))
def decoded_headlines(spark, sf):
    """Korean in EUC-KR, Spanish in Latin-1, others in UTF-8."""
    raw = F.expr(f"CASE language WHEN 'ko' THEN {_KOREAN} WHEN 'es' THEN encode(headline, 'ISO-8859-1') ELSE encode(headline, 'UTF-8') END")
    return articles(spark, sf).select("article_id", text.decoded(raw).alias("body"))


@query("f3_language")
def language(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", text.language(F.regexp_extract("text", "^[^\n]*", 0), F.col("text"), F.lit("en")).alias("language"))


@query("f4_hangul", sql("SELECT article_id, CASE WHEN length(regexp_replace(headline, '[^가-힣]', '', 'g')) >= 0.1 * length(headline) THEN 'ko' ELSE 'en' END AS language FROM articles"))
def hangul(spark, sf):
    return articles(spark, sf).select("article_id", text.hangul_language(F.col("headline")).alias("language"))


_STOP = "CASE lang " + " ".join(f"WHEN '{k}' THEN {list(ws)!r}" for k, ws in text.STOP_WORDS.items()) + " ELSE [] END"


@query("f5_content_words", f"SELECT doc_id, CAST(len(list_filter(regexp_extract_all(lower(coalesce(text, '')), '\\p{{L}}{{3,}}'), lambda w: NOT list_contains({_STOP}, w))) AS BIGINT) AS n FROM documents")
def content_words(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.size(text.content_words(F.col("text"), F.col("lang"))).cast("bigint").alias("n"))


@query("f6_sentences")
def sentences(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.size(text.sentences(F.col("text"))).alias("n"))


@query("f31_discovered_urls", """
WITH u AS (SELECT page_id, regexp_replace(trim(url), '#.*$', '') AS u FROM pages), p AS (SELECT page_id, regexp_extract(u, '^(https?)://([^/?]*)([^?]*)(?:\\?(.*))?$', ['s', 'h', 'p', 'q']) AS r FROM u),
q AS (SELECT page_id, r.s AS s, regexp_replace(lower(regexp_replace(r.h, '^.*@', '')), ':(80|443)?$', '') AS h, CASE WHEN r.p IN ('', '/') THEN '/' ELSE regexp_replace(r.p, '/+$', '') END AS p,
  list_sort(list_filter(string_split(r.q, '&'), lambda x: regexp_matches(x, '^[^=]+=.') AND lower(split_part(x, '=', 1)) NOT IN (TRACKING))) AS q FROM p)
SELECT page_id, CASE WHEN s <> '' AND h <> '' THEN s || '://' || h || p || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END ELSE '' END AS url FROM q""".replace("TRACKING", ", ".join(f"'{t.lower()}'" for t in urls.TRACKING)))
def discovered(spark, sf):
    return table(spark, sf, "pages").select("page_id", urls.discovered(F.col("url")).alias("url"))


@query("s45_article_urls", r"""
WITH p AS (SELECT page_id, url, regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1) AS p FROM pages), s AS (SELECT *, list_filter(string_split(p, '/'), lambda x: x <> '') AS s FROM p)
SELECT page_id, len(s) > 0 AND NOT (regexp_matches(p, '(?i)\.(jpg|jpeg|png|gif|svg|webp|css|js|pdf|zip|mp3|mp4|xml|json|ico)$') OR regexp_matches(p, '(?i)/(tag|tags|category|categories|author|search|login|signup|about|contact|page/\d+)(/|$)')
  OR regexp_matches(url, '(?i)://([^/]*\.)?(facebook|twitter|x|instagram|youtube|linkedin|pinterest|tiktok)\.com')) AND (len(s) > 1 OR length(s[1]) >= 20) AS is_article FROM s""")
def article_urls(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.coalesce(urls.is_article(F.col("url")), F.lit(False)).alias("is_article"))


_PHRASES = ["subscribe", "log in to", "the", "und"]


@query("s46_paywalls", f"""WITH h AS (SELECT doc_id, coalesce(text, '') AS t, {' + '.join(f"CAST(contains(lower(coalesce(text, '')), '{p}') AS INT)" for p in _PHRASES)} AS hits FROM documents)
SELECT doc_id, length(t) < 50 OR hits >= 2 OR (hits = 1 AND length(t) < 2000) AS paywall FROM h""")
def paywalls(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.is_paywall(F.coalesce("text", F.lit("")), _PHRASES).alias("paywall"))


@query("f24_slugs", sql(r"""SELECT DISTINCT headline, substr(regexp_replace(regexp_replace(lower(headline), '[^A-Za-z0-9_\s]', '', 'g'), '\s+', '_', 'g'), 1, 60) AS slug FROM articles"""))
def slugs(spark, sf):
    from ..operators.questions import slug

    return articles(spark, sf).select("headline", slug(F.col("headline")).alias("slug")).distinct()


@query("f33_evidence_ids", sql("SELECT article_id, 'ev:' || substr(sha256('u' || CAST(article_id AS VARCHAR) || '|' || CAST(day AS VARCHAR)), 1, 16) AS evidence_id FROM articles"))
def evidence_ids(spark, sf):
    return articles(spark, sf).select("article_id", text.evidence_id(F.concat(F.lit("u"), F.col("article_id").cast("string")), F.col("day")).alias("evidence_id"))


@query("f19_signal_types", sql("SELECT article_id, CASE WHEN importance_score / 100 >= 0.55 THEN 'NOISE' WHEN burst_score >= 0.8 THEN 'BREAKING' WHEN novelty_score >= 0.6 THEN 'WEAK_SIGNAL' ELSE 'TREND' END AS kind FROM articles"))
def signal_types(spark, sf):
    return articles(spark, sf).select("article_id", text.signal_type(F.col("importance_score") / 100, F.col("novelty_score"), F.col("burst_score")).alias("kind"))


@query("f25_strengths", sql("""
r AS (SELECT article_id, ['frame', 'graphrag', 'agenda', 'other'][article_id % 4 + 1] AS kind, 'KL=' || CAST(article_id % 30 AS VARCHAR) || '.5 entities=' || CAST(article_id % 40 AS VARCHAR) || ', articles=' || CAST(article_id % 25 AS VARCHAR) AS rel, CASE WHEN article_id % 3 = 0 THEN 0.5 ELSE 1.0 END AS s, article_id % 9 AS lag FROM articles)
SELECT article_id, round(CASE WHEN s < 0.999 THEN s WHEN kind = 'frame' THEN least(1, ln(1 + article_id % 30 + 0.5) / ln(26)) WHEN kind = 'graphrag' THEN least(1, 0.6 * ln(1 + article_id % 40) / ln(501) + 0.4 * ln(1 + article_id % 25) / ln(201))
  WHEN kind = 'agenda' AND lag = 0 THEN 0.5 WHEN kind = 'agenda' THEN 0.9 + 0.09 * ln(1 + lag) / ln(31) ELSE s END, 6) + 0.0::DOUBLE AS strength FROM r"""))
def strengths(spark, sf):
    i = F.col("article_id")
    kind = F.get(F.array(*map(F.lit, ("frame", "graphrag", "agenda", "other"))), (i % 4).cast("int"))
    told = F.concat(F.lit("KL="), (i % 30).cast("string"), F.lit(".5 entities="), (i % 40).cast("string"), F.lit(", articles="), (i % 25).cast("string"))
    return articles(spark, sf).select("article_id", F.round(text.effective_strength(kind, told, F.when(i % 3 == 0, 0.5).otherwise(1.0), i % 9), 6).alias("strength"))


_HAM = "bit_count(xor(a, b))"


@query("f23_hamming", sql("p AS (SELECT article_id, article_id * 7919 AS a, article_id * 104729 AS b FROM articles) SELECT article_id, CAST(bit_count(xor(a, b)) AS INT) AS distance, 1 - bit_count(xor(a, b)) / 64 AS similarity FROM p"))
def hamming(spark, sf):
    d = text.hamming(F.col("article_id") * 7919, F.col("article_id") * 104729)
    return articles(spark, sf).select("article_id", d.alias("distance"), (1 - d / 64).alias("similarity"))


@query("s39_accepted", r"""
WITH p AS (SELECT page_id, url, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title FROM pages) SELECT sha256(url) AS article_id, count(*) AS n FROM p WHERE trim(title) <> '' AND url <> '' GROUP BY 1""")
def accepted(spark, sf):
    return pipeline.accept(_raw(spark, sf)).groupBy("article_id").agg(F.count("*").alias("n"))


def _raw(spark, sf):
    """Pages as raw article rows."""
    p = table(spark, sf, "pages")
    null = F.lit(None).cast("string")
    return p.select(
        "url", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"), text.visible(F.col("html")).alias("body"), F.concat(F.lit("s"), F.col("page_id") % 5).alias("source_id"), F.lit("S").alias("source_name"), F.regexp_extract("html", 'lang="([a-z]+)"', 1).alias("language"),
        F.concat(F.lit("2024-01-"), F.lpad((F.col("page_id") % 28 + 1).cast("string"), 2, "0"), F.lit("T00:00:00Z")).alias("published_at"), F.lit("2024-01-29T00:00:00Z").alias("crawled_at"), null.alias("author"), F.lit("news").alias("category"), null.alias("evidence_id"), F.lit(False).alias("is_paywall_truncated"),
    )


# Raw rows as feeds give them: odd categories, times and languages, walls, rows without a title or address.
_RAW = """SELECT CASE WHEN article_id % 41 = 0 THEN '' WHEN article_id % 43 = 0 THEN NULL ELSE CONCAT('https://', source, '.org/', article_id) END AS url, CASE article_id % 37 WHEN 0 THEN '  ' WHEN 1 THEN NULL ELSE CONCAT('<b>', title, '</b>  &amp; more ') END AS title,
  CASE WHEN article_id % 31 <> 0 THEN CONCAT(headline, ' <i>', title, '</i>') END AS body, source AS source_id, CONCAT('Name of ', source) AS source_name,
  CASE article_id % 5 WHEN 0 THEN 'xx' WHEN 1 THEN NULL ELSE language END AS language,
  CASE article_id % 4 WHEN 0 THEN '2024-01-05T06:07:08Z' WHEN 1 THEN '2024-01-05 06:07:08' WHEN 2 THEN 'yesterday' END AS published_at, '2024-01-29T00:00:00Z' AS crawled_at, CAST(NULL AS {text}) AS author,
  CASE article_id % 6 WHEN 0 THEN CONCAT(chr(123), '"name": "World"', chr(125)) WHEN 1 THEN '["Sports", "Local"]' WHEN 2 THEN ' economy ' WHEN 3 THEN ' ' WHEN 4 THEN NULL ELSE 'news' END AS category,
  CASE WHEN article_id % 7 = 0 THEN CONCAT('e', article_id) ELSE 'e' END AS evidence_id, CASE article_id % 9 WHEN 0 THEN true WHEN 1 THEN NULL ELSE false END AS is_paywall_truncated FROM articles"""


@query("s39_accepted_rows", sql(f"""r AS ({_RAW.format(text="VARCHAR")}), a AS (SELECT *, rtrim(regexp_replace(title, '</?b>', '', 'g')) AS t FROM r WHERE trim(title) <> '' AND url <> ''),
b AS (SELECT *, replace(replace(t, '&amp;', '&'), '  ', ' ') AS title_, CASE WHEN coalesce(is_paywall_truncated, false) OR body IS NULL THEN '' ELSE regexp_replace(body, '</?i>', '', 'g') END AS body_ FROM a)
SELECT sha256(url) AS article_id, evidence_id, url, title_ AS title, body_ AS body, source_name AS source, CASE WHEN category LIKE '{{%' THEN 'World' WHEN category LIKE '[%' THEN 'Sports' WHEN trim(category) <> '' THEN trim(category) ELSE 'uncategorized' END AS category,
  CASE WHEN language IN ('ko', 'en', 'ja', 'es') THEN language WHEN source_id = 'src1' THEN 'de' ELSE 'en' END AS language, CASE WHEN published_at <> 'yesterday' THEN TIMESTAMP '2024-01-05 06:07:08' END AS published_at, TIMESTAMP '2024-01-29 00:00:00' AS crawled_at,
  author, CAST(len(list_filter(string_split(title_ || ' ' || body_, ' '), lambda x: x <> '')) AS INT) AS word_count, CASE WHEN body_ = '' THEN '' ELSE sha256(lower(body_)) END AS content_hash FROM b"""))
def accepted_rows(spark, sf):
    raw = spark.sql(_RAW.format(text="STRING").replace("FROM articles", "FROM {articles}"), articles=articles(spark, sf))
    return pipeline.accept(raw, {"src1": "de"})


@query("s44_fresh", r"""
WITH p AS (SELECT page_id, url, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title FROM pages) SELECT sha256(url) AS article_id, count(*) AS n FROM p WHERE trim(title) <> '' AND url <> '' AND page_id % 28 + 1 >= 14 GROUP BY 1""")
def fresh(spark, sf):
    return pipeline.fresh(pipeline.accept(_raw(spark, sf)), "2024-01-15 00:00:00").groupBy("article_id").agg(F.count("*").alias("n"))


@query("t2_deduplicated")
def deduplicated(spark, sf):
    """All pages, by address, title and fingerprint."""
    return pipeline.deduplicate(pipeline.accept(_raw(spark, sf))).select("article_id", "url_key")


_T = "CAST(len(list_intersect(string_split(a, ' '), string_split(b, ' '))) AS DOUBLE) / len(list_distinct(string_split(a, ' ') || string_split(b, ' ')))"


@query("f21_similar_titles", f"""
WITH t AS (SELECT DISTINCT lower(p_name || ' ' || p_type) AS t FROM part), p AS (SELECT x.t AS a, y.t AS b FROM t x JOIN t y ON x.t < y.t)
SELECT a, b FROM p WHERE {_T} >= 0.8 OR levenshtein(a, b) < 0.2 * greatest(length(a), length(b)) OR (least(length(a), length(b)) > 10 AND substr(a, 1, least(length(a), length(b))) = substr(b, 1, least(length(a), length(b))) AND least(length(a), length(b)) > 0.7 * greatest(length(a), length(b)))""")
def similar_titles(spark, sf):
    """The names and types of all parts, by all three rules; f21_titles_alike has the titles of all documents."""
    return titles.alike(table(spark, sf, "part").select(F.lower(F.concat_ws(" ", "p_name", "p_type")).alias("form")))
