"""Feeds and logs as tables: RSS and Atom entries, sitemaps, crawl logs. Documents come as rows of text, wherever from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# What a failed fetch's message says about its kind, first match wins.
FAILURES = [("blocked", r"(?i)\b(403|429)\b|captcha|blocked|forbidden"), ("timeout", r"(?i)time[d]?\s?out"), ("dns", r"(?i)dns|name resolution|getaddrinfo"), ("not_found", r"(?i)\b404\b|not found"), ("parse", r"(?i)parse|extract|empty body"), ("server", r"(?i)\b5\d\d\b|server error")]


def _inner(xml, tag: str):
    """The text of the first such element, CDATA and entities resolved."""
    x = F.regexp_extract(xml, rf"(?is)<(?:\w+:)?{tag}\b[^>]*>(.*?)</(?:\w+:)?{tag}>", 1)
    x = F.regexp_replace(x, r"(?s)<!\[CDATA\[(.*?)\]\]>", "$1")
    for name, c in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        x = F.replace(x, F.lit(name), F.lit(c))
    return F.nullif(F.trim(x), F.lit(""))


def feed_entries(feeds: DataFrame, text: str = "xml", since: str | None = None) -> DataFrame:
    """``title, url, published_at, summary`` of RSS items and Atom entries; those before ``since`` go, undated ones stay."""
    e = feeds.select(F.explode(F.regexp_extract_all(text, F.lit(r"(?is)(<item\b.*?</item>|<entry\b.*?</entry>)"), 1)).alias("e"))
    link = F.coalesce(_inner(F.col("e"), "link"), F.nullif(F.regexp_extract("e", r"""(?is)<link\b[^>]*href=["']([^"']+)""", 1), F.lit("")))
    day = F.coalesce(_inner(F.col("e"), "pubDate"), _inner(F.col("e"), "published"), _inner(F.col("e"), "updated"))
    rfc = F.regexp_replace(day, r"^\w{3},\s*", "")
    when = F.coalesce(F.try_to_timestamp(day), F.try_to_timestamp(rfc, F.lit("d MMM yyyy HH:mm:ss Z")), F.try_to_timestamp(F.regexp_replace(rfc, "GMT|UTC", "+0000"), F.lit("d MMM yyyy HH:mm:ss Z")))
    out = e.select(_inner(F.col("e"), "title").alias("title"), link.alias("url"), when.alias("published_at"), F.coalesce(_inner(F.col("e"), "description"), _inner(F.col("e"), "summary")).alias("summary")).where("url is not null")
    return out.where(F.col("published_at").isNull() | (F.col("published_at") >= F.lit(since).cast("timestamp"))) if since else out


def sitemap_urls(maps: DataFrame, text: str = "xml") -> DataFrame:
    """``url, modified, is_index``: addresses in URL sets and in indexes; the day from the address where there is no other."""
    e = maps.select(F.explode(F.regexp_extract_all(text, F.lit(r"(?is)(<url>.*?</url>|<sitemap>.*?</sitemap>)"), 1)).alias("e"))
    url = _inner(F.col("e"), "loc")
    day = F.coalesce(F.try_to_timestamp(_inner(F.col("e"), "lastmod")), F.try_to_timestamp(F.nullif(F.regexp_extract(url, r"(\d{4})[/-]?(\d{2})[/-]?(\d{2})", 0), F.lit("")), F.lit("yyyy/MM/dd")))
    return e.select(url.alias("url"), day.alias("modified"), F.col("e").startswith("<sitemap").alias("is_index")).where("url is not null")


def diagnose(lines: DataFrame, text: str = "value") -> DataFrame:
    """Failures by site and kind from log lines ``... site=NAME ... ERROR message``, one column a kind."""
    kind = F.lit("other")
    for name, pattern in reversed(FAILURES):
        kind = F.when(F.col(text).rlike(pattern), name).otherwise(kind)
    failed = lines.where(F.col(text).rlike(r"\bERROR\b|\bWARN")).select(F.regexp_extract(text, r"site=(\S+)", 1).alias("site"), kind.alias("kind")).where("site <> ''")
    return failed.groupBy("site").pivot("kind", [n for n, _ in FAILURES] + ["other"]).count().na.fill(0)
