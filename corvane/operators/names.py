"""Names in articles: which are valid, one form of each, what two names have to do with each other, and the countries
and places that an article is about. Column expressions and joins with dimension tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Lengths, the share of digits, and what marks a phrase instead of a name in Korean.
SHORTEST, LONGEST, MOST_DIGITS, LONGEST_KO_PHRASE = 2, 50, 0.8, 20
KO_ENDINGS = "(거든|니까|습니다|됩니다|입니다|합니다|했다|겠다|된다|한다|세요|네요|어요|아요)$"
KO_PARTICLES = "(을|를|에서|에게|으로|과|와|이나|까지|부터|에는|에도|으로서|으로써)"
HONORIFIC = r"^(?i:Mr\.?|Ms\.?|Mrs\.?|Dr\.?|Prof\.?|Sr\.?|Jr\.?)\s+"
# Names that are noise in the graph, and words that tell places and organisations.
NOISE = ["sin", "el que", "tanto", "los ultimos", "todas las noticias", "artículos de opinión", "noticias", "últimos", "있다고", "있으며", "했다고", "됐다고", "밝혔다", "전했다"]
PLACE_WORDS = ["city", "state", "province", "country", "county", "washington", "beijing", "tokyo", "seoul", "london", "new york", "paris", "berlin", "moscow", "delhi"]
ORG_WORDS = ["inc", "corp", "ltd", "company", "group", "bank", "ministry", "department", "university", "institute", "association", "organization", "commission", "agency", "council", "foundation", "fund"]
# Weights of a place in the title, in the first characters, in the rest, and as a named place.
IN_TITLE, IN_FRONT, IN_REST, NAMED, NAMED_IN_PART = 5.0, 3.0, 1.0, 4.0, 0.7
FRONT, READ, LEAST_SHARE, LEAST_SCORE = 300, 2000, 0.10, 1.0


def valid(name: Column, lang: Column) -> Column:
    """Whether a name is one: 2 to 50 characters, mostly not digits, in Korean no sentence end, particle or long phrase."""
    n = F.length(name)
    ok = (n >= SHORTEST) & (n <= LONGEST) & (F.length(F.regexp_replace(name, "[^0-9]", "")) <= MOST_DIGITS * n)
    phrase = name.rlike(KO_ENDINGS) | name.rlike(KO_PARTICLES) | (F.contains(name, F.lit(" ")) & (n > LONGEST_KO_PHRASE))
    return F.coalesce(ok & ((lang != "ko") | lang.isNull() | ~phrase), F.lit(False))


def normal(name: Column) -> Column:
    """Without an honorific in front, single spaces."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.trim(name), HONORIFIC, ""), r"\s+", " "))


def distinct(names: Column) -> Column:
    """The normal forms of an array of names, in order, where of two names of which one holds the other (in any case) the
    longer one stays, the shorter one's place being given up."""

    def add(kept: Column, name: Column) -> Column:
        low = F.lower(name)
        same = F.exists(kept, lambda k: F.lower(k) == low)
        first = F.get(F.filter(kept, lambda k: F.contains(F.lower(k), low) | F.contains(low, F.lower(k))), F.lit(0))
        merged = F.when(F.contains(F.lower(first), low), kept).otherwise(F.concat(F.array_remove(kept, first), F.array(name)))
        return F.when(same | (name == ""), kept).when(first.isNull(), F.concat(kept, F.array(name))).otherwise(merged)

    return F.aggregate(F.transform(F.coalesce(names, F.array().cast("array<string>")), normal), F.array().cast("array<string>"), add)


def node(name: Column) -> Column:
    """The form of a name as a node of the graph; '' for single characters and noise."""
    x = F.trim(F.regexp_replace(F.coalesce(name, F.lit("")), r"\s+", " "))
    return F.when((F.length(x) <= 1) | F.lower(x).isin(NOISE), "").otherwise(x)


def relation(a: Column, b: Column) -> Column:
    """``located_in`` if either name sounds like a place, ``works_at`` if like an organisation, else ``mentioned_with``."""
    has = lambda ws: F.coalesce(F.lower(a).rlike("|".join(ws)) | F.lower(b).rlike("|".join(ws)), F.lit(False))
    return F.when(has(PLACE_WORDS), "located_in").when(has(ORG_WORDS), "works_at").otherwise("mentioned_with")


def named_count(*lists: str) -> Column:
    """How many names an article has in all its lists; a missing list has none."""
    return sum((F.coalesce(F.size(F.col(c)), F.lit(0)) for c in lists), F.lit(0)).cast("long")


def countries(articles: DataFrame, names: DataFrame, key: str = "article_id", column: str = "entities_location") -> DataFrame:
    """``KEY, countries``: the distinct codes, sorted, of the places an article names exactly; ``names``: ``name, code``
    (a dimension). Articles without one have an empty array."""
    each = articles.select(key, F.explode(column).alias("name")).select(key, F.trim("name").alias("name"))
    found = each.join(names.select("name", "code").distinct(), "name").groupBy(key).agg(F.sort_array(F.collect_set("code")).alias("countries"))
    return articles.select(key).join(found, key, "left").select(key, F.coalesce("countries", F.array().cast("array<string>")).alias("countries"))


def _alias_pattern(aliases: list[str]) -> str:
    escaped = "|".join(r"\Q" + a + r"\E" for a in sorted(aliases, key=lambda a: (-len(a), a)))
    return f"(?<![가-힣a-z])({escaped})(?![가-힣a-z])"


def place_focus(articles: DataFrame, aliases: dict[str, str], key: str = "article_id", title: str = "title", body: str = "body", named: str = "entities_location") -> DataFrame:
    """``KEY, code, score, share, rank``: the places an article is about, best first (ties by code).

    ``aliases`` maps names in lower case to codes. A hit counts 5 in the title, 3 in the first 300 characters of the body
    and 1 up to character 2000; a named place counts 4, and 2.8 where it only holds an alias of four characters or more
    (the longest one). Codes under a tenth of the best score, or under 1, are not about; ``share`` is of all scores.
    One pass over the texts: the pattern takes the longest alias at each place, the codes come from a map.
    """
    pattern, codes = _alias_pattern(list(aliases)), F.create_map(*(F.lit(x) for kv in aliases.items() for x in kv))
    low = lambda c: F.lower(F.coalesce(F.col(c), F.lit("")))
    parts = [(low(title), IN_TITLE), (F.substring(low(body), 1, FRONT), IN_FRONT), (F.substring(low(body), FRONT + 1, READ - FRONT), IN_REST)]
    weighed = lambda w: lambda x: F.struct(codes[x].alias("code"), F.lit(w).alias("score"))
    hits = [F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), weighed(w)) for text, w in parts]
    long = sorted((a for a in aliases if len(a) >= 4), key=lambda a: (-len(a), a))
    inside = lambda x: F.coalesce(*(F.when(F.contains(x, F.lit(a)), F.lit(aliases[a])) for a in long), F.lit(None).cast("string"))
    names = F.transform(F.coalesce(F.col(named), F.array().cast("array<string>")), lambda x: F.lower(F.trim(x)))
    hits.append(F.transform(names, lambda x: F.struct(F.coalesce(codes[x], inside(x)).alias("code"), F.when(codes[x].isNotNull(), NAMED).otherwise(NAMED * NAMED_IN_PART).alias("score"))))
    each = articles.select(key, F.explode(F.concat(*hits)).alias("x")).where("x.code is not null").groupBy(key, "x.code").agg(F.sum("x.score").alias("score"))
    all_of = each.groupBy(key).agg(F.sum("score").alias("total"), F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "code"))).alias("codes"))  # an article's codes: as many as there are codes at the most
    best = -F.get("codes", F.lit(0))["s"]
    kept = F.filter("codes", lambda x: -x["s"] >= F.greatest(F.lit(LEAST_SCORE), LEAST_SHARE * best))
    return all_of.select(key, "total", F.posexplode(kept).alias("at", "x")).select(key, "x.code", (-F.col("x.s")).alias("score"), (-F.col("x.s") / F.col("total")).alias("share"), (F.col("at") + 1).alias("rank"))


def country_of_region(region: Column) -> Column:
    """A source's country from its region code: the code in capitals, the Middle East's a region; unknown if blank."""
    up = F.upper(F.trim(F.coalesce(region, F.lit(""))))
    return F.when(up == "", "UNKNOWN").when(up == "ME", "ME_REGION").otherwise(up)


def tier(site: Column, group: Column, daily: Column, world: list[str], niche: list[str]) -> Column:
    """A source's tier by the lists of world-wide and niche sites, its group, and how many articles a day it is good for."""
    return (
        F.when(site.isin(world), "GLOBAL").when(site.isin(niche) | (group == "D"), "NICHE").when((group == "E") & (daily >= 40), "GLOBAL")
        .when(group.isin("F", "G", "H", "I", "J") & (daily <= 10), "REGIONAL").otherwise("NATIONAL")
    )
