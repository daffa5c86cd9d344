"""Text as column expressions: cleaning, tokens, scores of noise and novelty, fingerprints, titles."""

from __future__ import annotations

import functools
import hashlib
import operator
import re
import unicodedata

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# The common entities.
ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")]
# Patterns of the cleaning steps, in their order.
TAG, URL, EMAIL = "<[^>]+>", r"(?i)https?://[^\s<>\"')\]]+", r"(?i)[a-z0-9._%+-]+@[a-z0-9.-]+\.[a-z]{2,}"
DECORATION = r"[~\x{25a0}\x{25cf}\x{25cb}\x{2605}\x{2606}\x{2190}-\x{2199}\x{2500}-\x{257f}]+"


def clean(text: Column) -> Column:
    """Unescape the common entities, then strip tags, addresses and decoration, and collapse white space."""
    for name, c in ENTITIES:
        text = F.replace(text, F.lit(name), F.lit(c))
    for pattern, to in ((TAG, ""), (URL, ""), (EMAIL, ""), (DECORATION, ""), (r"\n{3,}", "\n\n"), (r"[ \t]+", " ")):
        text = F.regexp_replace(text, pattern, to)
    return F.trim(text)


def visible(html: Column) -> Column:
    """The text of a page: without scripts, styles and comments, block ends as line feeds, other tags removed."""
    x = F.regexp_replace(html, r"(?is)<(script|style|noscript)\b[^>]*>.*?</\1>|<!--.*?-->", "")
    x = F.regexp_replace(x, r"(?i)</(p|div|li|h[1-6]|tr|section|article)>|<br\s*/?>", "\n")
    return F.regexp_replace(F.regexp_replace(clean(x), r"\s*\n\s*", "\n"), r"^\s+|\s+$", "")


def words(text: Column) -> Column:
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.size(words(text))


def sentences(text: Column) -> Column:
    """Sentences by their ends: Latin ones before white space, CJK ones with or without it, and line feeds."""
    return F.filter(F.transform(F.split(text, r"(?<=[.!?])\s+|(?<=[\x{3002}\x{FF01}\x{FF1F}])\s*|\n+"), F.trim), lambda s: s != "")


def unicode_form(text: Column, lang: Column) -> Column:
    """Compatibility composition (NFKC) for Korean, Japanese and Chinese, canonical (NFC) for others; null stays."""

    @F.pandas_udf("string")
    def form(texts: pd.Series, langs: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else unicodedata.normalize("NFKC" if x in ("ko", "ja", "zh") else "NFC", t) for t, x in zip(texts, langs, strict=True)], dtype=object)

    return form(text, lang)


def decoded(raw: Column) -> Column:
    """Bytes as text: UTF-8, else EUC-KR, else Latin-1, which always fits. Valid UTF-8 never leaves the JVM's string."""

    @F.pandas_udf("string")
    def other(values: pd.Series) -> pd.Series:
        def one(b: bytes | None) -> str | None:
            if b is None:
                return None
            try:
                return bytes(b).decode("euc-kr")
            except UnicodeDecodeError:
                return bytes(b).decode("latin-1")

        return pd.Series([one(v) for v in values], dtype=object)

    as_text = raw.cast("string")
    return F.when(F.is_valid_utf8(as_text), as_text).otherwise(other(raw))


#: Common words that tell a language where no model is given.
STOP_WORDS = {
    "en": ["the", "and", "of", "to", "in", "is", "that", "for", "was", "with", "are", "has", "this"], "de": ["der", "die", "und", "das", "ist", "nicht", "mit", "den", "ein", "von", "auf", "auch", "im"],
    "fr": ["le", "les", "et", "des", "est", "une", "dans", "du", "pour", "qui", "sur", "pas", "au"], "es": ["el", "los", "y", "las", "del", "una", "por", "con", "para", "es", "al", "como", "más"],
    "it": ["il", "di", "che", "della", "gli", "per", "sono", "nel", "non", "con", "alla", "è", "anche"], "pt": ["o", "os", "do", "da", "em", "um", "uma", "não", "com", "para", "dos", "é", "mais"],
    "sv": ["och", "att", "det", "som", "en", "på", "är", "av", "för", "inte", "ett", "med", "till"], "no": ["og", "det", "som", "en", "på", "er", "av", "ikke", "et", "til", "med", "har", "fra"], "cs": ["je", "na", "že", "se", "to", "jako", "pro", "jsou", "ale", "byl", "které", "podle", "také"],
}
#: Scripts that tell a language by themselves: kana before Han, which Japanese has too.
SCRIPTS = [("ko", r"\x{AC00}-\x{D7A3}"), ("ja", r"\x{3040}-\x{30FF}"), ("zh", r"\x{4E00}-\x{9FFF}"), ("ru", r"\x{0400}-\x{04FF}")]


def language(title: Column, body: Column, expected: Column, sure: float = 0.9) -> Column:
    """The language of the title and the first 200 characters of the body, by script, then by the share that each language has of the
    stop words found. Under ten characters, and where it disagrees with a share of ``sure`` or less, it is ``expected``."""
    sample = F.trim(F.concat_ws(" ", title, F.substring(F.coalesce(body, F.lit("")), 1, 200)))
    letters = F.greatest(F.length(F.regexp_replace(sample, r"[^\p{L}]", "")), F.lit(1))
    script = F.coalesce(*(F.when(F.length(F.regexp_replace(sample, f"[^{chars}]", "")) / letters >= (0.1 if lang in ("ko", "ja") else 0.5), lang) for lang, chars in SCRIPTS), F.lit(None))
    found = F.split(F.lower(sample), r"[^\p{L}]+")
    common = lambda ws: F.size(F.filter(found, lambda w: w.isin(ws)))
    hits = F.array(*(F.struct(common(ws).alias("n"), F.lit(lang).alias("lang")) for lang, ws in STOP_WORDS.items()))
    total, best = F.aggregate(hits, F.lit(0), lambda s, x: s + x["n"]), F.array_max(F.filter(hits, lambda x: x["n"] > 0))
    guess = F.when((best["n"] / total > sure) | (best["lang"] == expected), best["lang"])
    return F.when(F.length(sample) < 10, expected).otherwise(F.coalesce(script, guess, expected))


def content_words(text: Column, lang: Column) -> Column:
    """Words in lower case without the language's stop words; in Korean, Japanese and Chinese runs of two characters or more, elsewhere
    letters of three or more."""
    low = F.lower(F.coalesce(text, F.lit("")))
    cjk = F.regexp_extract_all(low, F.lit(r"[\x{3040}-\x{30FF}\x{4E00}-\x{9FFF}\x{AC00}-\x{D7A3}\p{L}\p{N}_]{2,}"), F.lit(0))
    latin = F.regexp_extract_all(low, F.lit(r"\p{L}{3,}"), F.lit(0))
    stop = F.create_map(*(x for k, ws in STOP_WORDS.items() for x in (F.lit(k), F.array(*map(F.lit, ws)))))
    return F.when(lang.isin("ko", "ja", "zh"), cjk).otherwise(F.filter(latin, lambda w: ~F.coalesce(F.array_contains(stop[lang], w), F.lit(False))))


def effective_strength(kind: Column, relationship: Column, strength: Column, lag: Column) -> Column:
    """A link's strength where old rows were cut off at 1: by the divergence that the relationship tells (frames), by its entities and
    articles (chains), and by the lag (agendas: none is worth a half)."""
    number = lambda pattern: F.regexp_extract(relationship, pattern, 1).try_cast("double")
    kl, n, m = number(r"KL=([\d.]+)"), number(r"entities=(\d+),\s*articles=\d+"), number(r"entities=\d+,\s*articles=(\d+)")
    one = F.lit(1.0)
    days = F.coalesce(lag.cast("double"), F.lit(0.0))
    full = strength >= 0.999
    return (
        F.when(full & (kind == "frame") & kl.isNotNull(), F.least(one, F.log1p(kl) / F.log1p(F.lit(25.0))))
        .when(full & (kind == "graphrag") & n.isNotNull(), F.least(one, 0.6 * F.log1p(n) / F.log1p(F.lit(500.0)) + 0.4 * F.log1p(m) / F.log1p(F.lit(200.0))))
        .when(full & (kind == "agenda"), F.when(days <= 0, 0.5).otherwise(0.9 + 0.09 * F.log1p(days) / F.log1p(F.lit(30.0))))
        .otherwise(strength)
    )


def content_hash(body: Column) -> Column:
    """SHA-256 of the body in lower case with collapsed white space; '' for a blank one."""
    x = F.trim(F.regexp_replace(F.lower(F.coalesce(body, F.lit(""))), r"\s+", " "))
    return F.when(x == "", "").otherwise(F.sha2(x, 256))


def evidence_id(url: Column, published: Column) -> Column:
    return F.when(published.isNotNull(), F.concat(F.lit("ev:"), F.substring(F.sha2(F.concat_ws("|", url, published.cast("string")), 256), 1, 16)))


def hangul_language(text: Column, share: float = 0.1) -> Column:
    """``ko`` if a tenth of the characters are Hangul syllables, else ``en``."""
    n = F.length(F.regexp_replace(text, r"[^\x{AC00}-\x{D7A3}]", ""))
    return F.when(n >= share * F.length(text), "ko").otherwise("en")


def body_quality(body: Column, paywall: Column) -> Column:
    n = F.length(F.trim(body))
    return F.when(paywall, "PAYWALL").when(n >= 500, "FULL").when(n >= 100, "PARTIAL").otherwise("TITLE_ONLY")


def is_paywall(text: Column, phrases: list[str]) -> Column:
    """Under 50 characters, two strong phrases, or one in under 2,000 characters."""
    hits = sum((F.contains(F.lower(text), F.lit(p)).cast("int") for p in phrases), F.lit(0))
    return (F.length(text) < 50) | (hits >= 2) | ((hits == 1) & (F.length(text) < 2000))


# What marks scores, closing prices, weather and notices, in all languages. Words without capitals are apart.
RESULT, WON = r"\b\d{1,3}\s*[-:]\s*\d{1,3}\b", r"(?:win|loss|defeat|beat|scored|ganó|perdió|empate|gol)\b"
WON_ASIAN, ITS_PARTS = r"(?:승리|패배|득점|무승부|승|패|シュート|得点|勝|敗|引き分け)\b", ["승", "패", "득점", "シュート", "得点", "勝", "敗", "引き分け"]
CLOSED, CHANGE = r"close[sd]|closing|market\s+wrap", r"[+-]\s*\d+\.?\d*\s*%"
CLOSED_ASIAN, POINTS, MOVED = ["마감", "종가", "종합지수", "코스피", "코스닥", "나스닥", "다우"], r"(?:포인트|bp|bps)\s+(?:상승|하락|올랐|내렸)", ["상승", "하락", "올랐", "내렸"]
#: How the words of ``WON`` and ``CLOSED`` begin, in all cases that Java takes for the same (dotless i, long s): where nothing begins, no word is tried.
WON_BEGINS = r"(?-i)(?=[wldbgpeWLDBGPEsS\x{17F}])(?=[wW][iI\x{130}\x{131}]|[lLgG][oO]|[dDbBpP][eE]|[sS\x{17F}][cC]|[gG][aA]|[eE][mM])(?i)"
CLOSED_BEGINS = r"(?-i)(?=[cCmM][lLaA])(?i)"
WEATHER = r"(?:날씨|기온|강수|강설|맑음|흐림)|(?:weather\s+forecast|temperature)|(?:\d{1,2}°[CF])"
NOTICES = r"(?:오늘의\s+일정|일정\s+안내|공고|고시|입찰공고)|(?:press\s+release|media\s+advisory|embargo)|(?:agenda\s+for|schedule\s+for\s+(?:today|tomorrow))"
# Words of a title that tell of something new.
SURPRISES = ["처음", "최초", "역대", "사상", "unprecedented", "first time", "new high", "new low", "reversal", "surprise", "unexpected", "반전", "충격", "돌파", "사상 최초", "전례없는"]


def noise(title: Column, body: Column, quality: Column) -> Column:
    """How much an article looks like scores, prices, weather or notices, 0 to 1. Word ends are those of any script.

    A rule meets a text only if that has what each of its matches has: a sign, or one of the words without capitals.
    """
    n, both = F.length(F.trim(body)), F.concat_ws(" ", title, F.substring(body, 1, 500))
    score = F.when(quality.isin("TITLE_ONLY", "PAYWALL") | (n < 150), 0.45).when(n < 400, 0.20).otherwise(0.0)
    digits = F.length(F.regexp_replace(F.trim(title), r"[^0-9]", ""))
    wide = F.octet_length(both) > F.length(both)
    has = lambda parts: functools.reduce(operator.or_, (F.contains(both, F.lit(p)) for p in parts))
    scores = (has("-:") & both.rlike(f"(?iU){RESULT}")) | (wide & has(ITS_PARTS) & both.rlike(f"(?U){WON_ASIAN}")) | both.rlike(f"(?iU){WON_BEGINS}(?:{WON})")
    closing = (has("%") & both.rlike(f"(?iU){CHANGE}")) | (wide & (has(CLOSED_ASIAN) | (has(MOVED) & both.rlike(f"(?iU){POINTS}")))) | both.rlike(f"(?iU){CLOSED_BEGINS}(?:{CLOSED})")
    rules = [
        (scores, 0.35), (closing, 0.30), (title.rlike(f"(?iU){WEATHER}"), 0.40), (title.rlike(f"(?iU){NOTICES}"), 0.35),
        ((F.length(F.trim(title)) < 15) & (digits > 0.4 * F.length(F.trim(title))), 0.25),
    ]
    return F.least(sum((F.when(hit, v).otherwise(0.0) for hit, v in rules), score), F.lit(1.0))


def novelty(title: Column, body: Column, quality: Column, codes: Column, places: Column, named: Column) -> Column:
    """How much an article looks like something new, 0 to 1."""
    n, geo = F.size(codes), F.size(F.array_except(F.array_distinct(places), F.array(*map(F.lit, ("UNKNOWN", "EU", "NATO", "UN")))))
    parts = [
        F.when(F.length(F.trim(body)) >= 800, 0.20).when(quality == "FULL", 0.10), F.when(F.array_contains(codes, "CRS") | (n >= 3), 0.25).when(n == 2, 0.10),
        F.when(geo >= 3, 0.20).when(geo == 2, 0.10), F.when(named >= 6, 0.20).when(named >= 3, 0.10), F.when(F.lower(title).rlike("|".join(SURPRISES)), 0.15),
    ]
    return F.least(sum((F.coalesce(p, F.lit(0.0)) for p in parts), F.lit(0.0)), F.lit(1.0))


def signal_type(noise_score: Column, novelty_score: Column, burst_score: Column) -> Column:
    return F.when(noise_score >= 0.55, "NOISE").when(burst_score >= 0.8, "BREAKING").when(novelty_score >= 0.6, "WEAK_SIGNAL").otherwise("TREND")


def keyword_scores(title: Column, body: Column, keywords: dict[str, list[str]], in_title: float = 3.0) -> Column:
    """Normalised keyword hits by code: ``array<struct<score, code>>``, best first; title hits weigh ``in_title``."""
    hits = [F.struct((in_title * F.regexp_count(title, F.lit(p)) + F.regexp_count(F.substring(body, 1, 3000), F.lit(p))).alias("score"), F.lit(code).alias("code")) for code, ws in keywords.items() for p in [r"(?i)\b(" + "|".join(ws) + r")\b"]]
    both = F.array(*hits)
    total = F.aggregate(both, F.lit(0.0), lambda s, x: s + x["score"])
    norm = F.transform(both, lambda x: F.struct(F.when(total > 0, x["score"] / total).otherwise(0.0).alias("score"), x["code"].alias("code")))
    return F.array_sort(norm, lambda a, b: F.when(a["score"] > b["score"], -1).when(a["score"] < b["score"], 1).when(a["code"] < b["code"], -1).otherwise(1))


def title_form(title: Column) -> Column:
    """A title without its tag in front and its site behind, lower case, single spaces."""
    x = F.regexp_replace(F.trim(title), r"^\s*(\[[^\]]{1,20}\]\s*)+", "")
    x = F.regexp_replace(x, r"\s+[|–—-]\s+[^|–—-]{2,30}$", "")
    return F.regexp_replace(F.trim(F.lower(x)), r"\s+", " ")


# Kana, Han and Hangul, by code point, and the share of a text's letters from which it is cut by characters.
CJK, CJK_SHARE = r"\x{3040}-\x{30FF}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{AC00}-\x{D7AF}", 0.4


def mostly_cjk(text: Column) -> Column:
    """Whether over ``CJK_SHARE`` of the letters are kana, Han or Hangul."""
    letters = F.length(F.regexp_replace(text, r"[^\p{L}]", ""))
    return F.length(F.regexp_replace(text, f"[^{CJK}]", "")) > CJK_SHARE * letters


def title_words(form: Column) -> Column:
    """The set that a title is compared by: its words, or its single letters where most are kana, Han or Hangul."""
    return F.array_distinct(F.when(mostly_cjk(form), F.split(F.regexp_replace(form, r"[^\p{L}]", ""), "")).otherwise(F.split(form, " ")))


def titles_alike(a: Column, b: Column, jaccard: float = 0.8, edit: float = 0.2) -> Column:
    """Jaccard of ``title_words``, normalised edit distance, or a prefix of more than 10 characters and 70 %; of normal forms."""
    x, y = title_words(a), title_words(b)
    j = F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y))
    most, least = F.greatest(F.length(a), F.length(b)), F.least(F.length(a), F.length(b))
    prefix = (least > 10) & (F.substring(a, F.lit(1), least) == F.substring(b, F.lit(1), least)) & (least > 0.7 * most)
    return (a != "") & (b != "") & ((a == b) | (j >= jaccard) | (F.levenshtein(a, b) < edit * most) | prefix)


def simhash_of(grams: list[bytes]) -> int:
    """64-bit SimHash: the bits that over half of the hashes have, each the first eight bytes of a gram's SHA-256; as a signed number."""
    counts = np.zeros(64, np.int64)
    for i in range(0, len(grams), 1 << 16):
        first = b"".join([hashlib.sha256(g).digest()[:8] for g in grams[i : i + (1 << 16)]])
        counts += np.unpackbits(np.frombuffer(first, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(grams)).tobytes(), "big", signed=True)


#: Runs of the characters of ``CJK``, for Python.
_CJK_RUN = re.compile("[" + re.sub(r"\\x\{(\w+)\}", r"\\u\1", CJK) + "]+")


def simhash64(text: Column, n: int = 3) -> Column:
    """64-bit SimHash of word ``n``-grams, or of pairs of characters where most letters are kana, Han or Hangul; 0 under 50 characters.

    Case and punctuation don't count; a gram's hash is the first eight bytes of SHA-256. With fewer than ``n`` words each word is a gram.
    What is no letter or number goes by a built-in expression; grams are cut, hashed and counted over Arrow batches, as no built-in
    one reads a hash as a number at once, and one for the share of ``CJK`` meets each character of the text several times.
    """

    def runs(parts: list[bytes], k: int, by: bytes) -> list[bytes]:
        return [by.join(x) for x in zip(*(parts[i:] for i in range(k)))] if len(parts) >= k else parts  # noqa: B905

    def by_characters(t: str) -> bool:
        return (found := sum(map(len, _CJK_RUN.findall(t)))) > 0 and found > CJK_SHARE * sum(map(str.isalpha, t))

    def one(t: bytes) -> int:
        w = t.split()  # all white space that is left is ASCII
        if not t.isascii() and by_characters(t.decode(errors="replace")):
            return simhash_of(runs([c.encode() for c in b"".join(w).decode(errors="replace")], 2, b""))
        return simhash_of(runs(w, n, b" "))

    @F.arrow_udf("long")
    def fingerprint(plain: pa.Array) -> pa.Array:
        return pa.array([None if t.as_py() is None else one(t.as_py()) for t in plain], pa.int64())

    plain = F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}_\s\x{3001}-\x{9FFF}\x{AC00}-\x{D7AF}]+", " ")
    return F.when(F.length(text) < 50, F.lit(0).cast("long")).otherwise(fingerprint(plain.cast("binary")))


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))
