"""Quality rules whose cutoffs follow the data, in DataFrame functions only.

Each text is measured in its own row: word length, symbols, repeated lines, repeated words. Of the documents that pass
the base rules every measure goes into a quantile sketch of its language and source: counts in buckets whose width
grows with the value (exact below ``EXACT``, then ``EXACT / 2`` buckets for each doubling, so a quantile is off by less than
2 / ``EXACT`` of itself). Such sketches merge by adding counts: rows add up to sketches of a language and source, these to
the language's, those to one of all, whatever the order and the partitions. A group of fewer than ``least`` documents takes the
sketch of its language, a small language the sketch of all.

A cutoff is a fence around the median: as far beyond it as ``reach`` times the distance from the median to an outer
quantile, and never nearer than ``slack``, so that groups of like documents don't reject for trifles. The join of the
documents with the cutoffs of their group ends in the filter ``kept``.

Cases: null texts have no words and fail the base rules, as do empty ones; a null language or source is a group like
any other; rows that repeat an id are rows of their own; texts of any length are measured whole; words in windows are
compared by 64-bit hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import settle

SYMBOLS = "[#*$%&|<>]"
#: Base rules: fewer words, or a larger share of repeated words in percent, fail.
LEAST_WORDS, MOST_REPEATED = 10, 20
#: Words of a window, and values below which the sketch has a bucket each (a power of two).
WINDOW, EXACT = 5, 128
#: Documents that a group needs for cutoffs of its own.
LEAST = 200
#: Measures in whole units: of what they are the share, and the fence's sides, reach and slack.
MEASURES = {
    "word_length": ("1000 * word_chars div n_words", True, 6, 1500),  # thousandths of a character a word
    "symbols": ("10000 * n_symbols div word_chars", False, 6, 100),  # characters in ten thousand
    "dup_lines": ("10000 * n_dup_lines div n_lines", False, 6, 2000),  # lines in ten thousand
    "repeated": ("10000 * n_repeat_words div n_words", False, 6, 1500),  # words in ten thousand
}
#: Outer quantiles: up to a quarter of a group may be junk without moving its cutoffs.
LOW, HIGH = 0.25, 0.75
GROUP = ["_lang", "_source"]


def measured(docs: DataFrame) -> DataFrame:
    """``doc_id, lang, source, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words``, one row a row of ``docs``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+", -1), lambda w: w != "")
    d = docs.select("doc_id", "lang", "source", text.alias("_text"), lines.alias("_lines"), words.alias("_words"))
    d = d.select(
        "doc_id", "lang", "source", F.size("_words").cast("long").alias("n_words"),
        F.aggregate("_words", F.lit(0).cast("long"), lambda n, w: n + F.char_length(w)).alias("word_chars"), (F.size(F.split("_text", SYMBOLS, -1)) - 1).cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"), (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_h"),
    )
    k = 1
    while k < WINDOW:  # hashes of windows by doubling
        step = min(k, WINDOW - k)
        n = F.greatest(F.size("_h") - step, F.lit(0))
        d, k = d.withColumn("_h", F.zip_with(F.slice("_h", F.lit(1), n), F.slice("_h", F.lit(1 + step), n), lambda a, b: F.xxhash64(a, b))), k + step
    d = d.withColumn("_again", F.size(F.array_distinct("_h")) < F.size("_h"))
    # texts with a window found again: windows sorted by hash, the places of those that equal a neighbour, in order
    d = d.withColumn("_s", F.when(F.col("_again"), F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")))
    n = F.greatest(F.size("_s") - 1, F.lit(0))
    d = d.withColumn("_eq", F.zip_with(F.slice("_s", F.lit(1), n), F.slice("_s", F.lit(2), n), lambda a, b: a["h"] == b["h"])).withColumn("_no", F.when(F.size("_s") > 0, F.array(F.lit(False))).otherwise(F.array().cast("array<boolean>")))
    d = d.withColumn("_in", F.zip_with(F.concat("_no", "_eq"), F.concat("_eq", "_no"), lambda a, b: a | b))
    d = d.withColumn("_at", F.sort_array(F.filter(F.zip_with("_s", "_in", lambda s, x: F.when(x, s["i"])), lambda x: x.isNotNull())))
    n = F.greatest(F.size("_at") - 1, F.lit(0))
    gaps = F.zip_with(F.slice("_at", F.lit(1), n), F.slice("_at", F.lit(2), n), lambda a, b: F.least(b - a, F.lit(WINDOW)))
    covered = F.aggregate(gaps, F.lit(0).cast("long"), lambda t, x: t + x) + F.when(F.size("_at") > 0, WINDOW).otherwise(0)
    return d.select("doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", covered.cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def bucket(v: Column) -> Column:
    """The bucket of a whole number >= 0: itself below ``EXACT``, else ``EXACT / 2`` buckets for each doubling."""
    bits = EXACT.bit_length() - 1
    over = F.length(F.bin(v)) - bits  # how often the number is halved to come below EXACT
    half = F.lit(EXACT // 2)
    return F.when(v < EXACT, v).otherwise(over * half + F.floor(v / F.pow(F.lit(2.0), over))).cast("int")


def edges(b: Column) -> tuple[Column, Column]:
    """The least and the largest value of a bucket."""
    half = EXACT // 2
    over = F.floor(b / half) - 1
    low = (b - over * half) * F.pow(F.lit(2.0), over)
    return F.when(b < EXACT, b).otherwise(low).cast("long"), F.when(b < EXACT, b).otherwise(low + F.pow(F.lit(2.0), over) - 1).cast("long")


def sketches(rows: DataFrame) -> DataFrame:
    """``_lang, _source, measure, bucket, n``: the sketch of each language and source, of documents past the base rules.

    Groups are named by ``=`` and their value; null is the empty name.
    """
    values = F.explode(F.array(*(F.struct(F.lit(m).alias("measure"), bucket(F.expr(say)).alias("bucket")) for m, (say, *_) in MEASURES.items()))).alias("x")
    return rows.where(~F.col("base_failed")).select(*GROUP, values).groupBy(*GROUP, "x.measure", "x.bucket").agg(F.count("*").alias("n"))


def merged(sketch: DataFrame, by: list[str]) -> DataFrame:
    """Sketches added up over what ``by`` leaves out."""
    return sketch.groupBy(*by, "measure", "bucket").agg(F.sum("n").alias("n"))


def fences(sketch: DataFrame, by: list[str]) -> DataFrame:
    """``by, size, fences`` (a map of measure to its low and high end), from sketches of the groups ``by``."""
    w = Window.partitionBy(*by, "measure")
    told = sketch.withColumn("size", F.sum("n").over(w)).withColumn("upto", F.sum("n").over(w.orderBy("bucket")))
    low, high = edges(F.col("bucket"))
    at = lambda q, side: F.min(F.when(F.col("upto") >= F.ceil(q * F.col("size")), side))
    told = told.groupBy(*by, "measure").agg(F.first("size").alias("size"), at(LOW, low).alias("lo"), at(0.5, low).alias("mid_lo"), at(0.5, high).alias("mid_hi"), at(HIGH, high).alias("hi"))
    pick = lambda i: F.element_at(F.create_map(*(F.lit(x) for m, t in MEASURES.items() for x in (m, t[i]))), F.col("measure"))
    end = F.col("mid_hi") + F.greatest(pick(2) * (F.col("hi") - F.col("mid_hi")), pick(3))
    start = F.when(pick(1), F.col("mid_lo") - F.greatest(pick(2) * (F.col("mid_lo") - F.col("lo")), pick(3))).otherwise(F.lit(-1))
    told = told.withColumn("fence", F.struct(start.cast("long").alias("low"), end.cast("long").alias("high")))
    return told.groupBy(*by).agg(F.max("size").alias("size"), F.map_from_entries(F.collect_list(F.struct("measure", "fence"))).alias("fences"))


def cutoffs(sketch: DataFrame, least: int = LEAST) -> DataFrame:
    """``_lang, _source, fences`` of each group: its own, or those of its language or of all where too few documents are."""
    own, lang = fences(sketch, GROUP), fences(merged(sketch, GROUP[:1]), GROUP[:1]).select("_lang", F.col("size").alias("lang_size"), F.col("fences").alias("lang_fences"))
    everything = fences(merged(sketch.withColumn("_all", F.lit(0)), ["_all"]), ["_all"]).select(F.col("fences").alias("all_fences"))
    of = own.join(lang, "_lang").crossJoin(F.broadcast(everything))  # one row
    return of.select(*GROUP, F.when(F.col("size") >= least, F.col("fences")).when(F.col("lang_size") >= least, F.col("lang_fences")).otherwise(F.col("all_fences")).alias("fences"))


def filtered(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept``, one row a row of ``docs``.

    The measures are settled once, without texts; sketches and cutoffs come from them, and Spark broadcasts the settled cutoffs only
    below its own threshold of bytes.
    """
    name = lambda c: F.when(F.col(c).isNull(), "").otherwise(F.concat(F.lit("="), F.col(c).cast("string")))
    rows = settle(measured(docs).withColumn("base_failed", base_failed()).withColumn("_lang", name("lang")).withColumn("_source", name("source")).drop("lang", "source"))
    limits = settle(cutoffs(settle(sketches(rows)), least))
    inside = F.lit(True)
    for m, (say, *_) in MEASURES.items():
        fence = F.element_at("fences", F.lit(m))
        inside &= F.expr(say).between(fence["low"], fence["high"])
    told = rows.join(limits, GROUP, "left")
    kept = F.when(F.col("base_failed"), F.lit(False)).otherwise(F.coalesce(inside, F.lit(False)))
    return told.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"))


def oracle() -> str:
    """The same in SQL for DuckDB over ``documents``."""
    bits = EXACT.bit_length() - 1
    values = ", ".join(f"('{m}', {say.replace(' div ', ' // ')})" for m, (say, *_) in MEASURES.items())
    rules = ", ".join(f"('{m}', {str(both).lower()}, {reach}, {slack})" for m, (_, both, reach, slack) in MEASURES.items())

    def limits(name: str, by: str) -> str:
        group = f"{by}, measure" if by else "measure"
        return f"""{name}c AS (SELECT {group}, bucket, sum(n) AS n FROM sk GROUP BY ALL), {name}u AS (SELECT *, sum(n) OVER (PARTITION BY {group}) AS size, sum(n) OVER (PARTITION BY {group} ORDER BY bucket) AS upto FROM {name}c),
{name}q AS (SELECT {group}, any_value(size) AS size, min(low) FILTER (upto >= ceil({LOW} * size)) AS lo, min(low) FILTER (upto >= ceil(0.5 * size)) AS mlo, min(high) FILTER (upto >= ceil(0.5 * size)) AS mhi, min(high) FILTER (upto >= ceil({HIGH} * size)) AS hi FROM {name}u JOIN edge USING (bucket) GROUP BY {group}),
{name} AS (SELECT {group}, size, CASE WHEN two_sided THEN mlo - greatest(reach * (mlo - lo), slack) ELSE -1 END AS lo, mhi + greatest(reach * (hi - mhi), slack) AS hi FROM {name}q JOIN rule USING (measure))"""

    return f"""WITH t AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
m AS (SELECT r, doc_id, CASE WHEN lang IS NULL THEN '' ELSE '=' || lang END AS l, CASE WHEN source IS NULL THEN '' ELSE '=' || source END AS s, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM t),
win AS (SELECT r, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS g FROM m, unnest(range(1, len(w) - {WINDOW - 2})) AS u(i)), rep AS (SELECT r, unnest(range(i, i + {WINDOW})) AS p FROM win WHERE (r, g) IN (SELECT (r, g) FROM win GROUP BY r, g HAVING count(*) > 1)), nrep AS (SELECT r, count(DISTINCT p) AS k FROM rep GROUP BY r),
d AS (SELECT m.r, doc_id, l, s, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars, len(regexp_extract_all(text, '{SYMBOLS}')) AS n_symbols, len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(k, 0) AS n_repeat_words FROM m LEFT JOIN nrep ON nrep.r = m.r),
b AS (SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed FROM d),
v AS (SELECT r, l, s, x.measure, x.v::BIGINT AS v FROM b, LATERAL (VALUES {values}) AS x(measure, v) WHERE NOT base_failed),
k AS (SELECT *, CASE WHEN v < {EXACT} THEN v ELSE (length(bin(v)) - {bits}) * {EXACT // 2} + (v >> (length(bin(v)) - {bits})) END AS bucket FROM v), sk AS (SELECT l, s, measure, bucket, count(*) AS n FROM k GROUP BY ALL),
edge AS (SELECT DISTINCT bucket, CASE WHEN bucket < {EXACT} THEN bucket ELSE (bucket - (bucket // {EXACT // 2} - 1) * {EXACT // 2}) << (bucket // {EXACT // 2} - 1) END AS low, CASE WHEN bucket < {EXACT} THEN bucket ELSE ((bucket - (bucket // {EXACT // 2} - 1) * {EXACT // 2} + 1) << (bucket // {EXACT // 2} - 1)) - 1 END AS high FROM sk),
rule AS (SELECT * FROM (VALUES {rules}) AS x(measure, two_sided, reach, slack)), {limits("own", "l, s")}, {limits("lang", "l")}, {limits("every", "")},
ok AS (SELECT k.r, bool_and(k.v BETWEEN CASE WHEN own.size >= {LEAST} THEN own.lo WHEN lang.size >= {LEAST} THEN lang.lo ELSE every.lo END AND CASE WHEN own.size >= {LEAST} THEN own.hi WHEN lang.size >= {LEAST} THEN lang.hi ELSE every.hi END) AS ok
FROM k JOIN own USING (l, s, measure) JOIN lang ON lang.l = k.l AND lang.measure = k.measure JOIN every ON every.measure = k.measure GROUP BY k.r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, coalesce(ok, false) AS kept FROM b LEFT JOIN ok ON ok.r = b.r"""
