"""Benchmark decontamination by winnowing, in DataFrame functions only.

Of each 6 consecutive 5-word grams the least hash is kept, in documents as in benchmark items; a shared window of 10
words has a kept gram in common on both sides, whichever words surround it. Documents that share a kept gram are
read again, each place of a shared gram is extended to the words around it, and the windows there are compared word by
word. An item shorter than the window is one window, found by the hashes of all its document grams of that length.

Hashes of grams, and the least of them, are made by doubling: of two words, of four, of five. A shared gram travels with
the few words around it, never with a whole text. Fingerprints of the benchmark and the keys of found documents are
settled tables, which Spark broadcasts only below its own threshold of bytes and joins by shuffle beyond it.

Cases: null and empty texts have no words; an item without words occurs nowhere; items that repeat an id count once;
rows that repeat a document id are rows of their own, each judged by its own text; rows with a null id are never hit.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import settle

WINDOW, GRAM = 10, 5
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BREAKS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Stands for the document itself among its grams.
ITSELF = 0
ROW = ["doc_id", "_text_key"]


def words(text: str) -> Column:
    """The words of a text as they stand, A-Z not lowered yet."""
    return F.filter(F.split(F.coalesce(F.col(text).cast("string"), F.lit("")), _BREAKS, -1), lambda w: w != "")


def lowered(word: Column) -> Column:
    """A-Z to a-z and nothing else; words of ASCII alone (as many bytes as characters) go the short way."""
    return F.when(F.octet_length(word) == F.char_length(word), F.lower(word)).otherwise(F.translate(word, _UPPER, _UPPER.lower()))


def _rolled(df: DataFrame, name: str, of: str, width: int, f: Callable[[Column, Column], Column]) -> DataFrame:
    """``df`` with ``name``: ``f`` over each ``width`` consecutive entries of ``of``, by doubling; ``f`` takes overlaps."""
    df, k = df.withColumn(name, F.col(of)), 1
    while k < width:
        step = min(k, width - k)
        n = F.greatest(F.size(name) - step, F.lit(0))
        df, k = df.withColumn(name, F.zip_with(F.slice(name, F.lit(1), n), F.slice(name, F.lit(1 + step), n), f)), k + step
    return df


def _grams(df: DataFrame, name: str, k: int) -> DataFrame:
    """Hashes of the ``k`` consecutive words at each place, from the words' hashes ``h``."""
    return _rolled(df, name, "h", k, lambda a, b: F.xxhash64(a, b))


def _winnowed(df: DataFrame, window: int, gram: int) -> DataFrame:
    """``g``, the grams, and ``kept``, the least of each ``window - gram + 1`` consecutive ones, each once."""
    df = _rolled(_grams(df, "g", gram), "kept", "g", window - gram + 1, lambda a, b: F.least(a, b))
    return df.withColumn("kept", F.array_distinct("kept"))


def _around(own: str, place: Column, k: int, lead: int) -> Column:
    """``before, words``: the gram at ``place`` (from 1) with up to ``lead`` words on both sides, and how many stand before it."""
    before = F.least(place - 1, F.lit(lead))
    return F.struct(before.alias("before"), F.slice(own, place - before, before + k + lead).alias("words"))


def benchmark_grams(benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``k, gram, item_id, item`` (see ``_around``): the kept grams of each item; items shorter than the window are one gram."""
    items = benchmark.select("item_id", F.transform(words("text"), lowered).alias("own")).where("size(own) > 0").withColumn("h", F.transform("own", lambda w: F.xxhash64(w)))
    long = _winnowed(items.where(F.size("own") >= window), window, gram)
    long = long.select("item_id", "own", "kept", F.posexplode("g").alias("at", "gram")).where(F.array_contains("kept", F.col("gram")))
    out = long.select(F.lit(gram).alias("k"), "gram", "item_id", _around("own", F.col("at") + 1, gram, window - gram).alias("item"))
    short = items.where(F.size("own") < window)
    for k in range(1, window):
        some = _grams(short.where(F.size("own") == k), "g", k)
        out = out.unionByName(some.select(F.lit(k).alias("k"), F.get("g", F.lit(0)).alias("gram"), "item_id", _around("own", F.lit(1), k, 0).alias("item")))
    return out


def scan(docs: DataFrame, bench: DataFrame, window: int, gram: int, short: list[int]) -> DataFrame:
    """``doc_id, _text_key, n_words, itself, gram``: one row ``itself`` for each row of ``docs``, and one for each kept
    gram that the benchmark has too. One pass over the texts."""
    rows = docs.select("doc_id", F.xxhash64(F.col("text").cast("string")).alias("_text_key"), words("text").alias("own"))
    rows = _winnowed(rows.withColumn("h", F.transform("own", lambda w: F.xxhash64(lowered(w)))), window, gram)
    for k in short:
        rows = _grams(rows, f"g{k}", k)
    grams = F.concat(F.array(F.lit(ITSELF).cast("long")), F.when(F.col("doc_id").isNotNull(), F.concat("kept", *(F.array_distinct(f"g{k}") for k in short))).otherwise(F.array().cast("array<bigint>")))
    keys = settle(bench.select("gram").union(bench.sparkSession.range(1).select(F.lit(ITSELF).cast("long"))).distinct())
    each = rows.select(*ROW, F.size("own").cast("long").alias("n_words"), F.posexplode(grams).alias("at", "gram"))
    return settle(each.join(keys, "gram", "left_semi").select(*ROW, "n_words", (F.col("at") == 0).alias("itself"), "gram"))


def extended(docs: DataFrame, scanned: DataFrame, bench: DataFrame, window: int, gram: int, short: list[int]) -> DataFrame:
    """``doc_id, _text_key, windows, items``: of each row that has a benchmark window, where (``start``, word places from 1,
    and ``size``), and of which items."""
    found = settle(scanned.where("not itself").select(ROW).distinct())
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).where("doc_id is not null").withColumn("_text_key", F.xxhash64("text"))
    again = texts.join(found, ROW).select(*ROW, F.transform(words("text"), lowered).alias("own")).withColumn("h", F.transform("own", lambda w: F.xxhash64(w)))
    again, out = settle(again), None
    for k in sorted({gram, *short}):
        of, lead = bench.where(F.col("k") == k), window - gram if k == gram else 0
        places = _grams(again, "g", k).select(*ROW, F.posexplode("g").alias("at", "gram")).join(of.select("gram").distinct(), "gram", "left_semi")
        places = places.groupBy(ROW).agg(F.collect_set(F.struct("at", "gram")).alias("places"))
        each = again.select(*ROW, "own").join(places, ROW)
        each = each.select(*ROW, F.explode(F.transform("places", lambda x: F.struct((x["at"] + 1).alias("p"), x["gram"].alias("gram"), _around("own", x["at"] + 1, k, lead).alias("doc")))).alias("x")).select(*ROW, "x.*")
        met = each.join(of, "gram")
        size = F.least(F.size("item.words"), F.lit(window))
        back = F.least("doc.before", "item.before")  # how far a window can begin before the gram
        same = lambda j: (
            (F.size(F.slice("item.words", F.col("item.before") + 1 - j, size)) == size) & (F.slice("doc.words", F.col("doc.before") + 1 - j, size) == F.slice("item.words", F.col("item.before") + 1 - j, size))
        )
        starts = F.transform(F.filter(F.sequence(F.lit(0), back), same), lambda j: F.struct((F.col("p") - j).alias("start"), size.alias("size")))
        met = met.select(*ROW, "item_id", F.explode(starts).alias("w"))
        out = met if out is None else out.unionByName(met)
    return out.distinct().groupBy(ROW).agg(F.collect_set("w").alias("windows"), F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"))


def prepared(docs: DataFrame, benchmark: DataFrame, window: int, gram: int) -> tuple[DataFrame, DataFrame]:
    """What ``scan`` finds, settled, and the windows, by row."""
    bench = settle(benchmark_grams(benchmark, window, gram).distinct())
    short = sorted(r.k for r in bench.where(F.size("item.words") < window).select("k").distinct().collect())  # below the window
    scanned = scan(docs, bench, window, gram, short)
    return scanned, extended(docs, scanned, bench, window, gram, short)


def hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``doc_id, _text_key, windows, items`` of each row of ``docs`` that has a benchmark window; ``_text_key`` is the
    ``xxhash64`` of its text."""
    return prepared(docs, benchmark, window, gram)[1]


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` for each row of ``docs``."""
    scanned, found = prepared(docs, benchmark, window, gram)
    covered = F.size(F.array_distinct(F.flatten(F.transform("windows", lambda w: F.sequence(w["start"], w["start"] + w["size"] - 1)))))
    found = settle(found.select(*ROW, covered.cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256")))
    out = scanned.where("itself").select(*ROW, "n_words").join(found, ROW, "left")
    n = F.coalesce("n_hit", F.lit(0)).cast("long")
    return out.select("doc_id", "n_words", n.alias("n_hit"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"), F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"), (n > 0).alias("contaminated"))
