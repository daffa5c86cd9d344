"""Checks of inputs and outputs: which days are there, whether values are in range, and whether a run met its marks."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.stats import label

# What a run is measured by: the metric, how it is compared, and its mark.
MARKS = [("success_rate", ">=", 80.0), ("total_articles", ">=", 500.0), ("dedup_effectiveness", ">=", 90.0), ("avg_crawl_time", "<=", 300.0), ("peak_memory", "<=", 10.0)]
EXPECTED_SITES = 44


def availability(files: DataFrame, end: datetime.date, days: int, needed: list[str], essential: list[str]) -> DataFrame:
    """``day, n_files, status`` for each of the ``days`` days up to ``end``: ``available`` with all essential files and all but one of the
    needed ones, ``incomplete`` with any, else ``missing``. ``files``: ``day, file, size`` (a catalogue; empty files do not count)."""
    spark = files.sparkSession
    calendar = spark.range(days).select(F.date_sub(F.lit(end), F.col("id").cast("int")).alias("day"))
    have = files.where(F.col("file").isin(needed) & (F.col("size") > 0)).groupBy("day").agg(F.countDistinct("file").alias("n_files"), F.countDistinct(F.when(F.col("file").isin(essential), F.col("file"))).alias("n_essential"))
    each = calendar.join(have, "day", "left").na.fill(0, ["n_files", "n_essential"])
    status = F.when((F.col("n_essential") == len(essential)) & (F.col("n_files") >= len(needed) - 1), "available").when(F.col("n_files") > 0, "incomplete").otherwise("missing")
    return each.select("day", "n_files", status.alias("status"))


def assemble(spark: SparkSession, path: str, available: DataFrame, least: float = 0.45) -> DataFrame:
    """The rows of a table partitioned by ``crawl_date`` on the available days; raises if they are too small a share of the window."""
    rows = available.collect()  # one row a day
    good = [r.day for r in rows if r.status == "available"]
    if not rows or len(good) < least * len(rows):
        raise ValueError(f"{len(good)} of {len(rows)} days are available, {least:.0%} are needed")
    return spark.read.option("mergeSchema", "true").parquet(path).where(F.col("crawl_date").isin(good))


def catalogue(spark: SparkSession, path: str, name: str) -> DataFrame:
    """``day, file, size`` of a partitioned table's files, as ``availability`` wants them; reads no rows."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path).select("path", "length")
    day = F.to_date(F.nullif(F.regexp_extract("path", r"crawl_date=(\d{4}-\d{2}-\d{2})", 1), F.lit("")))
    return found.select(day.alias("day"), F.lit(name).alias("file"), F.col("length").alias("size")).where("day is not null")


def out_of_range(df: DataFrame, ranges: dict[str, tuple[float | None, float | None]], allowed: dict[str, list[str]] | None = None, needed: list[str] = ()) -> DataFrame:
    """``check, column, bad``: how many rows have a value outside its range (an end may be open), a value that is not allowed, or none
    where one is needed. One pass; a row for each check."""
    rules: list[tuple[str, str, Column]] = []
    for c, (lo, hi) in ranges.items():
        low, high = F.lit(False) if lo is None else F.col(c) < lo, F.lit(False) if hi is None else F.col(c) > hi
        rules.append(("range", c, low | high | F.isnan(F.col(c).cast("double"))))
    rules += [("allowed", c, ~F.col(c).isin(values) | F.col(c).isNull()) for c, values in (allowed or {}).items()]
    rules += [("needed", c, F.col(c).isNull()) for c in needed]
    one = df.agg(*(F.sum(F.coalesce(bad, F.lit(False)).cast("long")).alias(f"_{i}") for i, (_, _, bad) in enumerate(rules)))
    return one.select(F.explode(F.array(*(F.struct(F.lit(kind).alias("check"), F.lit(c).alias("column"), F.coalesce(F.col(f"_{i}"), F.lit(0)).cast("long").alias("bad")) for i, (kind, c, _) in enumerate(rules)))).alias("x")).select("x.*")


def analysis_report(articles: DataFrame, emotions: list[str], codes: list[str]) -> DataFrame:
    """``check, column, bad`` of the analysed articles: scores in range, known codes, ids, too neutral a mood, and codes that no
    article has (of more than 50)."""
    ranges = {"sentiment_score": (-1.0, 1.0), "importance_score": (0.0, 100.0)} | {f"emotion_{e}": (0.0, 1.0) for e in emotions}
    out = out_of_range(articles, ranges, {"steeps_category": codes}, ["article_id"])
    neutral = (label(F.col("sentiment_score")) == "neutral").cast("double")
    more = articles.agg(F.count("*").alias("n"), F.avg(neutral).alias("neutral"), F.collect_set("steeps_category").alias("have"))  # as many as there are codes
    missing = F.size(F.array_except(F.array(*map(F.lit, codes)), "have")).cast("long")
    both = F.array(
        F.struct(F.lit("distribution").alias("check"), F.lit("sentiment_score").alias("column"), F.when((F.col("n") > 10) & (F.col("neutral") > 0.95), 1).otherwise(0).cast("long").alias("bad")),
        F.struct(F.lit("coverage").alias("check"), F.lit("steeps_category").alias("column"), F.when(F.col("n") > 50, missing).otherwise(0).cast("long").alias("bad")),
    )
    return out.unionByName(more.select(F.explode(both).alias("x")).select("x.*"))


# What an enriched article needs, what its codes may be, and the columns whose commonest values are told.
ENRICHED_NEEDED = ["evidence_id", "url", "source_id", "title", "language", "body_quality", "source_tier", "geo_focus_primary", "steeps_primary", "sentiment_label", "signal_type"]
ENRICHED_ALLOWED = {
    "EN4": ("body_quality", ["FULL", "PARTIAL", "TITLE_ONLY", "PAYWALL"]),
    "EN5": ("steeps_primary", ["SOC", "TEC", "ECO", "ENV", "POL", "SEC", "SPI", "CRS"]),
    "EN6": ("signal_type", ["BREAKING", "TREND", "WEAK_SIGNAL", "NOISE", "UNCLASSIFIED"]),
}
ENRICHED_TOLD = ["steeps_primary", "signal_type", "source_tier", "body_quality", "geo_focus_primary", "sentiment_label"]


def enriched_report(enriched: DataFrame | None) -> DataFrame:
    """``rule, column, value, level, passed`` of the enriched articles (none: no such table, which only EN1 tells). One pass.

    EN1 there is a table, EN2 it has rows, EN3 no nulls in what is needed (``value`` is null for a column that is not there),
    EN4 to EN6 rows with a code that is not known (or none), EN7 at most 70 % of unknown places, EN8 at most 50 % without a sentiment. The
    last two warn. Of an empty table only the first two are told; EN4 to EN8 need their column.
    """
    schema = "rule string, column string, value double, level string, passed boolean"
    if enriched is None:
        return SparkSession.active().createDataFrame([("EN1", None, 0.0, "error", False)], schema)
    have, null = set(enriched.columns), F.lit(None).cast("double")
    count = lambda bad: F.coalesce(F.sum(F.coalesce(bad, F.lit(True)).cast("double")), F.lit(0.0))
    rules: list[tuple[str, str | None, Column, str, float]] = [("EN1", None, F.lit(0.0), "error", 0.0), ("EN2", None, (F.count("*") == 0).cast("double"), "error", 0.0)]
    rules += [("EN3", c, count(F.col(c).isNull()) if c in have else null, "error", 0.0) for c in ENRICHED_NEEDED]
    rules += [(rule, c, count(~F.col(c).isin(allowed)), "error", 0.0) for rule, (c, allowed) in ENRICHED_ALLOWED.items() if c in have]
    if "geo_focus_primary" in have:
        rules.append(("EN7", "geo_focus_primary", F.avg(F.coalesce(F.col("geo_focus_primary") == "UNKNOWN", F.lit(False)).cast("double")), "warning", 0.70))
    if "sentiment_score" in have:
        rules.append(("EN8", "sentiment_score", F.avg(F.col("sentiment_score").isNull().cast("double")), "warning", 0.50))
    one = enriched.agg(F.count("*").alias("_n"), *(value.alias(f"_{i}") for i, (_, _, value, _, _) in enumerate(rules)))
    rows = [
        F.struct(F.lit(rule).alias("rule"), F.lit(c).cast("string").alias("column"), F.col(f"_{i}").alias("value"), F.lit(level).alias("level"), F.coalesce(F.col(f"_{i}") <= most, F.lit(False)).alias("passed"))
        for i, (rule, c, _, level, most) in enumerate(rules)
    ]
    return one.select("_n", F.explode(F.array(*rows)).alias("x")).where("_n > 0 or x.rule in ('EN1', 'EN2')").select("x.*")


def commonest(df: DataFrame, columns: list[str], top: int = 8) -> DataFrame:
    """``column, value, n``: the ``top`` values of each column that is there (nulls and empty texts do not count, ties by value). One pass."""
    pairs = F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns if c in df.columns))
    n = df.select(F.explode(pairs).alias("x")).select("x.*").where("value <> ''").groupBy("column", "value").agg(F.count("*").alias("n"))
    place = F.row_number().over(Window.partitionBy("column").orderBy(F.desc("n"), "value"))  # a row a value
    return n.withColumn("place", place).where(F.col("place") <= top).drop("place")


def success(sites: DataFrame, expected: int = EXPECTED_SITES) -> DataFrame:
    """``metric, value, mark, passed`` of a crawl, from ``site, before, after, seconds, memory`` (articles before and after
    deduplication); a metric without data has no value and does not pass."""
    n = F.greatest(F.count("*"), F.lit(expected))
    got = F.sum((F.col("after") > 0).cast("int"))
    before, after = F.sum("before"), F.sum("after")
    one = sites.agg(
        F.round(got / n * 100, 2).alias("success_rate"), F.coalesce(after, F.lit(0)).cast("double").alias("total_articles"), F.round(F.when((before > 0) & (before >= after), (before - after) / before * 100), 2).alias("dedup_effectiveness"),
        F.round(F.avg(F.when(F.col("seconds") > 0, F.col("seconds"))), 2).alias("avg_crawl_time"), F.round(F.max("memory"), 3).alias("peak_memory"),
    )
    passed = {">=": lambda v, m: v >= m, "<=": lambda v, m: v <= m}
    rows = [F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"), F.lit(mark).alias("mark"), F.coalesce(passed[how](F.col(m), F.lit(mark)), F.lit(False)).alias("passed")) for m, how, mark in MARKS]
    return one.select(F.explode(F.array(*rows)).alias("x")).select("x.*")


def converged(new: int, total: int, share: float = 0.02, least: int = 5) -> bool:
    """Whether another pass is not worth it: it brought less than 2 % of all rows, or less than 5."""
    return new < max(share * total, least)
