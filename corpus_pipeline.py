"""The corpus pipeline: what the operators decide, applied to the documents one after the other.

Each stage takes the documents that its predecessor kept, as (spark, docs, sf_dir), and returns a table that is written
and read again before the next one. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.llm import bpe, decontaminate, langid, neardup, substrings
from corvane.llm.queries import table, vocabulary
from corvane.llm.store import settle


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or whose likeliest language has a probability under a half, go.

    Learns from the labelled documents but those of part 2 of 4; a missing ``lang`` is filled in, others stay.
    Where none of these has a label there is no language to tell, and nothing is kept.
    """
    model = langid.fit(docs.where(F.coalesce(langid.part(4) != 2, F.lit(True))))
    told = langid.identify(docs, model).where((F.col("lang_pred") != "und") & (F.col("score") >= 0.5))
    return told.withColumn("lang", F.coalesce("lang", "lang_pred")).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked at 0.8 of their five-word shingles the smallest id stays; rows that repeat it are one document."""
    gone = neardup.near_duplicates(docs, k=5, similarity=80).where(~F.col("kept")).select("doc_id").distinct()
    return docs.hint("merge").join(gone, "doc_id", "left_anti").select(docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words that 50-word passages of earlier documents cover go; so do documents that lose all words. ``n_chars`` follows the text."""
    cleaned = substrings.removed(docs, settle(substrings.repeats(docs, window=50)))
    cleaned = cleaned.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_words")))
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return cleaned.select(docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten consecutive words of a benchmark item (or all of a shorter item) go."""
    hit = settle(decontaminate.hits(docs, table(spark, sf_dir, "benchmark"), window=10).select(F.col("doc_id").alias("_hit_id"), F.col("_text_key").alias("_hit_text")))
    same = (F.col("doc_id") == F.col("_hit_id")) & (F.xxhash64(F.col("text").cast("string")) == F.col("_hit_text"))  # rows that repeat an id go by their own text
    return docs.hint("merge").join(hit, same, "left_anti").select(docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, lang, source, n_tokens, ids``: the tokens of each document that stayed."""
    out = bpe.encode(docs.select("doc_id", "lang", "source", "text"), vocabulary("byte_bpe_50k.json"))
    return out.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages), ("decontaminated", decontaminated), ("encoded", encoded)]

#: Language models, similarities of shingle sets and merge ranks aren't for SQL; tests check the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result of each is written to the shared folder and reread."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir))
    return docs
