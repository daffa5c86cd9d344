"""Queries of operators that learn from whole tables: density clusters, outliers, causal links, factors, names and key phrases.

SQL can express none of them but the signals index and the drift of vectors; ``tests/test_density.py``, ``tests/test_models.py``, ``tests/test_ward.py``, ``tests/test_topicfeatures.py`` and ``tests/test_learned.py`` hold them against brute force.
"""

import uuid

from pyspark.sql import functions as F

from ..operators import causal, density, entities, factors, features, grouped, models, narrative, phrases, signals, topicfeatures, ward
from ..operators import series as S
from ..sources import tables
from .registry import query
from .standins import CODES, articles, sql, table


@query("a32_density")
def density_clusters(spark, sf):
    return density.density_clusters(table(spark, sf, "embeddings"))


@query("a35_ward")
def ward_clusters(spark, sf):
    return ward.ward_clusters(table(spark, sf, "embeddings"))


def _outliers(spark, sf):
    return density.outliers(table(spark, sf, "embeddings"))


@query("a37_outliers")
def outliers(spark, sf):
    return _outliers(spark, sf)


@query("a37_topic_outliers")
def topic_outliers(spark, sf):
    """The table's label stands for a topic."""
    return density.topic_outliers(_outliers(spark, sf), table(spark, sf, "embeddings").withColumnRenamed("label", "topic_id"))


@query("a11_pcmci")
def pcmci(spark, sf):
    volume = S.daily(articles(spark, sf)).where("metric = 'volume' and series <> 'all'").select("series", "day", "value")
    return causal.pcmci(volume)


@query("s5_forecast")
def forecast(spark, sf):
    """The 20 largest topics and the aggregate, the days of the series and seven more."""
    volume = S.largest(S.daily(articles(spark, sf)), 20).where("metric = 'volume'").select("series", "day", "value")
    return models.forecast(volume).select("series", "day", *(F.round(c, 6).alias(c) for c in ("forecast", "lower", "upper")), "future")


@query("a6_series_models")
def series_models(spark, sf):
    """Of every measure's daily series."""
    return models.metrics(S.daily(articles(spark, sf)).select(F.concat_ws(":", "series", "metric").alias("series"), "day", "value"))


def _weights(spark, sf):
    return features.tfidf(table(spark, sf, "documents"), longest=2, by=F.coalesce("lang", F.lit("")))


@query("a33_nmf")
def nmf(spark, sf):
    """Documents without a term that others have too have no topic."""
    told = factors.factorised(_weights(spark, sf))
    return table(spark, sf, "documents").select("doc_id").join(told, "doc_id", "left").select("doc_id", F.coalesce("topic_id", F.lit(-1)).alias("topic_id"), F.coalesce("weight", F.lit(0.0)).alias("weight"))


@query("a27_names")
def names(spark, sf):
    """Names are the capitalised sequences of the benchmark's items, by how many words they have."""
    found = table(spark, sf, "benchmark").select(F.explode(F.regexp_extract_all("text", F.lit(r"\p{Lu}\p{L}+( \p{Lu}\p{L}+)*"), F.lit(0))).alias("name")).where("length(name) > 3").distinct()
    dimension = found.withColumn("kind", F.concat(F.size(F.split("name", " ")).cast("string"), F.lit("-word")))
    return phrases.names_in(table(spark, sf, "documents"), dimension).groupBy("doc_id", "name", "kind").agg(F.count("*").alias("n"), F.min("start").alias("first"))


@query("a28_key_phrases")
def key_phrases(spark, sf):
    return phrases.key_phrases(_weights(spark, sf))


def _signals(spark, sf):
    """A signal for each topic, kind and day."""
    a = articles(spark, sf).groupBy(F.col("signal_type").alias("signal_layer"), "topic_id", "day")
    return a.agg(F.max("novelty_score").alias("confidence"), F.collect_set("article_id").alias("article_ids"))


@query("s30_signals_index", sql("""s AS (SELECT signal_type, topic_id, day, max(novelty_score) AS confidence, count(DISTINCT article_id) AS article_count FROM articles GROUP BY ALL)
SELECT sha256(signal_type || '|' || CAST(topic_id AS VARCHAR) || '|' || CAST(day AS VARCHAR)) AS signal_id, signal_type AS signal_layer, topic_id, day, round(confidence, 6) AS confidence, article_count FROM s"""))
def signals_index(spark, sf):
    """The index after a first run that knew half of the confidence, and a second one over the later days and the same signals."""
    rows = tables.settle(signals.index_rows(_signals(spark, sf)))
    path = f"{tables.folder(spark)}/index-{uuid.uuid4().hex}"
    tables.upsert(rows.withColumn("confidence", F.col("confidence") / 2).withColumn("article_count", F.lit(0).cast("long")), path, ["signal_id"], "day")
    tables.upsert(rows, path, ["signal_id"], "day")
    return spark.read.schema(rows.schema).parquet(path).withColumn("confidence", F.round("confidence", 6))


def _vectors(spark, sf):
    """An article's vector is the one with its id."""
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("article_id"), "embedding")


@query("a39_drift", sql("""v AS (SELECT topic_id, embedding, row_number() OVER (PARTITION BY topic_id ORDER BY day, article_id) - 1 AS k, count(*) OVER (PARTITION BY topic_id) // 2 AS middle, count(*) OVER (PARTITION BY topic_id) AS n
  FROM articles JOIN embeddings ON vec_id = article_id WHERE topic_id >= 0 AND embedding IS NOT NULL),
e AS (SELECT topic_id, n, k >= middle AS late, unnest(range(len(embedding))) AS i, CAST(unnest(embedding) AS DOUBLE) AS x FROM v),
m AS (SELECT topic_id, n, i, avg(x) FILTER (NOT late) AS a, avg(x) FILTER (late) AS b FROM e GROUP BY ALL)
SELECT topic_id, round(CASE WHEN n >= 4 AND sqrt(sum(a * a)) > 1e-10 AND sqrt(sum(b * b)) > 1e-10 THEN 1 - sum(a * b) / (sqrt(sum(a * a)) * sqrt(sum(b * b))) ELSE 0 END, 6) AS embedding_drift FROM m GROUP BY topic_id, n"""))
def drift(spark, sf):
    return topicfeatures.drift(articles(spark, sf), _vectors(spark, sf)).withColumn("embedding_drift", F.round("embedding_drift", 6))


@query("a39_topic_features")
def topic_features(spark, sf):
    """All features of every topic, with the layer of those that make a signal."""
    a = tables.settle(articles(spark, sf))
    scores = _outliers(spark, sf).select(F.col("vec_id").alias("article_id"), "ood_score")
    edges = entities.cooccurrence(a, ["entities_person", "entities_org"])
    shifts = grouped.shift_points(narrative.frame_shift(narrative.frame_shares(a, CODES), CODES))
    told = tables.settle(topicfeatures.topic_features(a, _vectors(spark, sf), scores, edges, shifts))
    return told.join(signals.best(signals.classify(told)), "topic_id", "left")
