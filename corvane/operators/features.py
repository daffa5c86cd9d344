"""Text features and clusters: TF-IDF, source frames, hashed embeddings, lexicon sentiment, MLlib clusters, outliers, evidence chains."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import stats
from ..sources.tables import numbered, settle
from . import lda, termweights

# A small lexicon of our own, the fallback where no sentiment model is given.
POSITIVE = ["boom", "growth", "recovery", "gain", "success", "peace", "agreement", "win", "rise", "hope"]
NEGATIVE = ["crisis", "crash", "war", "loss", "fear", "collapse", "attack", "decline", "uncertainty", "inflation"]


def provide(docs: DataFrame, column: str, kind: str, model: Callable | None, fallback: Column, text: str = "text") -> DataFrame:
    """``docs`` with a model's output: ``model`` maps an iterator of pandas series of texts to series; without it ``fallback``."""
    return docs.withColumn(column, F.pandas_udf(model, kind)(F.col(text)) if model else fallback.cast(kind))


def lexicon_sentiment(text: Column) -> Column:
    """(positive - negative) over both, 0 without either."""
    hits = lambda words: F.regexp_count(F.lower(text), F.lit(r"\b(" + "|".join(words) + r")\b"))
    p, n = hits(POSITIVE), hits(NEGATIVE)
    return F.when(p + n > 0, (p - n) / (p + n)).otherwise(0.0)


def hashed_embedding(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 64) -> DataFrame:
    """``KEY, embedding``: a deterministic stand-in for a sentence encoder: signed word hashes summed, of unit length; zeros without words.

    One pass over a text's words: each makes its place and sign as one number, sorted; a place's value is the sum of its run.
    """
    words = F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    rows = docs.select(key, F.transform(words, lambda w: 2 * F.pmod(F.xxhash64(w), F.lit(size)) + F.pmod(F.hash(w), F.lit(2))).alias("_w"))
    rows = rows.withColumn("_w", F.concat("_w", F.sequence(F.lit(0).cast("long"), F.lit(2 * size - 1).cast("long"))))  # each number once more, so that all are there
    # sorted, numbers end where the next is larger: places of the ends, apart by how many there are of each
    rows = rows.withColumn("_w", F.sort_array("_w")).withColumn("_n", F.concat(F.slice("_w", F.lit(2), F.size("_w")), F.array(F.lit(2 * size).cast("long"))))
    ends = F.filter(F.zip_with(F.zip_with("_w", "_n", lambda a, b: a < b), F.sequence(F.lit(1), F.size("_w")), lambda last, i: F.when(last, i)), lambda i: i.isNotNull())
    rows = rows.select(key, F.concat(F.array(F.lit(0)), ends).alias("_e"))
    n = lambda i: F.get("_e", i + 1) - F.get("_e", i) - 1
    raw = F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: (n(2 * i) - n(2 * i + 1)).cast("double"))
    rows = rows.select(key, raw.alias("_v")).withColumn("_norm", F.sqrt(F.aggregate("_v", F.lit(0.0), lambda s, x: s + x * x)))
    return rows.select(key, F.when(F.col("_norm") > 0, F.transform("_v", lambda x: x / F.col("_norm"))).otherwise(F.col("_v")).alias("embedding"))


def terms(text: Column, longest: int = 1) -> Column:
    """Words of two characters or more in lower case, and with ``longest`` = 2 also pairs of words next to each other."""
    words = F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]{2,}"), 0)
    if longest == 1:
        return words
    n = F.greatest(F.size(words) - 1, F.lit(0))
    return F.concat(words, F.zip_with(F.slice(words, F.lit(1), n), F.slice(words, F.lit(2), n), lambda a, b: F.concat_ws(" ", a, b)))


def tfidf(docs: DataFrame, key: str = "doc_id", text: str = "text", top: int = 20, least: int = 2, most: float = 0.95, longest: int = 1, by: Column | None = None, vocabulary: int | None = None) -> DataFrame:
    """``KEY, term, weight, rank``: sublinear tf times smoothed idf, unit length, the ``top`` terms of each document.

    Terms of fewer than ``least`` documents or over a share of ``most`` are left out. ``longest`` = 2 takes pairs of words too; ``by`` gives
    documents vocabularies of their own, with counts of documents and limits within each (documents without one have no terms);
    ``vocabulary`` keeps that many terms of each, the most frequent ones. Without it no term is a row before the leading ones.
    """
    docs = docs.select(key, F.col(text).alias("_text"), (by if by is not None else F.lit("all")).alias("_by"))
    n = docs.groupBy("_by").agg(F.count("*").alias("n"))  # a row for each vocabulary
    if not vocabulary:
        whole = docs.join(F.broadcast(n), "_by").select(F.col(key).alias("k"), F.col("_by").cast("string").alias("by"), "n", F.col("_text").alias("text"))
        return termweights.weights(whole, terms, longest, least, most, top).withColumnRenamed("k", key)
    tf = docs.select(key, "_by", F.explode(terms(F.col("_text"), longest)).alias("term")).groupBy(key, "_by", "term").agg(F.count("*").alias("tf"))
    df = tf.groupBy("_by", "term").agg(F.count("*").alias("df"), F.sum("tf").alias("all")).join(F.broadcast(n), "_by").where((F.col("df") >= least) & (F.col("df") <= most * F.col("n")))
    df = numbered(df.withColumn("_all", -F.col("all")), "_by", ["_all", "term"], "_k").where(F.col("_k") <= vocabulary)
    idf = df.select("_by", "term", (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1).alias("idf"))
    w = tf.join(idf, ["_by", "term"]).select(key, "term", ((1 + F.log("tf")) * F.col("idf")).alias("w"))
    each = Window.partitionBy(key)
    w = w.withColumn("weight", F.col("w") / F.sqrt(F.sum(F.col("w") ** 2).over(each))).withColumn("rank", F.row_number().over(each.orderBy(F.desc(F.round("weight", 9)), "term")))
    return w.where(F.col("rank") <= top).select(key, "term", "weight", "rank")


def sparse(weights: DataFrame, key: str = "doc_id") -> DataFrame:
    """``KEY, size, entries`` (``array<struct<index, weight>>`` by index): sparse vectors from the top terms of each document; a term's
    index is its place in the sorted vocabulary of all of them. Ranges of the vocabulary are numbered apart, so that no task sorts it whole."""
    weights = settle(weights)  # read twice
    vocabulary = weights.select("term").distinct().repartitionByRange("term").sortWithinPartitions("term").select("term", F.spark_partition_id().alias("part"))
    ranked = settle(vocabulary.withColumn("at", F.row_number().over(Window.partitionBy("part").orderBy("term"))))
    counts = ranked.groupBy("part").agg(F.count("*").alias("c"))  # one row a range
    before = counts.withColumn("before", F.coalesce(F.sum("c").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    index = ranked.join(F.broadcast(before), "part").select("term", (F.col("before") + F.col("at") - 1).alias("index"))
    total = index.agg(F.count("*").alias("size"))
    out = weights.join(index, "term").groupBy(key).agg(F.sort_array(F.collect_list(F.struct("index", "weight"))).alias("entries"))  # at most the top terms
    return out.crossJoin(F.broadcast(total)).select(key, "size", "entries")  # one row


def topics_over_time(docs: DataFrame, top: int = 10, topic: str = "topic_id", day: str = "day", text: str = "text") -> DataFrame:
    """``TOPIC, DAY, n, term, weight, rank``: class-based TF-IDF of each topic's texts by day: a term's share of the topic's words that day
    times the log of 1 + mean words of a topic and day over the term's frequency in all; the ``top`` terms, and how many documents."""
    n = docs.groupBy(topic, day).agg(F.count("*").alias("n"))
    tf = docs.select(topic, day, F.explode(terms(F.col(text))).alias("term")).groupBy(topic, day, "term").agg(F.count("*").alias("tf"))
    size = tf.groupBy(topic, day).agg(F.sum("tf").alias("size"))
    mean = size.agg(F.avg("size").alias("mean"))
    all_of = tf.groupBy("term").agg(F.sum("tf").alias("f"))
    w = tf.join(all_of, "term").join(size, [topic, day]).crossJoin(F.broadcast(mean))  # one row
    w = w.select(topic, day, "term", (F.col("tf") / F.col("size") * F.log(1 + F.col("mean") / F.col("f"))).alias("weight"))
    w = w.withColumn("rank", F.row_number().over(Window.partitionBy(topic, day).orderBy(F.desc(F.round("weight", 9)), "term"))).where(F.col("rank") <= top)
    return w.join(n, [topic, day]).select(topic, day, "n", "term", "weight", "rank")


def cooccurring(items: DataFrame, key: str = "article_id", labels: str = "labels", least: float = 0.001) -> DataFrame:
    """``a, b, shared, jaccard``: labels that have articles in common, by the Jaccard of their article sets. Pairs are made inside each
    article's row, so a label of any size is an aggregate and never a list."""
    each = F.sort_array(F.array_distinct(F.filter(F.col(labels), lambda x: x.isNotNull())))
    rows = items.select(each.alias("l"))
    n = rows.select(F.explode("l").alias("x")).groupBy("x").agg(F.count("*").alias("n"))
    pairs = rows.select(F.explode(F.flatten(F.transform("l", lambda x: F.transform(F.filter("l", lambda y: y > x), lambda y: F.struct(x.alias("a"), y.alias("b")))))).alias("p")).groupBy("p.a", "p.b").agg(F.count("*").alias("shared"))
    out = pairs.join(n.toDF("a", "na"), "a").join(n.toDF("b", "nb"), "b")
    return out.select("a", "b", "shared", (F.col("shared") / (F.col("na") + F.col("nb") - F.col("shared"))).alias("jaccard")).where(F.col("jaccard") >= least)


def frame_divergence(counts: DataFrame, smooth: float = 1e-10) -> DataFrame:
    """Symmetric divergence of sources' term shares (``source, term, n``) and its strength: ``a, b, kl, strength``."""
    p = settle(counts.withColumn("p", F.col("n") / F.sum("n").over(Window.partitionBy("source"))).select("source", "term", "p"))
    # a term that neither has adds nothing; one that a single source has adds the same beside any other source
    alone = lambda p: p * F.log((p + smooth) / smooth)
    each = settle(p.groupBy("source").agg(F.sum(alone(F.col("p"))).alias("alone")))
    x, y = F.col("x.p"), F.col("y.p")
    both = p.alias("x").join(p.alias("y"), (F.col("x.term") == F.col("y.term")) & (F.col("x.source") < F.col("y.source")))
    both = both.groupBy(F.col("x.source").alias("a"), F.col("y.source").alias("b")).agg(F.sum((x - y) * F.log((x + smooth) / (y + smooth)) - alone(x) - alone(y)).alias("shared"))
    left, right = each.toDF("a", "of_a"), each.toDF("b", "of_b")
    kl = left.join(right, F.col("a") < F.col("b")).join(both, ["a", "b"], "left")  # sources, no terms
    kl = kl.select("a", "b", ((F.col("of_a") + F.col("of_b") + F.coalesce("shared", F.lit(0.0))) / 2).alias("kl"))
    return kl.withColumn("strength", F.log1p("kl") / F.log1p(F.lit(25.0)))


def cross_lingual(centroids: DataFrame, cut: float = 0.7, fallback: float = 0.5) -> DataFrame:
    """Pairs of topic centroids of different languages (``language, topic_id, c``) at ``cut``; at ``fallback`` if there are none."""
    x = centroids.alias("x").join(centroids.alias("y"), F.col("x.language") < F.col("y.language"))
    s = x.select(F.col("x.language").alias("a"), F.col("x.topic_id").alias("ta"), F.col("y.language").alias("b"), F.col("y.topic_id").alias("tb"), stats.cosine(F.col("x.c"), F.col("y.c")).alias("cosine"))
    best = s.agg(F.max("cosine").alias("most"))
    return s.crossJoin(F.broadcast(best)).where(F.col("cosine") >= F.when(F.col("most") >= cut, cut).otherwise(fallback)).drop("most")  # one row


def evidence_chains(articles: DataFrame, least: int = 3, top: int = 5) -> DataFrame:
    """Per topic: entities with ``least`` articles, the leading ones joined, articles and strength."""
    n = articles.where("topic_id >= 0").select("topic_id", "article_id", F.explode(F.array_distinct(F.concat("entities_person", "entities_org"))).alias("e")).groupBy("topic_id", "e").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    n = n.withColumn("k", F.row_number().over(Window.partitionBy("topic_id").orderBy(F.desc("n"), "e"))).where(F.col("k") <= top)
    out = n.groupBy("topic_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "e"))), lambda x: x["e"]), "|").alias("entities"), F.sum("n").alias("n"))
    return out.withColumn("strength", F.least(F.lit(1.0), F.log1p("n") / F.log1p(F.lit(50.0))))


def _near_pairs(rows: DataFrame, by: str, order: str, reach: int) -> tuple[DataFrame, DataFrame, Column]:
    """Two sides ``x``, ``y`` of a group's rows and the condition that they are less than ``reach`` apart in order, joined by buckets."""
    r = settle(numbered(rows, by, [order]))
    x = r.withColumn("bucket", F.floor(F.col("k") / reach))
    y = r.withColumn("bucket", F.explode(F.array(F.floor(F.col("k") / reach), F.floor(F.col("k") / reach) - 1)))
    near = (F.col(f"x.{by}") == F.col(f"y.{by}")) & (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.k") < F.col("y.k")) & (F.col("y.k") < F.col("x.k") + reach)
    return x.alias("x"), y.alias("y"), near


#: Rows of a topic whose pairs are made in one task.
RUN = 5000


def alike_but_opposed(rows: DataFrame, entails: Callable | None = None, reach: int = 20, least: float = 0.6) -> DataFrame:
    """``topic_id, a, b, similarity, score``: pairs of a topic's articles, within ``reach`` in order, of different sources and with vectors at
    a cosine of ``least``, that contradict each other.

    ``rows``: ``topic_id, article_id, source, text, embedding``. With a model (``entails`` maps two series of texts to a series of
    probabilities of contradiction) pairs at ``least`` count and have its score; without one every such pair has half its similarity.
    """
    r = settle(numbered(rows.where("topic_id >= 0").select("topic_id", "article_id", "source", "text", F.col("embedding").cast("array<double>").alias("embedding")), "topic_id", ["article_id"]))
    own = F.floor(F.col("k") / RUN)
    # a run of a topic's rows in order, and the first ones of the next run, which are met from it
    dealt = r.select("*", F.explode(F.when(F.col("k") % RUN < reach, F.array(own, own - 1)).otherwise(F.array(own))).alias("run"), own.alias("own"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = f"topic_id {kinds['topic_id']}, a {kinds['article_id']}, b {kinds['article_id']}, similarity double" + (", said string, other string" if entails else "")

    def work(t: pa.Table) -> pa.Table:
        t = t.sort_by("k")
        lists = t.column("embedding").combine_chunks()
        size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
        v = np.zeros((len(size), size.max(initial=0)))
        v[np.arange(v.shape[1]) < size[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
        whole = ~np.isnan(v).any(1) & ~lists.is_null().to_numpy(zero_copy_only=False)
        norm, first = np.sqrt((v * v).sum(1)), (t.column("own").to_numpy() == t.column("run").to_numpy())
        source = t.column("source").combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy()
        found = []
        for step in range(1, min(reach, len(size))):
            x, y = slice(None, -step), slice(step, None)
            with np.errstate(invalid="ignore", divide="ignore"):
                cosine = np.nan_to_num((v[x] * v[y]).sum(1) / (norm[x] * norm[y]))
            at = np.flatnonzero(first[x] & whole[x] & whole[y] & (size[x] == size[y]) & (source[x] != source[y]) & (source[x] >= 0) & (source[y] >= 0) & (cosine >= least))
            found.append((at, at + step, cosine[at]))
        i, j, cosine = (np.concatenate([f[c] for f in found]) if found else np.zeros(0, kind) for c, kind in enumerate((int, int, float)))
        columns = [t.column("topic_id").take(i), t.column("article_id").take(i), t.column("article_id").take(j), pa.array(cosine)]
        names = ["topic_id", "a", "b", "similarity"]
        return pa.table([*columns, t.column("text").take(i), t.column("text").take(j)], [*names, "said", "other"]) if entails else pa.table(columns, names)

    p = dealt.groupBy("topic_id", "run").applyInArrow(work, schema)
    score = F.pandas_udf(entails, "double")("said", "other") if entails else 0.5 * F.col("similarity")
    out = p.withColumn("score", score)
    return (out.where(F.col("score") >= least) if entails else out).select("topic_id", "a", "b", "similarity", "score")


def contradictions(articles: DataFrame, per_topic: int = 20, least: float = 0.6) -> DataFrame:
    """Pairs of a topic's articles, within ``per_topic`` in order, of different sources and opposed sentiment: ``score`` is half the gap.

    The window is the operator's own definition, so a topic of any size makes at most ``per_topic`` pairs an article. This is the form for
    corpora without vectors; ``alike_but_opposed`` goes by them.
    """
    x, y, near = _near_pairs(articles.where("topic_id >= 0").select("topic_id", "article_id", "source", "sentiment_score"), "topic_id", "article_id", per_topic)
    gap = F.abs(F.col("x.sentiment_score") - F.col("y.sentiment_score")) / 2
    opposed = (F.col("x.source") != F.col("y.source")) & (F.col("x.sentiment_score") * F.col("y.sentiment_score") < 0) & (gap >= least)
    return x.join(y, near & opposed).select(F.col("x.topic_id").alias("topic_id"), F.col("x.article_id").alias("a"), F.col("y.article_id").alias("b"), gap.alias("score"))


def clusters(vectors: DataFrame, choices: tuple[int, ...] = tuple(range(5, 51, 5)), kind: str = "kmeans", seed: int = 42, vector: str = "embedding") -> DataFrame:
    """``vectors`` with ``cluster``: k-means or bisecting k-means with the number of clusters of the best silhouette (of ten from 5 to 50, if
    there are that many rows)."""
    from pyspark.ml.clustering import BisectingKMeans, KMeans
    from pyspark.ml.evaluation import ClusteringEvaluator
    from pyspark.ml.functions import array_to_vector

    data = vectors.withColumn("features", array_to_vector(F.col(vector).cast("array<double>")))
    n, best = data.count(), None
    for k in [k for k in choices if k < n] or choices[:1]:
        made = (KMeans if kind == "kmeans" else BisectingKMeans)(k=k, seed=seed, predictionCol="cluster").fit(data).transform(data)
        score = ClusteringEvaluator(predictionCol="cluster").evaluate(made)
        if best is None or score > best[0]:
            best = (score, made)
    return best[1].drop("features")


def topics(docs: DataFrame, k: int = 20, key: str = "doc_id", text: str = "text", seed: int = 42) -> DataFrame:
    """``KEY, topic_id``: the likeliest topic of an LDA model of all words of two documents or more; see ``lda``."""
    return lda.topics(docs, F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}{3,}"), 0), k, key, seed=seed)
