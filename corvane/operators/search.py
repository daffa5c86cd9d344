"""Full-text search over an inverted index with BM25 order and snippets, and exact vector search."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import settle


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), 0)


def index(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``term, KEY, tf, length, places``: the inverted index. Texts are cut once; write it partitioned or sorted by term to search it again."""
    each = docs.select(key, tokens(F.col(text)).alias("t")).select(key, F.size("t").alias("length"), F.posexplode("t").alias("place", "term"))
    return each.groupBy("term", key, "length").agg(F.count("*").alias("tf"), F.sort_array(F.collect_list("place")).alias("places"))


def search(docs: DataFrame, terms: list[str], every: bool = True, phrase: bool = False, k: int = 20, k1: float = 1.2, b: float = 0.75, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``KEY, score``: the ``k`` documents with the best BM25 score that hold ``every`` one of the terms, or any; as a ``phrase``
    in that order. Texts are cut once: of each only its length and the places of the query's terms go on."""
    own = docs.select(key, tokens(F.col(text)).alias("t"))
    placed = F.transform("t", lambda x, i: F.struct(x.alias("x"), i.alias("i")))
    places = lambda term: F.transform(F.filter(placed, lambda x: x["x"] == term), lambda x: x["i"])
    at = [F.struct(F.lit(t).alias("term"), places(t).alias("places")) for t in terms]
    rows = settle(own.select(key, F.size("t").alias("length"), F.filter(F.array(*at), lambda x: F.size(x["places"]) > 0).alias("hits")))
    whole = rows.agg(F.count("*").alias("n"), F.avg("length").alias("mean"))
    post = rows.where(F.size("hits") > 0).select(key, "length", F.explode("hits").alias("h")).select(key, "length", "h.term", F.size("h.places").alias("tf"), "h.places")
    df = post.groupBy("term").agg(F.count("*").alias("df"))
    post = post.join(F.broadcast(df), "term").crossJoin(F.broadcast(whole))  # one row a query term; one row
    return _ranked(post, terms, every, phrase, k, k1, b, key)


def search_index(postings: DataFrame, sizes: DataFrame, terms: list[str], every: bool = True, phrase: bool = False, k: int = 20, k1: float = 1.2, b: float = 0.75, key: str = "doc_id") -> DataFrame:
    """As ``search``, over a written ``index``: only the postings of the terms are read. ``sizes``: one row ``n, mean`` of all documents."""
    post = postings.where(F.col("term").isin(terms))
    df = post.groupBy("term").agg(F.count("*").alias("df"))
    return _ranked(post.join(F.broadcast(df), "term").crossJoin(F.broadcast(sizes)), terms, every, phrase, k, k1, b, key)  # one row a query term; one row


def _ranked(post: DataFrame, terms: list[str], every: bool, phrase: bool, k: int, k1: float, b: float, key: str) -> DataFrame:
    idf = F.log(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    part = idf * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("length") / F.col("mean")))
    out = post.groupBy(key).agg(F.sum(part).alias("score"), F.count("*").alias("found"), F.map_from_entries(F.collect_list(F.struct("term", "places"))).alias("at"))
    if every or phrase:
        out = out.where(F.col("found") == len(set(terms)))
    if phrase:
        start = F.col("at")[terms[0]]
        out = out.where(F.exists(start, lambda p: F.forall(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(t).alias("t")) for i, t in enumerate(terms))), lambda x: F.array_contains(F.element_at("at", x["t"]), p + x["i"]))))
    return out.select(key, "score").orderBy(F.desc("score"), key).limit(k)


def snippet(text: Column, term: str, around: int = 40) -> Column:
    at = F.instr(F.lower(text), term)
    return F.when(at > 0, F.substring(text, F.greatest(at - around, F.lit(1)), F.lit(2 * around + len(term))))


#: Vectors that are compared at once with as many others.
BLOCK = 1000


def _blocks(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``block, ids, vectors``: rows of about ``BLOCK`` vectors each, dealt by a hash of the key."""
    n = vectors.count()
    block = F.pmod(F.xxhash64(key), F.lit(max(1, -(-n // BLOCK))))
    rows = vectors.where(F.col(vector).isNotNull()).select(block.alias("block"), F.struct(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v")).alias("x"))
    return rows.groupBy("block").agg(F.collect_list("x").alias("x")).select("block", F.transform("x", lambda r: r["id"]).alias("ids"), F.transform("x", lambda r: r["v"]).alias("vectors"))


def _unit(rows: list) -> np.ndarray:
    m = np.array([np.asarray(r, float) for r in rows])
    size = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, size, out=np.zeros_like(m), where=size > 0)


def _block_pairs(vectors: DataFrame, queries: DataFrame, key: str, vector: str) -> DataFrame:
    q = _blocks(queries, key, vector).toDF("qb", "qids", "q")
    return q.crossJoin(_blocks(vectors, key, vector)).repartition("qb", "block")  # blocks of a stated query set against blocks of all rows


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id, KEY, cosine, rank``: the ``k`` nearest vectors of each query, exactly. Queries and vectors meet in blocks of about a
    thousand, by one matrix product each, and only the ``k`` best rows of a query in a block go on."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for qids, q, ids, v in pdf[["qids", "q", "ids", "vectors"]].itertuples(index=False):
                ids, qids = np.asarray(ids), np.asarray(qids)
                c = _unit(q) @ _unit(v).T
                c[qids[:, None] == ids[None, :]] = -np.inf
                order = np.lexsort((np.broadcast_to(ids, c.shape), -np.round(c, 12)), axis=1)[:, :k]
                row = np.repeat(np.arange(len(qids)), order.shape[1])
                made = pd.DataFrame({"query_id": qids[row], key: ids[order.ravel()], "cosine": c[row, order.ravel()]})
                yield made[np.isfinite(made["cosine"])]

    kind = vectors.schema[key].dataType.simpleString()
    scored = _block_pairs(vectors, queries, key, vector).mapInPandas(work, f"query_id {kind}, {key} {kind}, cosine double")
    return scored.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc(F.round("cosine", 12)), key))).where(F.col("rank") <= k)


def alike(vectors: DataFrame, queries: DataFrame, cut: float = 0.75, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``KEY, n_alike``: how many other vectors are over ``cut`` in cosine with each query, at least 1; a zero vector has 1."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for qids, q, ids, v in pdf[["qids", "q", "ids", "vectors"]].itertuples(index=False):
                hit = (_unit(q) @ _unit(v).T > cut) & (np.asarray(qids)[:, None] != np.asarray(ids)[None, :])
                yield pd.DataFrame({key: np.asarray(qids), "n": hit.sum(axis=1)})

    kind = vectors.schema[key].dataType.simpleString()
    n = _block_pairs(vectors, queries, key, vector).mapInPandas(work, f"{key} {kind}, n long").groupBy(key).agg(F.sum("n").alias("n"))
    return queries.select(key).join(n, key, "left").select(key, F.greatest(F.coalesce("n", F.lit(0)), F.lit(1)).cast("long").alias("n_alike"))
