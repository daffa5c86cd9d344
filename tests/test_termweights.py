"""Term weights by batches against brute force, with odd rows."""

import math
import re
from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import functions as F

from corvane.operators import features, termweights


def brute(rows, longest, top, least=2, most=0.95):
    docs, n = defaultdict(Counter), Counter()
    for k, by, text in rows:
        if by is None:
            continue
        n[by] += 1
        w = re.findall(r"[^\W_]{2,}", (text or "").lower())
        docs[k, by].update(w + ([f"{a} {b}" for a, b in zip(w, w[1:])] if longest == 2 else []))
    df = Counter((by, t) for (_, by), c in docs.items() for t in c)
    each = defaultdict(dict)
    for (k, by), c in docs.items():
        for t, tf in c.items():
            if least <= df[by, t] <= most * n[by]:
                each[k][by, t] = (1 + math.log(tf)) * (math.log((1 + n[by]) / (1 + df[by, t])) + 1)
    out = []
    for k, w in each.items():
        norm = math.sqrt(sum(x * x for x in w.values()))
        best = sorted(((-round(x / norm, 9), t) for (_, t), x in w.items()))[:top]
        out += [(k, t, round(-x, 6), i + 1) for i, (x, t) in enumerate(best)]
    return sorted(out, key=repr)


def test_weights_of_odd_rows(spark):
    """Repeated and missing keys, missing texts and vocabularies, no words, one word, letters of all scripts."""
    texts = ["the cat sat on the mat", "The cat ate", "한국 은행 금리", "한국 은행 cat", "", "a b c", None, "mat", "le chat sat", "é12 cat 한국", "the the the the", "cat sat on"]
    langs = [None, "en", "ko", ""]
    rows = [(i % 12 if i % 13 else None, langs[i % 4], texts[i * 7 % 11]) for i in range(60)]  # a key has one vocabulary: ties of a term with itself are open
    df = spark.createDataFrame(rows, "doc_id int, lang string, text string").repartition(5)
    for longest in (1, 2):
        got = features.tfidf(df, longest=longest, by=F.col("lang"), top=4).where("doc_id is not null").collect()
        want = [w for w in brute(rows, longest, 4) if w[0] is not None]
        assert sorted(((r.doc_id, r.term, round(r.weight, 6), r.rank) for r in got), key=repr) == want and want
    assert features.tfidf(df.where("false")).count() == 0


def test_no_term_is_a_row_of_a_shuffle(spark):
    df = spark.createDataFrame([(1, "one two three"), (2, "one two four")], "doc_id long, text string")
    plan = features.tfidf(df, longest=2)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan


def test_batches_keep_the_rows_of_a_key_together(monkeypatch):
    monkeypatch.setattr(termweights, "WORDS", 3)
    keys = [1, 1, 2, 3, 3, 3, None, None, 4]
    batches = [pa.record_batch([pa.array(keys[i : i + 2], pa.int64()), pa.array([["x", "y"]] * len(keys[i : i + 2]))], ["k", "words"]) for i in range(0, 9, 2)]
    got = [t.column("k").to_pylist() for t in termweights._pieces(iter(batches))]
    assert [x for g in got for x in g] == keys and len(got) > 1
    assert sum(len(set(g)) for g in got) == len(set(keys))
