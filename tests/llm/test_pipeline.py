"""Every stage of the pipeline against its brute-force version, each on its own input."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from corvane.llm import langid
from corvane.llm.store import settle

from .test_ops import components_by_force, contaminated_by_force, kept_by_force, runs_of_one_word, words


@pytest.fixture(scope="module")
def stages(spark, small):
    docs, out = spark.read.parquet(f"{small}/documents.parquet"), []
    for _, f in P.STAGES:
        done = settle(f(spark, docs, small))
        out.append((docs, done))
        docs = done
    return out


def rows(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_columns(stages):
    assert [n for n, _ in P.STAGES] == ["language", "near_duplicates", "repeated_passages", "decontaminated", "encoded"]
    assert all(a.columns == b.columns and a.dtypes == b.dtypes for a, b in stages[:-1])


def test_language(stages):
    before, after = stages[0]
    told = langid.identify(before, langid.fit(before.where(langid.part(4) != 2)))
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in told.where("lang_pred <> 'und' and score >= 0.5").collect()}


def test_near_duplicates(stages):
    before, after = stages[1]
    assert {i for i, _ in rows(after)} == {i for i, (_, c) in components_by_force(rows(before), 5, 80).items() if i == c}


def test_repeated_passages(stages):
    before, after = stages[2]
    want = kept_by_force(rows(before))
    text = dict(rows(before))
    for i, t in rows(after):
        assert len(words(t)) == want[i][0] - want[i][1] and (want[i][1] or t == text[i])
    assert {i for i, _ in rows(after)} == {i for i, (n, gone, _) in want.items() if not gone or gone < n}


def test_repeated_passages_of_a_crowded_word(spark, small):
    told = runs_of_one_word()
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in told], "doc_id long, text string, lang string, source string, n_chars long")
    want = {i: n - gone for i, (n, gone, _) in kept_by_force(told).items()}
    assert {i: len(words(t)) for i, t in rows(P.repeated_passages(spark, docs, small))} == {i: n for i, n in want.items() if n}


def test_decontaminated(stages, small):
    before, after = stages[3]
    bench = duckdb.sql(f"select item_id, text from '{small}/benchmark.parquet'").fetchall()
    assert {i for i, _ in rows(after)} == {i for i, x in contaminated_by_force(rows(before), bench).items() if not x[4]}


def test_encoded(stages):
    from tokenizers import Tokenizer

    before, after = stages[4]
    lib = Tokenizer.from_file(P.vocabulary("byte_bpe_50k.json"))
    text = dict(rows(before))
    for r in after.collect():
        assert r.ids == lib.encode(text[r.doc_id], add_special_tokens=False).ids and r.n_tokens == len(r.ids)


def test_edge_rows(spark, small):
    docs = spark.createDataFrame(
        [(1, None, None, "s", None), (2, "", "en", "s", 0), (3, "1234 !!", "en", None, 7), (None, "words without an id here", "en", "s", 1), (4, "plain words stay", "en", "s", 16), (5, "plain words stay", "en", "s", 16), (6, "unlabelled words", None, "s", 3)],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    for _, f in P.STAGES[:-1]:
        assert f(spark, docs.where("false"), small).count() == 0
        docs = settle(f(spark, docs, small))
    assert sorted((r.doc_id or 0, r.lang) for r in docs.collect()) == [(0, "en"), (4, "en"), (6, "en")]
    assert docs.where(F.col("text").isNull()).count() == 0
