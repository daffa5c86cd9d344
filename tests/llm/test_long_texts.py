"""Texts above one slice of work, columns whose names clash with results, and corpora without a label."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from corvane.llm import bpe, chat, decontaminate, langid, licences, manifest, neardup, quality, qualityrules, queries, simhash, substrings, tokencount
from corvane.llm import textkit as tk

from .test_ops import NOTICES, components_by_force, contaminated_by_force, kept_by_force, sha, words


@pytest.fixture(scope="module")
def told():
    rng = random.Random(11)
    known = ["".join(rng.choice("abcdefghijklmnoprstuvw") for _ in range(rng.randrange(1, 9))) for _ in range(4000)]
    prose = lambda n: [rng.choice(known) for _ in range(n)]
    long = prose(250_000)
    item, other = prose(14), prose(230_000)
    texts = {
        1: " ".join(long), 2: " ".join([*long[:-300], *prose(300)]), 3: "x" * 1_300_000, 4: " ".join([*prose(20), *long[-400:-330], *prose(20)]), 5: " ".join([*other, *item[:12], "end"]),
        6: "short text", 7: "語" * 420_000, 8: " \n" * 700_000, 9: " ".join(other[:100_000]) + "\n" + next(iter(NOTICES.values())) + "\n" + " ".join(prose(140_000)), 10: None,
    }
    assert sum(len((t or "").encode()) > tk.SLICE_BYTES for t in texts.values()) == 7
    return texts, item


@pytest.fixture(scope="module")
def docs(spark, told):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in told[0].items()], "doc_id long, text string, lang string, source string, n_chars long").repartition(3).cache()


def test_near_duplicates(docs, told):
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(docs, 2).collect()}
    assert got == {i: c for i, (_, c) in components_by_force(list(told[0].items()), 2, 80).items()} and got[2] == 1 and got[4] == 4


def test_decontamination(spark, docs, told):
    bench = [(1, " ".join(told[1])), (2, "語" * 420_000), (3, "none of this is there")]
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in decontaminate.contamination(docs, spark.createDataFrame(bench, "item_id long, text string")).collect()}
    assert got == contaminated_by_force(told[0].items(), bench) and {i for i, x in got.items() if x[4]} == {5, 7}


def test_repeated_passages(docs, told):
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substrings.removed(docs, substrings.settle(substrings.repeats(docs)), digest=True).collect()}
    assert got == kept_by_force(told[0].items()) and got[4][1] == 70 and got[2][1] > 240_000


def test_nothing_kept(spark):
    """Slices without a word, and of copies alone."""
    passage = " ".join(f"w{i}" for i in range(60))
    for rows in ([(1, None), (2, ""), (3, " \n")], [(1, passage), (2, passage), (3, f"{passage} {passage}")]):
        df = spark.createDataFrame(rows, "doc_id long, text string").repartitionByRange(3, "doc_id")
        for digest in (True, False):
            got = {r.doc_id: r for r in substrings.removed(df, substrings.settle(substrings.repeats(df)), digest=digest).collect()}
            want = kept_by_force(rows)
            assert {i: (r.n_words, r.n_removed) for i, r in got.items()} == {i: x[:2] for i, x in want.items()}
            assert not digest or {i: r.kept_sha256 for i, r in got.items()} == {i: x[2] for i, x in want.items()}


def test_tokens(docs, told):
    import sentencepiece
    from tokenizers import Tokenizer

    path = queries.vocabulary("piece_bpe_32k.model")
    lib = sentencepiece.SentencePieceProcessor(model_file=path)
    got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in tokencount.count_tokens(docs.select("doc_id", "text"), path).collect()}
    assert got == {i: (len((t or "").encode()), len(lib.encode(t or ""))) for i, t in told[0].items()}
    path = queries.vocabulary("byte_bpe_50k.json")
    byte = Tokenizer.from_file(path)
    for r in bpe.digest(docs.where("doc_id <> 3"), path).collect():
        t = told[0][r.doc_id] or ""
        ids = byte.encode(t, add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(",".join(map(str, ids))), sha(t))


def test_fingerprints(docs, told):
    got = {r.doc_id: r for r in simhash.edited_pairs(docs).collect()}
    order = sorted(told[0], reverse=True)
    for n, i in enumerate(order):
        x, y = told[0][i] or "", told[0][order[(n + 1) % len(order)]] or ""
        assert (got[i].n_chars, got[i].edited_sha256) == (len(x), sha(x[: len(x) - len(x) // 3] + y[: len(x) // 3]))
    assert got[2].near_next > 0.9 and got[5].near_edited > got[5].near_next


def test_licences_and_language(docs):
    assert {r.doc_id: r.licences for r in licences.scan(docs).where("licences <> ''").select("doc_id", "licences").collect()} == {9: next(iter(NOTICES))}
    told = {r.doc_id: r for r in langid.language_query(docs.drop("n_chars")).collect()}
    assert {i: r.lang_pred for i, r in told.items() if r.lang_pred == "und"}.keys() == {8, 10} and all(0 <= r.score <= 1 for r in told.values())


def test_statistics(docs, told):
    """A text's statistics are those of its words and bytes, told one by one."""
    got = {r.doc_id: dict(zip(quality.FEATURES, r.stats, strict=True)) for r in quality.features(docs).select("doc_id", F.col(_stats(docs)).alias("stats")).collect()}
    for i, t in told[0].items():
        b, w = (t or "").encode(), [x.encode() for x in words(t)]
        x = got[i]
        for name, c in (("share_lower", b"abcdefghijklmnopqrstuvwxyz"), ("share_digit", b"0123456789"), ("share_newline", b"\n"), ("share_.", b".")):
            assert x[name] == pytest.approx(sum(b.count(bytes([k])) for k in c) / len(b) if b else 0), (i, name)
        assert x["share_high"] == pytest.approx(sum(k > 127 for k in b) / len(b) if b else 0)
        assert x["word_mean"] == pytest.approx(sum(map(len, w)) / len(w) if w else 0)


def _stats(docs):
    return next(f.name for f in quality.features(docs).schema if f.dataType.typeName() == "array")


def test_rules_and_manifest(docs, told):
    got = {r.doc_id: r for r in qualityrules.filtered(docs).collect()}
    for i, t in told[0].items():
        w = words(t)
        assert (got[i].n_words, got[i].word_chars, got[i].n_symbols) == (len(w), sum(map(len, w)), 0 if i != 9 else got[i].n_symbols)
    one = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaves = {r.doc_id: (r.leaf, r.root) for r in manifest.manifest(docs).collect()}
    assert {i: x for i, (x, _) in leaves.items()} == {i: sha("".join(map(one, (i, "s", "en", len(t or ""), t)))) for i, t in told[0].items()} and len({r for _, r in leaves.values()}) == 1


def test_clashing_columns(spark):
    """Columns named like a result give way to it; others stay."""
    rows = [(1, "one two", "x", "y", "z", 5), (2, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, over_limit string, ids string, extra int")
    got = {r.doc_id: r for r in tokencount.count_tokens(docs, queries.vocabulary("piece_bpe_32k.model")).collect()}
    assert got[1].n_tokens > 0 and got[1].over_limit is False and got[2].n_tokens == 0
    path = queries.vocabulary("byte_bpe_50k.json")
    got = {r.doc_id: r for r in bpe.decode(bpe.encode(docs, path), path).collect()}
    assert list(got[1].ids) and got[1].extra == 5 and got[1].decoded == "one two" and list(got[2].ids) == [] and got[2].decoded == ""
    assert {r.doc_id: r.n_tokens for r in bpe.digest(docs, path).collect()} == {1: len(got[1].ids), 2: 0}
    turns = spark.createDataFrame([(1, 0, "user", "hi", "a", "b"), (1, 1, "assistant", "ok", "c", None)], "conv_id long, turn long, role string, text string, n_turns string, example string")
    done = chat.digest(chat.examples(turns)).first()
    assert (done.n_turns, done.loss_chars, done.loss_sha256) == (2, 2, sha("ok"))


def test_pipeline_ends(spark, small):
    """The last stage on nothing and on a null text, and a corpus without a label, of which the first stage can keep nothing."""
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(1, None, None, "s", None), (2, "", "en", None, 0), (None, "no id", "en", "s", 5)], kind)
    assert P.encoded(spark, docs.where("false"), small).count() == 0
    got = {r.doc_id: r for r in P.encoded(spark, docs, small).collect()}
    assert {i: (r.n_tokens, len(r.ids)) for i, r in got.items()} == {1: (0, 0), 2: (0, 0), None: (2, 2)}
    blank = spark.createDataFrame([(i, f"words of a text {i}", None, "s", 17) for i in range(8)], kind)
    assert P.language(spark, blank, small).count() == 0
