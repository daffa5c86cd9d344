"""The operators against brute force, exact round trips and held-out accuracy, on made-up edge cases and the smallest tables."""

import hashlib
import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corvane.llm import bpe, chat, components, decontaminate, fmindex, langid, licences, neardup, quality, queries, simhash, substrings, tokencount
from corvane.llm import textkit as tk

EDGE = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "one"), (6, "é" * 3), (7, "a b c d e f g " * 40), (8, "a b c d e f g " * 40), (9, "x " * 30_000), (None, "no id"), (10, "\x00\x01 ok"), (11, "🙂 <|endoftext|> <s> 'll")]


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


@pytest.fixture(scope="module")
def edge(spark):
    rows = [(i, t, "en", "s", None, "clash") for i, t in EDGE] + [(4, "one", "en", "s", None, "clash")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string")


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="module")
def rows(small):
    return sorted(duckdb.sql(f"select doc_id, text from '{small}/documents.parquet'").fetchall())


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def low(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def test_words_and_hashes():
    texts = ["hello  world", None, "", " x", "x y", "abc\ndef é ü", "hello", "y"]
    w = tk.Words(pa.array(texts))
    got = [[w.data[w.start[i] : w.end[i]].tobytes().decode() for i in range(w.first[r], w.first[r + 1])] for r in range(len(texts))]
    assert got == [words(t) for t in texts]
    h = w.hash()
    assert h[0] == h[-2] and h[-1] == h[4] and len(set(h.tolist())) == 8


def test_components_random(spark):
    rng = random.Random(5)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(1000, 1000 + i) for i in range(1, 400)] + [(None, 3), (7, 7)]
    u = components.Union()
    for a, b in links:
        if a is not None and a != b:
            u.join(a, b)
    want = {x: u.root(x) for a, b in links if a is not None and a != b for x in (a, b)}
    got = {r.node: r.component for r in components.components(spark.createDataFrame(links, "a long, b long").repartition(5)).collect()}
    assert got == want
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# -- 1 quality


def test_quality(spark, edge, none):
    labels = spark.createDataFrame([(4, 1), (7, None), (None, 1), (99, 0)], "doc_id long, quality int")
    got = quality.quality_query(edge, labels).collect()
    assert len(got) == 13 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert quality.quality_query(none, labels).count() == 0


def test_trees_learn_and_flatten():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] > 0)).astype(float)
    t = quality.grow(x[:1500], y[:1500], trees=40)
    assert ((t.score(x[1500:]) > 0.5) == y[1500:]).mean() > 0.95

    def walk(row):
        total = t.base
        for n in t.roots:
            while t.left[n] != n:
                n = t.left[n] if row[t.feature[n]] <= t.threshold[n] else t.right[n]
            total += t.value[n]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(t.score(x[:50]), [walk(r) for r in x[:50]])
    assert np.allclose(quality.grow(np.zeros((0, 3)), np.zeros(0)).score(np.zeros((2, 3))), 0.5)


def test_quality_held_out(spark, small):
    big = small.replace("sf0.001", "sf0.01")
    got = queries.op1_quality(spark, big).join(spark.read.parquet(f"{big}/labels.parquet"), "doc_id").where("held_out").toPandas()
    assert (got.predicted == got.quality).mean() > 0.95


# -- 2 near-duplicates


def components_by_force(rows, k, t):
    sets = {}
    for i, x in rows:
        w = words(low(x))
        sets[i] = frozenset(tuple(w[j : j + k]) for j in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])
    u, ids = components.Union(), sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= t * (len(sets[a]) + len(sets[b]) - both):
                u.join(a, b)
    return {i: (len(sets[i]), u.root(i)) for i in ids}


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates(spark, rows, k):
    rng = random.Random(k)
    more = list(rows)
    base = words(rows[3][1] or "x y z")[:200]
    for i in range(60):  # a chain of edits, and short sets at the very bound
        w = list(base)
        for _ in range(rng.randrange(0, 14)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(999)}"
        more.append((10_000 + i, " ".join(w)))
    more += [(20_000, "a b c d e f"), (20_001, "a b c d e"), (20_002, "a b c d"), (20_003, "a b c"), (20_004, "A B C"), (20_005, "a"), (20_006, "a"), (20_007, "")]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(spark.createDataFrame(more, "doc_id long, text string"), k).collect()}
    assert got == components_by_force(more, k, 80)


def test_near_duplicate_blocks(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK_LEAST", 7)
    monkeypatch.setattr(neardup, "BLOCKS", 1000)
    rng = random.Random(1)
    more = []
    for i in range(90):
        w = [f"w{j}" for j in range(60)]
        for _ in range(rng.randrange(0, 7)):
            w[rng.randrange(60)] = f"e{rng.randrange(99)}"
        more.append((i, " ".join(w)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(spark.createDataFrame(more, "doc_id long, text string"), 2).collect()}
    assert got == components_by_force(more, 2, 80)


def test_near_duplicate_links_stay_few(spark, monkeypatch):
    """Blocks of a large group of near copies pass on links in proportion to its members."""
    rng, handed = random.Random(4), []
    more = []
    for i in range(400):
        w = [f"w{j}" for j in range(80)]
        for _ in range(rng.randrange(0, 3)):
            w[rng.randrange(80)] = f"e{rng.randrange(999)}"
        more.append((i, " ".join(w)))
    monkeypatch.setattr(neardup, "BLOCK_LEAST", 20)
    verify = neardup.verify

    def counted(*args):
        handed.append(neardup.settle(verify(*args)))
        return handed[-1]

    monkeypatch.setattr(neardup, "verify", counted)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(spark.createDataFrame(more, "doc_id long, text string"), 2).collect()}
    assert got == components_by_force(more, 2, 80)
    assert handed[0].count() < 2 * 400  # whatever is left for blocks after the comparison with centers


@pytest.mark.parametrize("least", [1, 5, 40])
def test_near_duplicate_open_groups(spark, monkeypatch, least):
    """Chains and half-alike texts, whose buckets hold several components, in blocks of any size."""
    monkeypatch.setattr(neardup, "BLOCK_LEAST", least)
    rng, more = random.Random(least), []
    base = [f"w{j}" for j in range(50)]
    for i in range(160):
        w = list(base)
        for at in rng.sample(range(50), rng.choice([1, 3, 5, 6, 7, 9])):
            w[at] = f"e{rng.randrange(12)}"
        more.append((i, " ".join(w)))
        if i % 4 == 0:
            base[rng.randrange(50)] = f"b{i}"
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(spark.createDataFrame(more, "doc_id long, text string"), 1).collect()}
    want = components_by_force(more, 1, 80)
    assert got == want and len({c for _, c in want.values()}) > 3


def test_least_linked():
    rng = np.random.default_rng(6)
    hit = np.triu(rng.random((60, 60)) < 0.02, 1)
    u = components.Union()
    for a, b in np.argwhere(hit).tolist():
        u.join(a, b)
    assert neardup.least_linked(hit | hit.T).tolist() == [u.root(x) for x in range(60)]


def test_near_duplicates_null_ids(spark):
    rows = [(1, "a b c d"), (None, "a b c d"), (None, "a b c d"), (None, None), (2, "a b c d")]
    got = sorted(((r.doc_id or 0, r.component_id, r.kept) for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()), key=str)
    assert got == [(0, None, True)] * 3 + [(1, 1, True), (2, 1, False)]


def test_superminhash_estimates():
    rng, shares = np.random.default_rng(0), []
    for _ in range(60):
        u = rng.integers(0, 2**64, 200, dtype=np.uint64)
        h = neardup.signatures(np.r_[np.sort(u[:180]), np.sort(u[20:])], np.array([0, 180, 360]), 250)
        shares.append((h[0] == h[1]).mean())
    assert abs(np.mean(shares) - 0.8) < 0.01 and np.std(shares) < (0.16 / 250) ** 0.5
    one = neardup.signatures(np.array([5], np.uint64), np.array([0, 1]), 250)
    assert sorted((one[0] >> np.uint64(32)).tolist()) == list(range(250))  # a permutation of ranks


def test_near_duplicates_edge(spark, edge, none):
    got = neardup.near_duplicates(edge, 2).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 13 and by[5].component_id == 4 and not by[5].kept and by[8].component_id == 7 and by[1].n_shingles == 0 and by[1].kept and by[None].kept
    assert neardup.near_duplicates(none, 2).count() == 0


# -- 3 decontamination


def contaminated_by_force(docs, bench, n=10):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(t))
    windows = {}
    for i, x in bench:
        w = cut(x)
        for p in range(max(1, len(w) - n + 1)) if w else ():
            windows.setdefault(tuple(w[p : p + n]), set()).add(i)
    out = {}
    for i, x in docs:
        w, hit, items = cut(x), set(), set()
        for size in {len(k) for k in windows}:
            for p in range(len(w) - size + 1):
                if found := windows.get(tuple(w[p : p + size])):
                    hit |= set(range(p, p + size))
                    items |= found
        out[i] = (len(w), len(hit), len(items), sha(",".join(sorted(map(str, items)))), bool(hit))
    return out


@pytest.mark.parametrize("threshold", ["10MB", "-1"])  # -1: every join shuffles
def test_decontamination(spark, rows, small, threshold):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    docs = [*rows, (9001, "Alpha beta gamma"), (9002, None), (9003, ""), (9004, "one two three four five six seven eight nine ten eleven"), (9005, "x beta GAMMA beta gamma y"), (9006, "one " * 13), (9007, "É é")]
    bench = [*duckdb.sql(f"select item_id, text from '{small}/benchmark.parquet'").fetchall(), (901, "beta gamma"), (902, "zero one two three four five six seven eight nine ten"), (903, ""), (904, None), (905, "one " * 11), (906, "y"), (907, "é")]
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in decontaminate.contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")).collect()}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == contaminated_by_force(docs, bench)


def test_decontamination_repeated_ids(spark):
    bench = [(1, "a b c d e f g h i j k l"), (2, "a b c d e"), (3, "p q r s t u v w x y z"), (4, "p q r s t u v w x y z q")]
    docs = [(1, "x A b c d e f g h i j y"), (1, "a b c d e"), (1, "nothing"), (1, "nothing"), (None, "a b c d e"), (2, "p q r s t u v w x y z p q r s t u v w x y Z q")]
    got = sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items) for r in decontaminate.contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")).collect())
    want = [(str(i), *next(iter(contaminated_by_force([(i, t)], bench).values()))[:3]) for i, t in docs]
    assert got == sorted((i, n, *((0, 0) if i == "None" else (hit, items))) for i, n, hit, items in want)


def test_decontamination_edge(spark, edge, none):
    bench = spark.createDataFrame([(1, "one")], "item_id long, text string")
    got = decontaminate.contamination(edge, bench)
    assert got.count() == 13 and {r.doc_id for r in got.where("contaminated").collect()} == {4, 5}
    assert decontaminate.contamination(edge, bench.where("false")).where("contaminated").count() == 0
    assert decontaminate.contamination(none, bench).count() == 0


# -- 4 token counts


def noise(seed, parts, n=4000):
    rng = random.Random(seed)
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(0, 40))) for _ in range(n)]


def test_token_counts(rows):
    import sentencepiece

    path = queries.vocabulary("piece_bpe_32k.model")
    t, lib = tokencount.Transducer(path), sentencepiece.SentencePieceProcessor(model_file=path)
    texts = noise(3, [*"ab'srtvelmd    \n\t12é中  　.,!́🙂▁\x00", "<s>", "</s>", "the", " th", "ing ", "<0x0A>"]) + [x for _, x in rows] + [x for _, x in EDGE] + ["a" * 3000, " " * 101, "x" + " " * 333 + "y", " "]
    assert t.count(pa.array(texts)).tolist() == [len(x) for x in lib.encode([x or "" for x in texts])]


def test_token_counts_start_anew(rows, monkeypatch):
    t = tokencount.Transducer(queries.vocabulary("piece_bpe_32k.model"))
    column = pa.array([x for _, x in rows])
    want = t.count(column).tolist()
    monkeypatch.setattr(tokencount, "MOST_STATES", 10)
    assert t.count(column).tolist() == want and t.count(column).tolist() == want


def test_token_counts_edge(edge, none):
    got = tokencount.count_tokens(edge.select("doc_id", "text"), queries.vocabulary("piece_bpe_32k.model"), 100)
    assert {r.doc_id for r in got.where("over_limit").collect()} == {7, 8, 9} and got.where("doc_id = 1").first().n_tokens == 0
    assert tokencount.count_tokens(none.select("doc_id", "text"), queries.vocabulary("piece_bpe_32k.model")).count() == 0


# -- 5 fingerprints


def test_edited_pairs(spark, rows):
    extra = [*rows, (77_777, None), (88_888, ""), (99_999, "only")]
    df = spark.createDataFrame(extra, "doc_id long, text string").repartition(7)
    order = sorted(extra, reverse=True)
    got = {r.doc_id: r for r in simhash.edited_pairs(df, 5).collect()}
    for n, (i, x) in enumerate(order):
        x, y = x or "", order[(n + 1) % len(order)][1] or ""
        k = len(x) // 3
        assert (got[i].n_chars, got[i].edited_sha256) == (len(x), sha(x[: len(x) - k] + y[:k]))
    assert got[77_777].fingerprint == got[88_888].fingerprint
    long = [r for r in got.values() if r.n_chars > 300]
    assert sum(r.near_edited > r.near_next for r in long) > 0.97 * len(long)


def test_edited_pairs_edge(spark, edge, none):
    assert simhash.edited_pairs(edge).count() == 13 and simhash.edited_pairs(none).count() == 0
    alone = simhash.edited_pairs(spark.createDataFrame([(1, "abcdef")], "doc_id long, text string")).first()
    assert alone.edited_sha256 == sha("abcdab") and alone.near_next == 1


@pytest.mark.parametrize(("radius", "free"), [(7, 1), (3, 2), (0, 2), (9, 3)])
def test_radius_search(spark, radius, free):
    rng = np.random.default_rng(2)
    base = rng.integers(0, 256, (200, 16), dtype=np.uint8)
    for i in range(1, 60):
        base[i] = base[0] ^ np.packbits(np.isin(np.arange(128), rng.choice(128, i % 12, replace=False)))
    base[60:70] = base[3]
    base[70] = 0
    df = spark.createDataFrame([(i, x.tobytes().hex()) for i, x in enumerate(base)], "doc_id long, fingerprint string")
    got = {(r.query_id, r.doc_id): r.distance for r in simhash.within(df, df.where("doc_id < 80"), radius, free).collect()}
    want = {(a, b): int(np.bitwise_count(base[a] ^ base[b]).sum()) for a in range(80) for b in range(200)}
    want = {k: d for k, d in want.items() if d <= radius}
    assert got == want
    counted = {r.doc_id: r.n_near for r in simhash.neighbours(df, df.where("doc_id < 80"), radius, free).collect()}
    assert counted == {a: sum(k[0] == a for k in want) for a in range(80)}


def print_by_force(text):
    """Votes of one text, term by term, in Python's own arithmetic."""
    w = [x.encode() for x in words(low(text))]
    if not w:
        return "0" * 32
    column = tk.Words(pa.array([" ".join(x.decode() for x in w)]))
    h = column.hash()
    pairs = [(int(g), min(len(a) + len(b) + gap, simhash.MOST_WEIGHT)) for g, a, b, gap in zip(tk.grams(h, 2), w[:-1], w[1:], gaps(low(text)), strict=True)] or [(int(h[0]), 1)]
    seen, first = {}, {}
    for g, size in pairs:
        seen[g] = seen.get(g, 0) + 1
        first.setdefault(g, size)
    votes = [0.0] * 128
    for g, n in seen.items():
        both = np.array([g, int(tk.mix(np.array([g], np.uint64) ^ np.uint64(0xD6E8FEB86659FD93))[0])], np.uint64)
        weight = first[g] * float(np.float32(1 + np.log(n)))
        for i, bit in enumerate("".join(f"{x:08b}" for x in both.tobytes())):
            votes[i] += weight if bit == "1" else -weight
    return f"{int(''.join('1' if v > 0 else '0' for v in votes), 2):032x}"


def gaps(text):
    at = [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
    return [b[0] - a[1] for a, b in zip(at[:-1], at[1:], strict=True)]


def test_fingerprint_votes(rows):
    texts = [x for _, x in rows if x and len(x) < 4000][:60] + ["one", "two words", "a a a a", "", "x\t\ny  z x\t\ny"]
    made = [x.tobytes().hex() for x in simhash.fingerprints(pa.array(texts))]
    assert made == [print_by_force(x) for x in texts]


def test_fingerprint_query(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    got = queries.op5_fingerprints(spark, small).collect()
    prints = {r.doc_id: int(r.fingerprint, 16) for r in got}
    assert len(got) == docs.count()
    for r in got:
        assert r.n_near == (sum((prints[r.doc_id] ^ x).bit_count() <= 3 for x in prints.values()) if r.doc_id % 100 == 0 else None)
        differ = (int(r.fingerprint, 16) ^ int(r.edited_fingerprint, 16)).bit_count()
        assert abs(r.near_edited - max(0, np.cos(np.pi * differ / 128))) < 1e-12


def test_edited_pairs_of_named_ids(spark):
    texts = [("b", "b text " * 9), ("a", "a word " * 7), (None, "nothing known"), ("c", None), ("aa", "é" * 10)]
    got = {r.doc_id: r for r in simhash.edited_pairs(spark.createDataFrame(texts, "doc_id string, text string"), 3).collect()}
    order = [("c", ""), ("b", texts[0][1]), ("aa", "é" * 10), ("a", texts[1][1]), (None, "nothing known")]
    for n, (i, x) in enumerate(order):
        k = len(x) // 3
        assert got[i].edited_sha256 == sha(x[: len(x) - k] + order[(n + 1) % 5][1][:k])
    assert simhash.fingerprint_query(spark.createDataFrame(texts, "doc_id string, text string")).count() == 5


# -- 6 BPE


def test_bpe_equals_library(rows):
    from tokenizers import Tokenizer

    path = queries.vocabulary("byte_bpe_50k.json")
    c, lib = bpe.Codec(path), Tokenizer.from_file(path)
    texts = noise(4, [*"ab'srtvelmd  \n\t12é中  　.,!́🙂", "<|endoftext|>", "'ll", "'re", " '"]) + [x for _, x in rows] + [x for _, x in EDGE] + ["aaaa" * 50, " " * 40, "'s", "x\r\n\r\n y"]
    ids, offs = c.encode(pa.array(texts))
    data, at = c.decode(ids, offs)
    for i, e in enumerate(lib.encode_batch([x or "" for x in texts], add_special_tokens=False)):
        own = ids[offs[i] : offs[i + 1]].tolist()
        assert own == e.ids and data[at[i] : at[i + 1]].tobytes().decode("utf-8", "replace") == lib.decode(own, skip_special_tokens=False)


def test_bpe_frames(spark, edge, none):
    path = queries.vocabulary("byte_bpe_50k.json")
    back = bpe.decode(bpe.encode(edge, path), path)
    assert all(r.decoded == (r.text or "") for r in back.collect()) and back.columns == [*edge.columns, "ids", "decoded"]
    broken = spark.createDataFrame([(1, [220, 255]), (2, None)], "doc_id long, ids array<int>")
    assert {r.doc_id: r.decoded for r in bpe.decode(broken, path).collect()}[2] == ""
    got = {r.doc_id: r for r in bpe.digest(edge, path).collect()}
    assert got[1].ids_sha256 == sha("") and got[2].n_tokens == 0 and got[11].decoded_sha256 == sha(EDGE[-1][1])
    assert bpe.digest(none, path).count() == 0


# -- 7 chat


def test_chat_round_trip(spark, small):
    hard = [
        (1, 0, "user", "a\\b<|im_end|>\n<|x"), (1, 1, "assistant", "<|im_start|>assistant\nok<\\|"), (1, 2, "user", None), (2, 0, "assi\nstant\\", "x"), (3, 0, "assistant", ""), (3, 0, "assistant", "\\"),
        (-1, 0, "user", "<|im_end|><|im_start|>assistant ok"), (-1, 1, "assistant", "<|im_end|><|im_start|>assistant ok"), (4, 1, None, "é🙂"), (4, 2, "assistant", "é🙂<"), (4, 3, "assistant", "|x\r\n"), (5, None, "user", "first"), (5, 0, "assistant", "second"),
    ]
    turns = hard + [(1000 + c, t, r, x) for c, t, r, x in duckdb.sql(f"select conv_id, turn, role, text from '{small}/conversations.parquet'").fetchall()]
    convs = {}
    for c, t, r, x in sorted(turns, key=lambda z: (z[0], -1 if z[1] is None else z[1], z[2] or "", z[3] or "")):
        convs.setdefault(c, []).append((r or "", x or ""))
    made = chat.examples(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")).cache()
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.digest(made).collect()}
    assert got == {c: (len(v), sha("".join(f"{r}\n{x}\n" for r, x in v)), sum(len(x) for r, x in v if r == "assistant"), sha("".join(x for r, x in v if r == "assistant"))) for c, v in convs.items()}
    for c, v in convs.items():  # one example a reply, the mask over that reply alone
        own = sorted((r.example, r.text, r.loss_start, r.loss_chars) for r in made.where(F.col("conv_id") == c).collect()) if c < 6 else []
        replies = [x for r, x in v if r == "assistant"]
        assert not own or [re.sub(r"(?s)\\(.)", r"\1", t[s - 1 : s - 1 + n]) for _, t, s, n in own if s] == replies
    assert chat.digest(chat.examples(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))).count() == 0


# -- 8 licences


def test_licences(spark, edge, none):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights\nto use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."
    df = spark.createDataFrame([(1, f"Intro\n\n{mit}"), (2, "junk\nLicensed under CC BY-NC 4.0.\nReleased under the MIT License."), (3, "The MIT licence is short."), (4, None)], "doc_id long, text string")
    assert {r.doc_id: r.licences for r in licences.scan(df).collect()} == {1: "MIT", 2: "MIT,CC-BY-NC-4.0", 3: "", 4: ""}
    assert licences.scan(edge).count() == 13 and licences.scan(none).count() == 0


BSD = [
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
]
GNU = "This {0} is free software: you can redistribute it and/or modify it under the terms of the GNU {1}General Public License as published by the Free Software Foundation, either version {2} of the License, or (at your option) any later version."
HOPE = "This {0} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."
NOTICES = {
    "BSD-3-Clause": "\n".join(BSD),
    "BSD-2-Clause": "\n".join(BSD[:3]),
    "GPL-3.0": "\n".join([GNU.format("program", "", "3"), HOPE.format("program")]),
    "GPL-2.0": "\n".join([GNU.format("program", "", "2"), HOPE.format("program")]),
    "LGPL-2.1": "\n".join([GNU.format("library", "Lesser ", "2.1"), HOPE.format("library")]),
    "LGPL-3.0": "\n".join([GNU.format("library", "Lesser ", "3"), HOPE.format("library")]),
    "AGPL-3.0": "\n".join([GNU.format("program", "Affero ", "3"), HOPE.format("program")]),
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.\n\nPermission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "0BSD": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
    "Apache-2.0": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    "Artistic-2.0": "Available under the Artistic License 2.0.",
    "EPL-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
}


def test_licence_notices(spark):
    """Notices as their licences print them: each is told as itself, and as nothing else."""
    texts = [(n, f"Preface\n{x}\nThe end of it") for n, x in NOTICES.items()] + [("MIT,BSD-2-Clause", "\n".join([*BSD[:3], "Released under the MIT License."])), ("", "no licence here"), ("BSD-3-Clause,BSD-2-Clause", "\n".join(BSD + BSD[:3]))]
    got = {r.doc_id: r.licences for r in licences.scan(spark.createDataFrame(texts, "doc_id string, text string")).collect()}
    assert got == {n: n for n, _ in texts}


def test_licence_anchors():
    assert all(any(w in said for w in licences.ANCHORS) for _, said in licences.SENTENCES) and len(licences.ANCHORS) < 12
    assert len({i for i, _ in licences.SENTENCES}) == len(licences.SENTENCES) == len({s for _, s in licences.SENTENCES})


def test_licence_sql(spark, small):
    con = duckdb.connect()
    con.sql(f"create view documents as from '{small}/documents.parquet'")
    got = queries.op8_licence_scan(spark, small)
    assert sorted(map(tuple, got.select("doc_id", "n_sentences", "sentence_ids", "licences").collect())) == sorted(con.sql(queries.oracle_sql()["op8_licence_scan"]).fetchall())


# -- 9 language


def test_language(spark, small, edge, none):
    big = small.replace("sf0.001", "sf0.01")
    got = queries.op9_language(spark, big).join(spark.read.parquet(f"{big}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (got.lang == got.lang_pred).mean() > 0.97 and got.score.between(0, 1).all()
    on_edge = {r.doc_id: r for r in langid.language_query(edge.drop("score")).collect()}
    assert on_edge[1].lang_pred == on_edge[2].lang_pred == on_edge[3].lang_pred == "und" and on_edge[1].score == 0
    assert langid.language_query(none).count() == 0
    assert {r.lang_pred for r in langid.language_query(edge.drop("score").withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_language_sample(spark):
    """A hot text counts once, a rare language is learned, and no word of the sample is left out."""
    rows = [("der hund läuft nach haus", "de")] * 300 + [(f"wort nummer {'abcdefghij'[i % 10] * (1 + i // 10)} steht hier", "de") for i in range(100)] + [("kissa istuu katolla", "fi")] + [("x", None), (None, "sv")]
    docs = spark.createDataFrame(rows, "text string, lang string")
    assert {(r.lang, r["count"]) for r in langid.sample(docs.dropna(), 1000).groupBy("lang").count().collect()} == {("de", 101), ("fi", 1)}
    some = langid.sample(docs.dropna(), 20).groupBy("lang").count().collect()
    assert {r.lang for r in some} == {"de", "fi"} and all(r["count"] < 45 for r in some)
    m = langid.fit(docs)
    assert m.languages == ["de", "fi"] and len(m.words) == len({w for t, lang in rows if t and lang for w in t.split()})
    assert m.predict(pa.array(["kissa", "hund", "katoll", "", None]))[0] == ["fi", "de", "fi", "und", "und"]


def language_by_force(train, text, longest=5):
    """Word-first backoff with dictionaries."""
    words_of, grams_of, langs = {}, {}, sorted({lang for _, lang in train})
    letters = lambda t: re.findall(r"[^\W\d_]+", (t or "").lower())
    cut = lambda w, n: [p[i : i + n] for p in ["<" + w + ">"] for i in range(len(p) - n + 1)] if n > 1 else list(w)
    for t, lang in train:
        for w in letters(t):
            words_of.setdefault(w, {}).setdefault(lang, 0)
            words_of[w][lang] += 1
            for n in range(1, longest + 1):
                for g in cut(w, n):
                    grams_of.setdefault(g, {}).setdefault(lang, 0)
                    grams_of[g][lang] += 1
    size = lambda of, lang: sum(c.get(lang, 0) for c in of.values())
    log = lambda of, x, lang: np.log(of[x].get(lang, 0) / size(of, lang) + 0.1 / max(size(of, x) for x in langs))
    total = dict.fromkeys(langs, 0.0)
    for w in letters(text):
        for lang in langs:
            if w in words_of:
                total[lang] += log(words_of, w, lang)
                continue
            for n in range(longest, 0, -1):
                if known := [g for g in cut(w, n) if g in grams_of]:
                    total[lang] += sum(log(grams_of, g, lang) for g in known) / len(known)
                    break
    top = max(total.values())
    return next(x for x in langs if total[x] == top), 1 / sum(np.exp(v - top) for v in total.values())


def test_language_by_force(spark):
    train = [("the cat sat on the mat", "en"), ("a dog ran home", "en"), ("die katze sitzt auf der matte", "de"), ("ein hund lief heim", "de"), ("le chat est assis", "fr")]
    m = langid.fit(spark.createDataFrame(train, "text string, lang string"))
    for text in ["the hound", "katzen", "chats ran", "xyz qq", "der cat", "assise sitzt"]:
        lang, score = m.predict(pa.array([text]))
        want = language_by_force(train, text)
        assert lang[0] == want[0] and abs(score[0] - want[1]) < 1e-5


# -- 10 repeated passages


def kept_by_force(rows, n=50):
    seen, out = {}, {}
    for i, x in sorted(rows, key=lambda r: r[0]):
        w = words(x)
        gone = [False] * len(w)
        for p in range(len(w) - n + 1):
            if seen.setdefault(tuple(w[p : p + n]), i) < i:
                gone[p : p + n] = [True] * n
        out[i] = (len(w), sum(gone), sha(" ".join(a for a, g in zip(w, gone, strict=True) if not g)))
    return out


@pytest.mark.parametrize("hot", [512, 3, 1])
def test_repeated_passages(spark, rows, monkeypatch, hot):
    monkeypatch.setattr(substrings, "HOT", hot)
    rng = random.Random(hot)
    passage = [f"p{i}" for i in range(120)]
    more = [r for r in rows if len(r[1]) < 6000]
    for i in range(40):  # a passage in many contexts, at varied cuts, twice in some
        lo = rng.randrange(0, 60)
        w = [f"c{rng.randrange(10**6)}" for _ in range(rng.randrange(0, 60))] + passage[lo : lo + rng.randrange(45, 70)] + [f"d{rng.randrange(10**6)}" for _ in range(rng.randrange(0, 60))]
        more.append((50_000 + i, " ".join(w * (1 + i % 7 // 6))))
    more += [(60_000, " ".join(passage[:49])), (60_001, " ".join(passage[:50])), (60_002, "same " * 200), (60_003, "same " * 60), (60_004, None), (60_005, "")]
    df = spark.createDataFrame(more, "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substrings.removed(df, substrings.settle(substrings.repeats(df)), digest=True).collect()}
    assert got == kept_by_force(more)


def test_repeated_passages_texts(spark, edge, none):
    out = substrings.removed(edge, substrings.repeats(edge))
    by = {r.doc_id: r for r in out.collect()}
    assert out.count() == 13 and by[7].text == EDGE[6][1] and by[8].text == "" and by[8].n_removed == 280 and by[1].text is None and by[None].text == "no id"
    assert substrings.removed(none, substrings.repeats(none)).count() == 0


@pytest.mark.parametrize("hot", [512, 1])
def test_repeated_passages_repeated_ids(spark, monkeypatch, hot):
    monkeypatch.setattr(substrings, "HOT", hot)
    w = [f"w{i}" for i in range(200)]
    rows = [
        (1, " ".join(w)), (5, " ".join(w)), (5, "x y " + " ".join(w[20:90]) + " z"), (5, "x y " + " ".join(w[20:90]) + " z"), (5, "  ".join(w)), (5, "none of it"), (None, " ".join(w)), (1, " ".join(w[60:130]) + " q r"),
        (7, "z " + " ".join(w[60:130]) + " q r"), (3, " ".join(f"n{i}" for i in range(80))), (3, "n " + " ".join(f"n{i}" for i in range(80))), (4, "m " + " ".join(f"n{i}" for i in range(80))),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in substrings.removed(df, substrings.settle(substrings.repeats(df)), digest=True).collect())
    seen, want = {}, []
    for i, x in rows:
        for p in range(len(words(x)) - 49) if i else ():
            key = tuple(words(x)[p : p + 50])
            seen[key] = min(i, seen.get(key, i))
    for i, x in rows:
        t = words(x)
        gone = {q for p in range(len(t) - 49) if i and seen[tuple(t[p : p + 50])] < i for q in range(p, p + 50)}
        want.append((str(i), len(t), len(gone), sha(" ".join(a for q, a in enumerate(t) if q not in gone))))
    assert got == sorted(want)


def test_repeated_passages_of_one_word(spark, monkeypatch):
    """A word or phrase again and again makes few segments, however long the text is, cut at any length."""
    column = pa.array(["same " * 50_000, "a b c " * 9_000])
    s = substrings.Segmented(column, 50, 16)
    assert (s.b - s.a).sum() < 1.5 * 77_000 and len(s.a) < 77_000 / 100
    monkeypatch.setattr(substrings, "LONGEST", 30)
    rows = [(1, "same " * 300), (2, "x " + "same " * 500), (3, "a b c " * 80), (4, "c a b " * 90 + "d"), (5, "b c " + "a b c " * 20 + "q " + "same " * 49)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substrings.removed(df, substrings.settle(substrings.repeats(df)), digest=True).collect()}
    assert got == kept_by_force(rows)


def runs_of_one_word(n=1500):
    """Documents with a run of 55 to 119 times one word, whose grams hash low, between other words: a crowded anchor."""
    rng = random.Random(1)
    other = lambda: " ".join(f"u{rng.randrange(10**7)}" for _ in range(rng.randrange(3, 20)))
    return [(i, f"{other()} {'261 ' * rng.randrange(55, 120)}{other()}") for i in range(n)]


def test_repeated_passages_of_a_crowded_word(spark):
    assert substrings.HOT == 512
    rows = runs_of_one_word()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substrings.removed(df, substrings.settle(substrings.repeats(df)), digest=True).collect()}
    assert got == kept_by_force(rows)


def test_windows_are_parts_of_their_own():
    s = substrings.Segmented(pa.array(["same " * 60, "same " * 49, "a b " * 30]), 50, 50)
    assert s.a.tolist() == [*range(11), *range(109, 120)] and (s.b - s.a == 50).all() and s.row.tolist() == [0] * 11 + [2] * 11
    assert len(set(s.content(s.a, s.b).tolist())) == 3


def test_repeated_passages_clashing_columns(spark):
    w = " ".join(f"w{i}" for i in range(60))
    df = spark.createDataFrame([(1, w, 7, "k", 5), (2, w, 8, "l", 6)], "doc_id long, text string, _text_key long, _spans string, n_words int")
    got = {r.doc_id: r for r in substrings.removed(df, substrings.repeats(df)).collect()}
    assert (got[2]._text_key, got[2]._spans, got[2].n_words, got[2].n_removed, got[1].text) == (8, "l", 60, 60, w)


def test_fm_index_counts():
    rng = np.random.default_rng(3)
    seqs = [rng.integers(1, 4, rng.integers(5, 60)) for _ in range(30)]
    symbols = np.concatenate([np.r_[s, 0] for s in seqs]).astype(np.uint64)
    owner = np.repeat(np.arange(30), [len(s) + 1 for s in seqs])
    index = fmindex.FMIndex(symbols, owner, 6)
    first = {}
    for d, s in enumerate(seqs):
        for p in range(len(s) - 5):
            first.setdefault(tuple(s[p : p + 6]), d)
    start = np.r_[0, np.cumsum([len(s) + 1 for s in seqs])][:-1]
    got = index.stream(symbols, start, start + [len(s) for s in seqs], np.arange(30))
    assert [x.tolist() for x in got] == [[p for p in range(len(s) - 5) if first[tuple(s[p : p + 6])] < d] for d, s in enumerate(seqs)]
    foreign = np.array([9, 9, *seqs[4][:7]], np.uint64)  # symbols the index lacks
    assert index.stream(foreign, np.array([0]), np.array([len(foreign)]), np.array([99]))[0].tolist() == [2, 3]


def test_sliding_least():
    g = np.random.default_rng(1).integers(0, 20, 200).astype(np.uint64)
    for width in (1, 2, 7, 35):
        value, at = substrings.sliding_least(g, width)
        assert value.tolist() == [min(g[i : i + width]) for i in range(201 - width)] and at.tolist() == [i + int(np.argmin(g[i : i + width])) for i in range(201 - width)]
