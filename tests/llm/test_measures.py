"""Quality rules, the manifest and whitening against brute force and SQL, with edge cases."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from corvane.llm import manifest, qualityrules, queries, whitening

from .test_ops import EDGE, sha, words

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def by_sql(spark, name, rows, schema=SCHEMA):
    """The query's SQL over these rows as ``documents``."""
    con = duckdb.connect()
    con.sql("create table documents (doc_id bigint, text varchar, lang varchar, source varchar, n_chars bigint)")
    if rows:
        con.executemany("insert into documents values (?, ?, ?, ?, ?)", rows)
    return sorted(con.sql(queries.oracle_sql()[name]).fetchall(), key=repr)


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# -- 11 quality rules


def measured_by_force(text):
    w = words(text)
    at = defaultdict(list)
    for i in range(len(w) - 4):
        at[tuple(w[i : i + 5])].append(i)
    again = {p for places in at.values() if len(places) > 1 for i in places for p in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines), len(lines) - len(set(lines)), len(again)


TEXTS = [t for _, t in EDGE] + [
    "a b c d e a b c d e", "a b c d e f a b c d e", "x\nx\n \nx\ny\n\n", "#*$%&|<> ok ###", "é🙂     x", "a\x0bb\x0cc\rd\te", "same\n" * 40_000, "\n".join(f"l{i % 7} w{i}" for i in range(9_000)), "one two three four five " * 3 + "end", "-" * 200_000,
]


def test_measures(spark):
    df = spark.createDataFrame([(i, t, "en", "s", None) for i, t in enumerate(TEXTS)], SCHEMA)
    got = {r.doc_id: tuple(r)[3:] for r in qualityrules.measured(df).collect()}
    assert got == {i: measured_by_force(t) for i, t in enumerate(TEXTS)}


def corpus(n=900):
    rng, rows = random.Random(3), []
    for i in range(n):
        lang, source = rng.choice(["en", "de", None]), "big" if i % 2 else rng.choice(["s1", "s2", None])
        t = " ".join("w" * rng.randrange(2, 9 if lang == "en" else 14) + str(rng.randrange(10**6)) for _ in range(rng.randrange(5, 80)))
        if i % 31 == 0:
            t = " ".join(x + "###" for x in t.split())
        if i % 37 == 0:
            t += "\nagain and again\nagain and again\nagain and again"
        rows.append((i // 2 if i % 50 == 0 else i, t, lang, source, len(t)))
    return rows + [(10_000 + i, t, "xx", None, 0) for i, t in enumerate(TEXTS)] + [(None, "no id at all " * 5, None, None, None)] * 2


def test_verdicts_by_sql(spark):
    rows = corpus()
    got = collected(qualityrules.filtered(spark.createDataFrame(rows, SCHEMA).repartition(7)))
    assert got == by_sql(spark, "op11_quality_rules", rows)
    verdict = {r[0]: r[-1] for r in got}
    assert not any(verdict[i] for i in range(0, 900, 31) if i % 50) and sum(verdict.values()) > 700  # junk goes, most stay


def test_sketches_merge():
    def bucket(v):
        over = v.bit_length() - 7
        return v if v < 128 else over * 64 + (v >> over)

    for v in [*range(300), 2**20 - 1, 2**20, 10**9]:
        b = bucket(v)
        over = b // 64 - 1
        low, high = (b, b) if b < 128 else ((b - over * 64) << over, ((b - over * 64 + 1) << over) - 1)
        assert low <= v <= high and high - low <= low / 64


def test_buckets(spark):
    v = [*range(300), 2**20 - 1, 2**20, 2**31 + 5, 10**12]
    low, high = qualityrules.edges(F.col("b"))
    rows = spark.createDataFrame([(x,) for x in v], "v long").withColumn("b", qualityrules.bucket(F.col("v"))).select("v", "b", low.alias("lo"), high.alias("hi")).collect()
    assert all(r.lo <= r.v <= r.hi and (r.hi - r.lo) * 64 <= max(r.lo, 1) * 1 or r.lo == r.hi == r.v for r in rows)
    assert [r.b for r in rows] == sorted(r.b for r in rows)


def test_rules_edge(spark):
    clash = spark.createDataFrame([(1, "a b c", "en", "s", 7, 8, "x", True)], "doc_id long, text string, lang string, source string, n_words long, fences long, _lang string, kept boolean")
    assert collected(qualityrules.filtered(clash)) == [(1, 3, 3, 0, 0, 0, True, False)]
    assert qualityrules.filtered(spark.createDataFrame([], SCHEMA)).count() == 0


def test_rules_plan_is_native(spark, small):
    plan = queries.op11_quality_rules(spark, small)._jdf.queryExecution().toString()
    measures = qualityrules.measured(spark.read.parquet(f"{small}/documents.parquet"))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan + measures)


# -- 12 manifest


def leaf_by_force(row):
    doc, text, lang, source, n = row
    return sha("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in (doc, source, lang, n, text)))


def tree_by_force(digests):
    """Root and, for each leaf, (place, run) at every level."""
    levels = [digests]
    while len(levels[-1]) > 1:
        x = levels[-1]
        levels.append([sha("".join(x[i : i + 8])) for i in range(0, len(x), 8)])
    paths = []
    for at in range(len(digests)):
        path = []
        for x in levels[:-1]:
            path.append((at % 8, x[at - at % 8 : at - at % 8 + 8]))
            at //= 8
        paths.append(path)
    return levels[-1][0], paths


def manifest_by_force(rows):
    by = defaultdict(list)
    for r in rows:
        by[r[2]].append(r)
    order = sorted(by, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        by[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_by_force(r)))
        trees[g] = tree_by_force([leaf_by_force(r) for r in by[g]])
    root, tops = tree_by_force([trees[g][0] for g in order]) if order else (None, [])
    out = []
    for g, top in zip(order, tops, strict=True):
        for r, own in zip(by[g], trees[g][1], strict=True):
            path = own + top
            low = None if r[1] is None else re.sub("[A-Z]", lambda m: m[0].lower(), r[1])
            fold = leaf_by_force((r[0], low, *r[2:])) if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 else leaf_by_force(r)
            for at, run in path:
                fold = sha("".join(run[:at]) + fold + "".join(run[at + 1 :]))
            proof = sha("".join("".join(run[:at] + run[at + 1 :]) for at, run in path))
            out.append((r[0], leaf_by_force(r), trees[g][0], root, proof, fold, fold == root))
    return sorted(out, key=repr)


@pytest.mark.parametrize("stratum", [1, 2, 3])
def test_traversal(stratum):
    for n in (1, 2, 8, 9, 63, 64, 65, 71, 72, 73, 511, 512, 513, 600, 1000, 4096):
        digests = [sha(str(i)) for i in range(n)]
        root, want = tree_by_force(digests)
        levels = manifest.height(n)
        assert manifest.block_root(digests, levels) == root
        got = list(manifest.traverse(digests, levels, stratum))
        assert got == [[(at, "".join(run[:at] + run[at + 1 :])) for at, run in path] for path in want]
        assert manifest.folded(digests[-1], got[-1]) == root


def test_partial_block_goes_up():
    """The last block of a larger tree: one leaf still becomes a run of one on each level."""
    assert manifest.block_root(["x"], 3) == sha(sha(sha("x"))) and list(manifest.traverse(["x"], 3)) == [[(0, ""), (0, ""), (0, "")]]


def documents(n):
    rng, rows = random.Random(n), []
    for i in range(n):
        rows.append((i * 7 - 50, rng.choice(["Ab\nC", "ÄÖ Zz", "", None, "plain"]) if i % 3 else f"Text {i}", rng.choice(["en", "en", "en", "de", "é", "", None]) if n > 1 else "en", rng.choice(["s", None]), rng.choice([None, i, -1])))
    rows += rows[:3] * 2 + [(None, "No Id", "en", "s", 1), (None, "No Id", "en", "s", 1), (5, "Second Of An Id", "en", "s", 1), (5, "third", "en", None, 1)] if n > 1 else []
    return rows


@pytest.mark.parametrize("n", [0, 1, 40, 900])
def test_manifest(spark, monkeypatch, n):
    rows = documents(n)
    if n > 40:  # blocks of 64: three rounds of blocks
        monkeypatch.setattr(manifest, "LEVELS", 2)
        monkeypatch.setattr(manifest, "BLOCK", 64)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5).withColumn("tree", F.lit("clash")).withColumn("pos", F.lit(1)).withColumn("digest", F.lit(2))
    got = collected(manifest.manifest(df))
    assert got == manifest_by_force(rows) == by_sql(spark, "op12_manifest", rows)
    assert n < 40 or any(r[-1] for r in got) and any(not r[-1] for r in got)


def test_manifest_of_many_languages(spark, monkeypatch):
    monkeypatch.setattr(manifest, "LEVELS", 1)
    monkeypatch.setattr(manifest, "BLOCK", 8)
    rows = [(i, "T" * (i % 5), f"l{i % 75}", None, None) for i in range(200)]
    assert collected(manifest.manifest(spark.createDataFrame(rows, SCHEMA))) == manifest_by_force(rows)


def test_manifest_ranges_split_a_tree(spark):
    """No range and no block holds a whole language."""
    rows = [(i, f"t{i}", "en", "s", 1) for i in range(9_000)]
    df = manifest.numbered(manifest.leaves(spark.createDataFrame(rows, SCHEMA)), "tree", ["doc_id", "digest", "row"])
    assert sorted((r.doc_id, r.pos, r.n) for r in df.collect()) == [(i, i, 9_000) for i in range(9_000)]
    of = manifest.blocks(df, ["doc_id"])
    assert sorted(r.c for r in of.select(F.size("items").alias("c")).collect()) == [808, 4096, 4096]


# -- 13 whitening


def whitened_by_force(rows, components=8):
    kept = [(i, v) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    sizes = Counter(len(v) for _, v in kept)
    d = max(sizes, key=lambda k: (sizes[k], k)) if sizes else 0
    kept = [(i, v) for i, v in kept if len(v) == d]
    if not kept:
        return [], None
    x = [[math.floor(1024 * float(c)) + 100_000 for c in v] for _, v in kept]
    n, s = len(x), [sum(c) for c in zip(*x, strict=True)]
    dev = [sum((n * a - b) ** 2 for a, b in zip(r, s, strict=True)) for r in x]
    m = np.array([[(n * a - b) / n for a, b in zip(r, s, strict=True)] for r in x])
    cov = m.T @ m / n
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1], u[:, ::-1]
    return [(i, n, q, [(m[r] @ u[:, k]) / math.sqrt(e[k]) if e[k] > 1e-9 else None for k in range(min(components, d))]) for r, ((i, _), q) in enumerate(zip(kept, dev, strict=True))], e / e.sum() if e.sum() > 0 else e * 0


def test_whitening(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(12, 12))
    rows = [(i, [float(x) for x in rng.normal(size=12) @ base]) for i in range(400)]
    rows += [(500, None), (501, [None] * 12), (502, [1.0] * 11 + [float("nan")]), (503, [float("inf")] + [0.0] * 11), (504, []), (505, [1.0] * 5), (3, rows[3][1]), (3, [0.0] * 12), (None, [0.5] * 12)] + [(600, rows[7][1])] * 90
    df = spark.createDataFrame([(a, b, "x", 1) for a, b in rows], "vec_id long, embedding array<double>, component string, n int").repartition(6)
    got = whitening.whiten(df).collect()
    want, share = whitened_by_force(rows)
    assert len(got) == 8 * len(want) and got[0].identity_error < 1e-9 and len({r.identity_error for r in got}) == 1
    assert all(abs(r.explained - share[r.component - 1]) < 1e-10 for r in got)
    sign = {}
    told = defaultdict(list)
    for i, n, q, w in want:
        told[i].append((n, q, w))
    for r in got:
        fits = [(n, q, w[r.component - 1]) for n, q, w in told[r.vec_id] if (n, q) == (r.n, r.deviation)]
        assert fits and min(abs(abs(w) - abs(r.whitened)) for *_, w in fits) < 1e-8
        if abs(r.whitened) > 1e-3 and len(fits) == 1:
            sign.setdefault(r.component, set()).add(bool(fits[0][2] * r.whitened > 0))
    assert all(len(x) == 1 for x in sign.values())  # an axis points one way for all rows


def test_whitening_edge(spark):
    kind = "vec_id long, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], kind)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None), (2, []), (3, [None])], kind)).count() == 0
    one = whitening.whiten(spark.createDataFrame([(1, [0.5, 2.0, -1.0])], kind)).collect()
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(k, 1, 0, None, 0.0, None) for k in (1, 2, 3)]
    flat = whitening.whiten(spark.createDataFrame([(1, [1.0, 0.0]), (2, [2.0, 0.0])], kind)).collect()
    assert sorted((r.vec_id, r.component, r.n, r.deviation, r.whitened and abs(r.whitened), r.explained) for r in flat) == [(1, 1, 2, 1024**2, 1.0, 1.0), (1, 2, 2, 1024**2, None, 0.0), (2, 1, 2, 1024**2, 1.0, 1.0), (2, 2, 2, 1024**2, None, 0.0)]
    huge = whitening.whiten(spark.createDataFrame([(1, [1e300]), (2, [-1e300]), (3, [0.0])], "vec_id long, embedding array<double>")).collect()
    assert {r.vec_id: r.deviation for r in huge} == {1: None, 2: None, 3: 0} and all(abs(r.explained - 1) < 1e-12 for r in huge)


def test_jacobi_keeps_small_eigenvalues():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 10))
    a = x.T @ x
    e, u = whitening.jacobi(a)
    w, _ = np.linalg.eigh(a)
    assert np.allclose(e, w[::-1], rtol=1e-12) and np.allclose(u.T @ u, np.eye(10), atol=1e-13) and np.allclose(u.T @ a @ u, np.diag(e), atol=1e-10)
    scale = np.diag([10.0**-k for k in range(10)])  # graded: the least is 1e-18 of the largest
    graded, _ = whitening.jacobi(scale @ a @ scale)
    assert (graded > 0).all() and abs(np.prod(graded / np.diag(scale) ** 2) / np.linalg.det(a) - 1) < 1e-9


def test_exact_products():
    rng = np.random.default_rng(4)
    for high in (5, 10**6, 2**30, 2**40):
        z = rng.integers(-high, high, (50, 3))
        assert whitening.products(z).tolist() == (z.astype(object).T @ z.astype(object)).tolist()
