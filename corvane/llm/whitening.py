"""Whitening of embeddings: principal axes of the covariance by cyclic Jacobi rotations, the vectors projected on them.

Entries become whole numbers first. Each task gives sums of its whole vectors, then, of vectors less the rounded mean, the
upper half of the sums of products; both are whole numbers, added exactly by Spark, so the scatter is the same
whatever the partitions. The driver gets one number a dimension and one a pair of dimensions. It rotates pairs of
dimensions in turn until nothing is left beside the diagonal (small eigenvalues keep their relative accuracy), sorts,
and sends out the axes: a matrix of dimensions x components.

Cases: null vectors and vectors with a null, an infinite entry or none go; so do vectors whose length isn't the commonest
one (the longer one on a tie). Extra columns are ignored; rows that repeat an id, or its vector, are rows of their own. An axis
without variance (one vector, all equal, or more dimensions than vectors) has a null ``whitened`` and explains 0. A
``deviation`` that no long can hold is null. Entries beyond 2**43 (as whole numbers beyond 2**53) count as that. No vectors, no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import settle

SCALE, OFFSET, COMPONENTS = 1024, 100_000, 8
_BOUND = 2.0**53
_LONG = 2**63 - 1
_SUMS = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("s", pa.decimal128(38, 0))])


def whole(vectors: pa.Array) -> np.ndarray:
    """Rows of whole numbers from a list column whose rows have one length."""
    n = len(vectors)
    c = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)
    return np.clip(np.floor(c * SCALE), -_BOUND, _BOUND).astype(np.int64) + OFFSET


def products(z: np.ndarray) -> np.ndarray:
    """``z.T @ z`` exactly: in floats while no sum can pass 2**53, else in Python's whole numbers."""
    most = int(np.abs(z).max(initial=0))
    step = int(_BOUND) // (most * most) if most else len(z)
    if step < 1:
        z = z.astype(object)
        return z.T @ z
    total = np.zeros((z.shape[1], z.shape[1]), object)
    for i in range(0, len(z), max(1, step)):
        f = z[i : i + step].astype(np.float64)
        total += (f.T @ f).astype(np.int64).astype(object)
    return total


def remaining(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """The rows whose vector is whole, finite, and of the commonest length."""
    v = F.col(vector)
    ok = vectors.where(v.isNotNull() & (F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    sizes = ok.groupBy(F.size(v).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return ok.where(F.size(v) == (sizes.d if sizes else 0))


def scatter(rows: DataFrame, vector: str = "embedding") -> tuple[int, list[int], list[list[int]]]:
    """Vectors, sums of each dimension, and n**2 times the covariance, all exact whole numbers."""

    def decimals(at: list[tuple[int, int]], of: list[int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([i for i, _ in at], pa.int32()), pa.array([j for _, j in at], pa.int32()), pa.array([Decimal(int(x)) for x in of], pa.decimal128(38, 0))], schema=_SUMS)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for b in batches:
            if b.num_rows:
                x = whole(b.column(0))
                n, total = n + len(x), x.astype(object).sum(axis=0) + (0 if total is None else total)
        if n:
            yield decimals([(-1, -1), *((i, i) for i in range(len(total)))], [n, *total])

    def centred(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = 0, False
        for b in batches:
            if b.num_rows:
                total, seen = products(whole(b.column(0)) - centre) + total, True
        if seen:
            yield decimals(*zip(*(((i, j), total[i, j]) for i in range(d) for j in range(i, d)), strict=True))

    one = rows.select(vector)
    told = {r.i: int(r.s) for r in one.mapInArrow(sums, "i int, j int, s decimal(38,0)").groupBy("i", "j").agg(F.sum("s").alias("s")).collect()}  # a row a dimension
    n = told.pop(-1, 0)
    d = len(told)
    s = [told[i] for i in range(d)]
    centre = np.array([(2 * x + n) // (2 * n) for x in s], np.int64) if n else np.zeros(0, np.int64)
    rest = [x - n * int(c) for x, c in zip(s, centre, strict=True)]  # sums of what is centred
    v = [[0] * d for _ in range(d)]
    if n:
        for r in one.mapInArrow(centred, "i int, j int, s decimal(38,0)").groupBy("i", "j").agg(F.sum("s").alias("s")).collect():  # a row a pair of dimensions
            v[r.i][r.j] = v[r.j][r.i] = n * int(r.s) - rest[r.i] * rest[r.j]
    return n, s, v


def jacobi(a: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix, by cyclic rotations.

    A rotation is left out where the entry is nothing beside its diagonal entries; a sweep without any ends it.
    """
    a, d = np.array(a, np.float64), len(a)
    v = np.eye(d)
    for _ in range(sweeps):
        turned = False
        for p in range(d - 1):
            for q in range(p + 1, d):
                x = a[p, q]
                if abs(x) <= 1e-17 * np.sqrt(abs(a[p, p] * a[q, q])) or abs(x) < 1e-300:
                    continue
                turned = True
                theta = (a[q, q] - a[p, p]) / (2 * x)
                t = (1.0 if theta >= 0 else -1.0) / (abs(theta) + np.hypot(theta, 1.0))
                c = 1 / np.hypot(t, 1.0)
                s = t * c
                ap, aq, app, aqq = a[:, p].copy(), a[:, q].copy(), a[p, p], a[q, q]
                a[:, p] = a[p, :] = c * ap - s * aq
                a[:, q] = a[q, :] = s * ap + c * aq
                a[p, p], a[q, q], a[p, q], a[q, p] = app - t * x, aqq + t * x, 0.0, 0.0
                vp = v[:, p].copy()
                v[:, p], v[:, q] = c * vp - s * v[:, q], s * vp + c * v[:, q]
        if not turned:
            break
    e = np.diag(a)
    order = np.argsort(-e, kind="stable")
    return e[order], v[:, order]


def axes(n: int, v: list[list[int]], components: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the leading components: eigenvalues (0 where nothing but rounding is left), unit axes (columns), shares of the trace."""
    a = np.array([[x / (n * n) for x in row] for row in v], np.float64).reshape(len(v), len(v))
    e, u = jacobi(a)
    trace = sum(v[i][i] for i in range(len(v))) / (n * n)
    e = np.where(e > len(v) * np.finfo(float).eps * max(e.max(initial=0), 0), e, 0.0)[:components]
    return e, u[:, :components], e / trace if trace else e * 0.0


def project(rows: DataFrame, n: int, s: list[int], e: np.ndarray, u: np.ndarray, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``KEY, deviation, whitened``: each vector's squared distance from the mean (n times both), and its coordinates."""
    scale = np.divide(1.0, np.sqrt(e), out=np.full(len(e), np.nan), where=e > 0)
    total = np.array(s, object)
    centre = np.array([(2 * x + n) // (2 * n) for x in s], np.int64)
    rest = np.array([(x - n * int(c)) / n for x, c in zip(s, centre, strict=True)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = whole(b.column(1))
            most = max(abs(n * int(x[:, i].min()) - t) for i, t in enumerate(s)), max(abs(n * int(x[:, i].max()) - t) for i, t in enumerate(s))
            if max(most) ** 2 * x.shape[1] <= _LONG and n * int(np.abs(x).max()) <= _LONG and max(map(abs, s)) <= _LONG:
                deviation = ((n * x - total.astype(np.int64)) ** 2).sum(axis=1).tolist()
            else:  # too large for 64 bits on the way
                deviation = [y if y <= _LONG else None for y in ((n * x.astype(object) - total) ** 2).sum(axis=1)]
            w = (((x - centre) - rest) @ u) * scale
            coordinates = pa.ListArray.from_arrays(pa.array(np.arange(0, w.size + 1, w.shape[1]), pa.int32()), pa.array(w.ravel(), from_pandas=True))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(deviation, pa.int64()), coordinates], ["vec_id", "deviation", "whitened"])

    kind = rows.schema[key].dataType.simpleString()
    return rows.select(key, vector).mapInArrow(work, f"vec_id {kind}, deviation long, whitened array<double>")


def identity_error(whitened: DataFrame, components: int) -> float | None:
    """The largest absolute entry of the covariance of ``whitened`` (over axes with variance) less the identity."""
    means = whitened.agg(*(F.avg(F.get("whitened", F.lit(k))).alias(f"m{k}") for k in range(components))).first()
    held = [k for k in range(components) if means[k] is not None]
    if not held:
        return None
    of = lambda k: F.get("whitened", F.lit(k)) - F.lit(means[k])
    cov = whitened.agg(*(F.avg(of(i) * of(j)).alias(f"c{i}_{j}") for i in held for j in held if i <= j)).first()
    return max(abs(cov[f"c{i}_{j}"] - (i == j)) for i in held for j in held if i <= j)


def whiten(vectors: DataFrame, components: int = COMPONENTS, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of each remaining vector and component."""
    spark, kind = vectors.sparkSession, vectors.schema[key].dataType.simpleString()
    out = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = remaining(vectors.select(key, vector), vector)
    n, s, v = scatter(rows, vector)
    if not n:
        return spark.createDataFrame([], out)
    e, u, share = axes(n, v, components)
    told = settle(project(rows, n, s, e, u, key, vector))
    error = identity_error(told, len(e))
    shares = F.array(*(F.lit(float(x)) for x in share))
    each = told.select("vec_id", "deviation", F.posexplode("whitened").alias("k", "whitened"))
    return each.select("vec_id", (F.col("k") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened", F.get(shares, F.col("k")).alias("explained"), F.lit(error).cast("double").alias("identity_error"))
