"""Causal discovery over daily series: condition sets by partial correlations, then momentary conditional independence.

A target is one task's work; what it needs of the others is the matrix of the chosen series, bounded by how many are chosen and by
the calendar.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import settle
from .grouped import beta_cdf

Link = tuple[int, int]  # variable, lag


def partial(x: np.ndarray, a: Link, b: Link, given: list[Link], cut: int) -> tuple[float, float]:
    """The partial correlation of two lagged columns of ``x`` (days x variables) given others, and its p-value (Student's t, two-sided)."""
    n = len(x) - cut
    take = lambda v: x[cut - v[1] : len(x) - v[1], v[0]]

    def standard(v: np.ndarray) -> np.ndarray:
        s = v.std()
        return (v - v.mean()) / s if s > 0 else v * 0.0

    p, q = standard(take(a)), standard(take(b))
    if given:
        z = np.column_stack([standard(take(v)) for v in given])
        p, q = (y - z @ np.linalg.lstsq(z, y, rcond=None)[0] for y in (p, q))
    free = n - 2 - len(given)
    size = float(np.sqrt((p @ p) * (q @ q)))
    if free < 1 or size < 1e-12:
        return 0.0, 1.0
    r = float(np.clip(p @ q / size, -1, 1))
    return r, beta_cdf(1 - r * r, free / 2, 0.5) if abs(r) < 1 else 0.0  # free / (free + t^2) is 1 - r^2


def parents(x: np.ndarray, target: int, lags: int, alpha: float) -> list[Link]:
    """Lagged variables that no set of the strongest others makes independent of the target: strongest first.

    With p = 0, 1, ... conditions each candidate is tested given the p strongest others; those over ``alpha`` go after the round.
    """
    left = [(i, lag) for i in range(x.shape[1]) for lag in range(1, lags + 1)]
    strength = dict.fromkeys(left, np.inf)
    p = 0
    while len(left) > p:
        gone = set()
        for c in left:
            r, value = partial(x, c, (target, 0), [o for o in left if o != c][:p], 2 * lags)
            strength[c] = min(strength[c], abs(r))
            if value > alpha:
                gone.add(c)
        left = sorted((c for c in left if c not in gone), key=lambda c: (-strength[c], c))
        p += 1
    return left


def momentary(x: np.ndarray, target: int, of: list[list[Link]], lags: int) -> list[tuple[int, int, float, float]]:
    """``cause, lag, r, p`` of each lagged variable on the target, given the target's parents and the cause's own, shifted."""
    out = []
    for i in range(x.shape[1]):
        for lag in range(1, lags + 1):
            given = [v for v in of[target] if v != (i, lag)]
            given += [v for v in ((k, m + lag) for k, m in of[i]) if v not in given and v != (i, lag)]
            out.append((i, lag, *partial(x, (i, lag), (target, 0), given, 2 * lags)))
    return out


def false_discovery(rows: DataFrame, p: str = "p") -> DataFrame:
    """``rows`` with ``q``: p-values corrected by Benjamini and Hochberg over all rows (few: pairs of the chosen series and lags)."""
    n = rows.agg(F.count("*").alias("_n"))
    up, down = Window.orderBy(p, *(c for c in rows.columns if c != p)), Window.orderBy(F.desc("_k")).rowsBetween(Window.unboundedPreceding, 0)
    ranked = rows.withColumn("_k", F.row_number().over(up)).crossJoin(F.broadcast(n))  # one row
    return ranked.withColumn("q", F.least(F.lit(1.0), F.min(F.col(p) * F.col("_n") / F.col("_k")).over(down))).drop("_k", "_n")


def pcmci(series: DataFrame, top: int = 20, lags: int = 7, fallback: int = 3, alpha: float = 0.05) -> DataFrame:
    """``cause, effect, lag, correlation, p, q, significant, lags`` of the ``top`` series by volume (``series, day, value``, dense): how each
    other series foretells an effect at each lag, beyond what the parents of both tell; ``q`` is corrected over all rows.

    Series that are too short for ``lags`` go by ``fallback``; too short for that, or a single one: no rows. Missing values are 0.
    """
    best = series.groupBy("series").agg(F.sum(F.coalesce("value", F.lit(0.0))).alias("volume")).orderBy(F.desc("volume"), "series").limit(top)  # a few rows
    whole = series.join(F.broadcast(best.select("series")), "series", "left_semi").groupBy("series").agg(F.transform(F.array_sort(F.collect_list(F.struct("day", F.coalesce("value", F.lit(0.0)).alias("v")))), lambda s: s["v"]).alias("x"))
    rows = whole.groupBy().agg(F.array_sort(F.collect_list(F.struct("series", "x"))).alias("all")).where(F.size("all") > 1)  # top x days values
    days = F.array_min(F.transform("all", lambda s: F.size(s["x"])))
    enough = lambda k: days - 2 * k > 2 * k + 4
    rows = rows.withColumn("lags", F.when(enough(lags), lags).when(enough(fallback), fallback)).where("lags is not null")
    rows = settle(rows.select("all", "lags", F.posexplode("all").alias("target", "_t")).drop("_t").repartition(top, "target"))

    def matrix(every: list) -> np.ndarray:
        n = min(len(s["x"]) for s in every)
        return np.column_stack([np.asarray(s["x"], float)[:n] for s in every])

    def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for every, k, target in pdf[["all", "lags", "target"]].itertuples(index=False):
                found = parents(matrix(every), target, k, alpha)
                yield pd.DataFrame({"target": [target], "of": [[[int(i), int(m)] for i, m in found]]})

    known = rows.mapInPandas(first, "target int, of array<array<int>>").groupBy().agg(F.array_sort(F.collect_list(F.struct("target", "of"))).alias("known"))  # a row a series
    rows = rows.crossJoin(F.broadcast(settle(known)))  # one row

    def second(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for every, k, target, told in pdf[["all", "lags", "target", "known"]].itertuples(index=False):
                of = [[tuple(map(int, v)) for v in t["of"]] for t in told]
                names = [s["series"] for s in every]
                made = [(names[i], names[target], lag, r, p, k) for i, lag, r, p in momentary(matrix(every), target, of, k) if i != target]
                yield pd.DataFrame(made, columns=["cause", "effect", "lag", "correlation", "p", "lags"])

    links = settle(rows.mapInPandas(second, "cause string, effect string, lag int, correlation double, p double, lags int"))
    out = false_discovery(links)
    return out.select("cause", "effect", "lag", "correlation", "p", "q", (F.col("q") < alpha).alias("significant"), "lags")
