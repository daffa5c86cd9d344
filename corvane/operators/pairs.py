"""Work on all pairs of series: blocks of whole series meet, so that neither a day nor a pair is a row of a join."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import settle

#: Series in a block, about: a task holds two blocks.
SIZE = 32


def by_blocks(series: DataFrame, work: Callable[[dict, dict], pd.DataFrame], schema: str, size: int = SIZE) -> DataFrame:
    """``work`` on every pair of blocks of ``series, day, value``; a block with itself is one of them.

    ``work(some, others)`` takes arrays by name: of ``days`` (whole numbers, ascending) and ``values`` (null as 0). For a block with itself
    both are the same object. n series are sent n / ``size`` times each, and pairs are made inside tasks. Rows without a name or
    day are dropped.
    """
    rows = series.where("series is not null and day is not null").select("series", F.struct(F.unix_date("day").alias("d"), F.coalesce(F.col("value").cast("double"), F.lit(0.0)).alias("v")).alias("at"))
    whole = settle(rows.groupBy("series").agg(F.array_sort(F.collect_list("at")).alias("at")))  # as long as the calendar
    blocks = max(1, math.ceil(whole.count() / size))
    own = F.pmod(F.xxhash64("series"), F.lit(blocks)).cast("int")
    met = F.transform(F.sequence(F.lit(0), F.lit(blocks - 1)), lambda i: F.struct(F.least(i, F.col("own")).alias("p"), F.greatest(i, F.col("own")).alias("q")))
    dealt = whole.withColumn("own", own).select("series", "own", F.col("at.d").alias("days"), F.col("at.v").alias("values"), F.explode(met).alias("k"))

    def run(key: tuple, g: pd.DataFrame) -> pd.DataFrame:
        def block(b: int) -> dict:
            part = g[g.own == b].sort_values("series")
            return {s: (np.asarray(d), np.asarray(v, float)) for s, d, v in zip(part.series, part.days, part["values"], strict=True)}

        p, q = key
        some = block(p)
        return work(some, some if p == q else block(q))

    return dealt.groupBy(F.col("k.p").alias("p"), F.col("k.q").alias("q")).applyInPandas(run, schema)


def names(some: dict, others: dict, ordered: bool = False):
    """The pairs of names of two blocks, each pair once (the smaller name first), or both ways if ``ordered``."""
    for a in some:
        for b in others:
            if a != b and (some is not others or ordered or a < b):
                yield (a, b) if ordered or a < b else (b, a)
                if ordered and some is not others:
                    yield b, a


def lagged(some: dict, others: dict, most: int) -> np.ndarray:
    """``r[most + lag, i, j]``: the correlation of series i on a day and series j ``lag`` days later, over the days that both have.

    NaN for fewer than three such days and where one of the two does not vary. All pairs at once, by matrix products.
    """
    lo = min(d[0] for d, _ in [*some.values(), *others.values()])
    hi = max(d[-1] for d, _ in [*some.values(), *others.values()])

    def dense(block: dict) -> tuple[np.ndarray, np.ndarray]:
        x, there = np.zeros((2, len(block), hi - lo + 1))
        for i, (d, v) in enumerate(block.values()):
            x[i, d - lo], there[i, d - lo] = v - v.mean(), 1
        return x, there

    (x, mx), (y, my) = dense(some), dense(others)
    days, out = x.shape[1], np.full((2 * most + 1, len(x), len(y)), np.nan)
    for lag in range(-min(most, days - 1), min(most, days - 1) + 1):
        a, b = slice(max(0, -lag), days - max(0, lag)), slice(max(0, lag), days - max(0, -lag))
        u, mu, v, mv = x[:, a], mx[:, a], y[:, b], my[:, b]
        n, sx, sy, sxx, syy = mu @ mv.T, u @ mv.T, mu @ v.T, (u * u) @ mv.T, mu @ (v * v).T
        with np.errstate(invalid="ignore", divide="ignore"):
            dx, dy = sxx - sx * sx / n, syy - sy * sy / n
            r = (u @ v.T - sx * sy / n) / np.sqrt(dx * dy)
            out[most + lag] = np.where((n >= 3) & (dx > 1e-12 * sxx) & (dy > 1e-12 * syy), r, np.nan)
    return out


def lead_lag(series: DataFrame, most: int = 7, least: float = 0.1, size: int = SIZE) -> DataFrame:
    """``a, b, lag, r`` per pair (``a < b``): the lag within ``most`` days of the largest absolute correlation over ``least``. Of equal ones
    (to nine digits) the lag nearest to 0 counts, then the negative one. A series has one value a day."""
    order = sorted(range(-most, most + 1), key=lambda k: (abs(k), k))

    def work(some: dict, others: dict) -> pd.DataFrame:
        r = lagged(some, others, most)
        u, v = np.array(list(some), object), np.array(list(others), object)
        turned = u[:, None] > v[None, :]
        r = np.where(turned, r[::-1], r)[[most + k for k in order]]  # from the smaller name to the larger
        size = np.round(np.abs(np.nan_to_num(r, nan=-1.0)), 9) * np.where(np.isnan(r), -1, 1)
        best = size.argmax(axis=0)
        value = np.take_along_axis(r, best[None], 0)[0]
        keep = np.abs(np.nan_to_num(value)) > least
        if some is others:
            keep &= u[:, None] < v[None, :]
        i, j = np.nonzero(keep)
        a, b = np.where(turned[i, j], v[j], u[i]), np.where(turned[i, j], u[i], v[j])
        return pd.DataFrame({"a": a, "b": b, "lag": np.array(order)[best[i, j]], "r": value[i, j]})

    return by_blocks(series, work, "a string, b string, lag int, r double", size)
