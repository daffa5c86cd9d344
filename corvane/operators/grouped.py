"""Numeric work on one series at a time, in grouped pandas functions over NumPy: bursts, changepoints, decomposition,
cycles, causality, alignment. A group is a daily series, so its size is bounded by the calendar."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import settle
from .pairs import by_blocks, names

#: Series in a block where a pair is dear, so that few series still make several tasks.
FEW = 4


def per_series(series: DataFrame, work, schema: str, by: tuple[str, ...] = ("series",)) -> DataFrame:
    """Apply ``work(values, days) -> DataFrame`` to each series in the order of its days (missing values are 0)."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("day")
        out = work(rows["value"].fillna(0).to_numpy(float), rows["day"].to_numpy())
        for name, value in zip(by, key, strict=True):
            out.insert(0, name, value)
        return out

    return series.groupBy(*by).applyInPandas(run, ", ".join(f"{c} string" for c in by) + ", " + schema)


def kleinberg(x: np.ndarray, base: float = 2.0, gamma: float = 1.0) -> np.ndarray:
    """Burst states of counts: the cheapest path through Poisson rates that grow by ``base``; going up costs."""
    n, mean = len(x), max(x.mean(), 1e-9)
    k = min(10, max(2, 1 + math.ceil(math.log(max(x.max(), 1.0)))))
    rates = mean * base ** np.arange(k)
    cost = rates[None, :] - x[:, None] * np.log(rates)[None, :]
    up = gamma * math.log(max(n, 2)) * np.maximum(np.arange(k)[None, :] - np.arange(k)[:, None], 0)
    best, back = cost[0] + up[0], np.zeros((n, k), int)
    for t in range(1, n):
        total = best[:, None] + up
        back[t] = total.argmin(axis=0)
        best = total.min(axis=0) + cost[t]
    state = np.zeros(n, int)
    state[-1] = best.argmin()
    for t in range(n - 1, 0, -1):
        state[t - 1] = back[t, state[t]]
    return state


def burst_scores(x: np.ndarray, state: np.ndarray) -> np.ndarray:
    """Level times duration times volume of each stretch above the base state, on all its days."""
    out, edges = np.zeros(len(x)), np.flatnonzero(np.diff(np.r_[0, state > 0, 0]))
    for lo, hi in zip(edges[::2], edges[1::2], strict=True):
        out[lo:hi] = state[lo:hi].max() * (hi - lo) * x[lo:hi].sum()
    return out


def bursts(series: DataFrame) -> DataFrame:
    def work(x, days):
        s = kleinberg(x)
        return pd.DataFrame({"day": days, "state": s, "burst_score": burst_scores(x, s)})

    return per_series(series, work, "day date, state long, burst_score double")


def squared_cost(x: np.ndarray) -> Callable[[int, int], float]:
    """The cost of a stretch as one level: its squared distances from its mean, of the standardised series."""
    x = (x - x.mean()) / (x.std() or 1.0)
    s1, s2 = np.r_[0, x.cumsum()], np.r_[0, (x**2).cumsum()]
    return lambda a, b: s2[b] - s2[a] - (s1[b] - s1[a]) ** 2 / (b - a)


def kernel_cost(x: np.ndarray) -> Callable[[int, int], float]:
    """The cost of a stretch as one distribution: its rows' spread in the space of a Gaussian kernel, as wide as the median distance.

    Sums of the Gram matrix over any square come from its double cumulative sum.
    """
    d = (x[:, None] - x[None, :]) ** 2
    middle = float(np.median(d[np.triu_indices(len(x), 1)])) if len(x) > 1 else 0.0
    gram = np.exp(-np.clip(d / (middle or 1.0), 1e-2, 1e2) * (d > 0))
    total = np.zeros((len(x) + 1, len(x) + 1))
    total[1:, 1:] = gram.cumsum(axis=0).cumsum(axis=1)
    return lambda a, b: (b - a) - (total[b, b] - total[a, b] - total[b, a] + total[a, a]) / (b - a)


def pelt(x: np.ndarray, least: int = 3, penalty: float | None = None, cost: Callable = squared_cost, jump: int = 1) -> list[int]:
    """Changepoints that minimise cost and penalties, exactly, by pruned dynamic programming: stretches of ``least`` or more, cut at
    multiples of ``jump``."""
    n = len(x)
    if n < 2 * least:
        return []
    of = cost(x)
    penalty = math.log(n) if penalty is None else penalty
    best, last, open_ = np.full(n + 1, np.inf), np.zeros(n + 1, int), [0]
    best[0] = -penalty
    for t in [*range(jump, n, jump), n]:
        costs = [(best[s] + of(s, t) + penalty, s) for s in open_ if t - s >= least]
        if not costs:
            continue
        best[t], last[t] = min(costs)
        open_ = [s for s in open_ if t - s < least or best[s] + of(s, t) <= best[t]] + [t]
    out, t = [], n
    while t:
        t = int(last[t])
        if t:
            out.append(t)
    return out[::-1]


def changepoints(series: DataFrame, permutations: int = 20, seed: int = 42, penalty: float | None = None, cost: Callable = kernel_cost, jump: int = 5) -> DataFrame:
    """Changepoints with one significance a series: the share of shuffles that explain less variance."""

    def work(x, days):
        at = pelt(x, penalty=penalty, cost=cost, jump=jump)
        explained = lambda v, cuts: v.var() - sum(p.var() * len(p) for p in np.split(v, cuts)) / len(v)
        rng = np.random.default_rng(seed)
        significance = float(np.mean([explained(rng.permutation(x), at) < explained(x, at) for _ in range(permutations)])) if at else 0.0
        return pd.DataFrame({"day": days[at], "significance": significance})

    return per_series(series, work, "day date, significance double")


def shift_points(shifts: DataFrame, penalty: float = 3.0) -> DataFrame:
    """``shifts`` (``topic_id, day, kl``) with ``changed``: whether the topic's divergences change level on that day."""
    at = changepoints(shifts.where("kl is not null").select(F.col("topic_id").cast("string").alias("series"), "day", F.col("kl").alias("value")), 1, penalty=penalty, cost=squared_cost, jump=1)
    at = at.select(F.col("series").cast(shifts.schema["topic_id"].dataType).alias("topic_id"), "day", F.lit(True).alias("changed"))
    return shifts.join(at, ["topic_id", "day"], "left").select("topic_id", "day", "kl", F.coalesce("changed", F.lit(False)).alias("changed"))


def loess(x: np.ndarray, y: np.ndarray, span: int, at: np.ndarray | None = None, weights: np.ndarray | None = None) -> np.ndarray:
    """Local linear fits, at ``at`` or each point, with tricube weights over the ``span`` nearest points (times ``weights``)."""
    at = x if at is None else at
    d = np.abs(at[:, None] - x[None, :])
    width = np.sort(d, axis=1)[:, min(span, len(x)) - 1] + max(span - len(x), 0) / 2
    w = np.clip(1 - (d / np.maximum(width * 1.001, 1e-9)[:, None]) ** 3, 0, None) ** 3 * (1 if weights is None else weights)
    bare = w.sum(axis=1) <= 1e-12  # nothing there but outliers: as if they were none
    if bare.any():
        w[bare] = np.clip(1 - (d[bare] / np.maximum(width[bare] * 1.001, 1e-9)[:, None]) ** 3, 0, None) ** 3
    w /= w.sum(axis=1, keepdims=True)
    mx, my = w @ x, w @ y
    away = x[None, :] - mx[:, None]
    spread = (w * away**2).sum(axis=1)
    slope = np.divide((w * away * (y[None, :] - my[:, None])).sum(axis=1), spread, out=np.zeros(len(at)), where=spread > 1e-9 * max(float(np.ptp(x)) ** 2, 1e-9))
    return my + slope * (at - mx)


def decompose(x: np.ndarray, period: int = 7, robust: int = 15, inner: int = 2, seasonal: int = 7) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Trend, season and rest (they sum to ``x``) by LOESS; a straight line and no season under two periods.

    In an inner round each phase of the period (each weekday) is smoothed over its own points, the smooth part of that is taken out by moving
    averages, and the trend is smoothed without the season. Up to ``robust`` outer rounds weigh down points far from the fit (bisquare).
    """
    n, t = len(x), np.arange(len(x), dtype=float)
    if n < 2 * period:
        trend = np.polyval(np.polyfit(t, x, 1), t) if n > 1 else x.copy()
        return trend, np.zeros(n), x - trend
    odd = lambda v: int(v) + 1 - int(v) % 2
    wide, low = odd(math.ceil(1.5 * period / (1 - 1.5 / seasonal))), odd(period + 1)
    long = np.arange(-period, n + period)  # one period more on both sides
    weights, trend, season = np.ones(n), np.zeros(n), np.zeros(n)
    mean = lambda v, k: np.convolve(v, np.ones(k) / k, "valid")
    for outer in range(robust + 1):
        for _ in range(inner):
            rest, cycle = x - trend, np.zeros(n + 2 * period)
            for p in range(period):
                own, places = t[p::period], long % period == p
                cycle[places] = loess(own / period, rest[p::period], seasonal, long[places] / period, weights[p::period])
            smooth = loess(t, mean(mean(mean(cycle, period), period), 3), low)
            season = cycle[period:-period] - smooth
            trend = loess(t, x - season, wide, weights=weights)
        away = np.abs(x - trend - season)
        scale = 6 * np.median(away)
        if outer == robust or scale < 1e-9 * max(float(np.abs(x).max()), 1e-9):
            break
        new = np.clip(1 - (away / scale) ** 2, 0, None) ** 2
        done, weights = np.abs(new - weights).max() < 1e-3, new
        if done:
            break
    return trend, season, x - trend - season


def decomposition(series: DataFrame, period: int = 7) -> DataFrame:
    def work(x, days):
        trend, season, rest = decompose(x, period)
        return pd.DataFrame({"day": days, "trend": trend, "seasonal": season, "residual": rest})

    return per_series(series, work, "day date, trend double, seasonal double, residual double")


def cycles(series: DataFrame, least: int = 14, ratio: float = 3.0) -> DataFrame:
    """The strongest period of each series and whether it stands out of the mean power."""

    def work(x, days):
        if len(x) < least or x.std() == 0:
            return pd.DataFrame({"period": [None], "power_ratio": [0.0], "cyclic": [False]})
        power = np.abs(np.fft.rfft(x - x.mean()))[1:] ** 2
        top = int(power.argmax())
        r = float(power[top] / power.mean())
        return pd.DataFrame({"period": [len(x) / (top + 1)], "power_ratio": [r], "cyclic": [r >= ratio]})

    return per_series(series, work, "period double, power_ratio double, cyclic boolean")


def beta_cdf(x: float, a: float, b: float) -> float:
    """The regularised incomplete beta function, by its continued fraction."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - beta_cdf(1 - x, b, a)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    tiny, c, d = 1e-300, 1.0, 1 - (a + b) * x / (a + 1)
    d = 1 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 300):
        for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d, c = 1 + num * d, 1 + num / c
            d, c = 1 / (d if abs(d) > tiny else tiny), c if abs(c) > tiny else tiny
            h *= d * c
        if abs(d * c - 1) < 1e-12:
            break
    return front * h


def f_tail(f: float, d1: int, d2: int) -> float:
    """P(F > f)."""
    return 1.0 if f <= 0 or d2 <= 0 else beta_cdf(d2 / (d2 + d1 * f), d2 / 2, d1 / 2)


def granger(x: np.ndarray, y: np.ndarray, lag: int) -> float:
    """The p-value of "x does not help to foretell y" with ``lag`` lags; 0 where it leaves nothing to tell."""
    n = len(y) - lag
    if n <= 2 * lag + 1:
        return 1.0
    own = np.column_stack([np.ones(n)] + [y[lag - k : len(y) - k] for k in range(1, lag + 1)])
    both = np.column_stack([own] + [x[lag - k : len(x) - k] for k in range(1, lag + 1)])
    rss = [float(((y[lag:] - a @ np.linalg.lstsq(a, y[lag:], rcond=None)[0]) ** 2).sum()) for a in (own, both)]
    if rss[1] <= 1e-12 * max(1.0, float(y @ y)):  # an exact fit: told by x, unless y tells itself
        return 0.0 if rss[0] > 1e-9 * max(1.0, float(y @ y)) else 1.0
    d2 = n - 2 * lag - 1
    return f_tail((rss[0] - rss[1]) / lag / (rss[1] / d2), lag, d2)


def dtw(x: np.ndarray, y: np.ndarray) -> float:
    """Dynamic time warping distance of standardised series, by anti-diagonals."""
    z = lambda v: (v - v.mean()) / (v.std() or 1.0)
    n, m = len(x), len(y)
    cost = np.abs(z(x)[:, None] - z(y)[None, :])
    acc = np.full((n + 1, m + 1), np.inf)
    acc[0, 0] = 0
    for d in range(2, n + m + 1):
        i = np.arange(max(1, d - m), min(n, d - 1) + 1)
        j = d - i
        acc[i, j] = cost[i - 1, j - 1] + np.minimum(np.minimum(acc[i - 1, j], acc[i, j - 1]), acc[i - 1, j - 1])
    return float(acc[-1, -1])


# The response surface of the unit-root test's 5 % critical value, with a constant.
ADF_5 = (-2.86154, -2.8903, -4.234, -40.040)


def unit_root(x: np.ndarray) -> tuple[float, int, bool]:
    """The augmented Dickey-Fuller statistic with a constant, its lags (least AIC over one sample), and whether it is below 5 %."""
    n, d = len(x), np.diff(x)
    most = min(n // 2 - 2, int(math.ceil(12 * (n / 100) ** 0.25)))
    if most < 0 or x.std() < 1e-12:
        return 0.0, 0, False

    def fit(lags: int, skip: int) -> tuple[float, float, int]:
        y = d[skip:]
        a = np.column_stack([np.ones(len(y)), x[skip:-1]] + [d[skip - k : len(d) - k] for k in range(1, lags + 1)])
        beta, *_ = np.linalg.lstsq(a, y, rcond=None)
        rss = float(((y - a @ beta) ** 2).sum())
        free = len(y) - a.shape[1]
        if free <= 0 or rss <= 1e-300:
            return math.inf, 0.0, len(y)
        t = beta[1] / math.sqrt(max(rss / free * np.linalg.pinv(a.T @ a)[1, 1], 1e-300))
        return len(y) * math.log(rss / len(y)) + 2 * a.shape[1], float(t), len(y)

    lags = min(range(most + 1), key=lambda k: fit(k, most)[0])
    _, t, used = fit(lags, lags)
    return t, lags, t < sum(c / used**i for i, c in enumerate(ADF_5))


def stationarity(series: DataFrame, least: int = 8) -> DataFrame:
    """``series, statistic, lags, stationary, differenced``: whether a series has no unit root, itself or after one difference; not
    under ``least`` points."""

    def work(x, days):
        for step, v in ((False, x), (True, np.diff(x))):
            if len(v) < least:
                break
            t, lags, ok = unit_root(v)
            if ok:
                return pd.DataFrame({"statistic": [t], "lags": [lags], "stationary": [True], "differenced": [step]})
        return pd.DataFrame({"statistic": [unit_root(x)[0] if len(x) >= least else 0.0], "lags": [0], "stationary": [False], "differenced": [False]})

    return per_series(series, work, "statistic double, lags long, stationary boolean, differenced boolean")


def cascades(series: DataFrame, top: int = 10, least_days: int = 30, lags: int = 7, level: float = 0.05) -> DataFrame:
    """``cause, effect, lag, p``: which of the ``top`` series by volume, of those with ``least_days`` days above 0, help to foretell
    which; the best lag's p-value under ``level``, without a correction for the number of pairs."""
    n = series.groupBy("series").agg(F.sum("value").alias("volume"), F.sum((F.col("value") > 0).cast("int")).alias("days"))
    best = n.orderBy(F.desc("volume"), "series").limit(top).where(F.col("days") >= least_days)  # a few rows
    return causality(series.join(F.broadcast(best.select("series")), "series", "left_semi"), lags).where(F.col("p") < level).select("cause", "effect", "lag", "p")


def causality(series: DataFrame, lags: int = 7, level: float = 0.05) -> DataFrame:
    """Granger tests of all ordered pairs: the best lag's p-value, significant after Bonferroni over the pairs."""

    def work(some: dict, others: dict) -> pd.DataFrame:
        every, out = some | others, []
        for a, b in names(some, others, ordered=True):
            p, lag = min((granger(every[a][1], every[b][1], k), k) for k in range(1, lags + 1))
            out.append((a, b, lag, p, min(1.0, max(0.0, -math.log10(max(p, 1e-300)) / 10))))
        return pd.DataFrame(out, columns=["cause", "effect", "lag", "p", "strength"])

    out = by_blocks(series, work, "cause string, effect string, lag long, p double, strength double", FEW)
    n = series.select("series").distinct().count()
    return out.withColumn("significant", F.col("p") < level / max(1, n * (n - 1)))


def alignment(series: DataFrame) -> DataFrame:
    """DTW distance of all pairs, its strength against the largest one, and ``lag``: by how many days the peak of ``a`` comes after that of
    ``b`` (the first day of each largest value)."""

    def work(some: dict, others: dict) -> pd.DataFrame:
        every, out = some | others, []
        for a, b in names(some, others):
            (d, x), (e, y) = every[a], every[b]
            out.append((a, b, dtw(x, y), int(d[x.argmax()] - e[y.argmax()])))
        return pd.DataFrame(out, columns=["a", "b", "distance", "lag"])

    d = settle(by_blocks(series, work, "a string, b string, distance double, lag int", FEW))  # read twice below
    most = d.agg(F.max("distance").alias("most"))
    return d.crossJoin(F.broadcast(most)).select("a", "b", "distance", F.when(F.col("most") > 0, 1 - F.col("distance") / F.col("most")).otherwise(0.0).alias("strength"), "lag")  # one row
