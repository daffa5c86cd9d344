"""Models of one daily series: a trend that may break with a weekly season, wavelet energies, ARIMA, and periods that stand out.

Each is NumPy over a series, whose size the calendar bounds; ``grouped.per_series`` runs one series a group.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from .grouped import per_series, unit_root

# The low-pass filter of Daubechies' wavelet with four vanishing moments.
DB4 = (-0.010597401784997278, 0.032883011666982945, 0.030841381835986965, -0.18703481171888114, -0.02798376941698385, 0.6308807679295904, 0.7148465705525415, 0.23037781330885523)


@dataclass
class Trend:
    """What ``fit_trend`` found; ``at(t)`` is its mean, ``spread(t)`` its standard deviation, both in units of the series."""

    start: int
    length: int
    scale: float
    breaks: np.ndarray
    weights: np.ndarray
    sigma: float

    def at(self, t: np.ndarray) -> np.ndarray:
        return self.scale * (design(t, self.start, self.length, self.breaks) @ self.weights)

    def deltas(self) -> np.ndarray:
        return self.weights[2 : 2 + len(self.breaks)]

    def spread(self, t: np.ndarray) -> np.ndarray:
        """Noise, and after the last day breaks as often and as large as before (Laplace changes at even times, in closed form)."""
        ahead = np.maximum(t / max(self.length - 1, 1) - 1, 0)
        size = np.abs(self.deltas()).mean() if len(self.breaks) else 0.0
        return self.scale * np.sqrt(self.sigma**2 + len(self.breaks) * 2 * size**2 * ahead**3 / 3)


def design(t: np.ndarray, start: int, length: int, breaks: np.ndarray) -> np.ndarray:
    """Columns: level, slope, a hinge for each candidate break, and three sines and cosines of the week (``start``: the first day's number)."""
    u = t / max(length - 1, 1)
    angle = 2 * np.pi * ((start + t) % 7)[:, None] * np.arange(1, 4) / 7
    return np.column_stack([np.ones(len(t)), u, np.maximum(u[:, None] - breaks, 0), np.sin(angle), np.cos(angle)])


def objective(a: np.ndarray, y: np.ndarray, weights: np.ndarray, sigma: float, n_breaks: int, width: float = 0.05) -> float:
    """The negative log posterior that ``fit_trend`` lowers, less its constants."""
    ridge = np.r_[[1 / 25, 1 / 25], np.zeros(n_breaks), np.full(6, 1 / 100)]
    return len(y) * math.log(sigma) + ((y - a @ weights) ** 2).sum() / (2 * sigma**2) + (ridge * weights**2).sum() / 2 + np.abs(weights[2 : 2 + n_breaks]).sum() / width + 2 * sigma**2


def fit_trend(y: np.ndarray, start: int = 0, most: int = 25, width: float = 0.05, rounds: int = 400) -> Trend:
    """The likeliest level, slope, breaks (of up to ``most`` even candidates in the first 80 %), weekly terms and noise.

    Priors: normal for level and slope (5) and weekly terms (10), Laplace (``width``) for breaks, half-normal (0.5) for the noise, of the
    series over its largest value. A break's absolute value is bounded by a parabola through the last round's; each round lowers the whole.
    """
    n = len(y)
    scale = float(np.abs(y).max()) or 1.0
    y = y / scale
    used = int(n * 0.8)
    n_breaks = max(min(most, used - 1), 0)
    breaks = np.round(np.linspace(0, used - 1, n_breaks + 1))[1:] / max(n - 1, 1)
    a = design(np.arange(n, dtype=float), start, n, breaks)
    places = slice(2, 2 + n_breaks)
    ridge = np.r_[[1 / 25, 1 / 25], np.full(n_breaks, 1 / width), np.full(6, 1 / 100)]
    gram, right = a.T @ a, a.T @ y
    size = np.ones(a.shape[1])
    sigma = max(float(y.std()), 1e-6)
    weights = np.zeros(a.shape[1])
    for _ in range(rounds):
        root = np.sqrt(size)  # breaks are solved for in units of their last size, so that none divides by zero
        new = root * np.linalg.solve(root[:, None] * gram * root / sigma**2 + np.diag(ridge), root * right / sigma**2)
        rss = float(((y - a @ new) ** 2).sum())
        sigma = max(math.sqrt((math.sqrt(n**2 + 16 * rss) - n) / 8), 1e-6)
        moved, weights = np.abs(new - weights).max(), new
        size[places] = np.abs(weights[places])
        if moved < 1e-10:
            break
    return Trend(start, n, scale, breaks, weights, sigma)


def forecast(series: DataFrame, horizon: int = 7, least: int = 14) -> DataFrame:
    """``series, day, forecast, lower, upper, future``: the fitted model on each day and ``horizon`` days on, with 80 % bounds.

    Series under ``least`` days have no rows. Only rows that are not ``future`` belong to the table of the series.
    """

    def work(x, days):
        if len(x) < least:
            return pd.DataFrame({c: pd.Series(dtype=object) for c in ("day", "forecast", "lower", "upper", "future")})
        first = pd.Timestamp(days[0])
        t = np.arange(len(x) + horizon, dtype=float)
        if np.ptp(x) == 0:
            mean, out = np.full(len(t), x[0]), np.zeros(len(t))
        else:
            made = fit_trend(x, first.toordinal())
            mean, out = made.at(t), 1.2815515655446004 * made.spread(t)
        return pd.DataFrame({"day": [(first + pd.Timedelta(days=int(i))).date() for i in t], "forecast": mean, "lower": mean - out, "upper": mean + out, "future": t >= len(x)})

    return per_series(series, work, "day date, forecast double, lower double, upper double, future boolean")


def dwt(x: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One step of a wavelet transform, the ends mirrored: smooth and detail coefficients."""
    n, k = len(x), len(low)
    high = low[::-1] * np.where(np.arange(k) % 2 == 0, -1.0, 1.0)
    at = 2 * np.arange((n + k - 1) // 2)[:, None] + 1 - np.arange(k)
    at = at % (2 * n)
    values = x[np.where(at < n, at, 2 * n - 1 - at)]
    return values @ low, values @ high


def idwt(smooth: np.ndarray, detail: np.ndarray, low: np.ndarray, n: int) -> np.ndarray:
    """The series of length ``n`` that ``dwt`` took apart."""
    k = len(low)
    high = low[::-1] * np.where(np.arange(k) % 2 == 0, -1.0, 1.0)
    at = 2 * np.arange(len(smooth)) + 1 - np.arange(n)[:, None]
    inside = (at >= 0) & (at < k)
    at = np.clip(at, 0, k - 1)
    return np.where(inside, low[at], 0) @ smooth + np.where(inside, high[at], 0) @ detail


def wavelet(x: np.ndarray, level: int = 4) -> tuple[dict[int, float], float, float | None]:
    """Energy of the details by period in days, energy of the smooth rest, and the period of the most energy.

    As many of ``level`` steps as the length allows (seven values a coefficient); none under 2 ** ``level`` days.
    """
    steps = min(level, int(math.log2(len(x) / (len(DB4) - 1)))) if len(x) >= max(2**level, len(DB4) - 1) else 0
    low, smooth, energy = np.array(DB4), x.astype(float), {}
    for j in range(1, steps + 1):
        smooth, detail = dwt(smooth, low)
        energy[2**j] = float((detail**2).sum())
    return energy, float((smooth**2).sum()), float(max(energy, key=energy.get)) if energy else None


def g_tail(g: float, m: int) -> float:
    """P(the largest of ``m`` ordinates of white noise is more than ``g`` of their sum), exactly."""
    if g <= 0 or m < 1:
        return 1.0
    terms = [(-1) ** (k - 1) * math.comb(m, k) * (1 - k * g) ** (m - 1) for k in range(1, min(m, int(1 / g)) + 1) if k * g < 1]
    total = math.fsum(terms)
    if terms and max(map(abs, terms)) > 1e12:  # small g: the sum cancels, and the tail is 1
        return 1.0
    return min(max(total, 0.0), 1.0)


def seasons(x: np.ndarray) -> list[tuple[float, float, float]]:
    """``period, power, p`` of each Fourier period from 2 days to half the length, p by Fisher's g."""
    n = len(x)
    if n < 4:
        return []
    power = 2 * np.abs(np.fft.rfft(x - x.mean())) ** 2 / n
    if n % 2 == 0:
        power[-1] /= 2
    power, total = power[1:], float(power[1:].sum())
    floor = 1e-12 * max(float((x**2).sum()), 1e-300)  # what rounding leaves of a flat series
    return [(n / (i + 1), float(v), g_tail(float(v) / total, len(power)) if total > floor else 1.0) for i, v in enumerate(power) if 2 <= n / (i + 1) <= n / 2]


def _recursive(u: np.ndarray, theta: np.ndarray) -> np.ndarray:
    """``out[t] = u[t] - sum of theta[j] * out[t - 1 - j]``, for each column."""
    out = np.zeros_like(u)
    for t in range(len(u)):
        k = min(t, len(theta))
        out[t] = u[t] - (theta[:k] @ out[t - k : t][::-1] if k else 0)
    return out


def _inside(c: np.ndarray) -> bool:
    """Whether ``z^k - c1 z^(k-1) - ...`` has all its roots inside the unit circle."""
    return not len(c) or bool(np.abs(np.roots(np.r_[1, -c])).max() < 0.999)


@dataclass
class Arma:
    mean: float
    phi: np.ndarray
    theta: np.ndarray
    rss: float
    n: int

    def aic(self) -> float:
        return self.n * math.log(max(self.rss, 1e-300) / self.n) + 2 * (len(self.phi) + len(self.theta) + 2)


def innovations(w: np.ndarray, mean: float, phi: np.ndarray, theta: np.ndarray, skip: int) -> np.ndarray:
    """What an ARMA model does not foresee, from the ``skip``-th value on; earlier innovations are 0."""
    v = w - mean
    u = v[skip:] - sum((f * v[skip - i : len(v) - i] for i, f in enumerate(phi, 1)), np.zeros(len(v) - skip))
    return _recursive(u, theta)


def fit_arma(w: np.ndarray, p: int, q: int, skip: int = 3, rounds: int = 60) -> Arma:
    """Least squares of the innovations by damped Gauss-Newton steps inside the stationary and invertible region."""
    mean = float(w.mean())
    v, n = w - mean, len(w) - skip
    phi, theta = np.zeros(p), np.zeros(q)
    if p or q:  # a long autoregression's innovations stand for the unknown ones
        reach = min(max(p + q + 2, 4), max(len(w) // 3, 1))
        lags = lambda x, k, at: [x[at - i : len(x) - i] for i in range(1, k + 1)]
        long = np.column_stack(lags(v, reach, reach))
        e = np.r_[np.zeros(reach), v[reach:] - long @ np.linalg.lstsq(long, v[reach:], rcond=None)[0]]
        at = reach + max(p, q)
        if len(v) - at > p + q:
            first = np.linalg.lstsq(np.column_stack(lags(v, p, at) + lags(e, q, at)), v[at:], rcond=None)[0]
            phi, theta = first[:p], first[p:]
        while not _inside(phi):
            phi = phi * 0.9 ** np.arange(1, p + 1)
        while not _inside(-theta):
            theta = theta * 0.9 ** np.arange(1, q + 1)
    e = innovations(w, mean, phi, theta, skip)
    rss, damp = float(e @ e), 1e-3
    for _ in range(rounds):
        v = w - mean
        before = np.r_[np.zeros(q), e]
        slopes = [np.full(n, -(1 - phi.sum()))] + [-v[skip - i : len(v) - i] for i in range(1, p + 1)] + [-before[q - j : q - j + n] for j in range(1, q + 1)]
        slope = _recursive(np.column_stack(slopes), theta)
        gram, right = slope.T @ slope, slope.T @ e
        better = False
        while damp < 1e8:
            step = np.linalg.lstsq(gram + damp * np.diag(np.diag(gram) + 1e-12), -right, rcond=None)[0]
            new = mean + step[0], phi + step[1 : 1 + p], theta + step[1 + p :]
            if _inside(new[1]) and _inside(-new[2]):
                tried = innovations(w, *new, skip)
                if float(tried @ tried) < rss:
                    better = True
                    break
            damp *= 10
        if not better:
            break
        gain, rss, e = rss - float(tried @ tried), float(tried @ tried), tried
        (mean, phi, theta), damp = new, max(damp / 10, 1e-9)
        if gain < 1e-10 * rss:
            break
    return Arma(mean, phi, theta, rss, n)


def arima(x: np.ndarray, most_p: int = 3, most_d: int = 2, most_q: int = 3, horizon: int = 7, least: int = 10) -> tuple[tuple[int, int, int], float, np.ndarray] | None:
    """``(p, d, q), AIC, forecast``; none under ``least`` values.

    Differences are taken until the unit-root test finds no root; among the orders over that series, all fitted from the same value
    on, the least AIC wins, the smaller model among equals.
    """
    if len(x) < least:
        return None
    w, d = x.astype(float), 0
    while d < most_d and np.ptp(w) > 1e-12 and not unit_root(w)[2]:
        w, d = np.diff(w), d + 1
    if np.ptp(w) <= 1e-12:
        made = Arma(float(w.mean()), np.zeros(0), np.zeros(0), 0.0, len(w))
    else:
        skip = min(most_p, len(w) - 6)
        orders = sorted(((p, q) for p in range(min(most_p, skip) + 1) for q in range(most_q + 1)), key=lambda o: (sum(o), o))
        made = min((fit_arma(w, p, q, skip) for p, q in orders if len(w) - skip > p + q + 3), key=Arma.aic)
    p, q = len(made.phi), len(made.theta)
    e = innovations(w, made.mean, made.phi, made.theta, p)
    v, e = list(w - made.mean), list(e)
    for _ in range(horizon):
        v.append(sum(f * v[-i] for i, f in enumerate(made.phi, 1)) + sum(f * e[-j] for j, f in enumerate(made.theta, 1) if j <= len(e)))
        e.append(0.0)
    ahead = np.array(v[len(w) :]) + made.mean
    for back in range(d - 1, -1, -1):
        ahead = np.diff(x.astype(float), back)[-1] + np.cumsum(ahead)
    return (p, d, q), made.aic(), ahead


def metrics(series: DataFrame, horizon: int = 7, level: float = 0.05) -> DataFrame:
    """A row a series: detail energies by period, the dominant period, the ARIMA order with its AIC and forecast, and the periods whose
    power is not that of noise (``period, power, p`` below ``level``). What a series is too short for is null or empty."""

    def work(x, days):
        energy, rest, period = wavelet(x)
        told = arima(x, horizon=horizon)
        order, aic, ahead = told or ((None,) * 3, None, None)
        found = [{"period": a, "power": b, "p": p} for a, b, p in seasons(x) if p < level]
        row = {"n": len(x), "energy": energy, "smooth_energy": rest, "dominant_period": period, "p": order[0], "d": order[1], "q": order[2], "aic": aic, "ahead": None if ahead is None else ahead.tolist(), "seasons": found}
        return pd.DataFrame([row])

    return per_series(series, work, "n int, energy map<int, double>, smooth_energy double, dominant_period double, p int, d int, q int, aic double, ahead array<double>, seasons array<struct<period: double, power: double, p: double>>")
