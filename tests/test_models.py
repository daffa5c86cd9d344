"""Models of daily series: optimality, made-up truth, exact transforms."""

import datetime

import numpy as np
import pytest

from corvane.operators import models as M


def rows(name, x):
    day = datetime.date(2024, 1, 1)
    return [(name, day + datetime.timedelta(t), float(v)) for t, v in enumerate(x)]


def broken(n=120, seed=2):
    t = np.arange(n)
    return 50 + 0.5 * t - 1.5 * np.maximum(t - 48, 0) + 6 * np.sin(2 * np.pi * t / 7) + np.random.default_rng(seed).normal(0, 1, n)


def test_trend_is_optimal():
    y = broken()
    made = M.fit_trend(y)
    a, z = M.design(np.arange(120.0), 0, 120, made.breaks), y / np.abs(y).max()
    best = M.objective(a, z, made.weights, made.sigma, len(made.breaks))
    rng = np.random.default_rng(0)
    for size in (1e-1, 1e-2, 1e-3):
        for _ in range(100):
            assert M.objective(a, z, made.weights + rng.normal(0, size, a.shape[1]), made.sigma * np.exp(rng.normal(0, size)), len(made.breaks)) >= best - 1e-7
    # the slope of the smooth part stays within the penalty on breaks, and meets it where there is one
    pull = a.T @ (z - a @ made.weights) / made.sigma**2
    d = made.deltas()
    assert np.abs(pull[2 : 2 + len(d)]).max() <= 20 * 1.02
    assert np.allclose(pull[2 : 2 + len(d)][np.abs(d) > 1e-3], 20 * np.sign(d[np.abs(d) > 1e-3]), rtol=1e-2)


def test_trend_finds_the_break_and_the_week():
    y = broken()
    made = M.fit_trend(y)
    t = np.arange(134.0)
    clean = 50 + 0.5 * t - 1.5 * np.maximum(t - 48, 0) + 6 * np.sin(2 * np.pi * t / 7)
    assert np.abs(made.at(t[:120]) - clean[:120]).mean() < 1 and np.abs(made.at(t[120:]) - clean[120:]).max() < 5
    d = made.deltas()
    near = np.abs(made.breaks * 119 - 48) < 8
    assert d[near].sum() < 0 and abs(d[near].sum()) > 0.8 * np.abs(d).sum()
    wide = made.spread(t)
    assert np.ptp(wide[:120]) < 1e-12 and (np.diff(wide[119:]) > 0).all()


def test_forecast(spark):
    data = rows("a", broken()) + rows("flat", [3.0] * 20) + rows("short", range(13))
    got = M.forecast(spark.createDataFrame(data, "series string, day date, value double")).toPandas()
    assert got.groupby("series").size().to_dict() == {"a": 127, "flat": 27}
    assert got.groupby("series")["future"].sum().to_dict() == {"a": 7, "flat": 7}
    assert (got[got.series == "flat"][["forecast", "lower", "upper"]] == 3).all().all()
    a = got[(got.series == "a") & ~got.future].sort_values("day")
    inside = (broken() >= a.lower.to_numpy()) & (broken() <= a.upper.to_numpy())
    assert 0.7 < inside.mean() < 0.9


@pytest.mark.parametrize("n", [7, 8, 15, 30, 61, 90])
def test_wavelet_rebuilds(n):
    low = np.array(M.DB4)
    for k in range(0, 8, 2):  # shifted by two the filter is orthogonal to itself
        assert (low[k:] @ low[: 8 - k]) == pytest.approx(float(k == 0), abs=1e-10)
    x = np.random.default_rng(n).normal(size=n)
    smooth, detail = M.dwt(x, low)
    assert len(smooth) == len(detail) == (n + 7) // 2
    assert np.allclose(M.idwt(smooth, detail, low, n), x, atol=1e-9)
    t = np.arange(n)
    inner = M.dwt(1 + 2.0 * t + t**2, low)[1][4:-4]  # four moments vanish away from the ends
    assert np.allclose(inner, 0, atol=1e-6)


def test_wavelet_periods():
    t = np.arange(256)
    for period in (4, 8, 16):
        assert M.wavelet(np.cos(2 * np.pi * t / (period * 1.4)))[2] == period  # a level holds the octave above its period
    assert M.wavelet(np.arange(15.0)) == ({}, float((np.arange(15.0) ** 2).sum()), None)
    assert set(M.wavelet(np.arange(30.0))[0]) == {2, 4} and set(M.wavelet(np.arange(112.0))[0]) == {2, 4, 8, 16}


def test_g_tail():
    rng = np.random.default_rng(5)
    draws = rng.exponential(size=(200_000, 12))
    g = (draws / draws.sum(axis=1, keepdims=True)).max(axis=1)
    for x in (0.15, 0.25, 0.4, 0.6):
        assert M.g_tail(x, 12) == pytest.approx((g > x).mean(), abs=5e-3)
    assert M.g_tail(0, 12) == 1.0 == pytest.approx(M.g_tail(0.01, 12)) and M.g_tail(1.0, 12) == 0.0
    assert M.g_tail(0.002, 400) == pytest.approx(1.0)
    assert 0 < M.g_tail(0.05, 400) < 1e-5


def test_seasons():
    t = np.arange(84)
    x = 10 + 3 * np.sin(2 * np.pi * t / 7) + np.random.default_rng(1).normal(size=84)
    found = {round(a, 6): p for a, _, p in M.seasons(x) if p < 0.05}
    assert list(found) == [7.0] and min(a for a, _, _ in M.seasons(x)) == 2.0 and max(a for a, _, _ in M.seasons(x)) == 42.0
    assert all(p == 1.0 for _, _, p in M.seasons(np.full(30, 0.1))) and M.seasons(np.ones(3)) == []
    power = sum(v for _, v, _ in M.seasons(x)) + 2 * np.abs(np.fft.rfft(x - x.mean()))[1] ** 2 / 84
    assert power == pytest.approx(((x - x.mean()) ** 2).sum())  # Parseval; one period is longer than half the length


def simulate(phi, theta, n=600, seed=0, mean=5.0):
    rng, v = np.random.default_rng(seed), [0.0] * 3
    e = rng.normal(size=n + 3)
    for t in range(3, n + 3):
        v.append(sum(f * v[t - i] for i, f in enumerate(phi, 1)) + e[t] + sum(f * e[t - j] for j, f in enumerate(theta, 1)))
    return np.array(v[3:]) + mean


@pytest.mark.parametrize("phi, theta", [([0.6], []), ([0.5, 0.3], []), ([], [0.6]), ([0.7], [0.4])])
def test_arma(phi, theta):
    w = simulate(phi, theta)
    made = M.fit_arma(w, len(phi), len(theta))
    assert np.allclose(made.phi, phi, atol=0.12) and np.allclose(made.theta, theta, atol=0.12) and abs(made.mean - w.mean()) < 0.5
    e, v = [], w - made.mean  # the recursion written out
    for t in range(3, len(w)):
        e.append(v[t] - sum(f * v[t - i] for i, f in enumerate(made.phi, 1)) - sum(f * e[-j] for j, f in enumerate(made.theta, 1) if j <= len(e)))
    assert sum(x * x for x in e) == pytest.approx(made.rss)
    rng = np.random.default_rng(1)
    for _ in range(60):
        other = M.innovations(w, made.mean + rng.normal(0, 0.01), made.phi + rng.normal(0, 0.01, len(phi)), made.theta + rng.normal(0, 0.01, len(theta)), 3)
        assert other @ other >= made.rss * (1 - 1e-9)
    if not theta:
        a = np.column_stack([np.ones(len(w) - 3)] + [w[3 - i : len(w) - i] for i in range(1, len(phi) + 1)])
        assert made.rss == pytest.approx(((w[3:] - a @ np.linalg.lstsq(a, w[3:], rcond=None)[0]) ** 2).sum(), rel=1e-6)


def test_arima():
    order, _, ahead = M.arima(simulate([0.8], []))
    assert order[1] == 0 and order[0] >= 1 and abs(ahead[-1] - 5) < 5
    walk = np.cumsum(simulate([], [], mean=1.0, seed=4))
    order, _, ahead = M.arima(walk)
    assert order[1] == 1 and ahead[-1] == pytest.approx(walk[-1] + 7, abs=5)
    order, _, ahead = M.arima(np.arange(40.0) * 2)
    assert order == (0, 1, 0) and np.allclose(ahead, 80 + 2 * np.arange(7))
    assert M.arima(np.full(20, 4.0))[2].tolist() == [4.0] * 7 and M.arima(np.ones(9)) is None
    for n in (10, 11, 12, 14):
        assert np.isfinite(M.arima(np.random.default_rng(n).normal(size=n))[2]).all()


def test_metrics(spark):
    data = rows("week", (broken() - 50 - 0.5 * np.arange(120) + 1.5 * np.maximum(np.arange(120) - 48, 0))[:112]) + rows("flat", [2.0] * 30) + rows("short", [1, 2, 3])
    got = {r.series: r for r in M.metrics(spark.createDataFrame(data, "series string, day date, value double")).collect()}
    assert got["week"].n == 112 and set(got["week"].energy) == {2, 4, 8, 16} and len(got["week"].ahead) == 7
    assert 7 in {round(s.period) for s in got["week"].seasons}
    assert got["flat"].seasons == [] and (got["flat"].p, got["flat"].d, got["flat"].q) == (0, 0, 0)
    assert got["short"].aic is None and got["short"].ahead is None and got["short"].energy == {} and got["short"].dominant_period is None
