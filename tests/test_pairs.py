"""Pairs of series by blocks against one pair at a time."""

import datetime
import math
import random

import numpy as np
import pytest

from corvane.operators import grouped, pairs, series

START = datetime.date(2024, 1, 1)


@pytest.fixture(scope="module")
def told():
    """Eleven series: one follows another by three days, one does not vary, one has two days, one lacks every third day, one is on other days."""
    rng = random.Random(3)
    out = {f"s{i}": {d: float(rng.randrange(40)) for d in range(50)} for i in range(7)}
    out["late"] = {d: 2 * out["s3"][d - 3] if d > 2 else 0.0 for d in range(50)}
    out["still"] = dict.fromkeys(range(50), 4.0)
    out["short"] = {3: 1.0, 4: 7.0}
    out["gaps"] = {d: out["s5"][d] + d for d in range(50) if d % 3}
    out["far"] = {d: float(d % 7) for d in range(400, 430)}
    return out


@pytest.fixture(scope="module")
def df(spark, told):
    rows = [(s, START + datetime.timedelta(d), v) for s, x in told.items() for d, v in x.items()] + [(None, START, 1.0), ("s0", None, 5.0)]
    return spark.createDataFrame(rows, "series string, day date, value double")


def by_force(told, most, least):
    out = {}
    for a in told:
        for b in told:
            best = None
            for lag in sorted(range(-most, most + 1), key=lambda k: (abs(k), k)) if a < b else ():
                both = [(v, told[b][d + lag]) for d, v in told[a].items() if d + lag in told[b]]
                x, y = np.array(both).T if both else (np.zeros(0), np.zeros(0))
                if len(both) < 3 or x.std() < 1e-9 or y.std() < 1e-9:
                    continue
                r = float(np.corrcoef(x, y)[0, 1])
                if best is None or round(abs(r), 9) > round(abs(best[1]), 9):
                    best = (lag, r)
            if best and abs(best[1]) > least:
                out[a, b] = best
    return out


@pytest.mark.parametrize("size", [2, 5, 64])
def test_lead_lag(df, told, size):
    got = {(r.a, r.b): (r.lag, r.r) for r in pairs.lead_lag(df, 7, 0.1, size).collect()}
    want = by_force(told, 7, 0.1)
    assert want["late", "s3"][0] == -3 and want["late", "s3"][1] == pytest.approx(1)
    assert got.keys() == want.keys()
    for k, (lag, r) in want.items():
        assert got[k][0] == lag and math.isclose(got[k][1], r, abs_tol=1e-9), k


def test_leader(df):
    from pyspark.sql import functions as F

    led = series.lead_lag(df.withColumn("metric", F.lit("volume"))).where("a = 'late' and b = 's3'").first()
    assert (led.lag, led.leader) == (-3, "s3")


@pytest.mark.parametrize("size", [1, 3, 64])
def test_every_pair_meets_once(df, told, size):
    def work(ordered):
        import pandas as pd

        return lambda some, others: pd.DataFrame(list(pairs.names(some, others, ordered)), columns=["a", "b"])

    got = [tuple(r) for r in pairs.by_blocks(df, work(False), "a string, b string", size).collect()]
    assert sorted(got) == sorted((a, b) for a in told for b in told if a < b)
    got = [tuple(r) for r in pairs.by_blocks(df, work(True), "a string, b string", size).collect()]
    assert sorted(got) == sorted((a, b) for a in told for b in told if a != b)


def test_causality_and_alignment(df, told, monkeypatch):
    monkeypatch.setattr(grouped, "FEW", 2)
    whole = df.where("series in ('s0', 's1', 's3', 'late', 'still')")
    x = {s: np.array([told[s][d] for d in range(50)]) for s in ("s0", "s1", "s3", "late", "still")}
    got = {(r.cause, r.effect): r for r in grouped.causality(whole).collect()}
    assert got.keys() == {(a, b) for a in x for b in x if a != b}
    for (a, b), r in got.items():
        assert (r.p, r.lag) == min((grouped.granger(x[a], x[b], k), k) for k in range(1, 8))
    assert got["s3", "late"].significant and got["s3", "late"].lag == 3 and not got["s0", "s1"].significant
    near = {(r.a, r.b): r for r in grouped.alignment(whole).collect()}
    most = max(grouped.dtw(x[a], x[b]) for a in x for b in x if a < b)
    assert near.keys() == {(a, b) for a in x for b in x if a < b}
    for (a, b), r in near.items():
        assert r.distance == grouped.dtw(x[a], x[b]) and r.strength == pytest.approx(1 - r.distance / most) and r.lag == int(x[a].argmax()) - int(x[b].argmax())


def test_empty(df):
    none = df.where("false")
    assert pairs.lead_lag(none).count() == grouped.causality(none).count() == grouped.alignment(none).count() == 0


def test_plan_joins_nothing(df):
    plan = pairs.lead_lag(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
