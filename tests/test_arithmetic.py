"""Operators without a SQL twin against independent arithmetic."""

import datetime as dt
import math

import numpy as np
import pytest

from candlewick.operators import panel
from candlewick.operators.series import Axis

AXIS = Axis(key=("entity_id",), order=("time",), span=86400 * 4000, rows=16)


@pytest.fixture(scope="module")
def series():
    rng = np.random.default_rng(5)
    return {"a": np.cumsum(rng.normal(size=90)), "b": 5 + 0.6 * rng.normal(size=41), "c": rng.normal(size=60) + np.sin(np.arange(60) / 4)}


@pytest.fixture(scope="module")
def table(spark, series):
    start = dt.datetime(2024, 1, 1)
    rows = [(k, start + dt.timedelta(hours=i), float(x)) for k, v in series.items() for i, x in enumerate(v)]
    return spark.createDataFrame(rows, "entity_id string, time timestamp, value double")


def by_entity(df, *order):
    out = {}
    for r in df.orderBy("entity_id", *order).collect():
        out.setdefault(r.entity_id, []).append(r)
    return out


def t_quantile(p, n):
    """Quantile of the t distribution by bisection over a numeric integral."""
    const = math.exp(math.lgamma((n + 1) / 2) - math.lgamma(n / 2)) / math.sqrt(n * math.pi)

    def cdf(t):
        x = np.linspace(0, t, 20001)
        y = const * (1 + x * x / n) ** (-(n + 1) / 2)
        return 0.5 + float(((y[1:] + y[:-1]) / 2 * np.diff(x)).sum())

    lo, hi = 0.0, 60.0
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if cdf(mid) < p else (lo, mid)
    return lo


def test_grubbs(table, series):
    for k, rows in by_entity(panel.grubbs_anomalies(table, axis=AXIS), "time").items():
        x = series[k]
        n = len(x)
        t = t_quantile(1 - 0.05 / (2 * n), n - 2)
        critical = (n - 1) / math.sqrt(n) * math.sqrt(t * t / (n - 2 + t * t))
        assert rows[0].critical_value == pytest.approx(critical, rel=1e-4)
        g = np.abs(x - x.mean()) / x.std(ddof=1)
        assert [r.g_stat for r in rows] == pytest.approx(g)
        assert [r.is_anomaly for r in rows] == list(g > rows[0].critical_value)


def test_cubic(table, series):
    for k, rows in by_entity(panel.smooth_polynomial(table, 3, axis=AXIS), "time").items():
        t = np.linspace(0, 1, len(series[k]))
        assert [r.smoothed for r in rows] == pytest.approx(np.polyval(np.polyfit(t, series[k], 3), t), rel=1e-6, abs=1e-8)


def test_autoregression(table, series):
    for k, rows in by_entity(panel.forecast_linear(table, 6, lags=4, axis=AXIS), "horizon").items():
        x = series[k]
        a = np.column_stack([np.ones(len(x) - 4), *[x[4 - j : len(x) - j] for j in range(1, 5)]])
        c = np.linalg.lstsq(a, x[4:], rcond=None)[0]
        path = list(x)
        for _ in range(6):
            path.append(c[0] + sum(c[j] * path[-j] for j in range(1, 5)))
        assert [r.value for r in rows] == pytest.approx(path[-6:], rel=1e-6)


def test_dickey_fuller(table, series):
    for k, (row,) in by_entity(panel.adf(table, lags=4, axis=AXIS)).items():
        x = series[k]
        d = np.diff(x)
        a = np.column_stack([np.ones(len(d) - 4), x[4:-1], *[d[4 - j : len(d) - j] for j in range(1, 5)]])
        y = d[4:]
        c, *_ = np.linalg.lstsq(a, y, rcond=None)
        e = y - a @ c
        s = math.sqrt(e @ e / (len(y) - a.shape[1]) * np.linalg.inv(a.T @ a)[1, 1])
        assert row.adf == pytest.approx(c[1] / s, rel=1e-6) and row.observations == len(y)


def test_periodogram(table, series):
    got = by_entity(panel.periodogram(table, 24, axis=AXIS), "period")
    for k, x in series.items():
        n = np.arange(1, len(x) + 1)
        d = x - np.polyval(np.polyfit(n, x, 1), n)
        want = [abs((d * np.exp(2j * np.pi * n / p)).sum()) for p in range(2, 25) if p <= len(x) // 2]
        assert [r.amplitude for r in got[k]] == pytest.approx(want, rel=1e-7)


def test_isolation_forest(spark):
    """Equal values cannot be isolated: every path is the expected one and the score one half, whatever the size. Short
    entities are scored on their values, and a value far out scores highest."""
    start = dt.datetime(2024, 1, 1)
    far = [0.1 * i for i in range(40)]
    far[25] = 1000.0
    values = {"flat": [3.0] * 30, "flat_short": [2.0] * 4, "short": [1.0, 1.1, 50.0, 0.9], "far": far}
    rows = [(k, start + dt.timedelta(hours=i), x) for k, v in values.items() for i, x in enumerate(v)]
    df = spark.createDataFrame(rows, "entity_id string, time timestamp, value double")
    got = by_entity(panel.isolation_outliers(df, trees=60, lags=5, axis=AXIS), "time")
    assert [r.anomaly_score for r in got["flat"][5:] + got["flat_short"]] == pytest.approx([0.5] * 29)
    assert [r.anomaly_score is None for r in got["flat"]] == [True] * 5 + [False] * 25
    short = [r.anomaly_score for r in got["short"]]
    assert max(short) == short[2] > 0.55
    hit = [r.anomaly_score for r in got["far"]]
    assert max(x for x in hit if x is not None) in hit[25:31]
