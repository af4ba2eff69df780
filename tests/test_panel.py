"""Panel operators against brute force."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from candlewick.operators import panel
from candlewick.operators.series import HOURLY


def lof(x, k):
    """Local outlier factor by definition; the k nearest, ties by position."""
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    near = np.argsort(d, axis=1, kind="stable")[:, :k]
    kd = np.take_along_axis(d, near, 1)[:, -1]
    reach = np.maximum(np.take_along_axis(d, near, 1), kd[near])
    lrd = 1 / (reach.mean(axis=1) + 1e-10)
    return lrd[near].mean(axis=1) / lrd


@pytest.mark.parametrize("kind,block", [("walk", 64), ("normal", 40), ("levels", 50), ("normal", 4096)])
def test_local_outlier_factor(spark, kind, block):
    rng = np.random.default_rng(3)
    n, lags, k = 400, 5, 8
    series = {"walk": rng.normal(size=n).cumsum(), "normal": rng.normal(size=n), "levels": np.where(rng.random(n) < 0.8, 1.0, rng.integers(0, 40, n)) + np.arange(n) * 1e-7}[kind]
    rows = ", ".join(f"('a', timestamp_seconds({1_700_000_000 + 3600 * i}), {v!r}D)" for i, v in enumerate(series.tolist()))
    df = spark.sql(f"SELECT * FROM VALUES {rows} AS t(entity_id, time, value)")
    got = panel.local_outliers(df, neighbours=k, lags=lags, block=block).filter(F.col("lof_score").isNotNull()).orderBy("time").collect()
    x = np.array([series[i - lags + 1 : i + 1] for i in range(lags - 1, n)])
    if len(got) != len(x):  # the vector may hold the value and its lags
        x = np.array([series[i - lags : i + 1] for i in range(lags, n)])
    assert len(got) == len(x)
    assert np.array([r.lof_score for r in got]) == pytest.approx(lof(x, k), rel=1e-6)


def test_short_entities_get_no_score(spark):
    df = spark.sql("SELECT 'a' AS entity_id, timestamp_seconds(id * 60) AS time, cast(id AS double) AS value FROM range(12)")
    out = panel.local_outliers(df, neighbours=20)
    assert out.count() == 12 and out.filter(F.col("lof_score").isNotNull() | F.col("is_anomaly")).count() == 0


def all_pairs(frame, length, ahead, k, band):
    """Nearest windows by definition: every window of every symbol against the newest one of each."""

    def dtw(a, b):
        scale = lambda x: (x - x.min()) / (x.max() - x.min() + 1e-8)
        a, b = scale(a), scale(b)
        d = np.full((length + 1, length + 1), np.inf)
        d[0, 0] = 0
        for i in range(1, length + 1):
            for j in range(max(1, i - band), min(length, i + band) + 1):
                d[i, j] = abs(a[i - 1] - b[j - 1]) + min(d[i - 1, j], d[i, j - 1], d[i - 1, j - 1])
        return d[length, length] / length

    held = []
    for s, part in frame.groupby("symbol"):
        c = part.sort_values("ts")["close"].to_numpy()
        held += [(s, part.sort_values("ts")["ts"].iloc[i], c[i - length + 1 : i + 1], i + ahead < len(c)) for i in range(length - 1, len(c))]
    newest = {s: v for s, _, v, _ in held}  # the last one of each symbol stays
    return {q: sorted((dtw(v, w), s, t) for s, t, w, forward in held if forward)[:k] for q, v in newest.items()}


@pytest.mark.parametrize("block", [32_768, 40])
def test_similar_patterns_are_those_of_all_pairs(spark, block, monkeypatch):
    monkeypatch.setattr(panel, "BLOCK", block)
    monkeypatch.setattr(panel, "SEEDS", 3)
    rng = np.random.default_rng(12)
    frames = [pd.DataFrame({"symbol": s, "ts": pd.date_range("2024-01-01", periods=n, freq="h"), "close": 100 + rng.normal(size=n).cumsum()}) for s, n in (("a", 170), ("b", 150), ("c", 60), ("d", 11))]
    frames.append(frames[0].assign(symbol="copy"))  # equal distances
    frames.append(pd.DataFrame({"symbol": "flat", "ts": pd.date_range("2024-01-01", periods=40, freq="h"), "close": 7.0}))
    frame = pd.concat(frames)
    want = all_pairs(frame, 12, 3, 6, 3)
    got = panel.similar_patterns(spark.createDataFrame(frame), HOURLY, length=12, ahead=3, k=6, band=3).orderBy("query", "rank").collect()
    assert {r["query"] for r in got} == set(want) == {"a", "b", "c", "copy", "flat"}
    for q, best in want.items():
        own = [r for r in got if r["query"] == q]
        assert [r.dtw for r in own] == pytest.approx([d for d, *_ in best], abs=1e-12)
        assert [(r.symbol, r.ts) for r in own] == [(s, t.to_pydatetime()) for _, s, t in best]
