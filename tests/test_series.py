"""The block kernels against plain pandas loops; tiny blocks force many borders."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from candlewick.operators import ranking, series
from candlewick.operators.series import Axis

TINY = Axis(span=3600 * 7, rows=5)


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(3)
    rows = []
    for symbol, n in (("a", 60), ("b", 23), ("c", 1)):
        t = 0
        for i in range(n):
            t += int(rng.integers(1, 6)) * 3600
            rows.append((symbol, pd.Timestamp("2024-01-01") + pd.Timedelta(seconds=t), float(np.round(rng.normal(50, 5), 3))))
    pdf = pd.DataFrame(rows, columns=["symbol", "ts", "x"])
    pdf.loc[pdf.index % 9 == 4, "x"] = np.nan
    return pdf


@pytest.fixture(scope="module")
def frame(spark, data):
    return spark.createDataFrame(data).withColumn("x", F.when(~F.isnan("x"), F.col("x")))


def back(df, cols):
    return df.toPandas().sort_values(["symbol", "ts"]).reset_index(drop=True)[cols]


def close(a, b):
    np.testing.assert_allclose(np.asarray(a, dtype=float), np.asarray(b, dtype=float), rtol=1e-12, atol=1e-12, equal_nan=True)


def test_number(frame, data):
    got = back(series.number(frame, TINY), ["_pos"])
    close(got["_pos"], data.groupby("symbol").cumcount() + 1)


def test_frames_cross_block_borders(frame, data):
    got = back(
        series.over_blocks(
            frame, TINY, lambda w: {"m": F.avg("x").over(series.trailing(w, 8)), "l": F.lag("x", 3).over(w), "n": F.lead("x", 2).over(w)}, back=7, ahead=2
        ),
        ["m", "l", "n"],
    )
    g = data.groupby("symbol")["x"]
    close(got["m"], g.transform(lambda s: s.rolling(8, min_periods=1).mean()))
    close(got["l"], g.shift(3))
    close(got["n"], g.shift(-2))


@pytest.mark.parametrize("kind", ["sum", "max", "min", "count"])
def test_prefix(frame, data, kind):
    got = back(series.prefix(frame, TINY, {"y": (kind, "x")}), ["y"])
    fn = {"sum": "cumsum", "max": "cummax", "min": "cummin"}
    g = data.groupby("symbol")["x"]
    if kind == "count":
        want = g.transform(lambda s: s.notna().cumsum())
    else:
        want = g.transform(lambda s: getattr(s, fn[kind])().ffill())
    close(got["y"], want)


def test_prefix_known_values(frame, data):
    got = back(series.prefix(frame, TINY, {"f": ("last", "x")}), ["f"])
    close(got["f"], data.groupby("symbol")["x"].ffill())
    got = back(series.prefix(frame, TINY, {"f": ("last", "x")}, backward=True), ["f"])
    close(got["f"], data.groupby("symbol")["x"].bfill())
    got = back(series.prefix(frame, TINY, {"f": ("sum", "x")}, exclusive=True), ["f"])
    close(got["f"].fillna(0), data.groupby("symbol")["x"].transform(lambda s: s.fillna(0).cumsum().shift(1).fillna(0)))


def test_over_time(frame, data):
    got = back(series.over_time(frame, TINY.by(span=3600), 36000, lambda w: {"y": F.sum("x").over(w)}), ["y"])
    want = (
        data.set_index("ts").groupby("symbol")["x"].rolling("36000s").sum().reset_index().sort_values(["symbol", "ts"])["x"]
    )
    close(got["y"], want)


def test_smooth_has_enough_memory(frame, data):
    chain = [("e", "x", 0.5), ("ee", "e", 0.4), ("s", "x", 0.5, "std")]
    axis = TINY.by(rows=8)
    got = back(series.smoothed(frame, axis, chain), ["e", "ee"])
    g = data.groupby("symbol")["x"]
    e = g.transform(lambda s: s.ewm(alpha=0.5, adjust=False).mean())
    ee = e.groupby(data["symbol"]).transform(lambda s: s.ewm(alpha=0.4, adjust=False).mean())
    close(got["e"], e)
    close(got["ee"], ee)


def test_linear_scan(frame, data):
    rows = frame.withColumn("k", F.col("x") / 200)
    got = back(series.linear_scan(rows, TINY, "y", F.col("k"), F.col("x")), ["y"])
    want = []
    for _, part in data.groupby("symbol"):
        y = 0.0
        for x in part["x"]:
            if x == x:
                y = x / 200 * y + x
            want.append(y)
    close(got["y"], want)


def test_fold_equals_sequential(spark, frame, data):
    def step(part, state):
        y = 0.0 if state is None else state[0]
        out = []
        for x in part["x"]:
            x = 0.0 if x is None or x != x else x
            y = 0.0 if y > 120 else y + x / 2
            out.append(y)
        part = part[["symbol", "ts"]].copy()
        part["y"] = out
        return part, [y]

    got = back(series.fold(frame, TINY, step, "symbol string, ts timestamp, y double"), ["y"])
    want = []
    for _, part in data.groupby("symbol"):
        want += list(step(part, None)[0]["y"])
    close(got["y"], want)


def test_ranks_and_quantiles(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 400), "v": np.round(rng.normal(0, 1, 400), 1)})
    pdf.loc[::17, "v"] = 0.0
    df = spark.createDataFrame(pdf.reset_index())
    for method in ("average", "min", "max"):
        got = ranking.ranked(df, ["g"], "v", "r", method).toPandas().sort_values("index")
        close(got["r"], pdf.groupby("g")["v"].rank(method=method))
        got = ranking.ranked(df, ["g"], "v", "r", method, ascending=False).toPandas().sort_values("index")
        close(got["r"], pdf.groupby("g")["v"].rank(method=method, ascending=False))
    got = ranking.quantiles(df, ["g"], "v", {"a": 0.1, "b": 0.5, "c": 1.0}).toPandas().sort_values("g")
    for name, q in (("a", 0.1), ("b", 0.5), ("c", 1.0)):
        close(got[name], pdf.groupby("g")["v"].quantile(q))


def test_memory():
    assert (1 - 0.1) ** series.memory(0.1) < 1e-20
    assert series.memory(1.0) == 1
    assert math.isclose(series.span_alpha(9), 0.2)


@pytest.mark.parametrize("buckets", [3, 10, 100])
def test_fold_of_a_state_that_remembers(spark, buckets, monkeypatch):
    """A running balance never agrees with the assumed start; passes must not grow with the buckets."""
    from candlewick.operators.series import Axis, fold

    axis = Axis(key=("symbol",), order=("ts",), span=3600)
    start = dt.datetime(2024, 1, 1)
    rows = [(s, start + dt.timedelta(minutes=20 * i), float(i % 7 - 2)) for s in ("a", "b") for i in range(3 * buckets)] + [("c", start, 1.0)]
    df = spark.createDataFrame(rows, "symbol string, ts timestamp, x double")

    def step(part, state):
        total = 0.0 if state is None else state[0]
        out = []
        for v in part["x"]:
            total = total * 0.99 + v
            out.append(total)
        return part[["symbol", "ts", "x"]].assign(total=out), [total]

    calls = []
    frame = type(df)
    keep = frame.checkpoint
    monkeypatch.setattr(frame, "checkpoint", lambda self, *a, **b: calls.append(1) or keep(self, *a, **b))
    got = {(r.symbol, r.ts): r.total for r in fold(df, axis, step, "symbol string, ts timestamp, x double, total double").collect()}
    total = {}
    for s, ts, x in rows:
        total[s] = total.get(s, 0.0) * 0.99 + x
        assert got[s, ts] == pytest.approx(total[s], rel=1e-12)
    assert len(got) == len(rows) and len(calls) <= 9
