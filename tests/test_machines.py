"""Composable summaries against plain sequential runs, and the operators that use them on series of many time buckets."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from candlewick import fixtures as fx
from candlewick.operators import backtest, indicators, panel, risk, series
from candlewick.operators.machines import Affine, HighWater, Positions
from candlewick.operators.series import DAILY, HOURLY, fold, number
from candlewick.streaming import consolidators as con


def price_rows(n, seed, dense=False):
    rng = np.random.default_rng(seed)
    close = 50 + np.round(rng.normal(size=n), 2).cumsum()
    gaps = rng.integers(0, 2 if dense else 4000, n).cumsum()
    return pd.DataFrame({
        "ts": pd.Timestamp("2024-01-01") + pd.to_timedelta(gaps, unit="s"), "symbol": "a", "open": close, "high": close + rng.integers(0, 3, n) / 4, "low": close - rng.integers(0, 3, n) / 4,
        "close": close, "volume": rng.integers(1, 9, n).astype(float), "brick": (close - close[0]) / 0.7, "e": rng.random(n) < 0.2, "x": rng.random(n) < 0.07,
        "at": np.arange(1.0, n + 1), "last": np.arange(n) == n - 1,
    })


def position_step(machine):
    def step(rows, state):
        price, since, holds = *(state or [0.0, 0.0]), bool(state)
        for c, e, x, last, at in zip(*machine.columns(rows)):
            opened = False
            if not holds and e and c > 0:
                price, since, holds, opened = c, at, True, True
            if holds and (last or (not opened and (machine.reason(price, c) or x))):
                holds = False
        return None, ([price, since] if holds else [])

    return step


def machine_of(name):
    if name.startswith("positions"):
        stop, profit = {"positions": (2.0, 3.0), "positions_free": (0.0, 0.0), "positions_stop": (4.0, 0.0)}[name]
        m = Positions(lambda r: tuple(r[c].tolist() for c in ("close", "e", "x", "last", "at")), stop, profit)
        return m, position_step(m)
    step = {"time": lambda: con.time_step(["symbol"], 9000), "short": lambda: con.time_step(["symbol"], 1), "quote": lambda: con.quote_step(["symbol"], 20000), "range": lambda: con.range_step(["symbol"], 2.5), "wide": lambda: con.range_step(["symbol"], 40.0), "brick": lambda: con.brick_step(["symbol"])}[name]()
    return step.machine, step


@pytest.mark.parametrize("name", ["time", "short", "quote", "range", "wide", "brick", "positions", "positions_free", "positions_stop"])
@pytest.mark.parametrize("dense", [False, True])
def test_composed_summaries_equal_a_sequential_run(name, dense):
    machine, step = machine_of(name)
    for seed in range(6):
        rows = price_rows(160, seed, dense)
        cuts = [0, *sorted(random.Random(seed).sample(range(1, 160), 12)), 160]
        parts = [rows.iloc[a:b].reset_index(drop=True) for a, b in zip(cuts, cuts[1:])]
        sums = [machine.summarize(p) for p in parts]
        states, got = [], None
        for p in parts:
            states.append(step(p, states[-1] if states else None)[1])
        for s, want in zip(sums, states):
            got = machine.advance(s, got)
            assert got == pytest.approx(want)
        # any bracketing gives the same whole
        left = sums[0]
        for s in sums[1:]:
            left = machine.compose(left, s)
        right = sums[-1]
        for s in sums[-2::-1]:
            right = machine.compose(s, right)
        assert machine.advance(left, None) == pytest.approx(states[-1]) and machine.advance(right, None) == pytest.approx(states[-1])
        middle = machine.compose(machine.compose(sums[4], sums[5]), sums[6])
        assert machine.advance(middle, states[3]) == pytest.approx(states[6])


def test_affine_pieces():
    rng = np.random.default_rng(1)
    m, c = rng.normal(size=(37, 2, 2)) * 0.6, rng.normal(size=(37, 2))
    machine = Affine(2, lambda r: (m[r["i"]], c[r["i"]]))
    rows = pd.DataFrame({"i": np.arange(37)})
    y = np.zeros(2)
    for a, b in zip(m, c):
        y = a @ y + b
    parts = [machine.summarize(rows.iloc[a:b]) for a, b in ((0, 5), (5, 6), (6, 20), (20, 37))]
    whole = machine.compose(machine.compose(parts[0], parts[1]), machine.compose(parts[2], parts[3]))
    np.testing.assert_allclose(machine.advance(whole, None), y)


@pytest.fixture()
def no_walk(monkeypatch):
    def refuse(*a, **k):
        raise AssertionError("a series was walked in one task")

    monkeypatch.setattr(series, "_walk", refuse)


def frame(df, *order):
    return df.toPandas().sort_values(list(order)).reset_index(drop=True)


@pytest.mark.parametrize("name", ["time", "range", "quote"])
def test_bars_of_many_buckets(spark, sf, no_walk, name):
    bars = con.prices(fx.hourly(spark, sf), "close", "volume")
    step = {"time": lambda k: con.time_step(k, 5 * 3600), "range": lambda k: con.range_step(k, 30.0), "quote": lambda k: con.quote_step(k, 7 * 3600)}[name]
    a = frame(con.consolidate(bars, HOURLY.by(span=86400 * 2), step), "symbol", "start")
    b = frame(con.consolidate(bars, HOURLY.by(span=86400 * 40000), step), "symbol", "start")
    assert len(b) > 20
    pd.testing.assert_frame_equal(a, b)


def test_bricks_and_levels_of_hand_over(spark, sf, no_walk):
    bars = fx.hourly(spark, sf)
    a = frame(con.renko(bars, HOURLY.by(span=86400), "close", 5.0), "symbol", "start", "open")
    b = frame(con.renko(bars, HOURLY.by(span=86400 * 40000), "close", 5.0), "symbol", "start", "open")
    pd.testing.assert_frame_equal(a, b)
    step = con.time_step(["symbol"], 5 * 3600)
    schema = con._schema(bars, ["symbol"])
    for fan in (3, 5):  # 30 days in up to four levels
        c = frame(fold(con.prices(bars, "close", "volume"), HOURLY.by(span=86400), step, schema, machine=step.machine, fan=fan), "symbol", "start")
        d = frame(fold(con.prices(bars, "close", "volume"), HOURLY.by(span=86400 * 40000), step, schema), "symbol", "start")
        pd.testing.assert_frame_equal(c, d)


def test_holt_and_mcginley_of_many_buckets(spark, sf, no_walk):
    bars = fx.hourly(spark, sf)
    y = bars.select("symbol", "ts", F.col("close").alias("value"))
    axis = HOURLY.by(span=86400 * 3)
    wide = HOURLY.by(span=86400 * 40000)
    a, b = (frame(panel.forecast_holt(y, 4, axis=x), "symbol", "ts") for x in (axis, wide))
    pd.testing.assert_frame_equal(a, b, rtol=1e-9)
    a, b = (frame(indicators.mcginley(bars, x), "symbol", "ts") for x in (axis.by(span=86400 * 14), wide))
    pd.testing.assert_frame_equal(a, b, rtol=1e-9)


@pytest.mark.parametrize("high_water", [True, False])
def test_fees_of_many_buckets(spark, no_walk, high_water):
    rng = np.random.default_rng(8)
    rows = pd.DataFrame({"symbol": np.repeat(["a", "b"], 300), "ts": np.tile(pd.date_range("2000-01-31", periods=300, freq="ME"), 2), "ret": rng.normal(0.004, 0.05, 600)})
    table = spark.createDataFrame(rows)
    a, b = (frame(risk.fee_impact(table, DAILY.by(span=86400 * d), 0.02, 0.2, 0.03, high_water), "symbol", "ts") for d in (200, 100_000))
    assert (b["performance_fee"] > 0).sum() > 30 and len(b) == 600
    pd.testing.assert_frame_equal(a, b, rtol=1e-9, atol=1e-9)


def test_high_water_pieces():
    rng = np.random.default_rng(3)
    r = rng.normal(0.01, 0.06, 200)
    machine = HighWater(lambda d: (1 + r[d["i"]], 0.999 + r[d["i"]], 0.999 + r[d["i"]] - 0.2 * np.maximum(0, r[d["i"]])), 100.0)
    value, mark, states = 100.0, 100.0, []
    for x in r:
        gross = value * (1 + x)
        value, mark = (value * (0.999 + x - 0.2 * max(0.0, x)), gross) if gross > mark else (value * (0.999 + x), mark)
        states.append([value, mark])
    rows = pd.DataFrame({"i": np.arange(200)})
    cuts = [0, 1, 2, 50, 51, 120, 200]
    parts = [machine.summarize(rows.iloc[a:b]) for a, b in zip(cuts, cuts[1:])]
    state = None
    for s, end in zip(parts, cuts[1:]):
        state = machine.advance(s, state)
        assert state == pytest.approx(states[end - 1])
    whole = machine.compose(machine.compose(parts[1], parts[2]), machine.compose(parts[3], machine.compose(parts[4], parts[5])))
    assert machine.advance(whole, states[0]) == pytest.approx(states[-1])


@pytest.mark.parametrize("capital, walks", [(1e15, False), (60.0, True)])
def test_holdings_of_many_buckets(spark, sf, monkeypatch, capital, walks):
    if not walks:
        monkeypatch.setattr(series, "_walk", lambda *a, **k: (_ for _ in ()).throw(AssertionError("walked")))
    bars = number(fx.hourly(spark, sf), HOURLY, length="_n")
    rows = bars.withColumns({"enter": F.pmod(F.xxhash64("ts", "symbol"), F.lit(5)) == 0, "leave": F.pmod(F.xxhash64("symbol", "ts"), F.lit(9)) == 0})
    a, b = (frame(backtest.invest(rows, HOURLY.by(span=s), "enter", "leave", 4.0, 6.0, capital), "symbol", "ts") for s in (86400 * 2, 86400 * 40000))
    assert b["reason"].notna().sum() > 50 and set(b["reason"].dropna()) >= {"stop_loss", "take_profit"}
    pd.testing.assert_frame_equal(a[b.columns], b, check_dtype=False)
