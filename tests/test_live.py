"""Keyed live indicators and alerts against their batch forms, and what their state holds."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from candlewick import fixtures as fx
from candlewick.operators import indicators, signals
from candlewick.plans.streaming import CROSS, STREAMED
from candlewick.streaming import jobs, live

RULES = [
    CROSS,
    [{"indicator": "macd", "field": "histogram", "params": {"fast": 3, "slow": 6, "signal": 3}, "operator": "crosses_below", "value": 0}, "AND", {"indicator": "price_close", "operator": "falling", "lookback": 2}],
    [{"indicator": "price_close", "operator": ">", "offset": 2, "compare_indicator": "sma", "compare_params": {"period": 5}, "compare_offset": 1}],
    [{"indicator": "stochastic", "field": "d", "operator": "between", "value": 40, "value2": 80}, "OR", {"indicator": "roc", "operator": "crossed_above_within", "value": 0, "lookback": 4}],
]


def walk(n, seed, holes=()):
    rng = np.random.default_rng(seed)
    close = 50 + rng.normal(size=n).cumsum()
    out = pd.DataFrame({"open": close + 0.1, "high": close + rng.random(n), "low": close - rng.random(n), "close": close, "volume": rng.integers(1, 99, n).astype(float)})
    out.loc[list(holes), ["close", "high"]] = np.nan
    return out


def pieces(n, seed):
    cuts = np.sort(np.random.default_rng(seed).choice(np.arange(1, n), 9, replace=False))
    return list(zip([0, *cuts], [*cuts, n]))


def advance(frame, step, seed=1):
    """Rows of ``step`` over the frame cut into pieces, with the sizes of the state after each."""
    held, count, out, sizes = {}, 0, [], []
    for lo, hi in pieces(len(frame), seed):
        b = live.Bars({c: frame[c].to_numpy()[lo:hi] for c in live.FIELDS}, held, count)
        with np.errstate(all="ignore"):
            out.append(step(b))
        held, count = b.after, count + hi - lo
        sizes.append(sum(map(len, held.values())))
    return out, sizes


@pytest.mark.parametrize("holes", [(), (0, 7, 8, 60, 119)])
def test_pieces_equal_the_batch(spark, holes):
    frame = walk(120, 3, holes)
    table = frame.assign(symbol="a", ts=pd.date_range("2024-01-01", periods=120, freq="h"))
    batch = indicators.compute(spark.createDataFrame(table.astype(object).where(table.notna(), None), "open double, high double, low double, close double, volume double, symbol string, ts timestamp"), STREAMED)
    batch = batch.toPandas().sort_values("ts")
    parts, sizes = advance(frame, lambda b: live.indicate(b, STREAMED))
    names = live.outputs(STREAMED)
    for n in names:
        got = np.concatenate([p[n] for p in parts])
        if holes and n.startswith(("cci", "rsi", "adx")):
            continue  # windows over missing prices: the batch counts rows, not values
        np.testing.assert_allclose(got, batch[n].astype(float), rtol=1e-9, atol=1e-9, err_msg=n)
    assert sizes[-1] <= sizes[3] + 5 and max(sizes) < 400


@pytest.mark.parametrize("rules", RULES)
def test_rules_in_pieces_equal_the_batch(spark, rules):
    frame = walk(150, 5)
    table = frame.assign(symbol="a", ts=pd.date_range("2024-01-01", periods=150, freq="h"))
    met = signals.evaluate_groups(spark.createDataFrame(table), {"met": rules}).toPandas().sort_values("ts")["met"].fillna(False).astype(bool)
    parts, _ = advance(frame, lambda b: live.meets(b, rules))
    got = np.concatenate(parts)
    assert got.tolist() == met.tolist() and 0 < got.sum() < 150


def test_unknown_indicators_are_named(spark, sf):
    with pytest.raises(ValueError, match="supertrend"):
        live.live_indicators(fx.hourly(spark, sf), {"x": ("supertrend", {})})


def in_files(spark, rows, folder, parts):
    table = spark.createDataFrame(rows, "symbol string, ts timestamp, open double, high double, low double, close double, volume double")
    for part in parts:
        table.filter(F.col("ts").between(*[F.lit(p) for p in part])).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1).parquet(folder)


def test_late_repeated_and_idle_keys(spark, tmp_path):
    live.rocksdb(spark)
    day = lambda d, h=0: dt.datetime(2024, 1, d, h)
    bar = lambda s, t, x: (s, t, x, x, x, x, 1.0)
    rows = [bar("a", day(1, h), float(h)) for h in range(6)] + [bar("a", day(1, 5), 50.0)] + [bar("b", day(d), float(d)) for d in range(1, 29)] + [bar("a", day(28, h), float(h)) for h in range(4)]
    stream = in_files(spark, rows, str(tmp_path / "in"), [(day(1), day(1, 23)), (day(2), day(9)), (day(10), day(20)), (day(21), day(27)), (day(28), day(28, 23)), (day(1), day(1, 23))])
    out = live.live_indicators(stream, {"sma": ("sma", {"period": 3})}, delay="1 hour", idle_s=5 * 86400)
    live.write_stream(out, str(tmp_path / "out"), str(tmp_path / "cp"), once=True).awaitTermination()
    got = {(r.symbol, r.ts): r.sma for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert len(got) == 6 + 28 + 4  # bars seen again add nothing
    a = [got["a", day(1, h)] for h in range(6)]
    assert a[:2] == [None, None] and a[2:5] == [1.0, 2.0, 3.0] and a[5] in (4.0, (3 + 4 + 50) / 3)
    assert [got["a", day(28, h)] for h in range(4)] == [None, None, 1.0, 2.0]  # cleared while silent
    assert got["b", day(28)] == 27.0  # never silent for so long


def test_alert_stream_equals_the_batch(spark, sf, tmp_path):
    live.rocksdb(spark)
    bars = fx.hourly(spark, sf)
    bounds = bars.agg(F.min("ts"), F.max("ts")).first()
    mid = bounds[0] + (bounds[1] - bounds[0]) / 2
    rows = [tuple(r) for r in bars.select("symbol", "ts", *[F.col(c).cast("double") for c in live.FIELDS]).collect()]
    stream = in_files(spark, rows, str(tmp_path / "in"), [(bounds[0], mid), (mid + dt.timedelta(microseconds=1), bounds[1])])
    live.write_stream(live.live_alerts(stream, CROSS), str(tmp_path / "out"), str(tmp_path / "cp"), once=True).awaitTermination()
    got = sorted((r.symbol, r.ts) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == sorted((r.symbol, r.ts) for r in jobs.alerts(bars, CROSS).collect()) and len(got) > 10
