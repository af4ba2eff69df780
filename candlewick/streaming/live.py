"""Live indicators and alerts with one small state per key.

A key's state holds what its next bar needs and nothing else: the last rows of the fields that windows look back on, the last value of every exponential
average, and whether the rules were met on the bar before. Its size follows from the parameters, not from the history. A micro-batch advances a key
by all its new bars at once: windows run over the held rows and the new ones, averages go on from their last value.
With ``idle`` an event-time timer clears the state of a key that has been silent for so long; its next bar starts a new warm-up.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from candlewick.operators.series import memory, span_alpha
from candlewick.operators.signals import TOLERANCE, conditions_of

FIELDS = ("open", "high", "low", "close", "volume")
Values = np.ndarray
Slots = dict[str, list[float]]


class Bars:
    """New bars of one key in order, with the slots its state held before; ``after`` collects the slots to hold next."""

    def __init__(self, fields: Mapping[str, Values], held: Slots, count: int):
        self.new, self.held, self.count = fields, held, count
        self.after: Slots = {}
        self.rows = len(next(iter(fields.values())))

    def past(self, slot: str, fresh: Values, n: int) -> Values:
        """``fresh`` behind the ``n`` values before it; missing ones are NaN."""
        old = np.asarray(self.held.get(slot, []), float)[-n:] if n else np.empty(0)
        whole = np.concatenate([np.full(n - len(old), np.nan), old, fresh])
        self.after[slot] = whole[len(whole) - n :].tolist()
        return whole

    def lag(self, slot: str, fresh: Values, n: int) -> Values:
        return self.past(slot, fresh, n)[: self.rows]

    def frames(self, slot: str, fresh: Values, n: int) -> Values:
        """The last ``n`` values at each new bar, one row a bar."""
        return np.lib.stride_tricks.sliding_window_view(self.past(slot, fresh, n - 1), n)

    def mean(self, slot: str, fresh: Values, n: int) -> Values:
        return self.frames(slot, fresh, n).mean(axis=1)

    def smooth(self, slot: str, fresh: Values, alpha: float) -> Values:
        """y = alpha * x + (1 - alpha) * y from the first value on; a missing x lets the weight of y fade."""
        old = self.held.get(slot, [])  # the last value and how many missing ones followed it
        before = [old[0], *[np.nan] * int(old[1])] if old else []
        out = pd.Series(np.concatenate([before, fresh])).ewm(alpha=alpha, adjust=False).mean().to_numpy()[len(before) :]
        known = np.flatnonzero(~np.isnan(fresh))
        gap = len(fresh) - 1 - known[-1] if len(known) else (int(old[1]) if old else 0) + len(fresh)
        if len(out) and not np.isnan(out[-1]):
            self.after[slot] = [float(out[-1]), float(min(gap, memory(alpha)))]
        return out


def _nonzero(x: Values) -> Values:
    return np.where(x != 0, x, np.nan)


def _true_range(b: Bars, slot: str) -> Values:
    before = b.lag(f"{slot}.c", b.new["close"], 1)
    return np.fmax.reduce([b.new["high"] - b.new["low"], np.abs(b.new["high"] - before), np.abs(b.new["low"] - before)])


def _sma(b: Bars, slot: str, period: int = 20, source: str = "close") -> dict[str, Values]:
    return {"value": b.mean(slot, b.new[source], period)}


def _ema(b: Bars, slot: str, period: int = 20, source: str = "close") -> dict[str, Values]:
    return {"value": b.smooth(slot, b.new[source], span_alpha(period))}


def _macd(b: Bars, slot: str, fast: int = 12, slow: int = 26, signal: int = 9) -> dict[str, Values]:
    quick, calm = (b.smooth(f"{slot}.{n}", b.new["close"], span_alpha(n_rows)) for n, n_rows in (("f", fast), ("s", slow)))
    line = quick - calm
    average = b.smooth(f"{slot}.z", line, span_alpha(signal))
    return {"line": line, "signal": average, "histogram": line - average}


def _rsi(b: Bars, slot: str, period: int = 14) -> dict[str, Values]:
    change = np.nan_to_num(b.new["close"] - b.lag(f"{slot}.c", b.new["close"], 1), nan=0.0)
    gain, loss = (b.mean(f"{slot}.{n}", np.maximum(x, 0.0), period) for n, x in (("g", change), ("l", -change)))
    return {"value": 100 - 100 / (1 + gain / _nonzero(loss))}


def _bollinger(b: Bars, slot: str, period: int = 20, k: float = 2.0) -> dict[str, Values]:
    frame = b.frames(slot, b.new["close"], period)
    middle, sd = frame.mean(axis=1), frame.std(axis=1, ddof=1) if period > 1 else np.full(b.rows, np.nan)
    upper, lower = middle + k * sd, middle - k * sd
    return {"upper": upper, "middle": middle, "lower": lower, "bandwidth": (upper - lower) / _nonzero(middle) * 100, "percent_b": (b.new["close"] - lower) / _nonzero(upper - lower)}


def _atr(b: Bars, slot: str, period: int = 14) -> dict[str, Values]:
    return {"value": b.mean(f"{slot}.t", _true_range(b, slot), period)}


def _range(b: Bars, slot: str, period: int) -> tuple[Values, Values]:
    return b.frames(f"{slot}.l", b.new["low"], period).min(axis=1), b.frames(f"{slot}.h", b.new["high"], period).max(axis=1)


def _stochastic(b: Bars, slot: str, period: int = 14, smooth: int = 3) -> dict[str, Values]:
    low, high = _range(b, slot, period)
    k = (b.new["close"] - low) / _nonzero(high - low) * 100
    return {"k": k, "d": b.mean(f"{slot}.k", k, smooth)}


def _williams(b: Bars, slot: str, period: int = 14) -> dict[str, Values]:
    low, high = _range(b, slot, period)
    return {"value": -100 * (high - b.new["close"]) / _nonzero(high - low)}


def _roc(b: Bars, slot: str, period: int = 12) -> dict[str, Values]:
    before = b.lag(slot, b.new["close"], period)
    return {"value": (b.new["close"] - before) / _nonzero(before) * 100}


def _momentum(b: Bars, slot: str, period: int = 10) -> dict[str, Values]:
    before = b.lag(slot, b.new["close"], period)
    return {"value": (b.new["close"] / np.where(before == 0, np.nan, before) - 1) * 100}


def _cci(b: Bars, slot: str, period: int = 20) -> dict[str, Values]:
    typical = (b.new["high"] + b.new["low"] + b.new["close"]) / 3.0
    frame = b.frames(slot, typical, period)
    mean = frame.mean(axis=1)
    return {"value": (typical - mean) / (0.015 * _nonzero(np.abs(frame - mean[:, None]).mean(axis=1)))}


def _adx(b: Bars, slot: str, period: int = 14) -> dict[str, Values]:
    a = span_alpha(period)
    up = b.new["high"] - b.lag(f"{slot}.h", b.new["high"], 1)
    down = b.lag(f"{slot}.l", b.new["low"], 1) - b.new["low"]
    span = b.smooth(f"{slot}.at", _true_range(b, slot), a)
    plus = 100 * b.smooth(f"{slot}.ap", np.where((up > down) & (up > 0), up, 0.0), a) / _nonzero(span)
    minus = 100 * b.smooth(f"{slot}.am", np.where((down > up) & (down > 0), down, 0.0), a) / _nonzero(span)
    return {"adx": b.smooth(f"{slot}.dx", np.abs(plus - minus) / _nonzero(plus + minus) * 100, a), "plus_di": plus, "minus_di": minus}


def _price(value: Callable[[Mapping[str, Values]], Values]) -> Callable:
    return lambda b, slot: {"value": value(b.new)}


#: Indicators with a live form and their outputs, under the names of the batch registry.
KINDS: dict[str, tuple[Callable[..., dict[str, Values]], tuple[str, ...]]] = {
    "sma": (_sma, ("value",)), "ema": (_ema, ("value",)), "macd": (_macd, ("line", "signal", "histogram")), "rsi": (_rsi, ("value",)),
    "bollinger": (_bollinger, ("upper", "middle", "lower", "bandwidth", "percent_b")), "atr": (_atr, ("value",)), "stochastic": (_stochastic, ("k", "d")),
    "williams_r": (_williams, ("value",)), "roc": (_roc, ("value",)), "momentum": (_momentum, ("value",)), "cci": (_cci, ("value",)), "adx": (_adx, ("adx", "plus_di", "minus_di")),
    "true_range": (lambda b, slot: {"value": _true_range(b, slot)}, ("value",)),
    **{f"price_{c}": (_price(lambda f, c=c: f[c]), ("value",)) for c in FIELDS},
    "hl2": (_price(lambda f: (f["high"] + f["low"]) / 2), ("value",)), "hlc3": (_price(lambda f: (f["high"] + f["low"] + f["close"]) / 3), ("value",)),
    "ohlc4": (_price(lambda f: (f["open"] + f["high"] + f["low"] + f["close"]) / 4), ("value",)),
}


def _known(names: Iterable[str]) -> None:
    missing = sorted(set(names) - set(KINDS))
    if missing:
        raise ValueError(f"no live form of {', '.join(missing)}; use jobs.indicator_stream or jobs.alert_stream")


def outputs(wanted: Mapping[str, tuple[str, dict]]) -> list[str]:
    """Result columns: the alias for a single value, alias_field otherwise."""
    return [alias if fields == ("value",) else f"{alias}_{f}" for alias, (name, _) in wanted.items() for fields in [KINDS[name][1]] for f in fields]


def indicate(b: Bars, wanted: Mapping[str, tuple[str, dict]]) -> dict[str, Values]:
    out = {}
    for alias, (name, params) in wanted.items():
        fn, fields = KINDS[name]
        found = fn(b, alias, **params)
        out |= {alias if fields == ("value",) else f"{alias}_{f}": found[f] for f in fields}
    return out


def _side(b: Bars, name: str, params: Mapping, field: str, slot: str) -> Values:
    fn, fields = KINDS[name]
    return fn(b, slot, **params)[field if field in fields else fields[0]]


def _last(b: Bars, slot: str, flags: Values, n: int, every: bool) -> Values:
    """Whether any (``every``: each) of the last ``n`` flags is set; flags before the first bar count as missing."""
    frame = b.frames(slot, flags, n)
    found = ~np.isnan(frame)
    return ((frame == 1) | ~found).all(axis=1) & found.any(axis=1) if every else (frame == 1).any(axis=1)


def _condition(b: Bars, r: Mapping, slot: str) -> Values:
    x = _side(b, r["indicator"], r.get("params", {}), r.get("field", "value"), f"{slot}.x")
    other = r.get("compare_indicator")
    y = _side(b, other, r.get("compare_params", {}), r.get("compare_field", "value"), f"{slot}.y") if other else np.full(b.rows, float(r.get("value", 0)))
    op, n = r.get("operator", ">"), int(r.get("lookback", 5))
    if op in ("crosses_above", "crosses_below", "crossed_above_within", "crossed_below_within"):
        above = "above" in op
        px = b.lag(f"{slot}.px", x, 1)
        py = b.lag(f"{slot}.py", y, 1) if other else y
        hit = (px <= py) & (x > y) if above else (px >= py) & (x < y)
        return hit if op.startswith("crosses") else _last(b, f"{slot}.hit", hit.astype(float), n, False)
    if op in ("rising", "falling"):
        px = b.lag(f"{slot}.px", x, 1)
        step = (x > px if op == "rising" else x < px).astype(float)
        place = b.count + 1 + np.arange(b.rows)
        return _last(b, f"{slot}.hit", np.where(place > 1, step, np.nan), max(n - 1, 1), True) & (place >= 2)
    if r.get("offset"):
        x = b.lag(f"{slot}.ox", x, int(r["offset"]))
    if other and r.get("compare_offset"):
        y = b.lag(f"{slot}.oy", y, int(r["compare_offset"]))
    if op == "between":
        upper = r.get("value2")
        return (x >= float(r.get("value", 0))) & (x <= float(upper)) if upper is not None else np.zeros(b.rows, bool)
    tests = {">": x > y, "<": x < y, ">=": x >= y, "<=": x <= y, "==": np.abs(x - y) < TOLERANCE}
    return tests.get(op, np.zeros(b.rows, bool))


def meets(b: Bars, rules: Sequence, slot: str = "rule") -> Values:
    """Whether a rule group holds at each new bar."""
    parsed, logic = conditions_of(rules)
    parts = [_condition(b, r, f"{slot}{i}") for i, r in enumerate(parsed)]
    if not parts:
        return np.zeros(b.rows, bool)
    return np.logical_and.reduce(parts) if logic == "AND" else np.logical_or.reduce(parts)


class _Keeper(StatefulProcessor):
    """Advances the slots of a key by its new bars; ``step(bars) -> result columns and rows to emit``."""

    def __init__(self, step: Callable[[Bars], tuple[dict[str, Values], Values]], columns: Sequence[str], ts: str, idle_ms: int | None):
        self.step, self.columns, self.ts, self.idle_ms = step, list(columns), ts, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("live", "n bigint, last bigint, slots map<string, array<double>>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        part = pd.concat(list(rows), ignore_index=True)
        n, last, held = self.state.get() if self.state.exists() else (0, None, {})
        at = part[self.ts].astype("datetime64[us]").astype("int64")
        part = part.assign(_at=at).sort_values("_at", kind="stable").drop_duplicates("_at", keep="last")
        if last is not None:
            part = part[part["_at"] > last]
        if part.empty:
            return
        bars = Bars({c: part[c].astype("float64").to_numpy() for c in FIELDS}, held, n)
        with np.errstate(all="ignore"):
            found, emitted = self.step(bars)
        last = int(part["_at"].iloc[-1])
        self.state.update((n + bars.rows, last, bars.after))
        if self.idle_ms is not None:
            for old in list(self.handle.listTimers()):
                self.handle.deleteTimer(old)
            self.handle.registerTimer(last // 1000 + self.idle_ms)
        out = part[self.columns].assign(**found)
        yield out[emitted] if emitted is not None else out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.state.clear()
        return iter([])


def _run(bars: DataFrame, keys: Sequence[str], ts: str, step, extra: T.StructType, delay: str | None, idle_s: float | None) -> DataFrame:
    if idle_s is not None and delay is None:
        raise ValueError("idle needs a watermark delay")
    schema = T.StructType([*bars.schema.fields, *extra.fields])
    rows = bars.withWatermark(ts, delay) if delay else bars
    keeper = _Keeper(step, bars.columns, ts, None if idle_s is None else int(idle_s * 1000))
    return rows.groupBy(*keys).transformWithStateInPandas(keeper, schema, "Append", "None" if idle_s is None else "EventTime")


def live_indicators(bars: DataFrame, wanted: Mapping[str, tuple[str, dict]], keys: Sequence[str] = ("symbol",), ts: str = "ts", delay: str | None = None, idle_s: float | None = None) -> DataFrame:
    """Stream of bars with indicators ``{alias: (name, parameters)}`` and ``ready``: every one is past its warm-up.

    Bars of a key are taken in time order; of bars with equal times in a micro-batch the last counts, and a bar that is not newer than those its key has
    seen is left out. A key's rows of one micro-batch are in memory together, so the source should limit its batches.
    Needs the RocksDB state store.
    """
    _known(name for name, _ in wanted.values())
    names = outputs(wanted)

    def step(b: Bars) -> tuple[dict[str, Values], None]:
        found = indicate(b, wanted)
        return found | {"ready": np.logical_and.reduce([~np.isnan(v) for v in found.values()])}, None

    extra = T.StructType([*[T.StructField(n, T.DoubleType()) for n in names], T.StructField("ready", T.BooleanType())])
    return _run(bars, keys, ts, step, extra, delay, idle_s)


def live_alerts(bars: DataFrame, rules: Sequence, keys: Sequence[str] = ("symbol",), ts: str = "ts", delay: str | None = None, idle_s: float | None = None) -> DataFrame:
    """Bars of a stream on which a rule group turns from false to true; order and lateness as in :func:`live_indicators`."""
    parsed, _ = conditions_of(rules)
    _known(n for r in parsed for n in (r["indicator"], r.get("compare_indicator")) if n)

    def step(b: Bars) -> tuple[dict[str, Values], Values]:
        met = meets(b, rules)
        before = b.lag("met", met.astype(float), 1)
        return {}, met & ~(before == 1)

    return _run(bars, keys, ts, step, T.StructType([]), delay, idle_s)


def rocksdb(spark) -> None:
    """Choose the state store that keyed timers need, if the session has not."""
    name = "spark.sql.streaming.stateStore.providerClass"
    if "RocksDB" not in spark.conf.get(name, ""):
        spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def write_stream(rows: DataFrame, target: str, checkpoint: str, once: bool = False):
    """Append a stream to Parquet with Spark's file sink, which takes each batch exactly once."""
    rocksdb(rows.sparkSession)
    w = rows.writeStream.format("parquet").outputMode("append").option("path", target).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if once else w.trigger(processingTime="10 seconds")).start()
