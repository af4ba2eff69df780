"""Technical indicators as column builders over one cut of the bars into blocks.

An indicator is a function that adds stages to a :class:`Build`: window columns, exponential averages, more window
columns.  :func:`compute` runs the stages of many indicators together, so all of them share the numbering, the block
shuffle and one pass per kind of stage.  Running totals (OBV and the like) go through the prefix kernel first.
Indicators whose recurrence has a coefficient per row, or that are state machines, are in the second half.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.functions.scalars import clamp
from candlewick.operators.series import (
    HOURLY,
    POS,
    Axis,
    blocked,
    core,
    fold,
    full,
    linear_scan,
    memory,
    number,
    over_blocks,
    prefix,
    smooth,
    smoothed,
    span_alpha,
    span_of,
    trailing,
)
from candlewick.operators.windows import positive

Cols = Callable[[WindowSpec], Mapping[str, Column]]
REGISTRY: dict[str, tuple[Callable, tuple[str, ...]]] = {}


class Build:
    """Stages of one indicator; names are private to it."""

    def __init__(self, alias: str):
        self.alias = alias
        self.ahead = 0
        self.before: list[tuple[Cols, int]] = []
        self.running: dict[str, tuple[str, Column]] = {}
        self.stages: list[tuple] = []

    def name(self, n: str) -> str:
        return f"{self.alias}__{n}"

    def __getitem__(self, n: str) -> Column:
        return F.col(self.name(n))

    def _named(self, fn: Cols) -> Cols:
        return lambda w: {self.name(n): c for n, c in fn(w).items()}

    def cols(self, fn: Cols, reach: int = 0, ahead: int = 0) -> None:
        """Window columns looking back ``reach`` and ahead ``ahead`` rows."""
        self.ahead = max(self.ahead, ahead)
        self.stages.append(("cols", self._named(fn), reach))

    def ewm(self, *chain: tuple) -> None:
        """Exponential averages (out, input, alpha); an input written earlier by this indicator wins."""
        out = []
        depth: dict[str, int] = {}
        for name, source, alpha, *kind in chain:
            src = self.name(source[1:]) if source.startswith(".") else source
            out.append((self.name(name), src, alpha, *kind))
            depth[name] = depth.get(source[1:], 0) + memory(alpha)
        self.stages.append(("ewm", out, max(depth.values())))

    def first(self, fn: Cols, reach: int) -> None:
        """Window columns needed by the running totals."""
        self.before.append((self._named(fn), reach))

    def total(self, name: str, kind: str, value: Column) -> None:
        self.running[self.name(name)] = (kind, value)


def indicator(name: str, *outputs: str):
    """Register a builder under a name with its output fields."""

    def add(fn):
        REGISTRY[name] = (fn, outputs or ("value",))
        return fn

    return add


def outputs_of(alias: str, name: str) -> dict[str, str]:
    """Result column per field: the alias for a single value, alias_field otherwise."""
    fields = REGISTRY[name][1]
    return {f: alias if fields == ("value",) else f"{alias}_{f}" for f in fields}


def compute(
    bars: DataFrame,
    wanted: Mapping[str, tuple[str, dict]] | Sequence[str],
    axis: Axis = HOURLY,
    keep_pos: bool = False,
    after: Sequence[Cols] = (),
    after_reach: int = 0,
) -> DataFrame:
    """Add indicators ``{alias: (name, parameters)}`` (or names with default parameters) to the bars.

    ``after`` adds window columns that use the indicators, in the same blocks; their frames look back
    ``after_reach`` rows together.
    """
    if not isinstance(wanted, Mapping):
        wanted = {n: (n, {}) for n in wanted}
    builds, results = [], {}
    for alias, (name, params) in wanted.items():
        b = Build(alias)
        REGISTRY[name][0](b, **params)
        builds.append(b)
        results.update({out: b.name(f) for f, out in outputs_of(alias, name).items()})
    keep = bars.columns + ([POS] if keep_pos and POS not in bars.columns else [])
    rows = bars if POS in bars.columns else number(bars, axis)
    before = [x for b in builds for x in b.before]
    if before:
        merged = lambda w: {n: c for fn, _ in before for n, c in fn(w).items()}
        rows = over_blocks(rows, axis, merged, back=max(r for _, r in before), keep_pos=True)
    running = {n: s for b in builds for n, s in b.running.items()}
    if running:
        rows = prefix(rows, axis, running)
    back = max((sum(s[2] for s in b.stages) for b in builds), default=0) + after_reach
    rows = blocked(rows, axis, back=back, ahead=max((b.ahead for b in builds), default=0))
    w = span_of(axis)
    for i in range(max((len(b.stages) for b in builds), default=0)):
        level = [b.stages[i] for b in builds if i < len(b.stages)]
        cols = {n: c for kind, fn, _ in level if kind == "cols" for n, c in fn(w).items()}
        if cols:
            rows = rows.withColumns(cols)
        chain = [c for kind, ch, _ in level if kind == "ewm" for c in ch]
        if chain:
            rows = smooth(rows, axis, chain)
    rows = rows.withColumns({out: F.col(src) for out, src in results.items()})
    added: list[str] = []
    for step in after:
        cols = dict(step(w))
        rows = rows.withColumns(cols)
        added += [c for c in cols if c not in added]
    return core(rows, keep_pos=True).select(*keep, *results, *[F.col(f"`{c}`") for c in added if c not in results])


# --- building blocks ------------------------------------------------------------------------------------------------


def _bar_column(name: str) -> Callable[[], Column]:
    return lambda: F.col(name)


O, H, L, C, V = (_bar_column(c) for c in ("open", "high", "low", "close", "volume"))


def TYPICAL() -> Column:
    return (H() + L() + C()) / 3.0


def avg_n(w: WindowSpec, x: Column | str, n: int) -> Column:
    x = F.col(x) if isinstance(x, str) else x
    return full(F.avg(x).over(trailing(w, n)), x, w, n)


def sum_n(w: WindowSpec, x: Column | str, n: int) -> Column:
    x = F.col(x) if isinstance(x, str) else x
    return full(F.sum(x).over(trailing(w, n)), x, w, n)


def max_n(w: WindowSpec, x: Column, n: int) -> Column:
    return full(F.max(x).over(trailing(w, n)), x, w, n)


def min_n(w: WindowSpec, x: Column, n: int) -> Column:
    return full(F.min(x).over(trailing(w, n)), x, w, n)


def weighted(w: WindowSpec, x: Column | str, weights: Sequence[float]) -> Column:
    """Σ weight · value over the last len(weights) rows, oldest weight first."""
    n = len(weights)
    x = F.col(x) if isinstance(x, str) else x
    out = F.lit(0.0)
    for i, k in enumerate(weights):
        out = out + F.lag(x, n - 1 - i).over(w) * F.lit(float(k))
    return out


def linear_weighted(w: WindowSpec, x: Column | str, n: int) -> Column:
    total = n * (n + 1) / 2
    return weighted(w, x, [i / total for i in range(1, n + 1)])


def true_range(w: WindowSpec) -> Column:
    prev = F.lag(C()).over(w)
    return F.greatest(H() - L(), F.abs(H() - prev), F.abs(L() - prev))


def change_n(w: WindowSpec, x: Column, n: int) -> Column:
    return x - F.lag(x, n).over(w)


# --- moving averages ------------------------------------------------------------------------------------------------


@indicator("sma")
def _sma(b, period=20, source="close"):
    b.cols(lambda w: {"value": avg_n(w, source, period)}, period - 1)


@indicator("ema")
def _ema(b, period=20, source="close"):
    b.ewm(("value", source, span_alpha(period)))


@indicator("dema")
def _dema(b, period=20):
    a = span_alpha(period)
    b.ewm(("e1", "close", a), ("e2", ".e1", a))
    b.cols(lambda w: {"value": 2 * b["e1"] - b["e2"]})


@indicator("tema")
def _tema(b, period=20):
    a = span_alpha(period)
    b.ewm(("e1", "close", a), ("e2", ".e1", a), ("e3", ".e2", a))
    b.cols(lambda w: {"value": 3 * b["e1"] - 3 * b["e2"] + b["e3"]})


@indicator("rma")
def _rma(b, period=14):
    b.ewm(("value", "close", 1.0 / period))


@indicator("wma")
def _wma(b, period=20):
    b.cols(lambda w: {"value": linear_weighted(w, "close", period)}, period - 1)


@indicator("hma")
def _hma(b, period=20):
    half, root = max(period // 2, 1), max(int(math.sqrt(period)), 1)
    b.cols(lambda w: {"raw": 2 * linear_weighted(w, "close", half) - linear_weighted(w, "close", period)}, period - 1)
    b.cols(lambda w: {"value": linear_weighted(w, b["raw"], root)}, root - 1)


@indicator("tma")
def _tma(b, period=20):
    b.cols(lambda w: {"s": avg_n(w, "close", period)}, period - 1)
    b.cols(lambda w: {"value": avg_n(w, b["s"], period)}, period - 1)


@indicator("vwma")
def _vwma(b, period=20):
    b.cols(lambda w: {"value": sum_n(w, C() * V(), period) / positive(sum_n(w, "volume", period))}, period - 1)


@indicator("alma")
def _alma(b, period=9, offset=0.85, sigma=6.0):
    m, s = offset * (period - 1), period / sigma
    raw = [math.exp(-((i - m) ** 2) / (2 * s * s)) for i in range(period)]
    b.cols(lambda w: {"value": weighted(w, "close", [x / sum(raw) for x in raw])}, period - 1)


@indicator("zlema")
def _zlema(b, period=20):
    lag = (period - 1) // 2
    b.cols(lambda w: {"x": 2 * C() - F.coalesce(F.lag(C(), lag).over(w), C())}, lag)
    b.ewm(("value", ".x", span_alpha(period)))


@indicator("t3")
def _t3(b, period=5, factor=0.7):
    a, v = span_alpha(period), factor
    b.ewm(("e1", "close", a), *[(f"e{i}", f".e{i - 1}", a) for i in range(2, 7)])
    c1, c2 = -(v**3), 3 * v**2 + 3 * v**3
    c3, c4 = -6 * v**2 - 3 * v - 3 * v**3, 1 + 3 * v + v**3 + 3 * v**2
    b.cols(lambda w: {"value": c1 * b["e6"] + c2 * b["e5"] + c3 * b["e4"] + c4 * b["e3"]})


@indicator("vama")
def _vama(b, period=20):
    b.cols(lambda w: {"r": V() * C() / positive(avg_n(w, "volume", period))}, period - 1)
    b.cols(lambda w: {"value": sum_n(w, b["r"] * C(), period) / positive(sum_n(w, b["r"], period))}, period - 1)


# --- momentum -------------------------------------------------------------------------------------------------------


def _gains(b, n=1):
    b.cols(lambda w: {"d": change_n(w, C(), n)}, n)
    known = b["d"].isNotNull()
    b.cols(lambda w: {"g": F.when(known, F.greatest(b["d"], F.lit(0.0))), "l": F.when(known, F.greatest(-b["d"], F.lit(0.0)))})


def _from_ratio(g: Column, l: Column) -> Column:
    return 100 - 100 / (1 + g / positive(l))


@indicator("rsi")
def _rsi(b, period=14):
    """Simple means; the missing first change counts as zero."""
    b.cols(lambda w: {"d": F.coalesce(change_n(w, C(), 1), F.lit(0.0))}, 1)
    b.cols(lambda w: {"value": _from_ratio(avg_n(w, F.greatest(b["d"], F.lit(0.0)), period), avg_n(w, F.greatest(-b["d"], F.lit(0.0)), period))}, period - 1)


@indicator("rsi_wilder")
def _rsi_wilder(b, period=14):
    _gains(b)
    b.ewm(("ag", ".g", 1.0 / period), ("al", ".l", 1.0 / period))
    b.cols(lambda w: {"value": F.when(F.col(POS) > period, _from_ratio(b["ag"], b["al"]))})


@indicator("stochastic", "k", "d")
def _stochastic(b, period=14, smooth=3):
    def k(w):
        low, high = min_n(w, L(), period), max_n(w, H(), period)
        return {"k": (C() - low) / positive(high - low) * 100}

    b.cols(k, period - 1)
    b.cols(lambda w: {"d": avg_n(w, b["k"], smooth)}, smooth - 1)


@indicator("stoch_rsi")
def _stoch_rsi(b, period=14, stoch=14):
    _rsi(b, period)
    b.cols(lambda w: {"r": b["value"], "lo": min_n(w, b["value"], stoch), "hi": max_n(w, b["value"], stoch)}, stoch - 1)
    b.cols(lambda w: {"value": (b["r"] - b["lo"]) / positive(b["hi"] - b["lo"]) * 100})


@indicator("williams_r")
def _williams(b, period=14):
    b.cols(lambda w: {"value": -100 * (max_n(w, H(), period) - C()) / positive(max_n(w, H(), period) - min_n(w, L(), period))}, period - 1)


@indicator("roc")
def _roc(b, period=12):
    b.cols(lambda w: {"value": change_n(w, C(), period) / positive(F.lag(C(), period).over(w)) * 100}, period)


@indicator("momentum")
def _momentum(b, period=10):
    b.cols(lambda w: {"value": (C() / F.lag(C(), period).over(w) - 1) * 100}, period)


@indicator("change_pct")
def _change_pct(b):
    b.cols(lambda w: {"value": F.coalesce((C() / F.lag(C()).over(w) - 1) * 100, F.lit(0.0))}, 1)


@indicator("cmo")
def _cmo(b, period=14):
    _gains(b)
    b.cols(lambda w: {"sg": sum_n(w, b["g"], period), "sl": sum_n(w, b["l"], period)}, period - 1)
    b.cols(lambda w: {"value": 100 * (b["sg"] - b["sl"]) / positive(b["sg"] + b["sl"])})


@indicator("macd", "line", "signal", "histogram")
def _macd(b, fast=12, slow=26, signal=9, kind="mean"):
    a, s, z = span_alpha(fast), span_alpha(slow), span_alpha(signal)
    b.ewm(("f", "close", a, kind), ("s", "close", s, kind), ("sf", ".f", z, kind), ("ss", ".s", z, kind))
    b.cols(lambda w: {"line": b["f"] - b["s"], "signal": b["sf"] - b["ss"]})
    b.cols(lambda w: {"histogram": b["line"] - b["signal"]})


def _percent_oscillator(b, source, fast, slow, signal):
    b.ewm(("f", source, span_alpha(fast)), ("s", source, span_alpha(slow)))
    b.cols(lambda w: {"line": (b["f"] - b["s"]) / positive(b["s"]) * 100})
    b.ewm(("signal", ".line", span_alpha(signal)))
    b.cols(lambda w: {"histogram": b["line"] - b["signal"]})


@indicator("ppo", "line", "signal", "histogram")
def _ppo(b, fast=12, slow=26, signal=9):
    _percent_oscillator(b, "close", fast, slow, signal)


@indicator("pvo", "line", "signal", "histogram")
def _pvo(b, fast=12, slow=26, signal=9):
    _percent_oscillator(b, "volume", fast, slow, signal)


@indicator("tsi")
def _tsi(b, slow=25, fast=13):
    s, f = span_alpha(slow), span_alpha(fast)
    b.cols(lambda w: {"d": change_n(w, C(), 1)}, 1)
    b.cols(lambda w: {"a": F.abs(b["d"])})
    b.ewm(("d1", ".d", s), ("d2", ".d1", f), ("a1", ".a", s), ("a2", ".a1", f))
    b.cols(lambda w: {"value": 100 * b["d2"] / positive(b["a2"])})


@indicator("trix", "value", "signal")
def _trix(b, period=15, signal=9):
    a = span_alpha(period)
    b.ewm(("e1", "close", a), ("e2", ".e1", a), ("e3", ".e2", a))
    b.cols(lambda w: {"value": (b["e3"] / F.lag(b["e3"]).over(w) - 1) * 100}, 1)
    b.ewm(("signal", ".value", span_alpha(signal)))


@indicator("kst", "value", "signal")
def _kst(b, rocs=(10, 15, 20, 30), windows=(10, 10, 10, 15), signal=9):
    b.cols(lambda w: {f"r{i}": C() / F.lag(C(), n).over(w) - 1 for i, n in enumerate(rocs)}, max(rocs))
    b.cols(lambda w: {f"m{i}": avg_n(w, b[f"r{i}"], n) for i, n in enumerate(windows)}, max(windows) - 1)
    b.cols(lambda w: {"value": 100 * (b["m0"] + 2 * b["m1"] + 3 * b["m2"] + 4 * b["m3"])})
    b.cols(lambda w: {"signal": avg_n(w, b["value"], signal)}, signal - 1)


@indicator("coppock")
def _coppock(b, slow=14, fast=11, period=10):
    b.cols(lambda w: {"x": (C() / F.lag(C(), slow).over(w) + C() / F.lag(C(), fast).over(w) - 2) * 100}, max(slow, fast))
    b.cols(lambda w: {"value": linear_weighted(w, b["x"], period)}, period - 1)


@indicator("stc")
def _stc(b, slow=50, fast=23, cycle=10, smooth=3):
    def stochastic(x, out):
        def cols(w):
            low, high = min_n(w, b[x], cycle), max_n(w, b[x], cycle)
            return {out: 100 * (b[x] - low) / positive(high - low)}

        return cols

    b.ewm(("f", "close", span_alpha(fast)), ("s", "close", span_alpha(slow)))
    b.cols(lambda w: {"m": b["f"] - b["s"]})
    b.cols(stochastic("m", "k"), cycle - 1)
    b.ewm(("d", ".k", span_alpha(smooth)))
    b.cols(stochastic("d", "kd"), cycle - 1)
    b.ewm(("value", ".kd", span_alpha(smooth)))


@indicator("ultimate")
def _ultimate(b, short=7, medium=14, long=28):
    def flows(w):
        prev = F.lag(C()).over(w)
        low, high = F.least(L(), prev), F.greatest(H(), prev)
        return {"bp": C() - low, "tr": high - low}

    def ratio(w, n):
        return sum_n(w, b["bp"], n) / positive(sum_n(w, b["tr"], n))

    b.cols(flows, 1)
    b.cols(lambda w: {"value": 100 * (4 * ratio(w, short) + 2 * ratio(w, medium) + ratio(w, long)) / 7}, long - 1)


@indicator("awesome")
def _awesome(b, fast=5, slow=34):
    b.cols(lambda w: {"value": avg_n(w, (H() + L()) / 2, fast) - avg_n(w, (H() + L()) / 2, slow)}, slow - 1)


def mean_abs_deviation(values: Column) -> Column:
    n = F.size(values)
    mean = F.aggregate(values, F.lit(0.0), lambda s, x: s + x) / n
    return F.aggregate(values, F.lit(0.0), lambda s, x: s + F.abs(x - mean)) / n


@indicator("cci")
def _cci(b, period=20):
    def cols(w):
        mad = mean_abs_deviation(F.collect_list(TYPICAL()).over(trailing(w, period)))
        return {"value": full((TYPICAL() - F.avg(TYPICAL()).over(trailing(w, period))) / (0.015 * positive(mad)), TYPICAL(), w, period)}

    b.cols(cols, period - 1)


@indicator("mean_deviation")
def _mean_deviation(b, period=20):
    b.cols(lambda w: {"value": full(mean_abs_deviation(F.collect_list(C()).over(trailing(w, period))), C(), w, period)}, period - 1)


@indicator("dpo")
def _dpo(b, period=20):
    shift = period // 2 + 1
    b.cols(lambda w: {"value": F.lag(C(), shift).over(w) - avg_n(w, "close", period)}, max(period - 1, shift))


# --- volatility and channels ----------------------------------------------------------------------------------------


@indicator("true_range")
def _true_range(b):
    b.cols(lambda w: {"value": true_range(w)}, 1)


@indicator("atr")
def _atr(b, period=14):
    b.cols(lambda w: {"tr": true_range(w)}, 1)
    b.cols(lambda w: {"value": avg_n(w, b["tr"], period)}, period - 1)


@indicator("atr_wilder")
def _atr_wilder(b, period=14):
    b.cols(lambda w: {"tr": true_range(w)}, 1)
    b.ewm(("value", ".tr", 1.0 / period))


@indicator("natr")
def _natr(b, period=14):
    _atr(b, period)
    b.cols(lambda w: {"value": b["value"] / positive(C()) * 100})


@indicator("choppiness")
def _choppiness(b, period=14):
    b.cols(lambda w: {"tr": true_range(w)}, 1)
    b.cols(lambda w: {"value": 100 * F.log10(sum_n(w, b["tr"], period) / positive(max_n(w, H(), period) - min_n(w, L(), period))) / math.log10(period)}, period - 1)


@indicator("bollinger", "upper", "middle", "lower", "bandwidth", "percent_b")
def _bollinger(b, period=20, k=2.0):
    b.cols(lambda w: {"middle": avg_n(w, "close", period), "sd": full(F.stddev_samp(C()).over(trailing(w, period)), C(), w, period)}, period - 1)
    b.cols(lambda w: {"upper": b["middle"] + k * b["sd"], "lower": b["middle"] - k * b["sd"]})
    b.cols(lambda w: {"bandwidth": (b["upper"] - b["lower"]) / positive(b["middle"]) * 100, "percent_b": (C() - b["lower"]) / positive(b["upper"] - b["lower"])})


@indicator("keltner", "upper", "middle", "lower")
def _keltner(b, period=20, atr=10, k=2.0):
    b.cols(lambda w: {"tr": true_range(w)}, 1)
    b.cols(lambda w: {"atr": avg_n(w, b["tr"], atr)}, atr - 1)
    b.ewm(("middle", "close", span_alpha(period)))
    b.cols(lambda w: {"upper": b["middle"] + k * b["atr"], "lower": b["middle"] - k * b["atr"]})


@indicator("donchian", "upper", "middle", "lower")
def _donchian(b, period=20):
    b.cols(lambda w: {"upper": max_n(w, H(), period), "lower": min_n(w, L(), period)}, period - 1)
    b.cols(lambda w: {"middle": (b["upper"] + b["lower"]) / 2})


@indicator("chandelier", "long", "short")
def _chandelier(b, period=22, k=3.0):
    b.cols(lambda w: {"tr": true_range(w)}, 1)
    b.cols(lambda w: {"long": max_n(w, H(), period) - k * avg_n(w, b["tr"], period), "short": min_n(w, L(), period) + k * avg_n(w, b["tr"], period)}, period - 1)


@indicator("ttm_squeeze", "on", "momentum")
def _ttm(b, period=20, bands=2.0, channel=1.5):
    """Bollinger bands inside the Keltner channel, and the regression end point of price minus its midline."""

    def first(w):
        mid = ((max_n(w, H(), period) + min_n(w, L(), period)) / 2 + avg_n(w, "close", period)) / 2
        inner = bands * F.stddev_samp(C()).over(trailing(w, period)) < channel * avg_n(w, b["tr"], period)
        return {"on": full(inner, C(), w, period), "x": C() - mid}

    def second(w):
        f, x, t = trailing(w, period), b["x"], F.col(POS).cast("double")
        return {"momentum": full(F.regr_intercept(x, t).over(f) + F.regr_slope(x, t).over(f) * t, x, w, period)}

    b.cols(lambda w: {"tr": true_range(w)}, 1)
    b.cols(first, period - 1)
    b.cols(second, period - 1)


@indicator("rogers_satchell")
def _rogers_satchell(b, period=14):
    x = F.log(H() / C()) * F.log(H() / O()) + F.log(L() / C()) * F.log(L() / O())
    b.cols(lambda w: {"value": F.sqrt(avg_n(w, x, period))}, period - 1)


@indicator("ulcer")
def _ulcer(b, period=14):
    b.cols(lambda w: {"r": 100 * (C() / max_n(w, C(), period) - 1)}, period - 1)
    b.cols(lambda w: {"value": F.sqrt(avg_n(w, b["r"] * b["r"], period))}, period - 1)


@indicator("std_dev")
def _std_dev(b, period=20):
    b.cols(lambda w: {"value": full(F.stddev_samp(C()).over(trailing(w, period)), C(), w, period)}, period - 1)


# --- trend strength -------------------------------------------------------------------------------------------------


@indicator("adx", "adx", "plus_di", "minus_di")
def _adx(b, period=14):
    a = span_alpha(period)

    def moves(w):
        up, down = H() - F.lag(H()).over(w), F.lag(L()).over(w) - L()
        return {
            "tr": true_range(w), "p": F.when((up > down) & (up > 0), up).otherwise(0.0),
            "m": F.when((down > up) & (down > 0), down).otherwise(0.0),
        }

    b.cols(moves, 1)
    b.ewm(("at", ".tr", a), ("ap", ".p", a), ("am", ".m", a))
    b.cols(lambda w: {"plus_di": 100 * b["ap"] / positive(b["at"]), "minus_di": 100 * b["am"] / positive(b["at"])})
    b.cols(lambda w: {"dx": F.abs(b["plus_di"] - b["minus_di"]) / positive(b["plus_di"] + b["minus_di"]) * 100})
    b.ewm(("adx", ".dx", a))


@indicator("aroon", "up", "down", "oscillator")
def _aroon(b, period=25):
    """Bars since the n-bar high / low as a share of n (first of equal extremes)."""

    def cols(w):
        f, at = w.rowsBetween(-period, 0), F.col(POS)
        ago_high = F.max_by(at, F.struct(H(), -at)).over(f)
        ago_low = F.min_by(at, F.struct(L(), at)).over(f)
        return {n: full((period - (at - p)) / F.lit(period) * 100, C(), w, period + 1) for n, p in (("up", ago_high), ("down", ago_low))}

    b.cols(cols, period)
    b.cols(lambda w: {"oscillator": b["up"] - b["down"]})


@indicator("vortex", "plus", "minus")
def _vortex(b, period=14):
    b.cols(lambda w: {"tr": true_range(w), "p": F.abs(H() - F.lag(L()).over(w)), "m": F.abs(L() - F.lag(H()).over(w))}, 1)
    b.cols(lambda w: {n: sum_n(w, b[n[0]], period) / positive(sum_n(w, b["tr"], period)) for n in ("plus", "minus")}, period - 1)


@indicator("mass_index")
def _mass_index(b, fast=9, slow=25):
    a = span_alpha(fast)
    b.cols(lambda w: {"r": H() - L()})
    b.ewm(("e1", ".r", a), ("e2", ".e1", a))
    b.cols(lambda w: {"x": b["e1"] / positive(b["e2"])})
    b.cols(lambda w: {"value": sum_n(w, b["x"], slow)}, slow - 1)


@indicator("ichimoku", "conversion", "base", "span_a", "span_b", "chikou")
def _ichimoku(b, conversion=9, base=26, span=52):
    mid = lambda w, n: (max_n(w, H(), n) + min_n(w, L(), n)) / 2
    b.cols(lambda w: {"conversion": mid(w, conversion), "base": mid(w, base), "wide": mid(w, span)}, span - 1)
    b.cols(lambda w: {"span_a": F.lag((b["conversion"] + b["base"]) / 2, base).over(w), "span_b": F.lag(b["wide"], base).over(w), "chikou": F.lead(H(), base).over(w)}, base, base)


# --- volume ---------------------------------------------------------------------------------------------------------


def money_flow_multiplier() -> Column:
    return ((C() - L()) - (H() - C())) / positive(H() - L())


@indicator("obv")
def _obv(b):
    b.first(lambda w: {"x": F.coalesce(F.signum(change_n(w, C(), 1)), F.lit(0.0)) * V()}, 1)
    b.total("value", "sum", b["x"])


@indicator("obv_smoothed")
def _sobv(b, period=10):
    _obv(b)
    b.cols(lambda w: {"o": b["value"]})
    b.cols(lambda w: {"value": avg_n(w, b["o"], period)}, period - 1)


@indicator("ad_line")
def _ad_line(b):
    b.total("value", "sum", money_flow_multiplier() * V())


@indicator("chaikin_oscillator")
def _chaikin_oscillator(b, fast=3, slow=10):
    b.total("ad", "sum", F.coalesce(money_flow_multiplier(), F.lit(0.0)) * V())
    b.ewm(("f", ".ad", span_alpha(fast)), ("s", ".ad", span_alpha(slow)))
    b.cols(lambda w: {"value": b["f"] - b["s"]})


@indicator("chaikin_mf")
def _chaikin_mf(b, period=20):
    x = money_flow_multiplier() * V()
    b.cols(lambda w: {"value": full(F.sum(x).over(trailing(w, period)) / positive(F.sum(V()).over(trailing(w, period))), x, w, period)}, period - 1)


@indicator("mfi")
def _mfi(b, period=14):
    def flows(w):
        prev = F.lag(TYPICAL()).over(w)
        return {"p": F.when(TYPICAL() > prev, TYPICAL() * V()).otherwise(0.0), "m": F.when(TYPICAL() < prev, TYPICAL() * V()).otherwise(0.0)}

    b.cols(flows, 1)
    b.cols(lambda w: {"value": _from_ratio(sum_n(w, b["p"], period), sum_n(w, b["m"], period))}, period - 1)


@indicator("force_index")
def _force_index(b, period=13):
    b.cols(lambda w: {"x": change_n(w, C(), 1) * V()}, 1)
    b.ewm(("value", ".x", span_alpha(period)))


@indicator("ease_of_movement", "value", "signal")
def _eom(b, period=14, scale=1e8):
    b.cols(lambda w: {"value": (change_n(w, H(), 1) + change_n(w, L(), 1)) * (H() - L()) / (2 * positive(V())) * scale}, 1)
    b.cols(lambda w: {"signal": avg_n(w, b["value"], period)}, period - 1)


@indicator("vpt")
def _vpt(b):
    b.first(lambda w: {"x": F.coalesce(C() / F.lag(C()).over(w) - 1, F.lit(0.0)) * V()}, 1)
    b.total("value", "sum", b["x"])


@indicator("nvi")
def _nvi(b, start=1000.0):
    """Compounds the return of bars with falling volume."""
    b.first(lambda w: {"x": F.when(V() < F.lag(V()).over(w), F.log(C() / F.lag(C()).over(w))).otherwise(0.0)}, 1)
    b.total("s", "sum", b["x"])
    b.cols(lambda w: {"value": start * F.exp(b["s"])})


@indicator("vwap")
def _vwap(b):
    b.total("pv", "sum", TYPICAL() * V())
    b.total("v", "sum", V())
    b.cols(lambda w: {"value": b["pv"] / positive(b["v"])})


@indicator("vwap_rolling")
def _vwap_rolling(b, period=14):
    b.cols(lambda w: {"value": sum_n(w, TYPICAL() * V(), period) / positive(sum_n(w, "volume", period))}, period - 1)


@indicator("vfi")
def _vfi(b, period=130, smoothing=3, coef=0.2, vol_coef=2.5):
    def second(w):
        cut = coef * full(F.stddev_samp(b["i"]).over(trailing(w, 30)), b["i"], w, 30) * C()
        capped = F.when(b["av"].isNotNull(), F.least(V(), b["av"] * vol_coef))
        return {"x": F.when(b["d"] > cut, capped).when(b["d"] < -cut, -capped).when(cut.isNotNull() & capped.isNotNull(), 0.0)}

    b.cols(lambda w: {"a0": avg_n(w, "volume", period)}, period - 1)
    b.cols(lambda w: {"i": F.log(TYPICAL()) - F.log(F.lag(TYPICAL()).over(w)), "d": change_n(w, TYPICAL(), 1), "av": F.lag(b["a0"]).over(w)}, 1)
    b.cols(second, 29)
    b.cols(lambda w: {"r": sum_n(w, b["x"], period) / positive(b["av"])}, period - 1)
    b.ewm(("value", ".r", span_alpha(smoothing)))


@indicator("vzo")
def _vzo(b, period=14):
    b.cols(lambda w: {"x": F.coalesce(F.signum(change_n(w, C(), 1)), F.lit(0.0)) * V()}, 1)
    b.ewm(("a", ".x", span_alpha(period)), ("t", "volume", span_alpha(period)))
    b.cols(lambda w: {"value": 100 * b["a"] / positive(b["t"])})


@indicator("pzo")
def _pzo(b, period=14):
    b.cols(lambda w: {"x": F.coalesce(F.signum(change_n(w, C(), 1)), F.lit(0.0)) * C()}, 1)
    b.ewm(("a", ".x", span_alpha(period)), ("t", "close", span_alpha(period)))
    b.cols(lambda w: {"value": 100 * b["a"] / positive(b["t"])})


@indicator("fve")
def _fve(b, period=22, factor=0.3):
    def signed(w):
        mf = C() - (H() + L()) / 2 + change_n(w, TYPICAL(), 1)
        cut = factor * C() / 100
        return {"x": F.when(mf > cut, V()).when(mf < -cut, -V()).when(mf.isNotNull(), 0)}

    b.cols(signed, 1)
    b.cols(lambda w: {"value": sum_n(w, b["x"], period) / positive(avg_n(w, "volume", period)) / period * 100}, period - 1)


@indicator("tmf")
def _tmf(b, period=21):
    def flow(w):
        prev = F.lag(C()).over(w)
        low, high = F.least(L(), prev), F.greatest(H(), prev)
        return {"x": F.coalesce(V() * ((C() - low) - (high - C())) / positive(high - low), F.lit(0.0))}

    b.cols(flow, 1)
    b.ewm(("a", ".x", 1.0 / period), ("t", "volume", 1.0 / period))
    b.cols(lambda w: {"value": b["a"] / positive(b["t"])})


@indicator("volume_ratio")
def _volume_ratio(b, period=20):
    b.cols(lambda w: {"value": V() / (avg_n(w, "volume", period) + 1e-10)}, period - 1)


@indicator("dollar_volume")
def _dollar_volume(b):
    b.cols(lambda w: {"value": C() * V()})


@indicator("avg_dollar_volume")
def _avg_dollar_volume(b, period=20):
    b.cols(lambda w: {"value": avg_n(w, C() * V(), period)}, period - 1)


# --- bar shapes and levels ------------------------------------------------------------------------------------------


PRICES = {
    "price_close": lambda: C(), "price_open": lambda: O(), "price_high": lambda: H(), "price_low": lambda: L(),
    "price_volume": lambda: V().cast("double"), "hl2": lambda: (H() + L()) / 2, "hlc3": TYPICAL,
    "ohlc4": lambda: (O() + H() + L() + C()) / 4,
}
for _name, _source in PRICES.items():
    indicator(_name)(lambda b, _x=_source: b.cols(lambda w: {"value": _x()}))


@indicator("balance_of_power")
def _bop(b):
    b.cols(lambda w: {"value": (C() - O()) / positive(H() - L())})


@indicator("bar_strength")
def _ibs(b):
    b.cols(lambda w: {"value": (C() - L()) / positive(H() - L())})


@indicator("heikin_ashi", "open", "high", "low", "close")
def _heikin_ashi(b):
    """Open = mean of the previous smoothed open and close; starts at the middle of the first body."""
    b.cols(lambda w: {"close": (O() + H() + L() + C()) / 4})
    b.cols(lambda w: {"x": F.coalesce(F.lag(b["close"]).over(w), (O() + C()) / 2)}, 1)
    b.ewm(("open", ".x", 0.5))
    b.cols(lambda w: {"high": F.greatest(H(), b["open"], b["close"]), "low": F.least(L(), b["open"], b["close"])})


# Pivot levels as (base, weight of range) per kind; r and s mirror each other.
PIVOT_STEPS = {"fibonacci": (0.382, 0.618, 1.0), "camarilla": (1.1 / 12, 1.1 / 6, 1.1 / 4)}


@indicator("pivots", "pp", "r1", "r2", "r3", "s1", "s2", "s3")
def _pivots(b, kind="standard"):
    def levels(w):
        h, l, c = (F.lag(x).over(w) for x in (H(), L(), C()))
        pp = (h + l + 2 * c) / 4 if kind == "woodie" else (h + l + c) / 3
        out = {"pp": pp}
        if kind in PIVOT_STEPS:
            middle = pp if kind == "fibonacci" else c
            for i, k in enumerate(PIVOT_STEPS[kind], 1):
                out[f"r{i}"], out[f"s{i}"] = middle + k * (h - l), middle - k * (h - l)
            return out
        out.update({"r1": 2 * pp - l, "s1": 2 * pp - h, "r2": pp + (h - l), "s2": pp - (h - l)})
        out.update({"r3": h + 2 * (pp - l), "s3": l - 2 * (h - pp)})
        return out

    b.cols(levels, 1)


# --- combined tables ------------------------------------------------------------------------------------------------

GROUPS = {
    "trend": ("sma", "ema", "wma", "macd", "trix", "mass_index", "ichimoku", "kst", "dpo", "cci", "adx", "vortex", "stc", "aroon"),
    "momentum": ("rsi", "stochastic", "stoch_rsi", "williams_r", "awesome", "roc", "tsi", "ultimate", "ppo", "pvo"),
    "volatility": ("atr", "bollinger", "keltner", "donchian", "ulcer"),
    "volume": ("obv", "ad_line", "chaikin_mf", "force_index", "ease_of_movement", "vpt", "nvi", "mfi", "vwap"),
}


def all_indicators(bars: DataFrame, axis: Axis = HOURLY, groups: Sequence[str] = tuple(GROUPS)) -> DataFrame:
    """The wide table of a group's indicators with their default parameters."""
    return compute(bars, [n for g in groups for n in GROUPS[g]], axis)


def session_vwap(bars: DataFrame, axis: Axis = HOURLY) -> DataFrame:
    """VWAP since the start of the bar's day."""
    rows = bars.withColumn("_day", F.to_date(axis.order[0]))
    out = prefix(rows, axis.by(key=(*axis.key, "_day")), {"_pv": ("sum", TYPICAL() * V()), "_v": ("sum", V())})
    return out.withColumn("vwap_day", F.col("_pv") / positive(F.col("_v"))).drop("_pv", "_v", "_day")


def swing_pivots(bars: DataFrame, axis: Axis = HOURLY, left: int = 5, right: int = 5) -> DataFrame:
    """Highs (lows) that are the strict extreme of the ``left`` bars before and ``right`` bars after."""

    def cols(w):
        back, fore = w.rowsBetween(-left, -1), w.rowsBetween(1, right)
        whole = (F.count(C()).over(back) == left) & (F.count(C()).over(fore) == right)
        return {
            "pivot_high": F.when(whole & (H() > F.max(H()).over(back)) & (H() > F.max(H()).over(fore)), H()),
            "pivot_low": F.when(whole & (L() < F.min(L()).over(back)) & (L() < F.min(L()).over(fore)), L()),
        }

    return over_blocks(bars, axis, cols, back=left, ahead=right)


# Retracement shares.
FIBONACCI = (0.0, 0.236, 0.382, 0.5, 0.618, 1.0)


def fibonacci_levels(bars: DataFrame, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """Retracement levels between the highest high and the lowest low of each group."""
    top, low = F.max("high"), F.min("low")
    return bars.groupBy(*keys).agg(*[(top - (top - low) * k).alias(f"level_{int(k * 1000)}") for k in FIBONACCI])


# --- coefficient per row --------------------------------------------------------------------------------------------


def _recur(rows: DataFrame, axis: Axis, out: str, alpha: str, x: Column) -> DataFrame:
    """y = y + alpha · (x − y), starting at x on the first row with a coefficient."""
    first = number(rows.filter(F.col(alpha).isNotNull()), axis, "_k")
    rows = first.unionByName(rows.filter(F.col(alpha).isNull()).withColumn("_k", F.lit(None).cast("long")))
    a = F.when(F.col("_k") == 1, 0.0).otherwise(1 - F.col(alpha))
    b = F.when(F.col("_k") == 1, x).otherwise(F.col(alpha) * x)
    rows = linear_scan(rows, axis, out, a, b)
    return rows.withColumn(out, F.when(F.col(alpha).isNotNull(), F.col(out))).drop("_k", alpha)


def kama(bars: DataFrame, axis: Axis = HOURLY, period: int = 10, fast: int = 2, slow: int = 30, out: str = "kama") -> DataFrame:
    """Adaptive average: the squared smoothing constant follows the efficiency ratio."""
    f, s = span_alpha(fast), span_alpha(slow)

    def second(w):
        path = sum_n(w, F.col("_d"), period)
        er = F.when(path != 0, F.abs(change_n(w, C(), period)) / path).when(path.isNotNull(), 0.0)
        return {"_sc": F.pow(er * (f - s) + s, F.lit(2.0))}

    rows = over_blocks(bars, axis, [lambda w: {"_d": F.abs(change_n(w, C(), 1))}, second], back=period)
    return _recur(rows.drop("_d"), axis, out, "_sc", C())


def vidya(bars: DataFrame, axis: Axis = HOURLY, period: int = 14, out: str = "vidya") -> DataFrame:
    """Average whose weight scales with the absolute Chande momentum."""

    def second(w):
        d = F.col("_d")
        g = sum_n(w, F.when(d.isNotNull(), F.greatest(d, F.lit(0.0))), period)
        l = sum_n(w, F.when(d.isNotNull(), F.greatest(-d, F.lit(0.0))), period)
        return {"_al": span_alpha(period) * F.abs(F.coalesce((g - l) / positive(g + l), F.when(g.isNotNull(), 0.0)))}

    rows = over_blocks(bars, axis, [lambda w: {"_d": change_n(w, C(), 1)}, second], back=period)
    return _recur(rows.drop("_d"), axis, out, "_al", C())


def frama(bars: DataFrame, axis: Axis = HOURLY, batch: int = 10, out: str = "frama") -> DataFrame:
    """Fractal adaptive average: the weight follows the fractal dimension of two half windows."""

    def first(w):
        return {
            "_n1": (max_n(w, C(), batch) - min_n(w, C(), batch)) / batch,
            "_n3": (max_n(w, C(), 2 * batch) - min_n(w, C(), 2 * batch)) / (2 * batch),
        }

    def second(w):
        both = F.col("_n1") + F.lag("_n1", batch).over(w)
        dim = (F.log(positive(both)) - F.log(positive(F.col("_n3")))) / math.log(2)
        return {"_al": clamp(F.exp(-4.6 * (dim - 1)), 0.01, 1.0)}

    rows = over_blocks(bars, axis, [first, second], back=3 * batch)
    return _recur(rows.drop("_n1", "_n3"), axis, out, "_al", C())


def evwma(bars: DataFrame, axis: Axis = HOURLY, period: int = 20, out: str = "evwma") -> DataFrame:
    """Elastic volume-weighted average: the weight is the bar's share of the window's volume."""
    rows = over_blocks(bars, axis, lambda w: {"_al": V() / positive(sum_n(w, "volume", period))}, back=period - 1)
    return _recur(rows, axis, out, "_al", C())


def klinger(bars: DataFrame, axis: Axis = HOURLY, fast: int = 34, slow: int = 55, signal: int = 13) -> DataFrame:
    """Klinger oscillator and signal: volume force with the range cumulated since the last turn of the trend."""
    keep = bars.columns
    rows = over_blocks(
        bars, axis,
        [
            lambda w: {"_t": F.when(change_n(w, TYPICAL(), 1) > 0, 1).when(change_n(w, TYPICAL(), 1).isNotNull(), -1), "_dm": H() - L()},
            lambda w: {"_turn": ~F.col("_t").eqNullSafe(F.lag("_t").over(w)), "_pdm": F.lag("_dm").over(w)},
        ],
        back=2,
    )
    rows = prefix(rows, axis, {"_s": ("sum", "_dm")})
    start = F.when(F.col("_turn") & F.col("_t").isNotNull(), F.col("_s") - F.col("_dm") - F.col("_pdm"))
    rows = prefix(rows, axis, {"_base": ("last", start)})
    cm = F.col("_s") - F.col("_base")
    vf = F.when(F.col("_t").isNotNull(), V() * F.coalesce(F.abs(2 * F.col("_dm") / positive(cm) - 1), F.lit(0.0)) * F.col("_t") * 100)
    rows = rows.withColumn("_vf", vf)
    f, s, z = span_alpha(fast), span_alpha(slow), span_alpha(signal)
    rows = smoothed(rows, axis, [("_f", "_vf", f), ("_l", "_vf", s), ("_sf", "_f", z), ("_sl", "_l", z)])
    return rows.select(*keep, (F.col("_f") - F.col("_l")).alias("kvo"), (F.col("_sf") - F.col("_sl")).alias("kvo_signal"))


# --- state machines -------------------------------------------------------------------------------------------------


def _plus(df: DataFrame, *fields: tuple[str, str]) -> T.StructType:
    kinds = {"double": T.DoubleType(), "int": T.IntegerType()}
    return T.StructType(df.schema.fields + [T.StructField(n, kinds[k]) for n, k in fields])


def parabolic_sar(bars: DataFrame, axis: Axis = HOURLY, step: float = 0.02, limit: float = 0.2, out: str = "psar") -> DataFrame:
    """Parabolic stop.  A reversal clears the state, so split buckets agree after a few bars."""
    cols = bars.columns

    def run(part: pd.DataFrame, state):
        values = []
        level, af, side, extreme, h1, l1, h2, l2 = state if state else [math.nan] * 8
        for high, low in zip(part["high"].to_numpy(), part["low"].to_numpy()):
            if level != level:
                level, af, side, extreme = high, step, 1.0, high
            else:
                level += af * (extreme - level)
                near = [x for x in ((l1, l2) if side > 0 else (h1, h2)) if x == x]
                level = side * min(side * x for x in (level, *near))
                ahead, behind = (high, low) if side > 0 else (low, high)
                if side * behind < side * level:
                    level, extreme, af, side = extreme, behind, step, -side
                elif side * ahead > side * extreme:
                    extreme, af = ahead, min(af + step, limit)
            h1, l1, h2, l2 = high, low, h1, l1
            values.append(level)
        part = part[cols].copy()
        part[out] = values
        return part, [level, af, side, extreme, h1, l1, h2, l2]

    return fold(bars, axis, run, _plus(bars, (out, "double")))


def supertrend(bars: DataFrame, axis: Axis = HOURLY, period: int = 10, k: float = 3.0) -> DataFrame:
    """Trailing band and direction; null until the average range is known."""
    keep = bars.columns
    rows = compute(bars, {"_atr": ("atr", {"period": period})}, axis)
    rows = rows.withColumns({"_up": (H() + L()) / 2 + k * F.col("_atr"), "_dn": (H() + L()) / 2 - k * F.col("_atr")}).drop("_atr")

    def run(part: pd.DataFrame, state):
        upper, lower, side, level = state if state else [math.nan] * 4
        levels, sides = [], []
        for close, up, dn in zip(part["close"].to_numpy(), part["_up"].to_numpy(dtype=float), part["_dn"].to_numpy(dtype=float)):
            if up != up:
                levels.append(None)
                sides.append(None)
                continue
            before = side
            if level != level:
                side, level = 1.0, dn
            else:
                side = 1.0 if close > upper else -1.0 if close < lower else side
                band = dn if side > 0 else up
                level = side * max(side * band, side * level) if side == before else band
            upper, lower = up, dn
            levels.append(level)
            sides.append(int(side))
        part = part[keep].copy()
        part["supertrend"] = levels
        part["direction"] = pd.array(sides, dtype="Int32")
        return part, [upper, lower, side, level]

    return fold(rows, axis, run, _plus(bars, ("supertrend", "double"), ("direction", "int")))


def mcginley(bars: DataFrame, axis: Axis = HOURLY, period: int = 14, k: float = 0.6, out: str = "mcginley") -> DataFrame:
    """McGinley dynamic, starting at the first close."""
    cols = bars.columns

    def run(part: pd.DataFrame, state):
        y = state[0] if state else math.nan
        values = []
        with np.errstate(all="ignore"):
            for x in part["close"].to_numpy():
                y = x if y != y else y + (x - y) / (k * period * (x / y) ** 4)
                values.append(y)
        part = part[cols].copy()
        part[out] = values
        return part, [y]

    # each step pulls towards the price, so two starts meet after some hundred rows, but not always in the last bit
    return fold(bars, axis, run, _plus(bars, (out, "double")), near=1e-13)


def zigzag(bars: DataFrame, axis: Axis = HOURLY, change: float = 5.0, value: str = "close") -> DataFrame:
    """Turning points: an extreme is confirmed when the price has moved back by ``change`` percent."""
    key, ts = axis.key[0], axis.order[0]
    schema = T.StructType(
        [bars.schema[key], T.StructField("pivot_ts", T.TimestampType()), T.StructField("pivot", T.DoubleType()), T.StructField("kind", T.StringType()), T.StructField("confirmed_ts", T.TimestampType())]
    )

    def run(part: pd.DataFrame, state):
        side, top, top_at, low, low_at = state if state else [0.0, math.nan, 0.0, math.nan, 0.0]
        found = []
        for at, x in zip(part[ts], part[value].to_numpy()):
            us = float(at.value // 1000)
            if top != top:
                top, top_at, low, low_at = x, us, x, us
                continue
            if side >= 0 and x > top:
                top, top_at = x, us
            if side <= 0 and x < low:
                low, low_at = x, us
            if side >= 0 and x <= top * (1 - change / 100):
                found.append((top_at, top, "high", at))
                side, low, low_at = -1.0, x, us
            elif side <= 0 and x >= low * (1 + change / 100):
                found.append((low_at, low, "low", at))
                side, top, top_at = 1.0, x, us
        rows = pd.DataFrame(found, columns=["us", "pivot", "kind", "confirmed_ts"])
        rows["pivot_ts"] = pd.to_datetime(rows.pop("us").astype("int64"), unit="us")
        rows["confirmed_ts"] = pd.to_datetime(rows["confirmed_ts"])
        rows[key] = part[key].iloc[0]
        return rows[[key, "pivot_ts", "pivot", "kind", "confirmed_ts"]], [side, top, top_at, low, low_at]

    return fold(bars.select(key, ts, value), axis, run, schema)


# --- scores and regimes ---------------------------------------------------------------------------------------------


def technical_score(bars: DataFrame, axis: Axis = HOURLY, ma: int = 60) -> DataFrame:
    """Score 0-3 of the last bar of each symbol: price against its average, RSI band, MACD histogram and its slope.

    Symbols with fewer than ``ma`` bars have no score.
    """
    rows = compute(bars, {"_ma": ("sma", {"period": ma}), "_m": ("macd", {"kind": "adjusted"})}, axis)

    def cols(w):
        d = change_n(w, C(), 1)
        return {"_d": d, "_h1": F.lag("_m_histogram").over(w)}

    def rsi(w):
        f = trailing(w, 14)
        g = F.avg(F.greatest(F.col("_d"), F.lit(0.0))).over(f)
        l = F.avg(F.greatest(-F.col("_d"), F.lit(0.0))).over(f)
        return {"rsi": 100 - 100 / (1 + g / (l + 1e-8))}

    rows = over_blocks(rows, axis, [cols, rsi], back=15)
    last = rows.groupBy(*axis.key).agg(F.max_by(F.struct(*[c for c in rows.columns if c not in axis.key]), F.struct(*axis.order)).alias("_r"))
    last = last.select(*axis.key, "_r.*").filter(F.col("_ma").isNotNull())
    m, x, h, h1 = F.col("_ma"), F.col("rsi"), F.col("_m_histogram"), F.col("_h1")
    ma_score = F.when(C() > m * 1.02, 1.0).when(C() > m, 0.7).when(C() > m * 0.98, 0.3).otherwise(0.0)
    rsi_score = F.when(x.between(40, 60), 0.5).when((x >= 30) & (x < 40), 0.7).when(x < 30, 1.0).when((x > 60) & (x <= 70), 0.3).otherwise(0.0)
    macd_score = F.when((h > 0) & (h > h1), 1.0).when(h > 0, 0.7).when((h < 0) & (h > h1), 0.3).otherwise(0.0)
    out = last.withColumns({"ma_score": ma_score, "rsi_score": rsi_score, "macd_score": macd_score})
    out = out.withColumn("score", F.round(F.col("ma_score") + F.col("rsi_score") + F.col("macd_score"), 2))
    label = F.when(F.col("score") >= 2.5, "Strong").when(F.col("score") >= 1.5, "Moderate").otherwise("Weak")
    return out.withColumn("label", label).select(*axis.key, axis.order[0], "rsi", "ma_score", "rsi_score", "macd_score", "score", "label")


def ma_cross_state(bars: DataFrame, axis: Axis = HOURLY, fast: int = 50, slow: int = 200) -> DataFrame:
    """golden_cross, death_cross, above or below for every bar with both averages known on it and the bar before."""

    def first(w):
        return {"fast_ma": avg_n(w, "close", fast), "slow_ma": avg_n(w, "close", slow)}

    def second(w):
        return {"_f": F.lag("fast_ma").over(w), "_s": F.lag("slow_ma").over(w)}

    rows = over_blocks(bars, axis, [first, second], back=slow)
    f, s, pf, ps = F.col("fast_ma"), F.col("slow_ma"), F.col("_f"), F.col("_s")
    state = F.when((pf <= ps) & (f > s), "golden_cross").when((pf >= ps) & (f < s), "death_cross").when(f > s, "above").otherwise("below")
    return rows.withColumn("state", F.when(ps.isNotNull(), state)).drop("_f", "_s")


def regime(bars: DataFrame, axis: Axis = HOURLY, window: int = 20, short: int = 50, long: int = 200, year: int = 252) -> DataFrame:
    """Regime per bar from the annualised volatility (population) of ``window`` returns and two averages.

    Series shorter than the averages use a third of the bars so far and all but one of them.
    """

    def first(w):
        return {"_r": C() / F.lag(C()).over(w) - 1}

    def second(w):
        f = trailing(w, window)
        return {
            "_mean": full(F.avg("_r").over(f), "_r", w, window),
            "volatility": full(F.stddev_pop("_r").over(f) * math.sqrt(year), "_r", w, window),
            "_s": F.collect_list("close").over(trailing(w, short)),
            "_l": F.collect_list("close").over(trailing(w, long)),
        }

    rows = over_blocks(bars, axis, [first, second], back=max(long, window + 1), keep_pos=True)
    tail_mean = lambda a, n: F.aggregate(F.slice(a, F.greatest(F.size(a) - n + 1, F.lit(1)), n), F.lit(0.0), lambda s, x: s + x) / n
    n_short = F.least(F.lit(short), F.floor(F.col(POS) / 3).cast("int"))
    n_long = F.least(F.lit(long), (F.col(POS) - 1).cast("int"))
    ok = F.col(POS) >= 30
    rows = rows.withColumns({"short_ma": F.when(ok, tail_mean(F.col("_s"), n_short)), "long_ma": F.when(ok, tail_mean(F.col("_l"), n_long))})
    s, l, m = F.col("short_ma"), F.col("long_ma"), F.col("_mean")
    label = F.when(F.col("volatility") > 0.30, "high_volatility").when((s > l) & (m > 0), "bull").when((s < l) & (m < 0), "bear").otherwise("sideways")
    return rows.withColumn("regime", F.when(ok, label)).drop("_r", "_mean", "_s", "_l", POS)
