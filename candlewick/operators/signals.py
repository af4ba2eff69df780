"""Rules, signals, labels, splitters and the multi-symbol scanner."""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.operators import ranking
from candlewick.operators.indicators import compute, outputs_of
from candlewick.operators.series import BUCKET, HOURLY, POS, Axis, fold, number, over_blocks, prefix, shared, trailing
from candlewick.operators.windows import positive

# --- conditions -----------------------------------------------------------------------------------------------------

TOLERANCE = 1e-4


def _side(alias: str, name: str, field: str) -> str:
    columns = outputs_of(alias, name)
    return columns[field if field in columns else next(iter(columns))]


def conditions_of(rules: Sequence) -> tuple[list[dict], str]:
    """Conditions of a flat list and its logic: the last AND / OR word counts for the whole list."""
    logic = "AND"
    for r in rules:
        if isinstance(r, str) and r.upper() in ("AND", "OR"):
            logic = r.upper()
    return [r for r in rules if isinstance(r, Mapping)], logic


def _wanted(rules: Sequence[dict], tag: str) -> dict[str, tuple[str, dict]]:
    out = {}
    for i, r in enumerate(rules):
        out[f"_{tag}{i}"] = (r["indicator"], dict(r.get("params", {})))
        if r.get("compare_indicator"):
            out[f"_{tag}{i}t"] = (r["compare_indicator"], dict(r.get("compare_params", {})))
    return out


def _reach(r: dict) -> int:
    return max(int(r.get("offset", 0)), int(r.get("compare_offset", 0)), int(r.get("lookback", 5)) + 1, 1)


def crosses(w: WindowSpec, x: Column, y: Column, above: bool = True) -> Column:
    """x was on or below (above) y on the bar before and is beyond it now."""
    px, py = F.lag(x).over(w), F.lag(y).over(w)
    hit = (px <= py) & (x > y) if above else (px >= py) & (x < y)
    return F.coalesce(hit, F.lit(False))


def _met(w: WindowSpec, r: dict, alias: str) -> Column:
    x = F.col(_side(alias, r["indicator"], r.get("field", "value"))).cast("double")
    other = r.get("compare_indicator")
    y = F.col(_side(f"{alias}t", other, r.get("compare_field", "value"))).cast("double") if other else F.lit(float(r.get("value", 0)))
    op, n = r.get("operator", ">"), int(r.get("lookback", 5))
    if op in ("crosses_above", "crosses_below"):
        return crosses(w, x, y, op.endswith("above"))
    if op in ("crossed_above_within", "crossed_below_within"):
        return F.col(f"{alias}_hit")
    if op in ("rising", "falling"):
        return F.col(f"{alias}_hit")
    if r.get("offset"):
        x = F.lag(x, int(r["offset"])).over(w)
    if other and r.get("compare_offset"):
        y = F.lag(y, int(r["compare_offset"])).over(w)
    tests = {">": x > y, "<": x < y, ">=": x >= y, "<=": x <= y, "==": F.abs(x - y) < TOLERANCE}
    if op == "between":
        upper = r.get("value2")
        hit = x.between(F.lit(float(r.get("value", 0))), F.lit(float(upper))) if upper is not None else F.lit(False)
    else:
        hit = tests.get(op, F.lit(False))
    return F.coalesce(hit, F.lit(False))


def _steps(w: WindowSpec, r: dict, alias: str) -> dict[str, Column]:
    """Per-bar step of the operators that look at several bars."""
    x = F.col(_side(alias, r["indicator"], r.get("field", "value"))).cast("double")
    other = r.get("compare_indicator")
    y = F.col(_side(f"{alias}t", other, r.get("compare_field", "value"))).cast("double") if other else F.lit(float(r.get("value", 0)))
    op = r.get("operator", ">")
    if op in ("crossed_above_within", "crossed_below_within"):
        return {f"{alias}_step": crosses(w, x, y, "above" in op).cast("int")}
    if op in ("rising", "falling"):
        up = x > F.lag(x).over(w) if op == "rising" else x < F.lag(x).over(w)
        return {f"{alias}_step": F.when(F.col(POS) > 1, F.coalesce(up, F.lit(False)).cast("int"))}
    return {}


def _hits(w: WindowSpec, r: dict, alias: str) -> dict[str, Column]:
    op, n = r.get("operator", ">"), int(r.get("lookback", 5))
    if op in ("crossed_above_within", "crossed_below_within"):
        return {f"{alias}_hit": F.coalesce(F.max(f"{alias}_step").over(trailing(w, n)) == 1, F.lit(False))}
    if op in ("rising", "falling"):
        steps = w.rowsBetween(-max(n - 2, 0), 0)
        return {f"{alias}_hit": F.coalesce(F.min(f"{alias}_step").over(steps) == 1, F.lit(False)) & (F.col(POS) >= 2)}
    return {}


def evaluate_groups(bars: DataFrame, groups: Mapping[str, Sequence], axis: Axis = HOURLY) -> DataFrame:
    """Evaluate rule groups on every bar: one boolean column per group and one per condition (group_i).

    All indicators of all groups are computed once over the whole history.
    """
    parsed = {g: conditions_of(rules) for g, rules in groups.items()}
    items = [(g, i, r) for g, (rules, _) in parsed.items() for i, r in enumerate(rules)]
    wanted = {k: v for g, (rules, _) in parsed.items() for k, v in _wanted(rules, f"{g}_").items()}
    keep = bars.columns
    alias = lambda g, i: f"_{g}_{i}"
    steps = lambda w: {n: c for g, i, r in items for n, c in _steps(w, r, alias(g, i)).items()}
    hits = lambda w: {n: c for g, i, r in items for n, c in _hits(w, r, alias(g, i)).items()}
    met = lambda w: {f"{g}_{i}": _met(w, r, alias(g, i)) for g, i, r in items}
    reach = max((_reach(r) for *_, r in items), default=0) + 1
    rows = compute(bars, wanted, axis, keep_pos=True, after=[steps, hits, met], after_reach=reach)
    for g, (rules, logic) in parsed.items():
        parts = [F.col(f"{g}_{i}") for i in range(len(rules))]
        joined = functools.reduce((lambda a, b: a & b) if logic == "AND" else (lambda a, b: a | b), parts) if parts else F.lit(False)
        rows = rows.withColumn(g, joined)
    return rows.select(*keep, POS, *[f"{g}_{i}" for g, i, _ in items], *parsed)


def scan(bars: DataFrame, rules: Sequence, axis: Axis = HOURLY, newest: int = 365, at_least: int = 10) -> DataFrame:
    """Latest bar of every symbol against a rule group, from its newest bars; too short series are reported."""
    key, ts = list(axis.key), axis.order[0]
    recent = ranking.top_n(bars, key, [F.desc(c) for c in axis.order], newest).drop("rank")
    rows = evaluate_groups(recent, {"match": rules}, axis)
    flags = [c for c in rows.columns if c == "match" or c.startswith("match_")]
    last = rows.groupBy(*key).agg(
        F.max_by(F.struct(ts, "close", *flags), F.struct(*axis.order)).alias("_r"), F.count(F.lit(1)).alias("bars")
    )
    out = last.select(*key, "bars", "_r.*").withColumnRenamed("close", "price")
    short = F.col("bars") < at_least
    return out.withColumns(
        {
            "match": F.col("match") & ~short,
            "error": F.when(short, F.concat(F.lit("Insufficient data ("), F.col("bars").cast("string"), F.lit(" candles)"))),
        }
    )


# --- signals --------------------------------------------------------------------------------------------------------


def bars_since(df: DataFrame, axis: Axis, condition: Column, out: str = "bars_since") -> DataFrame:
    """Rows since the condition last held; null before."""
    rows = number(df, axis)
    rows = prefix(rows, axis, {"_at": ("last", F.when(condition, F.col(POS)))})
    return rows.withColumn(out, F.col(POS) - F.col("_at")).drop("_at", POS)


def crossover_signals(w: WindowSpec, fast: Column, slow: Column) -> dict[str, Column]:
    return {"entry": crosses(w, fast, slow), "exit": crosses(w, fast, slow, above=False)}


def threshold_signals(w: WindowSpec, x: Column, lower: float, upper: float) -> dict[str, Column]:
    """Enter when falling through ``lower``, exit when rising through ``upper``."""
    return {"entry": crosses(w, x, F.lit(lower), above=False), "exit": crosses(w, x, F.lit(upper))}


def _flag(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def breakout_signals(close: Column, upper: Column, lower: Column) -> dict[str, Column]:
    return {"entry": _flag(close > upper), "exit": _flag(close < lower)}


def reversion_signals(z: Column, enter: float = 2.0, leave: float = 0.0) -> dict[str, Column]:
    return {"entry": _flag(z < -enter), "exit": _flag(z > leave)}


def filtered_entry(entry: Column, x: Column, threshold: float, above: bool = True) -> Column:
    return entry & _flag(x > threshold if above else x < threshold)


def clean_signals(df: DataFrame, axis: Axis, entry: str = "entry", exit: str = "exit") -> DataFrame:
    """Alternate entries and exits; adds clean_entry, clean_exit, was_in (before the bar) and in_position (after it).

    The state before a bar is set by the last bar with one flag only, turned over once for every bar with both
    flags since.  Both are kept per time bucket and handed over between buckets in one shared shuffle; no state
    machine is needed.
    """
    keys = [*axis.key, BUCKET]
    e, x = _flag(F.col(entry)), _flag(F.col(exit))
    rows = axis.bucketed(df).withColumns({"_both": (e & x).cast("long"), "_one": F.when(e != x, e.cast("int"))})
    rows = shared(rows, *keys)
    at = F.struct(*axis.order)
    upto = Window.partitionBy(*keys).orderBy(*axis.order).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*keys).orderBy(*axis.order).rowsBetween(Window.unboundedPreceding, -1)
    local = rows.withColumn("_t", F.sum("_both").over(upto))
    local = local.withColumn("_event", F.when(F.col("_one").isNotNull(), F.struct(F.col("_one").alias("s"), F.col("_t").alias("t"))))
    local = local.withColumn("_last", F.last("_event", ignorenulls=True).over(earlier))
    # per bucket: state after its last single flag (null without one) and the turns since (all of them without one)
    ends = local.groupBy(*keys).agg(
        F.max_by("_event", F.when(F.col("_one").isNotNull(), at)).alias("_end"), F.sum("_both").alias("_turns")
    )
    line = Window.partitionBy(*axis.key).orderBy(BUCKET)
    ends = ends.withColumn("_run", F.sum("_turns").over(line.rowsBetween(Window.unboundedPreceding, 0)))
    mark = F.when(
        F.col("_end").isNotNull(),
        F.struct(F.col("_end.s").alias("s"), (F.col("_run") - F.col("_turns") + F.col("_end.t")).alias("t")),
    )
    known = F.last(mark, ignorenulls=True).over(line.rowsBetween(Window.unboundedPreceding, -1))
    ends = ends.withColumn("_k", known).select(
        *keys,
        ((F.coalesce(F.col("_k.s"), F.lit(0)) + F.col("_run") - F.col("_turns") - F.coalesce(F.col("_k.t"), F.lit(0))) % 2).alias("_start"),
    )
    turns = F.col("_t") - F.col("_both")
    state = F.when(F.col("_last").isNull(), F.col("_start") + turns).otherwise(F.col("_last.s") + turns - F.col("_last.t"))
    out = local.join(ends, keys).withColumn("was_in", state % 2 == 1)
    out = out.withColumns({"clean_entry": e & ~F.col("was_in"), "clean_exit": x & F.col("was_in")})
    after = (F.col("was_in") & ~F.col("clean_exit")) | F.col("clean_entry")
    return out.withColumn("in_position", after).drop(BUCKET, "_both", "_one", "_t", "_event", "_last", "_start")


def stop_exits(
    df: DataFrame,
    axis: Axis,
    entry: str = "entry",
    stop_loss: float | None = None,
    take_profit: float | None = None,
    trailing_stop: float | None = None,
    intrabar: bool = False,
) -> DataFrame:
    """Exit flag and reason (sl, tp, ts) of stops set at the close of an entry.

    Stops look at the close, or with ``intrabar`` at the low and high.  A state machine per series: see ``fold``.
    """
    cols = df.columns
    schema = T.StructType(df.schema.fields + [T.StructField("stop_exit", T.BooleanType()), T.StructField("reason", T.StringType())])

    def run(part: pd.DataFrame, state):
        inside, price, peak = state if state else [0.0, 0.0, 0.0]
        close = part["close"].to_numpy()
        low, high = (part["low"].to_numpy(), part["high"].to_numpy()) if intrabar else (close, close)
        reasons = []
        for flag, c, l, h in zip(part[entry].to_numpy(), close, low, high):
            why = None
            if flag and not inside:
                inside, price, peak = 1.0, c, h
            if inside:
                peak = max(peak, h)
                if stop_loss is not None and l <= price * (1 - stop_loss):
                    why = "sl"
                elif take_profit is not None and h >= price * (1 + take_profit):
                    why = "tp"
                elif trailing_stop is not None and l <= peak * (1 - trailing_stop):
                    why = "ts"
                if why:
                    inside, price, peak = 0.0, 0.0, 0.0
            reasons.append(why)
        part = part[cols].copy()
        part["reason"] = pd.array(reasons, dtype="object")
        part["stop_exit"] = [r is not None for r in reasons]
        return part[[*cols, "stop_exit", "reason"]], [inside, price, peak]

    return fold(df, axis, run, schema)


# --- random entries -------------------------------------------------------------------------------------------------


def uniform(*key: Column) -> Column:
    """Uniform number in [0, 1) drawn from a hash of the key, the same on every run and partitioning."""
    digest = F.md5(F.concat_ws("|", *[k.cast("string") for k in key]).cast("binary"))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / F.lit(float(16**12))


def random_entries(df: DataFrame, axis: Axis, n: int, seed: int = 0) -> DataFrame:
    """Exactly ``n`` entries per series (all rows of shorter ones): the rows with the smallest draws."""
    rows = number(df, axis).withColumn("_u", uniform(F.lit(seed), *[F.col(k) for k in axis.key], F.col(POS)))
    chosen = ranking.top_n(rows.select(*axis.key, POS, "_u"), list(axis.key), [F.asc("_u"), F.asc(POS)], n)
    chosen = chosen.select(*axis.key, POS, F.lit(True).alias("entry"))
    out = rows.join(chosen, [*axis.key, POS], "left")
    return out.withColumn("entry", F.coalesce("entry", F.lit(False))).drop("_u", POS)


def random_trades(
    df: DataFrame, axis: Axis, entry_prob: float = 0.1, exit_prob: float = 0.1, cooldown: int = 0, seed: int = 0
) -> DataFrame:
    """Entries and exits by chance, never overlapping, with at least ``cooldown`` bars after an exit."""
    keys = [F.col(k) for k in axis.key]
    rows = number(df, axis).withColumns(
        {
            "entry": uniform(F.lit(seed), F.lit("in"), *keys, F.col(POS)) < entry_prob,
            "exit": uniform(F.lit(seed), F.lit("out"), *keys, F.col(POS)) < exit_prob,
        }
    )
    if not cooldown:
        return clean_signals(rows, axis).drop("entry", "exit", "was_in", POS)
    cols = df.columns
    schema = T.StructType(df.schema.fields + [T.StructField(c, T.BooleanType()) for c in ("clean_entry", "clean_exit", "in_position")])

    def run(part: pd.DataFrame, state):
        inside, last = state if state else [0.0, -math.inf]
        out = []
        for e, x, at in zip(part["entry"].to_numpy(), part["exit"].to_numpy(), part[POS].to_numpy()):
            enter = leave = False
            if not inside:
                enter = bool(e) and at - last > cooldown
                inside = 1.0 if enter else 0.0
            elif x:
                leave, inside, last = True, 0.0, float(at)
            out.append((enter, leave, bool(inside)))
        part = part[cols].copy()
        part[["clean_entry", "clean_exit", "in_position"]] = pd.DataFrame(out, index=part.index)
        return part, [inside, last]

    return fold(rows, axis, run, schema)


# --- labels ---------------------------------------------------------------------------------------------------------


def _three_way(x: Column, threshold: float) -> Column:
    return F.when(x > threshold, 1).when(x < -threshold, -1).otherwise(0)


def labels(
    df: DataFrame, axis: Axis, horizon: int = 5, threshold: float = 0.0, window: int = 20, z: float = 1.0, extrema: int = 5, alpha: float = 2.0
) -> DataFrame:
    """Fixed-horizon, mean-reversion, local-extremum, trend and Bollinger-zone labels of the close."""
    c = F.col("close")

    def cols(w):
        f = trailing(w, window)
        mean, sd = F.avg("close").over(f), F.stddev_samp("close").over(f)
        around = w.rowsBetween(-extrema, extrema)
        whole = F.count("close").over(around) == 2 * extrema + 1
        known = F.count("close").over(f) == window
        upper, lower = mean + alpha * sd, mean - alpha * sd
        slope = F.regr_slope(c, F.col(POS).cast("double")).over(f) / F.when(mean > 0, mean)
        score = (c - mean) / positive(sd)
        return {
            "fixed_label": F.coalesce(_three_way(F.lead("close", horizon).over(w) / c - 1, threshold), F.lit(0)),
            "mean_label": F.when(known & (score < -z), 1).when(known & (score > z), -1).otherwise(0),
            "extremum_label": F.when(whole & (c == F.max("close").over(around)), -1).when(whole & (c == F.min("close").over(around)), 1).otherwise(0),
            "trend_label": F.when(known & (slope > threshold), 1).when(known & (slope < -threshold), -1).otherwise(0),
            "change_label": F.coalesce(_three_way(c / F.lag("close", window).over(w) - 1, threshold), F.lit(0)),
            "band_label": F.when(known & (c > upper), 2).when(known & (c > mean), 1).when(known & (c < lower), -2).when(known & (c < mean), -1).otherwise(0),
        }

    return over_blocks(df, axis, cols, back=max(window, extrema), ahead=max(horizon, extrema))


# --- rule frames ----------------------------------------------------------------------------------------------------

FRAME_OPERATORS = {
    ">": lambda a, b: a > b, "<": lambda a, b: a < b, "=": lambda a, b: a == b,
    ">=": lambda a, b: a >= b, "<=": lambda a, b: a <= b, "!=": lambda a, b: a != b,
}


def _term(t, columns: Sequence[str]) -> Column:
    return F.col(t).cast("double") if isinstance(t, str) and t in columns else F.lit(t).try_cast("double")


def frame_logic(logics: Sequence[Sequence], columns: Sequence[str], any_of: bool = False) -> Column:
    """All (or any) of ``[field, operator, field or number]``; an empty list never holds."""
    tests = []
    for logic in logics:
        op = FRAME_OPERATORS.get(logic[1]) if len(logic) == 3 else None
        tests.append(_flag(op(_term(logic[0], columns), _term(logic[2], columns))) if op else F.lit(False))
    if not tests:
        return F.lit(False)
    return functools.reduce((lambda a, b: a | b) if any_of else (lambda a, b: a & b), tests)


def actions(df: DataFrame, enter: Sequence, exit: Sequence, any_enter: bool = False, any_exit: bool = False) -> DataFrame:
    """Action per row: x (exit first), e or an empty string."""
    out = F.when(frame_logic(exit, df.columns, any_exit), "x").when(frame_logic(enter, df.columns, any_enter), "e").otherwise("")
    return df.withColumn("action", out)


# --- splitters ------------------------------------------------------------------------------------------------------


def split_ranges(df: DataFrame, ts: str, ranges: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """Rows per (split, set) for explicit train and test date ranges, both ends included."""
    stamp = lambda s: F.lit(s).cast("timestamp")
    marks = []
    for k, (a, b, c, d) in enumerate(ranges):
        part = F.when(F.col(ts).between(stamp(a), stamp(b)), "train").when(F.col(ts).between(stamp(c), stamp(d)), "test")
        marks.append(F.struct(F.lit(k).alias("split"), part.alias("set")))
    rows = df.withColumn("_s", F.explode(F.array(*marks)))
    return rows.select(*df.columns, "_s.split", "_s.set").filter(F.col("set").isNotNull())


def _numbered(df: DataFrame, axis: Axis) -> DataFrame:
    return number(df, axis, length="_n").withColumn("_i", F.col(POS) - 1)


def _splits(rows: DataFrame, first: Column, last: Column) -> DataFrame:
    k = F.when(first <= last, F.sequence(first.cast("long"), last.cast("long"))).otherwise(F.array().cast("array<long>"))
    return rows.withColumn("split", F.explode(k))


def split_rolling(df: DataFrame, axis: Axis, train: int = 252, test: int = 63, step: int = 21) -> DataFrame:
    """Fixed train window followed by a test window, advancing by ``step``; each row only lists the splits it is in."""
    rows = _numbered(df, axis)
    i, total = F.col("_i"), train + test
    latest = F.least(F.floor(i / step), F.floor((F.col("_n") - total) / step))
    rows = _splits(rows, F.greatest(F.ceil((i - total + 1) / step), F.lit(0)), latest)
    inside = i - F.col("split") * step
    return rows.withColumn("set", F.when(inside < train, "train").otherwise("test")).drop("_n", "_i", POS)


def split_expanding(df: DataFrame, axis: Axis, start: int = 252, test: int = 63, step: int = 21) -> DataFrame:
    """Train from the first row to a growing end, test on the rows after it."""
    rows = _numbered(df, axis)
    i = F.col("_i")
    latest = F.floor((F.col("_n") - test - start) / step)
    rows = _splits(rows, F.greatest(F.ceil((i - test - start + 1) / step), F.lit(0)), latest)
    end = start + F.col("split") * step
    return rows.withColumn("set", F.when(i < end, "train").otherwise("test")).drop("_n", "_i", POS)


def split_purged(df: DataFrame, axis: Axis, folds: int = 5, purge: int = 5, embargo: int = 5) -> DataFrame:
    """K folds; rows right before and after the test fold are left out of training."""
    rows = _numbered(df, axis).withColumn("split", F.explode(F.sequence(F.lit(0), F.lit(folds - 1))))
    i, size = F.col("_i"), F.floor(F.col("_n") / folds)
    a = F.col("split") * size
    b = F.least(a + size, F.col("_n"))
    kind = F.when((i >= a) & (i < b), "test").when((i < a - purge) | (i >= b + embargo), "train")
    return rows.withColumn("set", kind).filter(F.col("set").isNotNull()).drop("_n", "_i", POS)


# --- strategies -----------------------------------------------------------------------------------------------------


def _two(entry, exit):
    return lambda w: {"entry": _flag(entry()), "exit": _flag(exit())}


def strategy(name: str, prefix: str = "", **p) -> tuple[dict[str, tuple[str, dict]], Callable]:
    """Indicators and the entry / exit columns of a named strategy; ``prefix`` keeps their names apart."""

    def g(k, default):
        return p.get(k, default)

    def col(n):
        return F.col(prefix + n if n.startswith("_") else n)

    def cross(a, b):
        return lambda w: crossover_signals(w, col(a), col(b))

    catalog = {
        "sma_crossover": lambda: ({"_a": ("sma", {"period": g("fast", 10)}), "_b": ("sma", {"period": g("slow", 20)})}, cross("_a", "_b")),
        "ema_crossover": lambda: ({"_a": ("ema", {"period": g("fast", 10)}), "_b": ("ema", {"period": g("slow", 20)})}, cross("_a", "_b")),
        "macd": lambda: ({"_m": ("macd", {k: p[k] for k in ("fast", "slow", "signal") if k in p})}, cross("_m_line", "_m_signal")),
        "adx_trend": lambda: (
            {"_x": ("adx", {"period": g("period", 14)})},
            _two(
                lambda: (col("_x_adx") > g("threshold", 25)) & (col("_x_plus_di") > col("_x_minus_di")),
                lambda: ((col("_x_adx") > g("threshold", 25)) & (col("_x_minus_di") > col("_x_plus_di"))) | (col("_x_adx") < g("threshold", 25) * 0.7),
            ),
        ),
        "keltner_breakout": lambda: (
            {"_k": ("keltner", {"period": g("period", 20), "atr": g("atr", 10), "k": g("multiplier", 2.0)})},
            _two(lambda: col("close") > col("_k_upper"), lambda: col("close") < col("_k_middle")),
        ),
        "triple_ma": lambda: (
            {"_a": ("ema", {"period": g("fast", 5)}), "_b": ("ema", {"period": g("medium", 20)}), "_d": ("ema", {"period": g("slow", 50)})},
            _two(lambda: (col("_a") > col("_b")) & (col("_b") > col("_d")), lambda: col("_a") < col("_b")),
        ),
        "mean_reversion": lambda: (
            {"_m": ("sma", {"period": g("period", 20)}), "_s": ("std_dev", {"period": g("period", 20)})},
            lambda w: reversion_signals((col("close") - col("_m")) / positive(col("_s")), g("z", 2.0), g("z", 2.0) * 0.5),
        ),
        "bollinger": lambda: (
            {"_b": ("bollinger", {"period": g("period", 20), "k": g("k", 2.0)})},
            _two(lambda: col("close") < col("_b_lower"), lambda: col("close") > col("_b_upper")),
        ),
        "rsi": lambda: ({"_r": ("rsi", {"period": g("period", 14)})}, lambda w: threshold_signals(w, col("_r"), g("oversold", 30.0), g("overbought", 70.0))),
        "stochastic": lambda: (
            {"_s": ("stochastic", {"period": g("k", 14), "smooth": g("d", 3)})},
            _two(
                lambda: (col("_s_k") < g("oversold", 20)) & (col("_s_k") > col("_s_d")),
                lambda: (col("_s_k") > g("overbought", 80)) & (col("_s_k") < col("_s_d")),
            ),
        ),
        "momentum": lambda: (
            {"_m": ("momentum", {"period": g("lookback", 20)})},
            _two(lambda: col("_m") > g("threshold", 0.0), lambda: col("_m") < -g("threshold", 0.0)),
        ),
        "dual_momentum": lambda: (
            {"_a": ("momentum", {"period": g("short", 20)}), "_b": ("momentum", {"period": g("long", 60)})},
            _two(lambda: (col("_a") > g("threshold", 0.0)) & (col("_b") > g("threshold", 0.0)), lambda: col("_a") < -g("threshold", 0.0)),
        ),
        "breakout": lambda: (
            {"_d": ("donchian", {"period": g("period", 20)})},
            lambda w: breakout_signals(col("close"), F.lag(col("_d_upper")).over(w), F.lag(col("_d_lower")).over(w)),
        ),
        "volatility_breakout": lambda: (
            {"_a": ("atr", {"period": g("period", 20)})},
            lambda w: breakout_signals(
                col("close"), F.coalesce(F.lag("close").over(w), col("close")) + g("k", 1.5) * col("_a"),
                F.coalesce(F.lag("close").over(w), col("close")) - g("k", 1.5) * col("_a"),
            ),
        ),
        "rsi_macd": lambda: (
            {"_r": ("rsi", {"period": g("period", 14)}), "_m": ("macd", {})},
            _two(
                lambda: (col("_r") < g("oversold", 30)) & (col("_m_histogram") > 0),
                lambda: (col("_r") > g("overbought", 70)) | (col("_m_histogram") < 0),
            ),
        ),
        "macd_adx": lambda: (
            {"_m": ("macd", {}), "_x": ("adx", {"period": g("period", 14)})},
            _two(lambda: (col("_m_line") > col("_m_signal")) & (col("_x_adx") > g("threshold", 25)), lambda: ~(col("_m_line") > col("_m_signal"))),
        ),
        "bollinger_rsi": lambda: (
            {"_b": ("bollinger", {"period": g("period", 20)}), "_r": ("rsi", {"period": g("rsi", 14)})},
            _two(
                lambda: (col("close") < col("_b_lower")) & (col("_r") < g("oversold", 30)),
                lambda: (col("close") > col("_b_upper")) | (col("_r") > g("overbought", 70)),
            ),
        ),
        "williams_r": lambda: (
            {"_w": ("williams_r", {"period": g("period", 14)})},
            _two(lambda: col("_w") < g("oversold", -80), lambda: col("_w") > g("overbought", -20)),
        ),
        "cci": lambda: ({"_c": ("cci", {"period": g("period", 20)})}, _two(lambda: col("_c") < g("lower", -100), lambda: col("_c") > g("upper", 100))),
        "obv_trend": lambda: (
            {"_o": ("obv", {}), "_s": ("obv_smoothed", {"period": g("period", 20)})},
            _two(lambda: col("_o") > col("_s"), lambda: col("_o") < col("_s")),
        ),
    }
    wanted, columns = catalog[name]()
    return {prefix + a: spec for a, spec in wanted.items()}, columns


STRATEGIES = (
    "sma_crossover", "ema_crossover", "macd", "adx_trend", "keltner_breakout", "triple_ma", "mean_reversion", "bollinger", "rsi",
    "stochastic", "momentum", "dual_momentum", "breakout", "volatility_breakout", "rsi_macd", "macd_adx", "bollinger_rsi",
    "williams_r", "cci", "obv_trend",
)


def strategy_signals(bars: DataFrame, name: str, axis: Axis = HOURLY, **params) -> DataFrame:
    """Bars with the entry and exit flags of a named strategy."""
    wanted, columns = strategy(name, **params)
    keep = bars.columns
    return compute(bars, wanted, axis, after=[columns], after_reach=1).select(*keep, "entry", "exit")


def all_strategy_signals(bars: DataFrame, names: Sequence[str] = STRATEGIES, axis: Axis = HOURLY) -> DataFrame:
    """Long form (strategy, entry, exit) of several strategies; their indicators share one pass over the bars."""
    wanted, makers = {}, {}
    for n in names:
        more, makers[n] = strategy(n, prefix=f"{n}_")
        wanted.update(more)
    keep = bars.columns

    def flags(w):
        return {f"{n}:{k}": c for n, make in makers.items() for k, c in make(w).items()}

    rows = compute(bars, wanted, axis, after=[flags], after_reach=1)
    each = [F.struct(F.lit(n).alias("strategy"), F.col(f"`{n}:entry`").alias("entry"), F.col(f"`{n}:exit`").alias("exit")) for n in names]
    return rows.withColumn("_s", F.explode(F.array(*each))).select(*keep, "_s.*")
