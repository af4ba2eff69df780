"""Alpha models as tables of insights (symbol, ts, direction, magnitude)."""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.functions.stats import normal_cdf
from candlewick.operators import ranking
from candlewick.operators.indicators import avg_n
from candlewick.operators.series import DAILY, HOURLY, Axis, fold, full, over_blocks, prefix, trailing
from candlewick.operators.windows import cross_rank, pct_change, positive

UP, DOWN = 1, -1


def insight(rows: DataFrame, direction: Column, magnitude: Column, symbol: str = "symbol", ts: str = "ts") -> DataFrame:
    out = rows.select(F.col(symbol).alias("symbol"), F.col(ts).alias("ts"), direction.cast("int").alias("direction"), magnitude.alias("magnitude"))
    return out.filter(F.col("direction").isNotNull())


def bar_strength(bars: DataFrame, n: int = 2, ts: str = "ts") -> DataFrame:
    """Short the ``n`` highest, buy the ``n`` lowest internal bar strengths of each time (at most half of the symbols)."""
    span = F.col("high") - F.col("low")
    rows = bars.filter(F.col("open") * span != 0).withColumns(
        {"_x": F.round((F.col("close") - F.col("low")) / span, 6), "_m": F.abs(F.col("close") / F.col("open") - 1)}
    )
    rows = cross_rank(rows, "_x", (ts,), out="_low")
    sizes = rows.groupBy(ts).agg(F.count(F.lit(1)).alias("_n"))
    rows = rows.join(sizes, ts)
    take = F.least(F.floor(F.col("_n") / 2), F.lit(n))
    side = F.when(F.col("_low") <= take, UP).when(F.col("_low") > F.col("_n") - take, DOWN)
    return insight(rows, side, F.col("_m"), ts=ts)


def pumped(bars: DataFrame, n: int = 10, ts: str = "ts") -> DataFrame:
    """Short the ``n`` symbols with the largest open-to-close gain of each time."""
    rows = bars.filter(F.col("open") != 0).withColumn("_x", F.round(F.col("close") / F.col("open") - 1, 6))
    top = ranking.top_n(rows, [ts], [F.desc("_x"), F.asc("symbol")], n)
    return insight(top, F.lit(DOWN), F.abs(F.col("close") / F.col("open") - 1), ts=ts)


def magic_formula(universe: DataFrame, bars: DataFrame, period: Column, axis: Axis = DAILY, lookback: int = 1) -> DataFrame:
    """Rising insights for the members of a periodic universe with the rate of change as magnitude.

    ``universe``: period, symbol; ``period`` maps the time of a bar to its period.
    """
    rows = over_blocks(bars, axis, lambda w: {"_roc": pct_change(w, "close", lookback)}, back=lookback)
    rows = rows.withColumn("period", period).join(universe, ["period", "symbol"]).filter(F.col("_roc").isNotNull())
    return insight(rows, F.lit(UP), F.col("_roc"))


def gap_reversion(bars: DataFrame, axis: Axis = HOURLY, lookback: int = 100, factor: float = 3.0) -> DataFrame:
    """Fade a jump whose percent size exceeds ``factor`` population deviations of the last closes."""

    def cols(w):
        sd = full(F.stddev_pop("close").over(trailing(w, lookback)), "close", w, lookback)
        return {"_jump": pct_change(w), "_sd": sd}

    rows = over_blocks(bars, axis, cols, back=lookback).filter(F.abs(F.col("_jump") * 100) > factor * F.col("_sd"))
    return insight(rows, F.when(F.col("_jump") > 0, DOWN).otherwise(UP), F.col("_jump"))


def _on_change(rows: DataFrame, axis: Axis, side: str) -> DataFrame:
    """Rows whose side differs from the last known one."""
    rows = prefix(rows, axis, {"_before": ("last", side)}, exclusive=True)
    return rows.filter(F.col(side).isNotNull() & ~F.col(side).eqNullSafe(F.col("_before")))


def dual_thrust(bars: DataFrame, axis: Axis = HOURLY, k1: float = 0.63, k2: float = 0.63, n: int = 20) -> DataFrame:
    """Breakout of the last ``n`` bars' range around the previous close; only a change of side is emitted."""

    def cols(w):
        f = w.rowsBetween(-n, -1)
        hh, hc = F.max("high").over(f), F.max("close").over(f)
        lc, ll = F.min("close").over(f), F.min("low").over(f)
        reach, prev = F.greatest(hh - lc, hc - ll), F.lag("close").over(w)
        side = F.when(F.col("close") > prev + k1 * reach, UP).when(F.col("close") < prev - k2 * reach, DOWN)
        return {"_side": F.when(F.count("close").over(f) == n, side)}

    rows = _on_change(over_blocks(bars, axis, cols, back=n), axis, "_side")
    return insight(rows, F.col("_side"), F.lit(None).cast("double"))


def lunch_break(bars: DataFrame, axis: Axis = HOURLY, hour: int = 12) -> DataFrame:
    """At noon, fade the percent change of three bars; magnitude = mean one-bar change of three bars."""

    def first(w):
        return {"_r1": pct_change(w) * 100, "_r3": pct_change(w, "close", 3) * 100}

    rows = over_blocks(bars, axis, [first, lambda w: {"_m": avg_n(w, "_r1", 3)}], back=4)
    rows = rows.filter((F.hour(axis.order[0]) == hour) & F.col("_m").isNotNull())
    return insight(rows, F.when(F.col("_r3") > 0, DOWN).otherwise(UP), F.abs("_m"))


def intraday_reversal(bars: DataFrame, axis: Axis = HOURLY, n: int = 5, start: int = 10, end: int = 15) -> DataFrame:
    """Between two hours of the day: up below the average (plus 0.1 %), else down; only changes are emitted."""
    rows = over_blocks(bars, axis, lambda w: {"_sma": avg_n(w, "close", n)}, back=n - 1)
    minutes = F.hour(axis.order[0]) * 60 + F.minute(axis.order[0])
    rows = rows.filter(minutes.between(start * 60, end * 60))
    rows = rows.withColumn("_side", F.when(F.col("close") < F.round(F.col("_sma") * 1.001, 6), UP).otherwise(DOWN))
    return insight(_on_change(rows, axis, "_side"), F.col("_side"), F.lit(None).cast("double"))


def rate_volatility(rate: DataFrame, symbols: Sequence[str], axis: Axis, n: int = 15, deviations: float = 2.0, magnitude: float = 0.005) -> DataFrame:
    """When a rate leaves its band, one insight per listed symbol: the half band (up) overrides the full band (down)."""

    def cols(w):
        f = trailing(w, n)
        return {"_m": avg_n(w, "value", n), "_d": deviations * full(F.stddev_pop("value").over(f), "value", w, n)}

    rows = over_blocks(rate, axis, cols, back=n - 1)
    off = F.abs(F.col("value") - F.col("_m"))
    side = F.when(off > F.col("_d") / 2, UP).when(off > F.col("_d"), DOWN)
    rows = rows.withColumn("_side", side).filter(F.col("_side").isNotNull()).select(axis.order[0], "_side")
    out = rows.withColumn("symbol", F.explode(F.array(*[F.lit(s) for s in symbols])))
    return insight(out, F.col("_side"), F.lit(magnitude), ts=axis.order[0])


# --- pairs ----------------------------------------------------------------------------------------------------------


def pair_bars(bars: DataFrame, a: str, b: str, ts: str = "ts") -> DataFrame:
    """Closes of two symbols at common times."""
    left = bars.filter(F.col("symbol") == a).select(ts, F.col("close").alias("x"))
    right = bars.filter(F.col("symbol") == b).select(ts, F.col("close").alias("y"))
    return left.join(right, ts).withColumn("symbol", F.lit(f"{a}/{b}"))


def share_class(pairs: DataFrame, axis: Axis = HOURLY, n: int = 10) -> DataFrame:
    """Spread of two share classes held half and half at the first prices: enter against its average, leave when it
    crosses the average, then enter again.  Rows: pair, time, direction of the first class (the second is opposite)."""
    first = pairs.groupBy(*axis.key).agg(F.min_by("x", F.struct(*axis.order)).alias("_x0"), F.min_by("y", F.struct(*axis.order)).alias("_y0"))
    rows = pairs.join(first, list(axis.key)).withColumn("value", F.col("x") / F.col("_x0") - F.col("y") / F.col("_y0"))

    rows = over_blocks(rows, axis, [lambda w: {"_m": avg_n(w, "value", n)}, lambda w: {"_p": F.lag("value").over(w), "_known": F.lag("_m").over(w).isNotNull()}], back=n)
    above = F.col("value") >= F.col("_m")
    cross = above != (F.col("_p") >= F.col("_m"))
    rows = rows.withColumns({"_above": above, "_cross": F.coalesce(cross, F.lit(False))}).filter("_known")
    key, ts = axis.key[0], axis.order[0]
    schema = T.StructType([rows.schema[key], rows.schema[ts], T.StructField("direction", T.IntegerType())])

    def run(part: pd.DataFrame, state):
        invested = bool(state[0]) if state else False
        found = []
        for at, up, crossed in zip(part[ts], part["_above"].to_numpy(), part["_cross"].to_numpy()):
            if not invested:
                found.append((at, DOWN if up else UP))
                invested = True
            elif crossed:
                invested = False
        out = pd.DataFrame(found, columns=[ts, "direction"])
        out[ts] = pd.to_datetime(out[ts])
        out["direction"] = out["direction"].astype("int32")
        out.insert(0, key, part[key].iloc[0])
        return out, [float(invested)]

    return fold(rows.select(key, ts, "_above", "_cross"), axis, run, schema)


def kendall(points: Column) -> Column:
    """Kendall's tau-b of an array of structs (x, y); the array is a bounded history."""

    def sign_sum(f):
        inner = lambda a: F.aggregate(points, F.lit(0.0), lambda s, b: s + f(a, b))
        return F.aggregate(F.transform(points, inner), F.lit(0.0), lambda s, v: s + v)

    both = sign_sum(lambda a, b: F.signum(a["x"] - b["x"]) * F.signum(a["y"] - b["y"]))
    nx = sign_sum(lambda a, b: F.abs(F.signum(a["x"] - b["x"])))
    ny = sign_sum(lambda a, b: F.abs(F.signum(a["y"] - b["y"])))
    return both / positive(F.sqrt(nx * ny))


def lead_follow_pair(bars: DataFrame, leading: Sequence[str], following: Sequence[str], axis: Axis = DAILY, days: int = 90) -> DataFrame:
    """Kendall correlation of the newest daily returns of each leading and following symbol, best pair first."""
    rows = over_blocks(bars.filter(F.col("symbol").isin([*leading, *following])), axis, lambda w: {"_r": pct_change(w)}, back=1)
    rows = ranking.top_n(rows.filter(F.col("_r").isNotNull()), ["symbol"], [F.desc("ts")], days)
    left = rows.filter(F.col("symbol").isin(list(leading))).select("ts", F.col("symbol").alias("leader"), F.col("_r").alias("x"))
    right = rows.filter(F.col("symbol").isin(list(following))).select("ts", F.col("symbol").alias("follower"), F.col("_r").alias("y"))
    pairs = left.join(right, "ts").groupBy("leader", "follower").agg(F.collect_list(F.struct("x", "y")).alias("_p"))  # ≤ days entries
    return pairs.select("leader", "follower", kendall(F.col("_p")).alias("tau")).orderBy(F.desc("tau"), "leader", "follower")


def lead_follow(bars: DataFrame, pair: DataFrame, axis: Axis = HOURLY, lookback: int = 5, trigger: float = 0.75) -> DataFrame:
    """Follow the leader's percent change of ``lookback`` bars beyond a trigger; ``pair`` has one row."""
    rows = over_blocks(bars, axis, lambda w: {"_roc": pct_change(w, "close", lookback) * 100}, back=lookback)
    rows = rows.join(pair.select(F.col("leader").alias("symbol"), "follower"), "symbol")
    side = F.when(F.col("_roc") > trigger, UP).when(F.col("_roc") < -trigger, DOWN)
    return insight(rows, side, F.round(F.col("_roc") / 100, 6), symbol="follower")


def pairs_zscore(pairs: DataFrame, axis: Axis = HOURLY, n: int = 60, z: float = 2.0) -> DataFrame:
    """Hedge ratio, spread, its rolling z-score and the signal (short, long, exit inside half a deviation, hold)."""
    fit = pairs.groupBy(*axis.key).agg(F.regr_slope("x", "y").alias("hedge_ratio"))
    rows = pairs.join(fit, list(axis.key)).withColumn("spread", F.col("x") - F.col("hedge_ratio") * F.col("y"))

    def cols(w):
        f = trailing(w, n)
        score = (F.col("spread") - F.avg("spread").over(f)) / positive(F.stddev_samp("spread").over(f))
        return {"zscore": full(score, "spread", w, n)}

    rows = over_blocks(rows, axis, cols, back=n - 1)
    s = F.col("zscore")
    signal = F.when(s > z, "short_spread").when(s < -z, "long_spread").when(F.abs(s) < 0.5, "exit").when(s.isNotNull(), "hold")
    return rows.withColumn("signal", signal)


# --- event time and fundamentals ------------------------------------------------------------------------------------


def leveraged_rebalance(bars: DataFrame, groups: DataFrame, at: str = "14:15", move: float = 0.01, magnitude: float = 0.0005) -> DataFrame:
    """At a clock time compare the underlying with its previous day's close and trade its leveraged fund.

    ``groups``: underlying, ultra_long, ultra_short.  Uses the last bar known at that time of the day.
    """
    h, m = map(int, at.split(":"))
    rows = bars.join(groups, F.col("symbol") == F.col("underlying"))
    day = F.to_date("ts")
    clock = F.hour("ts") * 60 + F.minute("ts")
    daily = rows.groupBy("underlying", "ultra_long", "ultra_short", day.alias("day")).agg(
        F.max_by("close", "ts").alias("close"), F.max_by("close", F.when(clock <= h * 60 + m, F.col("ts"))).alias("_now")
    )
    daily = over_blocks(daily, Axis(key=("underlying",), order=("day",), span=DAILY.span), lambda w: {"_prev": F.lag("close").over(w)}, back=1)
    change = F.round((F.col("_now") - F.col("_prev")) / positive(F.col("_prev")), 10)
    side = F.when(change > move, F.struct(F.col("ultra_long").alias("s"), F.lit(UP).alias("d"))).when(
        change < -move, F.struct(F.col("ultra_short").alias("s"), F.lit(DOWN).alias("d"))
    )
    rows = daily.withColumn("_i", side).filter(F.col("_i").isNotNull())
    return rows.select(F.col("_i.s").alias("symbol"), F.col("day").alias("ts"), F.col("_i.d").alias("direction"), F.lit(magnitude).alias("magnitude"))


def decay_pair(bars: DataFrame, groups: DataFrame, magnitude: float = 0.001) -> DataFrame:
    """Short both leveraged funds of every group on every day the underlying trades."""
    days = bars.join(groups, F.col("symbol") == F.col("underlying")).select("ultra_long", "ultra_short", F.to_date("ts").alias("ts")).distinct()
    legs = days.withColumn("symbol", F.explode(F.array("ultra_long", "ultra_short")))
    return legs.select("symbol", "ts", F.lit(DOWN).alias("direction"), F.lit(magnitude).alias("magnitude"))


def default_probability(sheets: DataFrame, tau: float = 360.0) -> DataFrame:
    """N(−d2) from the asset history (array ``assets``, oldest first), return on assets, liabilities and payments."""
    known = F.filter(F.col("assets"), lambda a: a != 0)
    steps = F.zip_with(F.slice(known, 1, F.greatest(F.size(known) - 1, F.lit(0))), F.slice(known, 2, F.greatest(F.size(known) - 1, F.lit(0))), lambda a, b: b / a - 1)
    rows = sheets.withColumn("_s", steps)
    n = F.size("_s")
    mean = F.aggregate("_s", F.lit(0.0), lambda s, x: s + x) / n
    var = F.aggregate("_s", F.lit(0.0), lambda s, x: s + (x - mean) * (x - mean)) / n
    rows = rows.withColumns({"sigma": F.when(n > 0, F.sqrt(var)), "_v": F.element_at("assets", -1)})
    drift = (F.col("roa") - F.col("payments")) - 0.5 * F.col("sigma") * F.col("sigma")
    d2 = (F.log("_v") - F.log("liabilities") + drift * tau) / positive(F.col("sigma") * math.sqrt(tau))
    return rows.withColumn("d2", d2).withColumn("default_probability", normal_cdf(-F.col("d2"))).drop("_s", "_v")


def default_alpha(probabilities: DataFrame, threshold: float = 0.25, ts: str = "ts") -> DataFrame:
    p = F.col("default_probability")
    return insight(probabilities.filter((p >= threshold) & (p != 1.0)), F.lit(DOWN), p, ts=ts)
