"""Performance, risk, simulation and portfolio weights."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.functions.stats import normal_cdf_once, normal_ppf
from candlewick.operators import ranking
from candlewick.operators.joins import pair_statistics, pair_sums
from candlewick.operators.machines import HighWater
from candlewick.operators.series import DAILY, Axis, fold, number, over_blocks, prefix
from candlewick.operators.signals import uniform
from candlewick.operators.windows import drawdowns, positive
from candlewick.session import checkpoint_folder

YEAR = 252
ROOT = math.sqrt(YEAR)


def with_returns(bars: DataFrame, axis: Axis, value: str = "close", out: str = "ret") -> DataFrame:
    return over_blocks(bars, axis, lambda w: {out: F.col(value) / F.lag(value).over(w) - 1}, back=1)


def annualised(total: Column, n: Column, year: int = YEAR) -> Column:
    return F.pow(1 + total, year / F.greatest(n, F.lit(1))) - 1


# --- performance ----------------------------------------------------------------------------------------------------


def performance(rows: DataFrame, keys: Sequence[str], value: str = "close", ret: str = "ret", ts: str = "ts", rf: float = 0.04, ddof: int = 1) -> DataFrame:
    """Total, annualised, cumulative return, CAGR by calendar, volatility, best / worst, day counts, moments."""
    x, n = F.col(ret), F.count(ret)
    total = F.max_by(value, ts) / F.min_by(value, ts) - 1
    sd = F.stddev_samp(x) if ddof else F.stddev_pop(x)
    years = F.datediff(F.max(ts), F.min(ts)) / 365.25
    out = rows.groupBy(*keys).agg(
        total.alias("total_return"), annualised(total, n).alias("annualized_return"), F.when(years > 0, F.pow(1 + total, 1 / years) - 1).alias("cagr"),
        (sd * ROOT).alias("volatility"), F.max(x).alias("best"), F.min(x).alias("worst"), F.avg(x).alias("avg_return"), (F.avg(x) * 21).alias("avg_monthly"),
        F.count_if(x > 0).alias("positive"), F.count_if(x < 0).alias("negative"), F.min_by(value, ts).alias("start_price"), F.max_by(value, ts).alias("current_price"), n.alias("n"),
    )
    return out.withColumn("sharpe", F.when(F.col("volatility") > 0, (F.col("annualized_return") - rf) / F.col("volatility")).otherwise(0.0))


def ratios(rows: DataFrame, keys: Sequence[str], ret: str = "ret", rf: float = 0.0, drawdown: str | None = None, year: int = YEAR) -> DataFrame:
    """Sharpe, Sortino (deviation of the returns below the daily rate), Omega, gain / pain, Calmar with a drawdown column."""
    x, rate = F.col(ret), rf / year
    below = F.when(x < rate, x)
    excess = (F.avg(x) - rate) * year
    sd, down = F.stddev_samp(x) * math.sqrt(year), F.when(F.count(below) > 1, F.stddev_samp(below)).otherwise(0.0) * math.sqrt(year)
    gains, losses = F.sum(F.when(x > 0, x).otherwise(0.0)), F.sum(F.when(x < 0, -x).otherwise(0.0))
    aggs = [
        F.when(sd > 0, excess / sd).otherwise(0.0).alias("sharpe"), F.when(down > 0, excess / down).otherwise(0.0).alias("sortino"),
        F.when(losses > 0, gains / losses).alias("omega"), F.when(losses > 0, F.sum(x) / losses).alias("gain_pain"), down.alias("downside_risk"),
    ]
    if drawdown:
        aggs.append(F.when(F.min(drawdown) < 0, F.avg(x) * year / -F.min(drawdown)).otherwise(0.0).alias("calmar"))
    return rows.groupBy(*keys).agg(*aggs)


def max_drawdown(rows: DataFrame, axis: Axis, value: str = "close") -> DataFrame:
    """Deepest drawdown with the times of its peak, trough and recovery, and the current drawdown."""
    ts = axis.order[0]
    dd = drawdowns(rows, axis, value)
    tops = F.struct(F.col("drawdown"), F.col(ts))
    low = dd.groupBy(*axis.key).agg(
        F.min("drawdown").alias("max_drawdown"), F.min_by(F.struct(ts, "peak", "peak_pos"), tops).alias("_low"),
        F.max_by("drawdown", ts).alias("current_drawdown"), F.max("dd_length").alias("longest"),
    )
    low = low.select(*axis.key, "max_drawdown", "current_drawdown", "longest", F.col(f"_low.{ts}").alias("trough_ts"), F.col("_low.peak").alias("_peak"), F.col("_low.peak_pos").alias("_pp"))
    found = dd.join(low, list(axis.key)).groupBy(*axis.key).agg(
        F.max(F.when(F.col("_pos") == F.col("_pp"), F.col(ts))).alias("peak_ts"),
        F.min(F.when((F.col(ts) > F.col("trough_ts")) & (F.col(value) >= F.col("_peak")), F.col(ts))).alias("recovery_ts"),
    )
    return low.drop("_peak", "_pp").join(found, list(axis.key))


# --- value at risk --------------------------------------------------------------------------------------------------


def historical_var(rows: DataFrame, keys: Sequence[str], ret: str = "ret", confidence: float = 0.95) -> DataFrame:
    """VaR and CVaR by three conventions: floor index (tail mean up to the index), ceiling index, interpolated percentile."""
    p = round(1 - confidence, 10)
    pos = ranking.value_positions(rows, keys, ret)
    below, same, n, x = F.col(ranking.BELOW), F.col(ranking.SAME), F.col(ranking.SIZE), F.col(ret)
    at = lambda k: F.max(F.when((below <= k) & (k < below + same), x))
    low, up = F.floor(n * p + 1e-9), F.greatest(F.ceil(n * p - 1e-9) - 1, F.lit(0))
    taken = F.greatest(F.least(below + same, low + 1) - below, F.lit(0))
    base = pos.groupBy(*keys).agg(
        (-at(low)).alias("var_floor"), (-(F.sum(taken * x) / F.max(low + 1))).alias("cvar_floor"), (-at(up)).alias("var_ceil"), F.max(n).alias("n"),
    )
    q = ranking.quantiles(rows, keys, ret, {"_q": p}) if keys else None
    out = base.join(q, list(keys)).withColumn("var_percentile", -F.col("_q")).drop("_q")
    tail = rows.join(out.select(*keys, "var_ceil", "var_percentile"), list(keys)).groupBy(*keys).agg(
        (-F.avg(F.when(x <= -F.col("var_ceil"), x))).alias("cvar_ceil"), (-F.avg(F.when(x <= -F.col("var_percentile"), x))).alias("cvar_percentile"),
    )
    return out.join(tail, list(keys))


def parametric_var(rows: DataFrame, keys: Sequence[str], ret: str = "ret", confidence: float = 0.95, days: int = 1) -> DataFrame:
    """Normal and Cornish-Fisher VaR."""
    z = normal_ppf(1 - confidence)
    m, s, g, k = F.avg(ret), F.stddev_samp(ret), F.skewness(ret), F.kurtosis(ret)
    zcf = z + (z * z - 1) * g / 6 + (z**3 - 3 * z) * k / 24
    root = math.sqrt(days)
    return rows.groupBy(*keys).agg((-(m + z * s) * root).alias("var_normal"), (-(m + zcf * s) * root).alias("var_cornish_fisher"))


def component_var(rows: DataFrame, weights: DataFrame, ts: str = "ts", ret: str = "ret", confidence: float = 0.95, step: float = 0.001) -> DataFrame:
    """Marginal and component VaR of each asset of each portfolio: change of the historical VaR (ceiling index) when
    its weight grows by ``step`` and the weights are scaled back to one.

    ``weights``: portfolio, symbol, weight.  Missing returns count as zero.
    """
    book = rows.select("symbol", ts, ret).join(weights, "symbol")
    whole = book.groupBy("portfolio", ts).agg(F.sum(F.col("weight") * F.col(ret)).alias("_p"))
    each = whole.join(weights, "portfolio").join(rows.select("symbol", ts, F.col(ret).alias("_r")), ["symbol", ts], "left")
    each = each.withColumn("_x", (F.col("_p") + step * F.coalesce("_r", F.lit(0.0))) / (1 + step))

    def var(df: DataFrame, keys: list[str], col: str, out: str) -> DataFrame:
        pos = ranking.value_positions(df, keys, col)
        k = F.greatest(F.ceil(F.col(ranking.SIZE) * round(1 - confidence, 10) - 1e-9) - 1, F.lit(0))
        hit = (F.col(ranking.BELOW) <= k) & (k < F.col(ranking.BELOW) + F.col(ranking.SAME))
        return pos.groupBy(*keys).agg((-F.max(F.when(hit, F.col(col)))).alias(out))

    total = var(whole, ["portfolio"], "_p", "portfolio_var")
    moved = var(each, ["portfolio", "symbol"], "_x", "_moved")
    out = moved.join(total, "portfolio").join(weights, ["portfolio", "symbol"])
    out = out.withColumn("marginal_var", (F.col("_moved") - F.col("portfolio_var")) / step).drop("_moved")
    return out.withColumn("component_var", F.col("marginal_var") * F.col("weight"))


# --- simulation -----------------------------------------------------------------------------------------------------


def gaussian(*key: Column) -> Column:
    """Standard normal number drawn from a hash of the key (two uniforms, Box-Muller)."""
    digest = F.md5(F.concat_ws("|", *[k.cast("string") for k in key]).cast("binary"))
    u1 = F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / float(16**12)
    u2 = F.conv(F.substring(digest, 13, 12), 16, 10).cast("double") / float(16**12)
    return F.sqrt(-2 * F.log(F.greatest(u1, F.lit(1e-10)))) * F.cos(2 * math.pi * u2)


def simulate(params: DataFrame, keys: Sequence[str], paths: int, steps: int, seed: int = 0, log_steps: bool = True) -> DataFrame:
    """Terminal value and maximum drawdown of random paths from 1.

    ``params``: keys, mean, std per step.  Each path is one row that spreads over the cluster; its steps are folded
    inside the row.  ``log_steps`` uses exp(mean − std²/2 + std·z), else 1 + mean + std·z.
    """
    rows = params.withColumn("path", F.explode(F.sequence(F.lit(0), F.lit(paths - 1)))).repartition(*keys, "path")
    m, s = F.col("mean"), F.col("std")

    def growth(i: Column) -> Column:
        z = gaussian(F.lit(seed), *[F.col(k) for k in keys], F.col("path"), i)
        return F.exp(m - s * s / 2 + s * z) if log_steps else 1 + m + s * z

    start = F.struct(F.lit(1.0).alias("v"), F.lit(1.0).alias("top"), F.lit(0.0).alias("low"))

    def step(a: Column, g: Column) -> Column:
        v = a["v"] * g
        top = F.greatest(a["top"], v)
        return F.struct(v.alias("v"), top.alias("top"), F.least(a["low"], v / top - 1).alias("low"))

    walk = F.aggregate(F.transform(F.sequence(F.lit(1), F.lit(steps)), growth), start, step)
    return rows.withColumn("_w", walk).select(*keys, "path", F.col("_w.v").alias("terminal"), F.col("_w.low").alias("max_drawdown"))


def bootstrap(rows: DataFrame, axis: Axis, paths: int, steps: int, seed: int = 0, ret: str = "ret") -> DataFrame:
    """Terminal value of paths made of returns drawn with replacement (equi-join on a drawn position)."""
    known = number(rows.filter(F.col(ret).isNotNull()).select(*axis.key, *axis.order, ret), axis, length="_n")
    sizes = known.groupBy(*axis.key).agg(F.max("_n").alias("_n"))
    keys = [F.col(k) for k in axis.key]
    draws = sizes.withColumn("path", F.explode(F.sequence(F.lit(0), F.lit(paths - 1))))
    draws = draws.withColumn("_i", F.explode(F.sequence(F.lit(1), F.lit(steps))))
    draws = draws.withColumn("_pos", F.floor(uniform(F.lit(seed), *keys, F.col("path"), F.col("_i")) * F.col("_n")) + 1)
    picked = draws.join(known.select(*axis.key, "_pos", ret), [*axis.key, "_pos"])
    return picked.groupBy(*axis.key, "path").agg(F.exp(F.sum(F.log1p(ret))).alias("terminal"))


def simulation_summary(paths: DataFrame, keys: Sequence[str], confidence: float = 0.95) -> DataFrame:
    """Mean, quantiles, probability of profit and VaR of the terminal values."""
    x = F.col("terminal")
    base = paths.groupBy(*keys).agg(
        F.avg(x).alias("mean"), F.min(x).alias("min"), F.max(x).alias("max"), F.avg((x > 1).cast("double")).alias("prob_profit"), F.count(x).alias("paths"),
        *([F.avg("max_drawdown").alias("avg_drawdown")] if "max_drawdown" in paths.columns else []),
    )
    q = ranking.quantiles(paths, keys, "terminal", {"p5": 0.05, "p25": 0.25, "median": 0.5, "p75": 0.75, "p95": 0.95, "_v": 1 - confidence})
    return base.join(q, list(keys)).withColumn("var", 1 - F.col("_v")).drop("_v")


# --- scenarios ------------------------------------------------------------------------------------------------------


def stress_test(rows: DataFrame, keys: Sequence[str], scenarios: Mapping[str, float], ret: str = "ret") -> DataFrame:
    """Mean, volatility and historical VaR 95 / 99 (ceiling index) of returns shifted by each shock."""
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("scenario"), F.lit(float(s)).alias("shock")) for n, s in scenarios.items()]))
    out = rows.filter(F.col(ret).isNotNull()).withColumn("_s", each).select(*keys, "_s.*", (F.col(ret) + F.col("_s.shock")).alias("_x"))
    by = [*keys, "scenario"]
    stats = out.groupBy(*by).agg(F.max("shock").alias("shock"), F.avg("_x").alias("mean"), F.stddev_samp("_x").alias("volatility"))
    pos = ranking.value_positions(out, by, "_x")

    def var(c: float) -> Column:
        k = F.greatest(F.ceil(F.col(ranking.SIZE) * round(1 - c, 10) - 1e-9) - 1, F.lit(0))
        hit = (F.col(ranking.BELOW) <= k) & (k < F.col(ranking.BELOW) + F.col(ranking.SAME))
        return -F.max(F.when(hit, F.col("_x")))

    return stats.join(pos.groupBy(*by).agg(var(0.95).alias("var_95"), var(0.99).alias("var_99")), by)


def crisis_periods(rows: DataFrame, keys: Sequence[str], periods: Mapping[str, tuple[str, str]], ret: str = "ret", ts: str = "ts") -> DataFrame:
    """Return, volatility, worst bar and lowest cumulative sum of each series in named date ranges (ends included)."""
    marks = [
        F.when(F.col(ts).between(F.lit(a).cast("timestamp"), F.lit(b).cast("timestamp")), F.lit(n)) for n, (a, b) in periods.items()
    ]
    out = rows.filter(F.col(ret).isNotNull()).withColumn("period", F.explode(F.array_compact(F.array(*marks))))
    axis = Axis(key=(*keys, "period"), order=(ts,), span=DAILY.span)
    out = prefix(out, axis, {"_c": ("sum", ret)})
    return out.groupBy(*keys, "period").agg(
        (F.exp(F.sum(F.log1p(ret))) - 1).alias("total_return"), (F.stddev_samp(ret) * ROOT).alias("volatility"), F.min("_c").alias("max_drawdown"), F.min(ret).alias("worst"),
    )


# --- against a benchmark ---------------------------------------------------------------------------------------------


def _markets(rows: DataFrame, bench: str) -> DataFrame:
    """Each row once for all markets and once more for its bull or bear market."""
    side = F.when(F.col(bench) > 0, "bull").when(F.col(bench) < 0, "bear")
    return rows.withColumn("market", F.explode(F.array_compact(F.array(F.lit("all"), side))))


def benchmark_measures(rows: DataFrame, keys: Sequence[str], ret: str = "ret", bench: str = "bench", rf: float = 0.0, year: int = YEAR) -> DataFrame:
    """CAPM beta, alpha, R², risk split, Treynor, M², tracking error and information ratio for all, bull and bear markets.

    Bull and bear need at least five rows.
    """
    rows = _markets(rows.filter(F.col(ret).isNotNull() & F.col(bench).isNotNull()), bench)
    p, b = F.col(ret), F.col(bench)
    active = p - b
    root = math.sqrt(year)
    s = rows.groupBy(*keys, "market").agg(
        F.count(F.lit(1)).alias("n"), (F.covar_samp(p, b) / positive(F.var_samp(b))).alias("beta"), F.avg(p).alias("_p"), F.avg(b).alias("_b"),
        F.stddev_samp(p).alias("_sp"), F.stddev_samp(b).alias("_sb"), F.corr(p, b).alias("_c"), F.avg(active).alias("_a"), F.stddev_samp(active).alias("_sa"),
    )
    s = s.filter((F.col("market") == "all") | (F.col("n") >= 5))
    beta, ann = F.col("beta"), lambda c: F.col(c) * year
    sharpe = (ann("_p") - rf) / positive(F.col("_sp") * root)
    out = s.withColumns(
        {
            "alpha": ann("_p") - (rf + beta * (ann("_b") - rf)), "r2": F.col("_c") * F.col("_c"),
            "systematic_risk": beta * beta * F.col("_sb") * F.col("_sb"),
            "specific_risk": F.col("_sp") * F.col("_sp") - beta * beta * F.col("_sb") * F.col("_sb"),
            "treynor": (ann("_p") - rf) / positive(beta), "m2": rf + sharpe * F.col("_sb") * root,
            "tracking_error": F.col("_sa") * root, "information_ratio": ann("_a") / positive(F.col("_sa") * root),
        }
    )
    return out.drop("_p", "_b", "_sp", "_sb", "_c", "_a", "_sa")


def capture(rows: DataFrame, keys: Sequence[str], ret: str = "ret", bench: str = "bench") -> DataFrame:
    """Up / down capture (percent), their ratio, hit rate and batting average."""
    p, b = F.col(ret), F.col(bench)
    side = lambda c, k: F.avg(F.when(c, k))
    up = side(b > 0, p) / positive(side(b > 0, b)) * 100
    down = side(b < 0, p) / positive(side(b < 0, b)) * 100
    return rows.groupBy(*keys).agg(
        up.alias("up_capture"), down.alias("down_capture"), (up / positive(down)).alias("capture_ratio"),
        (F.count_if(p > 0) / F.count(p) * 100).alias("hit_rate"), F.avg((p > b).cast("double")).alias("batting_average"),
    )


def public_market_equivalent(rows: DataFrame, keys: Sequence[str], ret: str = "ret", bench: str = "bench", year: int = YEAR) -> DataFrame:
    """Ratio of growth to benchmark growth, annualised returns, annualised alpha, tracking error."""
    p, b, n = F.col(ret), F.col(bench), F.count(F.lit(1))
    gp, gb = F.exp(F.sum(F.log1p(p))), F.exp(F.sum(F.log1p(b)))
    active = p - b
    return rows.groupBy(*keys).agg(
        (gp / gb).alias("pme_ratio"), (F.pow(gp, year / n) - 1).alias("annual_return"), (F.pow(gb, year / n) - 1).alias("annual_benchmark"),
        (F.avg(active) * year).alias("annual_alpha"), (F.stddev_samp(active) * math.sqrt(year)).alias("tracking_error"), (gp - gb).alias("outperformance"), n.alias("days"),
    )


def pme_cash_flows(flows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Cash flows grown with an index to the end: final value over future value of the flows (amount, price, end_price, value)."""
    grown = F.sum(F.col("amount") * F.col("end_price") / F.col("price"))
    return flows.groupBy(*keys).agg((F.max("value") / positive(grown)).alias("pme"))


# --- extended statistics ---------------------------------------------------------------------------------------------


def extended_statistics(rows: DataFrame, keys: Sequence[str], ret: str = "ret", drawdown: str = "drawdown", year: int = YEAR) -> DataFrame:
    """Win rate, payoff, Kelly, profit factor, tail and outlier ratios, ulcer index and performance, recovery, exposure."""
    x, dd = F.col(ret), F.col(drawdown)
    win, loss = F.avg(F.when(x > 0, x)), F.avg(F.when(x < 0, x))
    rate = F.count_if(x > 0) / positive(F.count_if(x != 0))
    total = F.exp(F.sum(F.log1p(x))) - 1
    base = rows.groupBy(*keys).agg(
        rate.alias("win_rate"), win.alias("avg_win"), loss.alias("avg_loss"), F.abs(win / positive(loss)).alias("payoff_ratio"),
        (F.sum(F.when(x > 0, x)) / positive(F.abs(F.sum(F.when(x < 0, x))))).alias("profit_factor"), F.sqrt(F.avg(dd * dd)).alias("ulcer_index"),
        F.min(dd).alias("max_drawdown"), total.alias("_total"), F.avg(x).alias("_m"), (F.count_if(x != 0) / F.count(x)).alias("exposure"),
        (F.exp(F.avg(F.log1p(x))) - 1).alias("expected_return"), F.stddev_samp(x).alias("_s"),
    )
    q = ranking.quantiles(rows, keys, ret, {"_p95": 0.95, "_p5": 0.05, "_p99": 0.99, "_p1": 0.01})
    out = base.join(q, list(keys))
    b = F.col("payoff_ratio")
    return out.withColumns(
        {
            "kelly": (b * F.col("win_rate") - (1 - F.col("win_rate"))) / positive(b), "tail_ratio": F.abs(F.col("_p95") / positive(F.col("_p5"))),
            "outlier_win_ratio": F.col("_p99") / positive(F.col("avg_win")), "outlier_loss_ratio": F.col("_p1") / positive(F.col("avg_loss")),
            "ulcer_performance": F.col("_total") / positive(F.col("ulcer_index")), "recovery_factor": F.abs(F.col("_total") / positive(F.col("max_drawdown"))),
            "risk_return_ratio": F.col("_m") / positive(F.col("_s")), "cpc_index": F.col("profit_factor") * F.col("win_rate") * b,
        }
    ).drop("_total", "_m", "_s", "_p95", "_p5", "_p99", "_p1")


def equity_summary(rows: DataFrame, keys: Sequence[str], ret: str = "ret", drawdown: str = "drawdown") -> DataFrame:
    """All metrics of a run at once: VaR / CVaR 95 and 99, ulcer index, Omega, tail ratio, moments, quartiles.

    The higher moments divide by the sample deviation.
    """
    x, dd = F.col(ret), F.col(drawdown)
    q = ranking.quantiles(rows, keys, ret, {"var_95": 0.05, "var_99": 0.01, "p25": 0.25, "p75": 0.75, "p95": 0.95})
    both = rows.join(q, list(keys))
    gains, losses = F.sum(F.when(x > 0, x).otherwise(0.0)), F.sum(F.when(x < 0, -x).otherwise(0.0))
    out = both.groupBy(*keys).agg(
        *[F.max(c).alias(c) for c in ("var_95", "var_99", "p25", "p75", "p95")], F.avg(F.when(x <= F.col("var_95"), x)).alias("cvar_95"),
        F.avg(F.when(x <= F.col("var_99"), x)).alias("cvar_99"), F.sqrt(F.avg(dd * dd * 10000)).alias("ulcer_index"),
        F.when(losses > 0, gains / losses).otherwise(99.0).alias("omega"), (F.skewness(x) * F.pow((F.count(x) - 1) / F.count(x), F.lit(1.5))).alias("skewness"),
        ((F.kurtosis(x) + 3) * F.pow((F.count(x) - 1) / F.count(x), F.lit(2.0)) - 3).alias("kurtosis"),
        F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"), F.count(x).alias("n"),
    )
    return out.withColumn("tail_ratio", F.when(F.abs("var_95") > 1e-10, F.abs(F.col("p95") / F.col("var_95"))).otherwise(99.0))


def sharpe_significance(rows: DataFrame, keys: Sequence[str], ret: str = "ret", trials: int = 1, target: float = 0.0, year: int = YEAR) -> DataFrame:
    """Probabilistic Sharpe (per period) and deflated Sharpe (annualised, best of ``trials``)."""
    best = math.sqrt(2 * math.log(trials)) * (1 - float(np.euler_gamma) / (2 * math.log(trials))) if trials > 1 else 0.0
    x = F.col(ret)
    out = rows.groupBy(*keys).agg(
        F.avg(x).alias("_m"), F.stddev_samp(x).alias("_s"), F.skewness(x).alias("_g"), F.kurtosis(x).alias("_k"), F.count(x).alias("n")
    )
    sr = F.col("_m") / F.col("_s")
    out = out.withColumns({"sharpe": sr * math.sqrt(year), "_sr": sr})
    g, k, n, s, a = F.col("_g"), F.col("_k"), F.col("n"), F.col("_sr"), F.col("sharpe")
    spread = F.sqrt((1 - g * s + (k + 2) / 4 * s * s) / (n - 1))
    part = (n - 1) / n  # moments of the deflated form divide by the sample deviation
    deflated = (1 - g * F.pow(part, F.lit(1.5)) * a + ((k + 3) * part * part - 1) / 4 * a * a) / n
    out = out.withColumns({"_z": (s - target) / spread, "_d": deflated})
    out = out.withColumn("_zd", (a - best) / F.sqrt(F.when(F.col("_d") > 0, F.col("_d"))))
    return out.withColumns(
        {
            "probabilistic_sharpe": normal_cdf_once(F.col("_z")),
            "deflated_sharpe": F.when(n < 10, 0.0).when(F.col("_d") <= 0, a).otherwise(normal_cdf_once(F.col("_zd"))),
        }
    ).drop("_m", "_s", "_g", "_k", "_sr", "_z", "_d", "_zd")


# --- cash flows and fees ---------------------------------------------------------------------------------------------


def time_weighted(bars: DataFrame, keys: Sequence[str], value: str = "close", ts: str = "ts") -> DataFrame:
    """Product of sub-period returns and its annual rate by calendar days."""
    growth = F.max_by(value, ts) / F.min_by(value, ts)
    days = F.datediff(F.max(ts), F.min(ts))
    return bars.groupBy(*keys).agg(
        (growth - 1).alias("twr"), F.when(days > 0, F.pow(growth, 365.25 / days) - 1).otherwise(growth - 1).alias("annualized_twr"),
        (F.count(F.lit(1)) - 1).alias("periods"), days.alias("days"),
    )


def money_weighted(flows: DataFrame, keys: Sequence[str], date: str = "date", amount: str = "amount", steps: int = 80) -> DataFrame:
    """Internal rate of return by bisection, multiple on invested capital and flow count.

    Flows are summed per day first, so a portfolio holds at most one entry per calendar day.
    """
    daily = flows.groupBy(*keys, F.to_date(date).alias("_d")).agg(F.sum(amount).alias("_a"), F.count(F.lit(1)).alias("_n"))
    first = F.array_sort(F.collect_list(F.struct("_d", "_a")))
    book = daily.groupBy(*keys).agg(
        first.alias("_f"), (F.sum(F.when(F.col("_a") > 0, F.col("_a"))) / positive(-F.sum(F.when(F.col("_a") < 0, F.col("_a"))))).alias("moic"), F.sum("_n").alias("flows")
    )
    book = book.withColumn("_y", F.transform("_f", lambda f: F.struct(f["_a"].alias("a"), (F.datediff(f["_d"], F.get("_f", 0)["_d"]) / 365.25).alias("y"))))

    def npv(rate: Column) -> Column:
        return F.aggregate("_y", F.lit(0.0), lambda s, f: s + f["a"] / F.pow(1 + rate, f["y"]))

    start = F.struct(F.lit(-0.99).alias("lo"), F.lit(10.0).alias("hi"))

    def halve(a: Column, _: Column) -> Column:
        mid = (a["lo"] + a["hi"]) / 2
        left = npv(mid) < 0
        return F.struct(F.when(left, a["lo"]).otherwise(mid).alias("lo"), F.when(left, mid).otherwise(a["hi"]).alias("hi"))

    solved = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, halve, lambda a: (a["lo"] + a["hi"]) / 2)
    crosses = npv(F.lit(-0.99)) * npv(F.lit(10.0)) < 0
    return book.withColumn("irr", F.when(crosses, solved)).drop("_f", "_y")


def fee_impact(rows: DataFrame, axis: Axis, management: float, performance: float = 0.0, hurdle: float = 0.0, high_water: bool = True, periods: int = 12, ret: str = "ret") -> DataFrame:
    """Net return, fees and value per period with a performance fee above hurdle and high-water mark (state machine)."""
    ts = axis.order[0]
    schema = T.StructType([rows.schema[k] for k in (*axis.key, ts)] + [T.StructField(n, T.DoubleType()) for n in ("net_return", "management_fee", "performance_fee", "nav")])

    def run(part: pd.DataFrame, state):
        nav, mark = state if state else [100.0, 100.0]
        out = []
        for r in part[ret].to_numpy():
            before, gross = nav, nav * (1 + r)
            base = before * management / periods
            extra = max(0.0, gross - before - before * hurdle / periods) * performance
            if high_water:
                if gross > mark and performance > 0:
                    mark = gross
                else:
                    extra = 0.0
            nav = gross - base - extra
            out.append((nav / before - 1, base, extra, nav))
        res = pd.DataFrame(out, columns=["net_return", "management_fee", "performance_fee", "nav"])
        return pd.concat([part[[*axis.key, ts]].reset_index(drop=True), res], axis=1), [nav, mark]

    def factors(part: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        r = part[ret].astype(float).to_numpy()
        plain = 1 + r - management / periods
        paid = plain - np.maximum(0.0, r - hurdle / periods) * performance
        never = np.full(len(r), -np.inf)
        if not high_water:
            return never, paid, paid
        return (1 + r if performance > 0 else never), plain, paid

    return fold(rows.select(*axis.key, ts, ret), axis, run, schema, machine=HighWater(factors, 100.0))


# --- attribution -----------------------------------------------------------------------------------------------------


def active_attribution(rows: DataFrame, keys: Sequence[str], ret: str = "ret", bench: str = "bench") -> DataFrame:
    a = F.col(ret) - F.col(bench)
    return rows.groupBy(*keys).agg(
        F.avg(ret).alias("portfolio_return"), F.avg(bench).alias("benchmark_return"), F.avg(a).alias("active_return"),
        F.avg((a > 0).cast("double")).alias("hit_rate"), F.stddev_samp(a).alias("active_volatility"), (F.avg(a) / positive(F.stddev_samp(a))).alias("information_ratio"),
    )


def sector_attribution(book: DataFrame, bench: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Allocation, selection and interaction per sector: (sector, weight, ret) of portfolio and benchmark."""
    wp, rp = F.sum("weight"), F.sum(F.col("weight") * F.col("ret")) / positive(F.sum("weight"))
    p = book.groupBy(*keys, "sector").agg(wp.alias("wp"), rp.alias("rp"))
    b = bench.groupBy(*keys, "sector").agg(wp.alias("wb"), rp.alias("rb"))
    total = bench.groupBy(*keys).agg((F.sum(F.col("weight") * F.col("ret")) / positive(F.sum("weight"))).alias("_b"))
    z = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    both = p.join(b, [*keys, "sector"], "full").join(total, list(keys)) if keys else p.join(b, ["sector"], "full").crossJoin(F.broadcast(total))
    return both.withColumns(
        {
            "allocation": (z("wp") - z("wb")) * (z("rb") - F.col("_b")), "selection": z("wb") * (z("rp") - z("rb")), "interaction": (z("wp") - z("wb")) * (z("rp") - z("rb")),
        }
    ).drop("_b")


def persistence(rows: DataFrame, period: str, entity: str = "symbol", ret: str = "ret") -> DataFrame:
    """Rank correlation of entity returns between consecutive periods (``period`` is a date or timestamp column)."""
    per = rows.groupBy(entity, period).agg((F.exp(F.sum(F.log1p(ret))) - 1).alias("_r"))
    per = ranking.ranked(per, [period], "_r", "_k", ascending=False)
    order = Window.partitionBy(F.lit(0)).orderBy(period)  # one row per period
    nxt = per.select(period).distinct().withColumn("next_period", F.lead(period).over(order))
    a = per.select(entity, period, F.col("_k").alias("_a")).join(nxt, period)
    b = per.select(entity, F.col(period).alias("next_period"), F.col("_k").alias("_b"))
    return a.join(b, [entity, "next_period"]).groupBy(period, "next_period").agg(F.corr("_a", "_b").alias("rank_correlation"), F.count(F.lit(1)).alias("entities"))


# --- covariance and weights -------------------------------------------------------------------------------------------


def covariance(rows: DataFrame, ts: str = "ts", symbol: str = "symbol", ret: str = "ret", annualise: int = 1, blocks: int | None = None, times: int | None = None) -> DataFrame:
    """Covariance of every ordered pair (both triangles) and correlation."""
    half = pair_statistics(pair_sums(rows, ts, symbol, ret, blocks, times)).withColumn("cov", F.col("cov") * annualise)
    other = half.filter("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"), "n", "cov", "corr")
    return half.unionByName(other)


def portfolio_variance(weights: DataFrame, cov: DataFrame, keys: Sequence[str] = ("portfolio",)) -> DataFrame:
    """Variance, volatility and diversification ratio of each set of weights (keys, symbol, weight)."""
    left = weights.select(*keys, F.col("symbol").alias("a"), F.col("weight").alias("wa"))
    right = weights.select(*keys, F.col("symbol").alias("b"), F.col("weight").alias("wb"))
    pairs = left.join(cov.select("a", "b", "cov"), "a").join(right, [*keys, "b"])
    own = F.when(F.col("a") == F.col("b"), F.col("wa") * F.sqrt("cov"))
    out = pairs.groupBy(*keys).agg(F.sum(F.col("wa") * F.col("wb") * F.col("cov")).alias("variance"), F.sum(own).alias("_own"))
    return out.withColumns({"volatility": F.sqrt("variance"), "diversification_ratio": F.col("_own") / positive(F.sqrt("variance"))}).drop("_own")


def _nonnegative(cov: np.ndarray, b: np.ndarray, rounds: int = 5000) -> np.ndarray:
    """min ½y'Σy − b'y for y ≥ 0 by coordinate steps; scaled to sum one it is the long-only solution."""
    y = np.zeros(len(b))
    for _ in range(rounds):
        last = y.copy()
        for i in range(len(b)):
            y[i] = max(0.0, y[i] + (b[i] - cov[i] @ y) / cov[i, i])
        if np.max(np.abs(y - last)) < 1e-14 * max(1.0, np.max(np.abs(y))):
            break
    return y / y.sum() if y.sum() > 0 else np.full(len(b), 1 / len(b))


def _equal_risk(cov: np.ndarray, rounds: int = 5000) -> np.ndarray:
    """Weights with equal risk contributions by coordinate steps."""
    n = len(cov)
    y = 1 / np.sqrt(np.diag(cov))
    for _ in range(rounds):
        last = y.copy()
        for i in range(n):
            rest = cov[i] @ y - cov[i, i] * y[i]
            y[i] = (-rest + math.sqrt(rest * rest + 4 * cov[i, i] / n)) / (2 * cov[i, i])
        if np.max(np.abs(y - last)) < 1e-14:
            break
    return y / y.sum()


def _bisection_weights(cov: np.ndarray) -> np.ndarray:
    """Hierarchical risk parity: single-linkage order, then inverse-variance splits of halves."""
    n = len(cov)
    if n == 1:
        return np.ones(1)
    dist = np.sqrt(np.clip((1 - np.corrcoef(cov)) / 2, 0, None))
    groups = {i: [i] for i in range(n)}
    apart = {(i, j): dist[i, j] for i in range(n) for j in range(i + 1, n)}
    fresh = n
    while len(groups) > 1:
        i, j = min(apart, key=lambda k: (apart[k], k))
        joined = groups.pop(i) + groups.pop(j)
        near = {g: min(apart[min(i, g), max(i, g)], apart[min(j, g), max(j, g)]) for g in groups}
        apart = {k: v for k, v in apart.items() if i not in k and j not in k}
        apart.update({(g, fresh): v for g, v in near.items()})
        groups[fresh] = joined
        fresh += 1
    order = next(iter(groups.values()))

    def variance(items):
        part = cov[np.ix_(items, items)]
        w = 1 / np.diag(part)
        w /= w.sum()
        return w @ part @ w

    weights = np.ones(n)
    todo = [order]
    while todo:
        halves = []
        for items in todo:
            if len(items) > 1:
                a, b = items[: len(items) // 2], items[len(items) // 2 :]
                share = 1 - variance(a) / (variance(a) + variance(b))
                weights[a] *= share
                weights[b] *= 1 - share
                halves += [a, b]
        todo = halves
    return weights / weights.sum()


WEIGHT_METHODS = ("equal", "inverse_vol", "inverse_var", "min_variance", "max_sharpe", "equal_risk", "hierarchical")


def optimal_weights(members: DataFrame, cov: DataFrame, means: DataFrame, methods: Sequence[str] = WEIGHT_METHODS, rf: float = 0.04) -> DataFrame:
    """Weights per portfolio and method.

    ``members``: portfolio, symbol; ``cov``: a, b, cov (annual); ``means``: symbol, mean (annual).  The covariance
    comes from Spark; each portfolio then solves a system of the size of its member list in its own task.
    """
    left = members.select("portfolio", F.col("symbol").alias("a"))
    right = members.select("portfolio", F.col("symbol").alias("b"))
    entries = left.join(cov.select("a", "b", "cov"), "a").join(right, ["portfolio", "b"]).join(means.select(F.col("symbol").alias("a"), "mean"), "a")
    schema = T.StructType([members.schema["portfolio"], T.StructField("method", T.StringType()), T.StructField("symbol", T.StringType()), T.StructField("weight", T.DoubleType())])

    def solve(part: pd.DataFrame) -> pd.DataFrame:
        names = sorted(part["a"].unique())
        at = {s: i for i, s in enumerate(names)}
        c = np.zeros((len(names), len(names)))
        c[part["a"].map(at).to_numpy(), part["b"].map(at).to_numpy()] = part["cov"].to_numpy()
        mu = part.drop_duplicates("a").set_index("a")["mean"].reindex(names).to_numpy()
        n, sd = len(names), np.sqrt(np.diag(c))
        ways = {
            "equal": lambda: np.full(n, 1 / n), "inverse_vol": lambda: (1 / sd) / (1 / sd).sum(), "inverse_var": lambda: sd**-2 / (sd**-2).sum(),
            "min_variance": lambda: _nonnegative(c, np.ones(n)), "max_sharpe": lambda: _nonnegative(c, mu - rf), "equal_risk": lambda: _equal_risk(c),
            "hierarchical": lambda: _bisection_weights(c),
        }
        out = [(part["portfolio"].iloc[0], m, s, float(w)) for m in methods for s, w in zip(names, ways[m]())]
        return pd.DataFrame(out, columns=["portfolio", "method", "symbol", "weight"])

    return entries.groupBy("portfolio").applyInPandas(solve, schema)


def _spread_variance(drawn: DataFrame, cov: DataFrame, n: int, block: int) -> DataFrame:
    """``set, v``: Σ x_a x_b cov over all pairs of symbols for each of ``n`` sets of amounts (array ``_e`` of each symbol).

    Pairs lie in tiles of two symbol blocks; a tile multiplies its amounts and covariances as matrices and emits one row a set, not one a pair and set.
    """
    tiles = max(1, math.ceil(drawn.count() / block))
    own = lambda c: F.pmod(F.xxhash64(c), F.lit(tiles)).cast("int")
    every = F.sequence(F.lit(0), F.lit(tiles - 1))
    mine = F.array_union(F.transform(every, lambda j: F.struct(F.col("_s").alias("i"), j.alias("j"))), F.transform(every, lambda i: F.struct(i.alias("i"), F.col("_s").alias("j"))))
    amounts = drawn.withColumn("_s", own("symbol")).select("symbol", "_e", F.inline(mine)).withColumnsRenamed({"i": "_wi", "j": "_wj"})
    pairs = cov.select("a", "b", "cov", own("a").alias("_i"), own("b").alias("_j"))

    def multiply(pairs: pd.DataFrame, amounts: pd.DataFrame) -> pd.DataFrame:
        place = {s: i for i, s in enumerate(amounts["symbol"])}
        known = pairs[pairs["a"].isin(place) & pairs["b"].isin(place) & pairs["cov"].notna()]
        if not len(known):
            return pd.DataFrame({"set": pd.Series(dtype="int32"), "v": pd.Series(dtype="float64")})
        x = np.stack(amounts["_e"].to_numpy())
        left, a = np.unique(known["a"].map(place).to_numpy(), return_inverse=True)
        right, b = np.unique(known["b"].map(place).to_numpy(), return_inverse=True)
        matrix = np.zeros((len(left), len(right)))
        matrix[a, b] = known["cov"].to_numpy()
        return pd.DataFrame({"set": np.arange(n, dtype="int32"), "v": ((matrix.T @ x[left]) * x[right]).sum(axis=0)})

    parts = pairs.groupBy("_i", "_j").cogroup(amounts.groupBy("_wi", "_wj")).applyInPandas(multiply, "set int, v double")
    return parts.groupBy("set").agg(F.sum("v").alias("v"))


def random_frontier(cov: DataFrame, means: DataFrame, n: int = 1000, seed: int = 0, rf: float = 0.02, buckets: int = 20, block: int = 512) -> DataFrame:
    """Random long-only weight sets over the symbols of ``means``; per risk bucket the one with the highest return."""
    checkpoint_folder(means.sparkSession)
    amount = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda s: -F.log(F.greatest(uniform(F.lit(seed), s, F.col("symbol")), F.lit(1e-12))))
    drawn = means.select("symbol", "mean", amount.alias("_e")).checkpoint()
    sums = drawn.select("mean", F.posexplode("_e").alias("set", "x")).groupBy("set").agg(F.sum("x").alias("_t"), F.sum(F.col("x") * F.col("mean")).alias("_r"))
    points = sums.join(_spread_variance(drawn.select("symbol", "_e"), cov, n, block), "set")
    points = points.select("set", (F.sqrt("v") / F.col("_t")).alias("volatility"), (F.col("_r") / F.col("_t")).alias("return"))
    points = points.withColumn("sharpe", (F.col("return") - rf) / positive(F.col("volatility")))
    ends = points.agg(F.min("volatility").alias("_lo"), F.max("volatility").alias("_hi"))
    points = points.crossJoin(F.broadcast(ends))  # one row
    bucket = F.least(F.floor((F.col("volatility") - F.col("_lo")) / positive(F.col("_hi") - F.col("_lo")) * buckets), F.lit(buckets - 1))
    return points.withColumn("bucket", bucket.cast("int")).groupBy("bucket").agg(
        F.max("return").alias("return"), F.max_by("volatility", "return").alias("volatility"), F.max_by("sharpe", "return").alias("sharpe"), F.count(F.lit(1)).alias("sets")
    )


def limit_weights(weights: DataFrame, limit: float, keys: Sequence[str] = ("portfolio",)) -> DataFrame:
    """Cap weights and give the excess to the uncapped ones in proportion, until nothing exceeds the cap.

    The uncapped weights keep their proportions, so the result is ``least(limit, w * c)`` with one factor c per
    portfolio. At most 1 / limit names can be capped: c follows from the total and the largest 1 / limit + 1 weights,
    a bounded list however large the portfolio is. Portfolios with fewer than 1 / limit members get null weights.
    """
    most = math.ceil(1 / limit) + 1
    totals = weights.groupBy(*keys).agg(F.sum("weight").alias("_t"), F.count(F.lit(1)).alias("_n"))
    top = ranking.top_n(weights.select(*keys, "symbol", "weight"), list(keys), [F.desc("weight"), F.asc("symbol")], most)
    top = top.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "weight"))), lambda x: x["weight"]).alias("_w"))
    first = lambda k: F.aggregate(F.slice("_w", 1, k), F.lit(0.0), lambda s, x: s + x)
    factor = lambda k: (F.col("_t") - k * limit) / (F.col("_t") - first(k))
    fits = lambda k: F.coalesce(F.get("_w", k) * factor(k), F.lit(0.0)) <= limit + 1e-15
    capped = F.get(F.filter(F.sequence(F.lit(0), F.lit(most)), fits), F.lit(0))
    scale = totals.join(top, list(keys)).withColumn("_k", capped).withColumn("_c", F.when(F.col("_t") - first(F.col("_k")) > 1e-15, factor(F.col("_k"))))
    rows = weights.join(scale.select(*keys, "_n", "_c"), list(keys))
    cut = F.when(F.col("_c").isNull(), limit).otherwise(F.least(F.lit(float(limit)), F.col("weight") * F.col("_c")))
    return rows.select(*keys, "symbol", F.when(F.col("_n") * limit >= 1 - 1e-12, cut).alias("weight"))


def rebalance_cost(weights: DataFrame, axis: Axis, cost: float = 0.001) -> DataFrame:
    """Turnover and cost per rebalance date from the weights of each symbol (axis key includes the symbol)."""
    rows = over_blocks(weights, axis, lambda w: {"_prev": F.lag("weight").over(w)}, back=1)
    date = axis.order[0]
    return rows.groupBy(date).agg(F.sum(F.abs(F.col("weight") - F.coalesce("_prev", F.lit(0.0)))).alias("turnover")).withColumn("cost", F.col("turnover") * cost)


def topk_dropout(scores: DataFrame, topk: int, drop: int, ts: str = "ts", score: str = "score", span: int = 86400 * 31) -> DataFrame:
    """Hold ``topk`` names; each date sell those among the ``drop`` worst of holdings plus best newcomers, buy as many.

    Only names that were ever among the best ``topk + drop`` can be held, so the others are left out before the dates
    are folded (time bucket by time bucket; the state is the list of held names).
    """
    keep = ranking.top_n(scores.select(ts, "symbol", score), [ts], [F.desc(score), F.asc("symbol")], topk + drop).select("symbol").distinct()
    rows = scores.select(ts, "symbol", score).join(keep, "symbol", "left_semi").withColumn("_k", F.lit(0))
    axis = Axis(key=("_k",), order=(ts, "symbol"), span=span)
    names = keep.withColumns({"_k": F.lit(0), "_h": F.pmod(F.xxhash64("symbol"), F.lit(2**20))})
    names = number(names, Axis(key=("_k",), order=("_h", "symbol"), span=1024), "_id").select("symbol", F.col("_id").cast("double").alias("_id"))
    rows = rows.join(names, "symbol")
    schema = T.StructType([scores.schema[ts], T.StructField("symbol", T.StringType()), T.StructField("action", T.StringType())])

    def run(part: pd.DataFrame, state):
        held = set(state or [])
        out = []
        for at, day in part.groupby(ts, sort=True):
            day = day.sort_values([score, "symbol"], ascending=[False, True])
            rank = list(day["_id"])
            name = dict(zip(day["_id"], day["symbol"]))
            last = [i for i in rank if i in held]
            gone = held - set(last)  # not quoted today: kept
            room = topk - len(held)
            fresh = [i for i in rank if i not in held][: drop + max(room, 0)]
            both = set(last) | set(fresh)
            worst = [i for i in rank if i in both][-drop:] if drop else []
            sold = [i for i in last if i in worst]
            bought = fresh[: len(sold) + max(room, 0)]
            out += [(at, name[i], "sell") for i in sold] + [(at, name[i], "buy") for i in bought]
            held = (set(last) - set(sold)) | set(bought) | gone
            out += [(at, name[i], "hold") for i in last if i not in sold]
        res = pd.DataFrame(out, columns=[ts, "symbol", "action"])
        res[ts] = pd.to_datetime(res[ts])
        return res, sorted(held)

    return fold(rows.select("_k", ts, "symbol", score, "_id"), axis, run, schema)
