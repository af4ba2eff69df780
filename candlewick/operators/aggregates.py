"""Group statistics: descriptive, calendar, decile, trade, index and deal summaries."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.functions.scalars import clamp
from candlewick.functions.stats import t_p_value
from candlewick.operators import ranking
from candlewick.operators.series import POS, Axis, added, full, over_blocks, stretch, trailing, whole_by
from candlewick.operators.windows import adjusted_kurtosis, adjusted_skew


def describe(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Mean, std, var, count, sum, product, extremes, range, median and mode per group.

    Median and mode come from value counts, so no group has to fit one task.
    """
    x = F.col(value)
    base = df.groupBy(*keys).agg(
        F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"), F.var_samp(x).alias("var"), F.count(x).alias("count"),
        F.sum(x).alias("sum"), F.product(x).alias("product"), F.min(x).alias("min"), F.max(x).alias("max"),
        (F.max(x) - F.min(x)).alias("range"),
    )
    counts = df.filter(x.isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    mode = counts.groupBy(*keys).agg(F.max_by(value, F.struct("_n", -x)).alias("mode"))
    median = ranking.quantiles(df, keys, value, {"median": 0.5})
    return base.join(median, list(keys), "left").join(mode, list(keys), "left")


# Percentiles of the standard report.
PERCENTILES = (1, 5, 10, 25, 50, 75, 90, 95, 99)


def percentiles(df: DataFrame, keys: Sequence[str], value: str, at: Sequence[float] = PERCENTILES) -> DataFrame:
    """Exact percentiles with linear interpolation, in long form."""
    names = {f"p{str(p).replace('.', '_')}": p / 100 for p in at}
    wide = ranking.quantiles(df, keys, value, names)
    long = wide.unpivot(list(keys), list(names), "_p", value)
    table = F.create_map(*[F.lit(v) for n, p in zip(names, at) for v in (n, float(p))])
    return long.withColumn("percentile", table[F.col("_p")]).drop("_p")


def percentile_of_score(df: DataFrame, keys: Sequence[str], value: str, score: float) -> DataFrame:
    """Percentile rank of a score: mean of the strict and the weak share when the score occurs."""
    x, n = F.col(value), F.count(value)
    left, right = F.count_if(x < score), F.count_if(x <= score)
    hit = F.when(left < right, 1).otherwise(0)
    return df.groupBy(*keys).agg(((left + right + hit) * 50.0 / n).alias("percentile"))


def moments(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Bias-adjusted skewness and excess kurtosis."""
    n = F.count(value)
    return df.groupBy(*keys).agg(
        adjusted_skew(F.skewness(value), n).alias("skew"), adjusted_kurtosis(F.kurtosis(value), n).alias("kurtosis")
    )


def pair_summary(df: DataFrame, keys: Sequence[str], x: str, y: str) -> DataFrame:
    """Covariance, correlation, beta (x on y) and R²."""
    var = F.var_samp(F.when(F.col(x).isNotNull(), F.col(y)))
    cov, corr = F.covar_samp(x, y), F.corr(x, y)
    return df.groupBy(*keys).agg(
        cov.alias("cov"), corr.alias("corr"), F.when(var != 0, cov / var).otherwise(0.0).alias("beta"),
        (corr * corr).alias("r2"),
    )


def downside(df: DataFrame, keys: Sequence[str], value: str, threshold: float = 0.0) -> DataFrame:
    """Variance of the values below a threshold (0 below two of them) and realised variance."""
    x = F.col(value)
    below = F.when(x < threshold, x)
    return df.groupBy(*keys).agg(
        F.when(F.count(below) > 1, F.var_samp(below)).otherwise(0.0).alias("semi_variance"),
        F.sum(x * x).alias("realized_variance"),
    )


def winsorize(df: DataFrame, keys: Sequence[str], value: str, lower: float = 0.01, upper: float = 0.99) -> DataFrame:
    rows = ranking.with_quantiles(df, keys, value, {"_lo": lower, "_hi": upper})
    x = clamp(F.col(value), F.col("_lo"), F.col("_hi"))
    return rows.withColumn("winsorized", x).drop("_lo", "_hi")


def compound(x: str) -> Column:
    return F.exp(F.sum(F.log1p(F.col(x)))) - 1


def monthly_returns(df: DataFrame, keys: Sequence[str], ts: str, ret: str) -> DataFrame:
    """Year by month table of compounded returns with the year's total."""
    year = F.year(ts).alias("year")
    cells = [
        F.when(F.count(F.when(F.month(ts) == m, F.col(ret))) > 0, F.exp(F.sum(F.when(F.month(ts) == m, F.log1p(ret)))) - 1).alias(f"m{m:02d}")
        for m in range(1, 13)
    ]
    return df.groupBy(*keys, year).agg(*cells, compound(ret).alias("total"))


def pooled_t(m1: Column, v1: Column, n1: Column, m2: Column, v2: Column, n2: Column) -> Column:
    pooled = ((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2)
    return (m1 - m2) / F.sqrt(pooled * (1 / n1 + 1 / n2))


def calendar_effects(df: DataFrame, ts: str, ret: str) -> DataFrame:
    """Mean return and t statistic by weekday (more than 10 values) and by month (more than 5)."""
    stats = lambda d, k, kind: d.groupBy(k.alias("part")).agg(
        F.avg(ret).alias("mean_return"),
        (F.avg(ret) / (F.stddev_samp(ret) / F.sqrt(F.count(ret)))).alias("t_stat"),
        F.count(ret).alias("n"),
    ).withColumn("effect", F.lit(kind))
    days = stats(df, F.weekday(ts), "weekday").filter("part < 5 AND n > 10")
    months = stats(df, F.month(ts), "month").filter("n > 5")
    return days.unionByName(months)


def two_groups(df: DataFrame, ret: str, first: Column, second: Column, keys: Sequence[str] = ()) -> DataFrame:
    """Means of two row sets, their difference and the pooled two-sample t."""
    a, b = F.when(first, F.col(ret)), F.when(second, F.col(ret))
    out = df.groupBy(*keys).agg(
        F.avg(a).alias("mean_first"), F.avg(b).alias("mean_second"), F.var_samp(a).alias("_v1"), F.var_samp(b).alias("_v2"),
        F.count(a).alias("n_first"), F.count(b).alias("n_second"),
    )
    t = pooled_t(F.col("mean_first"), F.col("_v1"), F.col("n_first"), F.col("mean_second"), F.col("_v2"), F.col("n_second"))
    return out.withColumns({"difference": F.col("mean_first") - F.col("mean_second"), "t_stat": t}).drop("_v1", "_v2")


def with_p_value(df: DataFrame, t: str, freedom: Column) -> DataFrame:
    return df.withColumn("p_value", t_p_value(F.col(t), freedom.cast("double")))


def january_effect(df: DataFrame, ts: str, ret: str) -> DataFrame:
    return two_groups(df, ret, F.month(ts) == 1, F.month(ts) != 1)


def decile_performance(df: DataFrame, by: str, ret: str, bins: int = 10, at_least: int = 20) -> DataFrame:
    """Mean, deviation and ratio of returns per quantile bucket (1 = lowest) of ``by`` over the whole panel."""
    edges = ranking.quantile_edges(bins)
    rows = ranking.with_quantiles(df.filter(F.col(by).isNotNull() & F.col(ret).isNotNull()), [], by, edges)
    rows = rows.withColumn("decile", ranking.quantile_bucket(F.col(by), bins) + 1)
    sd = F.stddev_samp(ret)
    return rows.groupBy("decile").agg(
        F.avg(ret).alias("mean_return"), sd.alias("volatility"),
        F.when(sd > 0, F.avg(ret) / sd).otherwise(0.0).alias("sharpe"), F.count(ret).alias("n"),
    ).filter(F.col("n") > at_least)


def momentum_panel(df: DataFrame, axis: Axis, ret: str = "ret", lookback: int = 252, skip: int = 21) -> DataFrame:
    """Past return without the last ``skip`` bars, and the return of the next ``skip`` bars."""

    parts, rest = divmod(lookback - skip, skip)

    def sums(w):
        return {"_s": F.sum("_l").over(trailing(w, skip)), "_c": F.count("_l").over(trailing(w, skip))}

    def cols(w):
        past = stretch("_s", w, skip, parts, skip)
        if rest:
            past.append(F.sum("_l").over(w.rowsBetween(-(lookback - 1), -(lookback - rest))))
        return {
            "momentum": F.when(F.col(POS) >= lookback, F.exp(added(past)) - 1),  # every row has a return
            "future_return": F.when(F.lead("_c", skip).over(w) == skip, F.exp(F.lead("_s", skip).over(w)) - 1),
        }

    rows = df.filter(F.col(ret).isNotNull()).withColumn("_l", F.log1p(ret))
    out = over_blocks(rows, axis, [sums, cols], back=lookback - 1, ahead=skip).drop("_l", "_s", "_c")
    return out.dropna(subset=["momentum", "future_return"])


def trade_statistics(trades: DataFrame, keys: Sequence[str], pnl: str = "pnl", bars: str | None = "bars_held") -> DataFrame:
    """Totals, wins, losses, extremes, win rate, profit factor (999.99 without losses) and average holding time."""
    x = F.col(pnl)
    gain, loss = F.sum(F.when(x > 0, x).otherwise(0.0)), F.abs(F.sum(F.when(x <= 0, x).otherwise(0.0)))
    n = F.count(F.lit(1))
    aggs = [
        F.coalesce(F.sum(x), F.lit(0.0)).alias("total_pnl"), n.alias("trades"), F.count_if(x > 0).alias("wins"),
        F.count_if(x < 0).alias("losses"), F.max(x).alias("largest_win"), F.min(x).alias("largest_loss"),
        (F.count_if(x > 0) / n * 100).alias("win_rate"), F.avg(x).alias("avg_pnl"),
        F.when(loss > 0, gain / loss).when(gain > 0, 999.99).otherwise(0.0).alias("profit_factor"),
    ]
    if bars:
        aggs.append(F.avg(bars).alias("avg_bars_held"))
    return trades.groupBy(*keys).agg(*aggs)


def concentration(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Herfindahl index, effective number, top-3 / top-5 share and distance from equal weights per group."""
    rows = whole_by(df, keys, {"_total": F.sum(value), "_n": F.count(F.lit(1))})
    rows = rows.withColumn("_w", F.col(value) / F.col("_total"))
    base = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("holdings"), F.sum(value).alias("total_value"), F.sum(F.col("_w") * F.col("_w")).alias("hhi"),
        F.max(F.abs(F.col("_w") - 1 / F.col("_n"))).alias("max_deviation"),
    )
    top = ranking.top_n(rows.select(*keys, "_w"), keys, [F.desc("_w")], 5)
    top = top.groupBy(*keys).agg(
        F.sum(F.when(F.col("rank") <= 3, F.col("_w"))).alias("top_3"), F.sum("_w").alias("top_5")
    )
    out = base.join(top, list(keys))
    return out.withColumns({"effective_n": F.when(F.col("hhi") > 0, 1 / F.col("hhi")), "concentrated": F.col("hhi") > 0.25})


def tax_report(holdings: DataFrame, keys: Sequence[str], short_rate: float = 0.22) -> DataFrame:
    """Unrealised gains, loss-harvest candidates and estimated tax; all gains count as short-term."""
    cost, market = F.col("quantity") * F.col("avg_price"), F.col("quantity") * F.coalesce("current_price", "avg_price")
    gain = market - cost
    out = holdings.groupBy(*keys).agg(
        F.sum(cost).alias("cost_basis"), F.sum(market).alias("market_value"), F.sum(gain).alias("unrealized_gain"),
        F.sum(F.when(gain > 0, gain).otherwise(0.0)).alias("short_term_gains"),
        F.sum(F.when(gain <= 0, gain).otherwise(0.0)).alias("harvestable_loss"),
        F.count_if(gain <= 0).alias("loss_positions"), F.count(F.lit(1)).alias("positions"),
    )
    return out.withColumns(
        {
            "gain_pct": F.when(F.col("cost_basis") > 0, F.col("unrealized_gain") / F.col("cost_basis") * 100).otherwise(0.0),
            "estimated_tax": F.col("short_term_gains") * short_rate,
            "tax_savings": F.abs("harvestable_loss") * short_rate,
        }
    )


# --- indexes -----------------------------------------------------------------------------------------------------


def index_weights(constituents: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Price, market-cap, equal, float-adjusted and fundamental weights (the last by market cap)."""
    floated = F.col("float_shares") * F.col("price")
    rows = constituents.withColumn("_float", floated)
    rows = whole_by(rows, keys, {"_p": F.sum("price"), "_c": F.sum("market_cap"), "_n": F.count(F.lit(1)), "_f": F.sum("_float")})
    return rows.withColumns(
        {
            "w_price": F.col("price") / F.col("_p"), "w_cap": F.col("market_cap") / F.col("_c"), "w_equal": 1 / F.col("_n"),
            "w_float": F.col("_float") / F.col("_f"), "w_fundamental": F.col("market_cap") / F.col("_c"),
        }
    ).drop("_p", "_c", "_n", "_f", "_float")


def index_levels(prices: DataFrame, base: DataFrame, keys: Sequence[str], base_value: float = 100.0, divisor: float = 1.0) -> DataFrame:
    """Index level per date against base prices for each weighting.

    ``prices``: keys + symbol, price; ``base``: symbol, base_price, shares, float_shares.
    """
    rows = prices.join(base, "symbol")
    ratio = F.when(F.col("base_price") > 0, F.col("price") / F.col("base_price"))

    def cap(shares: str) -> Column:
        now, then = F.sum(F.col(shares) * F.col("price")), F.sum(F.col(shares) * F.col("base_price"))
        return F.when(then > 0, base_value * now / then).otherwise(base_value)

    return rows.groupBy(*keys).agg(
        (base_value * (F.sum("price") / F.sum("base_price")) / divisor).alias("price_weighted"),
        cap("shares").alias("cap_weighted"), cap("float_shares").alias("float_weighted"),
        (base_value * F.avg(ratio)).alias("equal_weighted"),
    )


def index_composition(weighted: DataFrame, keys: Sequence[str], weight: str, dividend_yield: str) -> DataFrame:
    """Dividend yield, concentration and top-5 / top-10 share of an index."""
    base = weighted.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("constituents"), F.sum(F.col(weight) * F.col(weight)).alias("hhi"),
        F.sum(F.col(weight) * F.coalesce(F.col(dividend_yield), F.lit(0.0))).alias("dividend_yield"),
    )
    top = ranking.top_n(weighted.select(*keys, weight), keys, [F.desc(weight)], 10)
    top = top.groupBy(*keys).agg(F.sum(F.when(F.col("rank") <= 5, F.col(weight))).alias("top_5"), F.sum(weight).alias("top_10"))
    return base.join(top, list(keys)).withColumn("effective_n", F.when(F.col("hhi") > 0, 1 / F.col("hhi")))


def sector_allocation(weighted: DataFrame, keys: Sequence[str], weight: str) -> DataFrame:
    return weighted.groupBy(*keys, "sector").agg(F.sum(weight).alias("weight"))


def rebalance_needs(current: DataFrame, target: DataFrame, keys: Sequence[str], tolerance: float = 0.05) -> DataFrame:
    """Weight adjustment per symbol; additions and deletions have no current / target weight."""
    both = current.join(target, [*keys, "symbol"], "full")
    gap = F.col("target_weight") - F.col("weight")
    kind = F.when(F.col("weight").isNull(), "addition").when(F.col("target_weight").isNull(), "deletion").otherwise("kept")
    return both.withColumns({"adjustment": gap, "change": kind, "beyond_tolerance": F.coalesce(F.abs(gap) > tolerance, F.lit(False))})


def needs_rebalancing(needs: DataFrame, keys: Sequence[str]) -> DataFrame:
    return needs.groupBy(*keys).agg(
        F.max(F.abs("adjustment")).alias("max_drift"), F.bool_or("beyond_tolerance").alias("needs_rebalancing"),
        F.count_if(F.col("change") == "addition").alias("additions"), F.count_if(F.col("change") == "deletion").alias("deletions"),
    )


# --- deals -------------------------------------------------------------------------------------------------------


def industry_stats(deals: DataFrame, start: str, end: str) -> DataFrame:
    """Count, value and mean premiums of the deals of each industry announced in a date range."""
    rows = deals.filter(
        F.col("announcement_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")) & F.col("deal_value").isNotNull()
    )
    return rows.groupBy("industry").agg(
        F.count(F.lit(1)).alias("deal_count"), F.sum("deal_value").alias("total_value"), F.avg("deal_value").alias("avg_value"),
        F.avg("premium_1day").alias("avg_premium_1day"), F.avg("premium_4week").alias("avg_premium_4week"),
    )


def spread_statistics(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Min, max, mean and median of several columns, in long form."""
    long = df.unpivot(list(keys), [F.col(c).cast("double").alias(c) for c in columns], "metric", "value")
    base = long.groupBy(*keys, "metric").agg(F.min("value").alias("min"), F.max("value").alias("max"), F.avg("value").alias("mean"))
    return base.join(ranking.quantiles(long, [*keys, "metric"], "value", {"median": 0.5}), [*keys, "metric"], "left")


def rank_deals(deals: DataFrame, criterion: str, keys: Sequence[str] = ()) -> DataFrame:
    """Rank by a metric, highest first; a missing metric counts as 0, ties keep the deal id order."""
    rows = deals.withColumn("metric_value", F.coalesce(F.col(criterion).cast("double"), F.lit(0.0)))
    rows = ranking.with_positions(rows, keys, "metric_value")
    lower = F.col(ranking.SIZE) - F.col(ranking.BELOW) - F.col(ranking.SAME)
    rows = ranking.ordinals(rows, keys, "metric_value", ["deal_id"], "_place")
    return rows.withColumn("rank", lower + F.col("_place")).drop("_place", ranking.BELOW, ranking.SAME, ranking.SIZE)


def payment_structure(deals: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    cash, stock, n = F.count_if(F.col("cash_pct") == 100), F.count_if(F.col("stock_pct") == 100), F.count(F.lit(1))
    return deals.groupBy(*keys).agg(
        n.alias("total"), cash.alias("all_cash"), stock.alias("all_stock"), (n - cash - stock).alias("mixed"),
        F.avg("cash_pct").alias("avg_cash_pct"), F.avg("stock_pct").alias("avg_stock_pct"),
        (cash / n * 100).alias("all_cash_share"), (stock / n * 100).alias("all_stock_share"),
    )


def premium_position(deals: DataFrame, peers: Sequence[str], premium: str) -> DataFrame:
    """Where the premium of each deal lies among the quartiles of its peers."""
    rows = ranking.with_quantiles(deals, peers, premium, {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    x = F.col(premium)
    label = (
        F.when(x < F.col("p25"), "below 25th percentile").when(x < F.col("p50"), "between 25th and 50th percentile")
        .when(x < F.col("p75"), "between 50th and 75th percentile").otherwise("above 75th percentile")
    )
    return rows.withColumns({"position": label, "above_median": x > F.col("p50")})


def synergy_share(deals: DataFrame, keys: Sequence[str]) -> DataFrame:
    rows = deals.filter(F.col("synergies").isNotNull()).withColumn("synergy_pct", F.col("synergies") / F.col("deal_value") * 100)
    out = spread_statistics(rows, keys, ["synergies", "synergy_pct"])
    return out.join(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("deals"), F.sum("synergies").alias("total_synergies")), list(keys))


def multiple_statistics(df: DataFrame, keys: Sequence[str], multiples: Sequence[str], weight: str) -> DataFrame:
    """Mean, median, harmonic and weighted harmonic mean, quartiles, extremes, std and count of positive multiples.

    The weight stays on the row of its multiple.
    """
    long = df.unpivot([*keys, weight], [F.col(c).cast("double").alias(c) for c in multiples], "multiple", "value")
    long = long.filter((F.col("value") > 0) & ~F.isnan("value") & (F.col("value") < float("inf")))
    by, v, w = [*keys, "multiple"], F.col("value"), F.col(weight)
    base = long.groupBy(*by).agg(
        F.avg(v).alias("mean"), (F.count(v) / F.sum(1 / v)).alias("harmonic_mean"),
        (F.sum(w) / F.sum(w / v)).alias("weighted_harmonic_mean"), F.min(v).alias("min"), F.max(v).alias("max"),
        F.coalesce(F.stddev_samp(v), F.lit(0.0)).alias("std"), F.count(v).alias("count"),
    )
    q = ranking.quantiles(long, by, "value", {"q1": 0.25, "median": 0.5, "q3": 0.75})
    return base.join(q, by)


# --- factor regressions ------------------------------------------------------------------------------------------


def weighted_sum(weights: Mapping[str, float]) -> Column:
    """Σ weight · column."""
    out = F.lit(0.0)
    for c, w in weights.items():
        out = out + F.lit(float(w)) * F.col(c)
    return out


def factor_exposure(df: DataFrame, keys: Sequence[str], ret: str, factors: Sequence[str]) -> DataFrame:
    """Beta to each factor on its own, and its share of the variance of the returns."""
    aggs = [F.var_samp(ret).alias("_total")]
    for f in factors:
        var = F.var_samp(f)
        aggs += [F.when(var != 0, F.covar_samp(ret, f) / var).otherwise(0.0).alias(f"beta_{f}"), var.alias(f"_var_{f}")]
    out = df.groupBy(*keys).agg(*aggs)
    shares = {
        f"share_{f}": F.when(F.col("_total") != 0, F.col(f"beta_{f}") ** 2 * F.col(f"_var_{f}") / F.col("_total")).otherwise(0.0)
        for f in factors
    }
    out = out.withColumns(shares)
    rest = F.lit(1.0)
    for f in factors:
        rest = rest - F.col(f"share_{f}")
    return out.withColumn("share_unexplained", rest).drop("_total", *[f"_var_{f}" for f in factors])


def factor_pnl(df: DataFrame, keys: Sequence[str], ret: str, factors: Sequence[str], initial: float = 1.0) -> DataFrame:
    """P&L of each row split into beta times factor return and the rest."""
    exposure = factor_exposure(df, keys, ret, factors).select(*keys, *[f"beta_{f}" for f in factors])
    rows = df.join(exposure, list(keys))
    parts = {f"pnl_{f}": F.col(f"beta_{f}") * F.coalesce(F.col(f), F.lit(0.0)) * initial for f in factors}
    rows = rows.withColumns(parts)
    explained = F.lit(0.0)
    for f in factors:
        explained = explained + F.col(f"pnl_{f}")
    rows = rows.withColumns({"total_pnl": F.col(ret) * initial, "explained": explained})
    return rows.withColumn("unexplained", F.col("total_pnl") - F.col("explained")).drop(*[f"beta_{f}" for f in factors])


def ols(df: DataFrame, keys: Sequence[str], y: str, xs: Sequence[str], constant: bool = True) -> DataFrame:
    """Least squares per group: coefficient, standard error, t and the fit in long form.

    The rows are reduced to cross products in Spark; each group then solves a system of the size of its columns.
    """
    rows = df.dropna(subset=[y, *xs])
    terms = (["const"] if constant else []) + list(xs)
    col = {t: F.lit(1.0) if t == "const" else F.col(t).cast("double") for t in terms}
    aggs = [F.sum(col[a] * col[b]).alias(f"xx_{i}_{j}") for i, a in enumerate(terms) for j, b in enumerate(terms) if i <= j]
    aggs += [F.sum(col[a] * F.col(y)).alias(f"xy_{i}") for i, a in enumerate(terms)]
    aggs += [F.sum(F.col(y) * F.col(y)).alias("yy"), F.sum(F.col(y).cast("double")).alias("sy"), F.count(F.lit(1)).alias("n")]
    key_fields = [df.schema[k] for k in keys]
    schema = T.StructType(
        [*key_fields, T.StructField("term", T.StringType())]
        + [T.StructField(c, T.DoubleType()) for c in ("coef", "std_err", "t", "r2", "r2_adj")]
        + [T.StructField("n", T.LongType())]
    )

    def solve(batches):
        k = len(terms)
        for part in batches:
            out = []
            for row in part.to_dict("records"):
                xx = np.zeros((k, k))
                for i in range(k):
                    for j in range(i, k):
                        xx[i, j] = xx[j, i] = row[f"xx_{i}_{j}"]
                xy = np.array([row[f"xy_{i}"] for i in range(k)])
                n = int(row["n"])
                if n <= k or np.linalg.matrix_rank(xx) < k:
                    continue
                beta = np.linalg.solve(xx, xy)
                rss = max(row["yy"] - float(beta @ xy), 0.0)
                tss = row["yy"] - row["sy"] ** 2 / n if constant else row["yy"]
                err = np.sqrt(rss / (n - k) * np.diag(np.linalg.inv(xx)))
                r2 = 1 - rss / tss if tss > 0 else None
                adj = None if r2 is None else 1 - (1 - r2) * (n - (1 if constant else 0)) / (n - k)
                for t, b, e in zip(terms, beta, err):
                    out.append({**{q: row[q] for q in keys}, "term": t, "coef": b, "std_err": e, "t": b / e if e > 0 else None, "r2": r2, "r2_adj": adj, "n": n})
            yield pd.DataFrame(out, columns=schema.names)

    return rows.groupBy(*keys).agg(*aggs).mapInPandas(solve, schema)


def histogram(df: DataFrame, value: str, low: float, high: float, bins: int) -> DataFrame:
    """Counts of equal-width bins; the last bin includes its upper end."""
    x = F.col(value)
    rows = df.filter(x.between(low, high))
    b = F.least(F.floor((x - low) / ((high - low) / bins)), F.lit(bins - 1))
    return rows.groupBy(b.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n")).withColumn(
        "start", F.lit(low) + F.col("bin") * F.lit((high - low) / bins)
    )


def snapshot_metrics(rows: DataFrame, keys: Sequence[str], value: str, ret: str, drawdown: str, bench: str, rf: float = 0.0, year: int = 252) -> DataFrame:
    """Volatility, Sharpe, drawdown, beta, historical VaR / CVaR 95 and a 0-100 risk score per portfolio.

    ``rows`` holds value, return and drawdown (fractions) per portfolio and time, and the benchmark return.
    """
    x = F.col(ret)
    stats = rows.groupBy(*keys).agg(
        F.avg(x).alias("_m"), F.stddev_samp(x).alias("_s"), F.count(x).alias("n"), F.min(drawdown).alias("max_drawdown"),
        F.when(F.var_samp(bench) > 1e-10, F.covar_samp(ret, bench) / F.var_samp(F.when(x.isNotNull(), F.col(bench)))).alias("beta"),
        F.max_by(value, F.struct("ts")).alias("last_value"),
    )
    pos = ranking.value_positions(rows, keys, ret)
    tail = F.greatest(F.floor(F.col(ranking.SIZE) * 0.05), F.lit(1))
    taken = F.greatest(F.least(F.col(ranking.BELOW) + F.col(ranking.SAME), tail) - F.col(ranking.BELOW), F.lit(0))
    tails = pos.groupBy(*keys).agg(
        F.max(F.when((F.col(ranking.BELOW) < tail), x)).alias("_cut"), (F.sum(taken * x) / F.max(tail)).alias("_mean_tail")
    )
    out = stats.join(tails, list(keys))
    vol = F.col("_s") * math.sqrt(year)
    out = out.withColumns(
        {
            "volatility": vol,
            "sharpe": F.when(F.col("_s") > 1e-8, (F.col("_m") - rf / year) / F.col("_s") * math.sqrt(year)),
            "var_95": F.col("last_value") * F.greatest(-F.col("_cut"), F.lit(0.0)),
            "cvar_95": F.col("last_value") * F.greatest(-F.col("_mean_tail"), F.lit(0.0)),
        }
    )
    return out.drop("_m", "_s", "_cut", "_mean_tail")


def risk_score(concentration_pct: Column, volatility_pct: Column, drawdown_pct: Column, beta: Column) -> Column:
    """Composite 0-100: volatility up to 30, top-3 concentration 25, drawdown 25, beta 20 points."""
    cap = lambda x, top, points: F.least(x / top, F.lit(1.0)) * points
    return (
        cap(volatility_pct, 40.0, 30.0) + cap(concentration_pct, 80.0, 25.0) + cap(F.abs(drawdown_pct), 50.0, 25.0)
        + cap(F.abs(F.coalesce(beta, F.lit(1.0))), 2.0, 20.0)
    )
