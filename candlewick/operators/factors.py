"""Evaluation of cross-sectional factors: information coefficients, quantile portfolios, turnover, selection."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.functions.stats import t_p_value
from candlewick.operators import ranking
from candlewick.operators.series import DAILY, over_blocks, shared


def information_coefficients(
    panel: DataFrame, factor: str, ret: str, by: str = "ts", method: str = "pearson", at_least: int = 10
) -> DataFrame:
    """Correlation of factor and forward return per date, for dates with enough names."""
    rows = panel.filter(F.col(factor).isNotNull() & F.col(ret).isNotNull())
    x, y = factor, ret
    if method == "spearman":
        rows = shared(rows.select(by, factor, ret), by, factor, ret)  # ranks are joined back to the rows they come from
        rows = ranking.ranked(rows, [by], factor, "_rx").select(by, ret, "_rx")
        rows = ranking.ranked(shared(rows, by, ret, "_rx"), [by], ret, "_ry")
        x, y = "_rx", "_ry"
    out = rows.groupBy(by).agg(F.corr(x, y).alias("ic"), F.count(F.lit(1)).alias("names"))
    return out.filter(F.col("names") >= at_least)


def ic_summary(ic: DataFrame) -> DataFrame:
    """Mean, population deviation, ratio, hit rate, extremes and t statistic of the coefficients."""
    n = F.count("ic")
    sd = F.stddev_pop("ic")
    return ic.agg(
        F.avg("ic").alias("ic_mean"), sd.alias("ic_std"), F.when(sd > 0, F.avg("ic") / sd).otherwise(0.0).alias("icir"),
        (F.count_if(F.col("ic") > 0) / n).alias("hit_rate"), F.max("ic").alias("ic_max"), F.min("ic").alias("ic_min"),
        F.skewness("ic").alias("ic_skew"), F.kurtosis("ic").alias("ic_kurtosis"),
        (F.avg("ic") / (F.stddev_samp("ic") / F.sqrt(n))).alias("t_stat"), n.alias("dates"),
    )


def ic_significance(summary: DataFrame) -> DataFrame:
    """Two-sided p-value of a mean coefficient of zero; 1 with fewer than ten dates."""
    p = t_p_value(F.col("t_stat"), (F.col("dates") - 1).cast("double"))
    return summary.withColumn("p_value", F.when(F.col("dates") < 10, 1.0).otherwise(p))


def _bucket_means(panel: DataFrame, factor: str, ret: str, q: int, by: str) -> DataFrame:
    rows = panel.filter(F.col(factor).isNotNull() & F.col(ret).isNotNull())
    edges = ranking.quantile_edges(q)
    big = rows.groupBy(by).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= 5 * q).drop("_n")
    rows = ranking.with_quantiles(rows.join(big, by, "left_semi"), [by], factor, edges)
    rows = rows.withColumn("bucket", ranking.quantile_bucket(F.col(factor), q) + 1)
    return rows.groupBy(by, "bucket").agg(F.avg(ret).alias("mean_ret"))


def quantile_returns(panel: DataFrame, factor: str, ret: str, q: int = 5, by: str = "ts", year: int = 252) -> DataFrame:
    """Mean, deviation, Sharpe and win rate of equal-weight quantile portfolios; dates with at least 5q names."""
    means = _bucket_means(panel, factor, ret, q, by)
    x = F.col("mean_ret")
    sd = F.stddev_pop(x)
    return means.groupBy("bucket").agg(
        F.avg(x).alias("mean_return"), sd.alias("std_return"),
        F.when(sd > 0, F.avg(x) / sd * math.sqrt(year)).otherwise(0.0).alias("sharpe"),
        (F.count_if(x > 0) / F.count(x)).alias("win_rate"), F.count(x).alias("observations"),
    )


def long_short(panel: DataFrame, factor: str, ret: str, q: int = 5, by: str = "ts", year: int = 252) -> DataFrame:
    """First minus last quantile: mean, Sharpe, spread of means and share of falling steps between quantiles."""
    means = _bucket_means(panel, factor, ret, q, by)
    pairs = means.groupBy(by).agg(
        (F.max(F.when(F.col("bucket") == 1, F.col("mean_ret"))) - F.max(F.when(F.col("bucket") == q, F.col("mean_ret")))).alias("_ls")
    )
    sd = F.stddev_pop("_ls")
    first = pairs.agg(
        F.avg("_ls").alias("long_short_mean"),
        F.when(sd > 0, F.avg("_ls") / sd * math.sqrt(year)).otherwise(0.0).alias("long_short_sharpe"),
    )
    stats = means.groupBy("bucket").agg(F.avg("mean_ret").alias("m"))
    step = Window.partitionBy().orderBy("bucket")  # one row per quantile
    stats = stats.withColumn("_falls", (F.lag("m").over(step) > F.col("m")).cast("int"))
    second = stats.agg(
        (F.max(F.when(F.col("bucket") == 1, F.col("m"))) - F.max(F.when(F.col("bucket") == q, F.col("m")))).alias("spread"),
        (F.sum("_falls") / F.count("_falls")).alias("monotonicity"),
    )
    return first.crossJoin(second)  # one row each


def membership_turnover(panel: DataFrame, factor: str, n: int, by: str = "ts", tie: str = "symbol") -> DataFrame:
    """Share of the top ``n`` that changed against the previous date (symmetric difference / n)."""
    top = ranking.top_n(panel.filter(F.col(factor).isNotNull()).select(by, tie, factor), [by], [F.desc(factor), F.col(tie)], n)
    sets = top.groupBy(by).agg(F.collect_set(tie).alias("_now"))  # at most n members
    dates = panel.select(by).distinct()
    sets = dates.join(sets, by, "left")
    rows = over_blocks(sets.withColumn("_k", F.lit(0)), DAILY.by(key=("_k",), order=(by,)), lambda w: {"_prev": F.lag("_now").over(w)}, back=1)
    change = F.size(F.array_except("_now", "_prev")) + F.size(F.array_except("_prev", "_now"))
    return rows.filter(F.col("_prev").isNotNull() & F.col("_now").isNotNull()).select(by, (change / n).alias("turnover"))


def turnover_summary(turnover: DataFrame) -> DataFrame:
    return turnover.agg(
        F.avg("turnover").alias("mean"), F.stddev_pop("turnover").alias("std"), F.max("turnover").alias("max"),
        F.min("turnover").alias("min"), F.count("turnover").alias("observations"),
    )


def select_features(df: DataFrame, features: Sequence[str], target: str, k: int = 10, method: str = "pearson", at_least: int = 10) -> DataFrame:
    """The ``k`` features with the largest absolute correlation with the target."""
    long = df.unpivot([target], [F.col(f).cast("double").alias(f) for f in features], "feature", "value")
    long = long.filter(F.col("value").isNotNull() & F.col(target).isNotNull())
    x, y = "value", target
    if method == "spearman":
        long = ranking.ranked(long, ["feature"], "value", "_rx")
        long = ranking.ranked(long, ["feature"], target, "_ry")
        x, y = "_rx", "_ry"
    ic = long.groupBy("feature").agg(F.abs(F.corr(x, y)).alias("abs_ic"), F.count(F.lit(1)).alias("n"))
    return ic.filter(F.col("n") >= at_least).orderBy(F.desc("abs_ic"), "feature").limit(k)


def combine(factors: Mapping[str, Column | str], weights: Mapping[str, float] | None = None) -> Column:
    """Weighted sum of factor columns; a missing weight is 1/n, no weights mean the plain average."""
    n = len(factors)
    out = F.lit(0.0)
    for name, c in factors.items():
        col = F.col(c) if isinstance(c, str) else c
        out = out + col * F.lit(float((weights or {}).get(name, 1.0 / n)))
    return out
