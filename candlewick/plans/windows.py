"""Rolling, running and cross-sectional queries."""

from pyspark.sql import functions as F

from candlewick import fixtures as fx
from candlewick.functions.stats import normal_cdf_sql
from candlewick.operators import windows as ops
from candlewick.operators.series import DAILY, HOURLY, over_blocks
from candlewick.plans.registry import near, query, r, rs
from candlewick.plans.sql import DAILY as DAILY_SQL
from candlewick.plans.sql import HOURLY as HOURLY_SQL
from candlewick.plans.sql import NUMBERED, RETURNS, with_

W = "PARTITION BY symbol ORDER BY ts"


def wn(n):
    return f"({W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def returns(spark, sf, daily=False, closes=False, keep_pos=False):
    """Bars (``closes``: their closes alone) with their simple return; the first bar of a symbol has none."""
    bars = fx.daily(spark, sf) if daily else fx.hourly(spark, sf)
    bars = bars.select("symbol", "ts", "close") if closes else bars
    return over_blocks(bars, DAILY if daily else HOURLY, lambda w: {"ret": ops.pct_change(w)}, back=1, keep_pos=keep_pos)


FEAT = ["returns", "log_returns", "sma_20", "sma_50", "sma_200", "bb_middle", "bb_std", "bb_upper", "bb_lower",
        "volatility_10", "volatility_20", "volatility_30"]


@query(
    "pipeline_features",
    "W1,W2,W3,W4,W5",
    with_(
        HOURLY_SQL,
        f"""a AS (SELECT *, lag(close) OVER ({W}) AS p FROM bars),
b AS (SELECT symbol, ts, close, CASE WHEN p > 0 THEN (close - p) / p ELSE 0 END AS returns, ln(close / p) AS log_returns FROM a),
c AS (SELECT *, {', '.join(f'avg(close) OVER {wn(n)} AS sma_{n}' for n in (20, 50, 200))},
  avg(close) OVER {wn(20)} AS bb_middle, stddev_samp(close) OVER {wn(20)} AS bb_std,
  {', '.join(f'stddev_samp(returns) OVER {wn(n)} AS volatility_{n}' for n in (10, 20, 30))} FROM b),
d AS (SELECT *, bb_middle + 2 * bb_std AS bb_upper, bb_middle - 2 * bb_std AS bb_lower FROM c)""",
        f"SELECT symbol, ts, {rs(*FEAT)} FROM d",
    ),
)
def pipeline_features(spark, sf):
    return near(ops.pipeline_features(fx.hourly(spark, sf)), *FEAT).select("symbol", "ts", *FEAT)


@query(
    "lag_lead",
    "W6",
    with_(
        HOURLY_SQL,
        f"x AS (SELECT symbol, ts, close, lag(close, 1) OVER ({W}) AS lag_1, lag(close, 3) OVER ({W}) AS lag_3, lead(close, 2) OVER ({W}) AS lead_2 FROM bars)",
        "SELECT * FROM x WHERE lag_3 IS NOT NULL AND lead_2 IS NOT NULL",
    ),
)
def lag_lead(spark, sf):
    return ops.lags(fx.hourly(spark, sf).select("symbol", "ts", "close"), HOURLY, "close", [1, 3], [2])


@query(
    "differences",
    "W7",
    with_(
        HOURLY_SQL,
        f"""x AS (SELECT symbol, ts, close - lag(close, 5) OVER ({W}) AS change, close - 2 * lag(close) OVER ({W}) + lag(close, 2) OVER ({W}) AS diff_2,
  close / lag(close) OVER ({W}) - 1 AS simple_return, ln(close / lag(close) OVER ({W})) AS log_return, close - lag(close) OVER ({W}) AS abs_return FROM bars)""",
        f"SELECT symbol, ts, {rs('change', 'diff_2', 'simple_return', 'log_return', 'abs_return')} FROM x",
    ),
)
def differences(spark, sf):
    names = ["change", "diff_2", "simple_return", "log_return", "abs_return"]
    out = ops.changes(fx.hourly(spark, sf).select("symbol", "ts", "close"), HOURLY, "close", 5, 2)
    return near(out, *names).drop("close")


_ROLL = {
    "mean": "avg(close)", "std": "stddev_samp(close)", "var": "var_samp(close)", "min": "min(close)", "max": "max(close)",
    "sum": "sum(close)", "count": "count(close)", "median": "quantile_cont(close, 0.5)",
    "percentile": "quantile_cont(close, 0.9)", "skew": "skewness(close)", "kurtosis": "kurtosis(close)",
}


@query(
    "rolling_statistics",
    "W8",
    with_(
        HOURLY_SQL,
        f"""x AS (SELECT symbol, ts, {', '.join(f'{e} OVER {wn(20)} AS {k}_20' for k, e in _ROLL.items())},
  max(close) OVER {wn(20)} - min(close) OVER {wn(20)} AS range_20 FROM bars)""",
        f"SELECT symbol, ts, count_20, {rs(*[f'{k}_20' for k in _ROLL if k not in ('count', 'skew', 'kurtosis')], 'range_20')}, {rs('skew_20', 'kurtosis_20', digits=5)} FROM x WHERE count_20 = 20",
    ),
)
def rolling_statistics(spark, sf):
    stats = [*_ROLL, "range"]
    out = ops.rolling(fx.hourly(spark, sf).select("symbol", "ts", "close"), HOURLY, "close", 20, stats)
    out = near(out, *[f"{s}_20" for s in stats if s not in ("count", "skew", "kurtosis")])
    return near(out, "skew_20", "kurtosis_20", digits=5).drop("close")


@query(
    "rolling_product",
    "W8",
    with_(
        HOURLY_SQL,
        RETURNS,
        f"x AS (SELECT symbol, ts, product(1 + ret) OVER {wn(10)} AS product_10, count(ret) OVER {wn(10)} AS n FROM rets)",
        f"SELECT symbol, ts, {rs('product_10', digits=5)} FROM x WHERE n = 10",
    ),
)
def rolling_product(spark, sf):
    rows = returns(spark, sf).select("symbol", "ts", (F.col("ret") + 1).alias("g"))
    return near(ops.rolling(rows, HOURLY, "g", 10, ["product"]), "product_10", digits=5).drop("g")


@query(
    "rolling_30_days",
    "W9",
    with_(
        DAILY_SQL,
        """x AS (SELECT symbol, ts, avg(close) OVER w AS time_mean, stddev_samp(close) OVER w AS time_std, sum(close) OVER w AS time_sum,
  min(close) OVER w AS time_min, max(close) OVER w AS time_max, count(close) OVER w AS time_count
  FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY epoch_us(ts) RANGE BETWEEN 2591999999999 PRECEDING AND CURRENT ROW))""",
        f"SELECT symbol, ts, time_count, {rs('time_mean', 'time_std', 'time_sum', 'time_min', 'time_max', digits=5)} FROM x",
    ),
)
def rolling_30_days(spark, sf):
    out = ops.rolling_time(fx.daily(spark, sf).select("symbol", "ts", "close"), DAILY, "close", 30 * 86400)
    return near(out, "time_mean", "time_std", "time_sum", "time_min", "time_max", digits=5).drop("close")


@query(
    "rolling_zscore",
    "W10",
    with_(
        HOURLY_SQL,
        f"x AS (SELECT symbol, ts, CASE WHEN count(close) OVER {wn(20)} = 20 THEN (close - avg(close) OVER {wn(20)}) / nullif(stddev_samp(close) OVER {wn(20)}, 0) END AS zscore FROM bars)",
        f"SELECT symbol, ts, {rs('zscore')} FROM x",
    ),
)
def rolling_zscore(spark, sf):
    return near(ops.rolling_zscore(fx.hourly(spark, sf).select("symbol", "ts", "close"), HOURLY), "zscore").drop("close")


def pair(spark, sf):
    """Close of each symbol next to the close of the symbol "view" at the same hour."""
    b = fx.hourly(spark, sf).select("symbol", "ts", "close")
    bench = b.filter("symbol = 'view'").select("ts", F.col("close").alias("bench"))
    return b.filter("symbol <> 'view'").join(bench, "ts")


PAIR_SQL = """pair AS (SELECT a.symbol, a.ts, a.close, b.close AS bench FROM bars a JOIN bars b ON a.ts = b.ts AND b.symbol = 'view'
  WHERE a.symbol <> 'view')"""


@query(
    "rolling_pair_statistics",
    "W11",
    with_(
        HOURLY_SQL,
        PAIR_SQL,
        f"""x AS (SELECT symbol, ts, count(*) OVER {wn(30)} AS n, covar_samp(close, bench) OVER {wn(30)} AS cov, corr(close, bench) OVER {wn(30)} AS corr,
  covar_samp(close, bench) OVER {wn(30)} / var_samp(bench) OVER {wn(30)} AS beta FROM pair)""",
        f"SELECT symbol, ts, {', '.join(f'CASE WHEN n = 30 THEN {r(c)} END AS {c}' for c in ('cov', 'corr', 'beta'))}, CASE WHEN n = 30 THEN {r('corr * corr')} END AS r2 FROM x",
    ),
)
def rolling_pair_statistics(spark, sf):
    out = ops.rolling_pair(pair(spark, sf), HOURLY, "close", "bench", 30)
    return near(out, "cov", "corr", "beta", "r2").drop("close", "bench")


@query(
    "rolling_rank",
    "W12",
    with_(
        HOURLY_SQL,
        f"x AS (SELECT symbol, ts, close, list(close) OVER {wn(20)} AS v FROM bars)",
        f"""SELECT symbol, ts, CASE WHEN len(v) = 20 THEN {r('(len(list_filter(v, lambda q: q < close)) + (len(list_filter(v, lambda q: q = close)) + 1) / 2.0) / 20')} END AS rank_pct FROM x""",
    ),
)
def rolling_rank(spark, sf):
    return near(ops.rolling_rank(fx.hourly(spark, sf).select("symbol", "ts", "close"), HOURLY, "close", 20), "rank_pct").drop("close")


@query(
    "rolling_slope",
    "W13",
    with_(
        HOURLY_SQL,
        NUMBERED,
        f"x AS (SELECT symbol, ts, CASE WHEN rn >= 20 THEN regr_slope(close, rn) OVER {wn(20)} END AS slope FROM nb)",
        f"SELECT symbol, ts, {rs('slope')} FROM x",
    ),
)
def rolling_slope(spark, sf):
    return near(ops.rolling_slope(fx.hourly(spark, sf).select("symbol", "ts", "close"), HOURLY, "close", 20), "slope").drop("close")


@query(
    "cumulative_returns",
    "W14",
    with_(
        HOURLY_SQL,
        RETURNS,
        f"x AS (SELECT symbol, ts, coalesce(exp(sum(ln(1 + ret)) OVER ({W} ROWS UNBOUNDED PRECEDING)), 1) AS g FROM rets)",
        f"SELECT symbol, ts, {r('g - 1', 5)} AS cum_return, {r('100 * g', 3)} AS rebuilt FROM x",
    ),
)
def cumulative_returns(spark, sf):
    out = ops.compounded(returns(spark, sf).select("symbol", "ts", "ret"), HOURLY)
    return near(near(out, "cum_return", digits=5), "rebuilt", digits=3).drop("ret")


@query(
    "total_return",
    "W14",
    with_(HOURLY_SQL, RETURNS, f"SELECT symbol, {r('exp(sum(ln(1 + ret))) - 1', 5)} AS total_return FROM rets GROUP BY symbol"),
)
def total_return(spark, sf):
    return near(ops.total_return(returns(spark, sf), ["symbol"]), "total_return", digits=5)


DD_SQL = f"""pk AS (SELECT symbol, ts, rn, close, max(close) OVER ({W} ROWS UNBOUNDED PRECEDING) AS peak FROM nb),
dd AS (SELECT *, (close - peak) / peak AS drawdown, rn - max(CASE WHEN close = peak THEN rn END) OVER ({W} ROWS UNBOUNDED PRECEDING) AS dd_length,
  max(CASE WHEN close = peak THEN rn END) OVER ({W} ROWS UNBOUNDED PRECEDING) AS pp, lead(ts) OVER ({W}) AS nts, lead(close) OVER ({W}) AS nv FROM pk),
rec AS (SELECT symbol, pp, max(peak) AS peak_value, min(ts) AS start_ts, arg_min(ts, close) AS valley_ts, min(close) AS valley_value,
  CASE WHEN count(nts) = count(*) THEN max(nts) END AS recovery_ts, CASE WHEN count(nts) = count(*) THEN arg_max(nv, rn) END AS recovery_value, max(-drawdown) AS depth, count(*) AS n,
  arg_min(rn, close) AS vrn, max(rn) AS lrn FROM dd WHERE drawdown < 0 GROUP BY symbol, pp),
records AS (SELECT symbol, peak_value, start_ts, valley_ts, valley_value, recovery_ts, recovery_value, depth, recovery_ts IS NULL AS active,
  n + (recovery_ts IS NOT NULL)::INT AS duration, vrn - pp AS decline_duration, CASE WHEN recovery_ts IS NULL THEN 0 ELSE lrn + 1 - vrn END AS recovery_duration FROM rec)"""


@query(
    "drawdown_series",
    "W15",
    with_(HOURLY_SQL, NUMBERED, DD_SQL, f"SELECT symbol, ts, peak, {rs('drawdown')}, dd_length FROM dd"),
)
def drawdown_series(spark, sf):
    out = ops.drawdowns(fx.hourly(spark, sf), HOURLY)
    return near(out, "drawdown").select("symbol", "ts", "peak", "drawdown", "dd_length")


@query(
    "drawdown_records",
    "W16",
    with_(HOURLY_SQL, NUMBERED, DD_SQL, f"SELECT * REPLACE ({r('depth')} AS depth) FROM records"),
)
def drawdown_records(spark, sf):
    return near(ops.drawdown_records(fx.hourly(spark, sf), HOURLY), "depth")


@query(
    "drawdown_statistics",
    "W16",
    with_(
        HOURLY_SQL,
        NUMBERED,
        DD_SQL,
        f"""SELECT symbol, count(*) AS n_drawdowns, {r('max(depth)')} AS max_depth, {r('avg(depth)')} AS avg_depth, max(duration) AS max_duration,
  {r('avg(duration)')} AS avg_duration, max(decline_duration) AS max_decline, max(recovery_duration) AS max_recovery,
  {r('avg(CASE WHEN active THEN 0 ELSE recovery_value / valley_value - 1 END)', 4)} AS avg_recovery_return, {r('max(CASE WHEN active THEN depth ELSE 0 END)')} AS active_depth
FROM records GROUP BY symbol""",
    ),
)
def drawdown_statistics(spark, sf):
    out = ops.drawdown_stats(fx.hourly(spark, sf), HOURLY)
    return near(near(out, "max_depth", "avg_depth", "avg_duration", "active_depth"), "avg_recovery_return", digits=4)


ISLANDS = f"""m AS (SELECT symbol, ts, rn, close > open AS up FROM nb),
i AS (SELECT *, rn - row_number() OVER (PARTITION BY symbol, up ORDER BY ts) AS island FROM m),
islands AS (SELECT symbol, up, min(ts) AS start_ts, max(ts) AS end_ts, count(*) AS length, max(rn) AS lrn FROM i GROUP BY symbol, up, island)"""


@query(
    "mask_ranges",
    "W17",
    with_(HOURLY_SQL, NUMBERED, ISLANDS, "SELECT symbol, start_ts, end_ts, length FROM islands WHERE up"),
)
def mask_ranges(spark, sf):
    return ops.ranges(fx.hourly(spark, sf), HOURLY, F.col("close") > F.col("open"))


@query(
    "mask_range_statistics",
    "W17",
    with_(
        HOURLY_SQL,
        NUMBERED,
        ISLANDS,
        f"""SELECT symbol, CAST(sum(length) AS BIGINT) AS n_rows, count(*) FILTER (up) AS n_ranges, {r('avg(length) FILTER (up)')} AS avg_length,
  max(length) FILTER (up) AS max_length, min(length) FILTER (up) AS min_length, CAST(sum(length) FILTER (up) AS BIGINT) AS covered,
  {r('CAST(sum(length) FILTER (up) AS DOUBLE) / sum(length) * 100')} AS coverage_pct FROM islands GROUP BY symbol""",
    ),
)
def mask_range_statistics(spark, sf):
    return near(ops.range_stats(fx.hourly(spark, sf), HOURLY, F.col("close") > F.col("open")), "avg_length", "coverage_pct")


@query(
    "streaks",
    "W18",
    with_(
        HOURLY_SQL,
        NUMBERED,
        ISLANDS,
        """SELECT symbol, coalesce(max(length) FILTER (up), 0) AS max_win_streak, coalesce(max(length) FILTER (NOT up), 0) AS max_loss_streak,
  arg_max(CASE WHEN up THEN length ELSE -length END, lrn) AS current_streak FROM islands GROUP BY symbol""",
    ),
)
def streaks(spark, sf):
    return ops.streaks(fx.hourly(spark, sf), HOURLY, F.col("close") > F.col("open"))


@query(
    "cross_rank",
    "W19",
    with_(
        DAILY_SQL,
        """SELECT symbol, ts, row_number() OVER (PARTITION BY ts ORDER BY volume, symbol) AS ordinal,
  rank() OVER (PARTITION BY ts ORDER BY volume DESC) AS best,
  rank() OVER (PARTITION BY ts ORDER BY volume) + (count(*) OVER (PARTITION BY ts, volume) - 1) / 2.0::DOUBLE AS mid FROM bars""",
    ),
)
def cross_rank(spark, sf):
    d = fx.daily(spark, sf).select("symbol", "ts", F.col("volume").cast("double").alias("v"))
    out = ops.cross_rank(d, "v", out="ordinal")
    out = ops.cross_rank(out, "v", ascending=False, method="min", out="best")
    return ops.cross_rank(out, "v", method="average", out="mid").drop("v")


@query(
    "cross_rank_masked_groups",
    "W19",
    with_(
        DAILY_SQL,
        """g AS (SELECT b.*, CAST(s_nationkey AS INTEGER) % 5 AS grp FROM bars b JOIN supplier ON CAST(s_suppkey AS VARCHAR) = b.symbol)""",
        """SELECT symbol, ts, grp, CASE WHEN volume >= 10 THEN rank() OVER (PARTITION BY ts, grp ORDER BY CASE WHEN volume >= 10 THEN volume END NULLS LAST) END AS rank FROM g""",
    ),
)
def cross_rank_masked_groups(spark, sf):
    s = fx.table(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("symbol"), (F.col("s_nationkey") % 5).alias("grp"))
    d = fx.daily(spark, sf).join(s, "symbol").withColumn("v", F.col("volume").cast("double"))
    out = ops.cross_rank(d, "v", ("ts", "grp"), method="min", mask=F.col("v") >= 10)
    return out.select("symbol", "ts", "grp", "rank")


@query(
    "cross_top_bottom",
    "W19",
    with_(
        DAILY_SQL,
        """a AS (SELECT symbol, ts, row_number() OVER (PARTITION BY ts ORDER BY close DESC, symbol) AS t, row_number() OVER (PARTITION BY ts ORDER BY close, symbol) AS b FROM bars)""",
        "SELECT symbol, ts, 'top' AS side, t AS rank FROM a WHERE t <= 3 UNION ALL SELECT symbol, ts, 'bottom', b FROM a WHERE b <= 3",
    ),
)
def cross_top_bottom(spark, sf):
    d = fx.daily(spark, sf).select("symbol", "ts", "close")
    top = ops.cross_top(d, "close", 3).withColumn("side", F.lit("top"))
    low = ops.cross_top(d, "close", 3, bottom=True).withColumn("side", F.lit("bottom"))
    return top.unionByName(low).drop("close")


@query(
    "cross_percentile_band",
    "W20",
    with_(
        DAILY_SQL,
        "q AS (SELECT ts, quantile_cont(close, 0.25) AS lo, quantile_cont(close, 0.75) AS hi FROM bars GROUP BY ts)",
        "SELECT symbol, b.ts, close FROM bars b JOIN q ON b.ts = q.ts WHERE close BETWEEN lo AND hi",
    ),
)
def cross_percentile_band(spark, sf):
    return ops.cross_band(fx.daily(spark, sf).select("symbol", "ts", "close"), "close", 25, 75)


@query(
    "cross_quantiles",
    "W20",
    with_(
        DAILY_SQL,
        f"q AS (SELECT ts, {', '.join(f'quantile_cont(close, {i / 4}) AS q{i}, ' for i in (1, 2, 3)).replace(', ,', ',').rstrip(', ')} FROM bars GROUP BY ts)",
        "SELECT symbol, b.ts, CAST((close > q1)::INT + (close > q2)::INT + (close > q3)::INT AS INTEGER) AS quartile FROM bars b JOIN q ON b.ts = q.ts",
    ),
)
def cross_quantiles(spark, sf):
    return ops.cross_quantile(fx.daily(spark, sf).select("symbol", "ts", "close"), "close", 4, out="quartile").drop("close")


@query(
    "cross_normalise",
    "W21",
    with_(
        DAILY_SQL,
        "q AS (SELECT ts, avg(close) AS m, stddev_samp(close) AS s, quantile_cont(close, 0.05) AS lo, quantile_cont(close, 0.95) AS hi FROM bars GROUP BY ts)",
        f"""SELECT symbol, b.ts, {r('close - m', 5)} AS demeaned, {r('(close - m) / (s + 1e-8)')} AS cs_zscore, {r('greatest(least(close, hi), lo)', 5)} AS winsorised,
  {r('greatest(least(close, 2000), 500)', 5)} AS clipped FROM bars b JOIN q ON b.ts = q.ts""",
    ),
)
def cross_normalise(spark, sf):
    out = ops.cross_normalise(fx.daily(spark, sf).select("symbol", "ts", "close"), "close", epsilon=1e-8, clip=(500.0, 2000.0))
    return near(near(out, "demeaned", "winsorised", "clipped", digits=5), "cs_zscore").drop("close")


@query(
    "cross_rank_normalised",
    "W22",
    with_(
        DAILY_SQL,
        f"""SELECT symbol, ts, {r('(rank() OVER (PARTITION BY ts ORDER BY volume) + (count(*) OVER (PARTITION BY ts, volume) - 1) / 2.0) / count(*) OVER (PARTITION BY ts)')} AS rank_pct FROM bars""",
    ),
)
def cross_rank_normalised(spark, sf):
    d = fx.daily(spark, sf).select("symbol", "ts", F.col("volume").cast("double").alias("v"))
    return near(ops.cross_rank_pct(d, "v"), "rank_pct").drop("v")


def _train_test(spark, sf):
    d = fx.daily(spark, sf).select("symbol", "ts", "close", F.col("volume").cast("double").alias("volume"))
    return d.filter("ts < '1999-01-01'"), d.filter("ts >= '1999-01-01'")


_TRAIN = """f AS (SELECT symbol, ts, close, CAST(volume AS DOUBLE) AS volume FROM bars), train AS (SELECT * FROM f WHERE ts < '1999-01-01'), test AS (SELECT * FROM f WHERE ts >= '1999-01-01')"""


@query(
    "fitted_minmax_zscore",
    "W23",
    with_(
        DAILY_SQL,
        _TRAIN,
        "p AS (SELECT min(close) AS c0, max(close) AS c1, avg(volume) AS m, stddev_samp(volume) AS s FROM train)",
        f"SELECT symbol, ts, {r('(close - c0) / (c1 - c0)')} AS close, {r('(volume - m) / s')} AS volume FROM test, p",
    ),
)
def fitted_minmax_zscore(spark, sf):
    train, test = _train_test(spark, sf)
    out = ops.MinMax(["close"]).fit(train).transform(test)
    return near(ops.ZScore(["volume"]).fit(train).transform(out), "close", "volume")


@query(
    "fitted_robust_tanh_winsor",
    "W23",
    with_(
        DAILY_SQL,
        _TRAIN,
        "med AS (SELECT median(close) AS c, quantile_cont(volume, 0.01) AS lo, quantile_cont(volume, 0.99) AS hi FROM train)",
        "mad AS (SELECT median(abs(close - c)) AS d FROM train, med)",
        f"SELECT symbol, ts, {r('greatest(least((close - c) / (1.4826 * d), 3), -3)')} AS close, {r('tanh(greatest(least(volume, hi), lo) / 10.0) * 10.0')} AS volume FROM test, med, mad",
    ),
)
def fitted_robust_tanh_winsor(spark, sf):
    train, test = _train_test(spark, sf)
    out = ops.RobustZScore(["close"]).fit(train).transform(test)
    out = ops.Winsorize(["volume"]).fit(train).transform(out)
    return near(ops.Tanh(["volume"], 10.0).transform(out), "close", "volume")


@query(
    "processor_chain",
    "W24",
    with_(
        DAILY_SQL,
        _TRAIN,
        "p1 AS (SELECT quantile_cont(close, 0.01) AS lo, quantile_cont(close, 0.99) AS hi FROM train)",
        "t1 AS (SELECT greatest(least(close, hi), lo) AS close FROM train, p1), p2 AS (SELECT avg(close) AS m, stddev_samp(close) AS s FROM t1)",
        f"SELECT symbol, ts, {r('(greatest(least(close, hi), lo) - m) / s')} AS close FROM test, p1, p2",
    ),
)
def processor_chain(spark, sf):
    train, test = _train_test(spark, sf)
    chain = ops.Processors([ops.Winsorize(["close"]), ops.ZScore(["close"])]).fit(train)
    return near(chain.transform(test), "close").drop("volume")


@query(
    "scale_per_entity",
    "W25",
    with_(
        HOURLY_SQL,
        "s AS (SELECT symbol, avg(close) AS m, stddev_samp(close) AS s, min(close) AS lo, max(close) AS hi, median(close) AS md, quantile_cont(close, 0.75) - quantile_cont(close, 0.25) AS iqr FROM bars GROUP BY symbol)",
        f"SELECT b.symbol, ts, {r('(close - m) / s')} AS standard, {r('(close - lo) / (hi - lo)')} AS minmax, {r('(close - md) / iqr')} AS robust FROM bars b JOIN s ON b.symbol = s.symbol",
    ),
)
def scale_per_entity(spark, sf):
    out = fx.hourly(spark, sf).select("symbol", "ts", "close")
    for m in ("standard", "minmax", "robust"):
        out = ops.scale_entities(out, "symbol", "close", m).withColumnRenamed("scaled", m)
    return near(out, "standard", "minmax", "robust").drop("close")


def gappy(spark, sf):
    """Closes with every fifth to seventh hour knocked out."""
    h = fx.hourly(spark, sf)
    return h.select("symbol", "ts", F.when((F.hour("ts") % 5 != 0) & (F.hour("ts") % 7 != 1), F.col("close")).alias("value"))


_GAPPY = """g AS (SELECT symbol, ts, CASE WHEN hour(ts) % 5 <> 0 AND hour(ts) % 7 <> 1 THEN close END AS value, row_number() OVER (PARTITION BY symbol ORDER BY ts) AS rn FROM bars),
k AS (SELECT *, last_value(value IGNORE NULLS) OVER f AS pv, last_value(CASE WHEN value IS NOT NULL THEN rn END IGNORE NULLS) OVER f AS pr,
  first_value(value IGNORE NULLS) OVER b AS nv, first_value(CASE WHEN value IS NOT NULL THEN rn END IGNORE NULLS) OVER b AS nr, avg(value) OVER (PARTITION BY symbol) AS m
  FROM g WINDOW f AS (PARTITION BY symbol ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), b AS (PARTITION BY symbol ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""


@query(
    "impute_simple",
    "W26,F11",
    with_(
        HOURLY_SQL,
        _GAPPY,
        f"SELECT symbol, ts, pv AS forward, nv AS backward, {r('coalesce(value, m)')} AS mean, coalesce(value, 0) AS zero FROM k",
    ),
)
def impute_simple(spark, sf):
    out = gappy(spark, sf)
    for m in ("forward", "backward", "mean", "zero"):
        out = ops.impute(out, HOURLY, "value", m, m)
    return near(out, "mean").drop("value")


@query(
    "impute_linear",
    "W26,F11",
    with_(
        HOURLY_SQL,
        _GAPPY,
        f"""SELECT symbol, ts, {r('coalesce(value, pv + (nv - pv) * (rn - pr) / (nr - pr))')} AS linear,
  {r('coalesce(value, CASE WHEN rn - pr <= 1 THEN coalesce(pv + (nv - pv) * (rn - pr) / (nr - pr), CASE WHEN nv IS NULL THEN pv END) END)')} AS limited FROM k""",
    ),
)
def impute_linear(spark, sf):
    out = ops.impute(gappy(spark, sf), HOURLY, "value", "linear", "linear")
    out = ops.interpolate(out, HOURLY, "value", "limited", limit=1, fill_tail=True)
    return near(out, "linear", "limited").drop("value")


@query(
    "head_tail_nth",
    "W27",
    with_(
        HOURLY_SQL,
        "n AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts) AS a, row_number() OVER (PARTITION BY symbol ORDER BY ts DESC) AS z FROM bars)",
        "SELECT symbol, ts, close, 'head' AS part FROM n WHERE a <= 3 UNION ALL SELECT symbol, ts, close, 'tail' FROM n WHERE z <= 2 UNION ALL SELECT symbol, ts, close, 'tenth' FROM n WHERE a = 10",
    ),
)
def head_tail_nth(spark, sf):
    b = fx.hourly(spark, sf).select("symbol", "ts", "close")
    parts = {"head": ops.head(b, HOURLY, 3), "tail": ops.tail(b, HOURLY, 2), "tenth": ops.nth(b, HOURLY, 10)}
    out = None
    for name, df in parts.items():
        df = df.select("symbol", "ts", "close", F.lit(name).alias("part"))
        out = df if out is None else out.unionByName(df)
    return out


@query(
    "last_known_value",
    "W27",
    with_(HOURLY_SQL, _GAPPY, "SELECT symbol, arg_max(value, ts) FILTER (value IS NOT NULL) AS last_value FROM g GROUP BY symbol"),
)
def last_known_value(spark, sf):
    return ops.last_value(gappy(spark, sf), HOURLY, "value")


@query(
    "rebase_to_100",
    "W28",
    with_(
        HOURLY_SQL,
        f"SELECT symbol, ts, {r('close / first_value(close) OVER (PARTITION BY symbol ORDER BY ts) * 100')} AS rebased FROM bars",
    ),
)
def rebase_to_100(spark, sf):
    return near(ops.rebase(fx.hourly(spark, sf).select("symbol", "ts", "close"), HOURLY), "rebased").drop("close")


@query(
    "lookback_returns",
    "W29",
    with_(
        DAILY_SQL,
        "n AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts DESC) AS z FROM bars)",
        "SELECT symbol, "
        + ", ".join(f"{r(f'max(CASE WHEN z = 1 THEN close END) / max(CASE WHEN z = {k} THEN close END) - 1')} AS \"{p}\"" for p, k in (("1m", 21), ("3m", 63), ("6m", 126), ("1y", 252)))
        + " FROM n GROUP BY symbol",
    ),
)
def lookback_returns(spark, sf):
    return near(ops.lookback_returns(fx.daily(spark, sf), DAILY), "1m", "3m", "6m", "1y")


@query(
    "relative_performance",
    "W29",
    with_(
        HOURLY_SQL,
        PAIR_SQL,
        f"""p AS (SELECT *, close / lag(close) OVER ({W}) - 1 AS a, bench / lag(bench) OVER ({W}) - 1 AS b FROM pair),
s AS (SELECT symbol, arg_max(close, ts) / arg_min(close, ts) - 1 AS total_asset, arg_max(bench, ts) / arg_min(bench, ts) - 1 AS total_bench,
  avg(a - b) / stddev_samp(a - b) AS information_ratio, stddev_samp(a - b) * sqrt(252) AS tracking_error, corr(a, b) AS correlation, covar_samp(a, b) / var_samp(b) AS beta FROM p GROUP BY symbol)""",
        f"SELECT symbol, {rs('total_asset', 'total_bench', 'information_ratio', 'tracking_error', 'correlation', 'beta', digits=5)} FROM s",
    ),
)
def relative_performance(spark, sf):
    names = ["total_asset", "total_bench", "information_ratio", "tracking_error", "correlation", "beta"]
    return near(ops.relative_performance(pair(spark, sf), ["symbol"], "close", "bench"), *names, digits=5).select("symbol", *names)


_RISK = ["roll_vol", "roll_sharpe", "roll_sortino", "roll_omega", "roll_downside", "roll_ir"]


@query(
    "rolling_risk",
    "W30",
    with_(
        HOURLY_SQL,
        PAIR_SQL,
        f"p AS (SELECT symbol, ts, close / lag(close) OVER ({W}) - 1 AS x, bench / lag(bench) OVER ({W}) - 1 AS b FROM pair)",
        f"""q AS (SELECT symbol, ts, count(x) OVER {wn(63)} AS n, avg(x) OVER {wn(63)} AS m, stddev_samp(x) OVER {wn(63)} AS s,
  sqrt(avg(CASE WHEN x < 0 THEN x * x WHEN x IS NOT NULL THEN 0 END) OVER {wn(63)}) AS dn, sum(CASE WHEN x > 0 THEN x ELSE 0 END) OVER {wn(63)} AS g,
  -sum(CASE WHEN x < 0 THEN x ELSE 0 END) OVER {wn(63)} AS l, avg(x - b) OVER {wn(63)} AS am, stddev_samp(x - b) OVER {wn(63)} AS asd FROM p)""",
        f"""SELECT symbol, ts, CASE WHEN n = 63 THEN {r('s * sqrt(252)', 5)} END AS roll_vol, coalesce(CASE WHEN n = 63 THEN {r('m * 252 / nullif(s * sqrt(252), 0)', 5)} END, 0) AS roll_sharpe,
  coalesce(CASE WHEN n = 63 THEN {r('m * 252 / nullif(dn * sqrt(252), 0)', 5)} END, 0) AS roll_sortino, coalesce(CASE WHEN n = 63 THEN {r('CASE WHEN l > 1e-10 THEN g / l ELSE 99 END', 5)} END, 0) AS roll_omega,
  CASE WHEN n = 63 THEN {r('dn * sqrt(252)', 5)} END AS roll_downside, coalesce(CASE WHEN n = 63 THEN {r('am * 252 / nullif(asd * sqrt(252), 0)', 5)} END, 0) AS roll_ir FROM q""",
    ),
)
def rolling_risk(spark, sf):
    rows = over_blocks(pair(spark, sf), HOURLY, lambda w: {"ret": ops.pct_change(w), "bret": ops.pct_change(w, "bench")}, back=1)
    out = ops.rolling_risk(rows, HOURLY, "ret", 63, "bret")
    return near(out, *_RISK, digits=5).select("symbol", "ts", *_RISK)


@query(
    "rolling_drawdown_calmar",
    "W30",
    with_(
        HOURLY_SQL,
        RETURNS,
        f"c AS (SELECT symbol, ts, rn, list(close) OVER {wn(21)} AS v FROM rets)",
        """e AS (SELECT symbol, ts, rn, v, list_transform(generate_series(1, len(v)), lambda i: list_extract(v, i) / list_max(list_slice(v, 1, i)) - 1) AS d FROM c)""",
        f"""SELECT symbol, ts, CASE WHEN rn >= 22 THEN {r('list_min(d)')} END AS roll_drawdown,
  CASE WHEN rn >= 22 THEN CASE WHEN abs(list_min(d)) < 1e-10 THEN 0 ELSE {r('(v[21] / v[1] - 1) / abs(list_min(d))', 5)} END ELSE 0 END AS roll_calmar FROM e""",
    ),
)
def rolling_drawdown_calmar(spark, sf):
    out = ops.rolling_risk(returns(spark, sf), HOURLY, "ret", 21, year=21)
    return near(near(out, "roll_drawdown"), "roll_calmar", digits=5).select("symbol", "ts", "roll_drawdown", "roll_calmar")


@query(
    "smooth_spikes",
    "W31",
    with_(
        HOURLY_SQL,
        "s AS (SELECT symbol, ts, close, avg(close) OVER (PARTITION BY symbol) AS m, stddev_samp(close) OVER (PARTITION BY symbol) AS sd FROM bars)",
        f"SELECT symbol, ts, {r('greatest(least(close, m + 2 * sd), m - 2 * sd)')} AS smoothed FROM s",
    ),
)
def smooth_spikes(spark, sf):
    return near(ops.smooth_spikes(fx.hourly(spark, sf).select("symbol", "ts", "close"), HOURLY, "close", 2.0), "smoothed").drop("close")


@query(
    "smooth_spikes_interpolated",
    "W31",
    with_(
        HOURLY_SQL,
        "s AS (SELECT symbol, ts, close, avg(close) OVER (PARTITION BY symbol) AS m, stddev_samp(close) OVER (PARTITION BY symbol) AS sd, row_number() OVER (PARTITION BY symbol ORDER BY ts) AS rn FROM bars)",
        """k AS (SELECT symbol, ts, rn, CASE WHEN abs(close - m) <= 2 * sd THEN close END AS v FROM s),
j AS (SELECT *, last_value(v IGNORE NULLS) OVER f AS pv, last_value(CASE WHEN v IS NOT NULL THEN rn END IGNORE NULLS) OVER f AS pr,
  first_value(v IGNORE NULLS) OVER b AS nv, first_value(CASE WHEN v IS NOT NULL THEN rn END IGNORE NULLS) OVER b AS nr
  FROM k WINDOW f AS (PARTITION BY symbol ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), b AS (PARTITION BY symbol ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))""",
        f"SELECT symbol, ts, {r('coalesce(v, pv + (nv - pv) * (rn - pr) / (nr - pr), CASE WHEN nv IS NULL THEN pv END)')} AS smoothed FROM j",
    ),
)
def smooth_spikes_interpolated(spark, sf):
    out = ops.smooth_spikes(fx.hourly(spark, sf).select("symbol", "ts", "close"), HOURLY, "close", 2.0, "interpolate")
    return near(out, "smoothed").drop("close")


@query(
    "ramp_weights",
    "W31",
    with_(
        HOURLY_SQL,
        "n AS (SELECT symbol, ts, close, row_number() OVER (PARTITION BY symbol ORDER BY ts) AS a, count(*) OVER (PARTITION BY symbol) AS c FROM bars)",
        f"SELECT symbol, ts, {r('close * CASE WHEN c - a + 1 <= 5 THEN least(CASE WHEN a <= 5 THEN a / 5.0 ELSE 1 END, (c - a + 1) / 5.0) WHEN a <= 5 THEN a / 5.0 ELSE 1 END')} AS ramped FROM n",
    ),
)
def ramp_weights(spark, sf):
    return near(ops.ramp(fx.hourly(spark, sf).select("symbol", "ts", "close"), HOURLY, "close"), "ramped").drop("close")


@query(
    "seasonal_adjust",
    "W31",
    with_(
        HOURLY_SQL,
        NUMBERED,
        f"SELECT symbol, ts, {r('close - avg(close) OVER (PARTITION BY symbol, (rn - 1) % 24) + avg(close) OVER (PARTITION BY symbol)')} AS adjusted FROM nb",
    ),
)
def seasonal_adjust(spark, sf):
    return near(ops.seasonal_adjust(fx.hourly(spark, sf).select("symbol", "ts", "close"), HOURLY, "close", 24), "adjusted").drop("close")


@query(
    "runs_test",
    "W32",
    with_(
        HOURLY_SQL,
        RETURNS,
        f"u AS (SELECT symbol, ts, (ret > median(ret) OVER (PARTITION BY symbol))::INT AS up FROM rets WHERE ret IS NOT NULL), t AS (SELECT *, (up <> lag(up) OVER ({W}))::INT AS turn FROM u)",
        "s AS (SELECT symbol, sum(turn) + 1 AS runs, CAST(sum(up) AS DOUBLE) AS n1, CAST(count(*) AS DOUBLE) AS n FROM t GROUP BY symbol)",
        "e AS (SELECT *, n - n1 AS n2, 2 * n1 * (n - n1) / n + 1 AS expected_runs FROM s)",
        "z AS (SELECT *, (runs - expected_runs) / sqrt(2 * n1 * n2 * (2 * n1 * n2 - n) / (n * n * (n - 1))) AS z FROM e)",
        f"SELECT symbol, CAST(runs AS BIGINT) AS runs, n, {rs('expected_runs', 'z')}, {r('2 * (1 - ' + normal_cdf_sql('abs(z)') + ')')} AS p_value FROM z",
    ),
)
def runs_test(spark, sf):
    return near(ops.runs_test(returns(spark, sf), HOURLY, "ret"), "expected_runs", "z", "p_value")


@query(
    "autocorrelation",
    "W32",
    with_(
        HOURLY_SQL,
        RETURNS,
        f"l AS (SELECT symbol, ret, {', '.join(f'lag(ret, {k}) OVER ({W}) AS l{k}' for k in (1, 5, 10, 20))} FROM rets)",
        "a AS (" + " UNION ALL ".join(f"SELECT symbol, {k} AS lag, count(ret) AS n, corr(ret, l{k}) AS autocorr FROM l GROUP BY symbol" for k in (1, 5, 10, 20)) + ")",
        f"SELECT symbol, n, lag, {rs('autocorr')}, {r('2 * (1 - ' + normal_cdf_sql('sqrt(n * autocorr * autocorr)') + ')')} AS p_value FROM a",
    ),
)
def autocorrelation(spark, sf):
    return near(ops.autocorrelation(returns(spark, sf), HOURLY, "ret"), "autocorr", "p_value")


@query(
    "variance_ratio",
    "W32",
    with_(
        HOURLY_SQL,
        RETURNS,
        "q AS (SELECT symbol, ts, ret, row_number() OVER (PARTITION BY symbol ORDER BY ts) AS k FROM rets WHERE ret IS NOT NULL)",
        f"s AS (SELECT symbol, ret, {', '.join(f'CASE WHEN k >= {k} THEN sum(ret) OVER {wn(k)} END AS s{k}' for k in (2, 4, 8, 16))} FROM q)",
        "a AS (" + " UNION ALL ".join(f"SELECT symbol, {k} AS period, count(ret) AS n, var_samp(s{k}) / ({k} * var_samp(ret)) AS ratio FROM s GROUP BY symbol" for k in (2, 4, 8, 16)) + ")",
        f"SELECT symbol, n, period, {rs('ratio')}, {r('sqrt(n) * (ratio - 1) / sqrt(2 * (period - 1))')} AS z FROM a",
    ),
)
def variance_ratio(spark, sf):
    return near(ops.variance_ratio(returns(spark, sf), HOURLY, "ret"), "ratio", "z").drop("p_value")


@query(
    "forward_volatility",
    "W33",
    with_(
        HOURLY_SQL,
        RETURNS,
        "q AS (SELECT symbol, ret, row_number() OVER (PARTITION BY symbol ORDER BY ts DESC) AS z FROM rets WHERE ret IS NOT NULL)",
        "a AS (" + " UNION ALL ".join(f"SELECT symbol, {t} AS tenor, var_samp(ret) * 252 AS v FROM q WHERE z <= {t} GROUP BY symbol" for t in (21, 63, 126, 252)) + ")",
        "b AS (SELECT symbol, tenor, v, greatest((v * tenor - lag(v) OVER w * lag(tenor) OVER w) / (tenor - lag(tenor) OVER w), CASE WHEN lag(v) OVER w IS NOT NULL THEN 0 END) AS fv FROM a WINDOW w AS (PARTITION BY symbol ORDER BY tenor))",
        f"SELECT symbol, tenor, {r('v', 4)} AS realized_var, {r('fv', 4)} AS forward_var, {r('sqrt(v)', 5)} AS realized_vol, {r('sqrt(fv)', 5)} AS forward_vol FROM b",
    ),
)
def forward_volatility(spark, sf):
    out = ops.forward_vol(returns(spark, sf), HOURLY, "ret")
    return near(near(out, "realized_var", "forward_var", digits=4), "realized_vol", "forward_vol", digits=5)


@query(
    "swap_strikes",
    "W33",
    with_(
        HOURLY_SQL,
        PAIR_SQL,
        f"p AS (SELECT symbol, ts, row_number() OVER ({W}) AS rn, ln(close / lag(close) OVER ({W})) AS a, ln(bench / lag(bench) OVER ({W})) AS b FROM pair)",
        f"""SELECT symbol, ts, CASE WHEN rn >= 22 THEN {r(f'sqrt(avg(a * a) OVER {wn(21)} * 252)')} END AS vol_swap,
  CASE WHEN rn >= 22 THEN {r(f'sum(a * b) OVER {wn(21)} / sqrt(sum(a * a) OVER {wn(21)} * sum(b * b) OVER {wn(21)})')} END AS corr_swap FROM p""",
    ),
)
def swap_strikes(spark, sf):
    out = ops.swap_strikes(pair(spark, sf), HOURLY, "close", "bench", 22)
    return near(out, "vol_swap", "corr_swap").select("symbol", "ts", "vol_swap", "corr_swap")


@query(
    "ewm_volatility",
    "W34",
    with_(
        HOURLY_SQL,
        RETURNS,
        "q AS (SELECT symbol, ts, rn - 1 AS k, ret AS x FROM rets WHERE ret IS NOT NULL)",
        """s AS (SELECT a.symbol, a.ts, sum(power(19 / 21.0, a.k - b.k)) AS w, sum(power(19 / 21.0, 2 * (a.k - b.k))) AS w2, sum(power(19 / 21.0, a.k - b.k) * b.x) AS m,
  sum(power(19 / 21.0, a.k - b.k) * b.x * b.x) AS m2 FROM q a JOIN q b ON a.symbol = b.symbol AND b.k <= a.k GROUP BY a.symbol, a.ts)""",
        f"SELECT symbol, ts, CASE WHEN w * w - w2 > 1e-9 THEN {r('sqrt((m2 / w - (m / w) * (m / w)) * w * w / (w * w - w2)) * sqrt(252)', 4)} END AS ewm_vol FROM s",
    ),
)
def ewm_volatility(spark, sf):
    rows = returns(spark, sf).filter("ret IS NOT NULL").select("symbol", "ts", "ret")
    return near(ops.ewm_volatility(rows, HOURLY, "ret"), "ewm_vol", digits=4).select("symbol", "ts", "ewm_vol")


@query(
    "trailing_factors",
    "W35",
    with_(
        HOURLY_SQL,
        RETURNS,
        f"""c AS (SELECT symbol, ts, rn, close, list(close) OVER {wn(21)} AS v, lag(close, 20) OVER ({W}) AS f0, stddev_samp(ret) OVER {wn(20)} AS sd,
  sum(close * volume) OVER {wn(21)} / sum(volume) OVER {wn(21)} AS wa, count(*) OVER (PARTITION BY ts) AS peers FROM rets),
d AS (SELECT *, list_min(list_transform(generate_series(1, len(v)), lambda i: list_extract(v, i) / list_max(list_slice(v, 1, i)) - 1)) AS md FROM c)""",
        f"""SELECT symbol, ts, {r('(close - f0) / f0')} AS returns_n, CASE WHEN rn >= 21 THEN {r('md')} END AS max_drawdown, CASE WHEN rn >= 21 THEN {r('sd * sqrt(252)', 5)} END AS ann_vol,
  CASE WHEN rn >= 21 THEN {r('wa')} END AS weighted_avg, peers FROM d""",
    ),
)
def trailing_factors(spark, sf):
    out = ops.trailing_factors(fx.hourly(spark, sf), HOURLY, 21)
    out = near(near(out, "returns_n", "max_drawdown", "weighted_avg"), "ann_vol", digits=5)
    return out.select("symbol", "ts", "returns_n", "max_drawdown", "ann_vol", "weighted_avg", "peers")
