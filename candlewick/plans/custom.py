"""User-defined factor, feature, pipeline and universe queries over hourly and daily bars."""

import numpy as np
from pyspark.sql import functions as F

from candlewick import fixtures as fx
from candlewick.operators import custom as ops
from candlewick.operators.series import DAILY, HOURLY
from candlewick.plans.indicators import roll, wn
from candlewick.plans.registry import near, query, r
from candlewick.plans.sql import DAILY as DAILY_SQL
from candlewick.plans.sql import HOURLY as HOURLY_SQL
from candlewick.plans.sql import with_


@query(
    "custom_factor",
    "U1",
    with_(HOURLY_SQL, f"SELECT symbol, ts, {r('CASE WHEN count(*) OVER w = 10 THEN sum(close * volume) OVER w / sum(volume) OVER w - (max(high) OVER w + min(low) OVER w) / 2 END')} AS tilt FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY ts ROWS 9 PRECEDING)"),
)
def custom_factor(spark, sf):
    def compute(close, volume, high, low):
        return (close * volume).sum(axis=1) / volume.sum(axis=1) - (high.max(axis=1) + low.min(axis=1)) / 2

    out = ops.custom_factor(fx.hourly(spark, sf), HOURLY, "tilt", ["close", "volume", "high", "low"], 10, compute)
    return near(out.select("symbol", "ts", "tilt"), "tilt")


_PIPE = f"""f AS (SELECT symbol, ts, close, volume, {roll('avg', 'close', 20)} AS slow, {roll('avg', 'close', 5)} AS fast FROM bars)"""


@query(
    "factor_pipeline",
    "U2,U3",
    with_(DAILY_SQL, _PIPE, f"""SELECT symbol, ts, {r('fast / slow - 1')} AS momentum, {r('-(fast - slow) * 2 + close % 7')} AS mix, CASE WHEN fast > slow THEN 'up' ELSE 'down' END AS side, {r('power(fast / slow, 2)')} AS squared
  FROM f WHERE slow IS NOT NULL AND (fast > slow * 1.02 OR (volume >= 40 AND NOT close < slow))"""),
)
def factor_pipeline(spark, sf):
    f = ops.features(fx.daily(spark, sf), DAILY, [{"fast": lambda f: f.mean(f.close, 5), "slow": lambda f: f.mean(f.close, 20)}], back=20)
    fast, slow = F.col("fast"), F.col("slow")
    screen = ops.not_null(slow) & ((fast > slow * 1.02) | ((F.col("volume") >= 40) & ops.negate(F.col("close") < slow)))
    cols = {"momentum": fast / slow - 1, "mix": -(fast - slow) * 2 + F.col("close") % 7, "side": ops.if_else(fast > slow, F.lit("up"), F.lit("down")), "squared": (fast / slow) ** 2}
    return near(ops.pipeline(f, ["symbol", "ts"], cols, screen), "momentum", "mix", "squared")


@query(
    "feature_expressions",
    "U4",
    with_(
        HOURLY_SQL,
        f"""e AS (SELECT *, lag(close, 5) OVER (PARTITION BY symbol ORDER BY ts) AS ref5, {roll('avg', 'close', 20)} AS m, {roll('stddev_samp', 'close', 20)} AS s, {roll('sum', 'volume', 10)} AS vol, {roll('max', 'high', 10)} AS hi, {roll('min', 'low', 10)} AS lo,
  CASE WHEN count(*) OVER {wn(12)} = 12 THEN list(close) OVER {wn(12)} END AS l FROM bars), e2 AS (SELECT *, abs(ln(close / ref5)) AS a FROM e)""",
        f"""SELECT symbol, ts, {r('close / ref5 - 1')} AS momentum, {r('(close - m) / s')} AS zscore, vol::BIGINT AS volume_10, {r('(close - lo) / (hi - lo)')} AS position,
  {r('(length(list_filter(l, lambda x: x < close)) + (length(list_filter(l, lambda x: x = close)) + 1) / 2) / 12')} AS rank_12, {r('a')} AS abs_log, sign(close - m)::DOUBLE AS side,
  {r(f'CASE WHEN count(a) OVER {wn(5)} = 5 THEN avg(a) OVER {wn(5)} END')} AS smooth FROM e2""",
    ),
)
def feature_expressions(spark, sf):
    first = {
        "momentum": lambda f: f.close / f.ref(f.close, 5) - 1, "zscore": lambda f: (f.close - f.mean(f.close, 20)) / f.std(f.close, 20), "volume_10": lambda f: f.sum(f.volume, 10),
        "position": lambda f: (f.close - f.min(f.low, 10)) / (f.max(f.high, 10) - f.min(f.low, 10)), "rank_12": lambda f: f.rank(f.close, 12),
        "abs_log": lambda f: f.abs(f.log(f.close / f.ref(f.close, 5))), "side": lambda f: f.sign(f.close - f.mean(f.close, 20)),
    }
    out = ops.features(fx.hourly(spark, sf), HOURLY, [first, {"smooth": lambda f: f.mean(f.abs_log, 5)}], back=32)
    real = ("momentum", "zscore", "position", "rank_12", "abs_log", "smooth")
    return near(out.select("symbol", "ts", *real, "volume_10", "side"), *real)


@query(
    "rolling_apply",
    "U5",
    with_(HOURLY_SQL, f"SELECT symbol, ts, {r('CASE WHEN count(*) OVER w = 15 THEN median(close) OVER w - avg(close) OVER w END')} AS skewness FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY ts ROWS 14 PRECEDING)"),
)
def rolling_apply(spark, sf):
    out = ops.rolling_apply(fx.hourly(spark, sf), HOURLY, "skewness", "close", 15, lambda x: float(np.median(x) - x.mean()))
    return near(out.select("symbol", "ts", "skewness"), "skewness")


@query(
    "indicator_factory",
    "U6",
    with_(HOURLY_SQL, f"SELECT symbol, ts, {r('CASE WHEN count(*) OVER w = 8 THEN max(high) OVER w + 0.5 END')} AS band_upper, {r('CASE WHEN count(*) OVER w = 8 THEN min(low) OVER w - 0.5 END')} AS band_lower FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY ts ROWS 7 PRECEDING)"),
)
def indicator_factory(spark, sf):
    def band(high, low, n, pad):
        import pandas as pd

        return pd.Series(high).rolling(n).max() + pad, pd.Series(low).rolling(n).min() - pad

    run = ops.indicator_factory(band, ["high", "low"], ["n", "pad"], ["upper", "lower"], "band")
    out = run(fx.hourly(spark, sf), HOURLY, 7, n=8, pad=0.5)
    return near(out.select("symbol", "ts", "band_upper", "band_lower"), "band_upper", "band_lower")


@query(
    "transformer_list",
    "U7",
    with_(HOURLY_SQL, f"SELECT symbol, ts, {r(roll('avg', 'close', 7))} AS short, {r(roll('avg', 'close', 30))} AS long, {r('(close / lag(close, 4) OVER (PARTITION BY symbol ORDER BY ts) - 1) * 100')} AS mom FROM bars"),
)
def transformer_list(spark, sf):
    wanted = [{"name": "short", "transformer": "sma", "args": [7]}, {"name": "long", "transformer": "sma", "args": [30]}, {"name": "mom", "transformer": "momentum", "args": [4]}]
    return near(ops.apply_transformers(fx.hourly(spark, sf), wanted).select("symbol", "ts", "short", "long", "mom"), "short", "long", "mom")


@query(
    "universe_filters",
    "U8",
    with_(
        DAILY_SQL,
        """s AS (SELECT *, CASE WHEN volume % 9 > 0 THEN close END AS price FROM bars),
p AS (SELECT *, count(price) OVER (PARTITION BY symbol ORDER BY ts ROWS 4 PRECEDING) AS n FROM s),
q AS (SELECT ts, quantile_cont(close, 0.25) AS a, quantile_cont(close, 0.5) AS b, quantile_cont(close, 0.75) AS c FROM bars GROUP BY ts)""",
        """SELECT symbol, p.ts, symbol IN ('1', '2', '3', '50') AS static, symbol = '7' AS single, n = 5 AS all_present, n >= 3 AS at_least_3, CASE WHEN close > c THEN 3 WHEN close > b THEN 2 WHEN close > a THEN 1 ELSE 0 END AS quartile, 0 AS everything FROM p JOIN q ON p.ts = q.ts""",
    ),
)
def universe_filters(spark, sf):
    d = fx.daily(spark, sf).withColumn("price", F.when(F.col("volume") % 9 > 0, F.col("close")))
    d = ops.with_presence(d, DAILY, ["price"], 5, out="all_present")
    d = ops.with_presence(d, DAILY, ["price"], 5, 3, out="at_least_3")
    d = ops.quantile_classifier(d, ["ts"], "close", 4, "quartile")
    s = F.col("symbol")
    return d.select(s, "ts", ops.static_assets(s, ["1", "2", "3", "50"]).alias("static"), ops.single_asset(s, "7").alias("single"), "all_present", "at_least_3", "quartile", ops.everything().alias("everything"))
