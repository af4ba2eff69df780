"""Rolling, running and cross-sectional columns of ordered series."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from candlewick.functions.scalars import clamp
from candlewick.functions.stats import normal_cdf
from candlewick.operators import ranking
from candlewick.operators.series import (
    HOURLY,
    POS,
    Axis,
    full,
    number,
    over_blocks,
    over_time,
    prefix,
    smoothed,
    span_alpha,
    trailing,
    whole,
    whole_by,
)

YEAR = 252


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def positive(c: Column) -> Column:
    """The value, or null when zero (divisor guard)."""
    return F.when(c != 0, c)


# --- pipeline features ---------------------------------------------------------------------------------------


def simple_return(w: WindowSpec, c: str = "close") -> Column:
    """Return against the previous bar; 0 without a positive previous value."""
    prev = F.lag(c).over(w)
    return F.when(prev > 0, (F.col(c) - prev) / prev).otherwise(F.lit(0.0))


def pct_change(w: WindowSpec, c: str = "close", n: int = 1) -> Column:
    return F.col(c) / F.lag(c, n).over(w) - 1


def pipeline_features(bars: DataFrame, axis: Axis = HOURLY, log_volatility: bool = False) -> DataFrame:
    """Returns, moving averages, bands and volatilities of the feature table; leading frames may be partial."""

    def first(w):
        prev = F.lag("close").over(w)
        return {"returns": simple_return(w), "log_returns": F.when(prev > 0, F.log(F.col("close") / prev))}

    def second(w):
        out = {f"sma_{n}": F.avg("close").over(trailing(w, n)) for n in (20, 50, 200)}
        out["bb_middle"] = F.avg("close").over(trailing(w, 20))
        out["bb_std"] = F.stddev_samp("close").over(trailing(w, 20))
        base = "log_returns" if log_volatility else "returns"
        out.update({f"volatility_{n}": F.stddev_samp(base).over(trailing(w, n)) for n in (10, 20, 30)})
        return out

    def third(w):
        return {
            "bb_upper": F.col("bb_middle") + 2 * F.col("bb_std"),
            "bb_lower": F.col("bb_middle") - 2 * F.col("bb_std"),
        }

    return over_blocks(bars, axis, [first, second, third], back=200)


FEATURE_TABLE = (
    "symbol", "ts", "returns", "log_returns", "sma_20", "sma_50", "sma_200", "bb_middle", "bb_upper", "bb_lower", "volatility_20",
)


# --- lags, differences ---------------------------------------------------------------------------------------


def lags(df: DataFrame, axis: Axis, value: str, steps: Sequence[int], leads: Sequence[int] = ()) -> DataFrame:
    """Lagged (and leading) copies; rows with a missing copy are dropped."""

    def cols(w):
        out = {f"lag_{k}": F.lag(value, k).over(w) for k in steps}
        out.update({f"lead_{k}": F.lead(value, k).over(w) for k in leads})
        return out

    names = [f"lag_{k}" for k in steps] + [f"lead_{k}" for k in leads]
    return over_blocks(df, axis, cols, back=max(steps, default=0), ahead=max(leads, default=0)).dropna(subset=names)


def difference(w: WindowSpec, value: str, order: int = 1) -> Column:
    """Difference of order n by binomial weights."""
    out = F.col(value)
    for k in range(1, order + 1):
        out = out + F.lit((-1) ** k * math.comb(order, k)) * F.lag(value, k).over(w)
    return out


def changes(df: DataFrame, axis: Axis, value: str, n: int = 1, order: int = 2) -> DataFrame:
    """n-step change, difference of the given order, simple and log return."""

    def cols(w):
        prev = F.lag(value, 1).over(w)
        return {
            "change": F.col(value) - F.lag(value, n).over(w),
            f"diff_{order}": difference(w, value, order),
            "simple_return": F.col(value) / prev - 1,
            "log_return": F.log(F.col(value) / prev),
            "abs_return": F.col(value) - prev,
        }

    return over_blocks(df, axis, cols, back=max(n, order, 1))


# --- rolling statistics ---------------------------------------------------------------------------------------


def interpolated(values: Column, q: float) -> Column:
    """Quantile with linear interpolation of an array of non-null values."""
    ordered = F.array_sort(values)
    at = F.lit(float(q)) * (F.size(values) - 1)
    low, high = F.floor(at).cast("int"), F.ceil(at).cast("int")
    a, b = F.get(ordered, low), F.get(ordered, high)
    return a + (b - a) * (at - F.floor(at))


def adjusted_skew(g: Column, n: Column) -> Column:
    return F.when(n > 2, g * F.sqrt(n * (n - 1)) / (n - 2))


def adjusted_kurtosis(g: Column, n: Column) -> Column:
    return F.when(n > 3, ((n + 1) * g + 6) * (n - 1) / ((n - 2) * (n - 3)))


def _stat(name: str, x: Column, f: WindowSpec, q: float) -> Column:
    n = F.count(x).over(f)
    simple = {
        "mean": F.avg, "std": F.stddev_samp, "var": F.var_samp, "min": F.min, "max": F.max,
        "sum": F.sum, "count": F.count, "product": F.product,
    }
    if name in simple:
        return simple[name](x).over(f)
    if name == "range":
        return F.max(x).over(f) - F.min(x).over(f)
    if name == "median":
        return interpolated(F.collect_list(x).over(f), 0.5)
    if name == "percentile":
        return interpolated(F.collect_list(x).over(f), q)
    if name == "skew":
        return adjusted_skew(F.skewness(x).over(f), n)
    if name == "kurtosis":
        return adjusted_kurtosis(F.kurtosis(x).over(f), n)
    if name == "realized_var":
        return F.sum(x * x).over(f)
    raise ValueError(name)


STATS = (
    "mean", "std", "var", "min", "max", "sum", "count", "product", "range", "median", "percentile", "skew", "kurtosis",
)


def rolling(
    df: DataFrame, axis: Axis, value: str, n: int, stats: Sequence[str] = STATS, q: float = 0.9, drop: bool = True
) -> DataFrame:
    """Statistics over the last ``n`` values, only where the frame is full."""
    x = F.col(value)
    out = over_blocks(
        df, axis, lambda w: {f"{s}_{n}": full(_stat(s, x, trailing(w, n), q), x, w, n) for s in stats}, back=n - 1
    )
    return out.dropna(subset=[f"{s}_{n}" for s in stats]) if drop else out


def rolling_time(df: DataFrame, axis: Axis, value: str, seconds: int) -> DataFrame:
    """Mean, deviation, sum and extremes over the last ``seconds`` (left-open)."""
    fns = {"mean": F.avg, "std": F.stddev_samp, "sum": F.sum, "min": F.min, "max": F.max, "count": F.count}
    return over_time(df, axis, seconds, lambda w: {f"time_{k}": f(value).over(w) for k, f in fns.items()})


def rolling_zscore(df: DataFrame, axis: Axis, value: str = "close", n: int = 20) -> DataFrame:
    def cols(w):
        f = trailing(w, n)
        z = (F.col(value) - F.avg(value).over(f)) / positive(F.stddev_samp(value).over(f))
        return {"zscore": full(z, value, w, n)}

    return over_blocks(df, axis, cols, back=n - 1)


def rolling_pair(df: DataFrame, axis: Axis, x: str, y: str, n: int) -> DataFrame:
    """Rolling covariance, correlation, beta and R² of two aligned columns."""

    def cols(w):
        f = trailing(w, n)
        guard = F.count(F.when(F.col(x).isNotNull() & F.col(y).isNotNull(), 1)).over(f) == n
        cov, corr = F.covar_samp(x, y).over(f), F.corr(x, y).over(f)
        return {
            "cov": F.when(guard, cov),
            "corr": F.when(guard, corr),
            "beta": F.when(guard, cov / positive(F.var_samp(y).over(f))),
            "r2": F.when(guard, corr * corr),
        }

    return over_blocks(df, axis, cols, back=n - 1)


def last_rank_pct(values: Column, last: Column) -> Column:
    """Average rank of ``last`` among ``values``, as a share."""
    below = F.size(F.filter(values, lambda v: v < last))
    same = F.size(F.filter(values, lambda v: v == last))
    return (below + (same + 1) / F.lit(2.0)) / F.size(values)


def rolling_rank(df: DataFrame, axis: Axis, value: str, n: int) -> DataFrame:
    def cols(w):
        values = F.collect_list(value).over(trailing(w, n))
        return {"rank_pct": full(last_rank_pct(values, F.col(value)), value, w, n)}

    return over_blocks(df, axis, cols, back=n - 1)


def rolling_slope(df: DataFrame, axis: Axis, value: str, n: int) -> DataFrame:
    """Slope of the least-squares line over the last ``n`` rows, per row."""

    def cols(w):
        slope = F.regr_slope(F.col(value), F.col(POS).cast("double")).over(trailing(w, n))
        return {"slope": full(slope, value, w, n)}

    return over_blocks(df, axis, cols, back=n - 1)


# --- running values -------------------------------------------------------------------------------------------


def compounded(df: DataFrame, axis: Axis, ret: str = "ret", initial: float = 100.0) -> DataFrame:
    """Cumulative return and rebuilt price; missing returns count as zero."""
    out = prefix(df, axis, {"_log": ("sum", F.log1p(F.col(ret)))})
    growth = F.exp(F.coalesce(F.col("_log"), F.lit(0.0)))
    return out.withColumns({"cum_return": growth - 1, "rebuilt": initial * growth}).drop("_log")


def total_return(df: DataFrame, keys: Sequence[str], ret: str = "ret") -> DataFrame:
    return df.groupBy(*keys).agg((F.exp(F.sum(F.log1p(ret))) - 1).alias("total_return"))


def drawdowns(df: DataFrame, axis: Axis, value: str = "close", ahead: bool = False) -> DataFrame:
    """Running peak, drawdown and rows since the peak.  ``ahead`` adds time, value and position of the next row."""
    if ahead:
        ts = axis.order[0]
        cols = lambda w: {"next_ts": F.lead(ts).over(w), "next_value": F.lead(value).over(w)}
        rows = over_blocks(df, axis, cols, ahead=1, keep_pos=True)
    else:
        rows = df if POS in df.columns else number(df, axis)
    rows = prefix(rows, axis, {"_top": ("max", F.struct(F.col(value).alias("v"), F.col(POS).alias("p")))})
    peak = F.col("_top.v")
    return rows.withColumns(
        {
            "peak": peak,
            "peak_pos": F.col("_top.p"),
            "drawdown": (F.col(value) - peak) / F.when(peak > 0, peak).otherwise(1.0),
            "dd_length": F.col(POS) - F.col("_top.p"),
        }
    ).drop("_top")


def drawdown_records(df: DataFrame, axis: Axis, value: str = "close") -> DataFrame:
    """One row per drawdown: start, valley, recovery (null while active), depth and durations in bars."""
    ts = axis.order[0]
    rows = drawdowns(df, axis, value, ahead=True).filter("drawdown < 0")
    low = F.struct(value, POS)
    out = rows.groupBy(*axis.key, "peak_pos").agg(
        F.max("peak").alias("peak_value"),
        F.min(ts).alias("start_ts"),
        F.min_by(ts, low).alias("valley_ts"),
        F.min(value).alias("valley_value"),
        F.max_by("next_ts", POS).alias("recovery_ts"),
        F.max_by("next_value", POS).alias("recovery_value"),
        F.max(-F.col("drawdown")).alias("depth"),
        F.count(F.lit(1)).alias("_n"),
        F.min_by(POS, low).alias("_valley"),
        F.max(POS).alias("_last"),
    )
    done = F.col("recovery_ts").isNotNull()
    return out.withColumns(
        {
            "active": ~done,
            "duration": F.col("_n") + done.cast("int"),
            "decline_duration": F.col("_valley") - F.col("peak_pos"),
            "recovery_duration": F.when(done, F.col("_last") + 1 - F.col("_valley")).otherwise(0),
        }
    ).drop("_n", "_valley", "_last", "peak_pos")


def drawdown_stats(df: DataFrame, axis: Axis, value: str = "close") -> DataFrame:
    """Per series: number of drawdowns, depths, durations, longest recovery."""
    rec = drawdown_records(df, axis, value)
    back = F.when(~F.col("active") & (F.col("valley_value") > 0), F.col("recovery_value") / F.col("valley_value") - 1)
    return rec.groupBy(*axis.key).agg(
        F.count(F.lit(1)).alias("n_drawdowns"),
        F.max("depth").alias("max_depth"),
        F.avg("depth").alias("avg_depth"),
        F.max("duration").alias("max_duration"),
        F.avg("duration").alias("avg_duration"),
        F.max("decline_duration").alias("max_decline"),
        F.max("recovery_duration").alias("max_recovery"),
        F.avg(F.coalesce(back, F.lit(0.0))).alias("avg_recovery_return"),
        F.max(F.when(F.col("active"), F.col("depth")).otherwise(0.0)).alias("active_depth"),
    )


def runs(df: DataFrame, axis: Axis, label: Column) -> DataFrame:
    """Maximal runs of equal non-null ``label``: label, first and last time, rows."""
    ts = axis.order[0]
    rows = df.withColumn("_label", label)
    rows = over_blocks(
        rows, axis, lambda w: {"_new": (~F.col("_label").eqNullSafe(F.lag("_label").over(w))).cast("int")}, back=1
    )
    rows = prefix(rows, axis, {"_run": ("sum", "_new")})
    return (
        rows.filter(F.col("_label").isNotNull())
        .groupBy(*axis.key, "_run")
        .agg(
            F.first("_label").alias("label"),
            F.min(ts).alias("start_ts"),
            F.max(ts).alias("end_ts"),
            F.count(F.lit(1)).alias("length"),
        )
        .withColumnRenamed("_run", "run")
    )


def ranges(df: DataFrame, axis: Axis, mask: Column) -> DataFrame:
    """Maximal stretches where ``mask`` holds."""
    return runs(df, axis, F.coalesce(mask, F.lit(False))).filter("label").drop("label", "run")


def range_stats(df: DataFrame, axis: Axis, mask: Column) -> DataFrame:
    total = df.groupBy(*axis.key).agg(F.count(F.lit(1)).alias("n_rows"))
    stats = ranges(df, axis, mask).groupBy(*axis.key).agg(
        F.count(F.lit(1)).alias("n_ranges"),
        F.avg("length").alias("avg_length"),
        F.max("length").alias("max_length"),
        F.min("length").alias("min_length"),
        F.sum("length").alias("covered"),
    )
    return total.join(stats, list(axis.key), "left").withColumn(
        "coverage_pct", F.coalesce(F.col("covered"), F.lit(0)) / F.col("n_rows") * 100
    )


def streaks(df: DataFrame, axis: Axis, win: Column) -> DataFrame:
    """Longest win and loss streak and the current one (negative for losses)."""
    r = runs(df, axis, win)
    signed = F.when(F.col("label"), F.col("length")).otherwise(-F.col("length"))
    return r.groupBy(*axis.key).agg(
        F.max(F.when(F.col("label"), F.col("length")).otherwise(0)).alias("max_win_streak"),
        F.max(F.when(~F.col("label"), F.col("length")).otherwise(0)).alias("max_loss_streak"),
        F.max_by(signed, "run").alias("current_streak"),
    )


# --- cross-section --------------------------------------------------------------------------------------------


def masked(value: str, mask: Column | None) -> Column:
    return F.col(value) if mask is None else F.when(mask, F.col(value))


def cross_rank(
    df: DataFrame,
    value: str,
    by: Sequence[str] = ("ts",),
    ascending: bool = True,
    method: str = "ordinal",
    mask: Column | None = None,
    tie: str = "symbol",
    out: str = "rank",
) -> DataFrame:
    """Rank of each row in its cross-section.  ``ordinal`` breaks ties by ``tie``; null values get no rank."""
    rows = df.withColumn("_x", masked(value, mask))
    rows = ranking.with_positions(rows, list(by), "_x")
    if method == "ordinal":
        rows = ranking.ordinals(rows, list(by), "_x", [tie], "_place")
        lower = F.col(ranking.BELOW) if ascending else F.col(ranking.SIZE) - F.col(ranking.BELOW) - F.col(ranking.SAME)
        rank = lower + F.col("_place")
    else:
        rank = ranking.rank_column(method, ascending)
    return rows.withColumn(out, rank).drop("_x", "_place", ranking.BELOW, ranking.SAME, ranking.SIZE)


def cross_top(df: DataFrame, value: str, n: int, by: Sequence[str] = ("ts",), bottom: bool = False) -> DataFrame:
    """The ``n`` largest (smallest) rows of each cross-section with their rank, ties by symbol; the others are not ranked."""
    known = df.filter(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    return ranking.top_n(known, by, [F.col(value) if bottom else F.desc(value), F.col("symbol")], n)


def cross_band(df: DataFrame, value: str, low: float, high: float, by: Sequence[str] = ("ts",)) -> DataFrame:
    """Rows whose value lies between two percentiles (0-100) of the cross-section."""
    q = ranking.with_quantiles(df, list(by), value, {"_lo": low / 100, "_hi": high / 100})
    return q.filter(F.col(value).between(F.col("_lo"), F.col("_hi"))).drop("_lo", "_hi")


def cross_quantile(df: DataFrame, value: str, bins: int, by: Sequence[str] = ("ts",), out: str = "bucket") -> DataFrame:
    """Bucket 0 … bins-1 from interpolated quantile edges of the cross-section."""
    edges = ranking.quantile_edges(bins)
    q = ranking.with_quantiles(df, list(by), value, edges)
    return q.withColumn(out, ranking.quantile_bucket(F.col(value), bins)).drop(*edges)


def cross_normalise(
    df: DataFrame,
    value: str,
    by: Sequence[str] = ("ts",),
    epsilon: float = 0.0,
    lower: float = 0.05,
    upper: float = 0.95,
    clip: tuple[float, float] | None = None,
) -> DataFrame:
    """Demeaned, z-scored, winsorised and (with ``clip``) clipped value in its cross-section."""
    stats = {"_m": F.avg(value), "_s": F.stddev_samp(value)}
    rows = whole_by(df, list(by), stats)
    rows = ranking.with_quantiles(rows, list(by), value, {"_lo": lower, "_hi": upper})
    x, s = F.col(value), F.col("_s")
    cols = {
        "demeaned": x - F.col("_m"),
        "cs_zscore": (x - F.col("_m")) / (positive(s) if epsilon == 0 else s + F.lit(epsilon)),
        "winsorised": clamp(x, F.col("_lo"), F.col("_hi")),
    }
    if clip:
        cols["clipped"] = clamp(x, *clip)
    return rows.withColumns(cols).drop("_m", "_s", "_lo", "_hi")


def cross_rank_pct(df: DataFrame, value: str, by: Sequence[str] = ("ts",), out: str = "rank_pct") -> DataFrame:
    """Average rank divided by the number of values, in (0, 1]."""
    rows = ranking.with_positions(df, list(by), value)
    return rows.withColumn(out, ranking.rank_column("average") / F.col(ranking.SIZE)).drop(
        ranking.BELOW, ranking.SAME, ranking.SIZE
    )


# --- fitted normalisers ---------------------------------------------------------------------------------------


class Normaliser:
    """Fit on one frame (a one-row table of parameters), apply to another."""

    def __init__(self, columns: Sequence[str]):
        self.columns = list(columns)
        self.params: DataFrame | None = None

    def fit(self, df: DataFrame) -> "Normaliser":
        return self

    def expr(self, c: str) -> Column:
        raise NotImplementedError

    def transform(self, df: DataFrame) -> DataFrame:
        rows = df if self.params is None else df.crossJoin(F.broadcast(self.params))  # params: one row
        out = rows.withColumns({c: self.expr(c) for c in self.columns})
        return out if self.params is None else out.drop(*self.params.columns)

    def _quantiles(self, df: DataFrame, qs: Mapping[str, float], suffix: str = "") -> DataFrame:
        """One row with the wanted quantiles of every column."""
        long = df.unpivot([], [F.col(c).cast("double").alias(c) for c in self.columns], "_c", "_v")
        q = ranking.quantiles(long, ["_c"], "_v", dict(qs))
        return q.agg(
            *[F.max(F.when(F.col("_c") == c, F.col(n))).alias(f"_{n}_{c}{suffix}") for c in self.columns for n in qs]
        )


class MinMax(Normaliser):
    def fit(self, df):
        self.params = df.agg(*[f(c).alias(f"_{f.__name__}_{c}") for c in self.columns for f in (F.min, F.max)])
        return self

    def expr(self, c):
        span = F.col(f"_max_{c}") - F.col(f"_min_{c}")
        return (F.col(c) - F.col(f"_min_{c}")) / F.when(span == 0, 1.0).otherwise(span)


class ZScore(Normaliser):
    def fit(self, df):
        self.params = df.agg(
            *[F.avg(c).alias(f"_m_{c}") for c in self.columns], *[F.stddev_samp(c).alias(f"_s_{c}") for c in self.columns]
        )
        return self

    def expr(self, c):
        s = F.col(f"_s_{c}")
        return (F.col(c) - F.col(f"_m_{c}")) / F.when(s == 0, 1.0).otherwise(s)


class RobustZScore(Normaliser):
    """Median and 1.4826 * MAD, clipped."""

    def __init__(self, columns, clip: float | None = 3.0):
        super().__init__(columns)
        self.clip = clip

    def fit(self, df):
        medians = self._quantiles(df, {"med": 0.5})
        apart = df.crossJoin(F.broadcast(medians)).select(  # one row
            *[F.abs(F.col(c) - F.col(f"_med_{c}")).alias(c) for c in self.columns]
        )
        self.params = medians.crossJoin(self._quantiles(apart, {"mad": 0.5}))  # one row each
        return self

    def expr(self, c):
        mad = F.col(f"_mad_{c}")
        z = (F.col(c) - F.col(f"_med_{c}")) / (1.4826 * F.when(mad == 0, 1.0).otherwise(mad))
        return z if self.clip is None else clamp(z, -self.clip, self.clip)


class Tanh(Normaliser):
    def __init__(self, columns, scale: float = 1.0):
        super().__init__(columns)
        self.scale = scale

    def expr(self, c):
        return F.tanh(F.col(c) / self.scale) * self.scale


class Winsorize(Normaliser):
    def __init__(self, columns, lower: float = 0.01, upper: float = 0.99):
        super().__init__(columns)
        self.lower, self.upper = lower, upper

    def fit(self, df):
        self.params = self._quantiles(df, {"lo": self.lower, "hi": self.upper})
        return self

    def expr(self, c):
        return clamp(F.col(c), F.col(f"_lo_{c}"), F.col(f"_hi_{c}"))


class Processors:
    """Chain of normalisers: each is fitted on the output of the one before."""

    def __init__(self, steps: Sequence[Normaliser]):
        self.steps = list(steps)

    def fit(self, df: DataFrame) -> "Processors":
        for s in self.steps:
            df = s.fit(df).transform(df)
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        for s in self.steps:
            df = s.transform(df)
        return df


def scale_entities(df: DataFrame, entity: str, value: str, method: str = "standard") -> DataFrame:
    """Scale per entity: ``standard`` (mean, std), ``minmax`` or ``robust`` (median, IQR)."""
    x = F.col(value)
    if method == "standard":
        rows = whole_by(df, [entity], {"_a": F.avg(value), "_b": F.stddev_samp(value)})
        out = (x - F.col("_a")) / positive(F.col("_b"))
    elif method == "minmax":
        rows = whole_by(df, [entity], {"_a": F.min(value), "_b": F.max(value)})
        out = (x - F.col("_a")) / positive(F.col("_b") - F.col("_a"))
    else:
        rows = ranking.with_quantiles(df, [entity], value, {"_a": 0.5, "_b": 0.25, "_c": 0.75})
        out = (x - F.col("_a")) / positive(F.col("_c") - F.col("_b"))
    return rows.withColumn("scaled", out).drop("_a", "_b", "_c")


# --- gaps ------------------------------------------------------------------------------------------------------


def fill_forward(df: DataFrame, axis: Axis, value: str, out: str | None = None) -> DataFrame:
    return prefix(df, axis, {out or value: ("last", value)})


def fill_backward(df: DataFrame, axis: Axis, value: str, out: str | None = None) -> DataFrame:
    return prefix(df, axis, {out or value: ("last", value)}, backward=True)


def interpolate(
    df: DataFrame, axis: Axis, value: str, out: str, limit: int | None = None, fill_tail: bool = False
) -> DataFrame:
    """Linear interpolation by row position between known values.

    ``limit`` fills at most that many rows of a gap; ``fill_tail`` repeats the last known value at the end.
    """
    rows = number(df, axis)
    known = F.when(F.col(value).isNotNull(), F.struct(F.col(value).cast("double").alias("v"), F.col(POS).alias("p")))
    rows = prefix(rows, axis, {"_prev": ("last", known)})
    rows = prefix(rows, axis, {"_next": ("last", known)}, backward=True)
    v0, p0, v1, p1 = F.col("_prev.v"), F.col("_prev.p"), F.col("_next.v"), F.col("_next.p")
    line = v0 + (v1 - v0) * (F.col(POS) - p0) / positive(p1 - p0)
    if fill_tail:
        line = F.coalesce(line, F.when(v1.isNull(), v0))
    if limit is not None:
        line = F.when(F.col(POS) - p0 <= limit, line)
    return rows.withColumn(out, F.coalesce(F.col(value).cast("double"), line)).drop("_prev", "_next", POS)


def impute(df: DataFrame, axis: Axis, value: str, method: str, out: str = "filled") -> DataFrame:
    """``forward``, ``backward``, ``mean``, ``zero`` or ``linear`` filling of null values per series."""
    if method == "forward":
        return fill_forward(df, axis, value, out)
    if method == "backward":
        return fill_backward(df, axis, value, out)
    if method == "mean":
        return whole_by(df, list(axis.key), {"_m": F.avg(value)}).withColumn(out, F.coalesce(value, "_m")).drop("_m")
    if method == "zero":
        return df.withColumn(out, F.coalesce(F.col(value), F.lit(0.0)))
    return interpolate(df, axis, value, out)


# --- positions -------------------------------------------------------------------------------------------------


def with_length(df: DataFrame, axis: Axis, out: str = "n_rows") -> DataFrame:
    """Position and number of rows of the series."""
    return number(df, axis, length=out)


def head(df: DataFrame, axis: Axis, n: int) -> DataFrame:
    return number(df, axis).filter(F.col(POS) <= n).drop(POS)


def tail(df: DataFrame, axis: Axis, n: int) -> DataFrame:
    return with_length(df, axis).filter(F.col(POS) > F.col("n_rows") - n).drop(POS, "n_rows")


def nth(df: DataFrame, axis: Axis, n: int) -> DataFrame:
    return number(df, axis).filter(F.col(POS) == n).drop(POS)


def last_value(df: DataFrame, axis: Axis, value: str) -> DataFrame:
    """Last non-null value per series."""
    at = F.when(F.col(value).isNotNull(), F.struct(*axis.order))
    return df.groupBy(*axis.key).agg(F.max_by(value, at).alias("last_value"))


def rebase(df: DataFrame, axis: Axis, value: str = "close", base: float = 100.0) -> DataFrame:
    """Series scaled to ``base`` at its first observation."""
    at = F.when(F.col(value).isNotNull(), F.struct(*axis.order))
    rows = whole(df, axis, {"_first": F.min_by(value, at)})
    return rows.withColumn("rebased", F.col(value) / positive(F.col("_first")) * base).drop("_first")


# Look-back periods in bars.
LOOKBACKS = {"1m": 21, "3m": 63, "6m": 126, "1y": 252, "2y": 504, "3y": 756, "5y": 1260, "10y": 2520}


def lookback_returns(df: DataFrame, axis: Axis, value: str = "close", periods: Sequence[str] = ("1m", "3m", "6m", "1y")) -> DataFrame:
    """Return over the last n prices of each series, only where it is long enough."""
    rows = with_length(df, axis)
    n = F.col("n_rows")
    cols = []
    for p in periods:
        k = LOOKBACKS[p]
        start = F.max(F.when((n >= k) & (F.col(POS) == n - k + 1), F.col(value)))
        cols.append((F.max(F.when(F.col(POS) == n, F.col(value))) / start - 1).alias(p))
    return rows.groupBy(*axis.key).agg(*cols)


def relative_performance(pair: DataFrame, keys: Sequence[str], asset: str, bench: str, ts: str = "ts", axis: Axis = HOURLY) -> DataFrame:
    """Total return, CAGR, tracking error, information ratio, correlation and beta against a benchmark price."""
    rows = over_blocks(
        pair, axis, lambda w: {"_ra": pct_change(w, asset), "_rb": pct_change(w, bench), "_first": F.lag(ts).over(w).isNull()}, back=1
    )
    diff = F.col("_ra") - F.col("_rb")
    years = F.datediff(F.max(ts), F.min(ts)) / 365.25
    start_a, end_a = F.min_by(asset, ts), F.max_by(asset, ts)
    start_b, end_b = F.min_by(bench, ts), F.max_by(bench, ts)
    out = rows.groupBy(*keys).agg(
        (end_a / start_a - 1).alias("total_asset"),
        (end_b / start_b - 1).alias("total_bench"),
        F.when(years > 0, F.pow(end_a / start_a, 1 / years) - 1).alias("cagr_asset"),
        F.when(years > 0, F.pow(end_b / start_b, 1 / years) - 1).alias("cagr_bench"),
        (F.avg(diff) / positive(F.stddev_samp(diff))).alias("information_ratio"),
        (F.stddev_samp(diff) * math.sqrt(YEAR)).alias("tracking_error"),
        F.corr("_ra", "_rb").alias("correlation"),
        (F.covar_samp("_ra", "_rb") / positive(F.var_samp("_rb"))).alias("beta"),
    )
    return out.withColumn("excess_cagr", F.col("cagr_asset") - F.col("cagr_bench"))


# --- rolling risk ------------------------------------------------------------------------------------------------


def window_drawdown(values: Column) -> Column:
    """Lowest drawdown (≤ 0) inside an array of values."""
    start = F.struct(F.get(values, 0).alias("peak"), F.lit(0.0).alias("low"))

    def step(acc, v):
        peak = F.greatest(acc["peak"], v)
        dd = F.when(peak > 0, (v - peak) / peak).otherwise(0.0)
        return F.struct(peak.alias("peak"), F.least(acc["low"], dd).alias("low"))

    return F.aggregate(values, start, step, lambda acc: acc["low"])


def rolling_risk(df: DataFrame, axis: Axis, ret: str, n: int, bench: str | None = None, year: int = YEAR) -> DataFrame:
    """Rolling Sharpe, volatility, Sortino, Calmar, Omega, downside risk, drawdown and (with a benchmark)
    information ratio; 0 until the frame is full."""
    root = math.sqrt(year)

    def cols(w):
        f = trailing(w, n)
        x = F.col(ret)
        mean, sd = F.avg(x).over(f), F.stddev_samp(x).over(f)
        down = F.sqrt(F.avg(F.when(x < 0, x * x).otherwise(F.when(x.isNotNull(), 0.0))).over(f))
        gains = F.sum(F.when(x > 0, x).otherwise(0.0)).over(f)
        losses = -F.sum(F.when(x < 0, x).otherwise(0.0)).over(f)
        growth = F.collect_list(1 + x).over(f)
        path = F.aggregate(
            growth,
            F.struct(F.lit(1.0).alias("v"), F.lit(None).cast("double").alias("first"), F.lit(0.0).alias("peak"), F.lit(0.0).alias("low")),
            lambda a, g: F.struct(
                (a["v"] * g).alias("v"),
                F.coalesce(a["first"], a["v"] * g).alias("first"),
                F.greatest(a["peak"], a["v"] * g).alias("peak"),
                F.least(a["low"], a["v"] * g / F.greatest(a["peak"], a["v"] * g) - 1).alias("low"),
            ),
        )
        out = {
            "roll_vol": full(sd * root, x, w, n),
            "roll_sharpe": F.coalesce(full(mean * year / positive(sd * root), x, w, n), F.lit(0.0)),
            "roll_sortino": F.coalesce(full(mean * year / positive(down * root), x, w, n), F.lit(0.0)),
            "roll_omega": F.coalesce(full(F.when(losses > 1e-10, gains / losses).otherwise(99.0), x, w, n), F.lit(0.0)),
            "roll_downside": full(down * root, x, w, n),
            "_path": path,
        }
        if bench:
            a = x - F.col(bench)
            out["roll_ir"] = F.coalesce(
                full(F.avg(a).over(f) * year / positive(F.stddev_samp(a).over(f) * root), a, w, n), F.lit(0.0)
            )
        return out

    def calmar(w):
        p = F.col("_path")
        low = F.abs(p["low"])
        growth = F.pow(p["v"] / p["first"], F.lit(year / n)) - 1
        return {
            "roll_drawdown": full(p["low"], ret, w, n),
            "roll_calmar": F.coalesce(full(F.when(low < 1e-10, 0.0).otherwise(growth / low), ret, w, n), F.lit(0.0)),
        }

    return over_blocks(df, axis, [cols, calmar], back=n - 1).drop("_path")


# --- spikes, ramps, seasons -----------------------------------------------------------------------------------


def smooth_spikes(df: DataFrame, axis: Axis, value: str, threshold: float = 3.0, method: str = "clip") -> DataFrame:
    """Clip values beyond ``threshold`` deviations, or interpolate over them."""
    rows = whole(df, axis, {"_m": F.avg(value), "_s": F.stddev_samp(value)})
    x, m, s = F.col(value), F.col("_m"), F.col("_s")
    if method == "clip":
        out = clamp(x, m - threshold * s, m + threshold * s)
        return rows.withColumn("smoothed", out).drop("_m", "_s")
    rows = rows.withColumn("_kept", F.when((s == 0) | (F.abs(x - m) <= threshold * s), x)).drop("_m", "_s")
    return interpolate(rows, axis, "_kept", "smoothed", fill_tail=True).drop("_kept")


def ramp(df: DataFrame, axis: Axis, value: str, up: int = 5, down: int = 5) -> DataFrame:
    """Scale from 0 to 1 over the first ``up`` rows and back over the last ``down``."""
    rows = with_length(df, axis)
    factor = F.when(F.col(POS) <= up, F.col(POS) / F.lit(up)).otherwise(1.0)
    left = F.col("n_rows") - F.col(POS) + 1
    factor = F.when(left <= down, F.least(factor, left / F.lit(down))).otherwise(factor)
    return rows.withColumn("ramped", F.col(value) * factor).drop(POS, "n_rows")


def seasonal_adjust(df: DataFrame, axis: Axis, value: str, period: int) -> DataFrame:
    """Value minus the mean of its position in the period plus the overall mean."""
    rows = number(df, axis).withColumn("_phase", (F.col(POS) - 1) % period)
    rows = whole_by(rows, [*axis.key, "_phase"], {"_pm": F.avg(value)})
    rows = whole_by(rows, list(axis.key), {"_m": F.avg(value)})
    return rows.withColumn("adjusted", F.col(value) - F.col("_pm") + F.col("_m")).drop(POS, "_phase", "_pm", "_m")


# --- randomness tests ------------------------------------------------------------------------------------------


def two_sided(z: Column) -> Column:
    return 2 * (1 - normal_cdf(F.abs(z)))


def runs_test(df: DataFrame, axis: Axis, value: str) -> DataFrame:
    """Runs above / below the median: count, expectation, z and two-sided normal p-value."""
    rows = ranking.with_quantiles(df.filter(F.col(value).isNotNull()), list(axis.key), value, {"_med": 0.5})
    rows = rows.withColumn("_up", (F.col(value) > F.col("_med")).cast("int"))
    rows = over_blocks(rows, axis, lambda w: {"_turn": (F.col("_up") != F.lag("_up").over(w)).cast("int")}, back=1)
    out = rows.groupBy(*axis.key).agg(
        (F.coalesce(F.sum("_turn"), F.lit(0)) + 1).alias("runs"),
        F.sum("_up").cast("double").alias("n1"),
        F.count(F.lit(1)).cast("double").alias("n"),
    )
    n1, n = F.col("n1"), F.col("n")
    n2 = n - n1
    expected = 2 * n1 * n2 / n + 1
    variance = 2 * n1 * n2 * (2 * n1 * n2 - n) / (n * n * (n - 1))
    out = out.withColumns({"expected_runs": expected, "z": F.when(variance > 0, (F.col("runs") - expected) / F.sqrt(variance)).otherwise(0.0)})
    return out.withColumn("p_value", F.when(F.col("z") == 0, 1.0).otherwise(two_sided(F.col("z")))).drop("n1")


def autocorrelation(df: DataFrame, axis: Axis, value: str, at: Sequence[int] = (1, 5, 10, 20)) -> DataFrame:
    """Autocorrelation at lags with n·r² tested against chi-square with one degree of freedom."""
    rows = over_blocks(df, axis, lambda w: {f"_l{k}": F.lag(value, k).over(w) for k in at}, back=max(at))
    wide = rows.groupBy(*axis.key).agg(
        F.count(value).alias("n"), *[F.corr(value, f"_l{k}").alias(str(k)) for k in at]
    )
    out = wide.unpivot([*axis.key, "n"], [str(k) for k in at], "lag", "autocorr")
    out = out.withColumn("lag", F.col("lag").cast("int")).filter("n > lag")
    return out.withColumn("p_value", two_sided(F.sqrt(F.col("n") * F.col("autocorr") * F.col("autocorr"))))


def variance_ratio(df: DataFrame, axis: Axis, value: str, periods: Sequence[int] = (2, 4, 8, 16)) -> DataFrame:
    """Variance of k-step sums over k times the variance, with its z and p-value; series of at least 10·k rows."""
    rows = over_blocks(
        df.filter(F.col(value).isNotNull()),
        axis,
        lambda w: {f"_s{k}": full(F.sum(value).over(trailing(w, k)), value, w, k) for k in periods},
        back=max(periods) - 1,
    )
    wide = rows.groupBy(*axis.key).agg(
        F.count(value).alias("n"), *[(F.var_samp(f"_s{k}") / (k * F.var_samp(value))).alias(str(k)) for k in periods]
    )
    out = wide.unpivot([*axis.key, "n"], [str(k) for k in periods], "period", "ratio")
    out = out.withColumn("period", F.col("period").cast("int")).filter("n >= period * 10")
    z = F.sqrt(F.col("n")) * (F.col("ratio") - 1) / F.sqrt(2 * (F.col("period") - 1))
    return out.withColumn("z", z).withColumn("p_value", two_sided(F.col("z")))


# --- term structures -------------------------------------------------------------------------------------------


def forward_vol(df: DataFrame, axis: Axis, ret: str, tenors: Sequence[int] = (21, 63, 126, 252), year: int = YEAR) -> DataFrame:
    """Realised and forward volatility / variance by look-back tenor."""
    rows = with_length(df.filter(F.col(ret).isNotNull()), axis)
    n = F.col("n_rows")
    tenors = sorted(tenors)
    wide = rows.groupBy(*axis.key).agg(
        *[
            (F.var_samp(F.when((n >= t) & (F.col(POS) > n - t), F.col(ret))) * year).alias(str(t))
            for t in tenors
        ]
    )
    out = wide.unpivot(list(axis.key), [str(t) for t in tenors], "tenor", "realized_var")
    out = out.withColumn("tenor", F.col("tenor").cast("int"))
    w = Window.partitionBy(*axis.key).orderBy("tenor")  # one row per tenor
    t1, v1 = F.lag("tenor").over(w), F.lag("realized_var").over(w)
    fwd = (F.col("realized_var") * F.col("tenor") - v1 * t1) / (F.col("tenor") - t1)
    out = out.withColumn("forward_var", F.when(fwd.isNotNull(), F.greatest(fwd, F.lit(0.0))))
    return out.withColumns({"realized_vol": F.sqrt("realized_var"), "forward_vol": F.sqrt("forward_var")})


def swap_strikes(df: DataFrame, axis: Axis, x: str, y: str, days: int, zero_mean: bool = True, year: int = YEAR) -> DataFrame:
    """Rolling volatility of ``x`` and correlation of ``x`` and ``y`` from log returns of ``days`` prices."""
    n = days - 1

    def rets(w):
        return {f"_{c}": F.log(F.col(c) / F.lag(c).over(w)) for c in {x, y}}

    def cols(w):
        f, a, b = trailing(w, n), F.col(f"_{x}"), F.col(f"_{y}")
        if zero_mean:
            vol = F.sqrt(F.avg(a * a).over(f) * year)
            corr = F.sum(a * b).over(f) / positive(F.sqrt(F.sum(a * a).over(f) * F.sum(b * b).over(f)))
        else:
            vol, corr = F.stddev_samp(a).over(f) * math.sqrt(year), F.corr(a, b).over(f)
        return {"vol_swap": full(vol, a, w, n), "corr_swap": full(corr, a * b, w, n)}

    return over_blocks(df, axis, [rets, cols], back=days).drop(f"_{x}", f"_{y}")


def ewm_volatility(df: DataFrame, axis: Axis, value: str, span: int = 20, annualize: bool = True, year: int = YEAR) -> DataFrame:
    """Exponentially weighted, bias-corrected deviation of ``value`` (a return or a spread)."""
    out = smoothed(df, axis, [("ewm_std", value, span_alpha(span), "std")])
    return out.withColumn("ewm_vol", F.col("ewm_std") * (math.sqrt(year) if annualize else 1.0))


# --- trailing-window factors ------------------------------------------------------------------------------------


def trailing_factors(df: DataFrame, axis: Axis, n: int = 21, weight: str = "volume", value: str = "close", year: int = YEAR) -> DataFrame:
    """n-day return, drawdown, annualised volatility and weighted average over a window of n rows, and the number
    of symbols with a value at the same time."""

    def cols(w):
        f = trailing(w, n)
        inner = w.rowsBetween(-(n - 2), 0)
        first = F.lag(value, n - 1).over(w)
        total = F.sum(weight).over(f)
        return {
            "returns_n": (F.col(value) - first) / first,
            "max_drawdown": full(window_drawdown(F.collect_list(value).over(f)), value, w, n),
            "ann_vol": full(F.stddev_samp("_r").over(inner) * math.sqrt(year), value, w, n),
            "weighted_avg": full(F.when(total > 0, F.sum(F.col(value) * F.col(weight)).over(f) / total).otherwise(0.0), value, w, n),
        }

    out = over_blocks(df, axis, [lambda w: {"_r": pct_change(w, value)}, cols], back=n).drop("_r")
    return whole_by(out, [axis.order[0]], {"peers": F.count(value)})


def rolling_apply(df: DataFrame, axis: Axis, value: str, n: int, fn: Callable[[Column], Column], out: str) -> DataFrame:
    """A column function of the array of the last ``n`` values."""
    return over_blocks(
        df, axis, lambda w: {out: full(fn(F.collect_list(value).over(trailing(w, n))), value, w, n)}, back=n - 1
    )
