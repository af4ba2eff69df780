"""Panel time-series queries."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick import fixtures as fx
from candlewick.functions.stats import chi2_p_sql, normal_cdf_sql, t_p_sql
from candlewick.operators import joins
from candlewick.operators import panel as ops
from candlewick.operators.series import HOURLY
from candlewick.operators.windows import two_sided
from candlewick.plans.indicators import wn
from candlewick.plans.registry import near, query, r, rs
from candlewick.plans.sql import DAILY as DAILY_SQL
from candlewick.plans.sql import HOURLY as HOURLY_SQL
from candlewick.plans.sql import RETURNS, ewm, with_
from candlewick.plans.windows import PAIR_SQL, pair, returns

E = "PARTITION BY entity_id ORDER BY time"
PANEL_SQL = 'p AS (SELECT symbol AS entity_id, ts AS time, close AS value, row_number() OVER (PARTITION BY symbol ORDER BY ts) AS rn, count(*) OVER (PARTITION BY symbol) AS n FROM bars)'


def panel(spark, sf):
    return ops.to_panel(fx.hourly(spark, sf))


@query(
    "zscore_anomalies", "P1",
    with_(HOURLY_SQL, PANEL_SQL, "z AS (SELECT *, (value - avg(value) OVER (PARTITION BY entity_id)) / stddev_pop(value) OVER (PARTITION BY entity_id) AS z FROM p)", f"SELECT entity_id, time, value, {r('z')} AS zscore, abs(z) > 3 AS is_anomaly, CASE WHEN z > 3 THEN 'high' WHEN z < -3 THEN 'low' END AS anomaly_type FROM z"),
)
def zscore_anomalies(spark, sf):
    return near(ops.zscore_anomalies(panel(spark, sf)), "zscore")


@query(
    "zscore_anomalies_rolling", "P1",
    with_(
        HOURLY_SQL, PANEL_SQL, f"z AS (SELECT *, avg(value) OVER ({E} ROWS 23 PRECEDING) AS m, stddev_pop(value) OVER ({E} ROWS 23 PRECEDING) AS s FROM p)",
        f"SELECT entity_id, time, value, CASE WHEN s > 0 THEN {r('(value - m) / s')} ELSE 0 END AS zscore, coalesce(s > 0 AND abs((value - m) / s) > 2, false) AS is_anomaly, CASE WHEN s > 0 AND (value - m) / s > 2 THEN 'high' WHEN s > 0 AND (value - m) / s < -2 THEN 'low' END AS anomaly_type FROM z",
    ),
)
def zscore_anomalies_rolling(spark, sf):
    return near(ops.zscore_anomalies(panel(spark, sf), 2.0, 24), "zscore")


@query(
    "iqr_anomalies", "P2",
    with_(
        HOURLY_SQL, PANEL_SQL,
        f"g AS (SELECT entity_id, quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b FROM p GROUP BY entity_id), w AS (SELECT *, quantile_cont(value, 0.25) OVER ({E} ROWS 24 PRECEDING) AS a, quantile_cont(value, 0.75) OVER ({E} ROWS 24 PRECEDING) AS b FROM p)",
        f"""SELECT p.entity_id, time, 'global' AS scope, {r('a - 1.5 * (b - a)')} AS lower_bound, {r('b + 1.5 * (b - a)')} AS upper_bound, value > b + 1.5 * (b - a) OR value < a - 1.5 * (b - a) AS is_anomaly FROM p JOIN g ON p.entity_id = g.entity_id
UNION ALL SELECT entity_id, time, 'rolling', {r('a - 1.5 * (b - a)')}, {r('b + 1.5 * (b - a)')}, value > b + 1.5 * (b - a) OR value < a - 1.5 * (b - a) FROM w""",
    ),
)
def iqr_anomalies(spark, sf):
    y = panel(spark, sf)
    both = [ops.iqr_anomalies(y, window=w).withColumn("scope", F.lit(n)) for n, w in (("global", None), ("rolling", 24))]
    cols = ["entity_id", "time", "scope", "lower_bound", "upper_bound", "is_anomaly"]
    return near(both[0].select(*cols).unionByName(both[1].select(*cols)), "lower_bound", "upper_bound")


@query("grubbs_anomalies", "P3")
def grubbs_anomalies(spark, sf):
    return near(ops.grubbs_anomalies(panel(spark, sf)), "g_stat", "critical_value")


@query(
    "residual_anomalies", "P4",
    with_(
        HOURLY_SQL, PANEL_SQL, f"f AS (SELECT *, lag(value) OVER ({E}) AS pr FROM p), d AS (SELECT *, value - pr AS res FROM f WHERE pr IS NOT NULL), z AS (SELECT *, (res - avg(res) OVER (PARTITION BY entity_id)) / stddev_pop(res) OVER (PARTITION BY entity_id) AS z FROM d)",
        f"SELECT entity_id, time, value AS actual, pr AS predicted, {r('res')} AS residual, {r('z')} AS residual_zscore, abs(z) > 3 AS is_anomaly FROM z",
    ),
)
def residual_anomalies(spark, sf):
    y = panel(spark, sf)
    naive = ops.over_blocks(y, ops.PANEL, lambda w: {"_p": F.lag("value").over(w)}, back=1).filter("_p IS NOT NULL").select("entity_id", "time", F.col("_p").alias("value"))
    return near(ops.residual_anomalies(y, naive), "residual", "residual_zscore")


@query(
    "change_points", "P4",
    with_(
        HOURLY_SQL, PANEL_SQL, "z AS (SELECT *, (value - avg(value) OVER (PARTITION BY entity_id)) / stddev_pop(value) OVER (PARTITION BY entity_id) AS z FROM p)",
        f"c AS (SELECT *, sum(CASE WHEN rn > 1 THEN z - 0.5 ELSE 0 END) OVER ({E}) AS cu, sum(CASE WHEN rn > 1 THEN z + 0.5 ELSE 0 END) OVER ({E}) AS cd FROM z), s AS (SELECT *, cu - min(cu) OVER ({E}) AS sp, cd - max(cd) OVER ({E}) AS sn FROM c)",
        f"SELECT entity_id, time, value, {r('sp')} AS s_pos, {r('sn')} AS s_neg, sp > 5 OR sn < -5 AS is_change_point FROM s",
    ),
)
def change_points(spark, sf):
    return near(ops.change_points(panel(spark, sf)), "s_pos", "s_neg")


@query("local_outliers", "P5")
def local_outliers(spark, sf):
    return near(ops.local_outliers(panel(spark, sf), block=512), "lof_score")


@query("isolation_outliers", "P5")
def isolation_outliers(spark, sf):
    return near(ops.isolation_outliers(panel(spark, sf), trees=20), "anomaly_score")


DET = "fit AS (SELECT entity_id, regr_slope(value, rn) AS b, regr_intercept(value, rn) AS a FROM p GROUP BY entity_id), d AS (SELECT p.entity_id, time, rn, n, value - a - b * rn AS d FROM p JOIN fit ON p.entity_id = fit.entity_id)"
ACF = f"lg AS (SELECT x.entity_id, k AS lag, sum(x.d * y.d) AS s, any_value(x.n) AS n FROM d x, (SELECT unnest(generate_series(1, 48)) AS k), d y WHERE x.entity_id = y.entity_id AND y.rn = x.rn - k GROUP BY ALL), v AS (SELECT entity_id, sum(d * d) AS v FROM d GROUP BY entity_id), ac AS (SELECT lg.entity_id, CAST(lag AS INTEGER) AS lag, s / v AS acf FROM lg JOIN v ON lg.entity_id = v.entity_id WHERE lag <= n // 2)"


@query("autocorrelation_function", "P6", with_(HOURLY_SQL, PANEL_SQL, DET, ACF, f"SELECT entity_id, lag, {rs('acf')} FROM ac"))
def autocorrelation_function(spark, sf):
    return near(ops.acf(panel(spark, sf), 48), "acf")


def seasonal(spark, sf):
    """Hourly event counts with a daily wave, per event type."""
    t = fx.ticks(spark, sf).groupBy(F.col("symbol").alias("entity_id"), F.date_trunc("hour", "ts").alias("time")).agg(F.count(F.lit(1)).alias("c"))
    return t.select("entity_id", "time", (F.col("c") + 4 * F.sin(F.hour("time") * 2 * 3.141592653589793 / 24)).alias("value"))


SEASONAL_SQL = "cn AS (SELECT symbol AS entity_id, date_trunc('hour', t.ts) AS time, count(*) AS c FROM ticks t GROUP BY ALL), p AS (SELECT entity_id, time, c + 4 * sin(hour(time) * 2 * 3.141592653589793 / 24) AS value, row_number() OVER (PARTITION BY entity_id ORDER BY time) AS rn, count(*) OVER (PARTITION BY entity_id) AS n FROM cn)"


@query(
    "seasonal_period", "P6",
    with_(
        HOURLY_SQL, SEASONAL_SQL, DET, ACF, "q AS (SELECT *, lag(acf) OVER (PARTITION BY entity_id ORDER BY lag) AS a, lead(acf) OVER (PARTITION BY entity_id ORDER BY lag) AS b FROM ac)",
        f"SELECT entity_id, min(lag) FILTER (acf > a AND acf > b AND acf >= 0.1) AS period, {r('arg_min(acf, lag) FILTER (acf > a AND acf > b AND acf >= 0.1)')} AS strength FROM q GROUP BY entity_id",
    ),
)
def seasonal_period(spark, sf):
    return near(ops.seasonal_period_acf(seasonal(spark, sf)), "strength")


PERIODS = "pd AS (SELECT unnest(generate_series(2, 48)) AS period), pg AS (SELECT entity_id, CAST(period AS INTEGER) AS period, sqrt(power(sum(d * cos(rn * 2 * pi() / period)), 2) + power(sum(d * sin(rn * 2 * pi() / period)), 2)) AS amplitude FROM d, pd WHERE period <= n // 2 GROUP BY ALL)"


@query("periodogram", "P6", with_(HOURLY_SQL, SEASONAL_SQL, DET, PERIODS, f"SELECT entity_id, period, {rs('amplitude', digits=4)} FROM pg"))
def periodogram(spark, sf):
    return near(ops.periodogram(seasonal(spark, sf)), "amplitude", digits=4)


@query(
    "seasonal_period_spectrum", "P6",
    with_(HOURLY_SQL, SEASONAL_SQL, DET, PERIODS, f"SELECT entity_id, arg_max(period, (amplitude, -period)) AS period, {r('least(max(amplitude) / avg(amplitude) / 10, 1)')} AS strength FROM pg GROUP BY entity_id"),
)
def seasonal_period_spectrum(spark, sf):
    return near(ops.seasonal_period_spectrum(seasonal(spark, sf)), "strength")


DEC = f"""tr AS (SELECT *, CASE WHEN count(*) OVER ({E} ROWS BETWEEN 12 PRECEDING AND 12 FOLLOWING) = 25 THEN (sum(value) OVER ({E} ROWS BETWEEN 12 PRECEDING AND 12 FOLLOWING) - (lag(value, 12) OVER ({E}) + lead(value, 12) OVER ({E})) / 2) / 24 END AS trend FROM p),
ph AS (SELECT entity_id, (rn - 1) % 24 AS ph, avg(value - trend) AS pm FROM tr GROUP BY ALL), sc AS (SELECT *, pm - avg(pm) OVER (PARTITION BY entity_id) AS seasonal FROM ph),
dc AS (SELECT tr.entity_id, time, value, trend, seasonal, value - trend - seasonal AS residual, value - seasonal AS adjusted FROM tr JOIN sc ON tr.entity_id = sc.entity_id AND (rn - 1) % 24 = ph)"""


@query("decompose", "P7", with_(HOURLY_SQL, SEASONAL_SQL, DEC, f"SELECT entity_id, time, {rs('value', 'trend', 'seasonal', 'residual', 'adjusted')} FROM dc"))
def decompose(spark, sf):
    return near(ops.decompose(seasonal(spark, sf), 24), "value", "trend", "seasonal", "residual", "adjusted")


@query(
    "seasonal_strength", "P7",
    with_(
        HOURLY_SQL, SEASONAL_SQL, DEC,
        "s AS (SELECT entity_id, var_pop(residual) AS rv, var_pop(seasonal) FILTER (residual IS NOT NULL) AS sv, var_pop(trend) FILTER (residual IS NOT NULL) AS tv FROM dc GROUP BY entity_id)",
        f"SELECT entity_id, {r('greatest(1 - rv / (sv + rv), 0)')} AS seasonal_strength, {r('greatest(1 - rv / (tv + rv), 0)')} AS trend_strength, greatest(1 - rv / (sv + rv), 0) > 0.3 AS is_seasonal, greatest(1 - rv / (tv + rv), 0) > 0.3 AS is_trending FROM s",
    ),
)
def seasonal_strength(spark, sf):
    return near(ops.strengths(ops.decompose(seasonal(spark, sf), 24)), "seasonal_strength", "trend_strength")


_G = ops.kernel("gaussian", sigma=1.5)
_GN = " + ".join(f"coalesce(lag(value, {len(_G) // 2 - i}) OVER ({E}), 0) * {k!r}" for i, k in enumerate(_G))
_GD = " + ".join(f"CASE WHEN lag(value, {len(_G) // 2 - i}) OVER ({E}) IS NOT NULL THEN {k!r} ELSE 0 END" for i, k in enumerate(_G))


@query(
    "smooth_series", "P8",
    with_(
        HOURLY_SQL, PANEL_SQL,
        f"SELECT entity_id, time, {r(f'avg(value) OVER ({E} ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)')} AS convolution, {r(f'({_GN}) / ({_GD})')} AS gaussian, {r(ewm('value', 0.3, order='time', part='entity_id'))} AS exponential, {r('avg(value) OVER (PARTITION BY entity_id, (rn - 1) // 10)')} AS binned FROM p",
    ),
)
def smooth_series(spark, sf):
    y = panel(spark, sf)
    out = ops.smooth_kernel(y, ops.kernel("ones", 5), out="convolution")
    out = ops.smooth_kernel(out, _G, out="gaussian")
    out = ops.smooth_binned(ops.smooth_exponential(out, 0.3, out="exponential"), out="binned")
    return near(out, "convolution", "gaussian", "exponential", "binned").drop("value")


@query(
    "smooth_polynomial", "P8",
    with_(
        HOURLY_SQL, PANEL_SQL, "t AS (SELECT *, (rn - 1) / (n - 1) AS t FROM p), f AS (SELECT entity_id, regr_slope(value, t) AS b, regr_intercept(value, t) AS a FROM t GROUP BY entity_id)",
        f"SELECT t.entity_id, time, {r('a + b * t')} AS smoothed FROM t JOIN f ON t.entity_id = f.entity_id",
    ),
)
def smooth_polynomial(spark, sf):
    return near(ops.smooth_polynomial(panel(spark, sf), 1), "smoothed").drop("value")


@query("smooth_cubic", "P8")
def smooth_cubic(spark, sf):
    return near(ops.smooth_polynomial(panel(spark, sf), 3), "smoothed")


@query(
    "sigma_bands", "P9",
    with_(
        HOURLY_SQL, PANEL_SQL, f"s AS (SELECT *, avg(value) OVER ({E} ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS sm FROM p), b AS (SELECT *, stddev_pop(value - sm) OVER (PARTITION BY entity_id) AS sd FROM s)",
        f"SELECT entity_id, time, {r('sm')} AS smoothed, {r('sm - 2 * sd')} AS lower_bound, {r('sm + 2 * sd')} AS upper_bound, value < sm - 2 * sd OR value > sm + 2 * sd AS is_outlier FROM b",
    ),
)
def sigma_bands(spark, sf):
    out = ops.sigma_bands(ops.smooth_kernel(panel(spark, sf), ops.kernel("ones", 5)))
    return near(out, "smoothed", "lower_bound", "upper_bound").drop("value")


LAST = "ls AS (SELECT entity_id, max(time) AS t, max(time) - max(time) FILTER (rn = n - 1) AS step, arg_max(value, time) AS v FROM p GROUP BY entity_id)"
AR1 = f"l1 AS (SELECT *, lag(value) OVER ({E}) AS x FROM p), ft AS (SELECT entity_id, regr_slope(value, x) AS b, regr_intercept(value, x) AS a FROM l1 GROUP BY entity_id)"


@query(
    "forecast_linear", "P10",
    with_(
        HOURLY_SQL, PANEL_SQL, LAST, AR1, "f1 AS (SELECT ls.entity_id, t, step, a, b, a + b * v AS y1 FROM ls JOIN ft ON ls.entity_id = ft.entity_id), f2 AS (SELECT *, a + b * y1 AS y2 FROM f1)",
        f"SELECT entity_id, 1 AS horizon, t + step AS time, {r('y1')} AS value FROM f2 UNION ALL SELECT entity_id, 2, t + 2 * step, {r('y2')} FROM f2",
    ),
)
def forecast_linear(spark, sf):
    return near(ops.forecast_linear(panel(spark, sf), 2, lags=1), "value")


@query(
    "forecast_ridge", "P10",
    with_(
        HOURLY_SQL, PANEL_SQL, LAST, f"l1 AS (SELECT *, lag(value) OVER ({E}) AS x FROM p), ft AS (SELECT entity_id, (regr_sxy(value, x)) / (regr_sxx(value, x) + 1000) AS b, avg(value) FILTER (x IS NOT NULL) AS my, avg(x) AS mx FROM l1 GROUP BY entity_id)",
        f"SELECT ls.entity_id, 1 AS horizon, t + step AS time, {r('my + b * (v - mx)')} AS value FROM ls JOIN ft ON ls.entity_id = ft.entity_id",
    ),
)
def forecast_ridge(spark, sf):
    return near(ops.forecast_linear(panel(spark, sf), 1, lags=1, ridge=1000.0), "value")


@query("forecast_autoregression", "P10")
def forecast_autoregression(spark, sf):
    return near(ops.forecast_linear(panel(spark, sf), 6, lags=4), "value")


@query(
    "forecast_knn", "P10",
    with_(
        HOURLY_SQL, PANEL_SQL, LAST,
        f"wv AS (SELECT *, lag(value) OVER ({E}) AS v1, lag(value, 2) OVER ({E}) AS v2, lead(value) OVER ({E}) AS a1, lead(value, 2) OVER ({E}) AS a2 FROM p), q AS (SELECT entity_id, value AS q0, v1 AS q1, v2 AS q2 FROM wv WHERE rn = n)",
        "dd AS (SELECT wv.*, power(value - q0, 2) + power(v1 - q1, 2) + power(v2 - q2, 2) AS d FROM wv JOIN q ON wv.entity_id = q.entity_id WHERE v2 IS NOT NULL AND a2 IS NOT NULL), k AS (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY d, time) AS k FROM dd)",
        "m AS (SELECT entity_id, avg(a1) AS y1, avg(a2) AS y2 FROM k WHERE k <= 5 GROUP BY entity_id)",
        f"SELECT m.entity_id, 1 AS horizon, t + step AS time, {r('y1')} AS value FROM m JOIN ls ON m.entity_id = ls.entity_id UNION ALL SELECT m.entity_id, 2, t + 2 * step, {r('y2')} FROM m JOIN ls ON m.entity_id = ls.entity_id",
    ),
)
def forecast_knn(spark, sf):
    return near(ops.forecast_knn(panel(spark, sf), 2), "value")


@query(
    "forecast_smoothing", "P10",
    with_(
        HOURLY_SQL, PANEL_SQL, LAST, f"lv AS (SELECT entity_id, time, {ewm('value', 0.3, order='time', part='entity_id')} AS l FROM p)",
        f"SELECT ls.entity_id, CAST(h AS INTEGER) AS horizon, t + h * step AS time, {r('l')} AS value FROM ls JOIN lv ON ls.entity_id = lv.entity_id AND lv.time = t, (SELECT unnest([1, 2, 3]) AS h)",
    ),
)
def forecast_smoothing(spark, sf):
    return near(ops.forecast_smoothing(panel(spark, sf), 3), "value")


@query(
    "forecast_holt", "P10",
    "WITH RECURSIVE " + with_(
        HOURLY_SQL, PANEL_SQL, LAST,
        """h AS (SELECT entity_id, rn, value AS level, 0.0::DOUBLE AS trend FROM p WHERE rn = 1 UNION ALL
  SELECT n.entity_id, n.rn, CASE WHEN n.rn = 2 THEN n.value ELSE 0.3 * n.value + 0.7 * (h.level + h.trend) END,
    CASE WHEN n.rn = 2 THEN n.value - h.level ELSE 0.1 * (0.3 * n.value + 0.7 * (h.level + h.trend) - h.level) + 0.9 * h.trend END FROM h JOIN p n ON n.entity_id = h.entity_id AND n.rn = h.rn + 1)""",
        "e AS (SELECT h.* FROM h JOIN p ON h.entity_id = p.entity_id AND h.rn = p.rn WHERE p.rn = p.n)",
        f"SELECT e.entity_id, CAST(k AS INTEGER) AS horizon, t + k * step AS time, {r('level + k * trend')} AS value FROM e JOIN ls ON e.entity_id = ls.entity_id, (SELECT unnest(range(1, 4)) AS k)",
    ).removeprefix("WITH "),
)
def forecast_holt(spark, sf):
    return near(ops.forecast_holt(panel(spark, sf), 3), "value")


@query(
    "forecast_metrics", "P11",
    with_(
        HOURLY_SQL, PANEL_SQL, f"f AS (SELECT *, avg(value) OVER ({E} ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS fc, value - lag(value) OVER ({E}) AS st FROM p), e AS (SELECT *, fc - value AS e FROM f WHERE fc IS NOT NULL)",
        "sc AS (SELECT entity_id, avg(abs(st)) AS s, avg(st * st) AS q FROM f GROUP BY entity_id), m AS (SELECT entity_id, avg(abs(e)) AS mae, avg(abs(e) / abs(value)) AS mape, avg(e * e) AS mse, avg(2 * abs(e) / (abs(value) + abs(fc))) AS smape, avg((e > 0)::INT) AS o, avg((e < 0)::INT) AS u, count(*) AS n FROM e GROUP BY entity_id)",
        f"SELECT m.entity_id, {rs('mae')}, {r('mape')} AS mape, {r('mse', 4)} AS mse, {r('sqrt(mse)')} AS rmse, {rs('smape')}, {r('o')} AS overforecast, {r('u')} AS underforecast, n, {r('mae / s')} AS mase, {r('sqrt(mse / q)')} AS rmsse FROM m JOIN sc ON m.entity_id = sc.entity_id",
    ),
)
def forecast_metrics(spark, sf):
    y = panel(spark, sf)
    f = ops.over_blocks(y, ops.PANEL, lambda w: {"_f": F.avg("value").over(w.rowsBetween(-3, -1))}, back=3).filter("_f IS NOT NULL").select("entity_id", "time", F.col("_f").alias("value"))
    out = ops.forecast_metrics(y, f, y)
    return near(near(out, "mae", "mape", "rmse", "smape", "overforecast", "underforecast", "mase", "rmsse"), "mse", digits=4)


@query(
    "tail_splits", "P12",
    with_(
        HOURLY_SQL, PANEL_SQL, "s AS (SELECT p.*, k, n - 24 - 10 * (2 - k) AS cut FROM p, (SELECT unnest([0, 1, 2]) AS k))",
        """SELECT entity_id, CAST(k AS INTEGER) AS split, 'expanding' AS kind, CASE WHEN rn > cut THEN 'test' ELSE 'train' END AS set, count(*) AS n, min(time) AS start_time FROM s WHERE rn <= cut + 24 GROUP BY ALL
UNION ALL SELECT entity_id, CAST(k AS INTEGER), 'sliding', CASE WHEN rn > cut THEN 'test' ELSE 'train' END, count(*), min(time) FROM s WHERE rn <= cut + 24 AND rn > cut - 100 GROUP BY ALL
UNION ALL SELECT entity_id, 0, 'tail', CASE WHEN rn > n - 24 THEN 'test' ELSE 'train' END, count(*), min(time) FROM p GROUP BY ALL""",
    ),
)
def tail_splits(spark, sf):
    y = panel(spark, sf)
    parts = {
        "expanding": ops.tail_splits(y, 24, 3, 10), "sliding": ops.tail_splits(y, 24, 3, 10, train_size=100), "tail": ops.split_tail(y, 24).withColumn("split", F.lit(0)),
    }
    out = reduce(DataFrame.unionByName, [p.select("entity_id", "split", "set", "time", F.lit(k).alias("kind")) for k, p in parts.items()])
    return out.groupBy("entity_id", "split", "kind", "set").agg(F.count(F.lit(1)).alias("n"), F.min("time").alias("start_time"))


ROLL = f"""o AS (SELECT *, sum(value) OVER ({E}) / rn AS mean, value + 0 AS naive, first_value(value) OVER ({E}) AS fv, {ewm('value', 0.3, order='time', part='entity_id')} AS sm, lead(value, 1) OVER ({E}) AS a1, lead(value, 6) OVER ({E}) AS a6 FROM p),
og AS (SELECT * FROM o WHERE rn >= 100 AND (rn - 100) % 50 = 0 AND rn + 6 <= n),
bt AS (SELECT entity_id, time AS origin_time, rn AS origin, model, horizon, CASE model WHEN 'naive' THEN value WHEN 'mean' THEN mean WHEN 'drift' THEN value + horizon * (value - fv) / (rn - 1) ELSE sm END AS forecast, CASE horizon WHEN 1 THEN a1 ELSE a6 END AS actual FROM og, (SELECT unnest(['naive', 'mean', 'drift', 'smoothing']) AS model), (SELECT unnest([1, 6]) AS horizon))"""


@query("rolling_origin", "P13", with_(HOURLY_SQL, PANEL_SQL, ROLL, f"SELECT entity_id, origin_time, origin, model, horizon, {rs('forecast')}, actual, {r('forecast - actual')} AS error FROM bt"))
def rolling_origin(spark, sf):
    return near(ops.rolling_origin(panel(spark, sf), 100, [1, 6], 50), "forecast", "error")


@query(
    "compare_models", "P13",
    with_(
        HOURLY_SQL, PANEL_SQL, ROLL, "e AS (SELECT *, forecast - actual AS e FROM bt)",
        f"SELECT entity_id, model, horizon, {r('avg(abs(e))')} AS mae, {r('sqrt(avg(e * e))')} AS rmse, {r('avg(abs(e / (actual + 1e-10))) * 100', 4)} AS mape, {r('avg(e)')} AS bias, count(*) AS n FROM e GROUP BY ALL",
    ),
)
def compare_models(spark, sf):
    out = ops.compare_models(ops.rolling_origin(panel(spark, sf), 100, [1, 6], 50))
    return near(near(out, "mae", "rmse", "bias"), "mape", digits=4)


@query(
    "dickey_fuller", "P14",
    with_(
        HOURLY_SQL, PANEL_SQL, f"l AS (SELECT entity_id, value - lag(value) OVER ({E}) AS d, lag(value) OVER ({E}) AS x FROM p), l2 AS (SELECT * FROM l WHERE x IS NOT NULL)",
        "f AS (SELECT entity_id, regr_slope(d, x) AS b, regr_sxx(d, x) AS sxx, regr_syy(d, x) - regr_slope(d, x) * regr_sxy(d, x) AS rss, count(*) AS n FROM l2 GROUP BY entity_id)",
        f"SELECT entity_id, {r('b / sqrt(rss / (n - 2) / sxx)', 5)} AS adf, n AS observations, b / sqrt(rss / (n - 2) / sxx) < -3.43035 AS below_1, b / sqrt(rss / (n - 2) / sxx) < -2.86154 AS below_5, b / sqrt(rss / (n - 2) / sxx) < -2.56677 AS below_10 FROM f",
    ),
)
def dickey_fuller(spark, sf):
    return near(ops.adf(panel(spark, sf), lags=0), "adf", digits=5)


@query("dickey_fuller_lagged", "P14")
def dickey_fuller_lagged(spark, sf):
    return near(ops.adf(panel(spark, sf), lags=4), "adf", digits=5)


@query(
    "ljung_box", "P14",
    with_(
        HOURLY_SQL, PANEL_SQL, "c AS (SELECT entity_id, rn, n, value - avg(value) OVER (PARTITION BY entity_id) AS c FROM p), v AS (SELECT entity_id, sum(c * c) AS v FROM c GROUP BY entity_id)",
        "g AS (SELECT x.entity_id, k, sum(x.c * y.c) AS s, any_value(x.n) AS n FROM c x, (SELECT unnest(generate_series(1, 10)) AS k), c y WHERE x.entity_id = y.entity_id AND y.rn = x.rn - k GROUP BY ALL)",
        f"SELECT g.entity_id, {r('any_value(n) * (any_value(n) + 2) * sum(power(s / v, 2) / (n - k))')} AS q, any_value(n) AS n FROM g JOIN v ON g.entity_id = v.entity_id GROUP BY g.entity_id",
    ),
)
def ljung_box(spark, sf):
    return near(ops.ljung_box(panel(spark, sf)), "q").drop("p_value")


@query(
    "ljung_box_significance", "P14",
    with_(
        HOURLY_SQL, PANEL_SQL, "c AS (SELECT entity_id, rn, n, value - avg(value) OVER (PARTITION BY entity_id) AS c FROM p), v AS (SELECT entity_id, sum(c * c) AS v FROM c GROUP BY entity_id)",
        "g AS (SELECT x.entity_id, k, sum(x.c * y.c) AS s, any_value(x.n) AS n FROM c x, (SELECT unnest(generate_series(1, 10)) AS k), c y WHERE x.entity_id = y.entity_id AND y.rn = x.rn - k GROUP BY ALL)",
        "h AS (SELECT g.entity_id, any_value(n) * (any_value(n) + 2) * sum(power(s / v, 2) / (n - k)) AS q, any_value(n) AS n FROM g JOIN v ON g.entity_id = v.entity_id GROUP BY g.entity_id)",
        f"SELECT entity_id, {r('q')} AS q, n, {r(chi2_p_sql('q', 10))} AS p_value FROM h",
    ),
)
def ljung_box_significance(spark, sf):
    return near(ops.ljung_box(panel(spark, sf)), "q", "p_value")


@query(
    "normality_durbin_watson", "P14",
    with_(
        HOURLY_SQL, PANEL_SQL, "m AS (SELECT entity_id, avg(value) AS m, stddev_pop(value) AS s, kurtosis_pop(value) AS k FROM p GROUP BY entity_id), g AS (SELECT p.entity_id, avg(power((value - m) / s, 3)) AS g, any_value(k) AS k, count(*) AS n FROM p JOIN m ON p.entity_id = m.entity_id GROUP BY p.entity_id)",
        f"w AS (SELECT entity_id, sum(power(d, 2)) / sum(value * value) AS dw FROM (SELECT entity_id, value, value - lag(value) OVER ({E}) AS d FROM p) GROUP BY entity_id)",
        f"SELECT g.entity_id, {r('n / 6 * (g * g + k * k / 4)', 4)} AS jarque_bera, {r('g')} AS skewness, {r('k + 3')} AS kurtosis, n, {r('exp(-(n / 6 * (g * g + k * k / 4)) / 2)')} AS p_value, {r('dw')} AS durbin_watson FROM g JOIN w ON g.entity_id = w.entity_id",
    ),
)
def normality_durbin_watson(spark, sf):
    y = panel(spark, sf)
    out = ops.normality(y).join(ops.durbin_watson(y), "entity_id")
    return near(near(out, "skewness", "kurtosis", "p_value", "durbin_watson"), "jarque_bera", digits=4)


@query(
    "t_test", "P14",
    with_(
        HOURLY_SQL, PANEL_SQL, "s AS (SELECT entity_id, (avg(value) - 50.0) / (stddev_samp(value) / sqrt(count(value))) AS t, count(value) AS n FROM p GROUP BY entity_id)",
        f"SELECT entity_id, {r('t')} AS t, n, {r(t_p_sql('t', 'n - 1'))} AS p_value FROM s",
    ),
)
def t_test(spark, sf):
    return near(ops.t_test(panel(spark, sf), 50.0), "t", "p_value")


@query(
    "rolling_regression", "P15",
    with_(
        HOURLY_SQL, PAIR_SQL,
        f"SELECT symbol, ts, CASE WHEN count(*) OVER {wn(30)} = 30 THEN {r(f'regr_slope(close, bench) OVER {wn(30)}')} END AS slope, CASE WHEN count(*) OVER {wn(30)} = 30 THEN {r(f'regr_intercept(close, bench) OVER {wn(30)}')} END AS intercept, CASE WHEN count(*) OVER {wn(30)} = 30 THEN {r(f'power(corr(close, bench) OVER {wn(30)}, 2)')} END AS r2 FROM pair",
    ),
)
def rolling_regression(spark, sf):
    return near(ops.rolling_regression(pair(spark, sf), "close", "bench", 30, HOURLY), "slope", "intercept", "r2").drop("close", "bench")


@query("principal_components", "P16")
def principal_components(spark, sf):
    rows = returns(spark, sf).filter("ret IS NOT NULL")
    return near(ops.principal_components(joins.correlation_pairs(rows, "ts", "symbol", "ret", times=4)), "eigenvalue", "explained", "loading")


@query(
    "linear_glm", "P17",
    """WITH f AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a FROM lineitem) SELECT 'const' AS term, """
    + r("a", 2) + " AS coef FROM f UNION ALL SELECT 'l_quantity', " + r("b", 2) + " FROM f",
)
def linear_glm(spark, sf):
    out = ops.glm(fx.table(spark, sf, "lineitem"), "l_extendedprice", ["l_quantity"])
    return near(out, "coef", digits=2).select("term", "coef")


@query("logistic_glm", "P17")
def logistic_glm(spark, sf):
    l = fx.table(spark, sf, "lineitem").withColumn("late", (F.col("l_returnflag") == "R").cast("double"))
    return near(ops.glm(l, "late", ["l_quantity", "l_discount", "l_tax"], "binomial"), "coef", "deviance", digits=4)


@query("poisson_glm", "P17")
def poisson_glm(spark, sf):
    return near(ops.glm(fx.table(spark, sf, "lineitem"), "l_quantity", ["l_discount", "l_tax"], "poisson"), "coef", "deviance", digits=4)


@query(
    "kaplan_meier", "P18",
    """WITH d AS (SELECT abs(datediff('day', o_orderdate, l_shipdate)) AS time, l_returnflag = 'R' AS ev FROM lineitem JOIN orders ON l_orderkey = o_orderkey), c AS (SELECT time, count(*) AS n, count(*) FILTER (ev) AS events FROM d GROUP BY time),
k AS (SELECT time, events, sum(n) OVER (ORDER BY time DESC) AS at_risk FROM c), e AS (SELECT * FROM k WHERE events > 0)
SELECT CAST(time AS INTEGER) AS time, events, CAST(at_risk AS BIGINT) AS at_risk, """
    + r("CASE WHEN min(1 - events / at_risk) OVER (ORDER BY time) > 0 THEN exp(sum(ln(CASE WHEN events < at_risk THEN 1 - events / at_risk END)) OVER (ORDER BY time)) ELSE 0 END")
    + " AS survival FROM e",
)
def kaplan_meier(spark, sf):
    l, o = fx.table(spark, sf, "lineitem"), fx.table(spark, sf, "orders")
    rows = l.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(F.abs(F.datediff("l_shipdate", "o_orderdate")).alias("time"), (F.col("l_returnflag") == "R").alias("status"))
    return near(ops.kaplan_meier(rows), "survival")


@query("similar_patterns", "P19")
def similar_patterns(spark, sf):
    return near(ops.similar_patterns(fx.hourly(spark, sf), HOURLY), "feature_distance", "dtw", "forward_return")


@query("pattern_win_rate", "P19")
def pattern_win_rate(spark, sf):
    return near(ops.pattern_win_rate(ops.similar_patterns(fx.hourly(spark, sf), HOURLY)), "win_rate", "avg_return")


PV = "tt AS (SELECT symbol, avg(ret) / (stddev_samp(ret) / sqrt(count(ret))) AS t FROM rets WHERE ret IS NOT NULL GROUP BY symbol), pv AS (SELECT symbol, CASE WHEN abs(t) >= 7 THEN 0 ELSE floor(2 * (1 - " + normal_cdf_sql("abs(t)") + ") * 1e6) / 1e6 END AS p FROM tt)"


@query(
    "multiple_tests", "P20",
    with_(
        DAILY_SQL, RETURNS, PV, "k AS (SELECT *, rank() OVER (ORDER BY p) + count(*) OVER (PARTITION BY p) - 1 AS k, count(*) OVER () AS n FROM pv), b AS (SELECT *, least(min(p * n / k) OVER (ORDER BY p DESC), 1) AS bh FROM k)",
        f"SELECT symbol, {r('p')} AS p_value, {r('bh')} AS p_bh, {r('least(p * n, 1)')} AS p_bonferroni, bh <= 0.05 AS reject_bh, least(p * n, 1) <= 0.05 AS reject_bonferroni FROM b",
    ),
)
def multiple_tests(spark, sf):
    rows = returns(spark, sf, daily=True).filter("ret IS NOT NULL").groupBy("symbol").agg((F.avg("ret") / (F.stddev_samp("ret") / F.sqrt(F.count("ret")))).alias("t"))
    rows = rows.select("symbol", (F.floor(two_sided(F.col("t")) * 1e6) / 1e6).alias("p_value"))
    return near(ops.adjust_p_values(rows), "p_value", "p_bh", "p_bonferroni")
