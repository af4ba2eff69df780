"""Performance, risk, simulation and weight queries."""

import math

from pyspark.sql import functions as F

from candlewick import fixtures as fx
from candlewick.functions.stats import normal_cdf_sql, normal_ppf
from candlewick.operators import risk as ops
from candlewick.operators import windows as win
from candlewick.operators.series import DAILY, HOURLY
from candlewick.plans.indicators import _recursive, recursive
from candlewick.plans.joins import HOLDINGS_SQL, BENCH, benchmark, holdings
from candlewick.plans.quality import COMPANIES_SQL, companies
from candlewick.plans.registry import log_scale, log_sql, near, query, r, rs
from candlewick.plans.signals import _u
from candlewick.plans.sql import DAILY as DAILY_SQL
from candlewick.plans.sql import HOURLY as HOURLY_SQL
from candlewick.plans.sql import NUMBERED, RETURNS, with_
from candlewick.plans.windows import DD_SQL, returns

RF = "rf AS (SELECT symbol, ts, ret FROM rets WHERE ret IS NOT NULL)"
JB = RF + ", " + BENCH + ", jb AS (SELECT symbol, rf.ts, ret, bench FROM rf JOIN bench ON rf.ts = bench.ts)"


def known(spark, sf):
    return returns(spark, sf).filter("ret IS NOT NULL").select("symbol", "ts", "close", "ret")


def against(spark, sf):
    return known(spark, sf).join(benchmark(spark, sf), "ts")


def with_dd(spark, sf):
    return win.drawdowns(returns(spark, sf), HOURLY).drop("_pos", "peak_pos")


@query(
    "performance",
    "R1",
    with_(
        DAILY_SQL, RETURNS,
        f"""SELECT symbol, {r('arg_max(close, ts) / arg_min(close, ts) - 1')} AS total_return, {r('power(arg_max(close, ts) / arg_min(close, ts), 252.0 / count(ret)) - 1')} AS annualized_return,
  {r("power(arg_max(close, ts) / arg_min(close, ts), 1 / (datediff('day', min(ts), max(ts)) / 365.25)) - 1")} AS cagr, {r('stddev_samp(ret) * sqrt(252)')} AS volatility, {r('max(ret)')} AS best, {r('min(ret)')} AS worst, {r('avg(ret)')} AS avg_return,
  {r('avg(ret) * 21')} AS avg_monthly, count(*) FILTER (ret > 0) AS positive, count(*) FILTER (ret < 0) AS negative, arg_min(close, ts) AS start_price, arg_max(close, ts) AS current_price, count(ret) AS n,
  {r('(power(arg_max(close, ts) / arg_min(close, ts), 252.0 / count(ret)) - 1 - 0.04) / (stddev_samp(ret) * sqrt(252))')} AS sharpe FROM rets GROUP BY symbol""",
    ),
)
def performance(spark, sf):
    out = ops.performance(returns(spark, sf, daily=True), ["symbol"])
    return near(out, "total_return", "annualized_return", "cagr", "volatility", "best", "worst", "avg_return", "avg_monthly", "sharpe")


@query(
    "risk_ratios",
    "R2",
    with_(
        HOURLY_SQL, NUMBERED, DD_SQL, "rets AS (SELECT *, close / lag(close) OVER (PARTITION BY symbol ORDER BY ts) - 1 AS ret FROM dd)",
        f"""SELECT symbol, {r('(avg(ret) - 0.02 / 252) * 252 / (stddev_samp(ret) * sqrt(252))')} AS sharpe, {r('(avg(ret) - 0.02 / 252) * 252 / (stddev_samp(ret) FILTER (ret < 0.02 / 252) * sqrt(252))', 4)} AS sortino, {r('sum(CASE WHEN ret > 0 THEN ret END) / sum(CASE WHEN ret < 0 THEN -ret END)')} AS omega,
  {r('sum(ret) / sum(CASE WHEN ret < 0 THEN -ret END)')} AS gain_pain, {r('stddev_samp(ret) FILTER (ret < 0.02 / 252) * sqrt(252)')} AS downside_risk, {r('avg(ret) * 252 / -min(drawdown)', 4)} AS calmar FROM rets GROUP BY symbol""",
    ),
)
def risk_ratios(spark, sf):
    out = ops.ratios(with_dd(spark, sf), ["symbol"], rf=0.02, drawdown="drawdown")
    return near(near(out, "sharpe", "omega", "gain_pain", "downside_risk"), "sortino", "calmar", digits=4)


@query(
    "max_drawdown",
    "R3",
    with_(
        HOURLY_SQL, NUMBERED, DD_SQL,
        "m AS (SELECT symbol, min(drawdown) AS md, arg_min(ts, drawdown) AS tt, arg_min(peak, drawdown) AS pk, arg_min(pp, drawdown) AS ppos, arg_max(drawdown, ts) AS cd, max(dd_length) AS longest FROM dd GROUP BY symbol)",
        f"SELECT m.symbol, {r('any_value(md)')} AS max_drawdown, {r('any_value(cd)')} AS current_drawdown, any_value(longest) AS longest, any_value(tt) AS trough_ts, max(ts) FILTER (rn = ppos) AS peak_ts, min(ts) FILTER (ts > tt AND close >= pk) AS recovery_ts FROM m JOIN dd ON m.symbol = dd.symbol GROUP BY m.symbol",
    ),
)
def max_drawdown(spark, sf):
    return near(ops.max_drawdown(fx.hourly(spark, sf), HOURLY), "max_drawdown", "current_drawdown")


@query(
    "historical_var",
    "R4",
    with_(
        HOURLY_SQL, RETURNS, RF,
        "s AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ret) - 1 AS k, count(*) OVER (PARTITION BY symbol) AS n, quantile_cont(ret, 0.05) OVER (PARTITION BY symbol) AS q FROM rf)",
        "v AS (SELECT symbol, any_value(n) AS n, any_value(q) AS q, max(ret) FILTER (k = floor(n * 0.05 + 1e-9)) AS a, avg(ret) FILTER (k <= floor(n * 0.05 + 1e-9)) AS ca, max(ret) FILTER (k = ceil(n * 0.05 - 1e-9) - 1) AS b FROM s GROUP BY symbol)",
        f"SELECT v.symbol, any_value(v.n) AS n, {r('-any_value(a)')} AS var_floor, {r('-any_value(ca)')} AS cvar_floor, {r('-any_value(b)')} AS var_ceil, {r('-any_value(v.q)')} AS var_percentile, {r('-avg(ret) FILTER (ret <= b)')} AS cvar_ceil, {r('-avg(ret) FILTER (ret <= v.q)')} AS cvar_percentile FROM v JOIN s ON v.symbol = s.symbol GROUP BY v.symbol",
    ),
)
def historical_var(spark, sf):
    return near(ops.historical_var(known(spark, sf), ["symbol"]), "var_floor", "cvar_floor", "var_ceil", "var_percentile", "cvar_ceil", "cvar_percentile")


_Z = normal_ppf(0.05)


@query(
    "parametric_var",
    "R5",
    with_(
        HOURLY_SQL, RETURNS, RF,
        "m AS (SELECT symbol, avg(ret) AS m, stddev_samp(ret) AS s, stddev_pop(ret) AS sp, kurtosis_pop(ret) AS k FROM rf GROUP BY symbol), g AS (SELECT m.symbol, any_value(m) AS m, any_value(s) AS s, any_value(k) AS k, avg(power((ret - m) / sp, 3)) AS g FROM m JOIN rf ON m.symbol = rf.symbol GROUP BY m.symbol)",
        f"SELECT symbol, {r(f'-(m + {_Z!r} * s) * sqrt(5)', 5)} AS var_normal, {r(f'-(m + ({_Z!r} + {_Z ** 2 - 1!r} * g / 6 + {_Z ** 3 - 3 * _Z!r} * k / 24) * s) * sqrt(5)', 5)} AS var_cornish_fisher FROM g",
    ),
)
def parametric_var(spark, sf):
    return near(ops.parametric_var(known(spark, sf), ["symbol"], days=5), "var_normal", "var_cornish_fisher", digits=5)


def books(rows):
    """Two portfolios over all symbols: equal weights and weights by the length of the name."""
    s = rows.select("symbol").distinct()
    n = s.agg(F.count(F.lit(1)).alias("_n"), F.sum(F.length("symbol")).alias("_l"))
    both = s.crossJoin(F.broadcast(n))  # one row
    eq = both.select(F.lit("equal").alias("portfolio"), "symbol", (1 / F.col("_n")).alias("weight"))
    return eq.unionByName(both.select(F.lit("named").alias("portfolio"), "symbol", (F.length("symbol") / F.col("_l")).alias("weight")))


BOOKS = """sy AS (SELECT DISTINCT symbol FROM rf), bk AS (SELECT 'equal' AS portfolio, symbol, 1.0::DOUBLE / (SELECT count(*) FROM sy) AS weight FROM sy
UNION ALL SELECT 'named', symbol, length(symbol)::DOUBLE / (SELECT sum(length(symbol)) FROM sy) FROM sy)"""


@query(
    "component_var",
    "R5",
    with_(
        HOURLY_SQL, RETURNS, RF, BOOKS,
        "p AS (SELECT portfolio, ts, sum(weight * ret) AS p FROM rf JOIN bk USING (symbol) GROUP BY ALL), e AS (SELECT p.portfolio, bk.symbol, bk.weight, (p + 0.001 * coalesce(ret, 0)) / 1.001 AS x FROM p JOIN bk ON p.portfolio = bk.portfolio LEFT JOIN rf ON rf.symbol = bk.symbol AND rf.ts = p.ts)",
        "pv AS (SELECT portfolio, -max(p) FILTER (k = greatest(ceil(n * 0.05 - 1e-9), 1)) AS portfolio_var FROM (SELECT *, row_number() OVER (PARTITION BY portfolio ORDER BY p) AS k, count(*) OVER (PARTITION BY portfolio) AS n FROM p) GROUP BY portfolio)",
        "ev AS (SELECT portfolio, symbol, any_value(weight) AS weight, -max(x) FILTER (k = greatest(ceil(n * 0.05 - 1e-9), 1)) AS v FROM (SELECT *, row_number() OVER (PARTITION BY portfolio, symbol ORDER BY x) AS k, count(*) OVER (PARTITION BY portfolio, symbol) AS n FROM e) GROUP BY ALL)",
        f"SELECT portfolio, symbol, {rs('weight', 'portfolio_var')}, {r('(v - portfolio_var) / 0.001', 5)} AS marginal_var, {r('(v - portfolio_var) / 0.001 * weight', 5)} AS component_var FROM ev JOIN pv USING (portfolio)",
    ),
)
def component_var(spark, sf):
    rows = known(spark, sf)
    return near(near(ops.component_var(rows, books(rows)), "weight", "portfolio_var"), "marginal_var", "component_var", digits=5)


def _gauss_sql(*parts):
    text = " || '|' || ".join(parts)
    u = lambda a: f"(('0x' || substr(md5({text}), {a}, 12))::BIGINT / 281474976710656.0::DOUBLE)"
    return f"sqrt(-2 * ln(greatest({u(1)}, 1e-10))) * cos(2 * pi() * {u(13)})"


SIM_SQL = f"""pm AS (SELECT symbol, avg(ln(1 + ret)) / 100 AS m, stddev_samp(ln(1 + ret)) / 100 AS s FROM rf GROUP BY symbol), st AS (SELECT symbol, m, s, path, i, {_gauss_sql(repr('9'), 'symbol', 'CAST(path AS VARCHAR)', 'CAST(i AS VARCHAR)')} AS z
  FROM pm, (SELECT unnest(generate_series(0, 199)) AS path), (SELECT unnest(generate_series(1, 60)) AS i)),
cu AS (SELECT symbol, path, i, exp(sum(m - s * s / 2 + s * z) OVER (PARTITION BY symbol, path ORDER BY i)) AS v FROM st), pk AS (SELECT *, v / greatest(max(v) OVER (PARTITION BY symbol, path ORDER BY i), 1) - 1 AS d FROM cu),
pa AS (SELECT symbol, path, arg_max(v, i) AS terminal, least(min(d), 0) AS max_drawdown FROM pk GROUP BY ALL)"""


def paths(spark, sf):
    params = known(spark, sf).groupBy("symbol").agg((F.avg(F.log1p("ret")) / 100).alias("mean"), (F.stddev_samp(F.log1p("ret")) / 100).alias("std"))
    return ops.simulate(params, ["symbol"], 200, 60, seed=9)


@query("simulated_paths", "R6", with_(HOURLY_SQL, RETURNS, RF, SIM_SQL, f"SELECT symbol, path, {rs('terminal', 'max_drawdown')} FROM pa"))
def simulated_paths(spark, sf):
    return near(paths(spark, sf), "terminal", "max_drawdown")


@query(
    "simulation_summary",
    "R6",
    with_(
        HOURLY_SQL, RETURNS, RF, SIM_SQL,
        f"""SELECT symbol, {r('avg(terminal)')} AS mean, {r('min(terminal)')} AS min, {r('max(terminal)')} AS max, {r('avg((terminal > 1)::INT)')} AS prob_profit, count(*) AS paths, {r('avg(max_drawdown)')} AS avg_drawdown,
  {', '.join(f'{r(f"quantile_cont(terminal, {q})")} AS {n}' for n, q in (('p5', 0.05), ('p25', 0.25), ('median', 0.5), ('p75', 0.75), ('p95', 0.95)))}, {r('1 - quantile_cont(terminal, 0.05)')} AS var FROM pa GROUP BY symbol""",
    ),
)
def simulation_summary(spark, sf):
    out = ops.simulation_summary(paths(spark, sf), ["symbol"])
    return near(out, "mean", "min", "max", "prob_profit", "avg_drawdown", "p5", "p25", "median", "p75", "p95", "var")


@query(
    "bootstrap_paths",
    "R6",
    with_(
        HOURLY_SQL, RETURNS, "nk AS (SELECT symbol, ret, row_number() OVER (PARTITION BY symbol ORDER BY ts) AS k, count(*) OVER (PARTITION BY symbol) AS n FROM rets WHERE ret IS NOT NULL)",
        f"d AS (SELECT s.symbol, path, i, floor({_u(repr('4'), 's.symbol', 'CAST(path AS VARCHAR)', 'CAST(i AS VARCHAR)')} * n) + 1 AS k FROM (SELECT DISTINCT symbol, n FROM nk) s, (SELECT unnest(generate_series(0, 99)) AS path), (SELECT unnest(generate_series(1, 20)) AS i))",
        f"SELECT d.symbol, path, {r('sum(ln(1 + ret))')} AS log_terminal FROM d JOIN nk ON d.symbol = nk.symbol AND d.k = nk.k GROUP BY ALL",
    ),
)
def bootstrap_paths(spark, sf):
    out = ops.bootstrap(known(spark, sf), HOURLY, 100, 20, seed=4)
    return near(out.select("symbol", "path", F.log("terminal").alias("log_terminal")), "log_terminal")


@query(
    "stress_test",
    "R7",
    with_(
        HOURLY_SQL, RETURNS, RF,
        "x AS (SELECT symbol, scenario, shock, ret + shock AS x FROM rf, (VALUES ('crash', -0.2::DOUBLE), ('dip', -0.05), ('rally', 0.1)) s(scenario, shock)), y AS (SELECT *, row_number() OVER w AS k, count(*) OVER (PARTITION BY symbol, scenario) AS n FROM x WINDOW w AS (PARTITION BY symbol, scenario ORDER BY x))",
        f"SELECT symbol, scenario, any_value(shock) AS shock, {r('avg(x)', 5)} AS mean, {r('stddev_samp(x)')} AS volatility, {r('-max(x) FILTER (k = greatest(ceil(n * 0.05 - 1e-9), 1))')} AS var_95, {r('-max(x) FILTER (k = greatest(ceil(n * 0.01 - 1e-9), 1))')} AS var_99 FROM y GROUP BY ALL",
    ),
)
def stress_test(spark, sf):
    out = ops.stress_test(known(spark, sf), ["symbol"], {"crash": -0.2, "dip": -0.05, "rally": 0.1})
    return near(near(out, "volatility", "var_95", "var_99"), "mean", digits=5)


@query(
    "crisis_periods",
    "R7",
    with_(
        DAILY_SQL, RETURNS, RF,
        "x AS (SELECT symbol, period, ts, ret, sum(ret) OVER (PARTITION BY symbol, period ORDER BY ts) AS c FROM rf, (VALUES ('asia', TIMESTAMP '1997-07-01', TIMESTAMP '1998-01-31'), ('russia', TIMESTAMP '1998-01-15', TIMESTAMP '1998-10-31')) p(period, a, b) WHERE ts BETWEEN a AND b)",
        f"SELECT symbol, period, {r('exp(sum(ln(1 + ret))) - 1')} AS total_return, {r('stddev_samp(ret) * sqrt(252)')} AS volatility, {r('min(c)')} AS max_drawdown, {r('min(ret)')} AS worst FROM x GROUP BY ALL",
    ),
)
def crisis_periods(spark, sf):
    rows = returns(spark, sf, daily=True).filter("ret IS NOT NULL")
    out = ops.crisis_periods(rows, ["symbol"], {"asia": ("1997-07-01", "1998-01-31"), "russia": ("1998-01-15", "1998-10-31")})
    return near(out, "total_return", "volatility", "max_drawdown", "worst")


_BM = ["beta", "alpha", "r2", "systematic_risk", "specific_risk", "treynor", "m2", "tracking_error", "information_ratio"]


@query(
    "benchmark_measures",
    "R8,R9",
    with_(
        HOURLY_SQL, RETURNS, JB,
        "mk AS (SELECT *, 'all' AS market FROM jb UNION ALL SELECT *, 'bull' FROM jb WHERE bench > 0 UNION ALL SELECT *, 'bear' FROM jb WHERE bench < 0)",
        "s AS (SELECT symbol, market, count(*) AS n, covar_samp(ret, bench) / nullif(var_samp(bench), 0) AS beta, avg(ret) AS p, avg(bench) AS b, stddev_samp(ret) AS sp, stddev_samp(bench) AS sb, corr(ret, bench) AS c, avg(ret - bench) AS a, stddev_samp(ret - bench) AS sa FROM mk GROUP BY ALL)",
        "t AS (SELECT *, p * 252 - (0.02 + beta * (b * 252 - 0.02)) AS alpha, c * c AS r2, beta * beta * sb * sb AS systematic_risk, sp * sp - beta * beta * sb * sb AS specific_risk, (p * 252 - 0.02) / nullif(beta, 0) AS treynor, 0.02 + (p * 252 - 0.02) / nullif(sp * sqrt(252), 0) * sb * sqrt(252) AS m2, sa * sqrt(252) AS tracking_error, a * 252 / nullif(sa * sqrt(252), 0) AS information_ratio FROM s WHERE market = 'all' OR n >= 5)",
        f"SELECT symbol, market, n, {rs(*_BM, digits=4)} FROM t",
    ),
)
def benchmark_measures(spark, sf):
    return near(ops.benchmark_measures(against(spark, sf), ["symbol"], rf=0.02), *_BM, digits=4)


@query(
    "capture_ratios",
    "R10",
    with_(
        HOURLY_SQL, RETURNS, JB,
        "c AS (SELECT symbol, avg(ret) FILTER (bench > 0) / avg(bench) FILTER (bench > 0) * 100 AS u, avg(ret) FILTER (bench < 0) / avg(bench) FILTER (bench < 0) * 100 AS d, count(*) FILTER (ret > 0) * 100.0 / count(*) AS h, avg((ret > bench)::INT) AS ba FROM jb GROUP BY symbol)",
        f"SELECT symbol, {r('u')} AS up_capture, {r('d')} AS down_capture, {r('u / d')} AS capture_ratio, {r('h')} AS hit_rate, {r('ba')} AS batting_average FROM c",
    ),
)
def capture_ratios(spark, sf):
    return near(ops.capture(against(spark, sf), ["symbol"]), "up_capture", "down_capture", "capture_ratio", "hit_rate", "batting_average")


PMEX = "pm AS (SELECT symbol, exp(sum(ln(1 + ret))) AS gp, exp(sum(ln(1 + bench))) AS gb, count(*) AS n, avg(ret - bench) AS a, stddev_samp(ret - bench) AS sa FROM dj GROUP BY symbol)"
DJ = "rf AS (SELECT symbol, ts, ret FROM rets WHERE ret IS NOT NULL), bench AS (SELECT ts, avg(ret) AS bench FROM rf GROUP BY ts), dj AS (SELECT symbol, rf.ts, ret / 100 AS ret, bench / 100 AS bench FROM rf JOIN bench ON rf.ts = bench.ts)"


def daily_against(spark, sf):
    """Daily returns scaled down a hundredfold, next to the equal-weight mean."""
    rows = returns(spark, sf, daily=True).filter("ret IS NOT NULL").select("symbol", "ts", (F.col("ret") / 100).alias("ret"))
    return rows.join(rows.groupBy("ts").agg(F.avg("ret").alias("bench")), "ts")


@query(
    "public_market_equivalent",
    "R11",
    with_(
        DAILY_SQL, RETURNS, DJ, PMEX,
        f"SELECT symbol, {r('gp / gb')} AS pme_ratio, {r('power(gp, 252.0 / n) - 1')} AS annual_return, {r('power(gb, 252.0 / n) - 1')} AS annual_benchmark, {r('a * 252')} AS annual_alpha, {r('sa * sqrt(252)')} AS tracking_error, {r('(gp - gb) / 1e9', 4)} AS outperformance, n AS days FROM pm",
    ),
)
def public_market_equivalent(spark, sf):
    out = ops.public_market_equivalent(daily_against(spark, sf), ["symbol"])
    out = out.withColumn("outperformance", F.col("outperformance") / 1e9)
    return near(near(out, "pme_ratio", "annual_return", "annual_benchmark", "annual_alpha", "tracking_error"), "outperformance", digits=4)


@query(
    "pme_cash_flows",
    "R11",
    f"""WITH f AS (SELECT o_custkey AS portfolio, l_extendedprice AS amount, p_retailprice AS price, p_retailprice * (1 + p_size / 100) AS end_price, sum(l_extendedprice) OVER (PARTITION BY o_custkey) * 1.2 AS value FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)
SELECT portfolio, {r('max(value) / sum(amount * end_price / price)')} AS pme FROM f GROUP BY portfolio""",
)
def pme_cash_flows(spark, sf):
    l, o, p = fx.table(spark, sf, "lineitem"), fx.table(spark, sf, "orders"), fx.table(spark, sf, "part")
    rows = l.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(p, F.col("l_partkey") == F.col("p_partkey"))
    flows = rows.select(F.col("o_custkey").alias("portfolio"), F.col("l_extendedprice").alias("amount"), F.col("p_retailprice").alias("price"), (F.col("p_retailprice") * (1 + F.col("p_size") / 100)).alias("end_price"))
    total = flows.groupBy("portfolio").agg((F.sum("amount") * 1.2).alias("value"))
    return near(ops.pme_cash_flows(flows.join(total, "portfolio"), ["portfolio"]), "pme")


_EX = ["win_rate", "avg_win", "avg_loss", "payoff_ratio", "profit_factor", "ulcer_index", "max_drawdown", "exposure", "expected_return", "kelly", "tail_ratio", "outlier_win_ratio", "outlier_loss_ratio", "ulcer_performance", "recovery_factor", "risk_return_ratio", "cpc_index"]


@query(
    "extended_statistics",
    "R12",
    with_(
        DAILY_SQL, NUMBERED, DD_SQL, "rets AS (SELECT *, close / lag(close) OVER (PARTITION BY symbol ORDER BY ts) - 1 AS x FROM dd)",
        """a AS (SELECT symbol, count(*) FILTER (x > 0) * 1.0 / count(*) FILTER (x <> 0) AS win_rate, avg(x) FILTER (x > 0) AS avg_win, avg(x) FILTER (x < 0) AS avg_loss, abs(avg(x) FILTER (x > 0) / avg(x) FILTER (x < 0)) AS payoff_ratio, sum(x) FILTER (x > 0) / abs(sum(x) FILTER (x < 0)) AS profit_factor,
  sqrt(avg(drawdown * drawdown)) AS ulcer_index, min(drawdown) AS max_drawdown, count(*) FILTER (x <> 0) * 1.0 / count(x) AS exposure, exp(avg(ln(1 + x))) - 1 AS expected_return, exp(sum(ln(1 + x))) - 1 AS t, avg(x) / stddev_samp(x) AS risk_return_ratio,
  quantile_cont(x, 0.95) AS p95, quantile_cont(x, 0.05) AS p5, quantile_cont(x, 0.99) AS p99, quantile_cont(x, 0.01) AS p1 FROM rets GROUP BY symbol)""",
        "b AS (SELECT *, (payoff_ratio * win_rate - (1 - win_rate)) / payoff_ratio AS kelly, abs(p95 / p5) AS tail_ratio, p99 / avg_win AS outlier_win_ratio, p1 / avg_loss AS outlier_loss_ratio, t / ulcer_index AS ulcer_performance, abs(t / max_drawdown) AS recovery_factor, profit_factor * win_rate * payoff_ratio AS cpc_index FROM a)",
        f"SELECT symbol, {rs(*_EX)} FROM b",
    ),
)
def extended_statistics(spark, sf):
    rows = win.drawdowns(returns(spark, sf, daily=True, closes=True, keep_pos=True), DAILY)
    return near(ops.extended_statistics(rows, ["symbol"]), *_EX)


@query(
    "time_weighted_return",
    "R13",
    with_(
        DAILY_SQL,
        f"SELECT symbol, {r('arg_max(close, ts) / arg_min(close, ts) - 1')} AS twr, {r('power(arg_max(close, ts) / arg_min(close, ts), 365.25 / datediff(' + repr('day') + ', min(ts), max(ts))) - 1')} AS annualized_twr, count(*) - 1 AS periods, CAST(datediff('day', min(ts), max(ts)) AS INTEGER) AS days FROM bars GROUP BY symbol",
    ),
)
def time_weighted_return(spark, sf):
    return near(ops.time_weighted(fx.daily(spark, sf), ["symbol"]), "twr", "annualized_twr")


@query(
    "money_weighted_return",
    "R13",
    """WITH RECURSIVE f AS (SELECT o_custkey AS portfolio, o_orderdate::DATE AS d, -o_totalprice AS a FROM orders UNION ALL SELECT o_custkey, DATE '2003-01-01', sum(o_totalprice) * 1.4 FROM orders GROUP BY o_custkey),
g AS (SELECT portfolio, datediff('day', min(d) OVER (PARTITION BY portfolio), d) / 365.25 AS y, a FROM f),
b(portfolio, lo, hi, k) AS (SELECT DISTINCT portfolio, -0.99::DOUBLE, 10.0::DOUBLE, 0 FROM g UNION ALL
  SELECT portfolio, CASE WHEN npv < 0 THEN lo ELSE mid END, CASE WHEN npv < 0 THEN mid ELSE hi END, k + 1 FROM (SELECT b.portfolio, any_value(lo) AS lo, any_value(hi) AS hi, any_value((lo + hi) / 2) AS mid, any_value(k) AS k, sum(a / power(1 + (lo + hi) / 2, y)) AS npv FROM b JOIN g ON b.portfolio = g.portfolio WHERE k < 60 GROUP BY b.portfolio))
SELECT b.portfolio, """
    + r("any_value((lo + hi) / 2)")
    + " AS irr, "
    + r("any_value(moic)")
    + " AS moic, any_value(flows) AS flows FROM b JOIN (SELECT portfolio, sum(a) FILTER (a > 0) / -sum(a) FILTER (a < 0) AS moic, count(*) AS flows FROM f GROUP BY portfolio) m ON b.portfolio = m.portfolio WHERE k = 60 GROUP BY b.portfolio",
)
def money_weighted_return(spark, sf):
    o = fx.table(spark, sf, "orders")
    paid = o.select(F.col("o_custkey").alias("portfolio"), F.to_date("o_orderdate").alias("date"), (-F.col("o_totalprice")).alias("amount"))
    end = o.groupBy(F.col("o_custkey").alias("portfolio")).agg((F.sum("o_totalprice") * 1.4).alias("amount")).withColumn("date", F.lit("2003-01-01").cast("date"))
    out = ops.money_weighted(paid.unionByName(end), ["portfolio"], steps=60)
    return near(out, "irr", "moic").select("portfolio", "irr", "moic", "flows")


@query(
    "active_attribution",
    "R14",
    with_(
        DAILY_SQL, RETURNS, DJ,
        f"SELECT symbol, {r('avg(ret)')} AS portfolio_return, {r('avg(bench)')} AS benchmark_return, {r('avg(ret - bench)')} AS active_return, {r('avg((ret - bench > 0)::INT)')} AS hit_rate, {r('stddev_samp(ret - bench)')} AS active_volatility, {r('avg(ret - bench) / stddev_samp(ret - bench)')} AS information_ratio FROM dj GROUP BY symbol",
    ),
)
def active_attribution(spark, sf):
    out = ops.active_attribution(daily_against(spark, sf), ["symbol"])
    return near(out, "portfolio_return", "benchmark_return", "active_return", "hit_rate", "active_volatility", "information_ratio")


SECTOR_SQL = COMPANIES_SQL + """, pb AS (SELECT sector, market_cap / sum(market_cap) OVER () AS weight, net_income / 10000 AS ret, country FROM companies), b1 AS (SELECT sector, sum(weight) AS wb, sum(weight * ret) / sum(weight) AS rb FROM pb GROUP BY sector),
p0 AS (SELECT sector, market_cap / sum(market_cap) OVER () AS weight, net_income / 10000 AS ret FROM companies WHERE net_income > 2000), p1 AS (SELECT sector, sum(weight) AS wp, sum(weight * ret) / sum(weight) AS rp FROM p0 GROUP BY sector), tb AS (SELECT sum(weight * ret) / sum(weight) AS t FROM pb)"""


@query(
    "sector_attribution",
    "R14",
    with_(
        SECTOR_SQL,
        f"""SELECT sector, {rs('wp', 'rp', 'wb', 'rb')}, {r('(coalesce(wp, 0) - coalesce(wb, 0)) * (coalesce(rb, 0) - t)')} AS allocation, {r('coalesce(wb, 0) * (coalesce(rp, 0) - coalesce(rb, 0))')} AS selection, {r('(coalesce(wp, 0) - coalesce(wb, 0)) * (coalesce(rp, 0) - coalesce(rb, 0))')} AS interaction FROM p1 FULL JOIN b1 USING (sector), tb""",
    ),
)
def sector_attribution(spark, sf):
    c = companies(spark, sf).withColumn("ret", F.col("net_income") / 10000)

    def book(df):
        total = df.agg(F.sum("market_cap").alias("_t"))
        return df.crossJoin(F.broadcast(total)).select("sector", (F.col("market_cap") / F.col("_t")).alias("weight"), "ret")  # one row

    out = ops.sector_attribution(book(c.filter("net_income > 2000")), book(c), [])
    return near(out, "wp", "rp", "wb", "rb", "allocation", "selection", "interaction")


@query(
    "performance_persistence",
    "R14",
    with_(
        DAILY_SQL, RETURNS, RF,
        "p AS (SELECT symbol, date_trunc('quarter', ts) AS q, exp(sum(ln(1 + ret))) - 1 AS x FROM rf GROUP BY ALL), k AS (SELECT symbol, q, rank() OVER (PARTITION BY q ORDER BY x DESC) + (count(*) OVER (PARTITION BY q, x) - 1) / 2.0 AS k FROM p), n AS (SELECT q, lead(q) OVER (ORDER BY q) AS nq FROM (SELECT DISTINCT q FROM p))",
        f"SELECT a.q AS quarter, nq AS next_period, {r('corr(a.k, b.k)')} AS rank_correlation, count(*) AS entities FROM k a JOIN n ON a.q = n.q JOIN k b ON b.q = nq AND a.symbol = b.symbol GROUP BY ALL",
    ),
)
def performance_persistence(spark, sf):
    rows = returns(spark, sf, daily=True).filter("ret IS NOT NULL").withColumn("quarter", F.date_trunc("quarter", "ts"))
    return near(ops.persistence(rows, "quarter"), "rank_correlation")


FEES = _recursive(
    "100 * (1 + ret) - 100 * 0.02 / 12 - CASE WHEN 100 * (1 + ret) > 100 THEN greatest(0, 100 * ret - 100 * 0.06 / 12) * 0.2 ELSE 0 END AS nav, 100 * 0.02 / 12 AS mf, CASE WHEN 100 * (1 + ret) > 100 THEN greatest(0, 100 * ret - 100 * 0.06 / 12) * 0.2 ELSE 0 END AS pf, greatest(100, 100 * (1 + ret)) AS mark, 100.0::DOUBLE AS prev",
    "p.nav * (1 + n.ret) - p.nav * 0.02 / 12 - CASE WHEN p.nav * (1 + n.ret) > p.mark THEN greatest(0, p.nav * n.ret - p.nav * 0.06 / 12) * 0.2 ELSE 0 END, p.nav * 0.02 / 12, CASE WHEN p.nav * (1 + n.ret) > p.mark THEN greatest(0, p.nav * n.ret - p.nav * 0.06 / 12) * 0.2 ELSE 0 END, greatest(p.mark, p.nav * (1 + n.ret)), p.nav",
    (), base="mo",
)[0]


@query(
    "fee_impact",
    "R15",
    recursive(
        DAILY_SQL, RETURNS, "mo AS (SELECT symbol, date_trunc('month', ts) AS ts, avg(ret) AS ret FROM rets WHERE ret IS NOT NULL GROUP BY symbol, date_trunc('month', ts))",
        FEES.replace("0.02 / 12 AS mf", "0.02::DOUBLE / 12 AS mf"),
        f"SELECT symbol, ts, {r('nav / prev - 1')} AS net_return, {r(log_sql('mf'))} AS management_fee, {r(log_sql('pf'))} AS performance_fee, {r(log_sql('nav'))} AS nav FROM rec",
    ),
)
def fee_impact(spark, sf):
    """Mean monthly returns under 2 % management and 20 % performance fee above a 6 % hurdle; amounts on a log scale."""
    mo = returns(spark, sf, daily=True).filter("ret IS NOT NULL").groupBy("symbol", F.date_trunc("month", "ts").alias("ts")).agg(F.avg("ret").alias("ret"))
    out = ops.fee_impact(mo, DAILY, 0.02, 0.2, 0.06)
    out = out.withColumns({c: log_scale(c) for c in ("management_fee", "performance_fee", "nav")})
    return near(out, "net_return", "management_fee", "performance_fee", "nav")


COV_SQL = "cv AS (SELECT a.symbol AS a, b.symbol AS b, covar_samp(a.ret, b.ret) * 252 AS cov, corr(a.ret, b.ret) AS corr, count(*) AS n FROM rf a JOIN rf b ON a.ts = b.ts GROUP BY ALL)"


def cov_of(spark, sf):
    return ops.covariance(known(spark, sf), annualise=252, times=4)


@query("covariance_matrix", "R16", with_(HOURLY_SQL, RETURNS, RF, COV_SQL, f"SELECT a, b, n, {r('cov', 3)} AS cov, {r('corr')} AS corr FROM cv"))
def covariance_matrix(spark, sf):
    return near(near(cov_of(spark, sf), "corr"), "cov", digits=3)


@query(
    "portfolio_variance",
    "R16",
    with_(
        HOURLY_SQL, RETURNS, RF, COV_SQL, BOOKS,
        "v AS (SELECT x.portfolio, sum(x.weight * y.weight * cov) AS v, sum(CASE WHEN a = b THEN x.weight * sqrt(cov) END) AS o FROM bk x JOIN cv ON cv.a = x.symbol JOIN bk y ON y.portfolio = x.portfolio AND y.symbol = cv.b GROUP BY x.portfolio)",
        f"SELECT portfolio, {r('v', 3)} AS variance, {r('sqrt(v)', 4)} AS volatility, {r('o / sqrt(v)')} AS diversification_ratio FROM v",
    ),
)
def portfolio_variance(spark, sf):
    out = ops.portfolio_variance(books(known(spark, sf)), cov_of(spark, sf))
    return near(near(near(out, "diversification_ratio"), "volatility", digits=4), "variance", digits=3)


@query("optimal_weights", "R17,R18")
def optimal_weights(spark, sf):
    """All weight methods for the members of each book."""
    rows = known(spark, sf)
    means = rows.groupBy("symbol").agg((F.avg("ret") * 252).alias("mean"))
    out = ops.optimal_weights(books(rows).select("portfolio", "symbol"), cov_of(spark, sf), means)
    return near(out, "weight")


@query(
    "closed_form_weights",
    "R17",
    with_(
        HOURLY_SQL, RETURNS, RF, BOOKS,
        "v AS (SELECT symbol, sqrt(var_samp(ret) * 252) AS s FROM rf GROUP BY symbol), k AS (SELECT portfolio, symbol, s FROM bk JOIN v USING (symbol))",
        f"SELECT portfolio, 'equal' AS method, symbol, {r('1.0 / count(*) OVER (PARTITION BY portfolio)')} AS weight FROM k UNION ALL SELECT portfolio, 'inverse_vol', symbol, {r('(1 / s) / sum(1 / s) OVER (PARTITION BY portfolio)')} FROM k UNION ALL SELECT portfolio, 'inverse_var', symbol, {r('power(s, -2) / sum(power(s, -2)) OVER (PARTITION BY portfolio)')} FROM k",
    ),
)
def closed_form_weights(spark, sf):
    rows = known(spark, sf)
    means = rows.groupBy("symbol").agg((F.avg("ret") * 252).alias("mean"))
    return near(ops.optimal_weights(books(rows).select("portfolio", "symbol"), cov_of(spark, sf), means, ["equal", "inverse_vol", "inverse_var"]), "weight")


@query(
    "random_frontier",
    "R19",
    with_(
        HOURLY_SQL, RETURNS, RF, COV_SQL,
        f"mn AS (SELECT symbol, avg(ret) * 252 AS m FROM rf GROUP BY symbol), e AS (SELECT set_no, symbol, m, -ln(greatest({_u(repr('1'), 'CAST(set_no AS VARCHAR)', 'symbol')}, 1e-12)) AS e FROM mn, (SELECT unnest(generate_series(0, 299)) AS set_no)), w AS (SELECT set_no, symbol, m, e / sum(e) OVER (PARTITION BY set_no) AS w FROM e)",
        'p AS (SELECT x.set_no, sqrt(sum(x.w * y.w * cov)) AS vol FROM w x JOIN cv ON cv.a = x.symbol JOIN w y ON y.set_no = x.set_no AND y.symbol = cv.b GROUP BY x.set_no), q AS (SELECT set_no, sum(w * m) AS ret FROM w GROUP BY set_no), s AS (SELECT vol, ret, (ret - 0.02) / vol AS sh, (SELECT min(vol) FROM p) AS lo, (SELECT max(vol) FROM p) AS hi FROM p JOIN q USING (set_no))',
        f'SELECT CAST(least(floor((vol - lo) / (hi - lo) * 10), 9) AS INTEGER) AS bucket, {r("max(ret)", 3)} AS "return", {r("arg_max(vol, ret)", 4)} AS volatility, {r("arg_max(sh, ret)")} AS sharpe, count(*) AS sets FROM s GROUP BY 1',
    ),
)
def random_frontier(spark, sf):
    means = known(spark, sf).groupBy("symbol").agg((F.avg("ret") * 252).alias("mean"))
    out = ops.random_frontier(cov_of(spark, sf), means, 300, seed=1, buckets=10)
    return near(near(near(out, "sharpe"), "volatility", digits=4), "return", digits=3)


@query(
    "limited_weights",
    "R20",
    with_(
        HOLDINGS_SQL,
        "v AS (SELECT portfolio, symbol, quantity * avg_price AS v FROM holdings), w AS (SELECT portfolio, symbol, v / sum(v) OVER (PARTITION BY portfolio) AS weight FROM v)",
        """s AS (SELECT *, row_number() OVER o AS rn, sum(weight) OVER (PARTITION BY portfolio) AS t, count(*) OVER (PARTITION BY portfolio) AS n, coalesce(sum(weight) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS above
  FROM w WINDOW o AS (PARTITION BY portfolio ORDER BY weight DESC, symbol)), f AS (SELECT *, (t - (rn - 1) * 0.25) / (t - above) AS c FROM s),
g AS (SELECT portfolio, arg_min(c, rn) AS c FROM f WHERE weight * c <= 0.25 + 1e-15 GROUP BY portfolio)""",
        f"SELECT portfolio, symbol, {r('CASE WHEN n * 0.25 >= 1 - 1e-12 THEN least(0.25, weight * g.c) END')} AS weight FROM f LEFT JOIN g USING (portfolio)",
    ),
)
def limited_weights(spark, sf):
    """Position weights of every customer capped at a quarter."""
    h = holdings(spark, sf).withColumn("v", F.col("quantity") * F.col("avg_price"))
    total = h.groupBy("portfolio").agg(F.sum("v").alias("t"))
    w = h.join(total, "portfolio").select("portfolio", "symbol", (F.col("v") / F.col("t")).alias("weight"))
    return near(ops.limit_weights(w, 0.25), "weight")


@query(
    "rebalance_cost",
    "R20",
    with_(
        DAILY_SQL,
        "m AS (SELECT symbol, date_trunc('month', b.ts) AS ts, sum(close * volume) AS v FROM bars b GROUP BY symbol, date_trunc('month', b.ts)), w AS (SELECT symbol, ts, v / sum(v) OVER (PARTITION BY ts) AS w FROM m), p AS (SELECT *, lag(w) OVER (PARTITION BY symbol ORDER BY ts) AS pw FROM w)",
        f"SELECT ts, {r('sum(abs(w - coalesce(pw, 0)))')} AS turnover, {r('sum(abs(w - coalesce(pw, 0))) * 0.001', 8)} AS cost FROM p GROUP BY ts",
    ),
)
def rebalance_cost(spark, sf):
    m = fx.daily(spark, sf).groupBy("symbol", F.date_trunc("month", "ts").alias("ts")).agg(F.sum(F.col("close") * F.col("volume")).alias("v"))
    w = m.join(m.groupBy("ts").agg(F.sum("v").alias("t")), "ts").select("symbol", "ts", (F.col("v") / F.col("t")).alias("weight"))
    return near(near(ops.rebalance_cost(w, DAILY), "turnover"), "cost", digits=8)


@query("topk_dropout", "R21")
def topk_dropout(spark, sf):
    m = fx.daily(spark, sf).groupBy("symbol", F.date_trunc("month", "ts").alias("ts")).agg(F.sum("volume").cast("double").alias("score"))
    return ops.topk_dropout(m, 10, 2)


@query(
    "sharpe_significance",
    "R22",
    with_(
        DAILY_SQL, RETURNS, RF,
        "m AS (SELECT symbol, avg(ret) AS m, stddev_samp(ret) AS s, stddev_pop(ret) AS sp, kurtosis_pop(ret) AS k, count(*) AS n FROM rf GROUP BY symbol), g AS (SELECT m.symbol, any_value(m / s) AS sr, any_value(k) AS k, any_value(n) AS n, avg(power((ret - m) / sp, 3)) AS g FROM m JOIN rf ON m.symbol = rf.symbol GROUP BY m.symbol)",
        "z AS (SELECT symbol, n, sr * sqrt(252) AS sharpe, sr / sqrt((1 - g * sr + (k + 2) / 4 * sr * sr) / (n - 1)) AS z FROM g)",
        f"SELECT symbol, n, {rs('sharpe')}, {r('CASE WHEN z >= 7 THEN 1 WHEN z <= -7 THEN 0 ELSE ' + normal_cdf_sql('z') + ' END', 5)} AS probabilistic_sharpe FROM z",
    ),
)
def sharpe_significance(spark, sf):
    rows = returns(spark, sf, daily=True).filter("ret IS NOT NULL")
    out = ops.sharpe_significance(rows, ["symbol"], trials=20)
    return near(near(out, "sharpe"), "probabilistic_sharpe", digits=5).drop("deflated_sharpe")


_BEST = math.sqrt(2 * math.log(20)) * (1 - 0.5772156649015329 / (2 * math.log(20)))


@query(
    "deflated_sharpe",
    "R22",
    with_(
        DAILY_SQL, RETURNS, RF,
        "m AS (SELECT symbol, avg(ret) AS m, stddev_samp(ret) AS s, stddev_pop(ret) AS sp, kurtosis_pop(ret) AS k, count(*) AS n FROM rf GROUP BY symbol), g AS (SELECT m.symbol, any_value(m / s) * sqrt(252) AS sharpe, any_value(k) AS k, any_value(n) AS n, avg(power((ret - m) / sp, 3)) AS g FROM m JOIN rf ON m.symbol = rf.symbol GROUP BY m.symbol)",
        "d AS (SELECT *, (1 - g * power((n - 1) / n, 1.5) * sharpe + ((k + 3) * power((n - 1) / n, 2) - 1) / 4 * sharpe * sharpe) / n AS d FROM g)",
        f"z AS (SELECT *, CASE WHEN d > 0 THEN (sharpe - {_BEST!r}) / sqrt(d) END AS z FROM d)",
        f"SELECT symbol, {rs('sharpe')}, {r('CASE WHEN n < 10 THEN 0 WHEN d <= 0 THEN sharpe WHEN z >= 7 THEN 1 WHEN z <= -7 THEN 0 ELSE ' + normal_cdf_sql('z') + ' END')} AS deflated_sharpe FROM z",
    ),
)
def deflated_sharpe(spark, sf):
    rows = returns(spark, sf, daily=True).filter("ret IS NOT NULL")
    return near(ops.sharpe_significance(rows, ["symbol"], trials=20), "sharpe", "deflated_sharpe").select("symbol", "sharpe", "deflated_sharpe")


_EQ = ["var_95", "var_99", "p25", "p75", "p95", "cvar_95", "cvar_99", "ulcer_index", "omega", "mean", "std", "tail_ratio"]


@query(
    "equity_summary",
    "R23",
    with_(
        DAILY_SQL, NUMBERED, DD_SQL, "rets AS (SELECT *, close / lag(close) OVER (PARTITION BY symbol ORDER BY ts) - 1 AS x FROM dd)",
        "q AS (SELECT symbol, quantile_cont(x, 0.05) AS var_95, quantile_cont(x, 0.01) AS var_99, quantile_cont(x, 0.25) AS p25, quantile_cont(x, 0.75) AS p75, quantile_cont(x, 0.95) AS p95 FROM rets GROUP BY symbol)",
        """a AS (SELECT q.symbol, any_value(var_95) AS var_95, any_value(var_99) AS var_99, any_value(p25) AS p25, any_value(p75) AS p75, any_value(p95) AS p95, avg(x) FILTER (x <= var_95) AS cvar_95, avg(x) FILTER (x <= var_99) AS cvar_99, sqrt(avg(drawdown * drawdown * 10000)) AS ulcer_index,
  sum(x) FILTER (x > 0) / sum(-x) FILTER (x < 0) AS omega, avg(x) AS mean, stddev_samp(x) AS std, count(x) AS n, any_value(abs(p95 / var_95)) AS tail_ratio FROM q JOIN rets ON q.symbol = rets.symbol GROUP BY q.symbol)""",
        f"SELECT symbol, {rs(*_EQ)}, n FROM a",
    ),
)
def equity_summary(spark, sf):
    rows = win.drawdowns(returns(spark, sf, daily=True), DAILY)
    return near(ops.equity_summary(rows, ["symbol"]), *_EQ).drop("skewness", "kurtosis")
