"""Group statistics, index and deal tables, factor evaluation."""

from pyspark.sql import functions as F

from candlewick import fixtures as fx
from candlewick.functions.stats import t_p_sql
from candlewick.operators import aggregates as ops
from candlewick.operators import factors
from candlewick.operators import windows as win
from candlewick.operators.joins import value_holdings
from candlewick.operators.series import DAILY, HOURLY, over_blocks, shared
from candlewick.plans.joins import BENCH, HOLDINGS_SQL, MULT_SQL, benchmark, holdings, multiples, quotes
from candlewick.plans.quality import DEALS_SQL, deals
from candlewick.plans.registry import near, query, r, rs
from candlewick.plans.sql import DAILY as DAILY_SQL
from candlewick.plans.sql import HOURLY as HOURLY_SQL
from candlewick.plans.sql import RETURNS, with_
from candlewick.plans.windows import PAIR_SQL, pair, returns


@query(
    "describe",
    "A8",
    with_(
        HOURLY_SQL,
        "m AS (SELECT symbol, arg_max(volume, (n, -volume)) AS mode FROM (SELECT symbol, volume, count(*) AS n FROM bars GROUP BY ALL) GROUP BY symbol)",
        f"""SELECT b.symbol, {r('avg(volume)')} AS mean, {r('stddev_samp(volume)')} AS std, {r('var_samp(volume)', 4)} AS var, count(volume) AS count, CAST(sum(volume) AS BIGINT) AS sum,
  min(volume) AS min, max(volume) AS max, max(volume) - min(volume) AS range, {r('median(volume)')} AS median, any_value(mode) AS mode FROM bars b JOIN m ON b.symbol = m.symbol GROUP BY b.symbol""",
    ),
)
def describe(spark, sf):
    out = ops.describe(fx.hourly(spark, sf), ["symbol"], "volume").drop("product")
    return near(near(out, "mean", "std", "median"), "var", digits=4)


@query(
    "growth_product",
    "A8",
    with_(HOURLY_SQL, RETURNS, f"SELECT symbol, {r('product(1 + ret)', 5)} AS product FROM rets GROUP BY symbol"),
)
def growth_product(spark, sf):
    rows = returns(spark, sf).select("symbol", (F.col("ret") + 1).alias("g"))
    return near(ops.describe(rows, ["symbol"], "g"), "product", digits=5).select("symbol", "product")


@query(
    "percentiles",
    "A9",
    with_(
        HOURLY_SQL,
        " UNION ALL ".join(f"SELECT symbol, {p}::DOUBLE AS percentile, {r(f'quantile_cont(close, {p / 100})')} AS close FROM bars GROUP BY symbol" for p in ops.PERCENTILES),
    ),
)
def percentiles(spark, sf):
    return near(ops.percentiles(fx.hourly(spark, sf), ["symbol"], "close"), "close")


@query(
    "percentile_of_score",
    "A9",
    with_(HOURLY_SQL, f"SELECT symbol, {r('(count(*) FILTER (close < 50) + count(*) FILTER (close <= 50) + CASE WHEN count(*) FILTER (close = 50) > 0 THEN 1 ELSE 0 END) * 50.0 / count(*)')} AS percentile FROM bars GROUP BY symbol"),
)
def percentile_of_score(spark, sf):
    return near(ops.percentile_of_score(fx.hourly(spark, sf), ["symbol"], "close", 50.0), "percentile")


@query("skew_kurtosis", "A10", with_(HOURLY_SQL, f"SELECT symbol, {r('skewness(close)')} AS skew, {r('kurtosis(close)')} AS kurtosis FROM bars GROUP BY symbol"))
def skew_kurtosis(spark, sf):
    return near(ops.moments(fx.hourly(spark, sf), ["symbol"], "close"), "skew", "kurtosis")


@query(
    "pair_summary",
    "A11",
    with_(HOURLY_SQL, PAIR_SQL, f"SELECT symbol, {r('covar_samp(close, bench)', 4)} AS cov, {r('corr(close, bench)')} AS corr, {r('covar_samp(close, bench) / var_samp(bench)')} AS beta, {r('power(corr(close, bench), 2)')} AS r2 FROM pair GROUP BY symbol"),
)
def pair_summary(spark, sf):
    return near(near(ops.pair_summary(pair(spark, sf), ["symbol"], "close", "bench"), "corr", "beta", "r2"), "cov", digits=4)


@query(
    "downside_variance",
    "A12",
    with_(HOURLY_SQL, RETURNS, f"SELECT symbol, {r('var_samp(ret) FILTER (ret < 0)')} AS semi_variance, {r('sum(ret * ret)', 4)} AS realized_variance FROM rets GROUP BY symbol"),
)
def downside_variance(spark, sf):
    return near(near(ops.downside(returns(spark, sf), ["symbol"], "ret"), "semi_variance"), "realized_variance", digits=4)


@query(
    "winsorize",
    "A12",
    with_(
        HOURLY_SQL,
        "q AS (SELECT symbol, quantile_cont(close, 0.01) AS lo, quantile_cont(close, 0.99) AS hi FROM bars GROUP BY symbol)",
        f"SELECT b.symbol, ts, {r('greatest(least(close, hi), lo)')} AS winsorized FROM bars b JOIN q ON b.symbol = q.symbol",
    ),
)
def winsorize(spark, sf):
    return near(ops.winsorize(fx.hourly(spark, sf).select("symbol", "ts", "close"), ["symbol"], "close"), "winsorized").drop("close")


@query(
    "monthly_returns",
    "A13",
    with_(
        DAILY_SQL,
        RETURNS,
        "SELECT symbol, CAST(year(ts) AS INTEGER) AS year, "
        + ", ".join(f"{r(f'exp(sum(ln(1 + ret)) FILTER (month(ts) = {m})) - 1')} AS m{m:02d}" for m in range(1, 13))
        + f", {r('exp(sum(ln(1 + ret))) - 1')} AS total FROM rets WHERE ret IS NOT NULL GROUP BY symbol, year(ts)",
    ),
)
def monthly_returns(spark, sf):
    rows = returns(spark, sf, daily=True).filter("ret IS NOT NULL")
    out = ops.monthly_returns(rows, ["symbol"], "ts", "ret")
    return near(out, *[f"m{m:02d}" for m in range(1, 13)], "total")


@query(
    "calendar_effects",
    "A14",
    with_(
        DAILY_SQL,
        RETURNS,
        f"""SELECT 'weekday' AS effect, CAST(isodow(ts) - 1 AS INTEGER) AS part, {r('avg(ret)')} AS mean_return, {r('avg(ret) / (stddev_samp(ret) / sqrt(count(ret)))')} AS t_stat, count(ret) AS n FROM rets WHERE isodow(ts) <= 5 GROUP BY ALL HAVING count(ret) > 10
UNION ALL SELECT 'month', CAST(month(ts) AS INTEGER), {r('avg(ret)')}, {r('avg(ret) / (stddev_samp(ret) / sqrt(count(ret)))')}, count(ret) FROM rets GROUP BY month(ts) HAVING count(ret) > 5""",
    ),
)
def calendar_effects(spark, sf):
    return near(ops.calendar_effects(returns(spark, sf, daily=True), "ts", "ret"), "mean_return", "t_stat")


_TWO = "avg(ret) FILTER ({a}) AS m1, avg(ret) FILTER ({b}) AS m2, var_samp(ret) FILTER ({a}) AS v1, var_samp(ret) FILTER ({b}) AS v2, count(ret) FILTER ({a}) AS n1, count(ret) FILTER ({b}) AS n2"
_TWO_OUT = f"{r('m1')} AS mean_first, {r('m2')} AS mean_second, n1 AS n_first, n2 AS n_second, {r('m1 - m2')} AS difference, {r('(m1 - m2) / sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2) * (1.0 / n1 + 1.0 / n2))')} AS t_stat"


@query(
    "january_effect",
    "A14",
    with_(DAILY_SQL, RETURNS, "g AS (SELECT " + _TWO.format(a="month(ts) = 1", b="month(ts) <> 1") + " FROM rets)", f"SELECT {_TWO_OUT} FROM g"),
)
def january_effect(spark, sf):
    return near(ops.january_effect(returns(spark, sf, daily=True), "ts", "ret"), "mean_first", "mean_second", "difference", "t_stat")


_T = "(m1 - m2) / sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2) * (1.0 / n1 + 1.0 / n2))"


@query(
    "january_significance",
    "A14",
    with_(
        DAILY_SQL, RETURNS, "g AS (SELECT " + _TWO.format(a="month(ts) = 1", b="month(ts) <> 1") + " FROM rets)", f"h AS (SELECT *, {_T} AS t FROM g)",
        f"SELECT {_TWO_OUT}, {r(t_p_sql('t', 'n1 + n2 - 2'))} AS p_value FROM h",
    ),
)
def january_significance(spark, sf):
    out = ops.january_effect(returns(spark, sf, daily=True), "ts", "ret")
    out = ops.with_p_value(out, "t_stat", F.col("n_first") + F.col("n_second") - 2)
    return near(out, "mean_first", "mean_second", "difference", "t_stat", "p_value")


def _decile_sql(by, ret, src, floor):
    edges = ", ".join(f"quantile_cont({by}, {i / 10}) AS q{i}" for i in range(1, 10))
    bucket = " + ".join(f"({by} > q{i})::INT" for i in range(1, 10))
    return (
        f"q AS (SELECT {edges} FROM {src} WHERE {by} IS NOT NULL AND {ret} IS NOT NULL), d AS (SELECT *, CAST({bucket} + 1 AS INTEGER) AS decile FROM {src}, q WHERE {by} IS NOT NULL AND {ret} IS NOT NULL)",
        f"SELECT decile, {r(f'avg({ret})')} AS mean_return, {r(f'stddev_samp({ret})')} AS volatility, {r(f'avg({ret}) / stddev_samp({ret})')} AS sharpe, count({ret}) AS n FROM d GROUP BY decile HAVING count({ret}) > {floor}",
    )


@query("size_deciles", "A15", with_(DAILY_SQL, RETURNS, "c AS (SELECT symbol, ts, ret, close * volume AS cap FROM rets)", *_decile_sql("cap", "ret", "c", 20)))
def size_deciles(spark, sf):
    rows = returns(spark, sf, daily=True).withColumn("cap", F.col("close") * F.col("volume"))
    return near(ops.decile_performance(rows, "cap", "ret"), "mean_return", "volatility", "sharpe")


MOMENTUM_SQL = """rn AS (SELECT symbol, ts, ret, row_number() OVER (PARTITION BY symbol ORDER BY ts) AS k FROM rets WHERE ret IS NOT NULL),
mo AS (SELECT symbol, ts, CASE WHEN k >= 252 THEN exp(sum(ln(1 + ret)) OVER (PARTITION BY symbol ORDER BY ts ROWS BETWEEN 251 PRECEDING AND 21 PRECEDING)) - 1 END AS momentum,
  CASE WHEN count(*) OVER (PARTITION BY symbol ORDER BY ts ROWS BETWEEN 1 FOLLOWING AND 21 FOLLOWING) = 21 THEN exp(sum(ln(1 + ret)) OVER (PARTITION BY symbol ORDER BY ts ROWS BETWEEN 1 FOLLOWING AND 21 FOLLOWING)) - 1 END AS future_return FROM rn)"""


def momentum(spark, sf):
    """Past and next returns, computed once for the quantiles and for the rows."""
    return shared(ops.momentum_panel(returns(spark, sf, daily=True, closes=True), DAILY).select("symbol", "ts", "momentum", "future_return"), "symbol", "ts")


@query("momentum_deciles", "A15", with_(DAILY_SQL, RETURNS, MOMENTUM_SQL, *_decile_sql("momentum", "future_return", "mo", 5)))
def momentum_deciles(spark, sf):
    rows = momentum(spark, sf)
    return near(ops.decile_performance(rows, "momentum", "future_return", at_least=5), "mean_return", "volatility", "sharpe")


@query(
    "winner_minus_loser",
    "A15",
    with_(
        DAILY_SQL,
        RETURNS,
        MOMENTUM_SQL,
        _decile_sql("momentum", "future_return", "mo", 5)[0],
        "e AS (SELECT decile, future_return AS ret FROM d), g AS (SELECT " + _TWO.format(a="decile = 10", b="decile = 1") + " FROM e)",
        f"SELECT {_TWO_OUT} FROM g",
    ),
)
def winner_minus_loser(spark, sf):
    rows = momentum(spark, sf)
    rows = win.cross_quantile(rows, "momentum", 10, by=())
    out = ops.two_groups(rows, "future_return", F.col("bucket") == 9, F.col("bucket") == 0)
    return near(out, "mean_first", "mean_second", "difference", "t_stat")


def trades(spark, sf):
    """Positions as closed trades: profit of the line against the list price, holding time in days."""
    l, o, p = fx.table(spark, sf, "lineitem"), fx.table(spark, sf, "orders"), fx.table(spark, sf, "part")
    rows = l.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(p, F.col("l_partkey") == F.col("p_partkey"))
    return rows.select(
        F.col("l_suppkey").alias("symbol"), F.col("o_custkey").alias("portfolio"), F.col("l_shipdate").cast("timestamp").alias("ts"),
        (F.col("l_orderkey") * 16 + F.col("l_linenumber")).alias("seq"),
        F.round(F.col("l_extendedprice") - F.col("l_quantity") * F.col("p_retailprice") * 2, 2).alias("pnl"),
        F.abs(F.datediff("l_shipdate", "o_orderdate")).alias("bars_held"),
    )


TRADES_SQL = """closed AS (SELECT l_suppkey AS symbol, o_custkey AS portfolio, l_shipdate AS ts, l_orderkey * 16 + l_linenumber AS seq, round(l_extendedprice - l_quantity * p_retailprice * 2, 2) AS pnl,
  abs(datediff('day', o_orderdate, l_shipdate)) AS bars_held FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""


@query(
    "trade_statistics",
    "A16",
    with_(
        TRADES_SQL,
        f"""SELECT symbol, {r('sum(pnl)', 2)} AS total_pnl, count(*) AS trades, count(*) FILTER (pnl > 0) AS wins, count(*) FILTER (pnl < 0) AS losses, max(pnl) AS largest_win, min(pnl) AS largest_loss,
  {r('count(*) FILTER (pnl > 0) * 100.0 / count(*)')} AS win_rate, {r('avg(pnl)', 4)} AS avg_pnl, {r('sum(pnl) FILTER (pnl > 0) / abs(sum(pnl) FILTER (pnl <= 0))')} AS profit_factor, {r('avg(bars_held)')} AS avg_bars_held FROM closed GROUP BY symbol""",
    ),
)
def trade_statistics(spark, sf):
    out = ops.trade_statistics(trades(spark, sf), ["symbol"])
    return near(near(near(out, "win_rate", "profit_factor", "avg_bars_held"), "total_pnl", digits=2), "avg_pnl", digits=4)


@query(
    "concentration",
    "A17",
    with_(
        HOLDINGS_SQL,
        """w AS (SELECT portfolio, market_value, market_value / sum(market_value) OVER p AS w, count(*) OVER p AS n, row_number() OVER (PARTITION BY portfolio ORDER BY market_value DESC) AS k FROM valued WINDOW p AS (PARTITION BY portfolio))""",
        f"""SELECT portfolio, count(*) AS holdings, {r('sum(market_value)', 2)} AS total_value, {r('sum(w * w)')} AS hhi, {r('max(abs(w - 1.0 / n))')} AS max_deviation, {r('sum(w) FILTER (k <= 3)')} AS top_3,
  {r('sum(w) FILTER (k <= 5)')} AS top_5, {r('1 / sum(w * w)')} AS effective_n, sum(w * w) > 0.25 AS concentrated FROM w GROUP BY portfolio""",
    ),
)
def concentration(spark, sf):
    out = ops.concentration(value_holdings(holdings(spark, sf), quotes(spark, sf)), ["portfolio"], "market_value")
    return near(near(out, "hhi", "max_deviation", "top_3", "top_5", "effective_n"), "total_value", digits=2)


@query(
    "tax_report",
    "A18",
    with_(
        HOLDINGS_SQL,
        "g AS (SELECT portfolio, cost_basis, market_value, market_value - cost_basis AS gain FROM valued)",
        f"""SELECT portfolio, {r('sum(cost_basis)', 2)} AS cost_basis, {r('sum(market_value)', 2)} AS market_value, {r('sum(gain)', 2)} AS unrealized_gain, {r('sum(CASE WHEN gain > 0 THEN gain ELSE 0 END)', 2)} AS short_term_gains,
  {r('sum(CASE WHEN gain <= 0 THEN gain ELSE 0 END)', 2)} AS harvestable_loss, count(*) FILTER (gain <= 0) AS loss_positions, count(*) AS positions, {r('sum(gain) / sum(cost_basis) * 100', 4)} AS gain_pct,
  {r('sum(CASE WHEN gain > 0 THEN gain ELSE 0 END) * 0.22', 2)} AS estimated_tax, {r('abs(sum(CASE WHEN gain <= 0 THEN gain ELSE 0 END)) * 0.22', 2)} AS tax_savings FROM g GROUP BY portfolio""",
    ),
)
def tax_report(spark, sf):
    h = holdings(spark, sf).join(quotes(spark, sf).select("symbol", F.col("price").alias("current_price")), "symbol", "left")
    out = ops.tax_report(h, ["portfolio"])
    return near(near(out, "cost_basis", "market_value", "unrealized_gain", "short_term_gains", "harvestable_loss", "estimated_tax", "tax_savings", digits=2), "gain_pct", digits=4)


def constituents(spark, sf):
    """Parts as index members, one index per brand; shares from the size."""
    return fx.table(spark, sf, "part").select(
        F.col("p_brand").alias("index"), F.col("p_partkey").alias("symbol"), F.col("p_type").alias("sector"), F.col("p_retailprice").alias("price"),
        (F.col("p_size") * 1000).cast("double").alias("shares"), (F.col("p_size") * 1000 * (1 - F.col("p_partkey") % 4 / 10)).alias("float_shares"),
        (F.col("p_size") * 1000 * F.col("p_retailprice")).alias("market_cap"), (F.col("p_partkey") % 5 / 100).alias("dividend_yield"),
    )


CONST_SQL = """cons AS (SELECT p_brand AS "index", p_partkey AS symbol, p_type AS sector, p_retailprice AS price, CAST(p_size * 1000 AS DOUBLE) AS shares, p_size * 1000 * (1 - p_partkey % 4 / 10) AS float_shares,
  p_size * 1000 * p_retailprice AS market_cap, p_partkey % 5 / 100 AS dividend_yield FROM part)"""


@query(
    "index_weights",
    "A19",
    with_(
        CONST_SQL,
        f"""SELECT "index", symbol, {r('price / sum(price) OVER w')} AS w_price, {r('market_cap / sum(market_cap) OVER w')} AS w_cap, {r('1.0 / count(*) OVER w')} AS w_equal,
  {r('float_shares * price / sum(float_shares * price) OVER w')} AS w_float, {r('market_cap / sum(market_cap) OVER w')} AS w_fundamental FROM cons WINDOW w AS (PARTITION BY "index")""",
    ),
)
def index_weights(spark, sf):
    out = near(ops.index_weights(constituents(spark, sf), ["index"]), "w_price", "w_cap", "w_equal", "w_float", "w_fundamental")
    return out.select("index", "symbol", "w_price", "w_cap", "w_equal", "w_float", "w_fundamental")


@query(
    "index_levels",
    "A20",
    with_(
        DAILY_SQL,
        "base AS (SELECT symbol, arg_min(close, ts) AS base_price, sum(volume) AS shares, sum(volume) / 2 AS float_shares FROM bars GROUP BY symbol)",
        f"""SELECT ts, {r('100 * sum(close) / sum(base_price)')} AS price_weighted, {r('100 * sum(shares * close) / sum(shares * base_price)')} AS cap_weighted,
  {r('100 * sum(float_shares * close) / sum(float_shares * base_price)')} AS float_weighted, {r('100 * avg(close / base_price)')} AS equal_weighted FROM bars JOIN base USING (symbol) GROUP BY ts""",
    ),
)
def index_levels(spark, sf):
    d = fx.daily(spark, sf)
    base = d.groupBy("symbol").agg(F.min_by("close", "ts").alias("base_price"), F.sum("volume").alias("shares"), (F.sum("volume") / 2).alias("float_shares"))
    out = ops.index_levels(d.select("symbol", "ts", F.col("close").alias("price")), base, ["ts"])
    return near(out, "price_weighted", "cap_weighted", "float_weighted", "equal_weighted")


@query(
    "index_composition",
    "A20",
    with_(
        CONST_SQL,
        'w AS (SELECT *, market_cap / sum(market_cap) OVER (PARTITION BY "index") AS w FROM cons), k AS (SELECT *, row_number() OVER (PARTITION BY "index" ORDER BY w DESC) AS k FROM w)',
        f"""SELECT "index", count(*) AS constituents, {r('sum(w * w)')} AS hhi, {r('sum(w * dividend_yield)')} AS dividend_yield, {r('sum(w) FILTER (k <= 5)')} AS top_5, {r('sum(w) FILTER (k <= 10)')} AS top_10, {r('1 / sum(w * w)')} AS effective_n FROM k GROUP BY "index" """,
    ),
)
def index_composition(spark, sf):
    w = ops.index_weights(constituents(spark, sf), ["index"])
    return near(ops.index_composition(w, ["index"], "w_cap", "dividend_yield"), "hhi", "dividend_yield", "top_5", "top_10", "effective_n")


@query(
    "sector_allocation",
    "A20",
    with_(CONST_SQL, 'w AS (SELECT *, market_cap / sum(market_cap) OVER (PARTITION BY "index") AS w FROM cons)', f'SELECT "index", sector, {r("sum(w)")} AS weight FROM w GROUP BY ALL'),
)
def sector_allocation(spark, sf):
    w = ops.index_weights(constituents(spark, sf), ["index"])
    return near(ops.sector_allocation(w, ["index"], "w_cap"), "weight")


@query(
    "industry_stats",
    "A21",
    with_(
        DEALS_SQL,
        f"""SELECT industry, count(*) AS deal_count, {r('sum(deal_value)', 2)} AS total_value, {r('avg(deal_value)', 4)} AS avg_value, {r('avg(premium_1day)')} AS avg_premium_1day, {r('avg(premium_4week)')} AS avg_premium_4week
FROM deals WHERE announcement_date BETWEEN '1996-01-01' AND '1998-12-31' GROUP BY industry""",
    ),
)
def industry_stats(spark, sf):
    out = ops.industry_stats(deals(spark, sf), "1996-01-01", "1998-12-31")
    return near(near(near(out, "avg_premium_1day", "avg_premium_4week"), "total_value", digits=2), "avg_value", digits=4)


@query(
    "compare_deals",
    "A22",
    with_(
        DEALS_SQL,
        " UNION ALL ".join(f"SELECT industry, '{m}' AS metric, min({m}) AS min, max({m}) AS max, {r(f'avg({m})', 4)} AS mean, {r(f'median({m})', 4)} AS median FROM deals GROUP BY industry" for m in ("deal_value", "premium_1day")),
    ),
)
def compare_deals(spark, sf):
    return near(ops.spread_statistics(deals(spark, sf), ["industry"], ["deal_value", "premium_1day"]), "mean", "median", digits=4)


@query("rank_deals", "A22", with_(DEALS_SQL, "SELECT deal_id, industry, row_number() OVER (PARTITION BY industry ORDER BY premium_1day DESC, deal_id) AS rank FROM deals"))
def rank_deals(spark, sf):
    return ops.rank_deals(deals(spark, sf), "premium_1day", ["industry"]).select("deal_id", "industry", "rank")


_PAY = "CASE WHEN payment_method LIKE '1%' THEN 100 WHEN payment_method LIKE '2%' THEN 0 ELSE 60 END"


@query(
    "payment_structure",
    "A22",
    with_(
        DEALS_SQL,
        f"p AS (SELECT industry, {_PAY} AS c FROM deals)",
        f"""SELECT industry, count(*) AS total, count(*) FILTER (c = 100) AS all_cash, count(*) FILTER (c = 0) AS all_stock, count(*) FILTER (c = 60) AS mixed, {r('avg(c)')} AS avg_cash_pct, {r('avg(100 - c)')} AS avg_stock_pct,
  {r('count(*) FILTER (c = 100) * 100.0 / count(*)')} AS all_cash_share, {r('count(*) FILTER (c = 0) * 100.0 / count(*)')} AS all_stock_share FROM p GROUP BY industry""",
    ),
)
def payment_structure(spark, sf):
    p = F.col("payment_method")
    cash = F.when(p.startswith("1"), 100).when(p.startswith("2"), 0).otherwise(60)
    d = deals(spark, sf).withColumn("cash_pct", cash).withColumn("stock_pct", 100 - F.col("cash_pct"))
    return near(ops.payment_structure(d, ["industry"]), "avg_cash_pct", "avg_stock_pct", "all_cash_share", "all_stock_share")


@query(
    "premium_position",
    "A22",
    with_(
        DEALS_SQL,
        "q AS (SELECT industry, quantile_cont(premium_1day, 0.25) AS a, quantile_cont(premium_1day, 0.5) AS b, quantile_cont(premium_1day, 0.75) AS c FROM deals GROUP BY industry)",
        """SELECT deal_id, CASE WHEN premium_1day < a THEN 'below 25th percentile' WHEN premium_1day < b THEN 'between 25th and 50th percentile' WHEN premium_1day < c THEN 'between 50th and 75th percentile' ELSE 'above 75th percentile' END AS position,
  premium_1day > b AS above_median FROM deals JOIN q USING (industry)""",
    ),
)
def premium_position(spark, sf):
    return ops.premium_position(deals(spark, sf), ["industry"], "premium_1day").select("deal_id", "position", "above_median")


@query(
    "synergy_share",
    "A22",
    with_(
        DEALS_SQL,
        "s AS (SELECT industry, deal_value, premium_4week * 1000 AS synergies, premium_4week * 1000 / deal_value * 100 AS synergy_pct FROM deals WHERE deal_status <> 'Withdrawn')",
        f"t AS (SELECT industry, count(*) AS deals, {r('sum(synergies)', 2)} AS total_synergies FROM s GROUP BY industry)",
        f"SELECT x.*, deals, total_synergies FROM (" + " UNION ALL ".join(f"SELECT industry, '{m}' AS metric, {r(f'min({m})', 4)} AS min, {r(f'max({m})', 4)} AS max, {r(f'avg({m})', 4)} AS mean, {r(f'median({m})', 4)} AS median FROM s GROUP BY industry" for m in ("synergies", "synergy_pct")) + ") x JOIN t USING (industry)",
    ),
)
def synergy_share(spark, sf):
    d = deals(spark, sf).withColumn("synergies", F.when(F.col("deal_status") != "Withdrawn", F.col("premium_4week") * 1000))
    return near(near(ops.synergy_share(d, ["industry"]), "min", "max", "mean", "median", digits=4), "total_synergies", digits=2)


@query(
    "multiple_statistics",
    "A23",
    with_(
        DEALS_SQL,
        MULT_SQL,
        "j AS (SELECT industry, deal_value, ev_revenue, ev_ebitda FROM deals JOIN mult USING (deal_id))",
        " UNION ALL ".join(
            f"SELECT industry, '{m}' AS multiple, {r(f'avg({m})', 4)} AS mean, {r(f'count({m}) / sum(1 / {m})', 4)} AS harmonic_mean, {r(f'sum(deal_value) / sum(deal_value / {m})', 4)} AS weighted_harmonic_mean, {r(f'min({m})', 4)} AS min, {r(f'max({m})', 4)} AS max, "
            f"{r(f'stddev_samp({m})', 4)} AS std, count({m}) AS count, {r(f'quantile_cont({m}, 0.25)', 4)} AS q1, {r(f'median({m})', 4)} AS median, {r(f'quantile_cont({m}, 0.75)', 4)} AS q3 FROM j WHERE {m} > 0 GROUP BY industry"
            for m in ("ev_revenue", "ev_ebitda")
        ),
    ),
)
def multiple_statistics(spark, sf):
    rows = deals(spark, sf).join(multiples(spark, sf), "deal_id")
    out = ops.multiple_statistics(rows, ["industry"], ["ev_revenue", "ev_ebitda"], "deal_value")
    return near(out, "mean", "harmonic_mean", "weighted_harmonic_mean", "min", "max", "std", "q1", "median", "q3", digits=4)


def factor_panel(spark, sf):
    """Daily bars: factor = 5-bar return, second factor = volume, target = next bar's return."""
    rows = over_blocks(
        fx.daily(spark, sf).select("symbol", "ts", "close", "volume"), DAILY,
        lambda w: {"factor": win.pct_change(w, "close", 5), "fwd": F.lead("close").over(w) / F.col("close") - 1}, back=5, ahead=1,
    )
    return rows.select("symbol", "ts", "factor", F.col("volume").cast("double").alias("vol"), "fwd", "close")


PANEL_SQL = """panel AS (SELECT symbol, ts, close, close / lag(close, 5) OVER w - 1 AS factor, CAST(volume AS DOUBLE) AS vol, lead(close) OVER w / close - 1 AS fwd FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY ts)),
pf AS (SELECT * FROM panel WHERE factor IS NOT NULL AND fwd IS NOT NULL)"""
IC_SQL = "ic AS (SELECT ts, corr(factor, fwd) AS ic, count(*) AS names FROM pf GROUP BY ts HAVING count(*) >= 10)"
RANKED_SQL = """rk AS (SELECT ts, rank() OVER (PARTITION BY ts ORDER BY factor) + (count(*) OVER (PARTITION BY ts, factor) - 1) / 2.0 AS factor, rank() OVER (PARTITION BY ts ORDER BY fwd) + (count(*) OVER (PARTITION BY ts, fwd) - 1) / 2.0 AS fwd FROM pf)"""


@query("information_coefficient", "A24", with_(DAILY_SQL, PANEL_SQL, IC_SQL, f"SELECT ts, {rs('ic')}, names FROM ic"))
def information_coefficient(spark, sf):
    return near(factors.information_coefficients(factor_panel(spark, sf), "factor", "fwd"), "ic")


@query("rank_information_coefficient", "A24", with_(DAILY_SQL, PANEL_SQL, RANKED_SQL, f"SELECT ts, {r('corr(factor, fwd)')} AS ic, count(*) AS names FROM rk GROUP BY ts HAVING count(*) >= 10"))
def rank_information_coefficient(spark, sf):
    return near(factors.information_coefficients(factor_panel(spark, sf), "factor", "fwd", method="spearman"), "ic")


@query(
    "ic_summary",
    "A24",
    with_(
        DAILY_SQL, PANEL_SQL, IC_SQL,
        f"SELECT {r('avg(ic)')} AS ic_mean, {r('stddev_pop(ic)')} AS ic_std, {r('avg(ic) / stddev_pop(ic)')} AS icir, {r('count(*) FILTER (ic > 0) * 1.0 / count(ic)')} AS hit_rate, {r('max(ic)')} AS ic_max, {r('min(ic)')} AS ic_min, {r('kurtosis_pop(ic)')} AS ic_kurtosis, {r('avg(ic) / (stddev_samp(ic) / sqrt(count(ic)))')} AS t_stat, count(ic) AS dates FROM ic",
    ),
)
def ic_summary(spark, sf):
    out = factors.ic_summary(factors.information_coefficients(factor_panel(spark, sf), "factor", "fwd")).drop("ic_skew")
    return near(out, "ic_mean", "ic_std", "icir", "hit_rate", "ic_max", "ic_min", "ic_kurtosis", "t_stat")


@query(
    "ic_significance",
    "A24",
    with_(
        DAILY_SQL, PANEL_SQL, IC_SQL, "s AS (SELECT avg(ic) / (stddev_samp(ic) / sqrt(count(ic))) AS t, count(ic) AS dates FROM ic)",
        f"SELECT {r('t')} AS t_stat, CASE WHEN dates < 10 THEN 1.0 ELSE {r(t_p_sql('t', 'dates - 1'))} END AS p_value, dates FROM s",
    ),
)
def ic_significance(spark, sf):
    out = factors.ic_summary(factors.information_coefficients(factor_panel(spark, sf), "factor", "fwd"))
    return near(factors.ic_significance(out), "t_stat", "p_value").select("t_stat", "p_value", "dates")


BUCKETS_SQL = """n AS (SELECT ts FROM pf GROUP BY ts HAVING count(*) >= 15), q AS (SELECT ts, quantile_cont(factor, 1 / 3) AS a, quantile_cont(factor, 2 / 3) AS b FROM pf GROUP BY ts),
bk AS (SELECT pf.ts, CAST((factor > a)::INT + (factor > b)::INT + 1 AS INTEGER) AS bucket, avg(fwd) AS m FROM pf JOIN n ON pf.ts = n.ts JOIN q ON pf.ts = q.ts GROUP BY ALL)"""


@query(
    "quantile_returns",
    "A25",
    with_(
        DAILY_SQL, PANEL_SQL, BUCKETS_SQL,
        f"SELECT bucket, {r('avg(m)')} AS mean_return, {r('stddev_pop(m)')} AS std_return, {r('avg(m) / stddev_pop(m) * sqrt(252)')} AS sharpe, {r('count(*) FILTER (m > 0) * 1.0 / count(m)')} AS win_rate, count(m) AS observations FROM bk GROUP BY bucket",
    ),
)
def quantile_returns(spark, sf):
    return near(factors.quantile_returns(factor_panel(spark, sf), "factor", "fwd", 3), "mean_return", "std_return", "sharpe", "win_rate")


@query(
    "long_short",
    "A25",
    with_(
        DAILY_SQL, PANEL_SQL, BUCKETS_SQL,
        "p AS (SELECT ts, max(m) FILTER (bucket = 1) - max(m) FILTER (bucket = 3) AS ls FROM bk GROUP BY ts), g AS (SELECT bucket, avg(m) AS m FROM bk GROUP BY bucket), h AS (SELECT max(m) FILTER (bucket = 1) AS a, max(m) FILTER (bucket = 2) AS b, max(m) FILTER (bucket = 3) AS c FROM g)",
        f"SELECT {r('avg(ls)')} AS long_short_mean, {r('avg(ls) / stddev_pop(ls) * sqrt(252)')} AS long_short_sharpe, {r('any_value(a - c)')} AS spread, any_value(((a > b)::INT + (b > c)::INT) / 2.0)::DOUBLE AS monotonicity FROM p, h",
    ),
)
def long_short(spark, sf):
    return near(factors.long_short(factor_panel(spark, sf), "factor", "fwd", 3), "long_short_mean", "long_short_sharpe", "spread")


TURN_SQL = """tp AS (SELECT ts, symbol, row_number() OVER (PARTITION BY ts ORDER BY factor DESC, symbol) AS k FROM panel WHERE factor IS NOT NULL),
st AS (SELECT d.ts, list_sort(list(symbol) FILTER (symbol IS NOT NULL)) AS s FROM (SELECT DISTINCT ts FROM panel) d LEFT JOIN (SELECT * FROM tp WHERE k <= 5) t ON d.ts = t.ts GROUP BY d.ts),
pv AS (SELECT ts, s, lag(s) OVER (ORDER BY ts) AS p FROM st),
tv AS (SELECT ts, (len(list_filter(s, lambda x: NOT list_contains(p, x))) + len(list_filter(p, lambda x: NOT list_contains(s, x)))) / 5.0 AS turnover FROM pv WHERE s IS NOT NULL AND p IS NOT NULL)"""


@query("membership_turnover", "A26", with_(DAILY_SQL, PANEL_SQL, TURN_SQL, f"SELECT ts, {rs('turnover')} FROM tv"))
def membership_turnover(spark, sf):
    return near(factors.membership_turnover(factor_panel(spark, sf), "factor", 5), "turnover")


@query("turnover_summary", "A26", with_(DAILY_SQL, PANEL_SQL, TURN_SQL, f"SELECT {r('avg(turnover)')} AS mean, {r('stddev_pop(turnover)')} AS std, {r('max(turnover)')} AS max, {r('min(turnover)')} AS min, count(*) AS observations FROM tv"))
def turnover_summary(spark, sf):
    return near(factors.turnover_summary(factors.membership_turnover(factor_panel(spark, sf), "factor", 5)), "mean", "std", "max", "min")


@query(
    "select_features",
    "A27",
    with_(
        DAILY_SQL, PANEL_SQL,
        "f AS (" + " UNION ALL ".join(f"SELECT '{c}' AS feature, abs(corr({c}, fwd)) AS abs_ic, count(*) AS n FROM panel WHERE {c} IS NOT NULL AND fwd IS NOT NULL" for c in ("factor", "vol", "close")) + ")",
        f"SELECT feature, {rs('abs_ic')}, n FROM f ORDER BY abs_ic DESC LIMIT 2",
    ),
)
def select_features(spark, sf):
    return near(factors.select_features(factor_panel(spark, sf), ["factor", "vol", "close"], "fwd", 2), "abs_ic")


@query("weighted_sum", "A28", with_(HOURLY_SQL, f"SELECT symbol, ts, {r('0.2 * open + 0.5 * close + 0.3 * low')} AS blend FROM bars"))
def weighted_sum(spark, sf):
    return near(fx.hourly(spark, sf).select("symbol", "ts", ops.weighted_sum({"open": 0.2, "close": 0.5, "low": 0.3}).alias("blend")), "blend")


def factor_returns(spark, sf):
    """Symbol returns next to two factor returns: the equal-weight mean and the mean of the square roots of volume."""
    m = fx.hourly(spark, sf).groupBy("ts").agg(F.avg(F.sqrt("volume")).alias("flow"))
    return returns(spark, sf).filter("ret IS NOT NULL").select("symbol", "ts", "ret").join(benchmark(spark, sf), "ts").join(m, "ts")


FACTOR_SQL = BENCH + """, fl AS (SELECT ts, avg(sqrt(volume)) AS flow FROM bars GROUP BY ts),
fr AS (SELECT symbol, r.ts, ret, bench, flow FROM rets r JOIN bench b ON r.ts = b.ts JOIN fl ON r.ts = fl.ts WHERE ret IS NOT NULL),
be AS (SELECT symbol, covar_samp(ret, bench) / var_samp(bench) AS b1, covar_samp(ret, flow) / var_samp(flow) AS b2, var_samp(bench) AS v1, var_samp(flow) AS v2, var_samp(ret) AS v FROM fr GROUP BY symbol)"""


@query(
    "factor_exposure",
    "A29",
    with_(HOURLY_SQL, RETURNS, FACTOR_SQL, f"SELECT symbol, {r('b1', 5)} AS beta_bench, {r('b2', 5)} AS beta_flow, {r('b1 * b1 * v1 / v')} AS share_bench, {r('b2 * b2 * v2 / v')} AS share_flow, {r('1 - b1 * b1 * v1 / v - b2 * b2 * v2 / v')} AS share_unexplained FROM be"),
)
def factor_exposure(spark, sf):
    out = ops.factor_exposure(factor_returns(spark, sf), ["symbol"], "ret", ["bench", "flow"])
    return near(near(out, "share_bench", "share_flow", "share_unexplained"), "beta_bench", "beta_flow", digits=5)


@query(
    "factor_pnl",
    "A29",
    with_(HOURLY_SQL, RETURNS, FACTOR_SQL, f"SELECT f.symbol, ts, {r('b1 * bench', 4)} AS pnl_bench, {r('b2 * flow', 4)} AS pnl_flow, {r('ret', 4)} AS total_pnl, {r('b1 * bench + b2 * flow', 4)} AS explained, {r('ret - b1 * bench - b2 * flow', 4)} AS unexplained FROM fr f JOIN be ON f.symbol = be.symbol"),
)
def factor_pnl(spark, sf):
    out = ops.factor_pnl(factor_returns(spark, sf), ["symbol"], "ret", ["bench", "flow"]).drop("ret", "bench", "flow")
    return near(out, "pnl_bench", "pnl_flow", "total_pnl", "explained", "unexplained", digits=4)


@query(
    "least_squares",
    "A29",
    with_(
        HOURLY_SQL, RETURNS, FACTOR_SQL,
        "c AS (SELECT symbol, count(*) AS n, covar_samp(bench, bench) AS saa, covar_samp(flow, flow) AS sbb, covar_samp(bench, flow) AS sab, covar_samp(ret, bench) AS say, covar_samp(ret, flow) AS sby, avg(ret) AS my, avg(bench) AS ma, avg(flow) AS mb, var_samp(ret) AS vy FROM fr GROUP BY symbol)",
        "e AS (SELECT *, (say * sbb - sby * sab) / (saa * sbb - sab * sab) AS b1, (sby * saa - say * sab) / (saa * sbb - sab * sab) AS b2 FROM c)",
        f"SELECT symbol, 'bench' AS term, {r('b1', 4)} AS coef, {r('(b1 * say + b2 * sby) / vy', 5)} AS r2, n FROM e UNION ALL SELECT symbol, 'flow', {r('b2', 4)}, {r('(b1 * say + b2 * sby) / vy', 5)}, n FROM e UNION ALL SELECT symbol, 'const', {r('my - b1 * ma - b2 * mb', 4)}, {r('(b1 * say + b2 * sby) / vy', 5)}, n FROM e",
    ),
)
def least_squares(spark, sf):
    out = ops.ols(factor_returns(spark, sf), ["symbol"], "ret", ["bench", "flow"])
    return near(near(out, "coef", digits=4), "r2", digits=5).select("symbol", "term", "coef", "r2", "n")


@query(
    "snapshot_metrics",
    "A30",
    with_(
        HOURLY_SQL, RETURNS, BENCH,
        """s AS (SELECT symbol, r.ts, close, ret, bench, close / max(close) OVER (PARTITION BY symbol ORDER BY r.ts ROWS UNBOUNDED PRECEDING) - 1 AS dd, rank() OVER (PARTITION BY symbol ORDER BY ret NULLS LAST) AS k FROM rets r LEFT JOIN bench b ON r.ts = b.ts),
t AS (SELECT symbol, greatest(floor(count(ret) * 0.05), 1) AS tc FROM s GROUP BY symbol), k AS (SELECT symbol, ret, row_number() OVER (PARTITION BY symbol ORDER BY ret) AS k FROM s WHERE ret IS NOT NULL),
v AS (SELECT k.symbol, max(ret) AS cut, avg(ret) AS tail FROM k JOIN t ON k.symbol = t.symbol WHERE k <= tc GROUP BY k.symbol)""",
        f"""SELECT s.symbol, count(ret) AS n, {r('min(dd)')} AS max_drawdown, {r('covar_samp(ret, bench) / var_samp(bench) FILTER (ret IS NOT NULL)', 5)} AS beta, arg_max(close, ts) AS last_value, {r('stddev_samp(ret) * sqrt(252)', 4)} AS volatility,
  {r('avg(ret) / stddev_samp(ret) * sqrt(252)')} AS sharpe, {r('arg_max(close, ts) * greatest(-any_value(cut), 0)')} AS var_95, {r('arg_max(close, ts) * greatest(-any_value(tail), 0)')} AS cvar_95 FROM s JOIN v ON s.symbol = v.symbol GROUP BY s.symbol""",
    ),
)
def snapshot_metrics(spark, sf):
    rows = win.drawdowns(returns(spark, sf), HOURLY, "close").join(benchmark(spark, sf), "ts", "left")
    out = ops.snapshot_metrics(rows, ["symbol"], "close", "ret", "drawdown", "bench")
    return near(near(near(out, "max_drawdown", "sharpe", "var_95", "cvar_95"), "beta", digits=5), "volatility", digits=4)


@query(
    "portfolio_risk_score",
    "A30",
    f"""SELECT s_suppkey AS symbol, {r('least((s_suppkey % 60) / 40.0, 1) * 30 + least((s_suppkey % 90) / 80.0, 1) * 25 + least((s_suppkey % 70) / 50.0, 1) * 25 + least(abs(s_acctbal / 5000) / 2, 1) * 20')} AS score FROM supplier""",
)
def portfolio_risk_score(spark, sf):
    k = F.col("s_suppkey")
    score = ops.risk_score((k % 90).cast("double"), (k % 60).cast("double"), -(k % 70).cast("double"), F.col("s_acctbal") / 5000)
    return near(fx.table(spark, sf, "supplier").select(k.alias("symbol"), score.alias("score")), "score")


@query(
    "return_histogram",
    "A31",
    with_(DAILY_SQL, RETURNS, "SELECT CAST(least(floor((ret + 1) / 0.05), 59) AS INTEGER) AS bin, count(*) AS n, -1 + least(floor((ret + 1) / 0.05), 59) * 0.05 AS start FROM rets WHERE ret BETWEEN -1 AND 2 GROUP BY ALL"),
)
def return_histogram(spark, sf):
    return ops.histogram(returns(spark, sf, daily=True), "ret", -1.0, 2.0, 60)


@query(
    "combine_factors",
    "A32",
    with_(DAILY_SQL, PANEL_SQL, f"SELECT symbol, ts, {r('(factor + vol + fwd) / 3')} AS equal, {r('0.5 * factor + 0.2 * vol + fwd / 3')} AS weighted FROM pf"),
)
def combine_factors(spark, sf):
    rows = factor_panel(spark, sf).filter("factor IS NOT NULL AND fwd IS NOT NULL")
    cols = {c: c for c in ("factor", "vol", "fwd")}
    out = rows.select("symbol", "ts", factors.combine(cols).alias("equal"), factors.combine(cols, {"factor": 0.5, "vol": 0.2}).alias("weighted"))
    return near(out, "equal", "weighted")


REB_SQL = CONST_SQL + """, cur AS (SELECT "index", symbol, market_cap / sum(market_cap) OVER (PARTITION BY "index") AS weight FROM cons WHERE price < 1080),
tgt AS (SELECT "index", symbol, price / sum(price) OVER (PARTITION BY "index") AS target_weight FROM cons WHERE price > 910),
rb AS (SELECT coalesce(c."index", t."index") AS "index", coalesce(c.symbol, t.symbol) AS symbol, weight, target_weight, target_weight - weight AS adjustment,
  CASE WHEN weight IS NULL THEN 'addition' WHEN target_weight IS NULL THEN 'deletion' ELSE 'kept' END AS change FROM cur c FULL JOIN tgt t ON c."index" = t."index" AND c.symbol = t.symbol)"""


def _weights(spark, sf):
    c = constituents(spark, sf)
    cur = ops.index_weights(c.filter("price < 1080"), ["index"]).select("index", "symbol", F.col("w_cap").alias("weight"))
    tgt = ops.index_weights(c.filter("price > 910"), ["index"]).select("index", "symbol", F.col("w_price").alias("target_weight"))
    return ops.rebalance_needs(cur, tgt, ["index"], 0.005)


@query("rebalance_needs", "A33", with_(REB_SQL, f"""SELECT "index", symbol, {rs('weight', 'target_weight', 'adjustment')}, change, coalesce(abs(adjustment) > 0.005, false) AS beyond_tolerance FROM rb"""))
def rebalance_needs(spark, sf):
    return near(_weights(spark, sf), "weight", "target_weight", "adjustment")


@query("needs_rebalancing", "A33", with_(REB_SQL, f"""SELECT "index", {r('max(abs(adjustment))')} AS max_drift, bool_or(coalesce(abs(adjustment) > 0.005, false)) AS needs_rebalancing, count(*) FILTER (change = 'addition') AS additions, count(*) FILTER (change = 'deletion') AS deletions FROM rb GROUP BY "index" """))
def needs_rebalancing(spark, sf):
    return near(ops.needs_rebalancing(_weights(spark, sf), ["index"]), "max_drift")
