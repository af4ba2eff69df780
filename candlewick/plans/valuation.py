"""Fundamentals and valuation queries: suppliers as companies, line items as bonds, options and curve quotes."""

from pyspark.sql import functions as F

from candlewick import fixtures as fx
from candlewick.functions import accounts as acc
from candlewick.functions.stats import normal_cdf_sql
from candlewick.operators import aggregates
from candlewick.operators import valuation as ops
from candlewick.operators.series import DAILY
from candlewick.plans.joins import fx_quotes
from candlewick.plans.quality import COMPANIES_SQL, companies
from candlewick.plans.registry import near, query, r, rs
from candlewick.plans.risk import _gauss_sql
from candlewick.plans.sql import DAILY as DAILY_SQL
from candlewick.plans.sql import with_


def statements(spark, sf):
    """Yearly statements per supplier from its shipments."""
    l, s = fx.table(spark, sf, "lineitem"), fx.table(spark, sf, "supplier")
    ep = F.col("l_extendedprice")
    y = l.groupBy(F.col("l_suppkey").alias("company"), F.year("l_shipdate").alias("period")).agg(
        F.sum(ep).alias("revenue"), F.sum(ep * (F.col("l_discount") * 4 + 0.3)).alias("cogs"), F.sum(ep * F.col("l_tax") * 2).alias("opex"), F.sum("l_quantity").alias("units"), F.count("*").cast("double").alias("deals"),
    )
    y = y.join(s.select("s_suppkey", "s_acctbal"), F.col("company") == F.col("s_suppkey"))
    c = lambda e, n: F.expr(e).alias(n)
    y = y.select("company", "period", "revenue", "cogs", "units", "deals", "s_acctbal", c("revenue - cogs", "gross_profit"), c("revenue - cogs - opex", "operating_income"))
    return y.select(
        "*", c("operating_income + units * 10", "ebitda"), c("units * 100D", "interest_expense"), c("operating_income - units * 100D", "pretax_income"), c("(operating_income - units * 100D) * 0.79D", "net_income"),
        c("s_acctbal * 100 + revenue / 2", "total_equity"), c("units * 2000D", "total_debt"), c("s_acctbal * 100 + revenue / 2 + units * 2500D", "total_assets"),
        c("units * 50D", "cash"), c("units * 5D", "marketable_securities"), c("units * 300D", "inventory"), c("units * 700D", "current_assets"), c("deals * 9000D", "current_liabilities"),
        c("units * 250D", "receivables"), c("deals * 3000D", "payables"), c("units * 900D", "fixed_assets"), c("units * 700D - deals * 9000D", "working_capital"), c("revenue * 0.2D", "operating_cash_flow"), c("deals * 100D", "lease_payments"),
    ).withColumn("tax_rate", F.lit(0.21))


STATEMENTS = """y AS (SELECT l_suppkey AS company, year(l_shipdate)::INT AS period, sum(l_extendedprice) AS revenue, sum(l_extendedprice * (l_discount * 4 + 0.3)) AS cogs, sum(l_extendedprice * l_tax * 2) AS opex, sum(l_quantity) AS units, count(*)::DOUBLE AS deals, any_value(s_acctbal) AS s_acctbal
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2),
y2 AS (SELECT *, revenue - cogs AS gross_profit, revenue - cogs - opex AS operating_income, revenue - cogs - opex + units * 10 AS ebitda, units * 100 AS interest_expense, revenue - cogs - opex - units * 100 AS pretax_income, (revenue - cogs - opex - units * 100) * 0.79 AS net_income,
  s_acctbal * 100 + revenue / 2 AS total_equity, units * 2000 AS total_debt, s_acctbal * 100 + revenue / 2 + units * 2500 AS total_assets, units * 50 AS cash, units * 5 AS marketable_securities, units * 300 AS inventory, units * 700 AS current_assets, deals * 9000 AS current_liabilities,
  units * 250 AS receivables, deals * 3000 AS payables, units * 900 AS fixed_assets, units * 700 - deals * 9000 AS working_capital, revenue * 0.2 AS operating_cash_flow, deals * 100 AS lease_payments FROM y),
st AS (SELECT *, """ + ", ".join(f"({c} + coalesce(lag({c}) OVER w, {c})) / 2 AS average_{c}" for c in ("total_equity", "total_assets", "inventory", "receivables", "payables", "fixed_assets", "working_capital")) + " FROM y2 WINDOW w AS (PARTITION BY company ORDER BY period))"
AVERAGED = ("total_equity", "total_assets", "inventory", "receivables", "payables", "fixed_assets", "working_capital")


def averaged(spark, sf):
    return ops.with_averages(statements(spark, sf), "company", "period", AVERAGED)


def _d(a, b):
    return f"CASE WHEN {b} > 0 THEN ({a}) / ({b}) END"


RATIOS = {
    "gross_margin": _d("gross_profit", "revenue"), "operating_margin": _d("operating_income", "revenue"), "net_margin": _d("net_income", "revenue"), "ebitda_margin": _d("ebitda", "revenue"),
    "roe": _d("net_income", "average_total_equity"), "roa": _d("net_income", "average_total_assets"), "roic": _d("operating_income * 0.79", "(total_debt + total_equity - cash)"),
    "current_ratio": _d("current_assets", "current_liabilities"), "quick_ratio": _d("current_assets - inventory", "current_liabilities"), "cash_ratio": _d("cash + marketable_securities", "current_liabilities"),
    "operating_cash_flow_ratio": _d("operating_cash_flow", "current_liabilities"), "debt_to_equity": _d("total_debt", "total_equity"), "debt_to_assets": _d("total_debt", "total_assets"),
    "debt_to_capital": _d("total_debt", "(total_debt + total_equity)"), "interest_coverage": _d("operating_income", "interest_expense"),
    "fixed_charge_coverage": _d("operating_income + lease_payments", "(interest_expense + lease_payments)"), "financial_leverage": _d("total_assets", "total_equity"),
    "asset_turnover": _d("revenue", "average_total_assets"), "fixed_asset_turnover": _d("revenue", "average_fixed_assets"), "inventory_turnover": _d("cogs", "average_inventory"),
    "receivables_turnover": _d("revenue", "average_receivables"), "payables_turnover": _d("cogs", "average_payables"), "working_capital_turnover": _d("revenue", "average_working_capital"),
    "days_in_inventory": "365 * average_inventory / cogs", "days_sales_outstanding": "365 * average_receivables / revenue", "days_payable_outstanding": "365 * average_payables / cogs",
    "cash_conversion_cycle": "365 * average_inventory / cogs + 365 * average_receivables / revenue - 365 * average_payables / cogs",
}


@query("financial_ratios", "D1", with_(STATEMENTS, "SELECT company, period, " + ", ".join(f"{r(x, 5)} AS {n}" for n, x in RATIOS.items()) + " FROM st"))
def financial_ratios(spark, sf):
    cols = {**ops.profitability(), **ops.liquidity(), **ops.solvency(), **ops.efficiency()}
    return near(averaged(spark, sf).select("company", "period", *[c.alias(n) for n, c in cols.items()]), *cols, digits=5)


_z = lambda a, b: f"coalesce({_d(a, b)}, 0)"
_DU = f"""du AS (SELECT company, period, {_z('net_income', 'revenue')} AS net_margin, {_z('revenue', 'average_total_assets')} AS asset_turnover, {_z('average_total_assets', 'average_total_equity')} AS leverage,
  {_z('net_income', 'pretax_income')} AS tax_burden, {_z('pretax_income', 'operating_income')} AS interest_burden, {_z('operating_income', 'revenue')} AS ebit_margin FROM st),
d2 AS (SELECT *, net_margin * asset_turnover * leverage AS roe_3, tax_burden * interest_burden * ebit_margin * asset_turnover * leverage AS roe_5 FROM du),
d3 AS (SELECT *, roe_3 - lag(roe_3) OVER w AS roe_3_change, CASE WHEN lag(roe_3) OVER w <> 0 THEN (roe_3 - lag(roe_3) OVER w) / lag(roe_3) OVER w * 100 END AS roe_3_pct, leverage - lag(leverage) OVER w AS leverage_change FROM d2 WINDOW w AS (PARTITION BY company ORDER BY period))"""
DU = ("net_margin", "asset_turnover", "leverage", "roe_3", "tax_burden", "interest_burden", "ebit_margin", "roe_5", "roe_3_change", "leverage_change")


@query("dupont", "D2", with_(STATEMENTS, _DU, f"SELECT company, period, {rs(*DU)}, {r('roe_3_pct', 3)} AS roe_3_pct FROM d3"))
def dupont(spark, sf):
    d = averaged(spark, sf)
    d = ops.drivers(d.select("company", "period", *[c.alias(n) for n, c in ops.dupont().items()]), "company", "period", ["roe_3", "leverage"])
    return near(near(d.select("company", "period", *DU, "roe_3_pct"), *DU), "roe_3_pct", digits=3)


_NAMES = {"revenue": ("Net Sales", "Total-Revenue", "revenue"), "cogs": ("Cost of Goods Sold", "COGS", "cost_of_revenue"), "operating_income": ("EBIT", "Operating Profit", "operating income"), "net_income": ("Net Profit", "profit-after-tax", "Net Income"), "units": ("Units Shipped", "Units Shipped", "Units Shipped")}
_STD = {"revenue": "revenue", "cogs": "cost_of_sales", "operating_income": "operating_income", "net_income": "net_income", "units": "units_shipped"}


@query(
    "standard_accounts",
    "D3",
    with_(
        STATEMENTS,
        "SELECT * FROM (" + " UNION ALL ".join(f"SELECT company, period, '{_STD[c]}' AS account, {r(c, 2)} AS amount FROM st" for c in _NAMES)
        + f" UNION ALL SELECT company, period, 'net_income_cf', {r('net_income', 2)} FROM st WHERE company % 3 > 0)",
    ),
)
def standard_accounts(spark, sf):
    y = statements(spark, sf)
    name = lambda c: F.element_at(F.array(*[F.lit(x) for x in _NAMES[c]]), (F.col("company") % 3 + 1).cast("int"))
    raw = y.select("company", "period", F.inline(F.array(*[F.struct(name(c).alias("name"), F.col(c).alias("amount")) for c in _NAMES])))
    return near(ops.standardise_accounts(raw, ["company", "period"], "name", "amount"), "amount", digits=2)


@query(
    "statement_checks",
    "D3",
    """WITH s AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS a, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE floor(o_totalprice * 0.6) END AS l,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_totalprice - floor(o_totalprice * 0.6) + CASE WHEN o_orderkey % 13 = 0 THEN 1 ELSE 0 END END AS e, o_custkey % 3 AS cf, o_custkey % 4 AS ep FROM orders)
SELECT id, CASE WHEN abs(a - (l + e)) > 0.01 THEN 'balance' ELSE '' END AS errors,
  array_to_string(list_filter([CASE WHEN a IS NULL AND l IS NOT NULL AND e IS NOT NULL THEN 'derived_assets' END, CASE WHEN l IS NULL AND a IS NOT NULL AND e IS NOT NULL THEN 'derived_liabilities' END, CASE WHEN a IS NULL AND l IS NULL AND e IS NOT NULL THEN 'estimated_assets' END,
    CASE WHEN cf = 0 THEN 'cash_change' END, CASE WHEN ep = 0 THEN 'eps' END], lambda x: x IS NOT NULL), '|') AS warnings,
  floor(coalesce(a, CASE WHEN e IS NOT NULL THEN coalesce(l, 0) + e END) + 0.004)::BIGINT AS total_assets FROM s""",
)
def statement_checks(spark, sf):
    p, k = F.col("o_totalprice"), F.col("o_orderkey")
    s = fx.table(spark, sf, "orders").select(
        k.alias("id"), F.when(k % 7 != 0, p).alias("total_assets"), F.when(k % 5 != 0, F.floor(p * 0.6)).alias("total_liabilities"),
        F.when(k % 11 != 0, p - F.floor(p * 0.6) + F.when(k % 13 == 0, 1).otherwise(0)).alias("total_equity"),
        F.lit(100.0).alias("cash_beginning"), F.lit(150.0).alias("cash_ending"), F.when(F.col("o_custkey") % 3 == 0, 60.0).otherwise(50.0).alias("net_cash_change"),
        F.lit(2.0).alias("basic_eps"), F.lit(10.0).alias("basic_shares"), F.when(F.col("o_custkey") % 4 == 0, 25.0).otherwise(20.0).alias("net_income"),
    )
    v = ops.validate_statements(s)
    return v.select("id", F.array_join("errors", "|").alias("errors"), F.array_join("warnings", "|").alias("warnings"), F.floor(F.col("total_assets") + 0.004).alias("total_assets"))


@query(
    "converted_statements",
    "D3",
    f"""WITH f AS (SELECT o_orderkey AS id, o_totalprice AS v, c_nationkey AS cur FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT id, 'N3' AS currency, {r("v * CASE WHEN cur = 3 THEN 1 WHEN cur >= 20 THEN NULL ELSE cur * 0.25 + 0.5 END", 3)} AS amount FROM f""",
)
def converted_statements(spark, sf):
    o, c, n = (fx.table(spark, sf, t) for t in ("orders", "customer", "nation"))
    f = o.join(c, o["o_custkey"] == c["c_custkey"]).select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("amount"), F.concat(F.lit("N"), "c_nationkey").alias("currency"))
    rates = n.filter("n_nationkey < 20").select(F.concat(F.lit("N"), "n_nationkey").alias("currency"), F.lit("N3").alias("target"), (F.col("n_nationkey") * 0.25 + 0.5).alias("rate"))
    return near(ops.convert_currency(f, "currency", rates, ["amount"], "N3"), "amount", digits=3)


@query(
    "metric_trend",
    "D4",
    with_(
        STATEMENTS,
        """t AS (SELECT company, revenue, row_number() OVER (PARTITION BY company ORDER BY period) - 1 AS i FROM st),
g AS (SELECT company, count(*) AS n, arg_min(revenue, i) AS a, arg_max(revenue, i) AS b, avg(revenue) AS m, stddev_pop(revenue) AS s, regr_slope(revenue, i) AS k FROM t GROUP BY company)""",
        f"""SELECT company, n, {r('CASE WHEN n >= 2 THEN power(b / a, 1.0 / (n - 1)) - 1 END')} AS growth_rate, {r('s / m')} AS volatility,
  CASE WHEN n < 2 THEN 'Insufficient data for trend analysis' WHEN n >= 3 THEN CASE WHEN k > 0.05 * m THEN 'Strong upward trend' WHEN k > 0.02 * m THEN 'Moderate upward trend' WHEN k < -0.05 * m THEN 'Strong downward trend' WHEN k < -0.02 * m THEN 'Moderate downward trend' ELSE 'Stable trend' END
  WHEN b > a THEN 'Improving' WHEN b < a THEN 'Declining' ELSE 'Stable' END AS trend FROM g""",
    ),
)
def metric_trend(spark, sf):
    return near(ops.trend(statements(spark, sf), "company", "period", "revenue"), "growth_rate", "volatility")


@query(
    "industry_comparison",
    "D4",
    with_(
        COMPANIES_SQL,
        "q AS (SELECT sector, quantile_cont(volume, 0.25) AS q1, quantile_cont(volume, 0.5) AS m, quantile_cont(volume, 0.75) AS q3 FROM companies GROUP BY sector)",
        """SELECT symbol, CASE WHEN volume >= q3 THEN 'above 75th' WHEN volume >= m THEN 'above median' WHEN volume >= q1 THEN 'above 25th' ELSE 'below 25th' END AS band,
  CASE WHEN volume >= 16000 THEN 'LOW' WHEN volume >= 15000 THEN 'MODERATE' ELSE 'HIGH' END AS risk FROM companies JOIN q USING (sector)""",
    ),
)
def industry_comparison(spark, sf):
    c = ops.compare_to_industry(companies(spark, sf), ["sector"], "volume")
    return c.select("symbol", "band", ops.risk_band(F.col("volume"), 17_000, 16_000, 15_000).alias("risk"))


PRICES = ("pe", "pb", "ps", "dividend_yield", "earnings_yield", "peg", "leading_pe", "trailing_pe", "justified_pb", "justified_ps", "ev_sales", "ev_ebitda", "ev_ebit", "ev_fcf", "implied_value")


@query(
    "valuation_multiples",
    "D5",
    with_(
        STATEMENTS,
        f"""v AS (SELECT *, 20 + company % 7 AS price, net_income / units AS eps, total_equity / units AS bv, revenue / units AS sps, 0.4 * net_income / units AS dps, (company % 12) / 100 AS growth, units * (20 + company % 7) + total_debt - cash AS ev FROM st),
m AS (SELECT company, period, {_d('price', 'eps')} AS pe, {_d('price', 'bv')} AS pb, {_d('price', 'sps')} AS ps, dps / price AS dividend_yield, eps / price AS earnings_yield, CASE WHEN growth > 0 AND eps > 0 THEN price / eps / (growth * 100) END AS peg,
  CASE WHEN growth < 0.1 THEN 0.4 / (0.1 - growth) END AS leading_pe, CASE WHEN growth < 0.1 THEN 0.4 / (0.1 - growth) / (1 + growth) END AS trailing_pe, CASE WHEN growth < 0.1 THEN (0.12 - growth) / (0.1 - growth) END AS justified_pb, CASE WHEN growth < 0.1 THEN 0.4 / (0.1 - growth) * 0.3 END AS justified_ps,
  {_d('ev', 'revenue')} AS ev_sales, {_d('ev', 'ebitda')} AS ev_ebitda, {_d('ev', 'operating_income')} AS ev_ebit, {_d('ev', 'operating_cash_flow')} AS ev_fcf, (8 * ebitda - total_debt + cash) / units AS implied_value FROM v)""",
        f"SELECT company, period, {rs(*PRICES, digits=5)} FROM m",
    ),
)
def valuation_multiples(spark, sf):
    s = statements(spark, sf)
    c = lambda e: F.expr(e)
    s = s.withColumns({
        "price": F.lit(20) + F.col("company") % 7, "eps": c("net_income / units"), "book_value_per_share": c("total_equity / units"), "sales_per_share": c("revenue / units"),
        "dividend_per_share": c("0.4D * net_income / units"), "growth": F.col("company") % 12 / 100, "ebit": F.col("operating_income"), "free_cash_flow": F.col("operating_cash_flow"),
        "enterprise_value": ops.enterprise_value(F.col("units") * (F.lit(20) + F.col("company") % 7), F.col("total_debt"), F.col("cash")),
    })
    j = ops.justified_multiples(F.lit(0.4), F.lit(0.1), F.col("growth"), F.lit(0.12), F.lit(0.3))
    cols = {
        **ops.price_multiples(F.col("growth")), "leading_pe": j["leading_pe"], "trailing_pe": j["trailing_pe"], "justified_pb": j["pb"], "justified_ps": j["ps"], **ops.ev_multiples(),
        "implied_value": ops.implied_share_value(F.lit(8.0), F.col("ebitda"), F.col("total_debt"), F.col("cash"), F.col("units")),
    }
    return near(s.select("company", "period", *[cols[n].alias(n) for n in PRICES]), *PRICES, digits=5)


def comps(spark, sf):
    return companies(spark, sf).withColumns({"ev_revenue": F.col("market_cap") / F.col("book_value") / (F.col("volume") / 1000), "pe": F.when(F.col("net_income") > 0, F.col("market_cap") / F.col("net_income"))})


@query(
    "comps_valuation",
    "D6",
    with_(
        COMPANIES_SQL,
        """c AS (SELECT *, market_cap / book_value / (volume / 1000) AS ev_revenue, CASE WHEN net_income > 0 THEN market_cap / net_income END AS pe FROM companies),
long AS (SELECT sector, 'ev_revenue' AS multiple, ev_revenue AS v FROM c UNION ALL SELECT sector, 'pe', pe FROM c WHERE pe IS NOT NULL),
s AS (SELECT sector, multiple, median(v) AS m, avg(v) AS a, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3 FROM long WHERE v > 0 GROUP BY ALL),
t AS (SELECT symbol, sector, 'ev_revenue' AS multiple, volume AS metric FROM c UNION ALL SELECT symbol, sector, 'pe', net_income FROM c WHERE net_income <> 0)""",
        f"SELECT symbol, sector, multiple, {r('metric * m', 2)} AS value_median, {r('metric * a', 2)} AS value_mean, {r('metric * q1', 2)} AS value_q1, {r('metric * q3', 2)} AS value_q3 FROM t JOIN s USING (sector, multiple)",
    ),
)
def comps_valuation(spark, sf):
    c = comps(spark, sf)
    stats_ = aggregates.multiple_statistics(c, ["sector"], ["ev_revenue", "pe"], "market_cap")
    out = ops.comps_valuation(c.select("symbol", "sector", "volume", "net_income"), stats_, ["sector"], {"ev_revenue": "volume", "pe": "net_income"})
    names = ["value_median", "value_mean", "value_q1", "value_q3"]
    return near(out.select("symbol", "sector", "multiple", *names), *names, digits=2)


@query(
    "comps_regression",
    "D6",
    with_(COMPANIES_SQL, f"""SELECT sector, {r('regr_slope(market_cap, volume)', 4)} AS slope, {r('regr_intercept(market_cap, volume)', 1)} AS intercept, {r('regr_r2(market_cap, volume)')} AS r_squared, count(*) AS data_points FROM companies WHERE market_cap > 0 AND volume > 0 GROUP BY sector HAVING count(*) >= 3"""),
)
def comps_regression(spark, sf):
    out = ops.regression(companies(spark, sf), ["sector"], "volume", "market_cap")
    return near(near(near(out, "slope", digits=4), "intercept", digits=1), "r_squared")


def offers(spark, sf):
    s, k = fx.table(spark, sf, "supplier"), F.col("s_suppkey")
    return s.select(k.cast("string").alias("symbol"), (F.to_timestamp(F.lit("1997-07-01")) + F.make_dt_interval((k % 500).cast("int"))).alias("ts"), (F.lit(1000.0) + k % 700).alias("offer_price"))


OFFERS = "offers AS (SELECT s_suppkey::VARCHAR AS symbol, TIMESTAMP '1997-07-01' + to_days((s_suppkey % 500)::INT) AS ts, 1000.0::DOUBLE + s_suppkey % 700 AS offer_price FROM supplier)"
HIST = """h AS (SELECT symbol, ts, close AS avg_1, avg(close) OVER (w ROWS 4 PRECEDING) AS a5, avg(close) OVER (w ROWS 19 PRECEDING) AS a20, avg(close) OVER (w ROWS 59 PRECEDING) AS a60, row_number() OVER w AS n,
  sum(close * volume) OVER (w ROWS 29 PRECEDING) / sum(volume) OVER (w ROWS 29 PRECEDING) AS vwap_30, max(high) OVER (w ROWS 251 PRECEDING) AS high_52w, min(low) OVER (w ROWS 251 PRECEDING) AS low_52w FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY ts)),
h2 AS (SELECT symbol, ts, avg_1, CASE WHEN n >= 5 THEN a5 ELSE avg_1 END AS avg_5, CASE WHEN n >= 20 THEN a20 WHEN n >= 5 THEN a5 ELSE avg_1 END AS avg_20, CASE WHEN n >= 60 THEN a60 WHEN n >= 20 THEN a20 WHEN n >= 5 THEN a5 ELSE avg_1 END AS avg_60, vwap_30, high_52w, low_52w FROM h),
j AS (SELECT o.symbol, o.ts, o.offer_price, h2.* EXCLUDE (symbol, ts) FROM offers o ASOF LEFT JOIN h2 ON o.symbol = h2.symbol AND o.ts > h2.ts)"""
PREM = ("avg_1", "avg_5", "avg_20", "avg_60", "vwap_30", "high_52w", "low_52w")


@query(
    "offer_premiums",
    "D7",
    with_(DAILY_SQL, OFFERS, HIST, f"""SELECT symbol, {', '.join(r(f'(offer_price - {c}) / {c} * 100', 5) + f' AS premium_{c}' for c in PREM)}, {r('(offer_price - low_52w) / (high_52w - low_52w) * 100', 5)} AS range_position, offer_price > high_52w AS above_high FROM j"""),
)
def offer_premiums(spark, sf):
    out = ops.offer_premiums(offers(spark, sf), fx.daily(spark, sf), DAILY)
    names = [f"premium_{c}" for c in PREM] + ["range_position"]
    return near(out.select("symbol", *names, "above_high"), *names, digits=5)


def _look(d):
    return f"(SELECT arg_max(close, b.ts) FROM bars b WHERE b.symbol = o.symbol AND b.ts <= o.ts - to_days({d}))"


@query(
    "historical_premiums",
    "D7",
    with_(DAILY_SQL, OFFERS, f"k AS (SELECT symbol, offer_price, {_look(1)} AS d1, {_look(7)} AS d7, {_look(28)} AS d28 FROM offers o)",
          f"""SELECT symbol, {r('(offer_price - d1) / d1 * 100', 5)} AS day_1, {r('(offer_price - d7) / d7 * 100', 5)} AS week_1, {r('(offer_price - d28) / d28 * 100', 5)} AS week_4,
  CASE WHEN (offer_price - d1) / d1 * 100 < 20 THEN 'below 25th' WHEN (offer_price - d1) / d1 * 100 < 35 THEN '25th to 50th' WHEN (offer_price - d1) / d1 * 100 < 50 THEN '50th to 75th' WHEN d1 IS NOT NULL THEN 'above 75th' END AS position FROM k"""),
)
def historical_premiums(spark, sf):
    out = ops.historical_premiums(offers(spark, sf), fx.daily(spark, sf), DAILY, {"day_1": 1, "week_1": 7, "week_4": 28})
    out = out.withColumn("position", ops.benchmark_position(F.col("day_1"), F.lit("technology")))
    return near(out.select("symbol", "day_1", "week_1", "week_4", "position"), "day_1", "week_1", "week_4", digits=5)


GROWTH = (0.08, 0.07, 0.06, 0.05, 0.04)
_PV = " + ".join(f"base * {'*'.join(f'(1 + {g})' for g in GROWTH[: i + 1])} / power(1 + w, {i + 1} - 0.5)" for i in range(5))
_LAST = f"base * {'*'.join(f'(1 + {g})' for g in GROWTH)}"


@query(
    "dcf_valuation",
    "D8",
    with_(COMPANIES_SQL, f"""b AS (SELECT symbol, market_cap / 20 AS base, 0.07::DOUBLE + (symbol % 5) / 100 AS w, 0.02::DOUBLE AS g FROM companies),
v AS (SELECT symbol, {_PV} AS pv_of_fcf, {_LAST} * (1 + g) / (w - g) AS terminal_value, w FROM b), x AS (SELECT *, terminal_value / power(1 + w, 4.5) AS pv_of_terminal_value FROM v)""",
          f"SELECT symbol, {rs('pv_of_fcf', 'terminal_value', 'pv_of_terminal_value', digits=2)}, {r('pv_of_fcf + pv_of_terminal_value', 2)} AS enterprise_value, {r('pv_of_terminal_value / (pv_of_fcf + pv_of_terminal_value) * 100')} AS terminal_share FROM x"),
)
def dcf_valuation(spark, sf):
    c = companies(spark, sf).withColumn("flows", ops.project(F.col("market_cap") / 20, F.array(*[F.lit(g) for g in GROWTH])))
    cols = ops.dcf("flows", F.lit(0.07) + F.col("symbol") % 5 / 100, F.lit(0.02), mid_year=True)
    out = c.select("symbol", *[v.alias(n) for n, v in cols.items()])
    return near(near(out, "pv_of_fcf", "terminal_value", "pv_of_terminal_value", "enterprise_value", digits=2), "terminal_share")


def _z_sql(i):
    return _gauss_sql("'5'", "CAST(symbol AS VARCHAR)", "CAST(run AS VARCHAR)", f"'{i}'")


@query(
    "simulated_valuation",
    "D8",
    with_(
        COMPANIES_SQL,
        f"""d AS (SELECT symbol, market_cap / 20 AS base, {', '.join(f'0.06 + 0.02 * {_z_sql(i)} AS g{i}' for i in range(3))}, least(greatest(0.02 + 0.005 * {_z_sql(3)}, 0), 0.06) AS t, least(greatest(0.1 + 0.01 * {_z_sql(4)}, 0.05), 0.2) AS w
  FROM companies, (SELECT unnest(range(100)) AS run)),
f AS (SELECT symbol, t, w, base * (1 + g0) AS f1, base * (1 + g0) * (1 + g1) AS f2, base * (1 + g0) * (1 + g1) * (1 + g2) AS f3 FROM d),
v AS (SELECT symbol, f1 / (1 + w) + f2 / power(1 + w, 2) + f3 / power(1 + w, 3) + CASE WHEN w > t THEN f3 * (1 + t) / (w - t) END / power(1 + w, 3) AS v FROM f)""",
        f"SELECT symbol, {r('avg(v)', 1)} AS mean, {r('stddev_pop(v)', 1)} AS std, {r('quantile_cont(v, 0.05)', 1)} AS p5, {r('median(v)', 1)} AS p50, {r('quantile_cont(v, 0.95)', 1)} AS p95 FROM v GROUP BY symbol",
    ),
)
def simulated_valuation(spark, sf):
    c = companies(spark, sf).withColumn("base", F.col("market_cap") / 20)
    out = ops.simulated_dcf(c, "symbol", "base", 3, 100, (0.06, 0.02), (0.02, 0.005), (0.1, 0.01), seed=5)
    names = ["mean", "std", "p5", "p50", "p95"]
    return near(out.select("symbol", *names), *names, digits=1)


BONDS = """bonds AS (SELECT l_orderkey AS "order", l_linenumber AS line, l_suppkey AS book, 1000.0::DOUBLE AS face, l_discount + 0.01 AS coupon, l_linenumber + l_quantity::INT % 20 + 0.5::DOUBLE AS years, l_tax + 0.005 AS y, l_extendedprice AS mv FROM lineitem)"""


def bonds(spark, sf):
    return fx.spread_table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order"), F.col("l_linenumber").alias("line"), F.col("l_suppkey").alias("book"), F.lit(1000.0).alias("face"), (F.col("l_discount") + 0.01).alias("coupon"),
        (F.col("l_linenumber") + F.col("l_quantity").cast("int") % 20 + 0.5).alias("years"), (F.col("l_tax") + 0.005).alias("y"), F.col("l_extendedprice").alias("mv"),
    )


TERMS = ("y", "face", "coupon", "years")


@query(
    "bond_yields",
    "D9",
    with_(BONDS, f"""SELECT "order", line, {r('coupon * face / 2 * (1 - power(1 + y / 2, -floor(years * 2))) / (y / 2) + face * power(1 + y / 2, -floor(years * 2))', 4)} AS price, {r('y')} AS ytm FROM bonds"""),
)
def bond_yields(spark, sf):
    y, face, coupon, years = (F.col(c) for c in TERMS)
    b = bonds(spark, sf).withColumn("price", ops.bond_price(y, face, coupon, years))
    b = b.withColumn("ytm", ops.bond_yield(F.col("price"), face, coupon, years))
    return near(near(b.select("order", "line", "price", "ytm"), "price", digits=4), "ytm")


_PVT = "CASE WHEN t < n THEN coupon * face / 2 ELSE coupon * face / 2 + face END / power(1 + y / 2, t)"
BOND_RISK = f"""bn AS (SELECT *, floor(years * 2)::INT AS n FROM bonds),
cf AS (SELECT *, list_transform(range(1, n + 1), lambda t: {_PVT}) AS pv FROM bn),
br AS (SELECT "order", line, book, mv, years, y, list_sum(pv) AS price, list_sum(list_transform(pv, lambda v, i: i / 2.0 * v)) / list_sum(pv) AS macaulay,
  list_sum(list_transform(pv, lambda v, i: i * (i + 1) * v)) / (list_sum(pv) * power(1 + y / 2, 2) * 4) AS convexity FROM cf),
bd AS (SELECT *, macaulay / (1 + y / 2) AS modified FROM br)"""


@query("bond_durations", "D9", with_(BONDS, BOND_RISK, f"""SELECT "order", line, {r('price', 4)} AS price, {rs('macaulay', 'modified', 'convexity', digits=5)} FROM bd"""))
def bond_durations(spark, sf):
    b = bonds(spark, sf).select("order", "line", *[c.alias(n) for n, c in ops.bond_duration(*[F.col(c) for c in TERMS]).items()])
    return near(near(b, "price", digits=4), "macaulay", "modified", "convexity", digits=5)


def bond_holdings(spark, sf):
    d = ops.bond_duration(*[F.col(c) for c in TERMS])
    return bonds(spark, sf).select("book", "order", "line", F.col("mv").alias("market_value"), d["modified"].alias("duration"), d["convexity"].alias("convexity"), F.col("y").alias("ytm"), F.col("years").alias("maturity"))


BP = ("portfolio_duration", "portfolio_convexity", "portfolio_ytm", "portfolio_maturity")


@query(
    "bond_portfolio",
    "D9",
    with_(BONDS, BOND_RISK, "p AS (SELECT book, sum(mv) AS t, count(*) AS num_holdings, sum(mv * modified) / sum(mv) AS portfolio_duration, sum(mv * convexity) / sum(mv) AS portfolio_convexity, sum(mv * y) / sum(mv) AS portfolio_ytm, sum(mv * years) / sum(mv) AS portfolio_maturity FROM bd GROUP BY book)",
          f"SELECT book, num_holdings, {r('t', 2)} AS total_market_value, {rs(*BP, digits=5)}, {r('portfolio_duration * t * 0.0001', 3)} AS dv01, {r('-portfolio_duration * 0.01 * t + 0.5 * portfolio_convexity * 0.0001 * t', 2)} AS up_100bp FROM p"),
)
def bond_portfolio(spark, sf):
    out = ops.bond_portfolio(bond_holdings(spark, sf), ["book"]).select("book", "num_holdings", "total_market_value", *BP, "dv01", "up_100bp")
    return near(near(near(out, "total_market_value", "up_100bp", digits=2), *BP, digits=5), "dv01", digits=3)


@query(
    "duration_contributions",
    "D9",
    with_(BONDS, BOND_RISK, f"""SELECT book, "order", line, {r('mv / sum(mv) OVER (PARTITION BY book)', 7)} AS weight, {r('modified * mv / sum(mv) OVER (PARTITION BY book)', 7)} AS contribution FROM bd"""),
)
def duration_contributions(spark, sf):
    return near(ops.duration_contributions(bond_holdings(spark, sf), ["book"]).select("book", "order", "line", "weight", "contribution"), "weight", "contribution", digits=7)


_KR = "CASE WHEN years <= 1.5 THEN 1 WHEN years <= 2.5 THEN 2 WHEN years <= 4 THEN 3 WHEN years <= 6 THEN 5 WHEN years <= 8.5 THEN 7 WHEN years <= 15 THEN 10 WHEN years <= 25 THEN 20 ELSE 30 END::DOUBLE"


@query(
    "key_rate_exposure",
    "D9",
    with_(BONDS, BOND_RISK, f"k AS (SELECT book, {_KR} AS key_rate, sum(mv) AS mv, sum(mv * modified) AS d FROM bd GROUP BY ALL)",
          f"SELECT book, key_rate, {r('mv', 2)} AS market_value, {r('mv / sum(mv) OVER (PARTITION BY book)')} AS weight, {r('d / sum(mv) OVER (PARTITION BY book)')} AS duration_contribution FROM k"),
)
def key_rate_exposure(spark, sf):
    out = ops.key_rate_exposure(bond_holdings(spark, sf), ["book"])
    return near(near(out, "market_value", digits=2), "weight", "duration_contribution")


def curve_points(spark, sf):
    l = fx.table(spark, sf, "lineitem").withColumn("curve", F.to_date(F.date_trunc("month", "l_shipdate")))
    return ops.curves(l.withColumn("rate", F.col("l_discount") / 2 + F.col("l_linenumber") * 0.002), ["curve"], "l_linenumber", "rate")


CURVE = """pts AS (SELECT date_trunc('month', l_shipdate)::DATE AS curve, l_linenumber::DOUBLE AS t, avg(l_discount / 2 + l_linenumber * 0.002) AS r FROM lineitem GROUP BY 1, 2),
seg AS (SELECT curve, t AS t0, r AS r0, lead(t) OVER w AS t1, lead(r) OVER w AS r1, row_number() OVER w AS k, count(*) OVER (PARTITION BY curve) AS n FROM pts WINDOW w AS (PARTITION BY curve ORDER BY t))"""
TARGETS = (0.5, 1.5, 4.0, 6.25, 10.0)


@query(
    "curve_interpolation",
    "D10",
    with_(CURVE, f"tg AS (SELECT unnest([{', '.join(map(str, TARGETS))}])::DOUBLE AS tenor)",
          f"SELECT curve, tenor, {r('r0 + (r1 - r0) * (tenor - t0) / (t1 - t0)', 7)} AS rate FROM seg, tg WHERE t1 IS NOT NULL AND (tenor >= t0 OR k = 1) AND (tenor < t1 OR k = n - 1)"),
)
def curve_interpolation(spark, sf):
    c = curve_points(spark, sf).withColumn("tenor", F.explode(F.array(*[F.lit(t) for t in TARGETS])))
    out = c.select("curve", "tenor", ops.interpolated(F.col("points"), F.col("tenor")).alias("rate")).filter(F.col("rate").isNotNull())
    return near(out, "rate", digits=7)


@query(
    "forward_rates",
    "D10",
    with_(CURVE, f'SELECT curve, t0 AS "start", t1 AS "end", {r("power(power(1 + r1, t1) / power(1 + r0, t0), 1 / (t1 - t0)) - 1", 7)} AS forward_rate FROM seg WHERE t1 IS NOT NULL'),
)
def forward_rates(spark, sf):
    return near(ops.forward_rates(curve_points(spark, sf)).select("curve", "start", "end", "forward_rate"), "forward_rate", digits=7)


@query(
    "curve_shape",
    "D10",
    with_(CURVE, """s AS (SELECT curve, max(r0) FILTER (k = 1) AS s, max(r0) FILTER (k = n // 2 + 1) AS m, max(r0) FILTER (k = n) AS l, max(t0) - min(t0) AS span FROM seg GROUP BY curve)""",
          f"""SELECT curve, CASE WHEN m > s AND m > l THEN 'Humped' WHEN m < s AND m < l THEN 'U-Shaped' WHEN l - s > 0.005 THEN 'Normal' WHEN l - s < -0.005 THEN 'Inverted' ELSE 'Flat' END AS shape, {r('l - s', 7)} AS slope, {r('CASE WHEN span <> 0 THEN (l - s) / span ELSE 0 END', 7)} AS steepness FROM s"""),
)
def curve_shape(spark, sf):
    return near(ops.curve_shape(curve_points(spark, sf)).select("curve", "shape", "slope", "steepness"), "slope", "steepness", digits=7)


OPTIONS = """opt AS (SELECT l_orderkey AS "order", l_linenumber AS line, l_suppkey AS sup, p_retailprice AS s, p_retailprice * (0.85::DOUBLE + 0.05 * l_linenumber) AS k, l_quantity / 25 AS t, 0.03::DOUBLE AS rf, 0.15::DOUBLE + l_discount * 3 AS v,
  CASE WHEN l_linenumber % 2 = 0 THEN 'put' ELSE 'call' END AS kind FROM lineitem JOIN part ON l_partkey = p_partkey),
o1 AS (SELECT *, (ln(s / k) + (rf + v * v / 2) * t) / (v * sqrt(t)) AS d1 FROM opt), o2 AS (SELECT *, d1 - v * sqrt(t) AS d2, exp(-d1 * d1 / 2) / sqrt(2 * pi()) AS pdf, k * exp(-rf * t) AS dk FROM o1),
o3 AS (SELECT *, """ + normal_cdf_sql("d1") + " AS n1, " + normal_cdf_sql("d2") + """ AS n2 FROM o2),
o4 AS (SELECT *, CASE kind WHEN 'call' THEN s * n1 - dk * n2 ELSE dk * (1 - n2) - s * (1 - n1) END AS option_price, CASE kind WHEN 'call' THEN n1 ELSE n1 - 1 END AS delta, pdf / (s * v * sqrt(t)) AS gamma, s * pdf * sqrt(t) / 100 AS vega,
  (-s * pdf * v / (2 * sqrt(t)) + CASE kind WHEN 'call' THEN -rf * dk * n2 ELSE rf * dk * (1 - n2) END) / 365 AS theta, dk * t * CASE kind WHEN 'call' THEN n2 ELSE 1 - n2 END / 100 AS rho, greatest(CASE kind WHEN 'call' THEN s - k ELSE k - s END, 0) AS intrinsic_value FROM o3)"""


def options(spark, sf):
    l, p = fx.spread_table(spark, sf, "lineitem"), fx.table(spark, sf, "part").select("p_partkey", "p_retailprice")
    return l.join(p, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("order"), F.col("l_linenumber").alias("line"), F.col("l_suppkey").alias("sup"), F.col("p_retailprice").alias("s"), (F.col("p_retailprice") * (0.85 + 0.05 * F.col("l_linenumber"))).alias("k"),
        (F.col("l_quantity") / 25).alias("t"), F.lit(0.03).alias("rf"), (0.15 + F.col("l_discount") * 3).alias("v"), F.when(F.col("l_linenumber") % 2 == 0, "put").otherwise("call").alias("kind"),
    )


GREEKS = ("option_price", "delta", "vega", "theta", "rho", "intrinsic_value", "time_value")


@query("option_greeks", "D11", with_(OPTIONS, f"""SELECT "order", line, sup, {rs(*GREEKS, digits=5)}, {r('gamma', 8)} AS gamma FROM (SELECT *, option_price - intrinsic_value AS time_value FROM o4)"""))
def option_greeks(spark, sf):
    out = ops.black_scholes(options(spark, sf), "s", "k", "t", "rf", "v", "kind").select("order", "line", "sup", *GREEKS, "gamma")
    return near(near(out, *GREEKS, digits=5), "gamma", digits=8)


@query("implied_volatility", "D11", with_(OPTIONS, f"""SELECT "order", line, sup, {r('v', 4)} AS implied_vol FROM opt"""))
def implied_volatility(spark, sf):
    o = ops.black_scholes(options(spark, sf), "s", "k", "t", "rf", "v", "kind")
    c = lambda n: F.col(n)
    out = o.select("order", "line", "sup", ops.implied_volatility(c("option_price"), c("s"), c("k"), c("t"), c("rf"), c("kind")).alias("implied_vol"))
    return near(out, "implied_vol", digits=4)


FXC = ("theoretical_forward", "deviation_pct", "forward_premium", "total_return", "leveraged_return", "annualized_return")


@query(
    "currency_parity",
    "D12",
    f"""WITH q AS (SELECT c_nationkey AS base, s_nationkey AS quote, floor(avg(l_extendedprice / l_quantity)) / 2500 AS spot FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey WHERE c_nationkey <> s_nationkey GROUP BY 1, 2),
f AS (SELECT *, spot * (1 + (base % 7) / 1000 - (quote % 5) / 2000) AS fwd, (base % 9) / 100 AS rd, (quote % 6) / 100 AS rq FROM q),
p AS (SELECT *, spot * (1 + rd * 0.5) / (1 + rq * 0.5) AS theoretical_forward FROM f), x AS (SELECT *, (fwd - theoretical_forward) / theoretical_forward * 100 AS deviation_pct, (fwd - spot) / spot / 0.5 * 100 AS forward_premium, (rq - rd) * 0.5 + 0.01 AS total_return FROM p),
z AS (SELECT *, total_return * 3 AS leveraged_return, total_return * 3 / 0.5 AS annualized_return FROM x)
SELECT base, quote, {rs(*FXC)}, abs(deviation_pct) < 0.05 AS parity_holds, abs(deviation_pct) > 0.1 AS arbitrage FROM z""",
)
def currency_parity(spark, sf):
    q = fx_quotes(spark, sf).withColumnRenamed("ask", "spot")
    q = q.withColumns({"fwd": F.col("spot") * (1 + F.col("base") % 7 / 1000 - F.col("quote") % 5 / 2000), "rd": F.col("base") % 9 / 100, "rq": F.col("quote") % 6 / 100})
    half = F.lit(0.5)
    p = ops.covered_parity(F.col("spot"), F.col("fwd"), F.col("rd"), F.col("rq"), half)
    c = ops.carry_return(F.col("rd"), F.col("rq"), F.lit(0.01), half, 3.0)
    cols = {**p, **c, "forward_premium": ops.forward_premium(F.col("spot"), F.col("fwd"), half)}
    return near(q.select("base", "quote", *[cols[n].alias(n) for n in (*FXC, "parity_holds", "arbitrage")]), *FXC)
