"""Order-book queries: one book per order, its line items as levels; shipments as the trade tape."""

from pyspark.sql import functions as F

from candlewick import fixtures as fx
from candlewick.operators import microstructure as ops
from candlewick.plans.registry import near, query, r, rs
from candlewick.plans.sql import TRADES, with_

LEVELS = """lv AS (SELECT l_orderkey AS book, 100 + (l_orderkey % 900) / 10 - l_linenumber * 0.05::DOUBLE AS bid, l_quantity AS bid_size,
  100 + (l_orderkey % 900) / 10 + l_linenumber * 0.03::DOUBLE AS ask, (l_suppkey % 50 + 1)::DOUBLE AS ask_size FROM lineitem),
bid AS (SELECT book, bid AS price, bid_size AS size, row_number() OVER (PARTITION BY book ORDER BY bid DESC, bid_size DESC) AS k FROM lv),
ask AS (SELECT book, ask AS price, ask_size AS size, row_number() OVER (PARTITION BY book ORDER BY ask, ask_size) AS k FROM lv)"""


def books(spark, sf):
    base = F.lit(100) + F.col("l_orderkey") % 900 / 10
    lv = fx.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("book"), (base - F.col("l_linenumber") * 0.05).alias("bid"), F.col("l_quantity").alias("bid_size"),
        (base + F.col("l_linenumber") * 0.03).alias("ask"), (F.col("l_suppkey") % 50 + 1).cast("double").alias("ask_size"),
    )
    return ops.books(lv, ["book"])


METRICS = f"""b AS (SELECT book, sum(size) AS bv, sum(size * price) / sum(size) AS bid_vwap, arg_min(price, k) AS best_bid FROM bid WHERE k <= 3 GROUP BY book),
a AS (SELECT book, sum(size) AS av, sum(size * price) / sum(size) AS ask_vwap, arg_min(price, k) AS best_ask FROM ask WHERE k <= 3 GROUP BY book),
m AS (SELECT book, best_bid, best_ask, best_ask - best_bid AS spread, (best_bid + best_ask) / 2 AS mid_price, bv AS bid_volume, av AS ask_volume, (bv - av) / (bv + av) AS obi, bid_vwap, ask_vwap,
  (bid_vwap * av + ask_vwap * bv) / (av + bv) AS weighted_mid, CASE WHEN (bv - av) / (bv + av) > 0.1 THEN 'BUY' WHEN (bv - av) / (bv + av) < -0.1 THEN 'SELL' ELSE 'NEUTRAL' END AS pressure FROM b JOIN a USING (book))"""
M = ("best_bid", "best_ask", "spread", "mid_price", "spread_bps", "obi", "bid_vwap", "ask_vwap", "weighted_mid")


@query("book_metrics", "M1", with_(LEVELS, METRICS, f"SELECT book, pressure, {rs(*M)} FROM (SELECT *, spread / mid_price * 10000 AS spread_bps FROM m)"))
def book_metrics(spark, sf):
    return near(ops.book_metrics(books(spark, sf), 3).select("book", "pressure", *M), *M)


WALK = """ord AS (SELECT DISTINCT book, CASE WHEN book % 2 = 0 THEN 'buy' ELSE 'sell' END AS side, (book % 60 + 1)::DOUBLE AS q FROM lv),
lev AS (SELECT book, 'buy' AS side, price, size, k FROM ask UNION ALL SELECT book, 'sell', price, size, k FROM bid),
f AS (SELECT book, side, q, price, least(size, greatest(q - coalesce(sum(size) OVER (PARTITION BY book, side ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 0)) AS take FROM lev JOIN ord USING (book, side)),
t AS (SELECT book, any_value(side) AS side, any_value(q) AS q, sum(take) AS got, sum(take * price) AS cost, count(*) FILTER (take > 0) AS fills FROM f GROUP BY book),
w AS (SELECT t.*, (bid.price + ask.price) / 2 AS mid FROM t JOIN bid ON bid.book = t.book AND bid.k = 1 JOIN ask ON ask.book = t.book AND ask.k = 1)"""


@query(
    "book_slippage",
    "M2",
    with_(LEVELS, WALK, f"""SELECT book, side, q - got AS unfilled, CASE WHEN got >= q THEN fills END AS fill_count, {r('CASE WHEN got >= q THEN cost END', 4)} AS total_cost, {r('CASE WHEN got >= q THEN abs(cost / q - mid) / mid * 10000 END')} AS slippage_bps FROM w"""),
)
def book_slippage(spark, sf):
    side = F.when(F.col("book") % 2 == 0, "buy").otherwise("sell")
    out = ops.walk_book(books(spark, sf), side, F.col("book") % 60 + 1).withColumn("side", side).select("book", "side", "unfilled", "fill_count", "total_cost", "slippage_bps")
    return near(near(out, "slippage_bps"), "total_cost", digits=4)


TAPE = """tape AS (SELECT l_suppkey AS symbol, year(l_shipdate) AS period, l_shipdate AS ts, l_orderkey * 16 + l_linenumber AS seq, l_extendedprice / l_quantity AS price, l_quantity AS size,
  CASE l_returnflag WHEN 'N' THEN 'buy' WHEN 'R' THEN 'sell' ELSE 'sell' END AS side, l_tax FROM lineitem),
ob AS (SELECT symbol, period, sum(CASE WHEN l_tax > 0.04 THEN size ELSE -size END) / sum(size) AS obi FROM tape GROUP BY ALL),
g AS (SELECT symbol, period, count(*) AS trade_count, sum(CASE WHEN side = 'buy' THEN size ELSE 0 END) AS bv, sum(CASE WHEN side = 'sell' THEN size ELSE 0 END) AS sv,
  arg_min(price, {'a': ts, 'b': seq}) AS p0, arg_max(price, {'a': ts, 'b': seq}) AS p1, avg(size) AS av, max(size) AS mx FROM tape GROUP BY ALL HAVING count(*) >= 10),
x AS (SELECT *, (bv - sv) / (bv + sv) AS vi, (p1 - p0) / p0 * 10000 AS pi, mx / av AS sc FROM g JOIN ob USING (symbol, period)),
s AS (SELECT *, abs(vi) * 40 + least(abs(pi) / 10, 1) * 30 + least((sc - 1) / 9, 1) * 20 + abs(obi) * 10 AS tox FROM x)"""


@query(
    "toxic_flow",
    "M3",
    with_(TAPE, f"""SELECT symbol, period, trade_count, {r('tox')} AS toxicity_score, {r('vi')} AS vol_imbalance, {r('pi', 3)} AS price_impact_bps, {r('sc')} AS size_concentration,
  (vi > 0 AND obi > 0) OR (vi < 0 AND obi < 0) AS aligns_with_book, CASE WHEN tox > 45 THEN 'WIDEN_SPREADS' WHEN tox > 30 THEN 'STEP_BACK' ELSE 'NORMAL' END AS action,
  CASE WHEN tox > 60 THEN 'HIGH_RISK' WHEN tox > 30 THEN 'ELEVATED' ELSE 'CLEAN' END AS classification FROM s"""),
)
def toxic_flow(spark, sf):
    l = fx.table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("symbol"), F.year("l_shipdate").alias("period"), F.col("l_shipdate").alias("ts"), (F.col("l_orderkey") * 16 + F.col("l_linenumber")).alias("seq"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"), F.col("l_quantity").alias("size"), F.when(F.col("l_returnflag") == "N", "buy").otherwise("sell").alias("side"), "l_tax",
    )
    keys = ["symbol", "period"]
    obi = l.groupBy(*keys).agg((F.sum(F.when(F.col("l_tax") > 0.04, F.col("size")).otherwise(-F.col("size"))) / F.sum("size")).alias("obi"))
    out = ops.toxic_flow(l, keys, obi).select(*keys, "trade_count", "toxicity_score", "vol_imbalance", "price_impact_bps", "size_concentration", "aligns_with_book", "action", "classification")
    return near(near(out, "toxicity_score", "vol_imbalance", "size_concentration"), "price_impact_bps", digits=3)


Q = ("bid_price", "ask_price", "bid_size", "ask_size", "quoted_spread_bps", "edge_per_side_bps", "inventory_adj")


@query(
    "market_quotes",
    "M4",
    with_(LEVELS, METRICS, f"""q AS (SELECT book, book % 21 - 10 AS inv, mid_price AS mid, spread, obi, pressure, spread * 1.5 AS qs, 0.01 * (book % 21 - 10) * spread AS adj FROM m)""", f"""SELECT book,
  CASE WHEN pressure = 'SELL' AND inv > 0 THEN 'WIDEN' WHEN pressure = 'BUY' THEN 'TIGHTEN' ELSE 'MAINTAIN' END AS recommendation, {r('mid - qs / 2 - adj')} AS bid_price, {r('mid + qs / 2 - adj')} AS ask_price,
  {r('CASE WHEN obi > 0 THEN 100 * (1 + obi) ELSE 100 END')} AS bid_size, {r('CASE WHEN obi < 0 THEN 100 * (1 - obi) ELSE 100 END')} AS ask_size, {r('qs / mid * 10000')} AS quoted_spread_bps,
  {r('qs / 2 / mid * 10000')} AS edge_per_side_bps, {r('adj')} AS inventory_adj FROM q"""),
)
def market_quotes(spark, sf):
    out = ops.market_quotes(ops.book_metrics(books(spark, sf), 3), F.col("book") % 21 - 10, 1.5)
    return near(out.select("book", "recommendation", *Q), *Q)


def orders(spark, sf):
    return fx.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order"), F.col("l_linenumber").alias("line"), F.col("l_suppkey").alias("symbol"), F.col("l_quantity").alias("size"), (F.col("l_extendedprice") / 10).alias("adv"),
        (F.col("l_discount") + 0.01).alias("volatility"), F.when(F.col("l_returnflag") == "A", "market").when(F.col("l_returnflag") == "R", "limit").otherwise("midpoint").alias("type"),
    )


C = ("permanent", "total", "participation_rate", "base_impact_bps", "slippage")


@query(
    "execution_costs",
    "M5",
    f"""WITH o AS (SELECT l_orderkey AS "order", l_linenumber AS line, l_quantity AS size, l_extendedprice / 10 AS adv, l_discount + 0.01 AS v, l_returnflag AS f FROM lineitem)
SELECT "order", line, {r('0.1 * v * sqrt(size / adv) * 0.5')} AS permanent, {r('0.1 * v * sqrt(size / adv)')} AS total, {r('size / adv')} AS participation_rate, {r('v * sqrt(size / adv) * 10000')} AS base_impact_bps,
  {r("CASE f WHEN 'A' THEN 5 WHEN 'R' THEN 0 ELSE 2.5 END + 0.5 * v * 10000 + 0.1 * sqrt(size / adv) * 10000")} AS slippage FROM o""",
)
def execution_costs(spark, sf):
    args = F.col("size"), F.col("adv"), F.col("volatility")
    out = orders(spark, sf).withColumns({**ops.impact(*args), "slippage": ops.slippage_bps(*args, F.col("type"))})
    return near(out.select("order", "line", *C), *C)


@query(
    "twap_schedule",
    "M5",
    """SELECT o_orderkey AS "order", i AS "interval", o_totalprice / 6 AS child_quantity, i * 5 AS execution_minute FROM orders, (SELECT unnest(range(6))::INT AS i)""",
)
def twap_schedule(spark, sf):
    o = fx.table(spark, sf, "orders").select(F.col("o_orderkey").alias("order"), F.col("o_totalprice").alias("q"))
    return ops.twap_schedule(o, "q", 6).drop("q")


@query(
    "vwap_schedule",
    "M5",
    f"""WITH p AS (SELECT o_orderkey AS "order", o_totalprice AS q, l_linenumber AS k, sum(l_quantity) AS v FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL),
s AS (SELECT *, row_number() OVER (PARTITION BY "order" ORDER BY k) - 1 AS i, v / sum(v) OVER (PARTITION BY "order") AS w FROM p)
SELECT "order", i::INT AS "interval", {r('w')} AS volume_participation, {r('q * w', 3)} AS child_quantity FROM s""",
)
def vwap_schedule(spark, sf):
    o = fx.table(spark, sf, "orders").select(F.col("o_orderkey").alias("order"), F.col("o_totalprice").alias("q"))
    v = fx.table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("order"), "l_linenumber").agg(F.sum("l_quantity").alias("v"))
    profile = v.groupBy("order").agg(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "v"))), lambda x: x["v"]).alias("profile"))
    out = ops.vwap_schedule(o.join(profile, "order"), "q", "profile").drop("q")
    return near(near(out, "volume_participation"), "child_quantity", digits=3)


@query(
    "pov_schedule",
    "M5",
    f"""WITH v AS (SELECT l_orderkey, sum(l_quantity) AS mv FROM lineitem GROUP BY 1)
SELECT o_orderkey AS "order", 0.1::DOUBLE AS target_participation, 0.2::DOUBLE AS max_participation, {r('o_totalprice / 1000 / 0.1', 4)} AS needed_volume, {r('o_totalprice / 1000 / mv')} AS share_of_volume FROM orders LEFT JOIN v ON l_orderkey = o_orderkey""",
)
def pov_schedule(spark, sf):
    o = fx.table(spark, sf, "orders").select(F.col("o_orderkey").alias("order"), (F.col("o_totalprice") / 1000).alias("q"))
    v = fx.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("order"), F.col("l_quantity").alias("volume"))
    return near(near(ops.pov_schedule(o, v, ["order"], "q").drop("q", "market_volume"), "share_of_volume"), "needed_volume", digits=4)


@query(
    "fill_pnl",
    "M6",
    f"""WITH f AS (SELECT l_orderkey AS "order", l_linenumber AS line, l_suppkey AS sup, CASE l_returnflag WHEN 'A' THEN 'long' WHEN 'R' THEN 'Buy' ELSE 'short' END AS d, l_extendedprice / l_quantity AS e, p_retailprice * 1.2::DOUBLE AS x, l_quantity AS q FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT "order", line, sup, {r("(x - e) * q * 10 * CASE WHEN d = 'short' THEN -1 ELSE 1 END", 3)} AS pnl, {r("(x - e) / e * 100 * CASE WHEN d = 'short' THEN -1 ELSE 1 END")} AS pnl_pct, {r('x * q * 10 * 0.0003', 4)} AS commission, {r('x * q * 10 * 0.12', 4)} AS margin FROM f""",
)
def fill_pnl(spark, sf):
    l, p = fx.table(spark, sf, "lineitem"), fx.table(spark, sf, "part")
    d = F.when(F.col("l_returnflag") == "A", "long").when(F.col("l_returnflag") == "R", "Buy").otherwise("short")
    e, x, q = F.col("l_extendedprice") / F.col("l_quantity"), F.col("p_retailprice") * 1.2, F.col("l_quantity")
    j = l.join(p.select("p_partkey", "p_retailprice"), F.col("l_partkey") == F.col("p_partkey"))
    out = j.select(
        F.col("l_orderkey").alias("order"), F.col("l_linenumber").alias("line"), F.col("l_suppkey").alias("sup"),
        *[c.alias(n) for n, c in ops.pnl(d, e, x, q, 10.0).items()], ops.commission(x, q, 0.0003, 10.0).alias("commission"), ops.margin(x, q, 0.12, 10.0).alias("margin"),
    )
    return near(near(near(out, "pnl", digits=3), "pnl_pct"), "commission", "margin", digits=4)
