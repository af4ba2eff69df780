"""Join queries."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick import fixtures as fx
from candlewick.functions.stats import t_p_sql
from candlewick.operators import joins as ops
from candlewick.operators.series import DAILY, HOURLY, TICK
from candlewick.plans.quality import DEALS_SQL, deals
from candlewick.plans.registry import near, query, r, rs
from candlewick.plans.sql import DAILY as DAILY_SQL
from candlewick.plans.sql import HOURLY as HOURLY_SQL
from candlewick.plans.sql import RETURNS, TICKS, with_
from candlewick.plans.windows import returns


def one(spark, sf, symbol, name="value"):
    return fx.hourly(spark, sf).filter(F.col("symbol") == symbol).select("ts", F.col("close").alias(name))


VC = "v AS (SELECT ts, close AS value FROM bars WHERE symbol = 'view'), c AS (SELECT ts, close AS value FROM bars WHERE symbol = 'click')"


@query(
    "align_series",
    "J1",
    with_(HOURLY_SQL, VC, " UNION ALL ".join(f"SELECT ts, v.value AS x, c.value AS y, '{h}' AS how FROM v {j} JOIN c USING (ts)" for h, j in (("inner", ""), ("outer", "FULL"), ("left", "LEFT"), ("right", "RIGHT")))),
)
def align_series(spark, sf):
    x, y = one(spark, sf, "view", "x"), one(spark, sf, "click", "y")
    return reduce(DataFrame.unionByName, [ops.align(x, y, ["ts"], h).withColumn("how", F.lit(h)) for h in ("inner", "outer", "left", "right")])


@query("combine_first", "J2", with_(HOURLY_SQL, VC, "SELECT ts, coalesce(v.value, c.value) AS value FROM v FULL JOIN c USING (ts)"))
def combine_first(spark, sf):
    return ops.combine_first(one(spark, sf, "view"), one(spark, sf, "click"), ["ts"])


@query(
    "merge_three",
    "J3",
    with_(HOURLY_SQL, VC, "e AS (SELECT ts, close AS value FROM bars WHERE symbol = 'error')", "SELECT ts, v.value AS value, c.value AS value_dup, e.value AS value_dup_dup FROM v FULL JOIN c USING (ts) FULL JOIN e USING (ts)"),
)
def merge_three(spark, sf):
    return ops.merge_all([one(spark, sf, s) for s in ("view", "click", "error")], ["ts"])


@query("common_dates", "J3", with_(HOURLY_SQL, VC, "e AS (SELECT ts, close AS value FROM bars WHERE symbol = 'error')", "SELECT ts, value, 'view' AS symbol FROM v WHERE ts IN (SELECT ts FROM c) AND ts IN (SELECT ts FROM e) UNION ALL SELECT ts, value, 'click' FROM c WHERE ts IN (SELECT ts FROM v) AND ts IN (SELECT ts FROM e) UNION ALL SELECT ts, value, 'error' FROM e WHERE ts IN (SELECT ts FROM v) AND ts IN (SELECT ts FROM c)"))
def common_dates(spark, sf):
    names = ("view", "click", "error")
    parts = ops.common_dates([one(spark, sf, s) for s in names], "ts")
    return reduce(DataFrame.unionByName, [p.withColumn("symbol", F.lit(s)) for s, p in zip(names, parts)])


@query("compare_series", "J4", with_(HOURLY_SQL, VC, f"SELECT ts, v.value AS x, c.value AS y, {r('v.value - c.value')} AS diff, {r('(v.value - c.value) / c.value * 100')} AS pct_diff FROM v JOIN c USING (ts)"))
def compare_series(spark, sf):
    return near(ops.compare(one(spark, sf, "view"), one(spark, sf, "click"), ["ts"]), "diff", "pct_diff")


@query(
    "dataset_diff",
    "J5",
    """WITH a AS (SELECT * FROM customer WHERE c_acctbal < 8000), b AS (SELECT c_custkey, c_name, CASE WHEN c_mktsegment = 'MACHINERY' THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal FROM customer WHERE c_acctbal > 1000)
SELECT CAST(coalesce(a.c_custkey, b.c_custkey) AS VARCHAR) AS key, CASE WHEN a.c_custkey IS NULL THEN 'added' WHEN b.c_custkey IS NULL THEN 'removed' ELSE 'changed' END AS change
FROM a FULL JOIN b ON a.c_custkey = b.c_custkey WHERE a.c_custkey IS NULL OR b.c_custkey IS NULL OR a.c_acctbal <> b.c_acctbal""",
)
def dataset_diff(spark, sf):
    c = fx.table(spark, sf, "customer")
    bumped = F.when(F.col("c_mktsegment") == "MACHINERY", F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal"))
    a = c.filter("c_acctbal < 8000").select("c_custkey", "c_name", "c_acctbal")
    b = c.filter("c_acctbal > 1000").select("c_custkey", "c_name", bumped.alias("c_acctbal"))
    return ops.dataset_diff(a, b, "c_custkey").select("key", "change")


@query(
    "regular_grid",
    "J6",
    with_(
        HOURLY_SQL,
        "g AS (SELECT symbol, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS ts FROM (SELECT symbol, min(ts) AS lo, max(ts) AS hi FROM bars GROUP BY symbol))",
        "SELECT g.symbol, g.ts, b.close FROM g LEFT JOIN bars b ON g.symbol = b.symbol AND g.ts = b.ts",
    ),
)
def regular_grid(spark, sf):
    return ops.spine(fx.hourly(spark, sf).select("symbol", "ts", "close"), "symbol", "ts", 3600, chunk=100)


@query(
    "asof_bar_for_tick",
    "J7",
    with_(
        HOURLY_SQL,
        "SELECT t.symbol, t.ts, t.seq, t.price, b.ts AS bar_ts, b.close AS bar_close FROM ticks t ASOF LEFT JOIN (SELECT symbol, ts + INTERVAL 1 HOUR AS known, ts, close FROM bars) b ON t.symbol = b.symbol AND t.ts >= b.known",
    ),
)
def asof_bar_for_tick(spark, sf):
    """The last finished hourly bar for every tick."""
    ticks = fx.ticks(spark, sf).select("symbol", "ts", "seq", "price")
    bars = fx.hourly(spark, sf).select("symbol", (F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("known"), F.col("ts").alias("bar_ts"), F.col("close").alias("bar_close"))
    return ops.asof(ticks, bars.withColumnRenamed("known", "ts"), TICK, ["bar_ts", "bar_close"])


BENCH = "bench AS (SELECT ts, avg(ret) AS bench FROM rets WHERE ret IS NOT NULL GROUP BY ts)"


def benchmark(spark, sf):
    """Equal-weight mean return of all symbols per hour."""
    return returns(spark, sf).filter("ret IS NOT NULL").groupBy("ts").agg(F.avg("ret").alias("bench"))


@query(
    "benchmark_alignment",
    "J8",
    with_(
        HOURLY_SQL,
        RETURNS,
        BENCH,
        f"j AS (SELECT symbol, r.ts, ret, bench FROM rets r JOIN bench b ON r.ts = b.ts WHERE ret IS NOT NULL)",
        f"SELECT 'all' AS market, symbol, count(*) AS n, {r('avg(ret)', 5)} AS mean FROM j GROUP BY symbol UNION ALL SELECT 'bull', symbol, count(*), {r('avg(ret)', 5)} FROM j WHERE bench > 0 GROUP BY symbol UNION ALL SELECT 'bear', symbol, count(*), {r('avg(ret)', 5)} FROM j WHERE bench < 0 GROUP BY symbol",
    ),
)
def benchmark_alignment(spark, sf):
    rets, b = returns(spark, sf).filter("ret IS NOT NULL").select("symbol", "ts", "ret"), benchmark(spark, sf)
    parts = []
    for m in ("all", "bull", "bear"):
        rows = ops.benchmark_pairs(rets, b, "ts", m)
        parts.append(rows.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"), F.avg("ret").alias("mean")).withColumn("market", F.lit(m)))
    return near(reduce(DataFrame.unionByName, parts), "mean", digits=5)


MULT_SQL = "mult AS (SELECT l_orderkey AS deal_id, sum(l_extendedprice) / sum(l_quantity) AS ev_revenue, count(*) * 1.0::DOUBLE AS ev_ebitda FROM lineitem GROUP BY l_orderkey)"


def multiples(spark, sf):
    return fx.table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("deal_id")).agg(
        (F.sum("l_extendedprice") / F.sum("l_quantity")).alias("ev_revenue"), F.count(F.lit(1)).cast("double").alias("ev_ebitda")
    )


@query(
    "comparable_deals",
    "J9",
    with_(
        DEALS_SQL,
        MULT_SQL,
        f"""SELECT d.deal_id, deal_value, announcement_date, {r('ev_revenue')} AS ev_revenue, ev_ebitda FROM deals d LEFT JOIN mult m ON d.deal_id = m.deal_id
WHERE industry = 'BUILDING' AND deal_value BETWEEN 100000 AND 300000 AND announcement_date BETWEEN '1996-01-01' AND '1999-12-31' AND deal_status = 'Completed' ORDER BY announcement_date DESC, d.deal_id LIMIT 20""",
    ),
)
def comparable_deals(spark, sf):
    out = ops.comparable_deals(deals(spark, sf), multiples(spark, sf), "BUILDING", 100000, 300000, "1996-01-01", "1999-12-31")
    return near(out, "ev_revenue").select("deal_id", "deal_value", "announcement_date", "ev_revenue", "ev_ebitda")


def busiest(spark, sf):
    """The day with the largest volume of each symbol as its event."""
    return fx.daily(spark, sf).groupBy("symbol").agg(F.max_by("ts", F.struct("volume", "ts")).alias("ts"))


EVENTS_SQL = """ri AS (SELECT symbol, ts, ret, row_number() OVER (PARTITION BY symbol ORDER BY ts) AS i FROM rets WHERE ret IS NOT NULL),
ev AS (SELECT DISTINCT ON (symbol) symbol, ts FROM bars ORDER BY symbol, volume DESC, ts DESC), e AS (SELECT ri.symbol, ri.ts AS event_ts, i AS e FROM ri JOIN ev ON ri.symbol = ev.symbol AND ri.ts = ev.ts)"""


STUDY_SQL = """s AS (SELECT e.symbol, event_ts, avg(ret) FILTER (i < e - 10) AS expected, stddev_samp(ret) FILTER (i < e - 10) AS sd, count(*) FILTER (i < e - 10) AS n_estimation,
  count(*) FILTER (i >= e - 10) AS n_event, sum(ret) FILTER (i >= e - 10) AS total FROM e JOIN ri ON e.symbol = ri.symbol AND i BETWEEN e - 260 AND e + 10 WHERE e > 11 GROUP BY e.symbol, event_ts)"""


@query(
    "event_study",
    "J10",
    with_(
        DAILY_SQL,
        RETURNS,
        EVENTS_SQL,
        STUDY_SQL,
        f"""SELECT symbol, event_ts, {r('expected')} AS expected, n_estimation, n_event, {r('total - n_event * expected')} AS car, {r('total / n_event - expected')} AS avg_abnormal,
  {r('(total / n_event - expected) / (sd / sqrt(n_event))')} AS t_stat FROM s""",
    ),
)
def event_study(spark, sf):
    out = ops.event_study(returns(spark, sf, daily=True), busiest(spark, sf), DAILY)
    return near(out, "expected", "car", "avg_abnormal", "t_stat")


@query(
    "event_significance",
    "J10",
    with_(
        DAILY_SQL, RETURNS, EVENTS_SQL, STUDY_SQL, "t AS (SELECT *, (total / n_event - expected) / (sd / sqrt(n_event)) AS t FROM s)",
        f"SELECT symbol, event_ts, {r('t')} AS t_stat, {r(t_p_sql('t', 'n_estimation - 1'))} AS p_value, {t_p_sql('t', 'n_estimation - 1')} < 0.05 AS significant FROM t",
    ),
)
def event_significance(spark, sf):
    study = ops.event_study(returns(spark, sf, daily=True), busiest(spark, sf), DAILY)
    return near(ops.event_significance(study), "t_stat", "p_value").select("symbol", "event_ts", "t_stat", "p_value", "significant")


@query(
    "post_event_drift",
    "J10",
    with_(
        DAILY_SQL,
        RETURNS,
        EVENTS_SQL,
        "p AS (SELECT unnest([5, 10, 20, 60]) AS period)",
        "d AS (SELECT period, e.symbol, event_ts, exp(sum(ln(1 + ret))) - 1 AS drift FROM e, p, ri WHERE e.symbol = ri.symbol AND i > e AND i <= e + period GROUP BY ALL HAVING count(*) = period)",
        f"SELECT period, {r('avg(drift)')} AS average_drift, {r('stddev_pop(drift)')} AS drift_std, {r('avg(drift) / (stddev_pop(drift) / sqrt(count(*)))')} AS t_stat, count(*) AS sample_size FROM d GROUP BY period",
    ),
)
def post_event_drift(spark, sf):
    out = ops.post_event_drift(returns(spark, sf, daily=True), busiest(spark, sf), DAILY)
    return near(out, "average_drift", "drift_std", "t_stat")


def fx_quotes(spark, sf):
    """Nations as currencies: the rate of a pair is the mean unit price between customer and supplier nation."""
    l = fx.table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", (F.col("l_extendedprice") / F.col("l_quantity")).alias("p"))
    o = fx.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    c = fx.table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("base"))
    s = fx.table(spark, sf, "supplier").select("s_suppkey", F.col("s_nationkey").alias("quote"))
    rows = l.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(c, F.col("o_custkey") == F.col("c_custkey")).join(s, F.col("l_suppkey") == F.col("s_suppkey"))
    rate = F.floor(F.avg("p")) / 2500
    return rows.filter("base <> quote").groupBy("base", "quote").agg((rate * 0.999).alias("bid"), rate.alias("ask"))


@query(
    "triangular_arbitrage",
    "J11",
    with_(
        """q AS (SELECT c_nationkey AS base, s_nationkey AS quote, floor(avg(l_extendedprice / l_quantity)) / 2500 * 0.999 AS bid, floor(avg(l_extendedprice / l_quantity)) / 2500 AS ask
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey WHERE c_nationkey <> s_nationkey GROUP BY ALL)""",
        """t AS (SELECT p1.base AS a, p1.quote AS b, p2.quote AS c, p1.ask * p2.ask * p3.bid AS forward, p3.ask * (1 / p2.bid) * (1 / p1.bid) AS reverse
  FROM q p1 JOIN q p2 ON p1.quote = p2.base JOIN q p3 ON p3.base = p2.quote AND p3.quote = p1.base WHERE p1.base < p1.quote AND p2.base < p2.quote)""",
        f"SELECT a, b, c, {rs('forward', 'reverse')}, CASE WHEN forward > reverse THEN 'forward' ELSE 'reverse' END AS best_path, {r('(greatest(forward, reverse) - 1) * 100')} AS profit_pct FROM t WHERE greatest(forward, reverse) > 1",
    ),
)
def triangular_arbitrage(spark, sf):
    return near(ops.triangles(fx_quotes(spark, sf)), "forward", "reverse", "profit_pct")


@query(
    "match_symbols",
    "J12",
    """WITH w AS (SELECT p_name AS s FROM part UNION SELECT p_type FROM part UNION SELECT lower(p_type) || '/' FROM part),
k AS (SELECT DISTINCT p_type AS m FROM part UNION SELECT DISTINCT split_part(p_name, ' ', 1) FROM part),
j AS (SELECT s, m, upper(regexp_replace(s, '[/_:-]', '', 'g')) AS a, upper(regexp_replace(m, '[/_:-]', '', 'g')) AS b FROM w, k),
f AS (SELECT s, m, CASE WHEN s = m THEN 0 WHEN a = b THEN 1 ELSE 2 END AS rank FROM j WHERE s = m OR a = b OR starts_with(a, b) OR starts_with(b, a)),
g AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY rank, m) AS n FROM f)
SELECT w.s AS symbol, g.m AS match, g.rank FROM w LEFT JOIN g ON w.s = g.s AND n = 1""",
)
def match_symbols(spark, sf):
    p = fx.table(spark, sf, "part")
    names = [F.col("p_name"), F.col("p_type"), F.concat(F.lower("p_type"), F.lit("/"))]
    wanted = reduce(DataFrame.union, [p.select(c.alias("symbol")) for c in names])
    known = p.select(F.col("p_type").alias("symbol")).union(p.select(F.split("p_name", " ")[0]))
    return ops.match_symbols(wanted, known)


def _place(key):
    """Position on the globe from a key."""
    return [((key * 37) % 1700 / 10 - 85).alias("lat"), ((key * 91) % 3600 / 10 - 180).alias("lon")]


@query(
    "within_radius",
    "J13",
    with_(
        "c AS (SELECT c_custkey AS point, (c_custkey * 37) % 1700 / 10 - 85 AS lat, (c_custkey * 91) % 3600 / 10 - 180 AS lon FROM customer)",
        "s AS (SELECT s_suppkey AS centre, (s_suppkey * 53) * 37 % 1700 / 10 - 85 AS lat, (s_suppkey * 53) * 91 % 3600 / 10 - 180 AS lon FROM supplier)",
        """d AS (SELECT centre, point, power(sin(radians(c.lat - s.lat) / 2), 2) + cos(radians(s.lat)) * cos(radians(c.lat)) * power(sin(radians(c.lon - s.lon) / 2), 2) AS a FROM c, s),
k AS (SELECT centre, point, 6371 * 2 * atan2(sqrt(a), sqrt(1 - a)) AS km FROM d)""",
        f"SELECT centre, point, {r('km', 4)} AS distance_km FROM k WHERE km <= 900",
    ),
)
def within_radius(spark, sf):
    points = fx.table(spark, sf, "customer").select(F.col("c_custkey").alias("point"), *_place(F.col("c_custkey")))
    centres = fx.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("centre"), *_place(F.col("s_suppkey") * 53))
    return near(ops.within_radius(centres, points, 900.0).select("centre", "point", "distance_km"), "distance_km", digits=4)


@query(
    "correlation_pairs",
    "J14",
    with_(
        DAILY_SQL,
        RETURNS,
        "p AS (SELECT a.symbol AS a, b.symbol AS b, count(*) AS n, covar_samp(a.ret, b.ret) AS cov, corr(a.ret, b.ret) AS corr FROM rets a JOIN rets b ON a.ts = b.ts AND a.symbol <= b.symbol WHERE a.ret IS NOT NULL AND b.ret IS NOT NULL GROUP BY ALL)",
        f"SELECT a, b, n, {rs('cov', 'corr')} FROM p",
    ),
)
def correlation_pairs(spark, sf):
    return near(ops.correlation_pairs(returns(spark, sf, daily=True), "ts", "symbol", "ret"), "cov", "corr")


def holdings(spark, sf):
    """Customers as portfolios, ordered parts as positions."""
    l = fx.table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice")
    o = fx.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return l.join(o, F.col("l_orderkey") == F.col("o_orderkey")).groupBy(F.col("o_custkey").alias("portfolio"), F.col("l_partkey").alias("symbol")).agg(
        F.sum("l_quantity").alias("quantity"), (F.sum("l_extendedprice") / F.sum("l_quantity")).alias("avg_price")
    )


def quotes(spark, sf):
    return fx.table(spark, sf, "part").filter("p_size >= 5").select(
        F.col("p_partkey").alias("symbol"), (F.col("p_retailprice") * 2).alias("price"), (F.col("p_size") % 11 - 5).cast("double").alias("change")
    )


HOLDINGS_SQL = """holdings AS (SELECT o_custkey AS portfolio, l_partkey AS symbol, sum(l_quantity) AS quantity, sum(l_extendedprice) / sum(l_quantity) AS avg_price FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL),
quotes AS (SELECT p_partkey AS symbol, p_retailprice * 2 AS price, CAST(p_size % 11 - 5 AS DOUBLE) AS change FROM part WHERE p_size >= 5),
valued AS (SELECT portfolio, h.symbol, quantity, avg_price, coalesce(price, avg_price) AS current_price, quantity * avg_price AS cost_basis, quantity * coalesce(price, avg_price) AS market_value,
  coalesce(change, 0) * quantity AS day_change FROM holdings h LEFT JOIN quotes q ON h.symbol = q.symbol)"""


@query(
    "portfolio_valuation",
    "J15",
    with_(
        HOLDINGS_SQL,
        f"""SELECT portfolio, symbol, quantity, {rs('avg_price', 'current_price', 'cost_basis', 'market_value', 'day_change', digits=3)}, {r('market_value - cost_basis', 3)} AS unrealized_pnl,
  {r('(market_value - cost_basis) / cost_basis * 100', 3)} AS unrealized_pct, {r('market_value / sum(market_value) OVER (PARTITION BY portfolio) * 100', 5)} AS weight FROM valued""",
    ),
)
def portfolio_valuation(spark, sf):
    out = ops.value_holdings(holdings(spark, sf), quotes(spark, sf))
    out = near(out, "avg_price", "current_price", "cost_basis", "market_value", "day_change", "unrealized_pnl", "unrealized_pct", digits=3)
    return near(out, "weight", digits=5)


@query(
    "portfolio_totals",
    "J15",
    with_(
        HOLDINGS_SQL,
        "t AS (SELECT portfolio, sum(market_value) AS market_value, sum(cost_basis) AS cost_basis, sum(day_change) AS day_change, count(*) FILTER (market_value - cost_basis >= 0) AS gainers, count(*) FILTER (market_value - cost_basis < 0) AS losers, count(*) AS positions FROM valued GROUP BY portfolio)",
        f"""SELECT portfolio, {rs('market_value', 'cost_basis', 'day_change', digits=2)}, {r('market_value - cost_basis', 2)} AS unrealized_pnl, {r('(market_value - cost_basis) / cost_basis * 100', 4)} AS unrealized_pct,
  {r('day_change / (market_value - day_change) * 100', 4)} AS day_change_pct, gainers, losers, positions, DATE '2024-01-31' AS date FROM t""",
    ),
)
def portfolio_totals(spark, sf):
    totals = ops.portfolio_totals(ops.value_holdings(holdings(spark, sf), quotes(spark, sf)))
    out = near(near(totals, "market_value", "cost_basis", "day_change", "unrealized_pnl", digits=2), "unrealized_pct", "day_change_pct", digits=4)
    day = F.lit("2024-01-31").cast("date")
    return ops.upsert_snapshot(out.withColumn("date", day), out, day)
