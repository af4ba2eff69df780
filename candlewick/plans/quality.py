"""Cleaning, data-quality and filter queries."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick import fixtures as fx
from candlewick.operators import quality as ops
from candlewick.operators.series import HOURLY
from candlewick.plans.registry import log_scale, log_sql, near, query, r, rs
from candlewick.plans.sql import HOURLY as HOURLY_SQL
from candlewick.plans.sql import DAILY as DAILY_SQL
from candlewick.plans.sql import MINUTE, with_

# Minute bars with some prices knocked out or negated, the same way in both engines.
DIRTY = """dirty AS (SELECT symbol, "timestamp", CASE WHEN seq % 97 = 0 THEN NULL ELSE open END AS open, CASE WHEN seq % 89 = 0 THEN -high ELSE high END AS high,
  low, CASE WHEN seq % 83 = 0 THEN NULL ELSE close END AS close, CASE WHEN seq % 79 = 0 THEN NULL ELSE volume END AS volume FROM minute)"""


def dirty(spark, sf):
    m = fx.minute_like(spark, sf)
    hit = lambda k: F.col("seq") % k == 0
    return m.select(
        "symbol", "timestamp",
        F.when(~hit(97), F.col("open")).alias("open"),
        F.when(hit(89), -F.col("high")).otherwise(F.col("high")).alias("high"),
        "low",
        F.when(~hit(83), F.col("close")).alias("close"),
        F.when(~hit(79), F.col("volume")).alias("volume"),
    )


@query(
    "null_counts",
    "F1",
    with_(MINUTE, DIRTY, "SELECT " + ", ".join(f'count(*) FILTER ("{c}" IS NULL) AS "{c}"' for c in ("symbol", "timestamp", "open", "high", "low", "close", "volume")) + " FROM dirty"),
)
def null_counts(spark, sf):
    return ops.null_counts(dirty(spark, sf))


OK = "open > 0 AND high > 0 AND low > 0 AND close > 0 AND high >= low AND high >= open AND high >= close AND low <= open AND low <= close"


@query(
    "valid_ohlc",
    "F2",
    with_(MINUTE, DIRTY, f"""SELECT symbol, "timestamp", CAST(open AS DOUBLE) AS open, CAST(high AS DOUBLE) AS high, CAST(low AS DOUBLE) AS low, CAST(close AS DOUBLE) AS close, volume FROM dirty WHERE {OK}"""),
)
def valid_ohlc(spark, sf):
    return ops.valid_ohlc(dirty(spark, sf)).withColumns({c: F.col(c).cast("double") for c in ops.PRICES})


@query(
    "cleaning_report",
    "F3",
    with_(
        MINUTE,
        DIRTY,
        f"""SELECT count(*) AS initial, count(*) FILTER (coalesce({OK}, false)) AS final, count(*) FILTER (NOT coalesce({OK}, false)) AS removed,
  round(count(*) FILTER (coalesce({OK}, false)) * 100.0 / count(*), 2)::DOUBLE AS retention_pct,
  count(*) FILTER (open IS NULL OR high IS NULL OR low IS NULL OR close IS NULL) AS null_price,
  count(*) FILTER (open <= 0 OR high <= 0 OR low <= 0 OR close <= 0) AS non_positive,
  count(*) FILTER (high < low) AS high_below_low, count(*) FILTER (high < open OR high < close) AS high_below_open_close,
  count(*) FILTER (low > open OR low > close) AS low_above_open_close FROM dirty""",
    ),
)
def cleaning_report(spark, sf):
    return ops.cleaning_report(dirty(spark, sf))


@query(
    "blank_counts",
    "F4",
    """SELECT count(*) AS n_rows, 'text' AS field, count(*) FILTER (text IS NULL OR trim(text) = '') AS n_blank FROM documents
UNION ALL SELECT count(*), 'lang', count(*) FILTER (lang IS NULL OR trim(lang) = '') FROM documents
UNION ALL SELECT count(*), 'source', count(*) FILTER (source IS NULL OR trim(source) = '') FROM documents""",
)
def blank_counts(spark, sf):
    return ops.blank_counts(fx.table(spark, sf, "documents"), ["text", "lang", "source"])


@query(
    "key_rule_mismatches",
    "F5",
    """WITH e AS (SELECT CAST(c_custkey AS VARCHAR) AS code, CASE WHEN c_nationkey % 2 = 0 THEN 'sse' ELSE 'szse' END AS market FROM customer),
b AS (SELECT code, market, CASE WHEN regexp_matches(code, '^[569]') THEN 'sse' ELSE 'szse' END AS expected FROM e)
SELECT code, market, expected, (SELECT count(*) FROM b WHERE market <> expected) AS n_mismatch FROM b WHERE market <> expected ORDER BY code LIMIT 20""",
)
def key_rule_mismatches(spark, sf):
    c = fx.table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("code"), F.when(F.col("c_nationkey") % 2 == 0, "sse").otherwise("szse").alias("market")
    )
    expected = F.when(F.col("code").rlike("^[569]"), "sse").otherwise("szse")
    return ops.key_rule_mismatches(c, expected, "market", ["code"])


@query(
    "file_integrity",
    "F6",
    """WITH idx AS (SELECT page_id, sha256(html) AS good FROM pages UNION ALL SELECT max(page_id) + 1, 'none' FROM pages)
SELECT CAST(page_id AS VARCHAR) AS path, CASE WHEN p.html IS NULL THEN 'missing' WHEN length(p.html) % 10 = 0 THEN 'mismatch' ELSE 'ok' END AS state
FROM idx LEFT JOIN pages p USING (page_id)""",
)
def file_integrity(spark, sf):
    pages = fx.table(spark, sf, "pages")
    files = pages.select(F.col("page_id").cast("string").alias("path"), F.encode("html", "utf-8").alias("content"))
    bad = F.length("html") % 10 == 0
    index = pages.select(
        F.col("page_id").cast("string").alias("path"),
        F.when(bad, F.sha2("url", 256)).otherwise(F.sha2("html", 256)).alias("sha256"),
    )
    gone = pages.agg((F.max("page_id") + 1).cast("string").alias("path"), F.lit("none").alias("sha256"))
    return ops.file_integrity(index.unionByName(gone), files).select("path", "state")


@query(
    "table_coverage",
    "F7",
    f"SELECT count(*) AS total, count(l.doc_id) AS covered, round(count(l.doc_id) * 100.0 / count(*), 2)::DOUBLE AS coverage_pct FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id",
)
def table_coverage(spark, sf):
    return ops.coverage(fx.table(spark, sf, "documents"), fx.table(spark, sf, "labels"), "doc_id")


@query(
    "coverage_by_quarter",
    "F7",
    """SELECT o_orderpriority AS dataset, CAST(year(o_orderdate) AS INTEGER) AS fiscal_year, CAST(quarter(o_orderdate) AS INTEGER) AS fiscal_quarter, count(*) AS n_rows
FROM orders GROUP BY ALL ORDER BY fiscal_year DESC, fiscal_quarter DESC, dataset LIMIT 60""",
)
def coverage_by_quarter(spark, sf):
    o = fx.table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("dataset"), F.year("o_orderdate").alias("fiscal_year"), F.quarter("o_orderdate").alias("fiscal_quarter")
    )
    return ops.coverage_counts(o, ["dataset", "fiscal_year", "fiscal_quarter"])


@query(
    "required_fields",
    "F8",
    with_(
        MINUTE,
        DIRTY,
        """SELECT symbol, "timestamp", list_filter([CASE WHEN open IS NULL THEN 'open' END, CASE WHEN close IS NULL THEN 'close' END, CASE WHEN volume IS NULL THEN 'volume' END], lambda x: x IS NOT NULL) AS errors
FROM dirty WHERE open IS NULL OR close IS NULL OR volume IS NULL""",
    ),
)
def required_fields(spark, sf):
    return ops.validate_required(dirty(spark, sf), "OHLCV").filter(F.size("errors") > 0).select("symbol", "timestamp", "errors")


def _profile_sql(c):
    return f"""SELECT '{c}' AS "column", avg({c}) AS mean, stddev_samp({c}) AS std, min({c}) AS min, max({c}) AS max, count(*) FILTER ({c} IS NULL) * 1.0 / count(*) AS missing_ratio,
  (SELECT count(*) FROM d, (SELECT avg({c}) AS m, stddev_pop({c}) AS s FROM d) WHERE abs({c} - m) > 3 * s) AS outliers_zscore,
  (SELECT count(*) FROM d, (SELECT quantile_cont({c}, 0.25) AS a, quantile_cont({c}, 0.75) AS b FROM d) WHERE {c} < a - 1.5 * (b - a) OR {c} > b + 1.5 * (b - a)) AS outliers_iqr FROM d"""


@query(
    "quality_profile",
    "F9",
    with_(
        MINUTE,
        DIRTY,
        "d AS (SELECT CAST(open AS DOUBLE) AS open, CAST(high AS DOUBLE) AS high, CAST(close AS DOUBLE) AS close, CAST(volume AS DOUBLE) AS volume FROM dirty)",
        "p AS (" + " UNION ALL ".join(_profile_sql(c) for c in ("open", "high", "close", "volume")) + ")",
        f'SELECT "column", {rs("mean", "std", "missing_ratio")}, min, max, outliers_zscore, outliers_iqr FROM p',
    ),
)
def quality_profile(spark, sf):
    return near(ops.profile(dirty(spark, sf), ["open", "high", "close", "volume"]), "mean", "std", "missing_ratio")


@query(
    "duplicate_rows",
    "F9",
    "SELECT CAST(sum(n - 1) AS BIGINT) AS duplicates FROM (SELECT count(*) AS n FROM documents GROUP BY text)",
)
def duplicate_rows(spark, sf):
    return ops.duplicate_rows(fx.table(spark, sf, "documents").select("text"))


@query(
    "price_rules",
    "F10",
    with_(
        HOURLY_SQL,
        """x AS (SELECT symbol, ts, close, close / lag(close) OVER w - 1 AS q FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY ts)),
y AS (SELECT *, CASE WHEN count(q) OVER v = 5 THEN stddev_samp(q) OVER v END AS s FROM x WINDOW v AS (PARTITION BY symbol ORDER BY ts ROWS 4 PRECEDING))""",
        f"""SELECT symbol, count(*) FILTER (close <= 0) AS non_positive, count(*) FILTER (abs(q) > 0.5) AS large_jumps,
  count(*) FILTER ((q > -0.55 AND q < -0.45) OR (q > 0.95 AND q < 1.05)) AS likely_splits, count(*) FILTER (abs(q) > 1) AS extreme_returns,
  {r('count(*) FILTER (q = 0) * 1.0 / count(q)')} AS zero_return_share, count(*) FILTER (s < 0.001) AS flat_windows FROM y GROUP BY symbol""",
    ),
)
def price_rules(spark, sf):
    return near(ops.price_rules(fx.hourly(spark, sf), HOURLY), "zero_return_share")


@query(
    "drop_incomplete",
    "F11,F14",
    with_(
        MINUTE,
        DIRTY,
        """SELECT symbol, "timestamp", 'any' AS rule FROM dirty WHERE open IS NOT NULL AND close IS NOT NULL AND volume IS NOT NULL
UNION ALL SELECT symbol, "timestamp", 'at least 6' FROM dirty WHERE (open IS NOT NULL)::INT + (close IS NOT NULL)::INT + (volume IS NOT NULL)::INT >= 2
UNION ALL SELECT symbol, "timestamp", 'labelled' FROM dirty WHERE close IS NOT NULL""",
    ),
)
def drop_incomplete(spark, sf):
    d = dirty(spark, sf)
    parts = {"any": d.na.drop(), "at least 6": d.na.drop(thresh=6), "labelled": d.na.drop(subset=["close"])}
    return reduce(DataFrame.unionByName, [p.select("symbol", "timestamp", F.lit(n).alias("rule")) for n, p in parts.items()])


@query(
    "remove_outliers",
    "F12",
    with_(
        HOURLY_SQL,
        """q AS (SELECT symbol, quantile_cont(close, 0.25) AS a, quantile_cont(close, 0.75) AS b, avg(close) AS m, stddev_samp(close) AS s FROM bars GROUP BY symbol)""",
        """SELECT x.symbol, ts, close, 'iqr' AS method FROM bars x JOIN q ON x.symbol = q.symbol WHERE close BETWEEN a - 1.5 * (b - a) AND b + 1.5 * (b - a)
UNION ALL SELECT x.symbol, ts, close, 'zscore' FROM bars x JOIN q ON x.symbol = q.symbol WHERE abs((close - m) / s) <= 2""",
    ),
)
def remove_outliers(spark, sf):
    b = fx.hourly(spark, sf).select("symbol", "ts", "close")
    iqr = ops.remove_outliers(b, ["symbol"], "close").withColumn("method", F.lit("iqr"))
    return iqr.unionByName(ops.remove_outliers(b, ["symbol"], "close", "zscore", 2.0).withColumn("method", F.lit("zscore")))


@query(
    "threshold_and_dates",
    "F13",
    with_(
        DAILY_SQL,
        "SELECT symbol, ts, close, 'ge' AS rule FROM bars WHERE close >= 1500 AND ts >= '1997-01-01' AND ts < '1998-07-01' UNION ALL SELECT symbol, ts, close, 'lt' FROM bars WHERE close < 1500 AND ts >= '1997-01-01' AND ts < '1998-07-01'",
    ),
)
def threshold_and_dates(spark, sf):
    b = ops.date_range(fx.daily(spark, sf).select("symbol", "ts", "close"), "ts", "1997-01-01", "1998-06-30")
    parts = [ops.threshold_filter(b, "close", o, 1500.0).withColumn("rule", F.lit(o)) for o in ("ge", "lt")]
    return parts[0].unionByName(parts[1])


@query(
    "replace_infinite",
    "F15",
    with_(
        HOURLY_SQL,
        "x AS (SELECT symbol, ts, close, volume, CASE WHEN open = close THEN CASE WHEN volume % 2 = 0 THEN 'inf'::DOUBLE ELSE '-inf'::DOUBLE END ELSE close / (close - open) END AS v FROM bars)",
        f"SELECT symbol, ts, CASE WHEN isinf(v) THEN NULL ELSE {r(log_sql('CASE WHEN isinf(v) THEN 0 ELSE v END'))} END AS nulled, {r(log_sql('CASE WHEN isinf(v) THEN sign(v) * 1000 ELSE v END'))} AS capped FROM x",
    ),
)
def replace_infinite(spark, sf):
    b = fx.hourly(spark, sf)
    inf = F.when(F.col("volume") % 2 == 0, float("inf")).otherwise(float("-inf"))
    v = F.when(F.col("open") == F.col("close"), inf).otherwise(F.try_divide("close", F.col("close") - F.col("open")))
    x = b.withColumns({"nulled": v, "capped": v})
    x = ops.replace_infinite(ops.replace_infinite(x, ["nulled"]), ["capped"], 1000.0)
    x = x.withColumns({c: log_scale(c) for c in ("nulled", "capped")})
    return near(x, "nulled", "capped").select("symbol", "ts", "nulled", "capped")


@query(
    "trading_sessions",
    "F16",
    """WITH e AS (SELECT event_id, ts, hour(ts) * 100 + minute(ts) AS c, isodow(ts) <= 5 AS wd FROM events)
SELECT event_id, CASE WHEN NOT wd THEN 'closed' WHEN c >= 1430 AND c < 2100 THEN 'regular' WHEN c >= 900 AND c < 1430 THEN 'pre_market' ELSE 'closed' END AS nyse,
  CASE WHEN NOT wd THEN 'closed' WHEN c >= 345 AND c < 1000 THEN 'regular' WHEN c >= 300 AND c < 345 THEN 'pre_market' ELSE 'closed' END AS nse,
  CASE WHEN NOT wd THEN 'closed' WHEN c >= 0 AND c < 600 THEN 'regular' ELSE 'closed' END AS tse,
  wd AND c >= 930 AND c <= 1600 AS in_hours FROM e""",
)
def trading_sessions(spark, sf):
    e = fx.table(spark, sf, "events")
    ts = F.col("ts").cast("timestamp")
    return e.select("event_id", *[ops.trading_session(ts, x).alias(x.lower()) for x in ("NYSE", "NSE", "TSE")], ops.market_minutes(ts).alias("in_hours"))


@query(
    "if_else_switch",
    "F17,F18",
    """SELECT event_id, CASE WHEN value > 50 THEN 'true' ELSE 'false' END AS by_value, CASE WHEN event_type <> '' THEN 'true' ELSE 'false' END AS by_truth,
  CASE WHEN event_type = 'view' THEN 0 WHEN event_type = 'click' THEN 1 ELSE 2 END AS route FROM events""",
)
def if_else_switch(spark, sf):
    return fx.table(spark, sf, "events").select(
        "event_id", ops.branch(F.col("value"), ">", 50).alias("by_value"), ops.branch(F.col("event_type")).alias("by_truth"),
        ops.route(F.col("event_type"), "view", "click").alias("route"),
    )


def deals(spark, sf):
    """Orders as deals."""
    c = fx.table(spark, sf, "customer")
    status = F.when(F.col("o_orderstatus") == "F", "Completed").when(F.col("o_orderstatus") == "O", "Pending").otherwise("Withdrawn")
    return fx.table(spark, sf, "orders").join(c, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("deal_id"),
        F.col("c_name").alias("target_name"),
        F.col("c_mktsegment").alias("industry"),
        F.col("o_totalprice").alias("deal_value"),
        status.alias("deal_status"),
        F.to_date("o_orderdate").alias("announcement_date"),
        F.col("o_orderpriority").alias("payment_method"),
        ((F.col("o_totalprice") * 100).cast("long") % 60).cast("double").alias("premium_1day"),
        ((F.col("o_totalprice") * 100).cast("long") % 90).cast("double").alias("premium_4week"),
    )


DEALS_SQL = """deals AS (SELECT o_orderkey AS deal_id, c_name AS target_name, c_mktsegment AS industry, o_totalprice AS deal_value,
  CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'Pending' ELSE 'Withdrawn' END AS deal_status, CAST(o_orderdate AS DATE) AS announcement_date, o_orderpriority AS payment_method,
  CAST(CAST(trunc(o_totalprice * 100) AS BIGINT) % 60 AS DOUBLE) AS premium_1day, CAST(CAST(trunc(o_totalprice * 100) AS BIGINT) % 90 AS DOUBLE) AS premium_4week
  FROM orders JOIN customer ON o_custkey = c_custkey)"""


@query(
    "search_deals",
    "F19",
    with_(
        DEALS_SQL,
        "SELECT deal_id, target_name, industry, deal_value, announcement_date FROM deals WHERE (target_name ILIKE '%00012%' OR industry ILIKE '%00012%') AND industry = 'MACHINERY' AND deal_value >= 50000 AND deal_value <= 400000 AND announcement_date >= '1996-01-01' ORDER BY announcement_date DESC",
    ),
)
def search_deals(spark, sf):
    out = ops.search(
        deals(spark, sf), "00012", ["target_name", "industry"], {"industry": "MACHINERY"},
        {"deal_value": 50000, "announcement_date": "1996-01-01"}, {"deal_value": 400000}, "announcement_date",
    )
    return out.select("deal_id", "target_name", "industry", "deal_value", "announcement_date")


@query(
    "search_instruments",
    "F20",
    """SELECT p_name || '-' || p_partkey AS symbol, p_brand AS exchange, CASE p_type WHEN 'ECONOMY' THEN 'EQ' WHEN 'SMALL' THEN 'INDEX' WHEN 'LARGE' THEN 'FUT' ELSE p_type END AS instrument_type
FROM part WHERE upper(p_name) LIKE '%RING%' ORDER BY CASE instrument_type WHEN 'EQ' THEN 0 WHEN 'INDEX' THEN 1 WHEN 'FUT' THEN 2 ELSE 3 END, symbol LIMIT 50""",
)
def search_instruments(spark, sf):
    kind = F.col("p_type")
    kind = F.when(kind == "ECONOMY", "EQ").when(kind == "SMALL", "INDEX").when(kind == "LARGE", "FUT").otherwise(kind)
    p = fx.table(spark, sf, "part").select(
        F.concat_ws("-", "p_name", "p_partkey").alias("symbol"), F.col("p_type").alias("brsymbol"), F.col("p_name").alias("name"),
        F.col("p_brand").alias("exchange"), kind.alias("instrument_type"),
    )
    return ops.search_instruments(p, "ring", limit=50).select("symbol", "exchange", "instrument_type")


def companies(spark, sf):
    """Suppliers as companies: market cap from shipped value, balance as equity and income."""
    l = fx.table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.sum(F.col("l_extendedprice")).alias("revenue"), F.sum("l_quantity").alias("volume"))
    n, rg = fx.table(spark, sf, "nation"), fx.table(spark, sf, "region")
    dims = n.join(rg, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", F.col("n_name").alias("country"), F.col("r_name").alias("sector"))
    s = fx.table(spark, sf, "supplier")
    return s.join(l, F.col("s_suppkey") == F.col("l_suppkey")).join(dims, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("symbol"), "country", "sector", F.col("revenue").alias("market_cap"), "volume",
        (F.col("revenue") / 100).alias("book_value"), F.col("s_acctbal").alias("net_income"),
    )


COMPANIES_SQL = """companies AS (SELECT s_suppkey AS symbol, n_name AS country, r_name AS sector, revenue AS market_cap, volume, revenue / 100 AS book_value, s_acctbal AS net_income
  FROM supplier JOIN (SELECT l_suppkey, sum(l_extendedprice) AS revenue, sum(l_quantity) AS volume FROM lineitem GROUP BY l_suppkey) ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


@query(
    "stock_screener",
    "F21",
    with_(COMPANIES_SQL, "SELECT symbol, country, sector FROM companies WHERE market_cap >= 5000000 AND volume BETWEEN 10000 AND 20000 AND net_income >= 0 AND sector = 'ASIA' ORDER BY market_cap DESC LIMIT 30"),
)
def stock_screener(spark, sf):
    limits = {"market_cap": (5_000_000, None), "volume": (10_000, 20_000), "net_income": (0, None)}
    return ops.screen(companies(spark, sf), limits, {"sector": "ASIA"}, "market_cap", 30).select("symbol", "country", "sector")


@query(
    "screen_comparables",
    "F21",
    with_(
        COMPANIES_SQL,
        """SELECT p.symbol, t.symbol AS target FROM companies p JOIN companies t ON p.sector = t.sector WHERE greatest(p.market_cap, t.market_cap) / least(p.market_cap, t.market_cap) <= 1.2
  AND p.net_income / p.book_value >= 0.01""",
    ),
)
def screen_comparables(spark, sf):
    c = companies(spark, sf)
    return ops.screen_comparables(c, c, 1.2, 0.01).select("symbol", "target")


@query(
    "missing_share",
    "F22",
    with_(
        MINUTE,
        DIRTY,
        "SELECT round((count(*) FILTER (open IS NULL) + count(*) FILTER (close IS NULL) + count(*) FILTER (volume IS NULL)) * 100.0 / (count(*) * 7), 2)::DOUBLE AS missing_pct FROM dirty",
    ),
)
def missing_share(spark, sf):
    return ops.missing_share(dirty(spark, sf))
