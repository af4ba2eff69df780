"""Roll-ups, latest prices, resampling."""

from pyspark.sql import functions as F

from candlewick import fixtures as fx
from candlewick.operators import bars as ops
from candlewick.operators import quality
from candlewick.plans.registry import near, query, r
from candlewick.plans.sql import DAILY, HOURLY, MINUTE, TICKS, TRADES, with_

CLEAN = """clean AS (SELECT * FROM minute WHERE open > 0 AND high > 0 AND low > 0 AND close > 0 AND high >= low
  AND high >= open AND high >= close AND low <= open AND low <= close)"""


@query(
    "daily_ohlcv",
    "A2",
    with_(
        MINUTE,
        CLEAN,
        f'''SELECT symbol, CAST("timestamp" AS DATE) AS date,
  CAST(arg_min(open, "timestamp") AS DOUBLE) AS open, CAST(max(high) AS DOUBLE) AS high, CAST(min(low) AS DOUBLE) AS low,
  CAST(arg_max(close, "timestamp") AS DOUBLE) AS close, CAST(sum(volume) AS BIGINT) AS volume,
  {r("CAST(sum(close) AS DOUBLE) / count(*)")} AS avg_price,
  {r("""CASE WHEN sum(volume) > 0 THEN CAST(sum(CAST(close * volume AS DECIMAL(38,4))) AS DOUBLE) / sum(volume) ELSE avg(close) END""")} AS vwap
FROM clean GROUP BY symbol, CAST("timestamp" AS DATE)''',
    ),
)
def daily_ohlcv(spark, sf):
    out = ops.daily_ohlcv(quality.valid_ohlc(fx.minute_like(spark, sf)))
    return _plain(out, ["open", "high", "low", "close"], ["avg_price", "vwap"])


def _plain(df, prices, rounded=()):
    df = df.withColumns({c: F.col(c).cast("double") for c in prices})
    return near(df.withColumns({c: F.col(c).cast("double") for c in rounded}), *rounded)


@query(
    "hourly_ohlcv",
    "A1",
    with_(
        MINUTE,
        CLEAN,
        f'''SELECT symbol, time_bucket(INTERVAL 1 HOUR, "timestamp") AS "timestamp",
  CAST(arg_min(open, "timestamp") AS DOUBLE) AS open, CAST(max(high) AS DOUBLE) AS high, CAST(min(low) AS DOUBLE) AS low,
  CAST(arg_max(close, "timestamp") AS DOUBLE) AS close, CAST(sum(volume) AS BIGINT) AS volume,
  {r("CAST(sum(close) AS DOUBLE) / count(*)")} AS avg_price
FROM clean c GROUP BY symbol, time_bucket(INTERVAL 1 HOUR, c."timestamp")''',
    ),
)
def hourly_ohlcv(spark, sf):
    out = ops.hourly_ohlcv(quality.valid_ohlc(fx.minute_like(spark, sf)))
    return _plain(out, ["open", "high", "low", "close"], ["avg_price"])


@query(
    "gold_daily_summary",
    "A3,K1",
    with_(
        MINUTE,
        """SELECT symbol, CAST("timestamp" AS DATE) AS date,
  CAST(arg_min(open, "timestamp") AS DOUBLE) AS open, CAST(max(high) AS DOUBLE) AS high, CAST(min(low) AS DOUBLE) AS low,
  CAST(arg_max(close, "timestamp") AS DOUBLE) AS close, CAST(sum(volume) AS BIGINT) AS volume
FROM minute GROUP BY symbol, CAST("timestamp" AS DATE) ORDER BY symbol, date""",
    ),
)
def gold_daily_summary(spark, sf):
    return _plain(ops.daily_summary(fx.minute_like(spark, sf)), ["open", "high", "low", "close"])


@query("rows_per_symbol", "A4", with_(MINUTE, "SELECT symbol, count(*) AS count FROM minute GROUP BY symbol"))
def rows_per_symbol(spark, sf):
    return ops.rows_per_symbol(fx.minute_like(spark, sf))


@query(
    "latest_prices",
    "K2",
    with_(
        MINUTE,
        """SELECT symbol, max("timestamp") AS "timestamp", CAST(arg_max(close, "timestamp") AS DOUBLE) AS close,
  arg_max(volume, "timestamp") AS volume FROM minute GROUP BY symbol""",
    ),
)
def latest_prices(spark, sf):
    return _plain(ops.latest_prices(fx.minute_like(spark, sf)), ["close"])


def _resample_sql(expr):
    return with_(
        HOURLY,
        f"""SELECT symbol, {expr} AS ts, arg_min(open, b.ts) AS open, max(high) AS high, min(low) AS low,
  arg_max(close, b.ts) AS close, CAST(sum(volume) AS BIGINT) AS volume FROM bars b GROUP BY symbol, {expr}""",
    )


for _name, _width, _expr in [
    ("resample_4h", "4 hours", "time_bucket(INTERVAL 4 HOUR, b.ts, TIMESTAMP '1970-01-01')"),
    ("resample_day", "1 day", "date_trunc('day', b.ts)"),
    ("resample_week", "1 week", "date_trunc('week', b.ts)"),
    ("resample_month", "1 month", "date_trunc('month', b.ts)"),
]:
    query(_name, "A5", _resample_sql(_expr))(
        lambda spark, sf, width=_width: ops.resample(fx.hourly(spark, sf), width)
    )


@query(
    "resample_15min_ticks",
    "A5",
    with_(
        TICKS,
        """SELECT symbol, time_bucket(INTERVAL 15 MINUTE, t.ts) AS ts, arg_min(price, t.ts) AS open, max(price) AS high, min(price) AS low,
  arg_max(price, t.ts) AS close, CAST(sum(size) AS BIGINT) AS volume FROM ticks t GROUP BY symbol, time_bucket(INTERVAL 15 MINUTE, t.ts)""",
    ),
)
def resample_15min_ticks(spark, sf):
    return ops.bars_from_ticks(fx.ticks(spark, sf), "15 minutes")


@query(
    "resample_year_quarter_daily",
    "A5",
    with_(
        DAILY,
        """SELECT symbol, 'quarter' AS unit, date_trunc('quarter', b.ts) AS ts, arg_min(open, b.ts) AS open, max(high) AS high, min(low) AS low,
  arg_max(close, b.ts) AS close, CAST(sum(volume) AS BIGINT) AS volume FROM bars b GROUP BY symbol, date_trunc('quarter', b.ts)
UNION ALL SELECT symbol, 'year', date_trunc('year', b.ts), arg_min(open, b.ts), max(high), min(low),
  arg_max(close, b.ts), CAST(sum(volume) AS BIGINT) FROM bars b GROUP BY symbol, date_trunc('year', b.ts)""",
    ),
)
def resample_year_quarter_daily(spark, sf):
    d = fx.daily(spark, sf)
    parts = [ops.resample(d, f"1 {u}").withColumn("unit", F.lit(u)) for u in ("quarter", "year")]
    return parts[0].unionByName(parts[1])


@query(
    "resample_panel_methods",
    "A6",
    with_(
        TICKS,
        f"""SELECT symbol AS entity_id, time_bucket(INTERVAL 1 DAY, ts) AS "time", {r("sum(price)")} AS "sum", {r("avg(price)")} AS mean,
  arg_min(price, t.ts) AS first, arg_max(price, t.ts) AS last, min(price) AS min, max(price) AS max
FROM ticks t GROUP BY symbol, time_bucket(INTERVAL 1 DAY, t.ts)""",
    ),
)
def resample_panel_methods(spark, sf):
    panel = fx.ticks(spark, sf).select(F.col("symbol").alias("entity_id"), F.col("ts").alias("time"), F.col("price").alias("value"))
    out = panel.groupBy("entity_id", ops.bucket(F.col("time"), "1 day").alias("_bar")).agg(
        *[fn("value", "time").alias(m) for m, fn in ops.METHODS.items()]
    )
    return near(out.withColumnRenamed("_bar", "time"), "sum", "mean")


@query(
    "infer_frequency",
    "A7",
    with_(
        TICKS,
        """gaps AS (SELECT symbol, (epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY symbol ORDER BY ts)) / 1e6 AS gap FROM ticks),
m AS (SELECT symbol, quantile_cont(gap, 0.5) AS g FROM gaps WHERE gap IS NOT NULL GROUP BY symbol)""",
        f"""SELECT symbol, {r("g", 3)} AS median_gap, CASE WHEN g <= 60 THEN '1Min' WHEN g <= 300 THEN '5Min' WHEN g <= 900 THEN '15Min' WHEN g <= 1800 THEN '30Min'
  WHEN g <= 3600 THEN '1H' WHEN g <= 14400 THEN '4H' WHEN g <= 86400 THEN '1D' WHEN g <= 604800 THEN '1W' ELSE '1M' END AS frequency FROM m""",
    ),
)
def infer_frequency(spark, sf):
    return near(ops.infer_frequency(fx.ticks(spark, sf)), "median_gap", digits=3)
