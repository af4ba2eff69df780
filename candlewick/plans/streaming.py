"""Streaming operators. ``*_stream`` queries run the stream over files of the table until nothing is left and return what it
wrote; the others are the batch results, with which the tests compare streams in many small batches."""

from pyspark.sql import functions as F

from candlewick import fixtures as fx
from candlewick.operators import indicators
from candlewick.operators.series import HOURLY, TICK
from candlewick.plans.indicators import BASE, E, W, _recursive, avg, hi, lo, recursive, roll, wn
from candlewick.plans.registry import near, query, r, rs
from candlewick.plans.sources import _BAR, _folder, BAR as SILVER, doubles
from candlewick.plans.sql import HOURLY as HOURLY_SQL
from candlewick.plans.sql import MINUTE as MINUTE_SQL
from candlewick.plans.sql import NUMBERED, TICKS, with_
from candlewick.sources import files
from candlewick.streaming import consolidators as con
from candlewick.streaming import jobs, live

BAR = ("open", "high", "low", "close", "volume")


def bars(spark, sf):
    return fx.hourly(spark, sf)


@query(
    "streamed_bars",
    "T1,T3",
    with_(TICKS, "SELECT symbol, time_bucket(INTERVAL 4 HOUR, t.ts) AS ts, arg_min(price, t.ts) AS open, max(price) AS high, min(price) AS low, arg_max(price, t.ts) AS close, sum(size)::BIGINT AS volume FROM ticks t GROUP BY symbol, time_bucket(INTERVAL 4 HOUR, t.ts)"),
)
def streamed_bars(spark, sf):
    return jobs.windowed_bars(fx.ticks(spark, sf), "4 hours", "10 minutes")


def _merge(closes: str, quote: bool = False) -> str:
    first = "ts AS s, ts AS e, open AS o, high AS h, low AS l, close AS c, volume::DOUBLE AS v, 1 AS m, {0} AS done"
    keep = {"o": ("n.open", "p.o"), "h": ("n.high", "p.h" if quote else "greatest(p.h, n.high)"), "l": ("n.low", "p.l" if quote else "least(p.l, n.low)"), "c": ("n.close", "n.close"), "v": ("n.volume::DOUBLE", "p.v" if quote else "p.v + n.volume"), "m": ("1", "p.m + 1")}
    new = {k: f"CASE WHEN p.done THEN {a} ELSE {b} END" for k, (a, b) in keep.items()}
    start = "CASE WHEN p.done THEN n.ts ELSE p.s END"
    done = closes.format(s=start, e="n.ts", **{k: f"({x})" for k, x in new.items()})
    step = f"{start}, n.ts, {', '.join(new.values())}, {done}"
    rec, _ = _recursive(first.format(closes.format(s="ts", e="ts", o="open", h="high", l="low", c="close", v="volume", m="1")), step, (), base="bars")
    return rec


_OUT = 'SELECT symbol, s AS "start", e AS "end", o AS open, h AS high, l AS low, c AS close, v AS volume FROM rec WHERE done'
SPAN = 5 * 3600


@query("time_bars", "T4", recursive(HOURLY_SQL, _merge("epoch({e}) - epoch({s}) >= 18000"), _OUT))
def time_bars(spark, sf):
    return con.consolidate(bars(spark, sf), HOURLY.by(span=86400 * 30), lambda k: con.time_step(k, SPAN))


@query(
    "count_bars",
    "T5",
    with_(TICKS, "n AS (SELECT *, (row_number() OVER (PARTITION BY symbol ORDER BY ts, seq) - 1) // 40 AS b FROM ticks)",
          'SELECT symbol, min(ts) AS "start", max(ts) AS "end", arg_min(price, {\'a\': ts, \'b\': seq}) AS open, max(price) AS high, min(price) AS low, arg_max(price, {\'a\': ts, \'b\': seq}) AS close, sum(size)::DOUBLE AS volume FROM n GROUP BY symbol, b HAVING count(*) = 40'),
)
def count_bars(spark, sf):
    return con.count_bars(con.prices(fx.ticks(spark, sf), "price", "size"), TICK, 40)


@query("range_bars", "T6", recursive(HOURLY_SQL.replace("max(price) AS high, min(price) AS low", "arg_max(price, ts) AS high, arg_max(price, ts) AS low").replace("arg_min(price, ts) AS open", "arg_max(price, ts) AS open"), _merge("({m} > 1 AND {h} - {l} >= 40)"), _OUT))
def range_bars(spark, sf):
    return con.consolidate(con.prices(bars(spark, sf), "close", "volume"), HOURLY.by(span=86400 * 30), lambda k: con.range_step(k, 40.0))


_BRICK = """x AS (SELECT *, (close - first_value(close) OVER (PARTITION BY symbol ORDER BY ts)) / 5 AS brick FROM bars)"""
_BRICKS, _ = _recursive("0.0::DOUBLE AS edge, 0::INT AS n_bricks, 1.0::DOUBLE AS side, volume AS v", "p.edge + CASE WHEN n.brick > p.edge THEN 1 ELSE -1 END * floor(abs(n.brick - p.edge) + 1e-9), floor(abs(n.brick - p.edge) + 1e-9)::INT, CASE WHEN n.brick > p.edge THEN 1.0 ELSE -1.0 END, n.volume", (), base="x")


@query(
    "renko_bricks",
    "T7",
    recursive(
        HOURLY_SQL, _BRICK, _BRICKS,
        "b AS (SELECT symbol, ts, edge, side, n_bricks, v, unnest(range(n_bricks)) AS i FROM rec WHERE n_bricks > 0), f AS (SELECT symbol, arg_min(close, ts) AS p0 FROM bars GROUP BY symbol)",
        f"""SELECT symbol, ts AS "start", {r('p0 + 5 * (edge - side * (n_bricks - i))', 4)} AS open, {r('p0 + 5 * (edge - side * (n_bricks - i - 1))', 4)} AS close, v::DOUBLE AS volume FROM b JOIN f USING (symbol)""",
    ),
)
def renko_bricks(spark, sf):
    out = con.renko(bars(spark, sf), HOURLY.by(span=86400 * 30), "close", 5.0)
    return near(out.select("symbol", "start", "open", "close", "volume"), "open", "close", digits=4)


@query("quote_bars", "T8", recursive(HOURLY_SQL, _merge("epoch({e}) - epoch({s}) >= 18000", quote=True), _OUT))
def quote_bars(spark, sf):
    return con.consolidate(bars(spark, sf), HOURLY.by(span=86400 * 30), lambda k: con.quote_step(k, SPAN))


LIVE = {"sma": ("sma", {"period": 20}), "momentum": ("momentum", {"period": 10}), "roc": ("roc", {"period": 12})}


@query(
    "live_indicators",
    "T9",
    with_(
        HOURLY_SQL,
        f"i AS (SELECT symbol, ts, {roll('avg', 'close', 20)} AS sma, (close / lag(close, 10) OVER w - 1) * 100 AS momentum, (close / lag(close, 12) OVER w - 1) * 100 AS roc FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY ts))",
        f"SELECT symbol, ts, {rs('sma', 'momentum', 'roc')}, sma IS NOT NULL AND momentum IS NOT NULL AND roc IS NOT NULL AS ready FROM i",
    ),
)
def live_indicators(spark, sf):
    out = indicators.compute(bars(spark, sf), LIVE)
    ready = F.col("sma").isNotNull() & F.col("momentum").isNotNull() & F.col("roc").isNotNull()
    return near(out.select("symbol", "ts", "sma", "momentum", "roc", ready.alias("ready")), "sma", "momentum", "roc")


ALERT = [{"indicator": "price_close", "operator": ">", "compare_indicator": "sma", "compare_params": {"period": 20}}, "AND", {"indicator": "hl2", "operator": ">=", "value": 5}]


@query(
    "live_alerts",
    "T10",
    with_(
        HOURLY_SQL,
        f"i AS (SELECT *, {roll('avg', 'close', 20)} AS sma FROM bars), m AS (SELECT *, coalesce(close > sma, false) AND (high + low) / 2 >= 5 AS met FROM i)",
        "SELECT symbol, ts, close FROM (SELECT *, lag(met, 1, false) OVER (PARTITION BY symbol ORDER BY ts) AS was FROM m) WHERE met AND NOT was",
    ),
)
def live_alerts(spark, sf):
    return jobs.alerts(bars(spark, sf), ALERT).select("symbol", "ts", "close")


@query(
    "hourly_counts",
    "T11",
    "SELECT event_type AS category, date_trunc('hour', ts) AS hour, count(*) AS n FROM events GROUP BY 1, 2",
)
def hourly_counts(spark, sf):
    return jobs.hourly_counts(events(spark, sf), "category", "ts", "10 minutes")


def events(spark, sf):
    return fx.table(spark, sf, "events").select(F.col("event_type").alias("category"), F.col("ts").cast("timestamp").alias("ts"), "value", "event_id")


@query(
    "velocity_by_hour",
    "T12",
    """WITH h AS (SELECT event_type AS category, date_trunc('hour', ts) AS hour, count(*) AS n FROM events GROUP BY 1, 2)
SELECT a.category, a.hour, a.n, round(a.n / greatest(coalesce(b.n, 0), 1), 1)::DOUBLE AS ratio, CASE WHEN a.n / greatest(coalesce(b.n, 0), 1) >= 5 THEN 'high' ELSE 'medium' END AS severity
FROM h a LEFT JOIN h b ON a.category = b.category AND b.hour = a.hour - INTERVAL 1 HOUR WHERE a.n >= 5 AND a.n / greatest(coalesce(b.n, 0), 1) >= 3""",
)
def velocity_by_hour(spark, sf):
    return jobs.velocity(jobs.hourly_counts(events(spark, sf), "category", "ts", "10 minutes"), "category")


@query(
    "sliding_velocity",
    "T12",
    """WITH w AS (SELECT event_type AS category, time_bucket(INTERVAL 10 MINUTE, ts) - to_minutes(10 * i) AS start FROM events, (SELECT unnest(range(6))::INT AS i))
SELECT category, start, count(*) AS n FROM w GROUP BY ALL""",
)
def sliding_velocity(spark, sf):
    return jobs.sliding_counts(events(spark, sf), "category", "ts", "10 minutes")


@query(
    "latest_per_topic",
    "T13",
    """SELECT event_type AS topic, time_bucket(INTERVAL 5 MINUTE, e.ts) AS "interval", max(e.ts) AS ts, arg_max(value, e.ts) AS value FROM events e GROUP BY event_type, time_bucket(INTERVAL 5 MINUTE, e.ts)""",
)
def latest_per_topic(spark, sf):
    return jobs.latest_per_topic(events(spark, sf).withColumnRenamed("category", "topic"), "topic", "ts", "value", "5 minutes")


# --- streams over the files of a table --------------------------------------------------------------------------------


def table_stream(spark, sf, name):
    """The files of a table as a stream, whether the table is one file or a folder of files."""
    return spark.readStream.schema(fx.table(spark, sf, name).schema).parquet(f"{sf.rstrip('/')}/{name}.parquet*")


def in_batches(df, ts, parts, folder):
    """The rows cut by time into ``parts`` writes, so that a stream of one file per batch gets them in order."""
    span = df.agg(F.min(ts).cast("long").alias("lo"), (F.max(ts).cast("long") + 1).alias("hi")).first()
    at = F.floor((F.col(ts).cast("long") - span.lo) * parts / (span.hi - span.lo))
    for i in range(parts):
        df.filter(at == i).coalesce(1).write.mode("append").parquet(folder)
    return df.sparkSession.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(folder)


@query("ingest_stream", "T1", with_(MINUTE_SQL, f"SELECT {_BAR} FROM minute"))
def ingest_stream(spark, sf):
    """Rows of the table as topic records, parsed and appended by the ingest job; records without a key are rejected."""
    bars = fx.minute_of(table_stream(spark, sf, "events")).select(*SILVER)
    broken = table_stream(spark, sf, "nation").select(F.lit("not json").alias("value"))
    target = _folder(spark, "ingest")
    jobs.ingest(files.to_messages(bars).unionByName(broken), f"{target}/rows", f"{target}/rejects", f"{target}/state", once=True).awaitTermination()
    return doubles(spark.read.parquet(f"{target}/rows").select(*SILVER))


@query("rejects_stream", "T1", "SELECT 'not json' AS value, n_nationkey AS key FROM nation")
def rejects_stream(spark, sf):
    """What the ingest job rejects: here records that are no JSON at all."""
    broken = table_stream(spark, sf, "nation").select(F.concat(F.lit("not json "), F.col("n_nationkey")).alias("value"))
    target = _folder(spark, "rejects")
    jobs.ingest(broken, f"{target}/rows", f"{target}/rejects", f"{target}/state", once=True).awaitTermination()
    found = spark.read.parquet(f"{target}/rejects").select(F.split("value", " ").alias("v"))
    return found.select(F.concat_ws(" ", F.slice("v", 1, 2)).alias("value"), F.col("v")[2].cast("bigint").alias("key"))


@query(
    "upsert_stream", "T2",
    "SELECT user_id, event_type, max(event_id) AS event_id, arg_max(value, event_id) AS value FROM events GROUP BY user_id, event_type",
)
def upsert_stream(spark, sf):
    rows = table_stream(spark, sf, "events").select("user_id", "event_type", "event_id", "value")
    folder, keys = _folder(spark, "upsert"), ["user_id", "event_type"]
    jobs.upsert_stream(rows, f"{folder}/rows", f"{folder}/state", keys, ["event_id"], once=True).awaitTermination()
    jobs.compact(spark, f"{folder}/rows", f"{folder}/compact", keys, ["event_id"])
    return jobs.current(spark, f"{folder}/compact", keys, ["event_id"])


STREAMED = {
    **LIVE, "ema": ("ema", {"period": 4}), "rsi": ("rsi", {"period": 5}), "macd": ("macd", {"fast": 3, "slow": 6, "signal": 3}), "bands": ("bollinger", {"period": 5}),
    "atr": ("atr", {"period": 4}), "stoch": ("stochastic", {}), "williams": ("williams_r", {}), "cci": ("cci", {}), "adx": ("adx", {"period": 4}),
}


def _streamed(spark, sf):
    folder = _folder(spark, "indicators")
    live.rocksdb(spark)
    stream = in_batches(bars(spark, sf), "ts", 3, f"{folder}/in")
    live.write_stream(live.live_indicators(stream, STREAMED), f"{folder}/rows", f"{folder}/state", once=True).awaitTermination()
    return spark.read.parquet(f"{folder}/rows")


_SHOWN = {
    "sma": avg("close", 20), "momentum": f"(close / lag(close, 10) OVER ({W}) - 1) * 100", "roc": f"(close / lag(close, 12) OVER ({W}) - 1) * 100", "ema": E("close", 4),
    "rsi": f"100 - 100 / (1 + ({avg('up', 5)}) / nullif({avg('dn', 5)}, 0))", "macd_line": "line", "macd_signal": "sig", "macd_histogram": "line - sig",
    "bands_upper": "bm + 2 * bs", "bands_middle": "bm", "bands_lower": "bm - 2 * bs", "bands_bandwidth": "4 * bs / nullif(bm, 0) * 100", "bands_percent_b": "(close - bm + 2 * bs) / nullif(4 * bs, 0)",
    "atr": avg("tr", 4), "stoch_k": "k", "stoch_d": avg("k", 3), "williams": "-100 * (h14 - close) / nullif(h14 - l14, 0)", "cci": "CASE WHEN rn >= 20 THEN (tp - tm) / (0.015 * nullif(mad, 0)) END",
    "adx_adx": E("dx", 4), "adx_plus_di": "pd", "adx_minus_di": "md",
}
_STREAM_SQL = [
    HOURLY_SQL, NUMBERED, BASE,
    "s0 AS (SELECT *, greatest(coalesce(d, 0), 0) AS up, greatest(-coalesce(d, 0), 0) AS dn, high - ph AS u, pl - low AS v FROM b)",
    f"""s1 AS (SELECT *, {E('close', 3)} - {E('close', 6)} AS line, {avg('close', 5)} AS bm, {roll('stddev_samp', 'close', 5)} AS bs, {lo('low', 14)} AS l14, {hi('high', 14)} AS h14,
       CASE WHEN u > v AND u > 0 THEN u ELSE 0 END AS p, CASE WHEN v > u AND v > 0 THEN v ELSE 0 END AS m, list(tp) OVER {wn(20)} AS tps, {avg('tp', 20)} AS tm FROM s0)""",
    f"s2 AS (SELECT *, {E('line', 3)} AS sig, (close - l14) / nullif(h14 - l14, 0) * 100 AS k, {E('tr', 4)} AS a_t, {E('p', 4)} AS ap, {E('m', 4)} AS am, list_avg(list_transform(tps, lambda x: abs(x - list_avg(tps)))) AS mad FROM s1)",
    "s3 AS (SELECT *, 100 * ap / nullif(a_t, 0) AS pd, 100 * am / nullif(a_t, 0) AS md FROM s2)",
    "s4 AS (SELECT *, abs(pd - md) / nullif(pd + md, 0) * 100 AS dx FROM s3)",
    f"i AS (SELECT symbol, ts, {', '.join(f'{e} AS {n}' for n, e in _SHOWN.items())} FROM s4)",
    f"o AS (SELECT *, {' AND '.join(f'{n} IS NOT NULL' for n in _SHOWN)} AS ready FROM i)",
]


@query("indicator_stream", "T9", with_(*_STREAM_SQL, f"SELECT symbol, ts, {rs(*_SHOWN)}, ready FROM o"))
def indicator_stream(spark, sf):
    """Twelve indicators of a stream in three micro-batches, from the state of each symbol."""
    return near(_streamed(spark, sf).select("symbol", "ts", *_SHOWN, "ready"), *_SHOWN)


@query("indicator_stream_gaps", "T9", with_(*_STREAM_SQL, "SELECT symbol, count(*) AS bars, count(*) FILTER (ready) AS ready_bars, 0::BIGINT AS rows_that_differ FROM o GROUP BY symbol"))
def indicator_stream_gaps(spark, sf):
    """Bars of each symbol that the stream wrote, and those on which any of the twelve indicators differs from its batch value."""
    batch = indicators.compute(bars(spark, sf), STREAMED)
    names = [c for c in batch.columns if c not in ("symbol", "ts", *BAR, "_pos")]
    other = _streamed(spark, sf).select("symbol", "ts", "ready", *[F.col(c).alias(f"_{c}") for c in names])
    same = F.lit(True)
    for c in names:
        a, b = F.col(c).cast("double"), F.col(f"_{c}").cast("double")
        same = same & (a.eqNullSafe(b) | F.coalesce(F.abs(a - b) <= 1e-9 * (1 + F.abs(a)), F.lit(False)))
    joined = batch.select("symbol", "ts", F.lit(True).alias("_in"), *names).join(other, ["symbol", "ts"], "full")
    return joined.groupBy("symbol").agg(
        F.count("ready").alias("bars"), F.count_if("ready").alias("ready_bars"), F.count_if(~F.coalesce(same & F.col("_in").isNotNull(), F.lit(False))).alias("rows_that_differ"),
    )


@query(
    "alert_stream",
    "T10",
    with_(
        HOURLY_SQL,
        f"i AS (SELECT *, {roll('avg', 'close', 20)} AS sma FROM bars), m AS (SELECT *, coalesce(close > sma, false) AND (high + low) / 2 >= 5 AS met FROM i)",
        "SELECT symbol, ts, close FROM (SELECT *, lag(met, 1, false) OVER (PARTITION BY symbol ORDER BY ts) AS was FROM m) WHERE met AND NOT was",
    ),
)
def alert_stream(spark, sf):
    folder = _folder(spark, "alerts")
    live.rocksdb(spark)
    stream = in_batches(bars(spark, sf), "ts", 3, f"{folder}/in")
    live.write_stream(live.live_alerts(stream, ALERT), f"{folder}/rows", f"{folder}/state", once=True).awaitTermination()
    return spark.read.parquet(f"{folder}/rows").select("symbol", "ts", "close")


CROSS = [
    {"indicator": "ema", "params": {"period": 4}, "operator": "crosses_above", "compare_indicator": "sma", "compare_params": {"period": 10}}, "OR",
    {"indicator": "rsi", "params": {"period": 5}, "operator": "crossed_below_within", "value": 30, "lookback": 3}, "OR",
    {"indicator": "price_close", "operator": "rising", "lookback": 4},
]


@query(
    "cross_alert_stream",
    "T10,G2",
    with_(
        HOURLY_SQL, NUMBERED, BASE,
        f"i AS (SELECT *, {E('close', 4)} AS e, {avg('close', 10)} AS s, greatest(coalesce(d, 0), 0) AS up, greatest(-coalesce(d, 0), 0) AS dn FROM b)",
        f"j AS (SELECT *, 100 - 100 / (1 + ({avg('up', 5)}) / nullif({avg('dn', 5)}, 0)) AS rsi FROM i)",
        f"k AS (SELECT *, coalesce(lag(e) OVER ({W}) <= lag(s) OVER ({W}) AND e > s, false) AS c1, coalesce(lag(rsi) OVER ({W}) >= 30 AND rsi < 30, false) AS fell, coalesce(d > 0, false) AS rose FROM j)",
        f"m AS (SELECT *, c1 OR bool_or(fell) OVER {wn(3)} OR (rn >= 2 AND bool_and(CASE WHEN rn > 1 THEN rose END) OVER {wn(3)}) AS met FROM k)",
        f"SELECT symbol, ts, close FROM (SELECT *, lag(met, 1, false) OVER ({W}) AS was FROM m) WHERE met AND NOT was",
    ),
)
def cross_alert_stream(spark, sf):
    """Crossings, a crossing within three bars and rising prices, joined by OR, over four micro-batches."""
    folder = _folder(spark, "crosses")
    live.rocksdb(spark)
    stream = in_batches(bars(spark, sf), "ts", 4, f"{folder}/in")
    live.write_stream(live.live_alerts(stream, CROSS), f"{folder}/rows", f"{folder}/state", once=True).awaitTermination()
    return spark.read.parquet(f"{folder}/rows").select("symbol", "ts", "close")
