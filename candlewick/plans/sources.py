"""Source and table queries over data derived from the given tables."""

from pyspark.sql import functions as F

from candlewick import fixtures as fx
from candlewick.operators import bars
from candlewick.plans.registry import near, query, r
from candlewick.plans.risk import _gauss_sql
from candlewick.plans.signals import _u
from candlewick.plans.sql import MINUTE, with_
from candlewick.sources import files, replay, synthetic, tables

_BAR = "symbol, \"timestamp\", open::DOUBLE AS open, high::DOUBLE AS high, low::DOUBLE AS low, close::DOUBLE AS close, volume, adjusted_close::DOUBLE AS adjusted_close"
BAR = ("symbol", "timestamp", "open", "high", "low", "close", "volume", "adjusted_close")


def doubles(df):
    return df.withColumns({c: F.col(c).cast("double") for c in ("open", "high", "low", "close", "adjusted_close")})


@query("minute_csv", "S1,S18", with_(MINUTE, f"SELECT {_BAR} FROM minute"))
def minute_csv(spark, sf):
    m = fx.minute_like(spark, sf)
    text = m.select(F.concat_ws("\n", F.lit(",".join(BAR)), F.to_csv(F.struct(*BAR), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})).alias("text"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in files.MINUTE.fields)
    return doubles(files.parse_csv_text(text, "text", schema, header=True).drop("line_no"))


@query("minute_messages", "S2,S9", with_(MINUTE, f"SELECT {_BAR} FROM minute"))
def minute_messages(spark, sf):
    sent = files.to_messages(fx.minute_like(spark, sf).select(*BAR), "symbol").select(F.encode("value", "UTF-8").alias("value"))
    return doubles(files.from_messages(sent))


@query(
    "keep_last_upsert",
    "S3,S4,T2",
    """WITH k AS (SELECT user_id, event_type, event_id, value, event_id % 2 AS half FROM events),
n AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY user_id, event_type, half ORDER BY event_id DESC) = 1)
SELECT user_id, event_type, value FROM n QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY half DESC) = 1""",
)
def keep_last_upsert(spark, sf):
    e = fx.table(spark, sf, "events").select("user_id", "event_type", "event_id", "value")
    keys = ["user_id", "event_type"]
    silver = tables.keep_last(e.filter("event_id % 2 = 0"), keys, ["event_id"])
    return tables.upsert(silver, e.filter("event_id % 2 = 1"), keys, ["event_id"]).drop("event_id")


@query(
    "envelope_rows",
    "S10",
    """SELECT event_id AS line, event_type AS symbol, value AS price FROM events WHERE event_id % 4 <> 3
UNION ALL SELECT event_id, 'user-' || user_id, value + 1 FROM events WHERE event_id % 4 = 1""",
)
def envelope_rows(spark, sf):
    e = fx.table(spark, sf, "events")
    one = F.struct(F.col("event_type").alias("symbol"), F.col("value").alias("price"))
    two = F.struct(F.concat(F.lit("user-"), "user_id").alias("symbol"), (F.col("value") + 1).alias("price"))
    wrapped = F.to_json(F.struct(F.lit(True).alias("success"), F.struct(F.lit("table").alias("type"), F.array(one, two).alias("rows")).alias("data")))
    line = F.when(F.col("event_id") % 4 == 1, wrapped).when(F.col("event_id") % 4 == 3, "Traceback: not JSON").otherwise(F.to_json(one))
    rows, _ = files.parse_envelopes(e.select(F.col("event_id").alias("line"), line.alias("value")), "value", "symbol string, price double")
    return rows


@query(
    "rejected_lines",
    "S10",
    "SELECT event_id AS line, 'Traceback: ' || event_type AS value FROM events WHERE event_id % 4 = 3",
)
def rejected_lines(spark, sf):
    e = fx.table(spark, sf, "events")
    line = F.when(F.col("event_id") % 4 == 3, F.concat(F.lit("Traceback: "), "event_type")).otherwise(F.to_json(F.struct(F.col("event_type").alias("symbol"))))
    return files.parse_envelopes(e.select(F.col("event_id").alias("line"), line.alias("value")), "value", "symbol string, price double")[1]


@query(
    "unsent_rows",
    "S11",
    """WITH s AS (SELECT user_id, max(ts) AS mark FROM events WHERE event_id % 3 = 0 AND user_id % 5 > 0 GROUP BY user_id)
SELECT event_id, e.user_id, CASE WHEN event_type LIKE '%m%' OR event_type LIKE '%h%' THEN 'market-data-minute' ELSE 'market-data-daily' END AS topic FROM events e LEFT JOIN s USING (user_id) WHERE mark IS NULL OR ts > mark""",
)
def unsent_rows(spark, sf):
    e = fx.table(spark, sf, "events")
    out = tables.newer_than_sent(e, e.filter("event_id % 3 = 0 AND user_id % 5 > 0"), "user_id", "ts")
    return out.select("event_id", "user_id", files.topic_of(F.col("event_type")).alias("topic"))


@query(
    "compacted_topic",
    "S12",
    """WITH l AS (SELECT user_id AS key, event_id AS "offset", CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value FROM events)
SELECT * FROM (SELECT * FROM l QUALIFY row_number() OVER (PARTITION BY key ORDER BY "offset" DESC) = 1) WHERE value IS NOT NULL""",
)
def compacted_topic(spark, sf):
    e = fx.table(spark, sf, "events")
    log = e.select(F.col("user_id").alias("key"), F.col("event_id").alias("offset"), F.when(F.col("event_type") != "error", F.col("value")).alias("value"))
    return tables.compacted(log, "key", "offset")


@query("retained_topic", "S13", "SELECT event_id, ts FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY")
def retained_topic(spark, sf):
    return tables.retained(fx.table(spark, sf, "events").select("event_id", "ts"), "ts", 7)


@query(
    "keyed_ingest",
    "S14",
    """WITH f AS (SELECT CASE WHEN o_orderkey % 50 = 0 THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS date, o_custkey AS code, o_orderkey AS id, floor(o_totalprice)::BIGINT AS amount FROM orders)
SELECT date, code, amount, '{"date":"' || date || '","code":' || code || ',"id":' || id || ',"amount":' || amount || '}' AS raw_json FROM f WHERE date <> '' QUALIFY row_number() OVER (PARTITION BY date, code ORDER BY id DESC) = 1""",
)
def keyed_ingest(spark, sf):
    o = fx.table(spark, sf, "orders")
    rows = o.select(
        F.when(F.col("o_orderkey") % 50 == 0, "").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("date"), F.col("o_custkey").alias("code"),
        F.col("o_orderkey").alias("id"), F.floor("o_totalprice").alias("amount"),
    )
    return tables.keyed_with_raw(rows, ["date", "code"], {"amount": F.col("amount")}, ["id"])


@query(
    "new_articles",
    "S15",
    """WITH i AS (SELECT md5(text) AS id, doc_id, source FROM documents), c AS (SELECT md5(text) AS id FROM documents WHERE doc_id % 3 = 0)
SELECT * FROM (SELECT * FROM i WHERE doc_id % 3 > 0 QUALIFY row_number() OVER (PARTITION BY id ORDER BY doc_id) = 1) WHERE id NOT IN (SELECT id FROM c)""",
)
def new_articles(spark, sf):
    d = fx.table(spark, sf, "documents").select(F.md5(F.col("text").cast("binary")).alias("id"), "doc_id", "source")
    return tables.insert_or_ignore(d.filter("doc_id % 3 = 0"), d.filter("doc_id % 3 > 0"), "id", ["doc_id"])


@query(
    "pending_backfill",
    "S16",
    """WITH s AS (SELECT l_suppkey AS symbol, min(l_shipdate)::DATE AS a, max(l_shipdate)::DATE AS b FROM lineitem GROUP BY 1), d AS (SELECT DISTINCT o_orderdate::DATE AS day FROM orders WHERE dayofweek(o_orderdate) BETWEEN 1 AND 5)
SELECT day, symbol FROM s JOIN d ON day BETWEEN a AND b WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_suppkey = symbol AND l_shipdate::DATE = day)""",
)
def pending_backfill(spark, sf):
    l = fx.table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("symbol"), F.to_date("l_shipdate").alias("day"))
    days = fx.table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("day")).distinct().filter(F.weekday("day") < 5)
    life = l.groupBy("symbol").agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"))
    return tables.pending_units(days, life, l, ["day", "symbol"])


MAPPING = (
    {"target": "symbol", "expression": "$.s", "transform": "upper"}, {"target": "timestamp", "expression": "$.t"},
    {"target": "price", "expression": "$.q.p", "transform": "number"}, {"target": "currency", "expression": "$.cur", "default": "usd", "transform": "upper"},
)


@query(
    "normalised_records",
    "S17",
    f"""SELECT event_id AS id, upper(event_type) AS symbol, CASE WHEN event_id % 6 > 0 THEN CAST(epoch(ts)::BIGINT AS VARCHAR) END AS "timestamp", CASE WHEN event_id % 7 > 0 THEN value END AS price,
  CASE WHEN event_id % 2 = 0 THEN 'EUR' ELSE 'USD' END AS currency, array_to_string(list_filter([CASE WHEN event_id % 6 = 0 THEN 'missing timestamp' END, CASE WHEN event_id % 7 = 0 THEN 'missing price' END], lambda x: x IS NOT NULL), ',') AS errors
FROM (SELECT * REPLACE (date_trunc('second', ts) AS ts) FROM events)""",
)
def normalised_records(spark, sf):
    e, k = fx.table(spark, sf, "events"), F.col("event_id")
    raw = F.to_json(F.struct(
        F.col("event_type").alias("s"), F.when(k % 6 > 0, F.unix_timestamp("ts").cast("string")).alias("t"),
        F.struct(F.when(k % 7 > 0, F.col("value")).alias("p")).alias("q"), F.when(k % 2 == 0, "eur").alias("cur"),
    ))
    transforms = {"upper": F.upper, "number": lambda c: c.try_cast("double")}
    out = tables.normalise_records(e.select(k.alias("id"), raw.alias("value")), "value", MAPPING, transforms, "QUOTE")
    return out.withColumn("errors", F.array_join("errors", ","))


_S = ("OHLCV", "QUOTE", "TICK", "ORDER", "POSITION", "PORTFOLIO", "INSTRUMENT", "NONE")
_T = lambda target, path, transform="", default="": {"target": target, "expression": path, "transform": transform, "default": default}
_NAMED = [_T("symbol", "$.s", "upper"), _T("timestamp", "$.t")]
ALL_MAPPINGS = {
    "OHLCV": [*_NAMED, *[_T(n, f"$.b.{n}", "number") for n in ("open", "high", "low", "close", "volume")]],
    "QUOTE": [*_NAMED, _T("price", "$.q.p", "number")],
    "TICK": [*_NAMED, _T("price", "$.q.p", "number"), _T("quantity", "$.n", "number")],
    "ORDER": [_T("orderId", "$.id"), _T("symbol", "$.s", "upper"), _T("side", "$.side", "upper"), _T("type", "$.kind", "upper", "market"), _T("quantity", "$.n", "number"), _T("status", "$.st")],
    "POSITION": [_T("symbol", "$.s", "upper"), _T("quantity", "$.n", "number"), _T("averagePrice", "$.q.p", "number")],
    "PORTFOLIO": [_T("timestamp", "$.t"), _T("totalValue", "$.q.p", "number")],
    "INSTRUMENT": [_T("symbol", "$.s", "upper"), _T("name", "$.s"), _T("exchange", "$.x", "upper", "xnys")],
}
TRANSFORMS = {"upper": F.upper, "number": lambda c: c.try_cast("double")}
_MIXED = f"""r AS (SELECT event_id AS id, {list(_S)!r}[event_id % 8 + 1] AS schema, event_type AS s, CASE WHEN event_id % 6 > 0 THEN CAST(epoch(ts)::BIGINT AS VARCHAR) END AS t,
  CASE WHEN event_id % 7 > 0 THEN value END AS p, CASE WHEN event_id % 5 > 0 THEN event_id % 9 END AS n, CASE WHEN event_id % 3 > 0 THEN 'buy' END AS side FROM (SELECT * REPLACE (date_trunc('second', ts) AS ts) FROM events)),
c AS (SELECT id, schema, CASE WHEN schema NOT IN ('PORTFOLIO', 'NONE') THEN upper(s) END AS symbol, CASE WHEN schema IN ('OHLCV', 'QUOTE', 'TICK', 'PORTFOLIO') THEN t END AS "timestamp",
  CASE WHEN schema = 'OHLCV' THEN p END AS open, CASE WHEN schema = 'OHLCV' THEN p + 1 END AS high, CASE WHEN schema = 'OHLCV' THEN p - 1 END AS low, CASE WHEN schema = 'OHLCV' THEN p END AS close,
  CASE WHEN schema = 'OHLCV' THEN n::DOUBLE END AS volume, CASE WHEN schema IN ('QUOTE', 'TICK') THEN p END AS price, CASE WHEN schema IN ('TICK', 'ORDER', 'POSITION') THEN n::DOUBLE END AS quantity,
  CASE WHEN schema = 'ORDER' THEN CAST(id AS VARCHAR) END AS "orderId", CASE WHEN schema = 'ORDER' THEN upper(side) END AS side, CASE WHEN schema = 'ORDER' THEN 'MARKET' END AS type,
  CASE WHEN schema = 'ORDER' THEN 'open' END AS status, CASE WHEN schema = 'POSITION' THEN p END AS "averagePrice", CASE WHEN schema = 'PORTFOLIO' THEN p END AS "totalValue",
  CASE WHEN schema = 'INSTRUMENT' THEN s END AS name, CASE WHEN schema = 'INSTRUMENT' THEN 'XNYS' END AS exchange FROM r)"""
_ERRORS = "e AS (" + " UNION ALL ".join(f"SELECT id, schema, 'missing {f}' AS error FROM c WHERE schema = '{k}' AND \"{f}\" IS NULL" for k, fs in tables.REQUIRED.items() for f in fs) + " UNION ALL SELECT id, schema, 'unknown schema' FROM c WHERE schema = 'NONE')"


def mixed_records(spark, sf):
    e, k = fx.table(spark, sf, "events"), F.col("event_id")
    price = F.when(k % 7 > 0, F.col("value"))
    size = F.when(k % 5 > 0, k % 9)
    raw = F.to_json(F.struct(
        k.cast("string").alias("id"), F.col("event_type").alias("s"), F.when(k % 6 > 0, F.unix_timestamp("ts").cast("string")).alias("t"), size.alias("n"), F.struct(price.alias("p")).alias("q"),
        F.struct(price.alias("open"), (price + 1).alias("high"), (price - 1).alias("low"), price.alias("close"), size.alias("volume")).alias("b"),
        F.when(k % 3 > 0, "buy").alias("side"), F.lit("open").alias("st"),
    ))
    rows = e.select(k.alias("id"), F.element_at(F.array(*[F.lit(x) for x in _S]), (k % 8 + 1).cast("int")).alias("schema"), raw.alias("value"))
    return tables.normalise_stream(rows, "value", "schema", ALL_MAPPINGS, TRANSFORMS)


@query("normalised_schemas", "S17", with_(_MIXED, _ERRORS, "SELECT c.*, coalesce(x.errors, 0) AS errors FROM c LEFT JOIN (SELECT id, count(*) AS errors FROM e GROUP BY id) x USING (id)"))
def normalised_schemas(spark, sf):
    """Records of all seven schemas and an unknown one, in one table."""
    return mixed_records(spark, sf).withColumn("errors", F.size("errors").cast("long"))


@query("record_errors", "S17", with_(_MIXED, _ERRORS, "SELECT * FROM e"))
def record_errors(spark, sf):
    return tables.error_rows(mixed_records(spark, sf), ["id"], "schema")


@query(
    "delimited_text",
    "S18",
    "SELECT o_orderkey AS id, 1 AS line_no, o_custkey AS customer, o_orderpriority AS priority, floor(o_totalprice)::DOUBLE AS total FROM orders UNION ALL SELECT o_orderkey, 2, -o_custkey, 'void', 0 FROM orders WHERE o_orderstatus = 'F'",
)
def delimited_text(spark, sf):
    o = fx.table(spark, sf, "orders")
    row = F.concat_ws("|", F.col("o_custkey"), F.col("o_orderpriority"), F.floor("o_totalprice"))
    text = F.concat(F.lit("customer|priority|total\r\n"), row, F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("\r\n"), -F.col("o_custkey"), F.lit("|void|0"))).otherwise(""))
    return files.parse_csv_text(o.select(F.col("o_orderkey").alias("id"), text.alias("text")), "text", "customer bigint, priority string, total double", "|", header=True)


def _g(i):
    return _gauss_sql("'3'", "symbol", "CAST(epoch(ts)::BIGINT AS VARCHAR)", f"'{i}'")


@query(
    "synthetic_minutes",
    "S20",
    f"""WITH d AS (SELECT s_suppkey::VARCHAR AS symbol, 50 + s_suppkey % 100 AS base, TIMESTAMP '2024-03-01' + to_days(i) AS day FROM supplier, (SELECT unnest(range(5))::INT AS i)),
m AS (SELECT symbol, base, day + to_minutes(570 + j) AS ts FROM d, (SELECT unnest(range(391))::INT AS j) WHERE dayofweek(day) BETWEEN 1 AND 5),
g AS (SELECT *, ln(1 + 0.001 * ({_g(0)})) AS step, {_u("'3'", 'symbol', "CAST(epoch(ts)::BIGINT AS VARCHAR)", "'4'")} AS u FROM m),
w AS (SELECT *, base * exp(sum(step) OVER (PARTITION BY symbol ORDER BY ts)) AS c FROM g)
SELECT symbol, ts AS "timestamp", {r('round(c, 2)', 1)} AS close, floor(-ln(1 - u) * 100000)::BIGINT AS volume FROM w""",
)
def synthetic_minutes(spark, sf):
    assets = fx.table(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("symbol"), (F.lit(50.0) + F.col("s_suppkey") % 100).alias("base_price"))
    m = synthetic.minute_bars(assets, "2024-03-01", "2024-03-05", seed=3)
    return m.select("symbol", "timestamp", F.col("close"), "volume").transform(lambda d: near(d, "close", digits=1))


def _folder(spark, name):
    """Fresh folder for a sink below the shared folder of the session."""
    import os
    import uuid

    from candlewick.session import checkpoint_folder

    return os.path.join(checkpoint_folder(spark), "sinks", f"{name}-{uuid.uuid4().hex}")


_DAILY = """d AS (SELECT symbol, "timestamp"::DATE AS date, arg_min(open, {'a': "timestamp", 'b': seq})::DOUBLE AS open, max(high)::DOUBLE AS high, min(low)::DOUBLE AS low, arg_max(close, {'a': "timestamp", 'b': seq})::DOUBLE AS close, sum(volume)::BIGINT AS volume FROM minute GROUP BY 1, 2)"""


def _silver(spark, sf):
    """The minute bars stored as a silver table of this session."""
    import uuid

    name = f"silver_{uuid.uuid4().hex}"
    tables.write_silver(fx.minute_like(spark, sf).select(*BAR, "seq"), name, _folder(spark, name), buckets=8)
    return name


_RANGE = "minute AS (SELECT * FROM m0 WHERE \"timestamp\" >= TIMESTAMP '2024-01-05' AND \"timestamp\" < TIMESTAMP '2024-01-25')"


@query(
    "silver_cleaning", "S3,F2",
    with_(MINUTE.replace("minute AS", "m0 AS", 1), _RANGE, f"SELECT {_BAR} FROM minute WHERE open > 0 AND high > 0 AND low > 0 AND close > 0 AND high >= low AND high >= open AND high >= close AND low <= open AND low <= close"),
)
def silver_cleaning(spark, sf):
    """Valid bars of a date range of the stored silver table."""
    from candlewick.operators import quality

    return doubles(quality.valid_ohlc(tables.silver_range(spark, _silver(spark, sf), "2024-01-05", "2024-01-25")).select(*BAR))


@query(
    "silver_daily", "S3,A3",
    with_(MINUTE, """d AS (SELECT symbol, "timestamp"::DATE AS day, arg_min(open, {'a': "timestamp", 'b': seq})::DOUBLE AS open, max(high)::DOUBLE AS high, min(low)::DOUBLE AS low, arg_max(close, {'a': "timestamp", 'b': seq})::DOUBLE AS close, sum(volume)::BIGINT AS volume, count(*) AS bars FROM minute GROUP BY 1, 2)""",
          'SELECT m.symbol, m."timestamp", m.seq, m.close::DOUBLE AS close, d.high AS day_high, d.low AS day_low, d.volume AS day_volume, d.bars AS day_bars FROM minute m JOIN d ON m.symbol = d.symbol AND m."timestamp"::DATE = d.day'),
)
def silver_daily(spark, sf):
    """Each stored bar beside its day: aggregate and join by symbol and day, both on the layout of the table."""
    return silver_days(spark.table(_silver(spark, sf)))


def silver_days(bars):
    days = bars.groupBy("symbol", "day").agg(F.max("high").alias("h"), F.min("low").alias("l"), F.sum("volume").alias("day_volume"), F.count("*").alias("day_bars"))
    rows = bars.join(days, ["symbol", "day"])
    return rows.select("symbol", "timestamp", "seq", F.col("close").cast("double").alias("close"), F.col("h").cast("double").alias("day_high"), F.col("l").cast("double").alias("day_low"), "day_volume", "day_bars")


@query("paced_replay", "S9", with_(MINUTE, f"SELECT {_BAR} FROM minute"))
def paced_replay(spark, sf):
    """One pass of the minute bars as messages, a fifth of them a trigger, read back from where the sink put them."""
    rows = fx.minute_like(spark, sf).select(*BAR)
    folder = _folder(spark, "replay")
    total = replay.number_messages(rows, ["timestamp", "symbol"], f"{folder}/rows")
    rate = -(-total // 5) * 2
    query = replay.paced(spark, f"{folder}/rows", total, rate, lambda m, i: m.write.mode("overwrite").parquet(f"{folder}/out/batch={i}"), f"{folder}/state", every_s=0.5)
    replay.finish(query, total, rate, every_s=0.5)
    return doubles(files.from_messages(spark.read.parquet(f"{folder}/out")))


@query("silver_parquet", "S5", with_(MINUTE, f"SELECT {_BAR} FROM minute"))
def silver_parquet(spark, sf):
    path = _folder(spark, "silver")
    files.write_parquet(fx.minute_like(spark, sf).select(*BAR), path)
    return doubles(tables.read_table(spark, path))


@query("gold_partitions", "S6", with_(MINUTE, _DAILY, "SELECT * FROM d WHERE symbol IN ('click', 'error')"))
def gold_partitions(spark, sf):
    path = _folder(spark, "gold")
    files.write_parquet(_summary(spark, sf), path, by=["symbol"], files_per_part=2)
    return spark.read.parquet(path).filter(F.col("symbol").isin("click", "error"))


def _summary(spark, sf):
    d = bars.daily_summary(fx.minute_like(spark, sf)).select("symbol", "date", "open", "high", "low", "close", "volume")
    return d.withColumns({c: F.col(c).cast("double") for c in ("open", "high", "low", "close")})


@query("gold_fan_out", "S8", with_(MINUTE, _DAILY, "SELECT 'columns' AS sink, * FROM d UNION ALL SELECT 'lines', * FROM d"))
def gold_fan_out(spark, sf):
    one, two = _folder(spark, "columns"), _folder(spark, "lines")
    daily = _summary(spark, sf)
    tables.fan_out(daily, {"columns": lambda d: files.write_parquet(d, one), "lines": lambda d: files.export(d, two, "json")})
    back = [spark.read.parquet(one).withColumn("sink", F.lit("columns")), spark.read.schema(daily.schema).json(two).withColumn("sink", F.lit("lines"))]
    return back[0].unionByName(back[1])


@query("exported_table", "S19", with_(MINUTE, _DAILY, "SELECT * FROM d"))
def exported_table(spark, sf):
    path = _folder(spark, "export")
    daily = _summary(spark, sf)
    files.export(daily, path)
    return spark.read.schema(daily.schema).option("header", True).csv(path)
