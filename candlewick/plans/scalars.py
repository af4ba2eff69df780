"""Scalar function, reshape and top-list queries."""


from pyspark.sql import functions as F

from candlewick import fixtures as fx
from candlewick.functions import scalars as fn
from candlewick.operators import reshape as ops
from candlewick.operators.series import DAILY, HOURLY
from candlewick.plans.quality import COMPANIES_SQL, companies
from candlewick.plans.registry import near, query, r, rs
from candlewick.plans.sql import DAILY as DAILY_SQL
from candlewick.plans.sql import HOURLY as HOURLY_SQL
from candlewick.plans.sql import NUMBERED, TICKS, with_


@query(
    "parse_timestamps",
    "C1",
    """SELECT event_id, date_trunc('second', ts) AS a, ts AS b, CASE WHEN event_type = 'error' THEN NULL ELSE date_trunc('second', ts) END AS c,
  date_trunc('second', ts) - INTERVAL 2 HOUR AS d, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso FROM events""",
)
def parse_timestamps(spark, sf):
    e = fx.table(spark, sf, "events").withColumn("t", F.col("ts").cast("timestamp"))
    text = e.select(
        "event_id", "t",
        F.date_format("t", "yyyy-MM-dd HH:mm:ss").alias("a"), F.date_format("t", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("b"),
        F.when(F.col("event_type") == "error", "n/a").otherwise(F.date_format("t", "yyyy-MM-dd'T'HH:mm:ss")).alias("c"),
        F.concat(F.date_format("t", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00")).alias("d"),
    )
    return text.select("event_id", *[fn.parse_time(x).alias(x) for x in "abcd"], fn.iso_seconds(F.col("t")).alias("iso"))


@query(
    "date_parts",
    "C2,C5",
    """SELECT o_orderkey, CAST(day(o_orderdate) AS INTEGER) AS day, CAST(month(o_orderdate) AS INTEGER) AS month, CAST(quarter(o_orderdate) AS INTEGER) AS quarter, CAST(year(o_orderdate) AS INTEGER) AS year,
  CAST(isodow(o_orderdate) - 1 AS INTEGER) AS weekday, CAST(week(o_orderdate) AS INTEGER) AS week, CAST(dayofyear(o_orderdate) AS INTEGER) AS day_of_year, last_day(o_orderdate) = o_orderdate::DATE AS is_month_end, isodow(o_orderdate) >= 6 AS is_weekend,
  CASE WHEN month(o_orderdate) = 12 AND day(o_orderdate) = 25 THEN true ELSE false END AS is_holiday FROM orders""",
)
def date_parts(spark, sf):
    o = fx.table(spark, sf, "orders")
    cols = {**fn.date_parts("o_orderdate"), **fn.calendar_columns("o_orderdate")}
    holidays = o.filter((F.month("o_orderdate") == 12) & (F.dayofmonth("o_orderdate") == 25)).select(
        F.to_date("o_orderdate").alias("date"), F.lit("XX").alias("country"), F.lit("christmas").alias("holiday")
    )
    out = fn.with_holidays(o.select("o_orderkey", "o_orderdate", *[c.alias(n) for n, c in cols.items()]), "o_orderdate", holidays)
    return out.drop("o_orderdate", "hour", "holidays")


@query(
    "day_counts",
    "C3",
    f"""WITH j AS (SELECT l_orderkey, l_linenumber, o_orderdate::DATE AS s, l_shipdate::DATE AS e FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT l_orderkey, l_linenumber, {r("(e - s) / 365")} AS act_365, {r("(e - s) / 360")} AS act_360,
  {r("(360 * (year(e) - year(s)) + 30 * (month(e) - month(s)) + least(day(e), 30) - least(day(s), 30)) / 360")} AS d30_360, CAST(DATE '2001-01-01' - e AS INTEGER) AS to_target FROM j""",
)
def day_counts(spark, sf):
    l, o = fx.table(spark, sf, "lineitem"), fx.table(spark, sf, "orders")
    j = l.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    out = j.select(
        "l_orderkey", "l_linenumber", fn.day_count("o_orderdate", "l_shipdate").alias("act_365"),
        fn.day_count("o_orderdate", "l_shipdate", "ACT/360").alias("act_360"), fn.day_count("o_orderdate", "l_shipdate", "30/360").alias("d30_360"),
        F.datediff(F.lit("2001-01-01").cast("date"), F.to_date("l_shipdate")).alias("to_target"),
    )
    return near(out, "act_365", "act_360", "d30_360")


@query(
    "shift_dates",
    "C4",
    """SELECT o_orderkey, CAST(o_orderdate + INTERVAL 1 MONTH AS DATE) AS next_month, CAST(o_orderdate + INTERVAL 1 YEAR + INTERVAL 3 DAY AS DATE) AS later,
  CASE WHEN isodow(o_orderdate) = 7 THEN CAST(o_orderdate AS DATE) + 1 ELSE CAST(o_orderdate AS DATE) END AS monday FROM orders""",
)
def shift_dates(spark, sf):
    return fx.table(spark, sf, "orders").select(
        "o_orderkey", fn.shift_date("o_orderdate", months=1).alias("next_month"), fn.shift_date("o_orderdate", days=3, years=1).alias("later"),
        fn.sunday_to_monday(F.to_date("o_orderdate")).alias("monday"),
    )


@query(
    "series_arithmetic",
    "C6,C7",
    with_(
        HOURLY_SQL,
        f"""SELECT symbol, ts, {r('abs(open - close)')} AS abs_diff, {r('open + close')} AS total, {r('open * close', 4)} AS prod, CASE WHEN open <> close THEN {r('volume / (open - close)', 4)} END AS ratio,
  {r('power(close, 1.5)', 4)} AS powered, {r('sqrt(close)')} AS root, {r('exp(-close / 100)')} AS e, CASE WHEN close > open THEN {r('ln(close - open)')} END AS l, CAST(ceil(close) AS BIGINT) AS up, CAST(floor(close) AS BIGINT) AS down,
  CASE WHEN volume <> 0 THEN CAST(floor(close / volume) AS BIGINT) END AS fdiv, close > open AND volume > 50 AS both_true, close > open OR volume > 50 AS either, NOT close > open AS neither, CASE WHEN close > open THEN close ELSE open END AS pick FROM bars""",
    ),
)
def series_arithmetic(spark, sf):
    o, c, v = F.col("open"), F.col("close"), F.col("volume")
    out = fx.hourly(spark, sf).select(
        "symbol", "ts", F.abs(o - c).alias("abs_diff"), (o + c).alias("total"), (o * c).alias("prod"), fn.divide(v, o - c).alias("ratio"),
        F.pow(c, F.lit(1.5)).alias("powered"), fn.safe_sqrt(c).alias("root"), F.exp(-c / 100).alias("e"), fn.safe_log(c - o).alias("l"),
        F.ceil(c).alias("up"), F.floor(c).alias("down"), fn.floor_divide(c, v).alias("fdiv"),
        ((c > o) & (v > 50)).alias("both_true"), ((c > o) | (v > 50)).alias("either"), (~(c > o)).alias("neither"), F.when(c > o, c).otherwise(o).alias("pick"),
    )
    return near(near(out, "abs_diff", "total", "root", "e", "l"), "prod", "ratio", "powered", digits=4)


@query(
    "array_functions",
    "C8",
    f"""WITH a AS (SELECT l_orderkey, list(l_extendedprice ORDER BY l_linenumber, l_extendedprice) AS v, list(l_linenumber ORDER BY l_linenumber, l_extendedprice) AS n, list(l_linenumber ORDER BY l_extendedprice DESC) AS sorted,
  list(l_linenumber ORDER BY l_linenumber, l_extendedprice) FILTER (l_returnflag = 'N') AS kept FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey, v[1] AS first, v[-1] AS last, CAST(len(v) AS INTEGER) AS length, {r('list_sum(v)', 2)} AS total, list_min(v) AS low, list_max(v) AS high, {r('list_sum(v) / len(v)', 4)} AS mean, sorted, coalesce(kept, []) AS kept FROM a""",
)
def array_functions(spark, sf):
    item = F.struct(F.col("l_linenumber").alias("n"), F.col("l_extendedprice").alias("p"), F.col("l_returnflag").alias("f"))
    a = fx.table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(item)).alias("a"))
    v = fn.array_pluck(F.col("a"), "p")
    out = a.select(
        "l_orderkey", fn.array_first(v).alias("first"), fn.array_last(v).alias("last"), F.size("a").alias("length"), fn.array_sum(v).alias("total"),
        F.array_min(v).alias("low"), F.array_max(v).alias("high"), fn.array_average(v).alias("mean"),
        fn.array_pluck(fn.array_sort_by(F.col("a"), "p", ascending=False), "n").alias("sorted"),
        fn.array_pluck(fn.array_where(F.col("a"), "f", "N"), "n").alias("kept"),
    )
    return near(near(out, "total", digits=2), "mean", digits=4)


@query(
    "array_returns",
    "C9",
    f"""WITH a AS (SELECT l_orderkey, list(l_extendedprice ORDER BY l_linenumber, l_extendedprice) AS v FROM lineitem GROUP BY l_orderkey),
b AS (SELECT l_orderkey, list_transform(generate_series(2, len(v)), lambda i: v[i] / v[i - 1] - 1) AS x FROM a)
SELECT l_orderkey, CAST(len(x) AS INTEGER) AS n, {r('coalesce(list_sum(x), 0)', 5)} AS total, CASE WHEN len(x) >= 2 THEN {r('list_stddev_samp(x) * sqrt(252)', 4)} ELSE 0 END AS volatility FROM b""",
)
def array_returns(spark, sf):
    item = F.struct("l_linenumber", "l_extendedprice")
    a = fx.table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(item)).alias("a"))
    v = fn.array_pluck(F.col("a"), "l_extendedprice")
    out = a.select("l_orderkey", F.size(fn.array_returns(v)).alias("n"), fn.array_sum(fn.array_returns(v)).alias("total"), fn.array_volatility(v).alias("volatility"))
    return near(near(out, "total", digits=5), "volatility", digits=4)


@query(
    "text_functions",
    "C10",
    """SELECT p_partkey, p_name = '' AS empty, CAST(length(p_name) AS INTEGER) AS length, lower(p_brand) AS lower, upper(p_name) AS upper, string_split(p_name, ' ') AS parts, replace(p_name, 'ring', 'RING') AS replaced,
  contains(p_name, 'ring') AS has, starts_with(p_name, 'red') AS starts, ends_with(p_name, 'bolt') AS ends, regexp_full_match(upper(p_type), '[A-Z]{1,5}(\\.[A-Z]{1,2})?') AND length(p_type) <= 10 AS ticker, replace(trim(upper(' ' || p_name || ' ')), ' ', '') AS symbol FROM part""",
)
def text_functions(spark, sf):
    n = F.col("p_name")
    return fx.table(spark, sf, "part").select(
        "p_partkey", (n == "").alias("empty"), F.length(n).alias("length"), F.lower("p_brand").alias("lower"), F.upper(n).alias("upper"), F.split(n, " ").alias("parts"),
        F.replace(n, F.lit("ring"), F.lit("RING")).alias("replaced"), F.contains(n, F.lit("ring")).alias("has"), F.startswith(n, F.lit("red")).alias("starts"),
        F.endswith(n, F.lit("bolt")).alias("ends"), fn.is_ticker(F.col("p_type")).alias("ticker"), fn.to_symbol(F.concat(F.lit(" "), n, F.lit(" "))).alias("symbol"),
    )


@query(
    "number_functions",
    "C11",
    f"""SELECT c_custkey, round(c_acctbal, 1) AS rounded, CAST(floor(c_acctbal) AS BIGINT) AS down, CAST(ceil(c_acctbal) AS BIGINT) AS up, abs(c_acctbal) AS abs, greatest(least(c_acctbal, 5000), 0) AS clamped,
  CASE WHEN c_acctbal < 0 THEN '-' ELSE '' END || '$' || format('{{:.2f}}', abs(c_acctbal)) AS usd, format('{{:.2f}}', abs(c_acctbal)) || ' EUR' AS eur, format('{{:.2f}}', c_acctbal) || '%' AS pct, {r('CASE WHEN c_acctbal <> 0 THEN (1000 - c_acctbal) / c_acctbal ELSE 0 END')} AS ret FROM customer""",
)
def number_functions(spark, sf):
    a = F.col("c_acctbal")
    out = fx.table(spark, sf, "customer").select(
        "c_custkey", F.round(a, 1).alias("rounded"), F.floor(a).alias("down"), F.ceil(a).alias("up"), F.abs(a).alias("abs"), fn.clamp(a, 0.0, 5000.0).alias("clamped"),
        fn.format_currency(a).alias("usd"), fn.format_currency(F.abs(a), "EUR").alias("eur"), fn.format_percent(a / 100).alias("pct"), fn.simple_return(a, F.lit(1000.0)).alias("ret"),
    )
    return near(out, "ret")


@query(
    "map_functions",
    "C12",
    """SELECT c_custkey, ['name', 'segment', 'nation'] AS keys, [c_name, c_mktsegment, CAST(c_nationkey AS VARCHAR)] AS vals, true AS has_name, ['name'] AS picked, ['segment', 'nation'] AS omitted,
  'merged' AS name_after, 4 AS merged_size FROM customer""",
)
def map_functions(spark, sf):
    c = fx.table(spark, sf, "customer")
    m = F.create_map(F.lit("name"), F.col("c_name"), F.lit("segment"), F.col("c_mktsegment"), F.lit("nation"), F.col("c_nationkey").cast("string"))
    extra = F.create_map(F.lit("name"), F.lit("merged"), F.lit("more"), F.lit("x"))
    merged = fn.map_merge(F.col("m"), extra)
    return c.select("c_custkey", m.alias("m")).select(
        "c_custkey", F.map_keys("m").alias("keys"), F.map_values("m").alias("vals"), F.map_contains_key("m", "name").alias("has_name"),
        F.map_keys(fn.map_pick(F.col("m"), ["name", "none"])).alias("picked"), F.map_keys(fn.map_omit(F.col("m"), ["name"])).alias("omitted"),
        F.element_at(merged, "name").alias("name_after"), F.size(merged).alias("merged_size"),
    )


@query(
    "json_functions",
    "C13,C14",
    """SELECT event_id, json_extract_string(props, '$.k') AS k, CAST(json_extract_string(props, '$.k') AS INTEGER) AS parsed, event_type AS nested, CAST(event_id AS VARCHAR) AS item, CAST(value AS VARCHAR) AS num, upper(event_type) AS up,
  strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%SZ') AS iso FROM events""",
)
def json_functions(spark, sf):
    e = fx.table(spark, sf, "events").withColumn("t", F.col("ts").cast("timestamp"))
    doc = F.to_json(F.struct(F.struct(F.col("event_type").alias("type"), F.array("event_id").alias("ids")).alias("a"), F.unix_millis("t").alias("ms"), F.col("value").alias("v")))
    e = e.withColumn("doc", doc)
    return e.select(
        "event_id", fn.json_path(F.col("props"), "k").alias("k"), F.from_json("props", "k INT")["k"].alias("parsed"), fn.json_path(F.col("doc"), "a.type").alias("nested"),
        fn.json_path(F.col("doc"), "$.a.ids[0]").alias("item"), fn.transform(fn.json_path(F.col("doc"), "v"), "to_number").alias("num"),
        fn.transform(F.col("event_type"), "upper").alias("up"), fn.transform(fn.json_path(F.col("doc"), "ms"), "unix_ms_to_iso").alias("iso"),
    )


@query(
    "regex_extract",
    "C15",
    """SELECT doc_id, regexp_extract_all(text, '[0-9]+') AS numbers, CASE WHEN regexp_matches(text, '([a-z]+)tion') THEN regexp_extract(text, '([a-z]+)tion', 1) END AS stem FROM documents""",
)
def regex_extract(spark, sf):
    t = F.col("text")
    return fx.table(spark, sf, "documents").select("doc_id", fn.extract_all(t, "[0-9]+").alias("numbers"), fn.extract_first(t, "([a-z]+)tion", 1).alias("stem"))


@query(
    "bucketize",
    "C16",
    with_(
        HOURLY_SQL,
        "e AS (SELECT min(close) AS lo, (max(close) - min(close)) / 10 AS w FROM bars)",
        """SELECT symbol, ts, CASE WHEN close > 0 AND close <= 10 THEN 'low' WHEN close > 10 AND close <= 50 THEN 'mid' WHEN close > 50 AND close <= 200 THEN 'high' END AS band,
  CAST(greatest(least(ceil((close - lo) / w) - 1, 9), 0) AS INTEGER) AS bin FROM bars, e""",
    ),
)
def bucketize(spark, sf):
    b = fx.hourly(spark, sf).withColumn("band", fn.bucketize(F.col("close"), [0, 10, 50, 200], ["low", "mid", "high"]))
    return fn.bucketize_width(b, "close", 10).select("symbol", "ts", "band", "bin")


@query(
    "annualise",
    "C17",
    f"""SELECT p_partkey, {r('power(1 + p_size / 10000, 252) - 1')} AS yearly, {r('power(1 + p_size / 100, 1 / 252.0) - 1', 9)} AS daily, {r('p_size * sqrt(252)')} AS vol FROM part""",
)
def annualise(spark, sf):
    s = F.col("p_size")
    out = fx.table(spark, sf, "part").select(
        "p_partkey", fn.annualize_return(s / 10000).alias("yearly"), fn.deannualize_return(s / 100).alias("daily"), fn.annualize_volatility(s).alias("vol")
    )
    return near(near(out, "yearly", "vol"), "daily", digits=9)


@query(
    "box_cox",
    "C18",
    f"""SELECT c_custkey, {r("(power(c_acctbal + CASE WHEN lo <= 0 THEN abs(lo) + 1 ELSE 0 END, 0.5) - 1) / 0.5")} AS transformed, {r("ln(abs(c_acctbal) + 1)")} AS logged FROM customer, (SELECT min(c_acctbal) AS lo FROM customer)""",
)
def box_cox(spark, sf):
    c = fx.table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    out = fn.box_cox_frame(c, "c_acctbal", 0.5).withColumn("logged", fn.box_cox(F.abs("c_acctbal") + 1, 0))
    return near(out, "transformed", "logged").drop("c_acctbal")


@query(
    "time_zones",
    "C19",
    """SELECT event_id, ts AT TIME ZONE 'America/New_York' AT TIME ZONE 'UTC' AS as_utc, ts AT TIME ZONE 'UTC' AT TIME ZONE 'Asia/Tokyo' AS tokyo FROM events""",
)
def time_zones(spark, sf):
    t = F.col("ts").cast("timestamp")
    return fx.table(spark, sf, "events").select("event_id", fn.localise(t, "America/New_York").alias("as_utc"), fn.convert(t, "Asia/Tokyo").alias("tokyo"))


@query(
    "business_days",
    "C20",
    """WITH days AS (SELECT unnest(generate_series(DATE '1990-01-01', DATE '2005-12-31', INTERVAL 1 DAY))::DATE AS d), cal AS (SELECT d, isodow(d) <= 5 AND d <> DATE '1997-12-25' AS b, sum((isodow(d) <= 5 AND d <> DATE '1997-12-25')::INT) OVER (ORDER BY d) AS n FROM days),
j AS (SELECT DISTINCT o_orderdate::DATE AS s, l_shipdate::DATE AS e FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT s, e, CAST(greatest(c2.n - c1.n + c1.b::INT, 0) AS BIGINT) AS business_days, f.d AS plus_5, p.d AS previous FROM j JOIN cal c1 ON s = c1.d JOIN cal c2 ON e = c2.d JOIN cal f ON f.b AND f.n = c1.n + 5 JOIN cal p ON p.b AND p.n = c1.n - CASE WHEN c1.b THEN 1 ELSE 0 END""",
)
def business_days(spark, sf):
    l, o = fx.table(spark, sf, "lineitem"), fx.table(spark, sf, "orders")
    j = l.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(F.to_date("o_orderdate").alias("s"), F.to_date("l_shipdate").alias("e")).distinct()
    both = j.select("s").union(j.select("e"))
    cal = fn.business_calendar(both, "s", ["1997-12-25"])
    out = fn.count_business_days(j, "s", "e", cal)
    out = fn.add_business_days(out, "s", 5, cal, "plus_5")
    return fn.previous_business_day(out, "s", cal, "previous")


# --- reshaping ---------------------------------------------------------------------------------------------------


@query(
    "append_prepend",
    "X1",
    with_(HOURLY_SQL, "SELECT symbol, ts, close, NULL::DOUBLE AS open, 1 AS part FROM bars WHERE symbol = 'view' UNION ALL SELECT symbol, ts, NULL, open, 2 FROM bars WHERE symbol = 'click' UNION ALL SELECT symbol, ts, close, NULL, 3 FROM bars WHERE symbol = 'error'"),
)
def append_prepend(spark, sf):
    h = fx.hourly(spark, sf)
    a = h.filter("symbol = 'view'").select("symbol", "ts", "close", F.lit(1).alias("part"))
    b = h.filter("symbol = 'click'").select("symbol", "ts", "open", F.lit(2).alias("part"))
    c = h.filter("symbol = 'error'").select("symbol", "ts", "close", F.lit(3).alias("part"))
    return ops.prepend(ops.append(a, b), c)


@query("distinct_by", "X2", "SELECT arg_min(event_id, event_id) AS event_id, user_id, arg_min(event_type, event_id) AS event_type FROM events GROUP BY user_id")
def distinct_by(spark, sf):
    e = ops.pick(fx.table(spark, sf, "events"), ["event_id", "user_id", "event_type", "absent"])
    return ops.omit(ops.distinct_by(e.withColumn("extra", F.lit(1)), "user_id", ["event_id"]), ["extra"])


@query("common_values", "X3", "SELECT user_id FROM events WHERE event_type = 'error' INTERSECT SELECT user_id FROM events WHERE event_type = 'purchase' INTERSECT SELECT user_id FROM events WHERE event_type = 'signup'")
def common_values(spark, sf):
    e = fx.table(spark, sf, "events")
    return ops.common_values([e.filter(F.col("event_type") == t) for t in ("error", "purchase", "signup")], "user_id")


@query(
    "chunks_and_repeats",
    "X4",
    with_(HOURLY_SQL, NUMBERED, "SELECT symbol, CAST(floor((rn - 1) / 100) AS BIGINT) AS chunk, copy, count(*) AS n, min(ts) AS first_ts FROM nb, (SELECT unnest([0, 1]) AS copy) GROUP BY ALL"),
)
def chunks_and_repeats(spark, sf):
    rows = ops.repeat(ops.chunks(fx.hourly(spark, sf), HOURLY, 100), 2)
    return rows.groupBy("symbol", "chunk", "copy").agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"))


@query("wide_to_long", "X4", with_(HOURLY_SQL, "SELECT symbol, ts, 'open' AS variable, open AS value FROM bars UNION ALL SELECT symbol, ts, 'close', close FROM bars"))
def wide_to_long(spark, sf):
    return ops.stack(fx.hourly(spark, sf), ["symbol", "ts"], ["open", "close"])


@query(
    "zero_pad",
    "X5",
    with_(
        HOURLY_SQL, NUMBERED,
        "f AS (SELECT symbol, max(ts) FILTER (rn = 1) AS a, max(ts) FILTER (rn = 2) AS b FROM nb GROUP BY symbol)",
        "SELECT symbol, ts, close FROM bars UNION ALL SELECT symbol, a - (b - a) * i, 0 FROM f, (SELECT unnest([1, 2, 3]) AS i)",
    ),
)
def zero_pad(spark, sf):
    return ops.zero_pad(fx.hourly(spark, sf), "symbol", "ts", "close", 3)


@query("coerce_panel", "X6", """SELECT CAST(user_id AS VARCHAR) AS entity_id, date_trunc('second', ts) AS "time", CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value FROM events""")
def coerce_panel(spark, sf):
    e = fx.table(spark, sf, "events")
    raw = e.select(
        F.col("user_id").alias(" Entity_ID "), F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd HH:mm:ss").alias("TIME"),
        F.when(F.col("event_type") == "error", "bad").otherwise(F.col("value").cast("string")).alias("Value"),
    )
    return ops.coerce_panel(raw)


# --- top lists ---------------------------------------------------------------------------------------------------


@query("newest_per_symbol", "K3", with_(TICKS, "SELECT symbol, ts, price FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts DESC) AS k FROM ticks) WHERE k <= 5"))
def newest_per_symbol(spark, sf):
    return ops.newest(fx.ticks(spark, sf).select("symbol", "ts", "price"), ["symbol"], ["ts"], 5)


@query("most_common_users", "K4", "SELECT user_id, count(*) AS count FROM events GROUP BY user_id ORDER BY count DESC, user_id LIMIT 10")
def most_common_users(spark, sf):
    return ops.most_common(fx.table(spark, sf, "events"), "user_id")


@query(
    "severity_order",
    "K5",
    """SELECT o_orderkey, s AS severity, CAST(CASE s WHEN 'critical' THEN 0 WHEN 'high' THEN 1 WHEN 'medium' THEN 2 ELSE 3 END AS INTEGER) AS rank FROM (SELECT o_orderkey, CASE left(o_orderpriority, 1) WHEN '1' THEN 'critical' WHEN '2' THEN 'high' WHEN '3' THEN 'medium' ELSE 'low' END AS s FROM orders) ORDER BY rank, o_orderkey""",
)
def severity_order(spark, sf):
    p = F.substring("o_orderpriority", 1, 1)
    s = F.when(p == "1", "critical").when(p == "2", "high").when(p == "3", "medium").otherwise("low")
    out = fx.table(spark, sf, "orders").select("o_orderkey", s.alias("severity"))
    return out.withColumn("rank", ops.severity_rank(F.col("severity"))).orderBy("rank", "o_orderkey")


@query(
    "down_sample",
    "K6",
    with_(DAILY_SQL, "n AS (SELECT symbol, ts, close, row_number() OVER (PARTITION BY symbol ORDER BY ts) AS rn, count(*) OVER (PARTITION BY symbol) AS c FROM bars)", "SELECT symbol, ts, close FROM n WHERE (rn - 1) % CASE WHEN c > 100 THEN CAST(floor(c / 100) AS BIGINT) ELSE 1 END = 0 OR rn = c"),
)
def down_sample(spark, sf):
    return ops.down_sample(fx.daily(spark, sf).select("symbol", "ts", "close"), DAILY, 100)


UNI_SQL = """uni AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, l_suppkey AS symbol, sum(l_extendedprice) AS dollar_volume FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL),
u AS (SELECT month, u.symbol, dollar_volume, sector, net_income AS roa, market_cap * 100 AS market_cap, market_cap / (abs(net_income) + 1) AS ev_to_ebitda, c.symbol * 10 AS age_days, CASE WHEN net_income > 1000 THEN 'NYS' ELSE 'LSE' END AS exchange FROM uni u JOIN companies c ON u.symbol = c.symbol),
s1 AS (SELECT *, row_number() OVER (PARTITION BY month ORDER BY dollar_volume DESC, symbol) AS k FROM u),
s2 AS (SELECT * EXCLUDE (k), count(*) OVER (PARTITION BY month) AS n, count(*) OVER (PARTITION BY month, sector) AS m, row_number() OVER (PARTITION BY month, sector ORDER BY dollar_volume DESC, symbol) AS k FROM s1 WHERE k <= 60 AND exchange = 'NYS' AND age_days > 180 AND market_cap > 5e8),
s3 AS (SELECT * EXCLUDE (k), row_number() OVER (PARTITION BY month ORDER BY ev_to_ebitda DESC, symbol) AS k FROM s2 WHERE k <= ceil(m * 20 / n)),
s4 AS (SELECT *, row_number() OVER (PARTITION BY month ORDER BY roa, symbol) AS rank FROM s3 WHERE k <= 20)"""


def universe(spark, sf):
    l, o = fx.table(spark, sf, "lineitem"), fx.table(spark, sf, "orders")
    c = companies(spark, sf).withColumnRenamed("volume", "_v")
    v = l.join(o, F.col("l_orderkey") == F.col("o_orderkey")).groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month"), F.col("l_suppkey").alias("symbol")).agg(F.sum("l_extendedprice").alias("dollar_volume"))
    return v.join(c, "symbol").select(
        "month", "symbol", "dollar_volume", "sector", F.lit("USA").alias("country"), F.when(F.col("net_income") > 1000, "NYS").otherwise("LSE").alias("exchange"),
        (F.col("symbol") * 10).alias("age_days"), (F.col("market_cap") * 100).alias("market_cap"),
        (F.col("market_cap") / (F.abs("net_income") + 1)).alias("ev_to_ebitda"), F.col("net_income").alias("roa"),
    )


@query("staged_universe", "K7", with_(COMPANIES_SQL, UNI_SQL, "SELECT month, symbol, rank FROM s4 WHERE rank <= 10"))
def staged_universe(spark, sf):
    return ops.staged_universe(universe(spark, sf), "month", coarse=60).select("month", "symbol", "rank")


@query(
    "peer_percentile",
    "K8",
    with_(COMPANIES_SQL, f"SELECT symbol, sector, {r('(rank() OVER (PARTITION BY sector ORDER BY net_income) - 1) * 100.0 / count(*) OVER (PARTITION BY sector)')} AS peer_percentile FROM companies"),
)
def peer_percentile(spark, sf):
    return near(ops.percentile_rank(companies(spark, sf), ["sector"], "net_income"), "peer_percentile").select("symbol", "sector", "peer_percentile")
