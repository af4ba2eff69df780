"""Row checks, null counts, cleaning and data-quality reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.operators.ranking import quantiles, with_quantiles
from candlewick.operators.series import Axis, full, over_blocks, trailing, whole_by

PRICES = ("open", "high", "low", "close")


def null_counts(df: DataFrame) -> DataFrame:
    return df.select([F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def ohlc_rules() -> dict[str, Column]:
    """Named rules; each is true when a row breaks it."""
    o, h, l, c = (F.col(x) for x in PRICES)
    return {
        "null_price": o.isNull() | h.isNull() | l.isNull() | c.isNull(),
        "non_positive": (o <= 0) | (h <= 0) | (l <= 0) | (c <= 0),
        "high_below_low": h < l,
        "high_below_open_close": (h < o) | (h < c),
        "low_above_open_close": (l > o) | (l > c),
    }


def valid_ohlc(df: DataFrame) -> DataFrame:
    o, h, l, c = (F.col(x) for x in PRICES)
    return df.filter(
        (o > 0) & (h > 0) & (l > 0) & (c > 0) & (h >= l) & (h >= o) & (h >= c) & (l <= o) & (l <= c)
    )


def cleaning_report(df: DataFrame) -> DataFrame:
    """One pass: rows before and after, share kept, and breaks per rule (a row may break several)."""
    rules = ohlc_rules()
    broken = F.lit(False)
    for r in rules.values():
        broken = broken | F.coalesce(r, F.lit(False))
    initial, removed = F.count(F.lit(1)), F.count_if(broken)
    return df.agg(
        initial.alias("initial"),
        (initial - removed).alias("final"),
        removed.alias("removed"),
        F.when(initial > 0, F.round((initial - removed) / initial * 100, 2)).alias("retention_pct"),
        *[F.count_if(F.coalesce(r, F.lit(False))).alias(n) for n, r in rules.items()],
    )


def blank_counts(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Rows where a field is null or blank, per field, in long form."""
    counts = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(F.col(f).isNull() | (F.trim(F.col(f).cast("string")) == "")).alias(f) for f in fields],
    )
    return counts.unpivot("n_rows", list(fields), "field", "n_blank")


def key_rule_mismatches(df: DataFrame, expected: Column, actual: str, examples: Sequence[str], n: int = 20) -> DataFrame:
    """Count of rows whose non-empty ``actual`` differs from the value implied by the key, and the first ``n``."""
    bad = df.filter((F.coalesce(F.col(actual), F.lit("")) != "") & (F.col(actual) != expected))
    count = bad.agg(F.count(F.lit(1)).alias("n_mismatch"))
    first = bad.select(*examples, actual, expected.alias("expected")).orderBy(*examples).limit(n)
    return first.crossJoin(F.broadcast(count))  # one row


def file_integrity(index: DataFrame, files: DataFrame) -> DataFrame:
    """Indexed files (path, sha256) that are missing or whose bytes hash differently.

    ``files`` has path and content, as read by the binaryFile source.
    """
    found = files.select("path", F.sha2("content", 256).alias("actual"))
    state = (
        F.when(F.col("actual").isNull(), "missing")
        .when(F.col("actual") != F.col("sha256"), "mismatch")
        .otherwise("ok")
    )
    return index.join(found, "path", "left").withColumn("state", state)


def coverage(base: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Share of keys of ``base`` that ``other`` holds."""
    have = other.select(key).distinct().withColumn("_have", F.lit(1))
    return base.join(have, key, "left").agg(
        F.count(F.lit(1)).alias("total"),
        F.count("_have").alias("covered"),
        F.round(F.when(F.count(F.lit(1)) > 0, F.count("_have") / F.count(F.lit(1)) * 100), 2).alias("coverage_pct"),
    )


def coverage_counts(df: DataFrame, keys: Sequence[str], n: int = 60) -> DataFrame:
    """Rows per (dataset, year, quarter), newest first, first ``n`` lines of the report."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).orderBy(
        *[F.desc(k) for k in keys[1:]], keys[0]
    ).limit(n)


# Required fields per record type.
REQUIRED = {
    "OHLCV": ("symbol", "timestamp", "open", "high", "low", "close", "volume"),
    "QUOTE": ("symbol", "timestamp", "price"),
    "TICK": ("symbol", "timestamp", "price", "quantity"),
    "ORDER": ("orderId", "symbol", "side", "type", "quantity", "status"),
    "POSITION": ("symbol", "quantity", "averagePrice"),
    "PORTFOLIO": ("totalValue", "timestamp"),
    "INSTRUMENT": ("symbol", "name", "exchange"),
}


def missing_fields(fields: Sequence[str], available: Sequence[str]) -> Column:
    """Array of required fields that are null or not there at all."""
    marks = [F.when(F.col(f).isNull(), F.lit(f)) if f in available else F.lit(f) for f in fields]
    return F.filter(F.array(*marks), lambda x: x.isNotNull())


def validate_required(df: DataFrame, record_type: str) -> DataFrame:
    return df.withColumn("errors", missing_fields(REQUIRED[record_type], df.columns))


def missing_share(df: DataFrame) -> DataFrame:
    """Percent of empty cells; 100 for an empty frame."""
    n = len(df.columns)
    empty = sum((F.count_if(F.col(c).isNull()) for c in df.columns), F.lit(0))
    rows = F.count(F.lit(1))
    return df.agg(F.when(rows > 0, F.round(empty / (rows * n) * 100, 2)).otherwise(100.0).alias("missing_pct"))


def profile(df: DataFrame, columns: Sequence[str], z: float = 3.0) -> DataFrame:
    """Per numeric column: missing share, moments, extremes, and outliers by z-score and by 1.5 IQR."""
    long = df.unpivot([], [F.col(c).cast("double").alias(c) for c in columns], "column", "value")
    x = F.col("value")
    stats = long.groupBy("column").agg(
        F.count(F.lit(1)).alias("_n"),
        F.avg(x).alias("mean"),
        F.stddev_samp(x).alias("std"),
        F.stddev_pop(x).alias("_sd"),
        F.min(x).alias("min"),
        F.max(x).alias("max"),
        ((F.count(F.lit(1)) - F.count(x)) / F.count(F.lit(1))).alias("missing_ratio"),
    )
    edges = quantiles(long, ["column"], "value", {"_q1": 0.25, "_q3": 0.75})
    limits = stats.join(edges, "column", "left")  # one row per column name
    iqr = F.col("_q3") - F.col("_q1")
    flags = long.join(F.broadcast(limits), "column")
    outliers = flags.groupBy("column").agg(
        F.count_if(F.abs(x - F.col("mean")) > z * F.col("_sd")).alias("outliers_zscore"),
        F.count_if((x < F.col("_q1") - 1.5 * iqr) | (x > F.col("_q3") + 1.5 * iqr)).alias("outliers_iqr"),
    )
    return stats.join(outliers, "column").drop("_n", "_sd")


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each set of equal rows."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(F.sum(F.col("_n") - 1).alias("duplicates"))


def price_rules(bars: DataFrame, axis: Axis, value: str = "close") -> DataFrame:
    """Per symbol: non-positive prices, jumps beyond 50 %, likely splits, share of zero returns, flat stretches."""
    rows = over_blocks(bars, axis, lambda w: {"_r": F.col(value) / F.when(F.lag(value).over(w) != 0, F.lag(value).over(w)) - 1}, back=1)
    rows = over_blocks(rows, axis, lambda w: {"_s": full(F.stddev_samp("_r").over(trailing(w, 5)), "_r", w, 5)}, back=4)
    r = F.col("_r")
    return rows.groupBy(*axis.key).agg(
        F.count_if(F.col(value) <= 0).alias("non_positive"),
        F.count_if(F.abs(r) > 0.5).alias("large_jumps"),
        F.count_if(((r > -0.55) & (r < -0.45)) | ((r > 0.95) & (r < 1.05))).alias("likely_splits"),
        F.count_if(F.abs(r) > 1.0).alias("extreme_returns"),
        (F.count_if(r == 0) / F.count(r)).alias("zero_return_share"),
        F.count_if(F.col("_s") < 0.001).alias("flat_windows"),
    )


def remove_outliers(df: DataFrame, group: Sequence[str], value: str, method: str = "iqr", threshold: float = 1.5) -> DataFrame:
    """Drop rows outside the IQR fence or beyond a z-score."""
    x = F.col(value)
    if method == "iqr":
        rows = with_quantiles(df, group, value, {"_q1": 0.25, "_q3": 0.75})
        width = (F.col("_q3") - F.col("_q1")) * threshold
        return rows.filter((x >= F.col("_q1") - width) & (x <= F.col("_q3") + width)).drop("_q1", "_q3")
    rows = whole_by(df, list(group), {"_m": F.avg(value), "_s": F.stddev_samp(value)})
    return rows.filter(F.abs((x - F.col("_m")) / F.col("_s")) <= threshold).drop("_m", "_s")


COMPARE = {
    "gt": lambda a, b: a > b,
    "lt": lambda a, b: a < b,
    "ge": lambda a, b: a >= b,
    "le": lambda a, b: a <= b,
    "eq": lambda a, b: a == b,
    "ne": lambda a, b: a != b,
}


def threshold_filter(df: DataFrame, value: str, operator: str, threshold: float) -> DataFrame:
    return df.filter(COMPARE[operator](F.col(value), F.lit(threshold)))


def date_range(df: DataFrame, ts: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Inclusive date range; a bare end date covers the whole day."""
    if start is not None:
        df = df.filter(F.col(ts) >= F.lit(start).cast("timestamp"))
    if end is not None:
        df = df.filter(F.col(ts) < F.date_add(F.lit(end).cast("date"), 1).cast("timestamp"))
    return df


def replace_infinite(df: DataFrame, columns: Sequence[str], value: float | None = None) -> DataFrame:
    """±infinity becomes null, or ±``value``."""
    inf = float("inf")

    def fix(c: str) -> Column:
        x = F.col(c)
        if value is None:
            return F.when((x == inf) | (x == -inf), None).otherwise(x)
        return F.when(x == inf, value).when(x == -inf, -value).otherwise(x)

    return df.withColumns({c: fix(c) for c in columns})


# Trading sessions in UTC as hour * 100 + minute (open, close, pre-market open).
SESSIONS = {
    "NYSE": (1430, 2100, 900),
    "NASDAQ": (1430, 2100, 900),
    "LSE": (800, 1630, 700),
    "TSE": (0, 600, 2300),
    "NSE": (345, 1000, 300),
    "BSE": (345, 1000, 300),
}


def trading_session(ts: Column, exchange: Column | str) -> Column:
    """"regular", "pre_market" or "closed" for a UTC time; sessions are half-open, weekends closed."""
    exchange = F.lit(exchange) if isinstance(exchange, str) else exchange
    clock = F.hour(ts) * 100 + F.minute(ts)
    out = F.lit("closed")
    for name, (start, end, early) in SESSIONS.items():
        kind = F.when((clock >= start) & (clock < end), "regular").when((clock >= early) & (clock < start), "pre_market")
        out = F.when(exchange == name, F.coalesce(kind, F.lit("closed"))).otherwise(out)
    return F.when(F.weekday(ts) < 5, out).otherwise(F.lit("closed"))


def market_minutes(ts: Column, start: str = "09:30", end: str = "16:00") -> Column:
    """Weekday and local clock within [start, end], both ends included."""
    h0, m0 = map(int, start.split(":"))
    h1, m1 = map(int, end.split(":"))
    minute = F.hour(ts) * 60 + F.minute(ts)
    return (F.weekday(ts) < 5) & minute.between(h0 * 60 + m0, h1 * 60 + m1)


def branch(value: Column, operator: str | None = None, other: float | None = None) -> Column:
    """"true" / "false" for a comparison (a missing number counts as 0) or the truthiness of a value."""
    if operator is None:
        text = value.cast("string")
        number = F.try_to_number(text, F.lit("S999999999999999999.999999"))
        truth = value.isNotNull() & (text != "") & (text != "false") & F.coalesce(number != 0, F.lit(True))
    else:
        symbols = {">": "gt", "<": "lt", ">=": "ge", "<=": "le", "==": "eq", "!=": "ne"}
        truth = COMPARE[symbols[operator]](F.coalesce(value.cast("double"), F.lit(0.0)), F.lit(float(other)))
    return F.when(truth, "true").otherwise("false")


def route(value: Column, case1: str, case2: str) -> Column:
    """0, 1 or 2 (default) by the text of a field; empty cases never match."""
    text = value.cast("string")
    first = (text == case1) if case1 else F.lit(False)
    second = (text == case2) if case2 else F.lit(False)
    return F.when(first, 0).when(second, 1).otherwise(2)


def search(
    df: DataFrame,
    text: str | None = None,
    text_columns: Sequence[str] = (),
    equals: dict | None = None,
    at_least: dict | None = None,
    at_most: dict | None = None,
    newest: str | None = None,
) -> DataFrame:
    """Only the given filters apply; the text is matched case-insensitively in any of the columns."""
    if text:
        hit = F.lit(False)
        for c in text_columns:
            hit = hit | F.coalesce(F.contains(F.lower(F.col(c).cast("string")), F.lit(text.lower())), F.lit(False))
        df = df.filter(hit)
    for c, v in (equals or {}).items():
        df = df.filter(F.col(c) == v)
    for c, v in (at_least or {}).items():
        df = df.filter(F.col(c) >= v)
    for c, v in (at_most or {}).items():
        df = df.filter(F.col(c) <= v)
    return df.orderBy(F.desc(newest)) if newest else df


def search_instruments(df: DataFrame, text: str, exchange: str = "", limit: int = 20) -> DataFrame:
    """Substring of symbol, broker symbol or name; equities first, then indexes, futures, the rest."""
    pattern = text.upper()
    hit = F.lit(False)
    for c in ("symbol", "brsymbol", "name"):
        hit = hit | F.coalesce(F.contains(F.upper(c), F.lit(pattern)), F.lit(False))
    out = df.filter(hit)
    if exchange:
        out = out.filter(F.col("exchange") == exchange)
    kind = F.col("instrument_type")
    order = F.when(kind == "EQ", 0).when(kind == "INDEX", 1).when(kind == "FUT", 2).otherwise(3)
    return out.orderBy(order, "symbol").limit(limit)


def screen(
    df: DataFrame,
    limits: dict[str, tuple[float | None, float | None]],
    equals: dict | None = None,
    order: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Rows with every column inside its inclusive range; the first ``limit`` by ``order``."""
    for c, (low, high) in limits.items():
        if low is not None:
            df = df.filter(F.col(c) >= low)
        if high is not None:
            df = df.filter(F.col(c) <= high)
    for c, v in (equals or {}).items():
        df = df.filter(F.col(c) == v)
    if order:
        df = df.orderBy(F.desc(order), *[c for c in df.columns if c != order][:1])
    return df.limit(limit) if limit else df


PIECES = 8  # cuts of each side of a band of companies


def screen_comparables(peers: DataFrame, targets: DataFrame, max_size_ratio: float = 10.0, min_roe: float = -0.5) -> DataFrame:
    """Peers of each target: same sector, market cap within a ratio, return on equity above a floor.

    Log-size bands make the join an equi-join: caps within the ratio lie in the same or a neighbouring band. A band is
    cut into PIECES x PIECES pieces, since its pairs grow with the square of its companies.
    """
    import math

    band = F.floor(F.log("market_cap") / math.log(max_size_ratio))
    near = F.explode(F.array(band - 1, band, band + 1))
    piece, every = F.pmod(F.xxhash64("symbol"), F.lit(PIECES)), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(PIECES - 1).cast("long")))
    left = targets.select(
        F.col("symbol").alias("target"), "sector", F.col("market_cap").alias("_cap"), near.alias("_band"), piece.alias("_i")
    ).withColumn("_j", every)
    roe = F.when(F.col("book_value") > 0, F.col("net_income") / F.col("book_value")).otherwise(-1.0)
    right = peers.withColumns({"_band": band, "roe": roe, "_j": piece}).filter(F.col("roe") >= min_roe).withColumn("_i", every)
    keys = ["sector", "_band", "_i", "_j"]
    tasks = 4 * peers.sparkSession.sparkContext.defaultParallelism  # a number, since few bytes become many pairs
    left, right = left.repartition(tasks, *keys), right.repartition(tasks, *keys)
    ratio = F.greatest("market_cap", "_cap") / F.least("market_cap", "_cap")
    return right.join(left, keys).filter(ratio <= max_size_ratio).drop("_band", "_cap", "_i", "_j")
