"""Column functions: parsing, dates, arrays, text, numbers, maps, JSON."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- time --------------------------------------------------------------------------------------------------------

# Accepted timestamp patterns, tried in this order.
TIME_PATTERNS = (
    "yyyy-MM-dd HH:mm:ss.SSSSSS",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ssXXX",
    "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd",
)


def parse_time(c: Column | str) -> Column:
    """Timestamp from any of the patterns; null when none fits."""
    text = F.trim(_c(c))
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(p)) for p in TIME_PATTERNS])


def iso_seconds(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")


def date_parts(ts: Column | str) -> dict[str, Column]:
    """Day, month, quarter, year and weekday (Monday = 0)."""
    t = _c(ts)
    return {
        "day": F.dayofmonth(t), "month": F.month(t), "quarter": F.quarter(t), "year": F.year(t), "weekday": F.weekday(t),
    }


def day_count(start: Column | str, end: Column | str, convention: str = "ACT/365") -> Column:
    s, e = _c(start), _c(end)
    if convention == "ACT/360":
        return F.datediff(e, s) / 360
    if convention == "30/360":
        months = 360 * (F.year(e) - F.year(s)) + 30 * (F.month(e) - F.month(s))
        return (months + F.least(F.dayofmonth(e), F.lit(30)) - F.least(F.dayofmonth(s), F.lit(30))) / 360
    return F.datediff(e, s) / 365


def shift_date(ts: Column | str, days: int = 0, months: int = 0, years: int = 0) -> Column:
    """Calendar shift: months first, the day clipped to the month's end, then days."""
    t = _c(ts)
    moved = F.add_months(t, 12 * years + months) if months or years else t
    return F.date_add(moved, days) if days else moved


def sunday_to_monday(d: Column | str) -> Column:
    d = _c(d)
    return F.when(F.weekday(d) == 6, F.date_add(d, 1)).otherwise(F.to_date(d))


def calendar_columns(ts: Column | str) -> dict[str, Column]:
    t = _c(ts)
    return {
        "year": F.year(t), "quarter": F.quarter(t), "month": F.month(t), "week": F.weekofyear(t), "day": F.dayofmonth(t),
        "weekday": F.weekday(t), "day_of_year": F.dayofyear(t), "hour": F.hour(t), "is_month_end": F.last_day(t) == F.to_date(t),
        "is_weekend": F.weekday(t) >= 5,
    }


def with_holidays(df: DataFrame, ts: str, holidays: DataFrame) -> DataFrame:
    """Flag and name of the holiday (date, country, holiday) on the day of ``ts``."""
    names = holidays.groupBy("date").agg(F.array_sort(F.collect_set("holiday")).alias("holidays"))
    out = df.withColumn("_d", F.to_date(ts)).join(names.withColumnRenamed("date", "_d"), "_d", "left").drop("_d")
    return out.withColumn("is_holiday", F.col("holidays").isNotNull())


def localise(ts: Column | str, zone: str) -> Column:
    """Wall-clock time of a zone as UTC."""
    return F.to_utc_timestamp(_c(ts), zone)


def convert(ts: Column | str, zone: str) -> Column:
    """UTC as wall-clock time of a zone."""
    return F.from_utc_timestamp(_c(ts), zone)


# --- numbers -----------------------------------------------------------------------------------------------------


def divide(a: Column, b: Column) -> Column:
    """Null on a zero divisor."""
    return F.when(b != 0, a / b)


def safe_log(a: Column) -> Column:
    return F.when(a > 0, F.log(a))


def safe_sqrt(a: Column) -> Column:
    return F.when(a >= 0, F.sqrt(a))


def floor_divide(a: Column, b: Column) -> Column:
    return F.when(b != 0, F.floor(a / b))


def clamp(x: Column, low: Column | float, high: Column | float) -> Column:
    """Value moved into [low, high]; null stays null."""
    low, high = (b if isinstance(b, Column) else F.lit(b) for b in (low, high))
    return F.when(x.isNotNull(), F.greatest(F.least(x, high), low))


def format_currency(x: Column, currency: str = "USD") -> Column:
    number = F.format_string("%.2f", F.abs(x).cast("double"))
    sign = F.when(x < 0, "-").otherwise("")
    if currency in ("USD", "$"):
        return F.concat(sign, F.lit("$"), number)
    if currency == "INR":
        return F.concat(sign, F.lit("Rs."), number)
    return F.concat(sign, number, F.lit(f" {currency}"))


def format_percent(x: Column, decimals: int = 2) -> Column:
    return F.concat(F.format_string(f"%.{decimals}f", x.cast("double") * 100), F.lit("%"))


def simple_return(old: Column, new: Column) -> Column:
    return F.when(old != 0, (new - old) / old).otherwise(0.0)


def annualize_return(r: Column, periods: int = 252) -> Column:
    return F.pow(1 + r, F.lit(float(periods))) - 1


def deannualize_return(r: Column, periods: int = 252) -> Column:
    return F.pow(1 + r, F.lit(1.0 / periods)) - 1


def annualize_volatility(s: Column, periods: int = 252) -> Column:
    return s * math.sqrt(periods)


def box_cox(x: Column, power: float, shift: Column | float = 0.0) -> Column:
    v = x + shift
    return F.log(v) if power == 0 else (F.pow(v, F.lit(float(power))) - 1) / power


def box_cox_frame(df: DataFrame, value: str, power: float) -> DataFrame:
    """Box-Cox over a whole column; a column with values ≤ 0 is shifted above zero first."""
    low = df.agg(F.min(value).alias("_low"))
    rows = df.crossJoin(F.broadcast(low))  # one row
    shift = F.when(F.col("_low") <= 0, F.abs("_low") + 1).otherwise(0.0)
    return rows.withColumn("transformed", box_cox(F.col(value), power, shift)).drop("_low")


def bucketize(x: Column, edges: Sequence[float], labels: Sequence[str] | None = None) -> Column:
    """Right-closed bins (a, b]; null outside."""
    out = F.lit(None)
    for i in range(len(edges) - 2, -1, -1):
        name = F.lit(labels[i] if labels else i)
        out = F.when((x > edges[i]) & (x <= edges[i + 1]), name).otherwise(out)
    return out


def bucketize_width(df: DataFrame, value: str, bins: int, out: str = "bin") -> DataFrame:
    """``bins`` equal-width right-closed bins over the range of the column; the minimum falls into the first."""
    ends = df.agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    rows = df.crossJoin(F.broadcast(ends))  # one row
    width = (F.col("_hi") - F.col("_lo")) / bins
    edge = F.ceil((F.col(value) - F.col("_lo")) / width) - 1
    return rows.withColumn(out, clamp(edge, 0, bins - 1).cast("int")).drop("_lo", "_hi")


# --- arrays ------------------------------------------------------------------------------------------------------


def array_first(a: Column) -> Column:
    return F.get(a, 0)


def array_last(a: Column) -> Column:
    return F.try_element_at(a, F.lit(-1))


def array_sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + F.coalesce(x.cast("double"), F.lit(0.0)))


def array_average(a: Column) -> Column:
    return F.when(F.size(a) > 0, array_sum(a) / F.size(a)).otherwise(0.0)


def array_pluck(a: Column, field: str) -> Column:
    return F.transform(a, lambda x: x[field])


def array_where(a: Column, field: str, value) -> Column:
    return F.filter(a, lambda x: x[field] == value)


def array_sort_by(a: Column, field: str, ascending: bool = True) -> Column:
    sign = 1 if ascending else -1
    return F.array_sort(
        a, lambda x, y: F.when(x[field] < y[field], -sign).when(x[field] > y[field], sign).otherwise(0)
    )


def array_unique_by(a: Column, field: str) -> Column:
    """First element of each value of the field."""
    keys = F.transform(a, lambda x: x[field])
    return F.filter(a, lambda x, i: F.array_position(keys, x[field]) == i + 1)


def array_returns(prices: Column) -> Column:
    steps = F.zip_with(
        F.slice(prices, 1, F.greatest(F.size(prices) - 1, F.lit(0))),
        F.slice(prices, 2, F.greatest(F.size(prices) - 1, F.lit(0))),
        lambda a, b: simple_return(a, b),
    )
    return F.when(F.size(prices) > 1, steps).otherwise(F.array().cast("array<double>"))


def array_volatility(prices: Column, year: int = 252) -> Column:
    """Annualised sample deviation of the returns of a price array; 0 below two returns."""
    rets = array_returns(prices)
    n = F.size(rets)
    mean = array_sum(rets) / n
    squares = F.aggregate(rets, F.lit(0.0), lambda s, x: s + (x - mean) * (x - mean))
    return F.when(n >= 2, F.sqrt(squares / (n - 1)) * math.sqrt(year)).otherwise(0.0)


# --- text --------------------------------------------------------------------------------------------------------


def is_ticker(s: Column) -> Column:
    return (F.length(s) <= 10) & F.upper(s).rlike(r"^[A-Z]{1,5}(\.[A-Z]{1,2})?$")


def to_symbol(s: Column) -> Column:
    return F.regexp_replace(F.trim(F.upper(s)), " ", "")


def extract_all(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def extract_first(text: Column, pattern: str, group: int = 0) -> Column:
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    return F.get(found, 0)


# --- maps and JSON ----------------------------------------------------------------------------------------------


def map_pick(m: Column, fields: Sequence[str]) -> Column:
    return F.map_filter(m, lambda k, _: k.isin(list(fields)))


def map_omit(m: Column, fields: Sequence[str]) -> Column:
    return F.map_filter(m, lambda k, _: ~k.isin(list(fields)))


def map_merge(a: Column, b: Column) -> Column:
    """Entries of both; ``b`` wins."""
    rest = F.map_filter(a, lambda k, _: ~F.map_contains_key(b, k))
    return F.map_concat(rest, b)


def json_path(text: Column, path: str) -> Column:
    """Dot / index path such as ``a.b[0].c`` (a leading ``$.`` is optional)."""
    path = path if path.startswith("$") else f"$.{path}"
    return F.get_json_object(text, path)


def transform(c: Column, name: str) -> Column:
    """Named conversions of text values; unknown names pass the value through."""
    number = F.coalesce(F.try_to_number(c, F.lit("S99999999999999999999.999999999")).cast("double"), c.try_cast("double"))
    if name == "to_number":
        return F.coalesce(number, F.lit(0.0)).cast("string")
    if name == "unix_ms_to_iso":
        return F.date_format(F.timestamp_millis(c.try_cast("double").cast("long")), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    if name == "unix_s_to_iso":
        return F.date_format(F.timestamp_seconds(c.try_cast("double").cast("long")), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    if name == "upper":
        return F.upper(c)
    if name == "lower":
        return F.lower(c)
    if name == "abs_value":
        return F.abs(F.coalesce(number, F.lit(0.0))).cast("string")
    return c


# --- business days -----------------------------------------------------------------------------------------------


def business_calendar(dates: DataFrame, date: str, holidays: Sequence[str] = (), margin: int = 60) -> DataFrame:
    """One row per calendar day around the dates: business flag and number of business days up to it.

    The size is bounded by the calendar, not by the data.
    """
    span = dates.agg(F.date_sub(F.min(date), margin).alias("lo"), F.date_add(F.max(date), margin).alias("hi"))
    days = span.select(F.explode(F.sequence("lo", "hi")).alias("day"))
    free = F.weekday("day") >= 5
    if holidays:
        free = free | F.col("day").isin([str(h) for h in holidays])
    days = days.withColumn("is_business", ~free)
    w = Window.partitionBy(F.lit(1)).orderBy("day").rowsBetween(Window.unboundedPreceding, 0)  # one row per day
    return days.withColumn("number", F.sum(F.col("is_business").cast("int")).over(w))


def count_business_days(df: DataFrame, start: str, end: str, calendar: DataFrame, out: str = "business_days") -> DataFrame:
    """Business days from start to end, both included."""
    a = calendar.select(F.col("day").alias(start), F.col("number").alias("_a"), F.col("is_business").cast("int").alias("_ia"))
    b = calendar.select(F.col("day").alias(end), F.col("number").alias("_b"))
    rows = df.join(F.broadcast(a), start, "left").join(F.broadcast(b), end, "left")
    return rows.withColumn(out, F.greatest(F.col("_b") - F.col("_a") + F.col("_ia"), F.lit(0))).drop("_a", "_b", "_ia")


def add_business_days(df: DataFrame, date: str, days: int, calendar: DataFrame, out: str) -> DataFrame:
    """The business day ``days`` after (before, if negative) a date; from a free day the count starts next to it."""
    a = calendar.select(F.col("day").alias(date), F.col("number").alias("_n"), F.col("is_business").alias("_b"))
    target = calendar.filter("is_business").select(F.col("number").alias("_t"), F.col("day").alias(out))
    rows = df.join(F.broadcast(a), date, "left")
    aim = F.col("_n") + days + (F.when(F.col("_b"), 0).otherwise(1) if days < 0 else F.lit(0))
    return rows.withColumn("_t", aim).join(F.broadcast(target), "_t", "left").drop("_t", "_n", "_b")


def previous_business_day(df: DataFrame, date: str, calendar: DataFrame, out: str) -> DataFrame:
    return add_business_days(df, date, -1, calendar, out)
