"""Roll-ups of ticks and bars into OHLCV bars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.operators.ranking import quantiles
from candlewick.operators.series import HOURLY, Axis, over_blocks

CALENDAR = ("week", "month", "quarter", "year")


def bucket(ts: Column, width: str) -> Column:
    """Bucket start: fixed widths ("15 minutes", "1 hour", "1 day") or calendar units ("month")."""
    unit = width.split()[-1].rstrip("s")
    if unit in CALENDAR:
        return F.date_trunc(unit, ts)
    return F.window(ts, width).start


def bars_from_ticks(ticks: DataFrame, width: str) -> DataFrame:
    """OHLCV from trades.  All aggregates combine map-side, so a hot symbol shuffles one row per bar and task."""
    at = F.struct("ts", "seq")
    return (
        ticks.withColumn("_at", at)
        .groupBy("symbol", bucket(F.col("ts"), width).alias("bar"))
        .agg(
            F.min_by("price", "_at").alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", "_at").alias("close"),
            F.sum("size").alias("volume"),
        )
        .withColumnRenamed("bar", "ts")
    )


def _ohlcv(ts: str) -> list[Column]:
    """Earliest non-null open, extremes, latest non-null close, summed volume."""
    t = F.col(ts)
    return [
        F.min_by("open", F.when(F.col("open").isNotNull(), t)).alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", F.when(F.col("close").isNotNull(), t)).alias("close"),
        F.sum("volume").alias("volume"),
    ]


def hourly_ohlcv(bars: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Hourly OHLCV with the average close."""
    return bars.groupBy("symbol", F.window(ts, "1 hour").start.alias("_bar")).agg(
        *_ohlcv(ts), F.avg("close").alias("avg_price")
    ).withColumnRenamed("_bar", ts)


def daily_ohlcv(bars: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Daily OHLCV with average close and VWAP (average close on zero volume)."""
    value = F.sum((F.col("close") * F.col("volume")).cast("decimal(38,4)"))
    traded = F.sum("volume")
    vwap = F.when(traded > 0, value.cast("double") / traded).otherwise(F.avg("close").cast("double"))
    return bars.groupBy("symbol", F.to_date(ts).alias("date")).agg(
        *_ohlcv(ts), F.avg("close").alias("avg_price"), vwap.alias("vwap")
    )


def daily_summary(bars: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Gold table: daily OHLCV ordered by symbol and date."""
    return bars.groupBy("symbol", F.to_date(ts).alias("date")).agg(*_ohlcv(ts)).orderBy("symbol", "date")


def resample(bars: DataFrame, width: str) -> DataFrame:
    """Bars of a wider interval; buckets without rows do not appear."""
    return bars.groupBy("symbol", bucket(F.col("ts"), width).alias("_bar")).agg(*_ohlcv("ts")).withColumnRenamed(
        "_bar", "ts"
    )


METHODS = {
    "sum": lambda v, t: F.sum(v),
    "mean": lambda v, t: F.avg(v),
    "min": lambda v, t: F.min(v),
    "max": lambda v, t: F.max(v),
    "first": lambda v, t: F.min_by(v, F.when(F.col(v).isNotNull(), F.col(t))),
    "last": lambda v, t: F.max_by(v, F.when(F.col(v).isNotNull(), F.col(t))),
}


def resample_values(panel: DataFrame, width: str, method: str = "mean") -> DataFrame:
    """Panel (entity_id, time, value) per bucket with one of the named methods."""
    return panel.groupBy("entity_id", bucket(F.col("time"), width).alias("_bar")).agg(
        METHODS[method]("value", "time").alias("value")
    ).withColumnRenamed("_bar", "time")


def latest_prices(bars: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Newest bar per symbol."""
    return bars.groupBy("symbol").agg(F.max_by(F.struct(ts, "close", "volume"), ts).alias("r")).select("symbol", "r.*")


def rows_per_symbol(bars: DataFrame) -> DataFrame:
    return bars.groupBy("symbol").count()


# Names of bar frequencies and the largest median gap in seconds each one covers.
FREQUENCIES = (
    ("1Min", 60), ("5Min", 300), ("15Min", 900), ("30Min", 1800), ("1H", 3600), ("4H", 14400), ("1D", 86400), ("1W", 604800),
)


def infer_frequency(series: DataFrame, axis: Axis = HOURLY) -> DataFrame:
    """Median gap in seconds per symbol and the smallest named frequency that covers it ("1M" beyond a week)."""
    gap = over_blocks(
        series.select("symbol", "ts"),
        axis,
        lambda w: {"gap": (F.unix_micros("ts") - F.unix_micros(F.lag("ts").over(w))) / 1e6},
        back=1,
    )
    label = F.lit("1M")
    for name, seconds in reversed(FREQUENCIES):
        label = F.when(F.col("median_gap") <= seconds, name).otherwise(label)
    return quantiles(gap, ["symbol"], "gap", {"median_gap": 0.5}).withColumn("frequency", label)
