"""Seeded minute bars for demonstrations and load tests, drawn from hashes so that every run gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.operators.risk import gaussian
from candlewick.operators.series import Axis, prefix
from candlewick.operators.signals import uniform


def minute_bars(assets: DataFrame, start: str, end: str, seed: int = 0, sigma: float = 0.001, mean_volume: float = 100_000.0) -> DataFrame:
    """Minute bars on weekdays 09:30–16:00 for each ``symbol, base_price`` row: a random walk with exponential volume."""
    days = assets.select("symbol", "base_price", F.explode(F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)))).alias("day"))
    spread = 4 * assets.sparkSession.sparkContext.defaultParallelism  # each row becomes 391: one file of assets must not be one task
    days = days.filter(F.weekday("day") < 5).repartition(spread, "symbol", "day")
    minutes = days.withColumn("_m", F.explode(F.sequence(F.lit(0), F.lit(390))))
    rows = minutes.select("symbol", "base_price", F.timestamp_seconds(F.unix_date("day").cast("long") * 86400 + 34200 + F.col("_m") * 60).alias("timestamp"))
    at = F.unix_timestamp("timestamp")
    draw = lambda i: gaussian(F.lit(seed), F.col("symbol"), at, F.lit(i))
    rows = rows.withColumn("_step", F.log1p(sigma * draw(0)))
    walk = prefix(rows, Axis(("symbol",), ("timestamp",), span=86400 * 30), {"_walk": ("sum", "_step")})
    close = F.col("base_price") * F.exp("_walk")
    out = walk.withColumns({"_close": close, "_before": F.col("base_price") * F.exp(F.col("_walk") - F.col("_step"))})
    floor = lambda c: F.greatest(c, F.lit(0.01))
    out = out.withColumns({"_open": floor(F.col("_before") + draw(1) * F.col("_close") * 0.0005), "_close": floor(F.col("_close"))})
    spread = F.col("_close") * 0.002
    cents = lambda c: F.round(c, 2)
    return out.select(
        "symbol", "timestamp", cents(F.col("_open")).alias("open"),
        cents(F.greatest("_open", "_close") + F.abs(draw(2) * spread)).alias("high"),
        cents(floor(F.least("_open", "_close") - F.abs(draw(3) * spread))).alias("low"),
        cents(F.col("_close")).alias("close"),
        F.floor(-F.log(1 - uniform(F.lit(seed), F.col("symbol"), at, F.lit(4))) * mean_volume).alias("volume"), cents(F.col("_close")).alias("adjusted_close"),
    )
