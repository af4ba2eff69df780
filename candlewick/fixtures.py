"""Market-shaped inputs derived by Spark from the provided tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.operators import bars


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def spread_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table for row work that is heavy on the processor: one unsplittable file is spread over the tasks first.

    A table of many files is already spread and is read as it is.
    """
    df = table(spark, sf_dir, name)
    single = len(df.inputFiles()) == 1
    return df.repartition(spark.sparkContext.defaultParallelism) if single else df


def ticks(spark: SparkSession, sf_dir: str, symbol: str = "event_type") -> DataFrame:
    """Trades: symbol, ts, seq, price, size."""
    return table(spark, sf_dir, "events").select(
        F.col(symbol).cast("string").alias("symbol"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_id").alias("seq"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("long").alias("size"),
    )


def hourly(spark: SparkSession, sf_dir: str, symbol: str = "event_type") -> DataFrame:
    return bars.bars_from_ticks(ticks(spark, sf_dir, symbol), "1 hour")


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shipments as trades: symbol = supplier, ts = day, seq = position in the order."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("symbol"),
        F.col("l_shipdate").cast("timestamp").alias("ts"),
        (F.col("l_orderkey") * 16 + F.col("l_linenumber")).alias("seq"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.col("l_quantity").cast("long").alias("size"),
    )


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars.bars_from_ticks(trades(spark, sf_dir), "1 day")


def minute_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars of the silver schema with prices as decimals: one bar per tick."""
    return minute_of(table(spark, sf_dir, "events"))


def minute_of(e: DataFrame) -> DataFrame:
    """The same from a batch or a stream of events."""
    d = lambda c: c.cast("decimal(18,2)")
    k = F.get_json_object("props", "$.k").cast("long")
    v = F.col("value")
    return e.select(
        F.col("event_type").alias("symbol"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        d(v).alias("open"),
        d(v + k / 100).alias("high"),
        d(v - k % 7 / 100).alias("low"),
        d(v + (k * 3 % 11 - 5) / 100).alias("close"),
        k.alias("volume"),
        d(v + (k * 3 % 11 - 5) / 100).alias("adjusted_close"),
        F.col("event_id").alias("seq"),
    )
