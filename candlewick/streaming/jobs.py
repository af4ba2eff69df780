"""Structured Streaming jobs: ingest with rejects, upserts, windowed bars, incremental indicators, alerts, counts."""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from candlewick.operators import indicators, ranking, signals
from candlewick.operators.series import POS, Axis, HOURLY
from candlewick.sources import files, tables


def _start(df: DataFrame, checkpoint: str, once: bool, batch: Callable[[DataFrame, int], None] | None = None, mode: str = "append", **trigger) -> StreamingQuery:
    w = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if once else w.trigger(**(trigger or {"processingTime": "10 seconds"}))
    return w.foreachBatch(batch).start()


def ingest(messages: DataFrame, target: str, rejects: str, checkpoint: str, schema=files.MINUTE, key: Sequence[str] = ("symbol", "timestamp"), once: bool = False) -> StreamingQuery:
    """Topic records into a Parquet table; records that cannot be read or lack a key go to the rejects.

    Files carry the batch number, so a batch that is run again after a failure replaces its own rows.
    """
    parsed = messages.select(F.col("value").cast("string").alias("value")).withColumn("data", F.from_json("value", schema))
    bad = F.lit(False)
    for k in key:
        bad = bad | F.col(f"data.{k}").isNull()

    def write(batch: DataFrame, number: int) -> None:
        held = batch.persist()
        try:
            held.filter(~bad).select("data.*").write.mode("overwrite").parquet(os.path.join(target, f"batch={number}"))
            held.filter(bad).select("value").write.mode("overwrite").parquet(os.path.join(rejects, f"batch={number}"))
        finally:
            held.unpersist()

    return _start(parsed, checkpoint, once, write)


def upsert_stream(rows: DataFrame, table: str, checkpoint: str, keys: Sequence[str], order: Sequence[str], once: bool = False) -> StreamingQuery:
    """Last write wins per key: every batch is appended under its number, and ``current`` reads the newest row per key.

    Only the copies inside a batch are collapsed on the way in.
    """

    def write(batch: DataFrame, number: int) -> None:
        tables.keep_last(batch, keys, order).write.mode("overwrite").parquet(os.path.join(table, f"batch={number}"))

    return _start(rows, checkpoint, once, write)


def current(spark: SparkSession, table: str, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Newest row per key over all batches, later batches before equal times."""
    return tables.keep_last(spark.read.parquet(table), keys, [*order, "batch"]).drop("batch")


def compact(spark: SparkSession, table: str, target: str, keys: Sequence[str], order: Sequence[str]) -> None:
    """Write the newest row per key of all batches so far as one batch of another table, under the number of the last one.

    Readers switch to ``target`` and the stream goes on there; the old folder can then be dropped.
    """
    last = spark.read.parquet(table).agg(F.max("batch")).first()[0]
    if last is not None:
        current(spark, table, keys, order).write.mode("overwrite").parquet(os.path.join(target, f"batch={last}"))


def first_seen(rows: DataFrame, keys: Sequence[str], ts: str, delay: str) -> DataFrame:
    """Keep the first of equal keys within the allowed delay; state older than the delay is dropped."""
    return rows.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def windowed_bars(ticks: DataFrame, width: str, delay: str, key: str = "symbol", ts: str = "ts", price: str = "price", size: str = "size") -> DataFrame:
    """Tumbling bars of a stream, each emitted once its window is past the delay."""
    return (
        ticks.withWatermark(ts, delay)
        .groupBy(F.window(ts, width), key)
        .agg(
            F.min_by(price, ts).alias("open"), F.max(price).alias("high"), F.min(price).alias("low"), F.max_by(price, ts).alias("close"), F.sum(size).alias("volume"),
        )
        .select(key, F.col("window.start").alias(ts), "open", "high", "low", "close", "volume")
    )


def latest_per_topic(events: DataFrame, topic: str, ts: str, value: str, every: str) -> DataFrame:
    """Latest value per topic and short interval (update mode on a stream)."""
    return events.groupBy(topic, F.window(ts, every)).agg(F.max_by(value, ts).alias(value), F.max(ts).alias(ts)).select(topic, F.col("window.start").alias("interval"), ts, value)


def hourly_counts(events: DataFrame, key: str, ts: str, delay: str) -> DataFrame:
    """Count per key and hour on a stream; the finished hours feed ``news.hourly_baseline``."""
    return events.withWatermark(ts, delay).groupBy(key, F.window(ts, "1 hour")).agg(F.count("*").alias("n")).select(key, F.col("window.start").alias("hour"), "n")


def sliding_counts(events: DataFrame, key: str, ts: str, delay: str, width: str = "1 hour", slide: str = "10 minutes") -> DataFrame:
    return events.withWatermark(ts, delay).groupBy(key, F.window(ts, width, slide)).agg(F.count("*").alias("n")).select(key, F.col("window.start").alias("start"), "n")


# ------------------------------------------------------------------------------------------------ bars with memory


def _with_tail(spark: SparkSession, folder: str, number: int, fresh: DataFrame, axis: Axis, keep: int, use: Callable[[DataFrame], None]) -> None:
    """Run ``use`` over the stored last bars and the new ones, then store the last ``keep`` bars per key.

    The stored bars of batch n are written under its number and read by batch n + 1, so a batch that is run again
    starts from the same bars. Every key keeps a bounded number of rows.
    """
    path = os.path.join(folder, f"batch={number - 1}")
    seen = fresh.withColumn("_new", F.lit(True))
    if number > 0:
        seen = seen.unionByName(spark.read.parquet(path).withColumn("_new", F.lit(False)))
    held = seen.persist()
    try:
        use(held)
        last = ranking.top_n(held.drop("_new"), list(axis.key), [F.desc(c) for c in axis.order], keep).drop("rank")
        last.write.mode("overwrite").parquet(os.path.join(folder, f"batch={number}"))
    finally:
        held.unpersist()


def indicator_stream(bars: DataFrame, wanted: Mapping[str, tuple[str, dict]], target: str, state: str, checkpoint: str, keep: int, axis: Axis = HOURLY, once: bool = False) -> StreamingQuery:
    """Indicators of each new bar from the last ``keep`` bars of its series: the batch kernels over a bounded history.

    ``ready`` tells whether every indicator is past its warm-up. ``keep`` covers the longest window, for exponential
    averages the rows after which older values no longer show in a double.
    """
    spark = bars.sparkSession
    columns = bars.columns

    def write(batch: DataFrame, number: int) -> None:
        def use(held: DataFrame) -> None:
            out = indicators.compute(held, wanted, axis)
            names = [c for c in out.columns if c not in (*columns, "_new", POS)]
            ready = F.lit(True)
            for n in names:
                ready = ready & F.col(n).isNotNull()
            out.filter("_new").select(*columns, *names, ready.alias("ready")).write.mode("overwrite").parquet(os.path.join(target, f"batch={number}"))

        _with_tail(spark, state, number, batch, axis, keep, use)

    return _start(bars, checkpoint, once, write)


def alert_stream(bars: DataFrame, rules: Sequence, target: str, state: str, checkpoint: str, keep: int, axis: Axis = HOURLY, once: bool = False) -> StreamingQuery:
    """An alert for each new bar on which a rule group turns from false to true."""
    spark = bars.sparkSession
    columns = bars.columns

    def write(batch: DataFrame, number: int) -> None:
        def use(held: DataFrame) -> None:
            alerts(held, rules, axis).filter("_new").select(*columns).write.mode("overwrite").parquet(os.path.join(target, f"batch={number}"))

        _with_tail(spark, state, number, batch, axis, keep, use)

    return _start(bars, checkpoint, once, write)


def alerts(bars: DataFrame, rules: Sequence, axis: Axis = HOURLY) -> DataFrame:
    """Bars on which a rule group turns true after not being true on the bar before."""
    from candlewick.operators.series import over_blocks

    met = signals.evaluate_groups(bars, {"_met": rules}, axis)
    on = F.coalesce(F.col("_met"), F.lit(False))
    turned = over_blocks(met, axis, lambda w: {"_was": F.lag(F.coalesce(F.col("_met"), F.lit(False)), 1, False).over(w)}, back=1)
    return turned.filter(on & ~F.col("_was")).select(*bars.columns)


def velocity(hours: DataFrame, key: str, ratio: float = 3.0, least: int = 5) -> DataFrame:
    """Hours with at least ``least`` events and ``ratio`` times those of the hour before (an empty one counts as one)."""
    before = hours.select(key, (F.col("hour") + F.expr("INTERVAL 1 HOUR")).alias("hour"), F.col("n").alias("_before"))
    r = F.col("n") / F.greatest(F.coalesce(F.col("_before"), F.lit(0)), F.lit(1))
    out = hours.join(before, [key, "hour"], "left").filter((F.col("n") >= least) & (r >= ratio))
    return out.select(key, "hour", "n", F.round(r, 1).alias("ratio"), F.when(r >= 5, "high").otherwise("medium").alias("severity"))
