"""Replay of stored rows as a paced stream of messages."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from candlewick.operators import ranking
from candlewick.sources import files

NUMBER, PIECE, ROUND = "message_no", "piece", "pass_no"
PIECE_ROWS = 100_000  # rows of a folder: a micro-batch reads the folders its numbers lie in


def number_messages(df: DataFrame, order: Sequence[str], path: str) -> int:
    """Store the rows of ``df`` with their number from 0 in the given order, in folders by number; returns how many there are."""
    rows = ranking.ordinals(df.withColumn("_one", F.lit(0)), [], "_one", order, NUMBER).drop("_one").withColumn(NUMBER, F.col(NUMBER) - 1)
    rows.withColumn(PIECE, F.floor(F.col(NUMBER) / PIECE_ROWS)).repartitionByRange(PIECE, NUMBER).write.mode("overwrite").partitionBy(PIECE).parquet(path)
    return df.sparkSession.read.parquet(path).count()


def _between(stored: DataFrame, low: int, high: int) -> DataFrame:
    """Rows numbered ``low`` to ``high``; only their folders are read."""
    return stored.filter(F.col(PIECE).between(low // PIECE_ROWS, high // PIECE_ROWS) & F.col(NUMBER).between(low, high)).drop(PIECE)


def paced(
    spark: SparkSession, path: str, total: int, rate: int, sink: Callable[[DataFrame, int], None], checkpoint: str, once: bool = True, every_s: float = 1.0, key: str | None = "symbol",
) -> StreamingQuery:
    """Send the rows stored by :func:`number_messages` as messages, ``rate`` a second, to ``sink(messages, batch number)``.

    Spark's rate source is the clock: each trigger admits the next ``rate * every_s`` numbers, and the checkpoint keeps the last one, so that a
    replay that is started again goes on where it stopped. A batch may be sent again after a failure, under the same number. ``once`` ends after one pass (the query
    then sends nothing more; see :func:`finish`); otherwise the rows come round again, with their pass in ``pass_no``. A rate of 0 is :func:`files.replay` over the files themselves.
    """
    if rate <= 0 or total <= 0:
        raise ValueError("a paced replay needs a rate and rows; without a pace use files.replay")
    step = max(1, round(rate * every_s))
    stored = spark.read.parquet(path)
    columns = [c for c in stored.columns if c not in (PIECE, NUMBER)]

    def send(batch: DataFrame, number: int) -> None:
        ends = batch.agg(F.min("value"), F.max("value")).first()
        if ends[0] is None:
            return
        low, high = ends[0], min(ends[1], total - 1) if once else ends[1]
        parts = []
        while low <= high:
            turn = low // total
            until = min(high, (turn + 1) * total - 1)
            parts.append(_between(stored, low - turn * total, until - turn * total).withColumn(ROUND, F.lit(turn)))
            low = until + 1
        for i, part in enumerate(parts):
            parts[i] = files.to_messages(part, key, columns) if once else files.to_messages(part, key, [*columns, ROUND])
        if parts:
            rows = parts[0]
            for part in parts[1:]:
                rows = rows.unionByName(part)
            sink(rows, number)

    clock = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", step).option("numPartitions", 1).load()
    return clock.writeStream.foreachBatch(send).option("checkpointLocation", checkpoint).trigger(processingTime=f"{max(1, round(every_s * 1000))} milliseconds").start()


def finish(query: StreamingQuery, total: int, rate: int, every_s: float = 1.0, poll_s: float = 0.05) -> None:
    """Wait for the end of one pass and stop the query."""
    batches = -(-total // max(1, round(rate * every_s)))
    while query.isActive:
        done = query.lastProgress
        if done and done["batchId"] >= batches - 1 and not query.status["isTriggerActive"]:
            break  # between two triggers, so that no batch is cut off
        query.awaitTermination(poll_s)
    query.stop()
