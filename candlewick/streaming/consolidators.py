"""Bars that close by time, count, range or brick. One small step function per kind serves batch and stream.

A step takes the rows of one series in time order and the state left by earlier rows (``None`` at the start) and
returns the closed bars and the new state. In batch ``fold`` runs it over time buckets in parallel, with the summaries of
``machines`` that a step may carry as ``machine``; on a stream the state is kept per key.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.operators.machines import Bars, Clamp, Machine
from candlewick.operators.series import POS, Axis, fold, number

BARS = "start timestamp, end timestamp, open double, high double, low double, close double, volume double"
Step = Callable[[pd.DataFrame, "list[float] | None"], "tuple[pd.DataFrame, list[float]]"]


def _seconds(ts: pd.Series) -> pd.Series:
    return ts.astype("datetime64[us]").astype("int64") / 1e6


def _bars(keys: pd.DataFrame, closed: list) -> pd.DataFrame:
    out = pd.DataFrame(closed, columns=["start", "end", "open", "high", "low", "close", "volume"])
    for c in ("start", "end"):
        out[c] = pd.to_datetime((out[c].astype(float) * 1e6).round().astype("int64"), unit="us")
    for i, k in enumerate(keys.columns):
        out.insert(i, k, keys[k].iloc[0] if len(keys) else None)
    return out


def merging(keys: list[str], closes: Callable[[list[float]], bool], quote: bool = False, machine: Machine | None = None) -> Step:
    """Step that merges rows ``ts, open, high, low, close, volume`` into a working bar until ``closes(bar)``.

    A working bar is [start, end, open, high, low, close, volume, rows]. A quote bar keeps the range of its first quote.
    """

    def step(rows: pd.DataFrame, state):
        bar, closed = list(state) if state else [], []
        for t, o, h, l, c, v in zip(_seconds(rows["ts"]), *(rows[x].astype(float) for x in ("open", "high", "low", "close", "volume"))):
            if not bar:
                bar = [t, t, o, h, l, c, v, 1.0]
            elif quote:
                bar[1], bar[5], bar[7] = t, c, bar[7] + 1
            else:
                bar = [bar[0], t, bar[2], max(bar[3], h), min(bar[4], l), c, bar[6] + v, bar[7] + 1]
            if closes(bar):
                closed.append(bar[:7])
                bar = []
        return _bars(rows[keys], closed), bar

    step.machine = machine
    return step


def time_step(keys: list[str], seconds: float) -> Step:
    """Bar opens at its first row and closes at the first row at least ``seconds`` later, that row included."""
    return merging(keys, lambda b: b[1] - b[0] >= seconds, machine=Bars(seconds=seconds))


def count_step(keys: list[str], n: int) -> Step:
    return merging(keys, lambda b: b[7] >= n)


def range_step(keys: list[str], size: float) -> Step:
    """Bar of prices that closes once its range reaches ``size``; the first row only opens it."""
    return merging(keys, lambda b: b[7] > 1 and b[3] - b[4] >= size, machine=Bars(size=size))


def quote_step(keys: list[str], seconds: float) -> Step:
    return merging(keys, lambda b: b[1] - b[0] >= seconds, quote=True, machine=Bars(seconds=seconds, quote=True))


def brick_step(keys: list[str]) -> Step:
    """Bricks on a price line measured in bricks from the first price (column ``brick``): state is the last brick edge."""

    def step(rows: pd.DataFrame, state):
        edge, out = (state[0] if state else None), []
        for t, x, v in zip(_seconds(rows["ts"]), rows["brick"].astype(float), rows["volume"].astype(float)):
            if edge is None:
                edge = float(int(x))
            side = 1.0 if x > edge else -1.0
            for _ in range(int(abs(x - edge) + 1e-9)):
                out.append([t, t, edge, max(edge, edge + side), min(edge, edge + side), edge + side, v])
                edge += side
        return _bars(rows[keys], out), ([] if edge is None else [edge])

    def bounds(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        x = rows["brick"].astype(float).to_numpy()
        return np.floor(x + 1e-9), np.ceil(x - 1e-9)

    step.machine = Clamp(bounds, lambda rows: float(int(rows["brick"].iloc[0])))
    return step


def _schema(df: DataFrame, keys: list[str]) -> T.StructType:
    return T.StructType([*[df.schema[k] for k in keys], *T._parse_datatype_string(BARS).fields])


def prices(df: DataFrame, price: str, volume: Column | str) -> DataFrame:
    """Ticks as one-price rows for the steps."""
    return df.withColumns({**{c: F.col(price).cast("double") for c in ("open", "high", "low", "close")}, "volume": (F.col(volume) if isinstance(volume, str) else volume).cast("double")})


def consolidate(df: DataFrame, axis: Axis, step: Callable[[list[str]], Step]) -> DataFrame:
    """Closed bars of a table of rows; ``step`` is called with the key columns."""
    keys = list(axis.key)
    run = step(keys)
    return fold(df, axis, run, _schema(df, keys), machine=getattr(run, "machine", None))


def count_bars(df: DataFrame, axis: Axis, n: int) -> DataFrame:
    """Bars of ``n`` rows by position, without a state: a group per ``n`` rows, the incomplete tail dropped."""
    rows = number(df, axis).withColumn("_bar", F.floor((F.col(POS) - 1) / n))
    at = F.struct(*axis.order)
    return (
        rows.groupBy(*axis.key, "_bar")
        .agg(
            F.min(axis.order[0]).alias("start"), F.max(axis.order[0]).alias("end"), F.min_by("open", at).alias("open"), F.max("high").alias("high"),
            F.min("low").alias("low"), F.max_by("close", at).alias("close"), F.sum("volume").alias("volume"), F.count("*").alias("_n"),
        )
        .filter(F.col("_n") == n)
        .drop("_n", "_bar")
    )


def renko(df: DataFrame, axis: Axis, price: str, size: float) -> DataFrame:
    """Bricks of ``size`` counted from the first price of each series, several per row where the price jumps."""
    keys = list(axis.key)
    first = df.groupBy(*keys).agg(F.min_by(price, F.struct(*axis.order)).cast("double").alias("_first"))
    rows = df.join(first, keys).withColumn("brick", (F.col(price) - F.col("_first")) / size)
    run = brick_step(keys)
    bricks = fold(rows, axis, run, _schema(df, keys), machine=run.machine)
    level = lambda c: (F.col("_first") + F.col(c) * size).alias(c)
    return bricks.join(first, keys).select(*keys, "start", "end", *[level(c) for c in ("open", "high", "low", "close")], "volume")


def consolidate_stream(stream: DataFrame, keys: list[str], step: Callable[[list[str]], Step]) -> DataFrame:
    """Closed bars of a stream; the working bar of each key is kept as state between batches."""
    run = step(keys)
    names = [f.name for f in _schema(stream, keys).fields]

    def update(key, batches, state):
        rows = pd.concat(list(batches)).sort_values("ts")
        held = list(state.get[0]) if state.exists else None
        bars, bar = run(rows, held)
        state.update(([float(x) for x in bar],))
        yield bars[names]

    return stream.groupBy(*keys).applyInPandasWithState(update, _schema(stream, keys), "bar array<double>", "append", "NoTimeout")
