"""Ordered work over long series, split so that no key has to fit into one task.

A series is the set of rows of one key (``Axis.key``), ordered by ``Axis.order``.  A key may hold any
share of the table, so nothing here groups by the key alone except tables of one row per block.

* :func:`blocked` cuts a series into blocks of equal row count and copies the few rows a bounded frame
  reaches back (or ahead) into the neighbouring block.  Frames inside a block equal frames over the series.
* :func:`prefix` computes running sums, extremes and last known values: inside time buckets first, then
  over one row per bucket, then joined back.
* :func:`smooth` runs exponential averages on blocks; the copied rows are chosen long enough for the
  weight of anything older to vanish below double precision.
* :func:`linear_scan` solves y[t] = a[t] * y[t-1] + b[t] exactly by composing one (a, b) pair per bucket.
* :func:`fold` runs a state machine per bucket; a machine with composable summaries (``machines``) gets the first state of each bucket
  from a parallel prefix over them, any other repeats the buckets whose start state turned out
  to differ from the end state of the bucket before, until every hand-over agrees.
"""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, replace

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.operators.machines import Machine
from candlewick.session import checkpoint_folder

POS, BLK, CORE, BUCKET = "_pos", "_blk", "_core", "_bucket"


@dataclass(frozen=True)
class Axis:
    """Key, order and cut of a series.

    ``span`` is the width in seconds of a time bucket.  It has to be small enough for the rows of one key in
    one bucket to fit a task: for bars that is ``span / bar width`` rows whatever the size of the table.
    ``rows`` is the block size of :func:`blocked`.
    """

    key: tuple[str, ...] = ("symbol",)
    order: tuple[str, ...] = ("ts",)
    span: int = 3600 * 32768
    rows: int = 32768

    def bucketed(self, df: DataFrame) -> DataFrame:
        first = F.col(self.order[0])
        kind = df.schema[self.order[0]].dataType
        if isinstance(kind, T.TimestampNTZType):
            first = first.cast("timestamp")
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            seconds = F.unix_seconds(first)
        elif isinstance(kind, T.DateType):
            seconds = F.unix_date(first).cast("long") * 86400
        else:
            seconds = first.cast("long")
        return df.withColumn(BUCKET, F.floor(seconds / F.lit(self.span)))

    def by(self, **kw) -> "Axis":
        return replace(self, **kw)


HOURLY = Axis()
DAILY = Axis(span=86400 * 32768)
MINUTE = Axis(span=60 * 32768)
TICK = Axis(order=("ts", "seq"), span=86400)


# --- shared shuffles ----------------------------------------------------------------------------------------

_SERIAL = itertools.count()


def shared(df: DataFrame, *keys: str | Column) -> DataFrame:
    """Shuffle by ``keys`` once for all branches of a self-join.

    Branches that need fewer columns would otherwise get a narrower copy of everything below the shuffle, that is,
    compute the input again.  An observed metric that touches every column keeps them equal, so Spark reuses the
    exchange: the input is computed once and its shuffle files are read by each branch.
    """
    rows = df.repartition(*keys)
    return rows.observe(f"shared_{next(_SERIAL)}", F.max(F.hash(*rows.columns)).alias("rows"))


# --- blocks -------------------------------------------------------------------------------------------------


def number(df: DataFrame, axis: Axis, out: str = POS, length: str | None = None) -> DataFrame:
    """1-based position of each row in its series and, if named, the number of rows of the series."""
    keys = [*axis.key, BUCKET]
    rows = shared(axis.bucketed(df), *keys)
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*axis.key).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        *keys,
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"),
        *([F.sum("_n").over(Window.partitionBy(*axis.key)).alias(length)] if length else []),
    )
    local = Window.partitionBy(*keys).orderBy(*axis.order)
    return (
        rows.withColumn("_local", F.row_number().over(local))
        .join(starts, keys)
        .withColumn(out, F.col("_start") + F.col("_local"))
        .drop("_start", "_local", BUCKET)
    )


def blocked(df: DataFrame, axis: Axis, back: int = 0, ahead: int = 0) -> DataFrame:
    """Rows with position, block id and a core flag; a block also holds ``back`` / ``ahead`` border rows."""
    size = max(axis.rows, 4 * (back + ahead), 1)
    rows = df if POS in df.columns else number(df, axis)
    at = F.col(POS) - 1
    own = F.floor(at / F.lit(size))
    if not back and not ahead:
        return rows.withColumn(BLK, own).withColumn(CORE, F.lit(True))
    first = F.greatest(F.floor((at - ahead) / F.lit(size)), F.lit(0))
    last = F.floor((at + back) / F.lit(size))
    return rows.withColumn(BLK, F.explode(F.sequence(first, last))).withColumn(CORE, F.col(BLK) == own)


def span_of(axis: Axis) -> WindowSpec:
    """Ordered window over one block."""
    return Window.partitionBy(*axis.key, BLK).orderBy(POS)


def core(df: DataFrame, keep_pos: bool = False) -> DataFrame:
    """Drop border rows and helper columns."""
    out = df.filter(CORE).drop(BLK, CORE)
    return out if keep_pos else out.drop(POS)


def over_blocks(
    df: DataFrame,
    axis: Axis,
    steps: Callable[[WindowSpec], Mapping[str, Column]] | Sequence[Callable[[WindowSpec], Mapping[str, Column]]],
    back: int = 0,
    ahead: int = 0,
    keep_pos: bool = False,
) -> DataFrame:
    """Add columns with bounded frames.  Later steps may use the columns of earlier ones; ``back`` / ``ahead``
    cover the sum of all frames."""
    out = blocked(df, axis, back, ahead)
    w = span_of(axis)
    for step in [steps] if callable(steps) else steps:
        out = out.withColumns(dict(step(w)))
    return core(out, keep_pos)


def trailing(w: WindowSpec, n: int) -> WindowSpec:
    """The last ``n`` rows including the current one."""
    return w.rowsBetween(-(n - 1), 0)


def full(value: Column, x: Column | str, w: WindowSpec, n: int) -> Column:
    """``value`` only where the last ``n`` rows all hold a value of ``x``."""
    x = F.col(x) if isinstance(x, str) else x
    return F.when(F.count(x).over(trailing(w, n)) == n, value)


def stretch(name: str, w: WindowSpec, step: int, parts: int, skip: int = 0) -> list[Column]:
    """Values of ``name``, which covers the last ``step`` rows, that together cover a long frame ending ``skip`` rows back.

    A frame of n rows costs n steps per row; the same in two levels costs ``step + parts``.
    """
    return [F.lag(name, skip + i * step).over(w) if skip + i else F.col(name) for i in range(parts)]


def added(parts: Sequence[Column]) -> Column:
    """Sum of the non-null parts, null without any."""
    total = functools.reduce(lambda a, b: a + b, [F.coalesce(p, F.lit(0)) for p in parts])
    return F.when(F.coalesce(*parts).isNotNull(), total)


def over_time(
    df: DataFrame, axis: Axis, seconds: int, steps: Callable[[WindowSpec], Mapping[str, Column]]
) -> DataFrame:
    """Add columns whose frame is the last ``seconds`` of time, open on the left: (t - seconds, t].

    Rows are copied to the next time buckets they are visible from, so frames never leave a bucket.
    """
    axis = axis.by(span=max(axis.span, 4 * seconds))
    rows = axis.bucketed(df).withColumn("_us", F.unix_micros(F.col(axis.order[0]).cast("timestamp")))
    last = F.floor((F.col("_us") / 1e6 + seconds) / F.lit(axis.span))
    rows = rows.withColumn(BLK, F.explode(F.sequence(F.col(BUCKET), F.greatest(last, F.col(BUCKET)))))
    w = Window.partitionBy(*axis.key, BLK).orderBy("_us").rangeBetween(-seconds * 1_000_000 + 1, 0)
    out = rows.withColumns(dict(steps(w)))
    return out.filter(F.col(BLK) == F.col(BUCKET)).drop(BLK, BUCKET, "_us")


# --- prefixes -----------------------------------------------------------------------------------------------

Running = tuple[str, "Column | str"]


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def prefix(
    df: DataFrame,
    axis: Axis,
    specs: Mapping[str, Running],
    exclusive: bool = False,
    backward: bool = False,
) -> DataFrame:
    """Running values from the start of each series (from its end with ``backward``).

    ``specs`` maps an output name to ``(kind, input)`` with kind ``sum``, ``max``, ``min``, ``count``, ``last``
    (nearest non-null value) or ``first`` (first non-null value).  ``exclusive`` leaves the current row out.
    """
    keys = [*axis.key, BUCKET]
    rows = axis.bucketed(df).withColumns({f"_i_{n}": _column(c) for n, (_, c) in specs.items()})
    rows = shared(rows, *keys)
    rank = F.struct(*axis.order)
    way = F.desc if backward else F.asc

    def total(kind: str, c: str) -> Column:
        if kind in ("last", "first"):
            newest = (kind == "last") != backward
            return (F.max_by if newest else F.min_by)(c, F.when(F.col(c).isNotNull(), rank))
        return getattr(F, kind)(c)

    def running(kind: str, c: str, w: WindowSpec) -> Column:
        if kind in ("last", "first"):
            return getattr(F, kind)(c, ignorenulls=True).over(w)
        return getattr(F, kind)(c).over(w)

    def merge(kind: str, old: Column, new: Column) -> Column:
        if kind in ("sum", "count"):
            both = F.coalesce(old, F.lit(0)) + F.coalesce(new, F.lit(0))
            return both if kind == "count" else F.when(old.isNotNull() | new.isNotNull(), both)
        if kind == "max":
            return F.greatest(old, new)
        if kind == "min":
            return F.least(old, new)
        return F.coalesce(new, old) if kind == "last" else F.coalesce(old, new)

    totals = rows.groupBy(*keys).agg(*[total(k, f"_i_{n}").alias(f"_t_{n}") for n, (k, _) in specs.items()])
    upto = Window.partitionBy(*axis.key).orderBy(way(BUCKET)).rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(
        *keys,
        *[running("sum" if k == "count" else k, f"_t_{n}", upto).alias(f"_c_{n}") for n, (k, _) in specs.items()],
    )
    inside = (
        Window.partitionBy(*keys)
        .orderBy(*[way(c) for c in axis.order])
        .rowsBetween(Window.unboundedPreceding, -1 if exclusive else 0)
    )
    out = rows.withColumns({f"_l_{n}": running(k, f"_i_{n}", inside) for n, (k, _) in specs.items()})
    out = out.join(carry, keys)
    out = out.withColumns({n: merge(k, F.col(f"_c_{n}"), F.col(f"_l_{n}")) for n, (k, _) in specs.items()})
    return out.drop(BUCKET, *[p + n for n in specs for p in ("_i_", "_l_", "_c_")])


def whole(df: DataFrame, axis: Axis, specs: Mapping[str, Column]) -> DataFrame:
    """Attach aggregates over the whole series: partial aggregation, one row per key joined back."""
    totals = df.groupBy(*axis.key).agg(*[c.alias(n) for n, c in specs.items()])
    return df.join(totals, list(axis.key))


def whole_by(df: DataFrame, keys: Sequence[str], specs: Mapping[str, Column]) -> DataFrame:
    """Like a window without order: aggregates per ``keys`` joined back to the rows (null keys included)."""
    totals = df.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(*[c.alias(n) for n, c in specs.items()])
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return df.join(totals, on).drop(*[f"_k_{k}" for k in keys])


# --- exponential smoothing ----------------------------------------------------------------------------------


def memory(alpha: float, digits: float = 20.0) -> int:
    """Rows after which an exponential weight has shrunk by ``digits`` decimal digits."""
    if alpha >= 1:
        return 1
    return int(math.ceil(digits * math.log(10) / -math.log1p(-alpha))) + 1


def span_alpha(n: float) -> float:
    return 2.0 / (n + 1.0)


Smoothing = tuple  # (out, input, alpha) or (out, input, alpha, "mean" | "adjusted" | "std")


def smooth(blocks: DataFrame, axis: Axis, chain: Iterable[Smoothing], min_periods: int = 1) -> DataFrame:
    """Add exponential averages ``(out, input, alpha)`` to rows made by :func:`blocked`.

    The recurrence starts at the first value: y = alpha * x + (1 - alpha) * y.  A chain may feed one output
    into the next.  The caller passes ``back`` = sum of :func:`memory` along the longest chain.  A fourth item
    "adjusted" asks for the mean with weights (1 - alpha)^age, "std" for its bias-corrected deviation.
    """
    chain = [(*c, "mean") if len(c) == 3 else tuple(c) for c in chain]
    names = [c[0] for c in chain]
    schema = T.StructType(blocks.schema.fields + [T.StructField(n, T.DoubleType()) for n in names])

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(POS)
        for out, source, alpha, kind in chain:
            x = part[source].astype("float64")
            if kind == "std":
                part[out] = x.ewm(alpha=alpha).std()
            elif kind == "adjusted":
                part[out] = x.ewm(alpha=alpha).mean()
            else:
                part[out] = x.ewm(alpha=alpha, adjust=False, min_periods=min_periods).mean()
        return part

    return blocks.groupBy(*axis.key, BLK).applyInPandas(run, schema)


def smoothed(
    df: DataFrame,
    axis: Axis,
    chain: Iterable[Smoothing],
    before: Callable[[WindowSpec], Mapping[str, Column]] | None = None,
    after: Callable[[WindowSpec], Mapping[str, Column]] | None = None,
    reach: int = 0,
    min_periods: int = 1,
) -> DataFrame:
    """Window columns, exponential averages on them, window columns on those: one cut into blocks.

    ``reach`` is the number of rows the frames of ``before`` and ``after`` look back together.
    """
    chain = list(chain)
    depth: dict[str, int] = {}
    for c in chain:
        depth[c[0]] = depth.get(c[1], 0) + memory(c[2])
    out = blocked(df, axis, back=reach + max(depth.values()))
    w = span_of(axis)
    if before:
        out = out.withColumns(dict(before(w)))
    out = smooth(out, axis, chain, min_periods)
    if after:
        out = out.withColumns(dict(after(w)))
    return core(out)


# --- linear recurrences with a coefficient per row ----------------------------------------------------------


def linear_scan(df: DataFrame, axis: Axis, out: str, a: Column, b: Column) -> DataFrame:
    """y[t] = a[t] * y[t-1] + b[t], y before the first row = 0; a row with null a or b keeps y."""
    keys = [*axis.key, BUCKET]
    rows = axis.bucketed(df).withColumns({"_a": a.cast("double"), "_b": b.cast("double")})
    schema = T.StructType(
        rows.schema.fields + [T.StructField(n, T.DoubleType()) for n in ("_pa", "_pb")]
    )
    order = list(axis.order)

    def compose(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(order)
        gain, level, gains, levels = 1.0, 0.0, [], []
        for x, y in zip(part["_a"].to_numpy(), part["_b"].to_numpy()):
            if x == x and y == y:
                gain, level = gain * x, x * level + y
            gains.append(gain)
            levels.append(level)
        part["_pa"], part["_pb"] = gains, levels
        return part

    local = shared(rows.groupBy(*keys).applyInPandas(compose, schema), *keys)
    rank = F.struct(*axis.order)
    ends = local.groupBy(*keys).agg(F.max_by("_pa", rank).alias("_ea"), F.max_by("_pb", rank).alias("_eb"))
    carried = T.StructType([*[rows.schema[k] for k in keys], T.StructField("_in", T.DoubleType())])

    def hand_over(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(BUCKET)
        level, starts = 0.0, []
        for x, y in zip(part["_ea"], part["_eb"]):
            starts.append(level)
            level = x * level + y
        part["_in"] = starts
        return part[[*keys, "_in"]]

    carry = ends.groupBy(*axis.key).applyInPandas(hand_over, carried)
    return (
        local.join(carry, keys)
        .withColumn(out, F.col("_pa") * F.col("_in") + F.col("_pb"))
        .drop("_a", "_b", "_pa", "_pb", "_in", BUCKET)
    )


# --- state machines -----------------------------------------------------------------------------------------


def _walk(rows: DataFrame, states: DataFrame, stale: DataFrame, axis: Axis, end_state, schema: T.StructType) -> DataFrame:
    """States of all buckets, those of unsettled series from one walk along their sorted rows from the first stale bucket on."""
    key, keys = list(axis.key), [*axis.key, BUCKET]
    first = stale.groupBy(*key).agg(F.min(BUCKET).alias("_from"))
    given = stale.select(*keys, F.col("start").alias("_given"))
    todo = rows.join(first, key).filter(F.col(BUCKET) >= F.col("_from")).join(given, keys, "left")
    todo = todo.withColumn("_given", F.when(F.col(BUCKET) == F.col("_from"), F.col("_given"))).drop("_from")

    def walk(parts):
        held, at, state = [], None, None

        def close():
            nonlocal state
            part = pd.concat(held, ignore_index=True)
            start = part["_given"].iloc[0]
            start = state[1] if start is None else [float(v) for v in start]
            out = end_state(part.drop(columns="_given"), start)
            state = (at[:-1], out["end"].iloc[0])
            return out[schema.names]

        for batch in parts:
            for name, part in batch.groupby(keys, sort=False, dropna=False):
                name = tuple(name)
                if name != at and held:
                    yield close()
                    held = []
                at = name
                held.append(part)
        if held:
            yield close()

    walked = todo.repartition(*key).sortWithinPartitions(*keys, *axis.order).mapInPandas(walk, schema)
    kept = states.join(first, key, "left").filter(F.col("_from").isNull() | (F.col(BUCKET) < F.col("_from"))).drop("_from")
    return kept.unionByName(walked)

Step = Callable[[pd.DataFrame, "list[float] | None"], "tuple[pd.DataFrame, list[float]]"]


def _hand_over(summaries: DataFrame, axis: Axis, machine: Machine, fan: int) -> DataFrame:
    """First state of every bucket from the summaries of all buckets, composed in levels of at most ``fan`` neighbours.

    A task holds ``fan`` summaries; the number of levels is the logarithm of the number of buckets.
    """
    key, keys = list(axis.key), [*axis.key, BUCKET]
    parts = T._parse_datatype_string("array<array<double>>")
    state = T.ArrayType(T.DoubleType())
    key_fields = [summaries.schema[k] for k in keys]
    wide = lambda s: [[float(v) for v in part] for part in s]

    def merged(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("_at")
        whole = functools.reduce(machine.compose, map(wide, part["_sum"]))
        head = part.iloc[:1][keys].reset_index(drop=True)
        head["_sum"] = [whole]
        return head

    def started(part: pd.DataFrame, given: list[float] | None) -> pd.DataFrame:
        part = part.sort_values(BUCKET)
        starts = []
        for s in part["_sum"]:
            starts.append(given)
            given = machine.advance(wide(s), given)
        out = part[keys].reset_index(drop=True)
        out["start"] = pd.Series(starts, dtype="object")
        return out

    def down(part: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        if part.empty or above.empty:
            return pd.DataFrame({f.name: [] for f in starts_schema.fields})
        given = above["start"].iloc[0]
        return started(part, None if given is None else [float(v) for v in given])

    starts_schema = T.StructType([*key_fields, T.StructField("start", state)])
    levels = [summaries]
    while levels[-1].groupBy(*key).count().agg(F.max("count")).first()[0] > fan:
        up = levels[-1].withColumns({"_at": F.col(BUCKET), BUCKET: F.floor(F.col(BUCKET) / fan)})
        levels.append(up.groupBy(*keys).applyInPandas(merged, T.StructType([*key_fields, T.StructField("_sum", parts)])).checkpoint())
    starts = levels.pop().groupBy(*key).applyInPandas(lambda part: started(part, None), starts_schema)
    while levels:
        level = levels.pop()
        group = level.withColumn("_up", F.floor(F.col(BUCKET) / fan)).groupBy(*key, "_up")
        starts = group.cogroup(starts.withColumnRenamed(BUCKET, "_up").groupBy(*key, "_up")).applyInPandas(down, starts_schema)
    return starts


def spans_buckets(df: DataFrame, axis: Axis) -> bool:
    """Whether any series has rows in several time buckets."""
    ends = axis.bucketed(df).groupBy(*axis.key).agg(F.min(BUCKET).alias("lo"), F.max(BUCKET).alias("hi"))
    return not ends.filter("hi > lo").isEmpty()


def fold(df: DataFrame, axis: Axis, step: Step, schema: T.StructType | str, rounds: int = 2, machine: Machine | None = None, near: float = 0.0, fan: int = 1024, split: bool | None = None) -> DataFrame:
    """Run ``step(rows, state) -> (result rows, state)`` along each series, bucket by bucket in parallel.

    ``state`` is ``None`` at the start of a series, else a list of doubles.  Every bucket is first run from
    ``None``; a bucket whose predecessor ended in another state than assumed is run again from that state.
    State machines that forget (a stop is hit, a bar closes) agree after ``rounds`` repetitions; the series of
    machines that remember (cash, a level) are then walked once in order, their sorted rows streaming through
    a task that holds one bucket at a time. So the number of passes does not depend on the number of buckets,
    the result is the one of a sequential run, and the input is computed once.

    With a ``machine`` that can summarise a stretch, nothing is repeated or walked: the summaries of all buckets give every first state.
    ``split`` tells whether any series spans several buckets, if the caller knows; otherwise it is looked up.
    ``near`` lets hand-overs agree that differ by that share of their value, for machines that forget without ever reaching equal bits.
    """
    keys = [*axis.key, BUCKET]
    spark = df.sparkSession
    rows = axis.bucketed(df)
    order = list(axis.order)
    if not isinstance(schema, T.StructType):
        schema = T._parse_datatype_string(schema)

    def fresh(part: pd.DataFrame) -> pd.DataFrame:
        return step(part.sort_values(order).reset_index(drop=True), None)[0]

    if not (spans_buckets(df, axis) if split is None else split):
        return rows.groupBy(*keys).applyInPandas(fresh, schema)

    checkpoint_folder(spark)
    rows = rows.checkpoint()
    key_fields = [rows.schema[k] for k in keys]
    arr = T.ArrayType(T.DoubleType())
    state_schema = T.StructType([*key_fields, T.StructField("start", arr), T.StructField("end", arr)])

    def end_state(part: pd.DataFrame, start) -> pd.DataFrame:
        _, end = step(part.sort_values(order).reset_index(drop=True), start)
        head = part.iloc[:1][keys].reset_index(drop=True)
        head["start"] = [start]
        head["end"] = [[float(v) for v in end]]
        return head

    def final(part: pd.DataFrame, given: pd.DataFrame) -> pd.DataFrame:
        start = given["start"].iloc[0]
        start = None if start is None else [float(v) for v in start]
        return step(part.sort_values(order).reset_index(drop=True), start)[0]

    if machine is not None:

        def summary(part: pd.DataFrame) -> pd.DataFrame:
            head = part.iloc[:1][keys].reset_index(drop=True)
            head["_sum"] = [machine.summarize(part.sort_values(order).reset_index(drop=True))]
            return head

        kind = T._parse_datatype_string("array<array<double>>")
        sums = rows.groupBy(*keys).applyInPandas(summary, T.StructType([*key_fields, T.StructField("_sum", kind)])).checkpoint()
        states = _hand_over(sums, axis, machine, fan)
        return rows.groupBy(*keys).cogroup(states.groupBy(*keys)).applyInPandas(final, schema)

    def agrees() -> Column:
        if not near:
            return F.col("want").eqNullSafe(F.col("start"))
        close = F.forall(F.arrays_zip("want", "start"), lambda z: F.abs(z["want"] - z["start"]) <= near * F.greatest(F.abs(z["want"]), F.abs(z["start"])))
        return F.col("want").eqNullSafe(F.col("start")) | F.coalesce(close & (F.size("want") == F.size("start")), F.lit(False))

    states = rows.groupBy(*keys).applyInPandas(lambda part: end_state(part, None), state_schema).checkpoint()
    chain = Window.partitionBy(*axis.key).orderBy(BUCKET)
    for done in range(rounds + 1):
        wanted = states.withColumn("want", F.lag("end").over(chain))
        stale = wanted.filter(~agrees()).select(*keys, F.col("want").alias("start"))
        stale = stale.checkpoint()
        if stale.isEmpty():
            break
        if done == rounds:
            states = _walk(rows, states, stale, axis, end_state, state_schema).checkpoint()
            break

        def again(part: pd.DataFrame, given: pd.DataFrame) -> pd.DataFrame:
            if part.empty or given.empty:
                return pd.DataFrame({f.name: [] for f in state_schema.fields})
            return end_state(part, [float(v) for v in given["start"].iloc[0]])

        todo = rows.join(stale.select(*keys), keys, "left_semi")
        redone = todo.groupBy(*keys).cogroup(stale.groupBy(*keys)).applyInPandas(again, state_schema)
        states = states.join(stale.select(*keys), keys, "left_anti").unionByName(redone).checkpoint()

    return rows.groupBy(*keys).cogroup(states.select(*keys, "start").groupBy(*keys)).applyInPandas(final, schema)
