"""Joins of series and tables: alignment, as-of, spine, event windows, pairs, radius."""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.functions.stats import t_p_value
from candlewick.operators.series import POS, Axis, number, over_blocks, prefix


def align(x: DataFrame, y: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    return x.join(y, list(on), how)


def combine_first(x: DataFrame, y: DataFrame, on: Sequence[str], value: str = "value") -> DataFrame:
    """All times of both; the value of ``x`` wins where it has one."""
    left = x.select(*on, F.col(value).alias("_x"))
    right = y.select(*on, F.col(value).alias("_y"))
    return left.join(right, list(on), "full").select(*on, F.coalesce("_x", "_y").alias(value))


def merge_all(frames: Sequence[DataFrame], on: Sequence[str], how: str = "outer", suffix: str = "_dup") -> DataFrame:
    """Merge several tables; a repeated column name gets the suffix as often as needed."""

    def step(left: DataFrame, right: DataFrame) -> DataFrame:
        taken = set(left.columns)
        for c in right.columns:
            if c not in on and c in taken:
                name = c + suffix
                while name in taken:
                    name += suffix
                right = right.withColumnRenamed(c, name)
        return left.join(right, list(on), how)

    return functools.reduce(step, frames)


def common_dates(frames: Sequence[DataFrame], on: str) -> list[DataFrame]:
    """Each table reduced to the dates all of them have."""
    shared = functools.reduce(DataFrame.intersect, [f.select(on) for f in frames])
    return [f.join(shared, on, "left_semi") for f in frames]


def compare(x: DataFrame, y: DataFrame, on: Sequence[str], value: str = "value") -> DataFrame:
    both = x.select(*on, F.col(value).alias("x")).join(y.select(*on, F.col(value).alias("y")), list(on))
    diff = F.col("x") - F.col("y")
    return both.withColumns({"diff": diff, "pct_diff": F.when(F.col("y") != 0, diff / F.col("y") * 100)})


def dataset_diff(a: DataFrame, b: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """Records added, removed and changed between two datasets, as JSON before / after.

    Of records with the same key the last one by ``order`` counts.
    """

    def keyed(df: DataFrame, name: str) -> DataFrame:
        record = F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"})
        rows = df.select(F.col(key).cast("string").alias("key"), record.alias(name), F.col(order or key).alias("_o"))
        return rows.groupBy("key").agg(F.max_by(name, F.struct("_o", name)).alias(name))

    both = keyed(a, "before").join(keyed(b, "after"), "key", "full")
    kind = F.when(F.col("before").isNull(), "added").when(F.col("after").isNull(), "removed").otherwise("changed")
    return both.withColumn("change", kind).filter((F.col("change") != "changed") | (F.col("before") != F.col("after")))


def spine(df: DataFrame, entity: str, time: str, seconds: int, chunk: int = 4096) -> DataFrame:
    """Regular grid per entity from its first to its last time, with the observations that fall on it.

    The grid is made chunk by chunk, so a long entity spreads over tasks.
    """
    ends = df.groupBy(entity).agg(
        F.unix_micros(F.min(F.col(time).cast("timestamp"))).alias("_lo"),
        F.unix_micros(F.max(F.col(time).cast("timestamp"))).alias("_hi"),
    )
    step = seconds * 1_000_000
    steps = F.floor((F.col("_hi") - F.col("_lo")) / step)
    parts = ends.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(steps / chunk))))
    parts = parts.repartition(entity, "_part")
    first = F.col("_part") * chunk
    at = F.explode(F.sequence(first, F.least(first + chunk - 1, steps)))
    grid = parts.withColumn("_i", at).select(entity, F.timestamp_micros(F.col("_lo") + F.col("_i") * step).alias(time))
    return grid.join(df.withColumn(time, F.col(time).cast("timestamp")), [entity, time], "left")


def asof(left: DataFrame, right: DataFrame, axis: Axis, columns: Sequence[str], strict: bool = False) -> DataFrame:
    """The latest row of ``right`` at or before (``strict``: before) the time of each row of ``left``.

    Both sides are laid on one time line and the last known right row is carried forward by the prefix kernel,
    so neither side is broadcast and a hot key is split by time.
    """
    ts = axis.order[0]
    extra = [c for c in left.columns if c not in (*axis.key, ts)]
    lefts = left.select(
        *axis.key, ts, F.struct(*extra).alias("_left") if extra else F.lit(True).alias("_left"),
        F.lit(0 if strict else 1).alias("_side"),
        F.lit(None).cast(T.StructType([right.schema[c] for c in columns])).alias("_right"),
    )
    rights = right.select(
        *axis.key, ts, F.lit(None).cast(lefts.schema["_left"].dataType).alias("_left"),
        F.lit(1 if strict else 0).alias("_side"), F.struct(*columns).alias("_right"),
    )
    line = lefts.unionByName(rights)
    line = prefix(line, axis.by(order=(ts, "_side")), {"_known": ("last", "_right")})
    out = line.filter(F.col("_left").isNotNull())
    keep = [F.col(f"_left.{c}").alias(c) for c in extra]
    return out.select(*axis.key, ts, *keep, *[F.col(f"_known.{c}").alias(c) for c in columns])


def benchmark_pairs(portfolio: DataFrame, benchmark: DataFrame, on: str, market: str = "all", bench: str = "bench") -> DataFrame:
    """Returns on common dates; "bull" keeps rising, "bear" falling benchmark dates."""
    both = portfolio.join(benchmark, on)
    if market == "bull":
        return both.filter(F.col(bench) > 0)
    if market == "bear":
        return both.filter(F.col(bench) < 0)
    return both


def comparable_deals(
    deals: DataFrame, multiples: DataFrame, industry: str, low: float, high: float, start: str, end: str, limit: int = 20
) -> DataFrame:
    """Newest completed deals of an industry in a value and date range, with their multiples."""
    found = deals.filter(
        (F.col("industry") == industry)
        & F.col("deal_value").between(low, high)
        & F.col("announcement_date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
        & (F.col("deal_status") == "Completed")
    )
    return found.join(multiples, "deal_id", "left").orderBy(F.desc("announcement_date"), "deal_id").limit(limit)


def _around(rows: DataFrame, events: DataFrame, axis: Axis, low: int, high: int) -> DataFrame:
    """Rows at positions event + low … event + high of each event, by equi-join on the position."""
    key, ts = list(axis.key), axis.order[0]
    at = rows.join(events.select(*key, ts), [*key, ts], "left_semi")
    at = at.select(*key, F.col(ts).alias("event_ts"), F.col(POS).alias("_e"))
    wanted = at.withColumn(POS, F.explode(F.sequence(F.col("_e") + low, F.col("_e") + high)))
    return wanted.join(rows, [*key, POS])


def event_study(
    returns: DataFrame, events: DataFrame, axis: Axis, value: str = "ret", estimation: int = 250, window: int = 21
) -> DataFrame:
    """Abnormal and cumulative abnormal return around each event against the mean of the bars before it."""
    half = window // 2
    rows = number(returns.filter(F.col(value).isNotNull()).select(*axis.key, *axis.order, value), axis)
    rows = _around(rows, events, axis, -estimation - half, half)
    x = F.col(value)
    before = F.when(F.col(POS) < F.col("_e") - half, x)
    inside = F.when(F.col(POS) >= F.col("_e") - half, x)
    out = rows.groupBy(*axis.key, "event_ts").agg(
        F.avg(before).alias("expected"),
        F.stddev_samp(before).alias("_sd"),
        F.count(before).alias("n_estimation"),
        F.sum(inside).alias("_sum"),
        F.count(inside).alias("n_event"),
        F.max("_e").alias("_e"),
    )
    out = out.filter(F.col("_e") > half + 1)
    car = F.col("_sum") - F.col("n_event") * F.col("expected")
    out = out.withColumns({"car": car, "avg_abnormal": car / F.col("n_event")})
    return out.withColumn("t_stat", F.col("avg_abnormal") / (F.col("_sd") / F.sqrt("n_event"))).drop("_sd", "_sum", "_e")


def event_significance(study: DataFrame, level: float = 0.05) -> DataFrame:
    """Two-sided p-value per event (degrees of freedom: estimation bars - 1)."""
    p = t_p_value(F.col("t_stat"), (F.col("n_estimation") - 1).cast("double"))
    return study.withColumn("p_value", p).withColumn("significant", F.col("p_value") < level)


def post_event_drift(
    returns: DataFrame, events: DataFrame, axis: Axis, value: str = "ret", periods: Sequence[int] = (5, 10, 20, 60)
) -> DataFrame:
    """Compounded return over the bars after each event, averaged per period with its t statistic."""
    rows = number(returns.filter(F.col(value).isNotNull()).select(*axis.key, *axis.order, value), axis)
    around = _around(rows, events, axis, 1, max(periods))
    steps = F.col(POS) - F.col("_e")
    per = around.groupBy(*axis.key, "event_ts").agg(
        *[
            F.when(F.count_if(steps <= p) == p, F.exp(F.sum(F.when(steps <= p, F.log1p(value)))) - 1).alias(str(p))
            for p in periods
        ]
    )
    long = per.unpivot([*axis.key, "event_ts"], [str(p) for p in periods], "period", "drift")
    return long.filter("drift IS NOT NULL").groupBy(F.col("period").cast("int").alias("period")).agg(
        F.avg("drift").alias("average_drift"),
        F.stddev_pop("drift").alias("drift_std"),
        (F.avg("drift") / (F.stddev_pop("drift") / F.sqrt(F.count(F.lit(1))))).alias("t_stat"),
        F.count(F.lit(1)).alias("sample_size"),
    )


def triangles(quotes: DataFrame) -> DataFrame:
    """Currency triangles a < b < c from pairs (base, quote, bid, ask) whose round trip gains in one direction."""
    ab = quotes.filter("base < quote").select(F.col("base").alias("a"), F.col("quote").alias("b"), F.col("bid").alias("bid1"), F.col("ask").alias("ask1"))
    bc = quotes.filter("base < quote").select(F.col("base").alias("b"), F.col("quote").alias("c"), F.col("bid").alias("bid2"), F.col("ask").alias("ask2"))
    ca = quotes.filter("base > quote").select(F.col("base").alias("c"), F.col("quote").alias("a"), F.col("bid").alias("bid3"), F.col("ask").alias("ask3"))
    rows = ab.join(bc, "b").join(ca, ["c", "a"])
    rows = rows.withColumns(
        {
            "forward": F.col("ask1") * F.col("ask2") * F.col("bid3"),
            "reverse": F.col("ask3") * (1 / F.col("bid2")) * (1 / F.col("bid1")),
        }
    )
    best = F.greatest("forward", "reverse")
    return rows.filter(best > 1).select(
        "a", "b", "c", "forward", "reverse",
        F.when(F.col("forward") > F.col("reverse"), "forward").otherwise("reverse").alias("best_path"),
        ((best - 1) * 100).alias("profit_pct"),
    )


def normalised_symbol(c: Column) -> Column:
    return F.upper(F.regexp_replace(c, "[/_:\\-]", ""))


def _prefixes(c: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.length(c)), lambda n: F.substring(c, F.lit(1), n))


def match_symbols(wanted: DataFrame, known: DataFrame) -> DataFrame:
    """Best known symbol for each wanted one: exact (0), equal after normalising (1), prefix either way (2).

    Prefix matches are found by equi-joins on exploded prefixes, so no pair of symbols is tried in vain.
    """
    w = wanted.select("symbol").distinct().withColumn("_norm", normalised_symbol(F.col("symbol")))
    k = known.select(F.col("symbol").alias("match")).distinct().withColumn("_norm", normalised_symbol(F.col("match")))
    exact = w.join(k.drop("_norm"), F.col("symbol") == F.col("match")).select("symbol", "match", F.lit(0).alias("rank"))
    same = w.join(k, "_norm").select("symbol", "match", F.lit(1).alias("rank"))
    longer = k.select("match", F.explode(_prefixes(F.col("_norm"))).alias("_norm"))
    shorter = w.select("symbol", F.explode(_prefixes(F.col("_norm"))).alias("_norm"))
    fits = w.join(longer, "_norm").select("symbol", "match", F.lit(2).alias("rank")).unionByName(
        shorter.join(k, "_norm").select("symbol", "match", F.lit(2).alias("rank"))
    )
    best = exact.unionByName(same).unionByName(fits).groupBy("symbol").agg(F.min(F.struct("rank", "match")).alias("_b"))
    return w.select("symbol").join(best, "symbol", "left").select("symbol", F.col("_b.match").alias("match"), F.col("_b.rank").alias("rank"))


EARTH_KM = 6371.0


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column, cos1: Column | None = None, cos2: Column | None = None) -> Column:
    """Distance on the sphere; the cosines of the latitudes may be given."""
    dlat, dlon = F.radians(lat2 - lat1), F.radians(lon2 - lon1)
    cos1, cos2 = F.cos(F.radians(lat1)) if cos1 is None else cos1, F.cos(F.radians(lat2)) if cos2 is None else cos2
    a = F.pow(F.sin(dlat / 2), 2) + cos1 * cos2 * F.pow(F.sin(dlon / 2), 2)
    return EARTH_KM * 2 * F.atan2(F.sqrt(a), F.sqrt(F.greatest(1 - a, F.lit(0.0))))


REACHED = 2_000_000  # pairs compared by one piece of a cube


def within_radius(centres: DataFrame, points: DataFrame, km: float) -> DataFrame:
    """Points within ``km`` of each centre (columns lat, lon; other names must differ).

    Positions on the sphere are put into cubes of edge ``km / 2``; a point in reach lies in a cube whose nearest corner is,
    which also holds at the poles and the date line. Points of a cube that meets many centres are dealt to pieces, as many as its pairs need.
    A pair is settled by the chord between its two positions; only next to the border the distance itself decides.
    """
    edge = km / 2

    def placed(df: DataFrame, lat: str, lon: str, side: str) -> DataFrame:
        phi, lam = F.radians(lat), F.radians(lon)
        xyz = (F.cos(phi) * F.cos(lam), F.cos(phi) * F.sin(lam), F.sin(phi))
        df = df.withColumns({f"_{side}{i}": c * EARTH_KM for i, c in zip("xyz", xyz)}).withColumn(f"_{side}c", F.cos(phi))
        return df.withColumns({f"_{i}": F.floor(F.col(f"_{side}{i}") / edge) for i in "xyz"})

    cube = ["_x", "_y", "_z"]
    reach = F.array(*[F.lit(i) for i in range(-2, 3)])
    left = placed(centres.withColumnsRenamed({"lat": "c_lat", "lon": "c_lon"}), "c_lat", "c_lon", "l")
    away = F.lit(0.0)
    for i in "xyz":
        left = left.withColumn("_d", F.explode(reach)).withColumn(f"_{i}", F.col(f"_{i}") + F.col("_d")).drop("_d")
        gap = F.greatest(F.col(f"_{i}") * edge - F.col(f"_l{i}"), F.col(f"_l{i}") - (F.col(f"_{i}") + 1) * edge, F.lit(0.0))
        away = away + gap * gap
    left = left.filter(away <= km * km * (1 + 1e-9) + 1e-6)
    right = placed(points, "lat", "lon", "r")
    right = right.filter(" AND ".join(f"{c} IS NOT NULL" for c in cube))
    met = right.groupBy(*cube).agg(F.count("*").alias("_n")).hint("merge").join(left.groupBy(*cube).agg(F.count("*").alias("_m")), cube)
    met = met.select(*cube, (F.col("_n") * F.col("_m")).alias("_met"))
    pieces = F.ceil(F.col("_met") / REACHED)
    total = met.agg(F.sum("_met")).first()[0] or 0
    tasks = max(1, min(4096, math.ceil(total / (4 * REACHED))))
    cut = met.select(*cube, pieces.alias("_pieces"))
    left = left.hint("merge").join(cut, cube).withColumn("_piece", F.explode(F.sequence(F.lit(1).cast("long"), "_pieces"))).drop("_pieces")
    right = right.hint("merge").join(cut, cube).withColumn("_piece", F.pmod(F.xxhash64(*points.columns), F.col("_pieces")) + 1).drop("_pieces")
    on = [*cube, "_piece"]
    if tasks > 1:  # small inputs may give many pairs, so their size in bytes does not tell the number of tasks
        left, right = left.repartition(tasks, *on), right.repartition(tasks, *on)
    x, y, z = (F.col(f"_l{i}") - F.col(f"_r{i}") for i in "xyz")
    chord = x * x + y * y + z * z
    border = (2 * EARTH_KM * math.sin(min(km / (2 * EARTH_KM), math.pi / 2))) ** 2
    km_apart = haversine(F.col("c_lat"), F.col("c_lon"), F.col("lat"), F.col("lon"), F.col("_lc"), F.col("_rc"))
    near = (chord <= border * (1 - 1e-9) - 1e-6) | ((chord <= border * (1 + 1e-9) + 1e-6) & (km_apart <= km))
    found = left.hint("merge").join(right, on).filter(near).withColumn("distance_km", km_apart)
    return found.drop(*on, *[f"_{s}{i}" for s in "lr" for i in "xyzc"])


PAIR_SCHEMA = "a string, b string, n double, sx double, sy double, sxx double, syy double, sxy double"


BLOCK_SYMBOLS = 1024  # of one side of a piece: the sums of its pairs take 50 MB
CHUNK_TIMES = 4096  # of a piece: its dense values take 200 MB
SPARSE = 0.05  # share of filled cells below which a piece lists the pairs of each time instead of multiplying matrices
PAIRS = 2_000_000  # listed at once


HELD_ROWS = 8_000_000  # of the two stacks of blocks that a task holds: 128 MB


def plan_pieces(df: DataFrame, time: str, symbol: str) -> tuple[int, int, int]:
    """Symbol blocks, time chunks and stacks of blocks from (approximate) counts, so that a piece has a bounded size whatever the universe and the history are.

    There are at least as many pieces as tasks that run at once, as far as there are times. A task takes two stacks, so every value travels once per stack: there are
    no more of them than give each core some tasks, or than fit into a task.
    """
    n = df.agg(F.approx_count_distinct(symbol).alias("s"), F.approx_count_distinct(time).alias("t"), F.count("*").alias("n")).first()
    blocks = max(1, math.ceil(n["s"] / BLOCK_SYMBOLS))
    cores = df.sparkSession.sparkContext.defaultParallelism
    wanted = math.ceil(cores / (blocks * (blocks + 1) / 2))
    times = max(1, math.ceil(n["t"] / CHUNK_TIMES), min(wanted, math.ceil(n["t"] / 32)))
    busy = math.ceil(math.sqrt(2 * 4 * cores / times))  # stacks * (stacks + 1) / 2 tasks for each chunk of times
    return blocks, times, max(1, min(blocks, max(busy, math.ceil(2 * n["n"] / times / HELD_ROWS))))


def _dense(t: np.ndarray, s: np.ndarray, x: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[np.ndarray]:
    """n, Σx, Σy, Σx², Σy², Σxy of each pair of a left and a right symbol by matrix products over the times."""

    def filled(own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.full(max(left.max(), right.max()) + 1, -1)
        at[own] = np.arange(len(own))
        hold = at[s] >= 0
        values, known = np.zeros((t.max() + 1, len(own))), np.zeros((t.max() + 1, len(own)))
        values[t[hold], at[s[hold]]], known[t[hold], at[s[hold]]] = x[hold], 1.0
        return values, known

    v, k = filled(left)
    w, m = (v, k) if left is right else filled(right)
    return [k.T @ m, v.T @ m, k.T @ w, (v * v).T @ m, k.T @ (w * w), v.T @ w]


def _listed(t: np.ndarray, s: np.ndarray, x: np.ndarray, n: int) -> list[np.ndarray]:
    """The same for a first symbol not after the second, from the pairs present at each time."""
    order = np.lexsort((s, t))
    t, s, x = t[order], s[order], x[order]
    many = np.searchsorted(t, t, side="right") - np.arange(len(t))  # partners of each row: itself and those after it
    out = [np.zeros(n * n) for _ in range(6)]
    ends = np.cumsum(many)
    at = 0
    while at < len(t):
        until = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS, side="right")))
        left = np.repeat(np.arange(at, until), many[at:until])
        right = left + np.arange(len(left)) - np.repeat(ends[at:until] - many[at:until] - (ends[at - 1] if at else 0), many[at:until])
        code, a, b = s[left] * n + s[right], x[left], x[right]
        for total, w in zip(out, (None, a, b, a * a, b * b, a * b)):
            total += np.bincount(code, w, n * n)
        at = until
    return [total.reshape(n, n) for total in out]


def _both(sums: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> list[np.ndarray]:
    """Listed sums, which are held once per pair, as those of each left with each right symbol."""
    n, sx, sy, sxx, syy, sxy = sums
    at, to = np.ix_(left, right), (right[None, :], left[:, None])
    first = left[:, None] <= right[None, :]
    pick = lambda p, q: np.where(first, p[at], q[to])
    return [pick(n, n), pick(sx, sy), pick(sy, sx), pick(sxx, syy), pick(syy, sxx), pick(sxy, sxy)]


def pair_sums(df: DataFrame, time: str, symbol: str, value: str, blocks: int | None = None, times: int | None = None) -> DataFrame:
    """n, Σx, Σy, Σx², Σy², Σxy over common times for every pair of symbols a ≤ b; of rows equal in time and symbol one counts.

    A matrix product in pieces: each piece holds two symbol blocks over one chunk of times and emits one row per
    symbol pair (not per pair and time). Pieces of one chunk hold different pairs; several chunks are summed map-side.  The number of pieces comes
    from :func:`plan_pieces` unless given; pieces with few filled cells list the pairs of each time instead. A symbol's values travel as one row
    per chunk and stack: a task takes two stacks of blocks and goes through the pieces of their blocks one by one. Rows without a time or a symbol meet nothing.
    """
    stacks = blocks
    if blocks is None or times is None:
        planned = plan_pieces(df, time, symbol)
        blocks, times = blocks or planned[0], times or planned[1]
        stacks = min(blocks, planned[2])
    stamp = F.unix_micros(F.col(time).cast("timestamp"))
    rows = df.filter(F.col(value).isNotNull() & F.col(time).isNotNull() & F.col(symbol).isNotNull()).select(
        F.col(symbol).cast("string").alias("s"),
        stamp.alias("t"),
        F.col(value).cast("double").alias("x"),
        F.pmod(F.xxhash64(symbol), F.lit(blocks)).cast("int").alias("_own"),
        F.pmod(F.xxhash64(stamp), F.lit(times)).cast("int").alias("_chunk"),
    )
    rows = rows.groupBy("s", "_own", "_chunk").agg(F.collect_list(F.struct("t", "x")).alias("_v"))
    rows = rows.select("s", "_own", "_chunk", F.col("_v.t").alias("t"), F.col("_v.x").alias("x"), (F.col("_own") % stacks).alias("_stack"))
    other = F.explode(F.sequence(F.lit(0), F.lit(stacks - 1)))
    rows = rows.withColumn("_o", other).withColumns({"_i": F.least("_stack", "_o"), "_j": F.greatest("_stack", "_o")}).drop("_o")

    def products(own: dict[int, list[np.ndarray]], i: int, j: int) -> pa.RecordBatch:
        """The pairs of two blocks, of which ``own`` holds names, values of each symbol, times and values."""
        held = [own[i]] if i == j else [own[i], own[j]]
        names, many, times_, x = (np.concatenate(v) for v in zip(*held))
        order = np.argsort(names, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        names, own_i = names[order], place[: len(own[i][0])]
        left = np.sort(own_i)
        right = left if i == j else np.sort(place[len(own_i) :])
        cols = np.repeat(place, many)
        here = np.zeros(times_.max() + 1, np.int64)
        here[times_] = 1
        rows = (np.cumsum(here) - 1)[times_]
        if len(x) < SPARSE * here.sum() * len(names):
            code = rows * len(names) + cols
            once = len(code) - 1 - np.unique(code[::-1], return_index=True)[1]
            sums = _both(_listed(rows[once], cols[once], x[once], len(names)), left, right)
        else:
            sums = _dense(rows, cols, x, left, right)
        n, sx, sy, sxx, syy, sxy = sums
        r, c = np.nonzero((n > 0) & (left[:, None] <= right[None, :])) if i == j else np.nonzero(n > 0)  # names are sorted
        swap = left[r] > right[c]
        first, second = np.where(swap, right[c], left[r]), np.where(swap, left[r], right[c])
        turned = lambda p, q: pa.array(np.where(swap, q[r, c], p[r, c]))
        words = pa.array(names, pa.string())
        return pa.RecordBatch.from_arrays(
            [
                words.take(pa.array(first)), words.take(pa.array(second)), pa.array(n[r, c]), turned(sx, sy), turned(sy, sx),
                turned(sxx, syy), turned(syy, sxx), pa.array(sxy[r, c]),
            ],
            ["a", "b", "n", "sx", "sy", "sxx", "syy", "sxy"],
        )

    def stacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """All pieces of two stacks of blocks, or of one."""
        parts = list(batches)
        at = lambda name: [p.column(p.schema.get_field_index(name)) for p in parts]
        plain = lambda name: np.concatenate([c.to_numpy(zero_copy_only=False) for c in at(name)])
        owner, names, stack = plain("_own"), plain("s"), plain("_stack")
        one, other = int(plain("_i")[0]), int(plain("_j")[0])
        many = np.concatenate([np.diff(c.offsets.to_numpy()) for c in at("t")])
        stamps, x = (np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in at(name)]) for name in ("t", "x"))
        del parts
        codes = np.unique(stamps, return_inverse=True)[1].astype(np.int32)
        del stamps
        ends, own, stack_of = np.cumsum(many), {}, {}
        for block in np.unique(owner):
            held = np.flatnonzero(owner == block)
            values = np.repeat(ends[held] - many[held] - (np.cumsum(many[held]) - many[held]), many[held]) + np.arange(many[held].sum())
            own[int(block)], stack_of[int(block)] = [names[held], many[held], codes[values], x[values]], int(stack[held[0]])
        del codes, x
        for i in own:
            for j in own:
                if stack_of[i] == one and stack_of[j] == other and (one != other or i <= j):
                    yield products(own, i, j)

    parts = rows.groupBy("_chunk", "_i", "_j").applyInArrow(stacked, PAIR_SCHEMA)
    return parts if times == 1 else parts.groupBy("a", "b").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")])


def pair_statistics(sums: DataFrame) -> DataFrame:
    """Sample covariance and correlation of each pair."""
    n = F.col("n")
    cov = (F.col("sxy") - F.col("sx") * F.col("sy") / n) / (n - 1)
    vx = (F.col("sxx") - F.col("sx") * F.col("sx") / n) / (n - 1)
    vy = (F.col("syy") - F.col("sy") * F.col("sy") / n) / (n - 1)
    out = sums.withColumns({"cov": F.when(n > 1, cov), "_vx": vx, "_vy": vy})
    corr = F.when((n > 1) & (F.col("_vx") > 0) & (F.col("_vy") > 0), F.col("cov") / F.sqrt(F.col("_vx") * F.col("_vy")))
    return out.withColumn("corr", corr).select("a", "b", F.col("n").cast("long").alias("n"), "cov", "corr")


def correlation_pairs(
    df: DataFrame, time: str, symbol: str, value: str, blocks: int | None = None, times: int | None = None
) -> DataFrame:
    return pair_statistics(pair_sums(df, time, symbol, value, blocks, times))


def value_holdings(holdings: DataFrame, quotes: DataFrame) -> DataFrame:
    """Holdings (portfolio, symbol, quantity, avg_price) at latest quotes (symbol, price, change): market value,
    cost, unrealised gain and weight.  Without a quote the average price counts."""
    price = F.coalesce(F.col("price"), F.col("avg_price"))
    rows = holdings.join(quotes, "symbol", "left").withColumns(
        {
            "current_price": price,
            "cost_basis": F.col("quantity") * F.col("avg_price"),
            "market_value": F.col("quantity") * price,
            "day_change": F.coalesce(F.col("change"), F.lit(0.0)) * F.col("quantity"),
        }
    )
    rows = rows.withColumn("unrealized_pnl", F.col("market_value") - F.col("cost_basis"))
    gain = F.when(F.col("cost_basis") > 0, F.col("unrealized_pnl") / F.col("cost_basis") * 100).otherwise(0.0)
    rows = rows.withColumn("unrealized_pct", gain)
    totals = rows.groupBy("portfolio").agg(F.sum("market_value").alias("_total"))
    weight = F.when(F.col("_total") > 0, F.col("market_value") / F.col("_total") * 100).otherwise(0.0)
    return rows.join(totals, "portfolio").withColumn("weight", weight).drop("_total", "price", "change")


def portfolio_totals(valued: DataFrame) -> DataFrame:
    mv, cost, day = F.sum("market_value"), F.sum("cost_basis"), F.sum("day_change")
    return valued.groupBy("portfolio").agg(
        mv.alias("market_value"),
        cost.alias("cost_basis"),
        (mv - cost).alias("unrealized_pnl"),
        F.when(cost > 0, (mv - cost) / cost * 100).otherwise(0.0).alias("unrealized_pct"),
        day.alias("day_change"),
        F.when(mv - day > 0, day / (mv - day) * 100).otherwise(0.0).alias("day_change_pct"),
        F.count_if(F.col("unrealized_pnl") >= 0).alias("gainers"),
        F.count_if(F.col("unrealized_pnl") < 0).alias("losers"),
        F.count(F.lit(1)).alias("positions"),
    )


def upsert_snapshot(snapshots: DataFrame, totals: DataFrame, day: Column) -> DataFrame:
    """Replace the snapshot of the same portfolio and day, keep the others."""
    new = totals.withColumn("date", day)
    old = snapshots.join(new.select("portfolio", "date"), ["portfolio", "date"], "left_anti")
    return old.unionByName(new, allowMissingColumns=True)
