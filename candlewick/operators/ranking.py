"""Exact ranks and quantiles of groups of any size.

Values are counted first (equal values collapse before the shuffle), then each group is cut into value bins: about one
percent of the value, a 1024th of the range of the group and one percent of the distance from its smallest value, whichever
is finest, so that values close together (an index level, a time) spread as well.  Ranks are running counts inside a bin plus
the count of all lower bins, so a group is never sorted or held by one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.operators.series import shared

BELOW, SAME, SIZE = "_below", "_same", "_size"


def _bin(v: Column, low: Column, high: Column) -> Column:
    """Number of a value's bin; each part grows with the value, and so does the whole."""
    size = F.floor(F.log2(F.abs(v)) * 64) + 80000
    relative = F.when(v > 0, size).when(v < 0, -size).otherwise(F.lit(0)).cast("long")
    share = F.when((high - low > 0) & (high - low < float("inf")), (v - low) / (high - low)).otherwise(0.0)
    linear = F.floor(share * 1023).cast("long")
    near = F.when(share > 0, F.greatest(F.floor(F.log2(share) * 64) + 8000, F.lit(0))).otherwise(0).cast("long")
    return (relative * 1024 + linear) * 8192 + near


def value_positions(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """Per group and distinct non-null value: rows below it, rows equal to it, rows of the group."""
    keys = list(group)
    counts = (
        df.filter(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
        .groupBy(*keys, value)
        .agg(F.count(F.lit(1)).alias(SAME))
    )
    v = F.col(value).cast("double")
    ends = counts.groupBy(*[F.col(k).alias(f"_e_{k}") for k in keys]).agg(F.min(v).alias("_low"), F.max(v).alias("_high"))
    if keys:
        same = F.lit(True)
        for k in keys:
            same = same & F.col(k).eqNullSafe(F.col(f"_e_{k}"))
        counts = counts.join(ends, same)
    else:
        counts = counts.crossJoin(F.broadcast(ends))  # one row
    counts = counts.withColumn("_bin", _bin(v, F.col("_low"), F.col("_high"))).drop("_low", "_high", *[f"_e_{k}" for k in keys])
    bins = counts.groupBy(*keys, "_bin").agg(F.sum(SAME).alias("_n"))
    lower = Window.partitionBy(*keys).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(*keys)
    bins = bins.select(
        *keys,
        "_bin",
        F.coalesce(F.sum("_n").over(lower), F.lit(0)).alias("_lower"),
        F.sum("_n").over(everything).alias(SIZE),
    )
    inside = Window.partitionBy(*keys, "_bin").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    on = F.lit(True)
    left = counts.withColumn("_in", F.coalesce(F.sum(SAME).over(inside), F.lit(0)))
    right = bins.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_bin").alias("_k_bin"), "_lower", SIZE)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    out = left.join(right, on & (F.col("_bin") == F.col("_k_bin")))
    return out.withColumn(BELOW, F.col("_lower") + F.col("_in")).select(*keys, value, BELOW, SAME, SIZE)


def with_positions(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """Attach below / same / size counts of ``value`` in its group to every row (null for null values)."""
    pos = value_positions(df, group, value)
    names = {c: f"_k_{c}" for c in [*group, value]}
    pos = pos.select(*[F.col(c).alias(n) for c, n in names.items()], BELOW, SAME, SIZE)
    on = F.col(value) == F.col(names[value])
    for g in group:
        on = on & F.col(g).eqNullSafe(F.col(names[g]))
    return df.join(pos, on, "left").drop(*names.values())


def rank_column(method: str = "average", ascending: bool = True) -> Column:
    """Rank from attached counts: ``min``, ``max`` or ``average`` of tied rows."""
    lower = F.col(BELOW) if ascending else F.col(SIZE) - F.col(BELOW) - F.col(SAME)
    if method == "min":
        return lower + 1
    if method == "max":
        return lower + F.col(SAME)
    return lower + (F.col(SAME) + 1) / F.lit(2.0)


def ranked(
    df: DataFrame, group: Sequence[str], value: str, out: str, method: str = "average", ascending: bool = True
) -> DataFrame:
    return with_positions(df, group, value).withColumn(out, rank_column(method, ascending)).drop(BELOW, SAME, SIZE)


def quantiles(df: DataFrame, group: Sequence[str], value: str, qs: dict[str, float]) -> DataFrame:
    """Exact quantiles with linear interpolation, one column per name; one row per group."""
    pos = value_positions(df, group, value)
    aggs = []
    for name, q in qs.items():
        at = F.lit(float(q)) * (F.col(SIZE) - 1)
        for side, k in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            hit = (F.col(BELOW) <= k) & (k < F.col(BELOW) + F.col(SAME))
            aggs.append(F.max(F.when(hit, F.col(value).cast("double"))).alias(f"_{side}_{name}"))
        aggs.append((F.lit(float(q)) * (F.max(SIZE) - 1)).alias(f"_at_{name}"))
    found = pos.groupBy(*group).agg(*aggs)
    cols = []
    for name in qs:
        lo, hi, at = F.col(f"_lo_{name}"), F.col(f"_hi_{name}"), F.col(f"_at_{name}")
        cols.append((lo + (hi - lo) * (at - F.floor(at))).alias(name))
    return found.select(*group, *cols)


def with_quantiles(df: DataFrame, group: Sequence[str], value: str, qs: dict[str, float]) -> DataFrame:
    """Attach group quantiles to the rows."""
    q = quantiles(df, group, value, qs)
    if not group:
        return df.crossJoin(F.broadcast(q))  # one row
    return df.join(q, list(group), "left")


def quantile_edges(n: int, prefix: str = "_e") -> dict[str, float]:
    return {f"{prefix}{i}": i / n for i in range(n + 1)}


def quantile_bucket(value: Column, n: int, prefix: str = "_e") -> Column:
    """0-based bucket of right-closed intervals between quantile edges, the lowest edge included."""
    bucket = F.lit(0)
    for i in range(1, n):
        bucket = bucket + F.when(value > F.col(f"{prefix}{i}"), 1).otherwise(0)
    return F.when(value.isNotNull() & F.col(f"{prefix}0").isNotNull(), bucket)


def top_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, salts: int = 32) -> DataFrame:
    """The first ``n`` rows per key by ``order`` with their rank.

    Each key is split by row hash; every piece keeps its first ``n``, the rest is ranked once more.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(salts)))
    piece = Window.partitionBy(*keys, "_salt").orderBy(*order)
    first = salted.withColumn("rank", F.row_number().over(piece)).filter(F.col("rank") <= n).drop("_salt", "rank")
    if not keys:
        first = first.withColumn("_all", F.lit(1))
    whole = Window.partitionBy(*(keys or ["_all"])).orderBy(*order)
    out = first.withColumn("rank", F.row_number().over(whole)).filter(F.col("rank") <= n)
    return out if keys else out.drop("_all")


COMMON = 100_000  # rows of one value beyond which it is numbered in pieces


def ordinals(df: DataFrame, group: Sequence[str], value: str, tie: Sequence[str], out: str, common: int = COMMON) -> DataFrame:
    """Number (from 1) of each row among those of its group with the same value, in the order of ``tie``; null values get none.

    A value of more than ``common`` rows is not numbered by one window: rows are dealt by ranges of (group, value, tie), numbered inside each range, and the
    counts of the ranges before are added.
    """
    keys = [*group, value]
    known = F.col(value).isNotNull()
    if df.filter(known).groupBy(*keys).count().filter(F.col("count") > common).isEmpty():
        apart = F.when(~known, F.pmod(F.xxhash64(*tie), F.lit(1024)))  # nulls are not numbered and need not meet
        return df.withColumn(out, F.when(known, F.row_number().over(Window.partitionBy(*keys, apart).orderBy(*tie))))
    ranged = df.repartitionByRange(*keys, *tie).withColumn("_piece", F.spark_partition_id())
    rows = shared(ranged, *keys, "_piece")
    before = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy(*keys, "_piece").count().withColumn("_before", F.coalesce(F.sum("count").over(before), F.lit(0)))
    starts = starts.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_piece").alias("_k"), "_before")
    on = F.col("_piece") == F.col("_k")
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    inside = F.row_number().over(Window.partitionBy(*keys, "_piece").orderBy(*tie))
    numbered = rows.withColumn(out, inside).join(starts, on).withColumn(out, F.when(known, F.col("_before") + F.col(out)))
    return numbered.drop("_piece", "_before", "_k", *[f"_k{i}" for i in range(len(keys))])
