"""Appending, de-duplicating, chunking, padding, coercing; top lists and down-sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.functions.scalars import parse_time
from candlewick.operators import ranking
from candlewick.operators.series import POS, Axis, number, whole_by


def append(x: DataFrame, y: DataFrame) -> DataFrame:
    return x.unionByName(y, allowMissingColumns=True)


def prepend(x: DataFrame, y: DataFrame) -> DataFrame:
    return y.unionByName(x, allowMissingColumns=True)


def distinct_by(df: DataFrame, field: str, order: Sequence[str]) -> DataFrame:
    """First row of each value of a field in the given order (partial aggregation, no sort of a group)."""
    return df.groupBy(field).agg(F.min_by(F.struct(*df.columns), F.struct(*order)).alias("_r")).select("_r.*")


def pick(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    return df.select(*[f for f in fields if f in df.columns])


def omit(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    return df.drop(*fields)


def common_values(frames: Sequence[DataFrame], column: str) -> DataFrame:
    """Distinct values all frames have."""
    out = frames[0].select(column)
    for f in frames[1:]:
        out = out.intersect(f.select(column))
    return out.distinct()


def chunks(df: DataFrame, axis: Axis, size: int) -> DataFrame:
    """Chunk number of ``size`` consecutive rows of each series."""
    return number(df, axis).withColumn("chunk", F.floor((F.col(POS) - 1) / size)).drop(POS)


def repeat(df: DataFrame, n: int) -> DataFrame:
    return df.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))


def stack(df: DataFrame, keys: Sequence[str], columns: Sequence[str], name: str = "variable", value: str = "value") -> DataFrame:
    """Wide to long; null values are left out."""
    return df.unpivot(list(keys), list(columns), name, value).filter(F.col(value).isNotNull())


def zero_pad(df: DataFrame, entity: str, time: str, value: str, n: int) -> DataFrame:
    """``n`` zero rows before each entity, spaced like its first two rows (a day when there is only one)."""
    first = df.groupBy(entity).agg(F.min(time).alias("_t0"))
    rows = df.join(first, entity)
    second = rows.filter(F.col(time) > F.col("_t0")).groupBy(entity).agg(F.min(time).alias("_t1"))
    ends = first.join(second, entity, "left")
    step = F.coalesce(F.unix_micros("_t1") - F.unix_micros("_t0"), F.lit(86_400_000_000).cast("long"))
    pads = ends.withColumn("_i", F.explode(F.sequence(F.lit(1), F.lit(n))))
    pads = pads.select(
        entity, F.timestamp_micros(F.unix_micros("_t0") - step * F.col("_i")).alias(time), F.lit(0.0).alias(value)
    )
    return df.select(entity, time, value).unionByName(pads)


def coerce_panel(df: DataFrame, entity: str | None = None, time: str | None = None, value: str | None = None) -> DataFrame:
    """(entity_id string, time timestamp, value double) with lower-case, trimmed names; bad cells become null."""
    df = df.toDF(*[c.strip().lower() for c in df.columns])
    entity, time, value = (x or d for x, d in ((entity, "entity_id"), (time, "time"), (value, "value")))
    kind = dict(df.dtypes)[time]
    stamp = parse_time(F.col(time)) if kind == "string" else F.col(time).cast("timestamp")
    return df.select(
        F.col(entity).cast("string").alias("entity_id"), stamp.alias("time"), F.col(value).try_cast("double").alias("value")
    )


# --- top lists ---------------------------------------------------------------------------------------------------


def newest(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """The newest ``n`` rows per key."""
    return ranking.top_n(df, keys, [F.desc(c) for c in order], n).drop("rank")


def most_common(df: DataFrame, key: str, n: int = 10) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), key).limit(n)


# Severities in order.
SEVERITIES = ("critical", "high", "medium", "low")


def severity_rank(c: Column) -> Column:
    out = F.lit(len(SEVERITIES))
    for i, s in reversed(list(enumerate(SEVERITIES))):
        out = F.when(c == s, i).otherwise(out)
    return out


def down_sample(df: DataFrame, axis: Axis, points: int = 500) -> DataFrame:
    """Every n-th row so that about ``points`` remain; the last row is kept."""
    rows = number(df, axis, length="_n")
    step = F.when(F.col("_n") > points, F.floor(F.col("_n") / points)).otherwise(1)
    keep = ((F.col(POS) - 1) % step == 0) | (F.col(POS) == F.col("_n"))
    return rows.filter(keep).drop(POS, "_n")


def percentile_rank(df: DataFrame, peers: Sequence[str], value: str) -> DataFrame:
    """Percent of the peers with a smaller value."""
    rows = ranking.with_positions(df, list(peers), value)
    return rows.withColumn("peer_percentile", F.col(ranking.BELOW) / F.col(ranking.SIZE) * 100).drop(
        ranking.BELOW, ranking.SAME, ranking.SIZE
    )


def staged_universe(
    rows: DataFrame,
    period: str,
    coarse: int = 500,
    fine: int = 20,
    final: int = 10,
    min_age_days: int = 180,
    min_cap: float = 5e8,
    countries: Sequence[str] = ("USA",),
    exchanges: Sequence[str] = ("NYS", "NAS"),
    ev_descending: bool = True,
    roa_descending: bool = False,
) -> DataFrame:
    """Monthly stock universe: top dollar volume → country, exchange, age and size → top share per sector →
    ``fine`` by EV/EBITDA → ``final`` by return on assets.  The defaults sort EV/EBITDA down and ROA up."""
    way = lambda c, down: F.desc(c) if down else F.asc(c)
    top = ranking.top_n(rows, [period], [F.desc("dollar_volume"), F.asc("symbol")], coarse).drop("rank")
    ok = top.filter(
        F.col("country").isin(list(countries)) & F.col("exchange").isin(list(exchanges))
        & (F.col("age_days") > min_age_days) & (F.col("market_cap") > min_cap)
    )
    sizes = ok.groupBy(period).agg(F.count(F.lit(1)).alias("_n"))
    sectors = ok.groupBy(period, "sector").agg(F.count(F.lit(1)).alias("_k"))
    ranked = ranking.top_n(ok, [period, "sector"], [F.desc("dollar_volume"), F.asc("symbol")], coarse)
    ranked = ranked.join(sizes, period).join(sectors, [period, "sector"])
    kept = ranked.filter(F.col("rank") <= F.ceil(F.col("_k") * F.lit(fine) / F.col("_n"))).drop("rank", "_n", "_k")
    by_ev = ranking.top_n(kept, [period], [way("ev_to_ebitda", ev_descending), F.asc("symbol")], fine).drop("rank")
    return ranking.top_n(by_ev, [period], [way("roa", roa_descending), F.asc("symbol")], final)
