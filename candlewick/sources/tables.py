"""Keyed tables: upserts, changelogs, incremental loads, mappings and multi-sink jobs."""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The newest row per key by a partial aggregate: copies of a key collapse before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*keys).agg(newest.alias("_r")).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest]).select(*df.columns)


def upsert(current: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Current table with the incoming rows written over equal keys; replaying a batch changes nothing."""
    newest = keep_last(incoming, keys, order)
    return current.join(newest.select(*keys), list(keys), "left_anti").select(*current.columns).unionByName(newest.select(*current.columns))


def insert_or_ignore(current: DataFrame, incoming: DataFrame, key: str, order: Sequence[Column | str]) -> DataFrame:
    """Only the incoming rows whose key is new, the first of each."""
    rest = [c for c in incoming.columns if c != key]
    first = incoming.groupBy(key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    first = first.select(key, *[F.col(f"_r.{c}").alias(c) for c in rest]).select(*incoming.columns)
    return first.join(current.select(key).distinct(), key, "left_anti").select(*incoming.columns)


def keyed_with_raw(df: DataFrame, keys: Sequence[str], columns: Mapping[str, Column], order: Sequence[Column | str]) -> DataFrame:
    """Upsert rows with the original row as JSON; rows without a key are skipped."""
    present = F.lit(True)
    for k in keys:
        present = present & F.col(k).isNotNull() & (F.col(k).cast("string") != "")
    raw = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    rows = df.filter(present).select(*keys, *[c.alias(n) for n, c in columns.items()], raw.alias("raw_json"), F.struct(*order).alias("_o"))
    return keep_last(rows, keys, ["_o"]).drop("_o")


def newer_than_sent(df: DataFrame, sent: DataFrame, key: str, ts: str) -> DataFrame:
    """Rows past the high-watermark of their key; keys never sent are sent whole. Rows without a time are skipped."""
    marks = sent.groupBy(key).agg(F.max(ts).alias("_mark"))
    return df.filter(F.col(ts).isNotNull()).join(marks, key, "left").filter(F.col("_mark").isNull() | (F.col(ts) > F.col("_mark"))).drop("_mark")


def compacted(log: DataFrame, key: str, offset: str, value: str = "value") -> DataFrame:
    """Latest record per key of a changelog; keys whose latest value is null are deleted."""
    rest = [c for c in log.columns if c not in (key, offset)]
    last = log.groupBy(key).agg(F.max(offset).alias(offset), F.max_by(F.struct(*rest), offset).alias("_r"))
    return last.select(key, offset, *[F.col(f"_r.{c}").alias(c) for c in rest]).filter(F.col(value).isNotNull()).select(*log.columns)


def retained(log: DataFrame, ts: str, days: int) -> DataFrame:
    """Records of the last days, counted back from the newest record."""
    newest = log.agg(F.max(ts).alias("_newest"))
    return log.join(F.broadcast(newest)).filter(F.col(ts) >= F.col("_newest") - F.make_dt_interval(F.lit(days))).drop("_newest")


def pending_units(days: DataFrame, symbols: DataFrame, ledger: DataFrame, keys: Sequence[str], force: bool = False) -> DataFrame:
    """Units of work (day, symbol) of a backfill that the ledger does not list as finished.

    ``symbols`` carries the days it trades from and to, so that units are made by range and not as all pairs.
    """
    units = symbols.withColumn(keys[0], F.explode(F.sequence("first_day", "last_day"))).drop("first_day", "last_day").join(days, keys[0], "left_semi")
    units = units.select(*keys)
    return units if force else units.join(ledger.select(*keys).distinct(), list(keys), "left_anti")


def backfill(spark: SparkSession, units: DataFrame, process: Callable[[DataFrame], DataFrame], target: str, ledger: str, keys: Sequence[str]) -> int:
    """Process the pending units as one job, then append them to the ledger; a failed run leaves the ledger as it was."""
    todo = units.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n = todo.count()
        if n:
            process(todo).write.mode("append").parquet(target)
            todo.select(*keys).write.mode("append").parquet(ledger)
        return n
    finally:
        todo.unpersist()


# ------------------------------------------------------------------------------------------------ mappings

# Fields each record schema requires.
REQUIRED = {
    "OHLCV": ("symbol", "timestamp", "open", "high", "low", "close", "volume"),
    "QUOTE": ("symbol", "timestamp", "price"),
    "TICK": ("symbol", "timestamp", "price", "quantity"),
    "ORDER": ("orderId", "symbol", "side", "type", "quantity", "status"),
    "POSITION": ("symbol", "quantity", "averagePrice"),
    "PORTFOLIO": ("totalValue", "timestamp"),
    "INSTRUMENT": ("symbol", "name", "exchange"),
}


def normalise_records(
    raw: DataFrame, value: str, mapping: Sequence[Mapping[str, str]], transforms: Mapping[str, Callable[[Column], Column]], schema: str
) -> DataFrame:
    """Canonical records from JSON by mapping rows (``target, expression, transform, default``).

    A missing value takes the default before the transform; ``errors`` lists the required fields left empty.
    """
    out = {}
    for m in mapping:
        if not m.get("target"):
            continue
        v = F.get_json_object(value, m["expression"]) if m.get("expression") else F.lit(None).cast("string")
        if m.get("default"):
            v = F.coalesce(v, F.lit(m["default"]))
        out[m["target"]] = transforms[m["transform"]](v) if m.get("transform") else v
    missing = [F.when(out[f].isNull() if f in out else F.lit(True), F.lit(f"missing {f}")) for f in REQUIRED.get(schema, ())]
    errors = F.array_compact(F.array(*missing)) if missing else F.array().cast("array<string>")
    return raw.select(*[c for c in raw.columns if c != value], *[c.alias(n) for n, c in out.items()], errors.alias("errors"))


def normalise_stream(
    raw: DataFrame, value: str, schema: str, mappings: Mapping[str, Sequence[Mapping[str, str]]], transforms: Mapping[str, Callable[[Column], Column]]
) -> DataFrame:
    """Canonical records of a table that mixes record schemas (column ``schema``), in one pass over its JSON.

    ``mappings`` holds the mapping rows of each schema. The result has a column per target of any schema, null where the record's schema does not have it, and
    ``errors`` as in :func:`normalise_records`; a schema without mapping rows gives the single error ``unknown schema``. Values of targets that several schemas
    share must have one type.
    """
    known = F.col(schema)
    targets: dict[str, Column] = {}
    errors = F.when(known.isNull() | ~known.isin(*mappings), F.array(F.lit("unknown schema")))
    for name, rows in mappings.items():
        own: dict[str, Column] = {}
        for m in rows:
            if m.get("target"):
                v = F.get_json_object(value, m["expression"]) if m.get("expression") else F.lit(None).cast("string")
                v = F.coalesce(v, F.lit(m["default"])) if m.get("default") else v
                own[m["target"]] = transforms[m["transform"]](v) if m.get("transform") else v
        for target, c in own.items():
            mine = F.when(known == name, c)
            targets[target] = F.coalesce(targets[target], mine) if target in targets else mine
        missing = [F.when(own[f].isNull() if f in own else F.lit(True), F.lit(f"missing {f}")) for f in REQUIRED.get(name, ())]
        errors = errors.when(known == name, F.array_compact(F.array(*missing)) if missing else F.array().cast("array<string>"))
    kept = [c for c in raw.columns if c != value]
    return raw.select(*kept, *[c.alias(t) for t, c in targets.items()], errors.alias("errors"))


def error_rows(records: DataFrame, keys: Sequence[str], schema: str) -> DataFrame:
    """One row per validation error of normalised records."""
    return records.select(*keys, schema, F.explode("errors").alias("error"))


# ------------------------------------------------------------------------------------------------ silver


def write_silver(df: DataFrame, name: str, path: str, buckets: int = 64, ts: str = "timestamp") -> DataFrame:
    """Store bars as table ``name``: a folder per month, and in it files by (symbol, day).

    Scans with a time range read its months only; aggregates and joins by symbol and day find their rows together and need no shuffle. A symbol with a large share
    of the rows spreads over the buckets by its days.
    """
    day, month = F.to_date(ts).alias("day"), F.date_format(ts, "yyyy-MM").alias("month")
    rows = df.select(*df.columns, day, month).repartition(buckets, "symbol", "day")
    rows.write.mode("overwrite").format("parquet").option("path", path).partitionBy("month").bucketBy(buckets, "symbol", "day").sortBy("symbol", ts).saveAsTable(name)
    return df.sparkSession.table(name)


def silver_range(spark: SparkSession, name: str, start: str, end: str, ts: str = "timestamp") -> DataFrame:
    """Bars of a stored silver table from ``start`` up to, but not including, ``end`` (dates); only the months between are read."""
    rows = spark.table(name)
    return rows.filter(F.col("month").between(start[:7], end[:7]) & (F.col(ts) >= F.lit(start).cast("timestamp")) & (F.col(ts) < F.lit(end).cast("timestamp")))


# ------------------------------------------------------------------------------------------------ jobs


def fan_out(df: DataFrame, sinks: Mapping[str, Callable[[DataFrame], None]]) -> dict[str, str]:
    """Compute once, write to every sink, report each; empty input is skipped, a failed sink fails the job at the end."""
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    status: dict[str, str] = {}
    try:
        if held.isEmpty():
            return {name: "skipped" for name in sinks}
        for name, write in sinks.items():
            try:
                write(held)
                status[name] = "ok"
            except Exception as e:  # each sink is tried; the failures are raised together below
                status[name] = f"failed: {e}"
    finally:
        held.unpersist()
    failed = [n for n, s in status.items() if s.startswith("failed")]
    if failed:
        raise RuntimeError(f"sinks failed: {failed}: " + "; ".join(status[n] for n in failed))
    return status


def read_table(spark: SparkSession, name: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """Scan of a stored table: a catalog name, a folder, or a connector given by ``fmt`` and its options."""
    if options or fmt != "parquet":
        return spark.read.format(fmt).options(**options).load(*([name] if name else []))
    return spark.read.parquet(name) if os.sep in name else spark.read.table(name)


def medallion(spark: SparkSession, bronze: str, silver: str, gold: str) -> dict[str, str]:
    """Batch pipeline over minute bars: landed CSV, clean silver table, hourly and daily roll-ups, gold by symbol."""
    from candlewick.operators import bars, quality
    from candlewick.sources import files

    landed = files.read_minute_csv(spark, bronze)
    clean = quality.valid_ohlc(keep_last(landed, ["symbol", "timestamp"], ["timestamp"]))
    files.write_parquet(clean, silver)
    stored = spark.read.parquet(silver)
    daily = bars.daily_summary(stored)
    return fan_out(daily, {
        "hourly": lambda _: files.write_parquet(bars.hourly_ohlcv(stored), os.path.join(gold, "hourly")),
        "daily": lambda d: files.write_parquet(d, os.path.join(gold, "daily"), by=["symbol"]),
    })
