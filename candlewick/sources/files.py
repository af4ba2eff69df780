"""File scans and sinks: CSV, JSON lines, Parquet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MINUTE = T.StructType([
    T.StructField("symbol", T.StringType(), False),
    T.StructField("timestamp", T.TimestampType(), False),
    *[T.StructField(c, T.DecimalType(18, 2)) for c in ("open", "high", "low", "close")],
    T.StructField("volume", T.LongType()),
    T.StructField("adjusted_close", T.DecimalType(18, 2)),
])


def read_minute_csv(spark: SparkSession, pattern: str) -> DataFrame:
    """All CSV files of a glob with a header row and the fixed minute-bar fields."""
    return spark.read.schema(MINUTE).option("header", True).csv(pattern)


def parse_csv_text(df: DataFrame, text: str, schema: str, separator: str = ",", header: bool = False) -> DataFrame:
    """Rows of CSV texts held in a column, one text per row; numbers the lines of each text from 1."""
    lines = F.posexplode(F.split(F.regexp_replace(F.col(text), "\r\n?", "\n"), "\n")).alias("line_no", "line")
    out = df.select(*[c for c in df.columns if c != text], lines).filter(F.trim("line") != "")
    if header:
        out = out.filter("line_no > 0")
    return out.withColumn("_r", F.from_csv("line", F.lit(schema), {"sep": separator})).select(*[c for c in out.columns if c != "line"], "_r.*")


def parse_envelopes(lines: DataFrame, value: str, row_schema: str) -> tuple[DataFrame, DataFrame]:
    """Rows of JSON lines, plain or wrapped as ``{success, data: {type: "table", rows: […]}}``, and the rejected lines."""
    wrapped = F.from_json(value, f"success boolean, data struct<type string, rows array<struct<{_fields(row_schema)}>>>")
    parsed = lines.select("*", wrapped.alias("_e"), F.from_json(value, row_schema).alias("_p"))
    known = F.lit(False)
    for f in T._parse_datatype_string(row_schema).fields:
        known = known | F.col(f"_p.{f.name}").isNotNull()
    table = (F.col("_e.data.type") == "table") & F.col("_e.data.rows").isNotNull()
    rows = F.when(F.coalesce(table, F.lit(False)), F.col("_e.data.rows")).when(known, F.array("_p"))
    keep = [c for c in lines.columns if c != value]
    parsed = parsed.withColumn("_rows", rows)
    return parsed.select(*keep, F.explode("_rows").alias("_r")).select(*keep, "_r.*"), parsed.filter(F.col("_rows").isNull()).select(*lines.columns)


def _fields(schema: str) -> str:
    return ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in T._parse_datatype_string(schema).fields)


def write_parquet(df: DataFrame, path: str, by: Sequence[str] = (), files_per_part: int = 1) -> None:
    """Overwrite a Parquet folder; with ``by``, one folder per value.

    Rows of one value are spread over ``files_per_part`` tasks before the write, so that a value with a large share
    of the table is not written by one task, and a value with few rows does not leave a file per task.
    """
    if by:
        df = df.repartition(*by, F.pmod(F.xxhash64(*df.columns), F.lit(files_per_part)))
        df.write.mode("overwrite").partitionBy(*by).parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "overwrite", **options: str) -> None:
    """JDBC sink; ``truncate`` keeps the table definition, ``numPartitions`` bounds the open connections."""
    settings = {"truncate": "true", "batchsize": "10000", "numPartitions": "8", **options}
    df.write.format("jdbc").mode(mode).options(url=url, dbtable=table, **settings).save()


def export(df: DataFrame, path: str, kind: str = "csv") -> None:
    """Result table as CSV (with header) or JSON lines, written by all tasks."""
    writer = df.write.mode("overwrite")
    writer.option("header", True).csv(path) if kind == "csv" else writer.json(path)


def to_messages(df: DataFrame, key: str | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows as ``key`` and JSON ``value``, the layout of a topic."""
    value = F.to_json(F.struct(*(columns or df.columns)), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}).alias("value")
    return df.select(F.col(key).cast("string").alias("key"), value) if key else df.select(value)


def from_messages(df: DataFrame, schema: T.StructType | str = MINUTE) -> DataFrame:
    """Topic records (``value`` bytes or text) as flat columns, unreadable records as null rows."""
    return df.select(F.from_json(F.col("value").cast("string"), schema).alias("data")).select("data.*")


def read_topic(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Kafka topic from the earliest offset, as a stream of records."""
    settings = {"startingOffsets": "earliest", "failOnDataLoss": "false", **options}
    return spark.readStream.format("kafka").options(**{"kafka.bootstrap.servers": servers, "subscribe": topic, **settings}).load()


def write_topic(messages: DataFrame, servers: str, topic: str) -> None:
    messages.write.format("kafka").options(**{"kafka.bootstrap.servers": servers, "topic": topic}).save()


def replay(spark: SparkSession, folder: str, schema: T.StructType | str, files_per_batch: int = 1) -> DataFrame:
    """CSV files as a paced stream of messages: so many files per trigger."""
    rows = spark.readStream.schema(schema).option("header", True).option("maxFilesPerTrigger", files_per_batch).csv(folder)
    return to_messages(rows, "symbol" if "symbol" in rows.columns else None)


def topic_of(interval: Column) -> Column:
    """Topic of a feed by its bar interval."""
    return F.when(interval.contains("m") | interval.contains("h"), "market-data-minute").otherwise("market-data-daily")
