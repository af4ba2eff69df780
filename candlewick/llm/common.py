"""Small helpers of the training-data operators."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.session import checkpoint_folder

# Functions sent to the workers travel by value, so that the workers need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__package__])

#: A word of a text, as a Java and as a Python pattern: everything between ASCII white space.
WORD = "[^\\x20\\x09-\\x0D]+"


def store(df: DataFrame, name: str, **options: int | str) -> DataFrame:
    """Write ``df`` to the shared folder named by ``spark.checkpoint.dir`` and read it back.

    Cuts lineage like ``checkpoint()``: a lost executor costs a re-read, not a recomputation. ``options`` go to the writer, ``__`` for dots.
    """
    spark = df.sparkSession
    path = f"{checkpoint_folder(spark).rstrip('/')}/candlewick-{uuid.uuid4().hex}/{name}"
    df.write.options(**{k.replace("__", "."): v for k, v in options.items()}).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sized_join(big: DataFrame, small: DataFrame, on: str | list[str], how: str, rows: int, limit: int = 1_000_000) -> DataFrame:
    """Join that spares ``big`` its shuffle while ``small`` has at most ``limit`` narrow rows; a shuffled join beyond it."""
    return big.join(F.broadcast(small) if rows <= limit else small, on, how)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` computed once instead of at every mention."""
    return F.transform(F.array(value), body)[0]


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def n_words(c: Column) -> Column:
    """Number of words; null and empty texts have none."""
    return F.coalesce(F.regexp_count(c, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def bucket_of(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as empty text (remainder 0)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Cut a stream sorted by ``keys`` into one table per key; holds one key's rows and one batch at a time."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(batch.schema.get_field_index(k)).to_pylist() for k in keys]
        start = 0
        for i, key in enumerate(zip(*columns, strict=True)):
            if key != last:
                if i > start:
                    held.append(batch.slice(start, i - start))
                if held:
                    yield pa.Table.from_batches(held)
                held, start, last = [], i, key
        held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)
