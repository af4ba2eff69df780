"""Distinct words of batches of documents: looked up once for all, put back by position.

A task cuts its documents into batches of bounded text size, numbers the distinct words of a batch and turns every text into word
numbers. Two reads come from it: the distinct words of a batch for a lookup by word, and one row per batch with the numbers in
their order. After the lookup both meet again by batch. So a word crosses the network once per batch, not once per mention,
and texts do not cross it at all.

Words travel as rows (batch, code, word) or, packed, in lanes: a word belongs to the lane of its checksum, and the words of a batch
in a lane are one row. A word then has its number by lane and first mention, which need not be sent. Lanes spread evenly however
common a word is, since a batch holds each word once.

The documents are read twice and must come in the same order both times: a table or a checkpoint, not a shuffle result. A batch
is named by a digest of its words, so a changed order raises an error and never gives wrong rows. Texts stand in a column
``_text``; the other columns come back with the result.
"""

from __future__ import annotations

import hashlib
import itertools
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Characters of text in a batch; one longer document is a batch of its own.
BATCH_CHARS = 20_000_000
READY = 500  # texts that are Python strings at a time

_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


@dataclass(frozen=True)
class Split:
    """Words are what stands between ASCII white space of ``ready(text)``; with ``spaced`` each takes the white space after it
    along, and what a text begins with is a word too."""

    ready: Callable[[str], str] | None = None
    spaced: bool = False

    def __call__(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Words of all texts one after the other, words per text."""
        if self.ready:
            made = (pa.array([self.ready(t) if t else "" for t in texts.slice(at, READY).to_pylist()], pa.large_string()) for at in range(0, len(texts), READY))
            texts = pa.concat_arrays([*made, pa.array([], pa.large_string())])
        raw = texts.cast(pa.large_binary()).fill_null(b"")
        borders = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
        data = np.frombuffer(raw.buffers()[2] or b"", np.uint8)[borders[0] : borders[-1]]
        borders = borders - borders[0]
        word = ~_SPACE[data]
        first = np.empty(len(data), bool)
        first[:1], first[1:] = word[:1], word[1:] & ~word[:-1]
        starts = borders[:-1][np.diff(borders) > 0]
        first[starts] = True if self.spaced else word[starts]
        begin = np.flatnonzero(first)
        if self.spaced:
            ends = np.append(begin, len(data))
        else:
            between = np.flatnonzero(~word)
            data = data[word]
            ends = np.append(begin - np.searchsorted(between, begin), len(data))
        values = pa.StringArray.from_buffers(len(begin), pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data.tobytes()))
        return values, np.diff(np.searchsorted(begin, borders))


def _batches(stream: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.Table]:
    held, size = [], 0
    for batch in stream:
        lengths = np.diff(np.asarray(batch.column("_text").cast(pa.large_binary()).buffers()[1]).view(np.int64)[: batch.num_rows + 1]) if batch.num_rows else []
        start = 0
        for i, n in enumerate(lengths):
            if size + n > limit and size:
                held.append(batch.slice(start, i - start))
                yield pa.Table.from_batches(held)
                held, size, start = [], 0, i
            size += int(n)
        if batch.num_rows > start:
            held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def _coded(stream: Iterator[pa.RecordBatch], split: Split, limit: int) -> Iterator[tuple[int, pa.Table, pa.Array, np.ndarray, np.ndarray]]:
    """(batch id, rows, words by code, codes of all texts one after the other, words per row)."""
    task = TaskContext.get().partitionId()
    for number, table in enumerate(_batches(stream, limit)):
        values, counts = split(table.column("_text").cast(pa.large_string()).combine_chunks())
        coded = values.dictionary_encode()
        words = coded.dictionary
        name = hashlib.blake2b(f"{task} {number} ".encode(), digest_size=8)
        for buffer in words.buffers()[1:]:
            name.update(buffer or b"")
        yield int.from_bytes(name.digest(), "little", signed=True), table, words, np.asarray(coded.indices), counts


def _by_lane(words: pa.Array, lanes: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the words by lane and code, and the lane of each in that order."""
    lane = np.fromiter((zlib.crc32(w) % lanes for w in words.cast(pa.binary()).to_pylist()), np.int32, len(words))
    order = np.argsort(lane, kind="stable")
    return order, lane[order]


def pack(values: np.ndarray) -> list[bytes]:
    """Whole numbers from 0 to 2**31 - 1 by byte planes, compressed."""
    return [pa.compress((values >> shift).astype(np.uint8).tobytes(), "zstd", asbytes=True) for shift in (0, 8, 16, 24)]


def unpack(planes: list[bytes], size: int) -> np.ndarray:
    values = np.zeros(size, np.int32)
    for shift, plane in zip((0, 8, 16, 24), planes, strict=True):
        values |= np.frombuffer(pa.decompress(plane, size, "zstd", asbytes=True), np.uint8).astype(np.int32) << shift
    return values


def word_rows(df: DataFrame, split: Split, limit: int = BATCH_CHARS, counted: str | None = None) -> DataFrame:
    """``batch, code, word, n``: distinct words of each batch; ``n`` counts its mentions in rows whose ``counted`` column holds."""

    def rows(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, table, words, codes, counts in _coded(stream, split, limit):
            if counted is None:
                n = np.bincount(codes, minlength=len(words))
            else:
                held = np.asarray(table.column(counted).to_numpy(zero_copy_only=False), bool)
                n = np.bincount(codes[np.repeat(held, counts)], minlength=len(words))
            for at in range(0, len(words), 50_000):
                part = words.slice(at, 50_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(part), batch)), pa.array(np.arange(at, at + len(part), dtype=np.int32)), part, pa.array(n[at : at + len(part)].astype(np.int64))],
                    names=["batch", "code", "word", "n"],
                )

    return df.mapInArrow(rows, "batch bigint, code int, word string, n bigint")


def lane_rows(df: DataFrame, split: Split, lanes: int, limit: int = BATCH_CHARS) -> DataFrame:
    """``lane, batch, words, n``: the distinct words of a batch that fall into a lane; no word may hold a line feed."""

    def rows(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, words, _, _ in _coded(stream, split, limit):
            order, lane = _by_lane(words, lanes)
            sorted_words = words.take(pa.array(order)).cast(pa.binary()).to_pylist()
            edges = np.concatenate([[0], np.flatnonzero(np.diff(lane)) + 1, [len(lane)]]) if len(lane) else [0]
            out = [(int(lane[lo]), batch, pa.compress(b"\n".join(sorted_words[lo:hi]), "zstd", asbytes=True), int(hi - lo)) for lo, hi in itertools.pairwise(edges)]
            out = [dict(zip(("lane", "batch", "words", "n"), row, strict=True)) for row in out]
            yield pa.RecordBatch.from_pylist(out, pa.schema([("lane", pa.int32()), ("batch", pa.int64()), ("words", pa.binary()), ("n", pa.int32())]))

    return df.mapInArrow(rows, "lane int, batch bigint, words binary, n int")


def words_of(packed: bytes) -> list[str]:
    # the frame of a compressed buffer does not tell its size to pyarrow
    return pa.input_stream(pa.py_buffer(packed), compression="zstd").read().decode().split("\n")


def text_rows(df: DataFrame, split: Split, lanes: int = 0, limit: int = BATCH_CHARS) -> DataFrame:
    """``batch, rows, counts, codes``: one packed row per batch; codes by lane and first mention if ``lanes`` is given."""

    def rows(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, table, words, codes, counts in _coded(stream, split, limit):
            if lanes:
                order, _ = _by_lane(words, lanes)
                number = np.empty(len(words), np.int32)
                number[order] = np.arange(len(words), dtype=np.int32)
                codes = number[codes]
            kept = table.drop_columns(["_text"])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, kept.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                writer.write_table(kept)
            yield pa.RecordBatch.from_pylist(
                [{"batch": batch, "rows": sink.getvalue().to_pybytes(), "counts": counts.tobytes(), "codes": pack(codes)}],
                schema=pa.schema([("batch", pa.int64()), ("rows", pa.binary()), ("counts", pa.binary()), ("codes", pa.list_(pa.binary()))]),
            )

    return df.mapInArrow(rows, "batch bigint, rows binary, counts binary, codes array<binary>")


def put_back(texts: DataFrame, found: DataFrame, body: Callable, schema: T.StructType | str, order: str = "code") -> DataFrame:
    """``body(rows, codes, counts, found)`` per batch: its rows without text, the codes of all texts, words per row, and
    what was found for the words, sorted by ``order``."""

    def meet(packed: pa.Table, words: pa.Table) -> pa.Table:
        if packed.num_rows != 1:
            raise RuntimeError("the documents came in another order on the second read; write or checkpoint them first")
        row = packed.to_pylist()[0]
        counts = np.frombuffer(row["counts"], np.int64)
        return body(pa.ipc.open_stream(row["rows"]).read_all(), unpack(row["codes"], int(counts.sum())), counts, words.sort_by(order))

    return texts.groupBy("batch").cogroup(found.groupBy("batch")).applyInArrow(meet, schema)
