"""Language identification by a byte convolutional network in numpy.

A text is cut into windows of fixed length. Bytes become small learned vectors; filters of several widths slide over a window,
their largest response goes through a softmax layer. A document gets the mean of its windows' log probabilities, weighted by
their bytes. The network is trained on the driver on a bounded sample of labelled rows and sent to the tasks, some kilobytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNKNOWN = "und"
WINDOW = 128
WIDTHS = (2, 3, 4)
STRIDE = WINDOW - max(WIDTHS) + 1  # windows overlap, so that no filter misses a place
DEPTH = 6  # numbers per byte
FILTERS = 12  # per width
CHUNK = 4096  # windows computed at once


@dataclass
class ByteNet:
    """Weights: bytes (257 x DEPTH, the last row for padding), filters (widest * DEPTH x all filters), output (filters x labels)."""

    labels: list[str]
    bytes: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    output: np.ndarray
    offset: np.ndarray

    @staticmethod
    def new(labels: list[str], seed: int) -> ByteNet:
        rng = np.random.default_rng(seed)
        wide, count = max(WIDTHS), FILTERS * len(WIDTHS)
        table = rng.normal(0, 0.5, (257, DEPTH)).astype(np.float32)
        table[256] = 0
        filters = rng.normal(0, 0.3, (wide * DEPTH, count)).astype(np.float32)
        net = ByteNet(labels, table, filters, np.zeros(count, np.float32), rng.normal(0, 0.1, (count, len(labels))).astype(np.float32), np.zeros(len(labels), np.float32))
        net.filters *= net.mask()
        return net

    @staticmethod
    def mask() -> np.ndarray:
        """Narrow filters see the first bytes of the widest slot only."""
        reach = np.repeat(WIDTHS, FILTERS) * DEPTH
        return (np.arange(max(WIDTHS) * DEPTH)[:, None] < reach[None, :]).astype(np.float32)

    def slots(self, windows: np.ndarray) -> np.ndarray:
        """Windows of byte numbers as rows of the bytes that a filter sees at each place."""
        vectors = self.bytes[windows]  # windows x length x depth
        wide = max(WIDTHS)
        seen = np.lib.stride_tricks.sliding_window_view(vectors.reshape(len(windows), -1), wide * DEPTH, axis=1)[:, ::DEPTH]
        return np.ascontiguousarray(seen)

    def log_chances(self, windows: np.ndarray) -> np.ndarray:
        seen = self.slots(windows)
        hidden = (seen.reshape(-1, seen.shape[2]) @ self.filters).reshape(len(windows), seen.shape[1], -1).max(axis=1)
        return _log_softmax(np.maximum(hidden + self.bias, 0) @ self.output + self.offset)

    def step(self, windows: np.ndarray, target: np.ndarray, memory: list[np.ndarray], rate: float) -> float:
        """One update with adaptive rates; the loss before it."""
        n, rows = len(windows), np.arange(len(windows))
        seen = self.slots(windows)
        raw = (seen.reshape(-1, seen.shape[2]) @ self.filters).reshape(n, seen.shape[1], -1)
        at = raw.argmax(axis=1)
        top = np.take_along_axis(raw, at[:, None], 1)[:, 0] + self.bias
        hidden = np.maximum(top, 0)
        chances = _log_softmax(hidden @ self.output + self.offset)
        error = np.exp(chances)
        error[rows, target] -= 1
        error /= n
        back = (error @ self.output.T) * (top > 0)
        picked = seen[rows[:, None], at]  # windows x filters x what the filter saw
        to_bytes = back[:, :, None] * self.filters.T[None]
        where = windows[rows[:, None, None], at[:, :, None] + np.arange(max(WIDTHS))[None, None]]
        bytes_gradient = np.zeros_like(self.bytes)
        np.add.at(bytes_gradient, where.ravel(), to_bytes.reshape(-1, DEPTH))
        bytes_gradient[256] = 0
        gradients = [bytes_gradient, np.einsum("nf,nfs->sf", back, picked) * self.mask(), back.sum(0), hidden.T @ error, error.sum(0)]
        for weight, g, m in zip((self.bytes, self.filters, self.bias, self.output, self.offset), gradients, memory, strict=True):
            m *= 0.98
            m += 0.02 * g * g
            weight -= rate * g / (np.sqrt(m) + 1e-5)
        return float(-chances[rows, target].mean())


def _log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(axis=1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=1, keepdims=True))


def cut(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document number, first byte) of every window of texts that lie in ``data`` from ``starts`` to ``ends``."""
    n = np.maximum(1, -(-(ends - starts - (WINDOW - STRIDE)) // STRIDE)) * (ends > starts)
    doc = np.repeat(np.arange(len(starts)), n)
    number = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    return doc, starts[doc] + number * STRIDE


def windows_of(data: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Byte numbers of windows, 256 beyond the end of the text."""
    places = first[:, None] + np.arange(WINDOW)[None, :]
    inside = places < end[:, None]
    return np.where(inside, data[np.minimum(places, len(data) - 1)], 256).astype(np.int16)


def fit(texts: list[str], labels: list[str], windows: int = 12, rounds: int = 12, seed: int = 5) -> ByteNet:
    """Train on at most ``windows`` windows of each text, drawn from all of it."""
    rng = np.random.default_rng(seed)
    known = sorted(set(labels))
    raw = [t.encode("utf-8", "replace") for t in texts]
    data = np.frombuffer(b"".join(raw) or b" ", np.uint8)
    ends = np.cumsum([len(r) for r in raw])
    starts = ends - np.array([len(r) for r in raw])
    doc, first = cut(data, starts, ends)
    order = np.lexsort((rng.random(len(doc)), doc))
    doc, first = doc[order], first[order]
    rank = np.arange(len(doc)) - np.searchsorted(doc, doc)
    doc, first = doc[rank < windows], first[rank < windows]
    x = windows_of(data, first, ends[doc])
    y = np.searchsorted(known, labels)[doc]
    net = ByteNet.new(known, seed)
    memory = [np.zeros_like(w) for w in (net.bytes, net.filters, net.bias, net.output, net.offset)]
    for r in range(rounds):
        for part in np.array_split(rng.permutation(len(x)), max(1, len(x) // 64)):
            if len(part):
                net.step(x[part], y[part], memory, 0.01 * 0.75**r)
    return net


def training_sample(df: DataFrame, per_label: int) -> DataFrame:
    """``text, lang``: for each label the ``per_label`` rows of smallest hash of the text; the bound does not grow with the table."""
    keyed = df.where(F.col("lang").isNotNull() & F.col("text").rlike("\\p{L}")).select("lang", "text", F.xxhash64(F.lit(29), "text").alias("_h"))
    first = keyed.select("lang", "_h").distinct().withColumn("_r", F.row_number().over(Window.partitionBy("lang").orderBy("_h"))).where(F.col("_r") <= per_label)
    last = first.groupBy("lang").agg(F.max("_h").alias("_last")).withColumnRenamed("lang", "_lang")
    chosen = keyed.join(F.broadcast(last), (F.col("lang") == F.col("_lang")) & (F.col("_h") <= F.col("_last")))  # one row per language
    return chosen.groupBy("lang", "_h").agg(F.min("text").alias("text")).select("text", "lang")


def train(df: DataFrame, per_label: int = 400, text: str = "text", lang: str = "lang") -> ByteNet | None:
    """Network for the labels of ``df``; None without labelled text. At most ``per_label`` texts of a label reach the driver."""
    rows = training_sample(df.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang")), per_label).toArrow()
    if not rows.num_rows:
        return None
    rows = rows.sort_by([("lang", "ascending"), ("text", "ascending")])
    return fit(rows.column("text").to_pylist(), rows.column("lang").to_pylist())


def predict(df: DataFrame, net: ByteNet | None, text: str = "text", lang_out: str = "lang_pred", score_out: str = "score") -> DataFrame:
    """Adds ``lang_pred`` and ``score`` (chance of that language, 0 to 1) from the whole of every text.

    Texts that are null or have no letter, and all texts without a network, get ``und`` and 0. Every row is judged by itself, so nothing
    else in the table matters; columns of the two names are replaced; an empty table gives an empty result.
    """
    names = [c for c in df.columns if c not in (lang_out, score_out)]
    schema = T.StructType([f for f in df.schema.fields if f.name in names] + [T.StructField(lang_out, T.StringType()), T.StructField(score_out, T.DoubleType())])

    def judge(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                best, chance = _judge(net, part.column(text)) if net else (np.zeros(part.num_rows, int), np.zeros(part.num_rows))
                labels = pa.array([net.labels[b] for b in best] if net else [UNKNOWN] * part.num_rows, pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, labels, pa.array(chance)], names=[*names, lang_out, score_out])

    done = df.select(names).mapInArrow(judge, schema)
    speaks: Column = F.coalesce(F.col(text).rlike("\\p{L}"), F.lit(False))
    return done.withColumn(score_out, F.when(speaks, F.col(score_out)).otherwise(0.0)).withColumn(lang_out, F.when(speaks, F.col(lang_out)).otherwise(UNKNOWN))


def _judge(net: ByteNet, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    raw = texts.cast(pa.large_binary()).fill_null(b"")
    borders = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
    data = np.frombuffer(raw.buffers()[2] or b"", np.uint8)
    data = data if len(data) else np.zeros(1, np.uint8)
    starts, ends = borders[:-1], borders[1:]
    doc, first = cut(data, starts, ends)
    total = np.zeros((len(raw), len(net.labels)))
    for at in range(0, len(doc), CHUNK):
        d, f = doc[at : at + CHUNK], first[at : at + CHUNK]
        chances = net.log_chances(windows_of(data, f, ends[d])) * np.minimum(WINDOW, ends[d] - f)[:, None]
        np.add.at(total, d, chances)
    mean = total / np.maximum(1, ends - starts)[:, None]
    best = mean.argmax(axis=1)
    return best, np.exp(_log_softmax(mean)[np.arange(len(best)), best]).astype(np.float64)
