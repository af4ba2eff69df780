"""Centroid clustering of whole-number vectors by a bisector tournament.

For every pair of centroids the plane between them is laid down once a round: a whole-number normal and a threshold. A vector keeps
one champion centroid and meets the others in the order of their numbers; the sign of one linear test says which of the two goes,
and zero keeps the smaller number. After k - 1 tests the champion is the nearest centroid, and only its distance is computed.
All numbers are whole, so every run and every division of the rows gives the same result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import store

PLANES = 1 << 24  # most components of all normals together: 128 MB in the driver and in each Python worker
WHOLE = 2.0**62  # components beyond have no exact sum


def whole_numbers(vec: Column, scale: float) -> Column:
    """``floor(scale * x)`` of each component as long; fails on a component that no long can hold."""
    wide = F.transform(vec.cast("array<double>"), lambda x: F.floor(x * F.lit(float(scale))))
    fits = F.coalesce(F.forall(vec.cast("array<double>"), lambda x: F.abs(x * F.lit(float(scale))) < WHOLE), F.lit(True))
    return F.when(fits, wide.cast("array<bigint>")).otherwise(F.raise_error(F.lit("a scaled component lies beyond 2^62")).cast("array<bigint>"))


def finite(vec: Column) -> Column:
    """Whether a vector is there and holds neither null nor non-finite components."""
    good = F.forall(vec.cast("array<double>"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(good, F.lit(False))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column without nulls, all of one length."""
    return np.asarray(column.flatten(), np.int64).reshape(len(column), -1)


def exact(values: np.ndarray, reach: int) -> np.ndarray:
    """``values`` in the fastest type in which sums up to ``reach`` are exact."""
    return values.astype(np.float64 if reach < 2**53 else np.int64 if reach < 2**62 else object)


class Planes:
    """Normals and thresholds between all pairs of centroids."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids.astype(object)
        k = len(centroids)
        self.peak = int(np.abs(self.centroids).max(initial=0))
        square = (self.centroids * self.centroids).sum(axis=1)
        self.pairs = {(i, j): (2 * (self.centroids[i] - self.centroids[j]), int(square[i] - square[j])) for i in range(k) for j in range(i + 1, k)}

    def assign(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of the nearest centroid, squared distance) of each vector."""
        n, dims = vectors.shape
        top = max(self.peak, int(max(-int(vectors.min(initial=0)), int(vectors.max(initial=0)))))
        x = exact(vectors, dims * 4 * top * top)
        champion = np.zeros(n, np.int32)
        for rival in range(1, len(self.centroids)):
            for held in range(rival):
                meets = np.flatnonzero(champion == held)
                if len(meets):
                    normal, threshold = self.pairs[held, rival]
                    champion[meets[(x[meets] @ normal.astype(x.dtype)) < threshold]] = rival
        away = x - self.centroids.astype(x.dtype)[champion]
        square = (away * away).sum(axis=1)
        if x.dtype == object and n and max(square) >= 2**63:
            raise OverflowError("a squared distance does not fit a long")
        return champion, square.astype(np.int64)


def _seeds(vectors: DataFrame, k: int, dims: int, seed: int) -> np.ndarray:
    chosen = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.select("vec", chosen.alias("h")).orderBy(F.asc_nulls_last("h"), "vec").limit(k).collect()
    return np.array([r["vec"] for r in rows], dtype=object).reshape(len(rows), dims)


def _moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Floors of the means of each centroid's vectors; a centroid without vectors stays."""
    planes = Planes(centroids)

    def totals(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(len(centroids), np.int64)
        total = np.zeros(centroids.shape, object)
        for batch in stream:
            x = matrix(batch.column(0))
            champion, _ = planes.assign(x)
            for c in np.unique(champion):
                own = x[champion == c]
                peak = int(max(-int(own.min(initial=0)), int(own.max(initial=0))))
                count[c] += len(own)
                total[c] += own.astype(np.int64 if len(own) * peak < 2**62 else object).sum(axis=0).astype(object)
        used = np.flatnonzero(count)
        # two whole numbers a component, so that sums of any size travel as longs
        high, low = (total >> 31)[used], (total & (2**31 - 1))[used]
        cells = lambda m: pa.array([[int(v) for v in row] for row in m], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(count[used]), cells(high), cells(low)], names=["cluster", "n", "high", "low"])

    parts = vectors.select("vec").mapInArrow(totals, "cluster int, n bigint, high array<bigint>, low array<bigint>")
    cells = parts.select("cluster", "n", F.posexplode(F.arrays_zip("high", "low")).alias("at", "part"))
    add = lambda c: F.sum(F.col(c).cast("decimal(20,0)"))
    rows = cells.groupBy("cluster", "at").agg(add("n").alias("n"), add("part.high").alias("high"), add("part.low").alias("low")).collect()
    new = centroids.copy()
    for r in rows:  # one row per centroid and dimension
        new[r["cluster"], r["at"]] = ((int(r["high"]) << 31) + int(r["low"])) // int(r["n"])
    return new


def bisector_clusters(
    df: DataFrame, k: int = 8, rounds: int = 10, dims: int = 64, scale: float = 1024.0, seed: int = 3, vec_id: str = "vec_id", vec: str = "embedding",
) -> tuple[DataFrame, DataFrame]:
    """``vec_id, cluster, distance, cluster_inertia, inertia`` per vector and ``cluster, centroid`` per centroid: Lloyd rounds over whole-number vectors ``floor(scale * x)``.

    Vectors that are null, of another length than ``dims``, or hold null or non-finite components take no part and have no row. The
    first centroids are the ``k`` vectors with the smallest hex digests of ``seed:vec_id`` (all, if fewer), in that order; rows that repeat an
    id come in the order of their vectors and are vectors of their own; rows without an id count, and come last among the first centroids. Equal distances go to the smaller number; a centroid that loses
    all vectors stays where it is. An empty table, or one without usable vectors, gives two empty results. Components beyond 2^62 after scaling and distances beyond 2^63 raise an error.

    The driver holds ``k`` centroids of ``dims`` components, one sum a round for each, and the planes between them (at most 2^24 components).
    """
    if k < 1 or k * (k - 1) // 2 * dims > PLANES:
        raise ValueError(f"{k} centroids of {dims} dimensions: planes between them are limited to {PLANES} components")
    spark = df.sparkSession
    rows = df.where(finite(F.col(vec)) & (F.size(vec) == dims)).select(F.col(vec_id).cast("long").alias("vec_id"), whole_numbers(F.col(vec), scale).alias("vec"))
    rows = store(rows, "vectors")
    centroids = _seeds(rows, k, dims, seed)
    for _ in range(rounds if len(centroids) else 0):
        centroids = _moved(rows, centroids)
    planes = Planes(centroids)

    def nearest(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            champion, square = planes.assign(matrix(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(champion), pa.array(square)], names=["vec_id", "cluster", "distance"])

    told = store(rows.mapInArrow(nearest, "vec_id bigint, cluster int, distance bigint"), "assigned")
    sums = {r["cluster"]: int(r["sum"]) for r in told.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("sum")).collect()}
    total = sum(sums.values())
    if total >= 2**63:
        raise OverflowError("the sum of all distances does not fit a long")
    inertia = spark.createDataFrame([(c, v, total) for c, v in sums.items()], "cluster int, cluster_inertia bigint, inertia bigint")
    final = spark.createDataFrame([(c, [int(v) for v in row]) for c, row in enumerate(centroids)], "cluster int, centroid array<bigint>")
    # at most k rows
    return told.join(F.broadcast(inertia), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia"), final
