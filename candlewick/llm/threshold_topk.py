"""Exact top k by inner product with Fagin's threshold algorithm.

Candidates are cut into blocks; a block sorts its vectors once per dimension. For a query the lists are read from their best
end (the top where the query is positive, the bottom where it is negative), deeper in every round; a vector met for the first
time is scored in full. The inner product of the values at the present depth bounds every vector not met yet; reading stops
when that bound lies below the k-th best score (at equal scores a smaller id could still win). The best of all blocks merge.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.llm.common import store

FIRST_DEPTH = 32


class SortedLists:
    """One block of candidates with its per-dimension lists."""

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        by_id = np.argsort(ids, kind="stable")
        self.ids, self.values = ids[by_id], values[by_id]
        # products of whole numbers are exact in doubles up to 2**53
        self.peak = float(np.abs(values).max(initial=0))
        self.floats = self.values.astype(np.float64)
        self.order = np.argsort(self.values, axis=0, kind="stable")
        self.sorted = np.take_along_axis(self.values, self.order, 0)

    def scores(self, at: np.ndarray, q: np.ndarray) -> np.ndarray:
        if self.peak * float(np.abs(q).max(initial=0)) * max(1, len(q)) < 2.0**53:
            return (self.floats[at] @ q.astype(np.float64)).astype(np.int64)
        return self.values[at] @ q

    def top(self, own: int, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the best ``k`` but ``own``, best first, equal scores by id."""
        n = len(self.ids)
        dims = np.flatnonzero(q)
        weights, rising = q[dims], q[dims] < 0
        met = self.ids == own  # a query is not its own candidate
        best, score = np.empty(0, np.int64), np.empty(0, np.int64)
        depth, step = 0, FIRST_DEPTH
        while depth < n and not met.all():
            until = min(n, depth + step)
            rows = np.where(rising[:, None], np.arange(depth, until)[None, :], n - 1 - np.arange(depth, until)[None, :]) if len(dims) else np.arange(depth, until)[None, :]
            seen = np.zeros(n, bool)
            seen[self.order[rows, dims[:, None]] if len(dims) else rows] = True
            new = np.flatnonzero(seen & ~met)
            met[new] = True
            best, score = np.concatenate([best, new]), np.concatenate([score, self.scores(new, q)])
            keep = np.lexsort((best, -score))[:k]
            best, score = best[keep], score[keep]
            depth, step = until, step * 2
            if len(dims):
                edge = self.sorted[np.where(rising, depth - 1, n - depth), dims]
                if len(best) == k and int((edge.astype(object) * weights.astype(object)).sum()) < int(score[-1]):
                    break
        return self.ids[best], score


def top_k(
    df: DataFrame, k: int = 10, every: int = 100, scale: float = 1024.0, vec_id: str = "vec_id", vec: str = "embedding", block: int = 2048, queries: int = 1024,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each vector whose id is divisible by ``every``, the ``k`` others with the highest inner
    product of whole-number vectors ``floor(scale * x)``, equal scores by smaller id.

    Vectors that are null or hold null or non-finite components, and rows without an id, take no part; a query scores only vectors
    of its own length. Fewer than ``k`` others give fewer rows; an empty table none. Rows that repeat an id are candidates of their own and answer as one
    query. Queries and candidates meet in pairs of blocks; a task holds one block of each.
    """
    parts = F.transform(F.col(vec).cast("array<double>"), lambda x: F.floor(x * scale).cast("long"))
    finite: Column = F.forall(F.col(vec).cast("array<double>"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * scale) < 2.0**62))
    rows = df.where(F.col(vec_id).isNotNull() & F.coalesce(finite, F.lit(False))).select(F.col(vec_id).cast("long").alias("vec_id"), parts.alias("vec"))
    rows = store(rows.withColumn("size", F.size("vec")), "whole")
    asked = store(rows.where(F.pmod("vec_id", F.lit(every)) == 0).dropDuplicates(["vec_id"]), "asked")
    n, n_asked = rows.count(), asked.count()
    cuts, cuts_asked = max(1, -(-n // block)), max(1, -(-n_asked // queries))
    side = lambda d, own, other, n_own, n_other: (
        d.withColumn(own, F.pmod(F.xxhash64("vec_id"), F.lit(n_own)).cast("int")).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))))
    )
    keys = ["size", "block", "asked"]

    def search(asked: pa.Table, held: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, ...]] = []
        if asked.num_rows and held.num_rows:
            matrix = lambda t: np.asarray(t.column("vec").combine_chunks().flatten(), np.int64).reshape(t.num_rows, -1)
            lists = SortedLists(np.asarray(held.column("vec_id"), np.int64), matrix(held))
            for own, q in zip(asked.column("vec_id").to_pylist(), matrix(asked), strict=True):
                ids, scores = lists.top(own, q, k)
                out.append((np.full(len(ids), own), ids, scores))
        columns = [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.empty(0, np.int64)] * 3
        return pa.table([pa.array(x.astype(np.int64)) for x in columns], names=["query_id", "vec_id", "score"])

    left = side(asked, "asked", "block", cuts_asked, cuts).groupBy(*keys)
    right = side(rows, "block", "asked", cuts, cuts_asked).groupBy(*keys)
    found = left.cogroup(right).applyInArrow(search, "query_id bigint, vec_id bigint, score bigint")
    # best of a few blocks first, so that a query with very many blocks is never ranked in one piece
    order = [F.desc("score"), F.asc("vec_id")]
    part = F.pmod(F.xxhash64("vec_id"), F.lit(max(1, cuts // 64)))
    found = found.withColumn("_part", part).withColumn("_r", F.row_number().over(Window.partitionBy("query_id", "_part").orderBy(*order))).where(F.col("_r") <= k)
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order))).where(F.col("rank") <= k)
    return found.select("query_id", "rank", "vec_id", "score")
