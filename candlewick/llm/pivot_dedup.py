"""Near duplicates of vectors by a pivot-permutation index.

A vector is described by its nearest reference points (pivots) in order. Inverted lists name the vectors that hold a pivot;
vectors that meet in a list are counted by the pivots they share and, from ``shared`` on, compared exactly. A list is cut into
blocks, and a task compares two blocks of a list, so its memory does not depend on the length of the list. A pair is counted in the list of the first
pivot both hold, and nowhere else.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import let, runs, store
from candlewick.llm.components import components


SAMPLE = 8  # vectors looked at for each pivot
NEAREST = 4  # pivots are at least so many times as far apart (one minus the cosine) as links may be


def choose_pivots(vectors: DataFrame, count: int, nearest: float) -> np.ndarray:
    """At most ``count`` vectors, of a sample of fixed size, each as far as can be from those before.

    Once all others have a cosine above ``nearest`` with a pivot no more are taken: pivots within a group of near copies would be told
    apart by noise only.
    """
    ids = vectors.select("node").orderBy(F.xxhash64(F.lit(11), "node"), "node").limit(SAMPLE * count).distinct()
    rows = vectors.join(F.broadcast(ids), "node", "left_semi").orderBy("node", "label").limit(SAMPLE * count).select("vec").toArrow()
    if not rows.num_rows:
        return np.empty((0, 0))
    sample = _matrix(rows.column("vec"))
    taken, close = [0], sample @ sample[0]
    while len(taken) < count:
        far = int(close.argmin())
        if close[far] > nearest:
            break
        taken.append(far)
        close = np.maximum(close, sample @ sample[far])
        close[far] = 1.0 if nearest < 1 else np.inf
    return sample[taken]


def _unit(v: Column) -> Column:
    return let(F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x)), lambda n: F.transform(v, lambda x: x / n))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(flat.flatten()).reshape(len(flat), -1)


def describe(vectors: DataFrame, pivots: np.ndarray, prefix: int) -> DataFrame:
    """Adds ``pivots``: numbers of the ``prefix`` nearest reference points, nearest first."""
    prefix = min(prefix, len(pivots))

    def nearest(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            if batch.num_rows:
                close = _matrix(batch.column("vec")) @ pivots.T
                order = np.argsort(-close, axis=1, kind="stable")[:, :prefix].astype(np.int32)
                found = pa.ListArray.from_arrays(pa.array(np.arange(0, order.size + 1, prefix, dtype=np.int32)), pa.array(order.ravel()))
                yield pa.RecordBatch.from_arrays([*batch.columns, found], names=[*batch.schema.names, "pivots"])

    return vectors.mapInArrow(nearest, f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in vectors.schema)}, pivots array<int>")


def _links(pivot: int, a: tuple, b: tuple | None, threshold: float, shared: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of one list: (node, vectors linked, smallest node of its group) for the links within ``a``, or between ``a`` and ``b``."""
    (ids, vecs, held, weight), (ids2, vecs2, held2, weight2) = a, b or a
    wide = int(max(held.max(), held2.max())) + 1
    flags, flags2 = (np.zeros((len(h), wide), np.float32) for h in (held, held2))
    flags[np.arange(len(held))[:, None], held] = 1
    flags2[np.arange(len(held2))[:, None], held2] = 1
    first = (flags[:, :pivot] @ flags2[:, :pivot].T) == 0 if pivot else np.ones((len(held), len(held2)), bool)
    match = first & (flags @ flags2.T >= shared)
    if b is None:
        match &= np.triu(np.ones_like(match), 1)
    left, right = np.nonzero(match)
    near = np.empty(len(left), bool)
    for at in range(0, len(left), 1 << 16):
        part = slice(at, at + (1 << 16))
        near[part] = np.einsum("ij,ij->i", vecs[left[part]], vecs2[right[part]]) >= threshold
    x, y = ids[left[near]], ids2[right[near]]
    nodes, ends = np.unique(np.concatenate([x, y]), return_inverse=True)
    i, j = ends[: len(x)], ends[len(x) :]
    n = np.bincount(i, weight2[right[near]], len(nodes)) + np.bincount(j, weight[left[near]], len(nodes))
    return nodes, n.astype(np.int64), nodes[_groups(i, j, len(nodes))]


def _groups(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """Smallest member of the group of each of ``n`` nodes."""
    low = np.arange(n)
    while True:
        meet = np.minimum(low[i], low[j])
        new = low.copy()
        np.minimum.at(new, i, meet)
        np.minimum.at(new, j, meet)
        new = new[new]
        if (new == low).all():
            return low
        low = new


def pivot_dedup(
    df: DataFrame, threshold: float = 0.98, pivots: int = 512, prefix: int = 8, shared: int = 2, block: int = 2048, vec_id: str = "vec_id", vec: str = "embedding", label: str | None = "label",
) -> DataFrame:
    """``vec_id, n_links, component_id, kept``: vectors of the same label with cosine >= ``threshold`` are linked.

    Null, zero and non-finite vectors, those with null components and those without a label link with nothing and are their own
    component. Equal vectors of a label are one node of the index and linked with each other. Ids are whole numbers; rows that repeat an id are
    vectors of their own with a common component; a row without an id takes no part and has no component. Vectors of another length than the pivots form a
    group of their own length. An empty table gives an empty result. The index is approximate: a pair is found if it shares ``shared``
    of the ``prefix`` nearest of ``pivots`` reference points; the reference points come from a sample of fixed size and stand apart from each other, every row is indexed.
    """
    wide = F.col(vec).cast("array<double>")
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), wide.alias("raw"), (F.col(label).cast("string") if label else F.lit("")).alias("label"))
    finite = F.forall("raw", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    # scaled by the largest component first, so that squares neither overflow nor vanish
    top = F.array_max(F.transform("raw", lambda x: F.abs(x)))
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite, F.lit(False)) & F.coalesce(top > 0, F.lit(False))
    rows = store(rows.withColumn("ok", usable), "vectors")
    nodes = rows.where("ok").groupBy("label", "raw").agg(F.min("vec_id").alias("node"), F.count("*").alias("weight"))
    scaled = let(top, lambda t: F.transform("raw", lambda x: x / t))
    nodes = store(nodes.withColumn("vec", let(scaled, _unit)).withColumn("size", F.size("raw")), "nodes")
    lengths = [r["size"] for r in nodes.groupBy("size").count().orderBy("size").collect()]
    schema = "node bigint, links bigint, other bigint"
    found = df.sparkSession.createDataFrame([], schema)
    for size in lengths:  # one or very few; vectors of different length are never compared
        found = found.unionByName(_search(nodes.where(F.col("size") == size), threshold, pivots, prefix, shared, block, schema))
    found = store(found, "links")

    roots = components(found.select(F.col("node").alias("a"), F.col("other").alias("b"))).select(F.col("node").alias("_n"), "root")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    answer = nodes.select("label", "raw", "node", "weight").join(counts, "node", "left").join(roots, F.col("node") == F.col("_n"), "left")
    answer = answer.select(F.col("label").alias("_l"), F.col("raw").alias("_r"), "node", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("_links"), F.coalesce("root", "node").alias("_root"))
    joined = rows.join(answer, F.col("ok") & (F.col("label") == F.col("_l")) & (F.col("raw") == F.col("_r")), "left")
    component = F.coalesce("_root", "vec_id")
    return joined.select("vec_id", F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))


def _search(nodes: DataFrame, threshold: float, pivots: int, prefix: int, shared: int, block: int, schema: str) -> DataFrame:
    """Links found in the inverted lists: per list and node, the vectors linked and the smallest node it hangs together with."""
    points = choose_pivots(nodes, pivots, 1 - NEAREST * (1 - threshold))
    shared = min(shared, len(points))
    held = store(describe(nodes.select("label", "node", "weight", "vec"), points, prefix), "described")
    lists = held.select("label", F.explode("pivots").alias("pivot")).groupBy("label", "pivot").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    entry = held.select("label", "node", "weight", "vec", "pivots", F.explode("pivots").alias("pivot")).join(lists, ["label", "pivot"])
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    entry = entry.withColumn("own", own).withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    lo, hi = F.least("own", "with").alias("lo"), F.greatest("own", "with").alias("hi")
    entry = entry.select("label", "pivot", lo, hi, "own", "node", "weight", "vec", "pivots")
    ready = entry.repartition("label", "pivot", "lo", "hi").sortWithinPartitions("label", "pivot", "lo", "hi")

    def compare(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in runs(stream, ["label", "pivot", "lo", "hi"]):
            pivot, lo, hi = (t.column(c)[0].as_py() for c in ("pivot", "lo", "hi"))
            own = np.asarray(t.column("own"))
            ids, weight = np.asarray(t.column("node")), np.asarray(t.column("weight"))
            vecs, held = _matrix(t.column("vec")), _matrix(t.column("pivots"))
            side = lambda m: (ids[m], vecs[m], held[m], weight[m])
            a, b = own == lo, own == hi
            if lo != hi and not (a.any() and b.any()):
                continue
            found = _links(pivot, side(a), None if lo == hi else side(b), threshold, shared)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["node", "links", "other"])

    return ready.mapInArrow(compare, schema)
