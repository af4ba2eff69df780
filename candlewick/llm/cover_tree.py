"""Vector codes: every vector becomes one codebook entry per part; the codebooks are learned by Lloyd rounds over cover trees.

Rows are cut into blocks inside their partitions. A block has one cover tree per part: a node covers a run of the block's distinct
parts (laid out in tree order, with running sums of counts and components) within a radius around one of them, and its children are centers more than
half that radius apart that cover the same run. In a round a node keeps the codebook entries that can still be nearest
to one of its points: by the triangle inequality those at most two radii farther from its center than the closest one. When a single entry is left the
whole subtree goes to it, its count and sum being differences of the running sums; other nodes pass the question to their
children, and only points of ambiguous leaves are compared one by one. Trees are built once, stored, and read in every round.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.bisector import exact, finite, matrix, whole_numbers
from candlewick.llm.common import sized_join, store

BLOCK = 2048  # rows that share the trees of a block
LEAF = 8  # distinct points below which a node is not split


@dataclass
class Tree:
    """Points in tree order, their counts, and nodes as runs of points; children of a node follow each other."""

    points: np.ndarray
    counts: np.ndarray
    start: np.ndarray
    end: np.ndarray
    center: np.ndarray
    radius: np.ndarray
    first: np.ndarray  # first child, or -1
    last: np.ndarray  # one beyond the last child


def _distances(points: np.ndarray, center: np.ndarray) -> np.ndarray:
    away = points - center
    return np.sqrt((away * away).sum(axis=1).astype(np.float64))


def build(points: np.ndarray, counts: np.ndarray, leaf: int = LEAF) -> tuple[Tree, np.ndarray]:
    """Tree over distinct ``points``, and the points' old numbers in tree order."""
    peak = int(max(-int(points.min(initial=0)), int(points.max(initial=0))))
    x = exact(points, points.shape[1] * 4 * peak * peak)
    order = np.arange(len(points))
    far = _distances(x, x[0])
    nodes = [[0, len(points), 0, float(far.max()), -1, -1]]
    away = far  # distance of the point at each place to the center of the node that holds it
    at = 0
    while at < len(nodes):
        lo, hi, _, radius, _, _ = nodes[at]
        if hi - lo > leaf and radius > 0:
            members, apart = order[lo:hi].copy(), away[lo:hi].copy()
            center = order[nodes[at][2]]
            rest, runs = np.arange(hi - lo), []
            # the node's own center comes first, then any point that no center so far covers
            pick, gap = center, apart
            while True:
                near = gap <= radius / 2
                runs.append((pick, rest[near], gap[near]))
                rest = rest[~near]
                if not len(rest):
                    break
                pick = members[rest[0]]
                gap = _distances(x[members[rest]], x[pick])
            nodes[at][4], nodes[at][5] = len(nodes), len(nodes) + len(runs)
            place = lo
            for chosen, own, gaps in runs:
                until = place + len(own)
                order[place:until], away[place:until] = members[own], gaps
                nodes.append([place, until, place + int(np.flatnonzero(members[own] == chosen)[0]), float(gaps.max()), -1, -1])
                place = until
        at += 1
    table = np.array(nodes, dtype=np.float64).reshape(-1, 6)
    start, end, center, first, last = (table[:, i].astype(np.int64) for i in (0, 1, 2, 4, 5))
    return Tree(points[order], counts[order], start, end, _settled(start, end, center, first, last), table[:, 3], first, last), order


def _settled(start: np.ndarray, end: np.ndarray, center: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Places of the centers after all moves: the center of a node that was split is the one of its first child, deepest nodes first."""
    center = center.copy()
    for node in np.flatnonzero(first >= 0)[::-1]:
        center[node] = center[first[node]]
    return center


def _ranges(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All places of some runs, one run after the other."""
    sizes = end - start
    return np.repeat(start - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


def assign(tree: Tree, entries: np.ndarray) -> tuple[np.ndarray, int]:
    """Nearest entry of each point of the tree (equal distances: the smaller number), and how many points were compared one by one."""
    dims = tree.points.shape[1]
    peak = max(int(np.abs(tree.points).max(initial=0)), max((abs(int(v)) for v in entries.ravel()), default=0))
    reach = dims * 4 * peak * peak
    x, book = exact(tree.points, reach), exact(entries, reach)
    square = (book * book).sum(axis=1)
    code = np.full(len(x), -1, np.int32)
    compared = 0
    nodes = np.zeros(1, np.int64)
    open_to = np.ones((1, len(book)), bool)
    while len(nodes):
        at = x[tree.center[nodes]]
        gap = (at * at).sum(axis=1)[:, None] - 2 * (at @ book.T) + square[None, :]
        gap = np.sqrt(gap.astype(np.float64))
        nearest = np.where(open_to, gap, np.inf).min(axis=1)
        # a hair wider than the bound, so that rounding of roots and radii drops nothing
        reachable = open_to & (gap <= ((nearest + 2 * tree.radius[nodes]) * (1 + 1e-12) + 1e-9)[:, None])
        single = reachable.sum(axis=1) == 1
        leaf = ~single & (tree.first[nodes] < 0)
        code[_ranges(tree.start[nodes[single]], tree.end[nodes[single]])] = np.repeat(reachable[single].argmax(axis=1), tree.end[nodes[single]] - tree.start[nodes[single]])
        places = _ranges(tree.start[nodes[leaf]], tree.end[nodes[leaf]])
        if len(places):
            code[places] = (square[None, :] - 2 * (x[places] @ book.T)).argmin(axis=1)
            compared += len(places)
        split = ~single & ~leaf
        parents = nodes[split]
        nodes = _ranges(tree.first[parents], tree.last[parents])
        open_to = np.repeat(reachable[split], tree.last[parents] - tree.first[parents], axis=0)
    return code, compared


def sums(tree: Tree, code: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(vectors, sums of components) per entry, from running sums over the runs of equal codes."""
    peak = max(1, int(np.abs(tree.points).max(initial=0)))
    kind = np.int64 if int(tree.counts.sum()) * peak < 2**62 else object
    weighted = tree.points.astype(kind) * tree.counts.astype(kind)[:, None]
    running = np.concatenate([np.zeros((1, weighted.shape[1]), kind), np.cumsum(weighted, axis=0)])
    counted = np.concatenate([[0], np.cumsum(tree.counts)])
    cuts = np.flatnonzero(np.diff(code)) + 1
    lo, hi = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(code)]])
    n, total = np.zeros(k, np.int64), np.zeros((k, weighted.shape[1]), object)
    np.add.at(n, code[lo], counted[hi] - counted[lo])
    np.add.at(total, code[lo], (running[hi] - running[lo]).astype(object))
    return n, total


#: One row per block; a tree per part, points of all dimensions one after the other.
LISTS = {"points": pa.int64(), "counts": pa.int64(), "place": pa.int32(), "start": pa.int32(), "stop": pa.int32(), "center": pa.int32(), "radius": pa.float64(), "first": pa.int32(), "last": pa.int32()}
SQL_TYPES = {pa.int64(): "bigint", pa.int32(): "int", pa.float64(): "double"}
TREE = ", ".join(f"{n}: array<{SQL_TYPES[t]}>" for n, t in LISTS.items())
FOREST = f"ids array<bigint>, labels array<string>, trees array<struct<{TREE}>>"
SMALL_GROUPS = {"parquet__block__size": 32 << 20, "parquet__block__size__row__check__min": 4}  # a reader holds one row group


def _lists(values: list, kind: pa.DataType) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.concat_arrays([v if isinstance(v, pa.Array) else pa.array(v, kind) for v in values]))


def _block(ids: pa.Array, labels: pa.Array, x: np.ndarray, parts: int) -> pa.RecordBatch:
    """One tree per part over the rows of a block."""
    width = x.shape[1] // parts
    trees = []
    for part in range(parts):
        points, which, counts = np.unique(x[:, part * width : (part + 1) * width], axis=0, return_inverse=True, return_counts=True)
        tree, order = build(points, counts)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        trees.append((tree.points.ravel(), tree.counts, place[which.ravel()], tree.start, tree.end, tree.center, tree.radius, tree.first, tree.last))
    columns = [_lists(list(c), kind) for c, kind in zip(zip(*trees, strict=True), LISTS.values(), strict=True)]
    held = pa.ListArray.from_arrays(pa.array([0, parts], pa.int32()), pa.StructArray.from_arrays(columns, names=list(LISTS)))
    return pa.RecordBatch.from_arrays([_lists([ids], pa.int64()), _lists([labels], pa.string()), held], names=["ids", "labels", "trees"])


def _trees(batch: pa.RecordBatch, width: int) -> Iterator[list[tuple[Tree, np.ndarray]]]:
    """Trees of each block with the place of every row in them."""
    for held in batch.column("trees"):
        fields = {name: held.values.field(name) for name in LISTS}
        found = []
        for i in range(len(held.values)):
            get = lambda name: np.asarray(fields[name].slice(i, 1).flatten())  # noqa: B023, E731
            where = [get(c).astype(np.int64) for c in ("start", "stop", "center")]
            tree = Tree(get("points").reshape(-1, width), get("counts"), *where, get("radius"), get("first").astype(np.int64), get("last").astype(np.int64))
            found.append((tree, get("place")))
        yield found


def grow(vectors: DataFrame, parts: int, block: int = BLOCK) -> DataFrame:
    """Trees of all blocks; ``vectors`` holds ``vec_id, label, vec`` with vectors of one length."""

    def plant(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0

        def close() -> pa.RecordBatch:
            ids, labels, vecs = (pa.concat_arrays([b.column(c) for b in held]) for c in (0, 1, 2))
            return _block(ids, labels, matrix(vecs), parts)

        for batch in stream:
            while batch.num_rows:
                head = batch.slice(0, block - rows)
                held, rows, batch = [*held, head], rows + head.num_rows, batch.slice(head.num_rows)
                if rows == block:
                    yield close()
                    held, rows = [], 0
        if rows:
            yield close()

    return vectors.select("vec_id", "label", "vec").mapInArrow(plant, FOREST)


def _moved(forest: DataFrame, books: np.ndarray) -> np.ndarray:
    """Floors of the means of each entry's parts; an entry without parts stays."""
    parts, k, width = books.shape

    def totals(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros((parts, k), np.int64), np.zeros((parts, k, width), object)
        for batch in stream:
            for block in _trees(batch, width):
                for part, (tree, _) in enumerate(block):
                    n, s = sums(tree, assign(tree, books[part])[0], k)
                    count[part] += n
                    total[part] += s
        part, entry = np.nonzero(count)
        # two whole numbers a component, so that sums of any size travel as longs
        cells = lambda m: pa.array([[int(v) for v in row] for row in m[part, entry]], pa.list_(pa.int64()))
        columns = [pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(count[part, entry]), cells(total >> 31), cells(total & (2**31 - 1))]
        yield pa.RecordBatch.from_arrays(columns, names=["part", "entry", "n", "high", "low"])

    found = forest.select("trees").mapInArrow(totals, "part int, entry int, n bigint, high array<bigint>, low array<bigint>")
    cells = found.select("part", "entry", "n", F.posexplode(F.arrays_zip("high", "low")).alias("at", "cell"))
    add = lambda c: F.sum(F.col(c).cast("decimal(20,0)"))
    new = books.copy()
    for r in cells.groupBy("part", "entry", "at").agg(add("n").alias("n"), add("cell.high").alias("high"), add("cell.low").alias("low")).collect():
        new[r["part"], r["entry"], r["at"]] = ((int(r["high"]) << 31) + int(r["low"])) // int(r["n"])
    return new


def _codes(forest: DataFrame, books: np.ndarray) -> DataFrame:
    """``vec_id, label, codes, error`` of every row."""
    parts, _, width = books.shape

    def tell(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for i, block in enumerate(_trees(batch, width)):
                codes, error = [], 0
                for part, (tree, place) in enumerate(block):
                    code, _ = assign(tree, books[part])
                    peak = max(int(np.abs(tree.points).max(initial=0)), max(abs(int(v)) for v in books[part].ravel()))
                    away = exact(tree.points, parts * width * 4 * peak * peak)
                    away = away - books[part].astype(away.dtype)[code]
                    square = (away * away).sum(axis=1)
                    codes.append(code[place])
                    error = error + (square if square.dtype == object else square.astype(np.int64))[place]
                flat = np.stack(codes, axis=1).astype(np.int32)
                offsets = pa.array(np.arange(0, flat.size + 1, parts, dtype=np.int32))
                head = [batch.column(c).slice(i, 1).flatten() for c in ("ids", "labels")]
                yield pa.RecordBatch.from_arrays([*head, pa.ListArray.from_arrays(offsets, pa.array(flat.ravel())), pa.array([int(e) for e in error], pa.int64())], names=["vec_id", "label", "codes", "error"])

    return forest.mapInArrow(tell, "vec_id bigint, label string, codes array<int>, error bigint")


def cover_tree_codes(
    df: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: float = 4096.0, vec_id: str = "vec_id", vec: str = "embedding", label: str = "label",
) -> tuple[DataFrame, DataFrame]:
    """``vec_id, label, size, codes, error, label_error`` per vector and ``size, codebooks`` per vector length: one codebook entry (from 0) per part
    of every vector ``floor(scale * x)``.

    Vectors that are null or hold null or non-finite components, and those that cannot be cut into ``parts`` equal parts of at least one component, take no part and have no row.
    Vectors of each length (``size``) have codebooks of their own. The first entries are the parts of the ``entries`` smallest ids (all rows, if
    fewer), rows that repeat an id in the order of their vectors, rows without an id last. Equal distances go to the lower index, entries without parts stay. ``error`` is the
    squared distance summed over the parts, ``label_error`` its sum over the rows of the label (all rows without a label together, all lengths together); ``label`` is read as a string.
    ``codebooks`` holds all components by part, entry and position. An empty table gives two empty results. Components beyond 2^62 after scaling and errors beyond 2^63 raise an error.

    A task holds one Arrow batch of trees (64 MB by Spark's default, about 1.5 MB a block of 64 dimensions) and the codebooks; the driver holds one sum per part, entry and position.
    """
    spark = df.sparkSession
    usable = df.where(finite(F.col(vec)) & (F.size(vec) > 0) & (F.size(vec) % parts == 0))
    rows = usable.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"), whole_numbers(F.col(vec), scale).alias("vec"))
    rows = store(rows, "vectors")
    lengths = [r["size"] for r in rows.groupBy(F.size("vec").alias("size")).count().orderBy("size").collect()]
    told = spark.createDataFrame([], "vec_id bigint, label string, codes array<int>, error bigint, size int")
    shown = []
    for size in lengths:  # one or very few
        alike = rows.where(F.size("vec") == size)
        first = alike.select("vec_id", "vec").orderBy(F.asc_nulls_last("vec_id"), "vec").limit(entries).collect()
        books = np.array([r["vec"] for r in first], dtype=object).reshape(len(first), parts, size // parts).transpose(1, 0, 2)
        forest = store(grow(alike, parts), "forest", **SMALL_GROUPS)
        for _ in range(rounds):
            books = _moved(forest, books)
        shown.append((size, [int(v) for v in books.ravel()]))
        told = told.unionByName(_codes(forest, books).withColumn("size", F.lit(size)))
    told = store(told, "codes")
    # labels get a key that is never null
    keyed = lambda d: d.withColumn("_k", F.concat(F.when(F.col("label").isNull(), F.lit("n")).otherwise(F.lit("v")), F.coalesce("label", F.lit(""))))
    totals = store(keyed(told).groupBy("_k").agg(F.sum(F.col("error").cast("decimal(38,0)")).cast("bigint").alias("label_error")), "label_error")
    answer = sized_join(keyed(told), totals, "_k", "inner", totals.count()).select("vec_id", "label", "size", "codes", "error", "label_error")
    return answer, spark.createDataFrame(shown, "size int, codebooks array<bigint>")
