"""Jaccard join of documents on word shingles by universe partitioning and the pigeonhole principle.

Two sets that link differ in at most ``budget`` shingles, a number that follows from their sizes. The universe of shingles is hashed
into slots; what a set holds of a slot is a segment. Sets are indexed by size band, since only sets of the same or of
neighbouring bands can link, with slots for the largest sizes of the band:

* with more slots than the budget, one segment at least is the same in both sets. ``spare`` slots more leave ``spare`` + 1 equal
  segments, so each set may leave out that many: it leaves out its smallest segments, which many sets share. Any order that
  depends on the segment alone loses nothing.
* two slots can be taken together and indexed with their one-deletion neighbourhood: equal up to one shingle. That uses up two of
  the budget and gives larger, rarer segments for more index rows. How many slots of a band are paired is decided by cost, with
  the overlap of random pairs of documents estimated on a sample of fixed size. It changes the work, never the result.

Sets that share an index key are candidates and are compared exactly. ``components.settle`` finds the groups without a row per pair: the
sets of a key are compared with one of them, and what is still apart then is compared block by block, as products of matrices.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import runs, sized_join, store
from candlewick.llm.components import meetings, settle

SLICE = 300_000  # bytes of text handled at once; a longer text is handled by itself
PART = 4  # one shingle in so many decides which sets are compared as a whole
_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every bit over all 64."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_RNG = np.random.default_rng(20)
_LETTER = _RNG.integers(0, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_LETTER[ord("A") : ord("Z") + 1] = _LETTER[ord("a") : ord("z") + 1]  # A-Z count as a-z
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_BASE = 0x9E3779B97F4A7C15
_PLACE = _mix(np.arange(1, 65, dtype=np.uint64))


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


class Shingler:
    """Distinct shingles of texts as 64-bit numbers; ``width`` words each, a shorter text as one."""

    def __init__(self, width: int):
        self.width, self.up, self.down = width, _powers(_BASE, 2), _powers(pow(_BASE, -1, 2**64), 2)

    def __call__(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first row, row number of each shingle within the slice, shingles sorted within a row) for slices of the rows."""
        raw = texts.cast(pa.large_binary()).fill_null(b"")
        borders = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
        data = np.frombuffer(raw.buffers()[2] or b"", np.uint8)
        at = 0
        while at < len(raw):
            until = max(at + 1, int(np.searchsorted(borders, borders[at] + SLICE, "right")) - 1)
            until = min(until, len(raw))
            part = borders[at : until + 1]
            rows, shingles = self._slice(data[part[0] : part[-1]], part[:-1] - part[0], part[1:] - part[0])
            yield at, rows, shingles
            at = until

    def _slice(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(data)
        if n + 1 > len(self.up):
            self.up, self.down = _powers(_BASE, n + 1), _powers(pow(_BASE, -1, 2**64), n + 1)
        word = ~_SPACE[data]
        before, after = np.zeros(n, bool), np.zeros(n, bool)
        before[1:], after[:-1] = word[:-1], word[1:]
        full = ends > starts
        before[starts[full]] = False
        after[ends[full] - 1] = False
        first, last = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_LETTER[data] * self.up[:n], dtype=np.uint64)])
        words = _mix((sums[last] - sums[first]) * self.down[first])
        row = np.searchsorted(ends, first, "right")
        count = np.bincount(row, minlength=len(starts))
        begin = np.cumsum(count) - count
        # every place of a long text, the first place of a short one
        place = np.arange(len(words)) - begin[row]
        short = count[row] < self.width
        use = np.flatnonzero(np.where(short, place == 0, place <= count[row] - self.width))
        total = np.zeros(len(use), np.uint64)
        for j in range(self.width):
            inside = j < np.minimum(count[row[use]], self.width)
            total += np.where(inside, words[np.minimum(use + j, max(0, len(words) - 1))] * _PLACE[j], _U(0))
        shingles = _mix(total + _PLACE[self.width] * np.minimum(count[row[use]], self.width).astype(np.uint64))
        order = np.lexsort((shingles, row[use]))
        rows, shingles = row[use][order], shingles[order]
        fresh = np.ones(len(rows), bool)
        fresh[1:] = (rows[1:] != rows[:-1]) | (shingles[1:] != shingles[:-1])
        return rows[fresh], shingles[fresh]


def bands(percent: int, largest: int) -> np.ndarray:
    """Smallest size of each band: a set links only with sets of its own, the next or the former band."""
    starts = [1]
    while starts[-1] <= largest:
        starts.append(starts[-1] * 100 // percent + 1)
    return np.array(starts, np.int64)


def budget(percent: int, largest: int) -> int:
    """Most shingles in which two linked sets of at most ``largest`` shingles differ."""
    return (100 - percent) * 2 * largest // (100 + percent)


def spare(differ: int) -> int:
    return -(-3 * (differ + 1) // 100) if differ else 0


def allocate(differ: int, largest: int, sets: float, overlap: float) -> int:
    """Number of slot pairs with one-deletion neighbourhoods that costs least: index rows and expected candidates of a set."""
    each = largest / (differ + 1)  # shingles of a slot

    def cost(pairs: int) -> float:
        single = differ + 1 - 2 * pairs
        rows = single + pairs * (1 + 2 * each)
        return rows + sets * (single * overlap**each + pairs * (1 + 2 * each) * overlap ** (2 * each - 1))

    return min(range((differ + 1) // 2 + 1), key=cost)


class Index:
    """Keys of sets: for each set those of its own band and, as a smaller partner, of the next."""

    def __init__(self, percent: int, starts: np.ndarray, paired: list[int]):
        self.starts = starts
        self.differ = np.array([budget(percent, int(s) - 1) for s in starts[1:]], np.int64)
        self.spare = np.array([spare(int(d)) for d in self.differ], np.int64)
        self.paired = np.array(paired, np.int64)

    def keys(self, row: np.ndarray, shingles: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, key) of all index keys; shingles are sorted within a row."""
        size = np.bincount(row, minlength=rows)
        own = np.searchsorted(self.starts, size, "right") - 1
        out = [self._band(row, shingles, size, np.minimum(own + step, len(self.differ) - 1), own + step < len(self.differ)) for step in (0, 1)]
        return np.concatenate([r for r, _ in out]), np.concatenate([k for _, k in out])

    def _band(self, row: np.ndarray, shingles: np.ndarray, size: np.ndarray, band: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        take = (part & (size > 0))[row]
        row, shingles = row[take], shingles[take]
        differ, left_out, paired = self.differ[band], self.spare[band], self.paired[band]
        slots = differ + 1 + left_out
        slot = ((shingles >> _U(33)) * slots[row].astype(np.uint64) >> _U(31)).astype(np.int64)
        double = slot < 2 * paired[row]
        slot = np.where(double, slot // 2, slot)  # both slots of a pair have the number of the pair; no single slot has it
        fresh = np.ones(len(row), bool)
        fresh[1:] = (row[1:] != row[:-1]) | (slot[1:] != slot[:-1]) | (double[1:] != double[:-1])
        begin = np.flatnonzero(fresh)
        spread = _mix(shingles + _U(0x632BE59BD9B4E019))
        held = np.diff(np.append(begin, len(row)))
        total = np.add.reduceat(spread, begin) if len(begin) else np.empty(0, np.uint64)
        seg_row, seg_slot, seg_double = row[begin], slot[begin], double[begin]
        # empty slots: only rows that hold too few segments need them
        present = np.bincount(seg_row[~seg_double], minlength=len(size))
        wanted = differ + 1 - 2 * paired
        singles = np.flatnonzero((size > 0) & part & (present < wanted))
        empty = [self._empty(r, seg_slot[(seg_row == r) & ~seg_double], np.arange(2 * paired[r], slots[r])) for r in singles]
        doubles = np.flatnonzero((size > 0) & part & (np.bincount(seg_row[seg_double], minlength=len(size)) < paired))
        empty2 = [self._empty(r, seg_slot[(seg_row == r) & seg_double], np.arange(paired[r])) for r in doubles]

        number = lambda r, s, d, t, h: _mix(t + _PLACE[10] * band[r].astype(np.uint64) + _PLACE[11] * s.astype(np.uint64) + _PLACE[12] * h.astype(np.uint64) + _PLACE[13] * np.asarray(d, np.uint64))
        r1, s1, t1, h1 = seg_row[~seg_double], seg_slot[~seg_double], total[~seg_double], held[~seg_double]
        if empty:
            er, es = (np.concatenate(x) for x in zip(*empty, strict=True))
            r1, s1, t1, h1 = np.concatenate([r1, er]), np.concatenate([s1, es]), np.concatenate([t1, np.zeros(len(er), np.uint64)]), np.concatenate([h1, np.zeros(len(er), np.int64)])
        key = number(r1, s1, 0, t1, h1)
        order = np.lexsort((key, -h1, r1))
        r1, key = r1[order], key[order]
        rank = np.arange(len(r1)) - np.searchsorted(r1, r1)
        keep = rank < wanted[r1]
        out_row, out_key = [r1[keep]], [key[keep]]
        if seg_double.any() or empty2:
            r2, s2, t2, h2 = seg_row[seg_double], seg_slot[seg_double], total[seg_double], held[seg_double]
            if empty2:
                er, es = (np.concatenate(x) for x in zip(*empty2, strict=True))
                r2, s2, t2, h2 = np.concatenate([r2, er]), np.concatenate([s2, es]), np.concatenate([t2, np.zeros(len(er), np.uint64)]), np.concatenate([h2, np.zeros(len(er), np.int64)])
            one = np.ones(len(r2), np.uint64)
            out_row.append(r2)
            out_key.append(number(r2, s2, one, t2, h2))
            which = np.cumsum(fresh) - 1  # segment of each shingle
            d = np.flatnonzero(double)
            out_row.append(row[d])
            out_key.append(number(row[d], slot[d], np.ones(len(d), np.uint64), total[which[d]] - spread[d], held[which[d]] - 1))
        return np.concatenate(out_row), np.concatenate(out_key)

    @staticmethod
    def _empty(row: int, there: np.ndarray, every: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        gone = np.setdiff1d(every, there)
        return np.full(len(gone), row), gone


def _describe(docs: DataFrame, width: int) -> DataFrame:
    """``doc_id, n_shingles, d1, d2``: size and digest of every set."""

    def rows(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(width)
        for b in stream:
            size, digest = np.zeros(b.num_rows, np.int64), np.zeros((2, b.num_rows), np.uint64)
            for at, row, s in shingle(b.column("text")):
                begin = np.flatnonzero(np.diff(row, prepend=-1))
                if len(begin):
                    held = row[begin] + at
                    size[held] = np.diff(np.append(begin, len(row)))
                    digest[0, held], digest[1, held] = np.add.reduceat(_mix(s), begin), np.add.reduceat(_mix(s ^ _PLACE[20]), begin)
            d1, d2 = digest.view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(size), pa.array(d1), pa.array(d2)], names=["doc_id", "n_shingles", "d1", "d2"])

    return docs.mapInArrow(rows, "doc_id bigint, n_shingles bigint, d1 bigint, d2 bigint")


def _index_rows(docs: DataFrame, width: int, index: Index) -> DataFrame:
    """``key, node``: of equal sets in one task only the first is indexed; copies are linked by their digest."""

    def rows(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle, seen = Shingler(width), set()
        for b in stream:
            ids = np.asarray(b.column("doc_id").fill_null(0))
            known = np.asarray(b.column("doc_id").is_valid())
            for at, row, s in shingle(b.column("text")):
                begin = np.flatnonzero(np.diff(row, prepend=-1))
                if not len(begin):
                    continue
                digest = zip(np.add.reduceat(_mix(s), begin).tolist(), np.add.reduceat(_mix(s ^ _PLACE[20]), begin).tolist(), strict=True)
                use = np.zeros(int(row[-1]) + 1, bool)
                for r, d in zip(row[begin].tolist(), digest, strict=True):
                    if known[at + r] and d not in seen:
                        seen.add(d)
                        use[r] = True
                keep = use[row]
                r, key = index.keys(row[keep], s[keep], len(use))
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(ids[at + r])], names=["key", "node"])

    return docs.mapInArrow(rows, "key bigint, node bigint")


def _sets(docs: DataFrame, width: int) -> DataFrame:
    """``node, shingles``."""

    def rows(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(width)
        for b in stream:
            for at, row, s in shingle(b.column("text")):
                begin = np.flatnonzero(np.diff(row, prepend=-1))
                if len(begin):
                    lists = pa.ListArray.from_arrays(pa.array(np.append(begin, len(row)).astype(np.int32)), pa.array(s.view(np.int64)))
                    yield pa.RecordBatch.from_arrays([b.column("doc_id").take(pa.array(row[begin] + at)), lists], names=["node", "shingles"])

    return docs.mapInArrow(rows, "node bigint, shingles array<bigint>")


def _parts(docs: DataFrame, width: int) -> DataFrame:
    """``node, n, part``: size of every set and, of the shingles of one residue class, half of the bits.

    What two sets differ in can only become less by leaving out a part of the universe and by taking different shingles for
    equal, so parts that differ too much belong to sets that do not link.
    """

    def rows(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(width)
        for b in stream:
            for at, row, s in shingle(b.column("text")):
                begin = np.flatnonzero(np.diff(row, prepend=-1))
                if len(begin):
                    taken = s % _U(PART) == 0
                    held, short = row[taken], (s[taken] >> _U(32)).astype(np.uint32).view(np.int32)
                    fresh = np.ones(len(held), bool)  # sorted by row and shingle, so equal halves are neighbours
                    fresh[1:] = (held[1:] != held[:-1]) | (short[1:] != short[:-1])
                    held, short = held[fresh], short[fresh]
                    lists = pa.ListArray.from_arrays(pa.array(np.append(np.searchsorted(held, row[begin]), len(held)).astype(np.int32)), pa.array(short))
                    size = np.diff(np.append(begin, len(row)))
                    yield pa.RecordBatch.from_arrays([b.column("doc_id").take(pa.array(row[begin] + at)), pa.array(size), lists], names=["node", "n", "part"])

    return docs.mapInArrow(rows, "node bigint, n bigint, part array<int>")


def _plan(docs: DataFrame, stats: DataFrame, width: int, percent: int, sample: int) -> Index:
    """Bands up to the largest set, and for each the cheapest allocation."""
    starts = bands(percent, stats.agg(F.coalesce(F.max("n_shingles"), F.lit(0))).first()[0])
    edges = F.array(*[F.lit(int(s)) for s in starts])
    band = F.size(F.filter(edges, lambda s: s <= F.col("n_shingles"))) - 1
    counts = {r["band"]: r["n"] for r in stats.where("n_shingles > 0").groupBy(band.alias("band")).agg(F.count("*").alias("n")).collect()}  # a row per band
    chosen = stats.where("n_shingles > 0").select("doc_id", "n_shingles").orderBy(F.xxhash64(F.lit(31), "doc_id"), "doc_id").limit(sample)
    held = _sets(docs.join(F.broadcast(chosen), "doc_id"), width).withColumn("n_shingles", F.size("shingles"))  # ``sample`` rows at most
    shares = held.select(band.alias("band"), F.explode("shingles").alias("s")).groupBy("band", "s").agg(F.count("*").alias("c"))
    pairs = {r["band"]: (r["c"], r["cc"]) for r in shares.groupBy("band").agg(F.sum("c").alias("c"), F.sum(F.col("c") * (F.col("c") - 1)).alias("cc")).collect()}
    sets = {r["band"]: r["n"] for r in held.groupBy(band.alias("band")).agg(F.count("*").alias("n")).collect()}
    paired = []
    for k in range(len(starts) - 1):
        c, cc = pairs.get(k, (1, 0))
        overlap = min(0.99, cc / c / max(1, sets.get(k, 1) - 1))
        largest = int(starts[k + 1]) - 1
        paired.append(allocate(budget(percent, largest), largest, counts.get(k, 0), overlap))
    return Index(percent, starts, paired)


def ngram_join(df: DataFrame, width: int = 4, percent: int = 85, sample: int = 2000, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id``: documents link when 100 * intersection >= ``percent`` * union of their shingle sets.

    A shingle is ``width`` neighbouring words (A-Z lower-cased, cut at ASCII white space); a text with fewer words is one shingle.
    Null, empty and blank texts have an empty set and link with nothing. ``component_id`` is the smallest id reachable by links. Rows that repeat an id
    are one document with all links of its texts; a row without an id links with nothing and has no component. An empty
    table gives an empty result. ``sample`` changes the work, not the result.
    """
    docs = df.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    stats = store(_describe(docs, width), "stats")
    index = _plan(docs, stats, width, percent, sample)
    first = stats.where("n_shingles > 0 AND doc_id IS NOT NULL")
    firsts = first.groupBy("n_shingles", "d1", "d2").agg(F.min("doc_id").alias("b"), F.max("doc_id").alias("_top")).where("b < _top")
    same = first.join(firsts.drop("_top"), ["n_shingles", "d1", "d2"]).select(F.col("doc_id").alias("a"), "b").where("a <> b")
    links = store(same, "copies")

    met = meetings(_index_rows(docs, width, index))
    roots = settle(met, links, lambda pairs: _verified(docs, pairs, width, percent), lambda left: _between(docs, left, width, percent))
    roots = roots.select(F.col("node").alias("_n"), "root")
    return stats.join(roots, F.col("doc_id") == F.col("_n"), "left").select("doc_id", "n_shingles", F.coalesce("root", "doc_id").alias("component_id"))


VOLUME = 400_000  # shingles in a block of sets
COLUMNS = 4096  # shingles whose matrix columns are held at once


def _common(lists: pa.ListArray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Number of values that lists have in common, for every pair of ``left`` and ``right``."""
    size = np.diff(np.asarray(lists.offsets))
    common = np.zeros((len(left), len(right)), np.int64)
    flat, row = np.asarray(lists.flatten()), np.repeat(np.arange(len(size)), size)
    if not len(flat):
        return common
    order = np.argsort(flat, kind="stable")
    flat, row = flat[order], row[order]
    fresh = np.ones(len(flat), bool)
    fresh[1:] = flat[1:] != flat[:-1]
    column = np.cumsum(fresh) - 1
    shared = np.bincount(column) > 1  # a shingle of one set adds to no overlap
    keep = shared[column]
    row, column = row[keep], (np.cumsum(shared) - 1)[column[keep]]
    edges = np.searchsorted(column, np.arange(0, int(column[-1]) + 1 + COLUMNS, COLUMNS)) if len(column) else [0]
    for i, (lo, hi) in enumerate(itertools.pairwise(edges)):
        held = np.zeros((len(size), COLUMNS), np.float32)
        held[row[lo:hi], column[lo:hi] - i * COLUMNS] = 1
        common += (held[left] @ held[right].T).astype(np.int64)
    return common


def _sides(x: pa.Table, y: pa.Table | None) -> tuple[pa.Table, np.ndarray, np.ndarray]:
    """The rows of one or two blocks and the places of both sides of a comparison."""
    both = x if y is None else pa.concat_tables([x, y])
    return both, np.arange(x.num_rows), np.arange(x.num_rows) if y is None else np.arange(x.num_rows, both.num_rows)


def _overlaps(x: pa.Table, y: pa.Table | None, percent: int) -> list[tuple[int, int]]:
    """Links (node, node) between sets of different roots within a block, or between two blocks."""
    both, left, right = _sides(x, y)
    node, root = np.asarray(both.column("node")), np.asarray(both.column("root"))
    if (root == root[0]).all():
        return []
    lists = both.column("shingles").combine_chunks()
    size, common = np.diff(np.asarray(lists.offsets)), _common(lists, left, right)
    union = size[left][:, None] + size[right][None, :] - common
    match = (common * 100 >= union * percent) & (root[left][:, None] != root[right][None, :])
    a, b = np.nonzero(match)
    return list(zip(node[left[a]].tolist(), node[right[b]].tolist(), strict=True))


def _hopeful(x: pa.Table, y: pa.Table | None, percent: int) -> np.ndarray:
    """Whether each row of one or two blocks has a partner of another root whose part does not differ too much."""
    both, left, right = _sides(x, y)
    root = np.asarray(both.column("root"))
    hope = np.zeros(both.num_rows, bool)
    if (root == root[0]).all():
        return hope
    lists = both.column("part").combine_chunks()
    size, n = np.diff(np.asarray(lists.offsets)), np.asarray(both.column("n"))
    differ = size[left][:, None] + size[right][None, :] - 2 * _common(lists, left, right)
    near = (differ * (100 + percent) <= (n[left][:, None] + n[right][None, :]) * (100 - percent)) & (root[left][:, None] != root[right][None, :])
    hope[left[near.any(1)]] = True
    hope[right[near.any(0)]] = True
    return hope


def _blocks(stream: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, pa.Table | None]]:
    """The two blocks of each comparison, or one that is compared with itself."""
    for t in runs(stream, ["family", "lo", "hi"]):
        lo, hi = t.column("lo")[0].as_py(), t.column("hi")[0].as_py()
        own = np.asarray(t.column("own"))
        x, y = t.filter(pa.array(own == lo)), None if lo == hi else t.filter(pa.array(own == hi))
        if x.num_rows and (y is None or y.num_rows):
            yield x, y


def _between(docs: DataFrame, left: DataFrame, width: int, percent: int) -> DataFrame:
    """Links between sets that share a key and are still in different groups.

    Keys with the same smallest node make a family; the sets of a family are cut into blocks of bounded volume, and a task
    compares two blocks: first by parts of the sets, then, of what may link, as a whole. Of the links found by a task only those that join groups are kept.
    """
    first = left.groupBy("key").agg(F.min("node").alias("family")).select(F.col("key").alias("_k"), "family")
    members = store(left.join(first, F.col("key") == F.col("_k")).select("family", "node", "root").distinct(), "members")
    used = store(members.select(F.col("node").alias("doc_id")).distinct(), "used")
    # rows that share an id may have different texts: all of them are compared
    sets = store(_parts(sized_join(docs, used, "doc_id", "left_semi", used.count()), width).distinct(), "parts").withColumnRenamed("node", "_n")
    sized = members.join(sets.select("_n", "n"), F.col("node") == F.col("_n"))
    parts = sized.groupBy("family").agg(F.ceil(F.sum("n") / VOLUME).cast("int").alias("parts")).select(F.col("family").alias("_f"), "parts")
    entry = members.join(parts, F.col("family") == F.col("_f")).withColumn("own", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    entry = entry.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    entry = entry.select("family", F.least("own", "with").alias("lo"), F.greatest("own", "with").alias("hi"), "own", "node", "root")

    def sift(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x, y in _blocks(stream):
            hope = _hopeful(x, y, percent)
            if hope.any():
                both = x if y is None else pa.concat_tables([x, y])
                yield from both.drop_columns(["n", "part"]).filter(pa.array(hope)).to_batches()

    def compare(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x, y in _blocks(stream):
            up: dict[int, int] = {}
            kept = [(a, b) for a, b in _overlaps(x, y, percent) if _joins(up, a, b)]
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in kept], pa.int64()), pa.array([k[1] for k in kept], pa.int64())], names=["a", "b"])

    block = ["family", "lo", "hi"]
    ready = entry.join(sets, F.col("node") == F.col("_n")).drop("_n").repartition(*block).sortWithinPartitions(*block)
    entry = store(ready.mapInArrow(sift, "family bigint, lo int, hi int, own int, node bigint, root bigint").distinct(), "hopeful")
    used = store(entry.select(F.col("node").alias("doc_id")).distinct(), "used")
    sets = _sets(sized_join(docs, used, "doc_id", "left_semi", used.count()), width).distinct().withColumnRenamed("node", "_n")
    ready = entry.join(sets, F.col("node") == F.col("_n")).drop("_n").repartition(*block).sortWithinPartitions(*block)
    return ready.mapInArrow(compare, "a bigint, b bigint")


def _joins(up: dict[int, int], a: int, b: int) -> bool:
    """Whether a link joins two groups, which are one from then on."""

    def top(x: int) -> int:
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    a, b = top(a), top(b)
    up[max(a, b)] = min(a, b)
    return a != b


def _verified(docs: DataFrame, pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs whose sets really overlap enough: parts are compared first, whole sets only where these allow it."""

    def met(pairs: DataFrame, describe: Callable[[DataFrame, int], DataFrame], name: str) -> DataFrame:
        used = store(pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct(), "used")
        sets = store(describe(sized_join(docs, used, "doc_id", "left_semi", used.count()), width), name)
        side = lambda c: sets.select(F.col("node").alias(c), *[F.col(f).alias(f"{c}_{f}") for f in sets.columns if f != "node"])
        return pairs.join(side("a"), "a").join(side("b"), "b")

    differ = F.size("a_part") + F.size("b_part") - 2 * F.size(F.array_intersect("a_part", "b_part"))
    near = met(pairs, _parts, "parts").where(differ * (100 + percent) <= (F.col("a_n") + F.col("b_n")) * (100 - percent))
    both = met(store(near.select("a", "b").distinct(), "near"), _sets, "sets")
    common: Column = F.size(F.array_intersect("a_shingles", "b_shingles"))
    both = both.select("a", "b", common.alias("i"), (F.size("a_shingles") + F.size("b_shingles")).alias("s"))
    return both.where(F.col("i") * 100 >= (F.col("s") - F.col("i")) * percent).select("a", "b").distinct()
