"""News analytics: tagging, sentiment, term vectors, story clusters, correlation signals, monitors, search, filings.

Word lists are literals in the plan (a few hundred phrases at most), so tagging is a projection without a shuffle.
"""

from __future__ import annotations

import functools
import math
import re
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.functions import vocabulary as voc
from candlewick.operators.series import Axis
from candlewick.session import checkpoint_folder

WORD = r"[\p{L}\p{N}_]+"


def _strings(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def words(text: Column) -> Column:
    """Words of a text, repeats kept."""
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


# ------------------------------------------------------------------------------------------------ tagging


def _table(rows: Sequence[tuple], names: Sequence[str]) -> Column:
    """Small constant table as an array of structs."""
    return F.array(*[F.struct(*[F.lit(v).alias(n) for v, n in zip(row, names)]) for row in rows])


def _once(bound: Column, use) -> Column:
    """``use(bound)`` with ``bound`` computed once per row."""
    return F.get(F.transform(F.array(bound), use), F.lit(0))


def _found(low: Column, tokens: Column | None, phrases: Sequence[tuple[str, str]]) -> Column:
    """Values of the phrases in the text; with ``tokens``, single words must be whole words."""
    whole = lambda p: tokens is not None and (" " not in p or len(p) <= 4) and bool(re.fullmatch(r"\w+", p))
    table = _table([(p, v, whole(p)) for p, v in phrases], ("phrase", "value", "whole"))
    empty = F.array().cast("array<string>")
    bound = F.struct(low.alias("low"), (tokens if tokens is not None else empty).alias("tokens"))
    hit = lambda t, p: F.when(p["whole"], F.array_contains(t["tokens"], p["phrase"])).otherwise(t["low"].contains(p["phrase"]))
    return _once(bound, lambda t: F.transform(F.filter(table, lambda p: hit(t, p)), lambda p: p["value"]))


def entity_mentions(
    df: DataFrame,
    text: str,
    countries: Sequence[tuple[str, str]] | None = None,
    organisations: Sequence[tuple[str, str]] | None = None,
    persons: Sequence[tuple[str, str]] | None = None,
) -> DataFrame:
    """Every mention per article, repeats kept: ``countries``, ``organisations``, ``people``, ``tickers``."""
    base = df.withColumns({"_low": F.lower(text), "_words": F.array_distinct(words(F.lower(text)))})
    titled = [
        F.regexp_extract_all(
            text,
            F.lit(rf"\b(?:{'|'.join(re.escape(t).replace(chr(92) + ' ', ' ') for t in titles)})\s+([A-Z][a-z]+(?:\s+[A-Z][a-z]+)*)"),
            F.lit(1),
        )
        for titles in voc.TITLES
    ]
    base = base.withColumns({
        "countries": _found(F.col("_low"), F.col("_words"), countries or list(voc.COUNTRIES.items())),
        "organisations": _found(F.col("_low"), None, organisations or list(voc.ORGANISATIONS.items())),
        "_known": _found(F.col("_low"), None, persons or list(voc.PERSONS.items())),
        "_titled": F.filter(F.array_distinct(F.concat(*titled)), lambda p: F.length(p) > 3),
        "tickers": F.filter(words(F.col(text)), lambda w: w.rlike("^[A-Z]{2,5}$") & ~w.isin(list(voc.NO_TICKERS))),
    })
    return base.withColumn("people", F.concat("_known", F.array_except("_titled", "_known"))).drop("_low", "_words", "_known", "_titled")


def extract_entities(df: DataFrame, text: str, most: int = 5, **lists) -> DataFrame:
    """First ``most`` distinct entities per type and article."""
    tagged = entity_mentions(df, text, **lists)
    return tagged.withColumns({c: F.slice(F.array_distinct(c), 1, most) for c in ("countries", "organisations", "people", "tickers")})


def top_entities(df: DataFrame, text: str, n: int = 10, **lists) -> DataFrame:
    """The ``n`` entities of each type with most mentions (ties by name)."""
    tagged = entity_mentions(df, text, **lists)

    def named(kind):
        return F.transform(kind, lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("name")))

    long = tagged.select(F.explode(F.concat(*[named(c) for c in ("countries", "organisations", "people", "tickers")])).alias("e"))
    counts = long.groupBy("e.kind", "e.name").agg(F.count("*").alias("mentions"))
    from candlewick.operators.ranking import top_n

    return top_n(counts, ["kind"], [F.desc("mentions"), F.asc("name")], n)


def sentiment(
    df: DataFrame, text: str, positive: Sequence[tuple[str, str]] | None = None, negative: Sequence[tuple[str, str]] | None = None
) -> DataFrame:
    """Weighted word stems in the text: ``positive_signals``, ``negative_signals``, ``sentiment``, ``score``, ``confidence``."""
    low = F.lower(text)

    def weigh(phrases):
        table = _table([(p, int(w)) for p, w in phrases], ("phrase", "weight"))
        hits = lambda t: F.filter(table, lambda p: t.contains(p["phrase"]))
        return _once(low, lambda t: F.aggregate(hits(t), F.lit(0), lambda s, p: s + p["weight"]))

    df = df.withColumns({
        "positive_signals": weigh(positive or list(voc.POSITIVE.items())),
        "negative_signals": weigh(negative or list(voc.NEGATIVE.items())),
    })
    total, net = F.col("positive_signals") + F.col("negative_signals"), F.col("positive_signals") - F.col("negative_signals")
    clear = F.abs(net) >= 2
    return df.withColumns({
        "sentiment": F.when(net >= 2, "BULLISH").when(net <= -2, "BEARISH").otherwise("NEUTRAL"),
        "score": F.when(total == 0, 0.0).otherwise(F.round(net / total, 3)),
        "confidence": F.when(total == 0, 0.2).when(clear, F.round(F.least(0.4 + total * 0.05, F.lit(0.95)), 3)).otherwise(0.3),
    })


def sentiment_summary(scored: DataFrame) -> DataFrame:
    count = lambda s: F.count(F.when(F.col("sentiment") == s, 1)).alias(s.lower())
    return scored.agg(count("BULLISH"), count("BEARISH"), count("NEUTRAL"), F.round(F.avg("score"), 3).alias("overall_score"))


# ------------------------------------------------------------------------------------------------ term vectors


def tokenise(text: Column, synonyms: Sequence[tuple[str, str]] | None = None, stop: Sequence[str] | None = None) -> Column:
    """Lower-case words of at least three letters without stop words, variants replaced by one form."""
    pairs = synonyms or list(voc.SYNONYMS.items())
    same = F.create_map(*[F.lit(x) for pair in pairs for x in pair])
    found = F.regexp_extract_all(F.lower(text), F.lit("[a-z]{3,}"), F.lit(0))
    kept = F.filter(found, lambda w: ~w.isin(list(stop or voc.STOP_WORDS)))
    return F.transform(kept, lambda w: F.when(w.isin([p for p, _ in pairs]), F.element_at(same, w)).otherwise(w))


def tf_idf(df: DataFrame, key: str, tokens: str) -> DataFrame:
    """One row per article and term: ``term, n, tf, idf, weight`` with idf = ln((N + 1) / (df + 1)) + 1."""
    size = df.agg(F.count("*").alias("_docs"))
    whole = df.select(key, F.size(tokens).alias("_len"), F.col(tokens).alias("_tokens")).repartition(key, "_len")  # token lists are smaller than a row per term
    terms = whole.select(key, "_len", F.explode("_tokens").alias("term")).groupBy(key, "_len", "term").agg(F.count("*").alias("n"))
    spread = terms.groupBy("term").agg(F.count("*").alias("_df")).join(F.broadcast(size))  # one row
    idf = F.log((F.col("_docs") + 1) / (F.col("_df") + 1)) + 1
    weighed = terms.join(spread.select("term", idf.alias("idf"), "_df"), "term")
    tf = F.col("n") / F.col("_len")
    return weighed.select(key, "term", "n", tf.alias("tf"), "idf", (tf * F.col("idf")).alias("weight"), F.col("_df").alias("df"))


# ------------------------------------------------------------------------------------------------ story clusters


def _vectors(kinds: DataFrame, weighed: DataFrame) -> DataFrame:
    """Unit vectors per kind as arrays over term hashes, rarest first."""
    terms = weighed.select("kind", F.xxhash64("term").alias("t"), "weight", "df")
    packed = terms.groupBy("kind").agg(
        F.array_sort(F.collect_list(F.struct("df", "t", "weight"))).alias("v"), F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm")
    )
    return kinds.join(packed, "kind")


SMALL = 20_000  # articles that one task settles in order
PIECE = 500_000  # articles of a piece beyond that
STEP = 8  # pieces that one task walks in a row, once pieces walked side by side do not agree
BATCH = 1024  # articles or vectors compared with leaders at a time (articles: four times as many)
SHARED = 4_000_000  # common terms of leaders and articles listed at once
CELLS = 2_000_000  # pairs of leaders and articles that are counted at once
FIRST = 64  # open articles that are compared with each other at a time


class _Texts(NamedTuple):
    """Articles in order of time: their terms lie one after the other in ``flat``."""

    ts: np.ndarray
    kind: np.ndarray
    cat: np.ndarray
    sizes: np.ndarray
    flat: np.ndarray

    @staticmethod
    def of(rows: pa.RecordBatch) -> _Texts:
        plain = lambda c: rows.column(rows.schema.get_field_index(c)).to_numpy(zero_copy_only=False)
        terms = rows.column(rows.schema.get_field_index("terms"))
        return _Texts(plain("ts"), plain("kind"), plain("cat"), np.diff(terms.offsets.to_numpy()).astype(np.int64), terms.flatten().to_numpy(zero_copy_only=False))

    @staticmethod
    def joined(parts: Sequence[_Texts]) -> _Texts:
        return _Texts(*[np.concatenate(x) for x in zip(*parts)])

    def take(self, at: np.ndarray) -> _Texts:
        sizes, starts = self.sizes[at], (np.cumsum(self.sizes) - self.sizes)[at]
        places = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        return _Texts(self.ts[at], self.kind[at], self.cat[at], sizes, self.flat[places])

    def part(self, start: int, until: int) -> _Texts:
        lo = int(self.sizes[:start].sum())
        return _Texts(*[x[start:until] for x in self[:4]], self.flat[lo : lo + int(self.sizes[start:until].sum())])


NO_TEXTS = _Texts(*[np.empty(0, np.int64)] * 5)


def _similar(leaders: _Texts, rows: _Texts, window: int, threshold: float, low: float) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of leaders and of rows at most ``window`` younger that reach the threshold (equal kinds do), in order of the leaders.

    The terms of the rows are looked up among those of the leaders, so that only pairs with a common term are counted.
    """
    m, n = len(leaders.ts), len(rows.ts)
    order = np.argsort(leaders.flat, kind="stable")
    sorted_ = leaders.flat[order]
    own = np.repeat(np.arange(m), leaders.sizes)[order]
    new = np.flatnonzero(np.concatenate([sorted_[:1] == sorted_[:1], sorted_[1:] != sorted_[:-1]]))
    distinct, holders = sorted_[new], np.diff(np.append(new, len(sorted_)))
    if not (len(distinct) and len(rows.flat)):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    place = np.minimum(np.searchsorted(distinct, rows.flat), len(distinct) - 1)
    known = np.flatnonzero(distinct[place] == rows.flat)
    place, row = place[known], np.repeat(np.arange(n), rows.sizes)[known]
    many = holders[place]
    if m > 1 and many.sum() > SHARED:
        half = m // 2
        a, b = (_similar(leaders.part(*cut), rows, window, threshold, low) for cut in ((0, half), (half, m)))
        return np.concatenate([a[0], b[0] + half]), np.concatenate([a[1], b[1]])
    at = np.repeat(new[place] - (np.cumsum(many) - many), many) + np.arange(many.sum())
    code = own[at] * n + np.repeat(row, many)
    if len(code) * 4 < m * n:
        cell, both = np.unique(code, return_counts=True)
    else:
        both = np.bincount(code, minlength=m * n)
        cell = np.flatnonzero(both)
        both = both[cell]
    i, j = np.divmod(cell, n)
    limit = np.where((leaders.cat[i] == rows.cat[j]) & (leaders.cat[i] != 0), low, threshold)
    like = (both / np.maximum(leaders.sizes[i] + rows.sizes[j] - both, 1) >= limit) | (leaders.kind[i] == rows.kind[j])
    like &= rows.ts[j] <= leaders.ts[i] + window
    return i[like], j[like]


def _first_leader(leaders: _Texts, rows: _Texts, window: int, threshold: float, low: float) -> np.ndarray:
    """Number of the earliest leader similar to each row, -1 without one. Rows that have theirs are not compared any more."""
    found, open_, at, wide = np.full(len(rows.ts), -1), np.arange(len(rows.ts)), 0, 16
    while at < len(leaders.ts) and len(open_):
        until = min(len(leaders.ts), at + max(1, min(wide, CELLS // len(open_))))
        i, j = _similar(leaders.part(at, until), rows, window, threshold, low)
        first = np.full(len(open_), -1)
        first[j[::-1]] = i[::-1]  # the smallest is written last
        hit = first >= 0
        found[open_[hit]] = at + first[hit]
        left = np.flatnonzero(~hit)
        if len(left) < len(open_):
            open_, rows = open_[left], rows.take(left)
        at, wide = until, wide * 2
    return found


def _walk(rows: _Texts, leaders: _Texts, window: int, threshold: float, low: float) -> tuple[np.ndarray, np.ndarray]:
    """Of rows in order: those that lead, and the number of each one's leader, where ``leaders`` before them are followed by the rows that lead."""
    found = _first_leader(leaders, rows, window, threshold, low)
    open_, led, n = np.flatnonzero(found < 0), [], len(leaders.ts)
    while open_.size:
        head, rest = open_[:FIRST], open_[FIRST:]
        own = rows.take(head)
        like = np.zeros((len(head), len(head)), bool)
        like[_similar(own, own, window, threshold, low)] = True
        first, lead = np.full(len(head), -1), []
        for i in range(len(head)):
            if first[i] < 0:
                first[i:][like[i, i:] & (first[i:] < 0)] = len(lead)
                first[i] = len(lead)
                lead.append(i)
        found[head] = n + first
        hit = _first_leader(own.take(np.array(lead)), rows.take(rest), window, threshold, low)
        found[rest[hit >= 0]] = n + hit[hit >= 0]
        led.append(head[lead])
        n += len(lead)
        open_ = rest[hit < 0]
    return np.concatenate(led) if led else np.empty(0, np.int64), found


def _pieces_of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, 4 * BATCH):
        yield batch.slice(at, 4 * BATCH)


def _lead_in_time(dated: DataFrame, described: Callable[[DataFrame], DataFrame], window: int, threshold: float, low: float) -> DataFrame:
    """``id, leader`` of first-come clusters of articles ``ts, id`` (no null ``ts``), to which ``described`` adds ``kind, cat, terms`` (not empty): an article joins its earliest
    similar leader that is at most ``window`` older, else it leads a cluster itself.

    First it is settled who leads, in pieces of time; then every piece looks up its articles' leaders by itself. A task reads its articles in order and holds the leaders of one window, in the
    second step those of its piece too. Similar pairs are not listed.
    """
    spark, columns = dated.sparkSession, ["ts", "id", "kind", "cat", "terms"]
    articles = described(dated).select(columns)
    told = T.StructType([articles.schema["id"], T.StructField("leader", articles.schema["id"].dataType)])
    like = (window, threshold, low)

    def names(batch: pa.RecordBatch, ids: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("id")), ids], ["id", "leader"])

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leaders, ids = NO_TEXTS, []
        for batch in (piece for whole in batches for piece in _pieces_of(whole)):
            rows = _Texts.of(batch)
            led, found = _walk(rows, leaders, *like)
            leaders = _Texts.joined([leaders, rows.take(led)])
            ids.append(batch.column(batch.schema.get_field_index("id")).take(pa.array(led)))
            yield names(batch, pa.concat_arrays(ids).take(pa.array(found)))

    n = dated.count()
    if n <= SMALL:
        return articles.repartition(1).sortWithinPartitions("ts", F.asc_nulls_last("id")).mapInArrow(settle, told)

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rows that lead, and again, as ``_state``, the leaders of the last window; leaders before come first, as ``_led``."""
        leaders, held, last = NO_TEXTS, [], None

        def marked(rows: pa.RecordBatch, state: bool) -> pa.RecordBatch:
            own = [rows.column(rows.schema.get_field_index(c)) for c in columns]
            return pa.RecordBatch.from_arrays([*own, pa.array(np.full(rows.num_rows, int(state), np.int32))], [*columns, "_state"])

        for batch in (piece for whole in batches for piece in _pieces_of(whole)):
            known = batch.column(batch.schema.get_field_index("_led")).to_numpy(zero_copy_only=False)
            before = int(known.sum())  # they come first
            if before:
                held.append(batch.slice(0, before))
                leaders = _Texts.joined([leaders, _Texts.of(held[-1])])
                batch = batch.slice(before)
            if not batch.num_rows:
                continue
            rows = _Texts.of(batch)
            last = rows.ts[-1]
            old = int(np.searchsorted(leaders.ts, rows.ts[0] - window))
            leaders = leaders.part(old, len(leaders.ts))
            held = [x for x in held if x.column(x.schema.get_field_index("ts"))[-1].as_py() >= rows.ts[0] - window]
            led, _ = _walk(rows, leaders, *like)
            if len(led):
                leaders = _Texts.joined([leaders, rows.take(led)])
                held.append(batch.take(pa.array(led)))
                yield marked(held[-1], False)
        for x in held if last is not None else ():
            new = np.flatnonzero(x.column(x.schema.get_field_index("ts")).to_numpy() >= last - window)
            if len(new):
                yield marked(x.take(pa.array(new)), True)

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Leaders of rows; all leaders in question come first."""
        texts, ids, leaders = [], [], None
        for batch in (piece for whole in batches for piece in _pieces_of(whole)):
            known = batch.column(batch.schema.get_field_index("_led")).to_numpy(zero_copy_only=False)
            before = int(known.sum())
            if before:
                texts.append(_Texts.of(batch.slice(0, before)))
                ids.append(batch.slice(0, before).column(batch.schema.get_field_index("id")))
                batch = batch.slice(before)
            if not batch.num_rows:
                continue
            if leaders is None:
                leaders, ids = _Texts.joined(texts), pa.concat_arrays(ids)
            rows = _Texts.of(batch)
            start, until = np.searchsorted(leaders.ts, rows.ts[0] - window), np.searchsorted(leaders.ts, rows.ts[-1], "right")
            found = _first_leader(leaders.part(start, until), rows, *like)
            if (found < 0).any():
                raise RuntimeError("an article has neither led nor found its leader")
            yield names(batch, ids.take(pa.array(start + found)))

    folder = f"{checkpoint_folder(spark).rstrip('/')}/candlewick-{uuid.uuid4().hex}"
    # texts are described after they are dealt: the bounds of the pieces come from a pass of its own
    cut = dated.repartitionByRange(max(2, math.ceil(n / PIECE)), "ts", F.asc_nulls_last("id")).withColumn("_piece", F.spark_partition_id())
    described(cut).select(*columns, "_piece").sortWithinPartitions("_piece", "ts", F.asc_nulls_last("id")).write.partitionBy("_piece").parquet(f"{folder}/rows")
    every = spark.read.schema(T.StructType([*articles.schema.fields, T.StructField("_piece", T.IntegerType())])).parquet(f"{folder}/rows")
    bounds = every.groupBy("_piece").agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).collect()
    spans = {r["_piece"]: (r["lo"], r["hi"]) for r in sorted(bounds, key=lambda r: r["_piece"])}

    def ordered(pieces: Sequence[int], before: DataFrame | None) -> DataFrame:
        """Some pieces as one partition in order, leaders before them first."""
        rows = every.filter(F.col("_piece").isin(list(pieces))).select(*columns, F.lit(False).alias("_led"))
        if before is not None:
            rows = before.select(*columns, F.lit(True).alias("_led")).unionByName(rows)
        return rows.coalesce(1).sortWithinPartitions(F.desc("_led"), "ts", F.asc_nulls_last("id"))

    def side_by_side(parts: Sequence[DataFrame]) -> DataFrame:
        """Union with a partition for each part: Spark would lay parts of one partition into one, were there not an empty one without partitions."""
        none = every.filter("_piece < 0").mapInArrow(lambda batches: batches, every.schema)
        none = none.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in parts[0].schema.fields])
        return functools.reduce(DataFrame.unionByName, parts, none)

    def walked(groups: Mapping[int, tuple[Sequence[int], DataFrame | None]], name: str) -> DataFrame:
        """Leaders, and ``_state`` at the end, of groups of pieces side by side; a group goes by the number of its first piece."""
        schema = T.StructType([*articles.schema.fields, T.StructField("_state", T.IntegerType())])
        done = [ordered(pieces, before).mapInArrow(lead, schema).withColumn("_piece", F.lit(p)) for p, (pieces, before) in groups.items()]
        side_by_side(done).write.partitionBy("_piece", "_state").parquet(f"{folder}/{name}")
        return spark.read.schema(done[0].schema).parquet(f"{folder}/{name}")

    latest = _lead_in_rounds(list(spans), walked)
    parts = []
    for p, (lo, hi) in spans.items():
        groups: dict[int, tuple[DataFrame, set[int]]] = {}
        for q in spans:
            if q <= p and spans[q][1] >= lo - window:
                groups.setdefault(id(latest[q][0]), (latest[q][0], set()))[1].add(latest[q][1])
        near = [run.filter(F.col("_piece").isin(list(own)) & (F.col("_state") == 0) & F.col("ts").between(lo - window, hi)) for run, own in groups.values()]
        parts.append(ordered([p], functools.reduce(DataFrame.unionByName, near)).mapInArrow(follow, told))
    return side_by_side(parts)


def _lead_in_rounds(order: Sequence[int], walked: Callable[[Mapping[int, tuple[Sequence[int], DataFrame | None]], str], DataFrame]) -> dict[int, tuple[DataFrame, int]]:
    """Table of the leaders of each piece and the number it has there.

    All pieces start without leaders before them and are walked side by side; a piece is right once those before it are, and those whose start has changed are walked again. Where articles
    are seldom similar, leaders depend on a short past, and this soon ends. Where a round leaves more than half of its pieces open, the past reaches on and on: the rest is then walked
    once, in order, several pieces in one task.
    """
    back = dict(zip(order[1:], order))
    latest: dict[int, tuple[DataFrame, int]] = {}
    seen: dict[int, tuple] = {}  # piece: mark of the leaders it was walked with
    ends: dict[int, tuple] = {}  # piece: mark of the leaders it ends with

    def before(p: int) -> DataFrame | None:
        if p not in back or back[p] not in latest:
            return None
        run, own = latest[back[p]]
        return run.filter((F.col("_piece") == own) & (F.col("_state") == 1))

    todo, rounds = list(order), 0
    while todo:
        for p in todo:
            seen[p] = ends.get(back.get(p), (0, 0))
        run = walked({p: ([p], before(p)) for p in todo}, f"round{rounds}")
        latest.update({p: (run, p) for p in todo})
        marks = run.filter("_state = 1").groupBy("_piece").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("ts", "id", "kind")).alias("h"))
        ends.update({r["_piece"]: (r["n"], r["h"]) for r in marks.collect()})
        left, rounds = [p for p in order[1:] if ends[back[p]] != seen[p]], rounds + 1
        if rounds > 1 and len(left) > max(1, len(todo) // 2):
            rest = order[order.index(left[0]) :]
            for at in range(0, len(rest), STEP):
                run = walked({rest[at]: (rest[at : at + STEP], before(rest[at]))}, f"row{at}")
                latest.update(dict.fromkeys(rest[at : at + STEP], (run, rest[at])))
            break
        todo = left
    return latest


HEAD = 2048  # earliest open kinds that one task settles among themselves in a round
HEAD_TERMS = 2_000_000  # and their terms together: 32 MB
PENDING = 1_000_000  # settled kinds that the table of vectors may still hold


def _first_cover(leaders: Sequence[tuple[np.ndarray, np.ndarray, float]], batch: Sequence[tuple[np.ndarray, np.ndarray, float]], threshold: float, among: bool) -> np.ndarray:
    """Number of the first leader with cosine >= threshold for each vector, -1 where there is none.

    Terms of the batch are kept as lists of the vectors that hold them, so a leader meets only vectors that share a term. ``among``: the batch is ``leaders`` itself in order, and
    only vectors that no earlier one covers lead.
    """
    n = len(batch)
    owner = np.repeat(np.arange(n), [len(t) for t, _, _ in batch])
    terms = np.concatenate([t for t, _, _ in batch]) if n else np.empty(0, np.int64)
    order = np.argsort(terms, kind="stable")
    terms, owner, weights = terms[order], owner[order], np.concatenate([w for _, w, _ in batch])[order] if n else np.empty(0)
    norms = np.array([x for _, _, x in batch])
    first = np.full(n, -1)
    for i, (t, w, norm) in enumerate(leaders):
        if among and first[i] >= 0:
            continue
        lo, hi = np.searchsorted(terms, t, "left"), np.searchsorted(terms, t, "right")
        many = hi - lo
        at = np.repeat(lo - (np.cumsum(many) - many), many) + np.arange(many.sum())
        score = np.bincount(owner[at], weights[at] * np.repeat(w, many), n)
        hit = (score >= threshold * norms * norm) & (first < 0)
        if among:
            hit[:i] = False
            first[i] = i
        first[hit] = i
    return first


def _lead_vectors(vectors: DataFrame, threshold: float) -> DataFrame:
    """``kind, leader`` for vectors in the order of ``first`` (time and id of the kind's first article).

    A round takes the earliest open kinds, as many as one task holds, settles them among themselves, and shows the new leaders to all other open kinds: a kind
    goes to the first leader similar to it. No table of similar pairs is made. The number of rounds is the number of kinds that no leader of the rounds before covers, divided by the size of a head.

    A round writes who leads whom, not the vectors that are still open: their table is written again only when half of it is settled (or ``PENDING`` kinds are), so that all tables together
    hold some two or three times the vectors, however many rounds there are.
    """
    spark = vectors.sparkSession
    folder = f"{checkpoint_folder(spark).rstrip('/')}/candlewick-{uuid.uuid4().hex}"

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    table = kept(vectors.select("kind", "first", F.transform("v", lambda x: x["t"]).alias("t"), F.transform("v", lambda x: x["weight"]).alias("w"), "norm"), "open")
    left = held = table.count()
    schema = T.StructType([table.schema["kind"], T.StructField("leader", vectors.schema["first"].dataType["id"].dataType)])
    head_schema = T.StructType([*table.schema.fields, schema["leader"]])
    triples = lambda part: [(np.asarray(t, np.int64), np.asarray(w, float), float(x)) for t, w, x in zip(part["t"], part["w"], part["norm"])]

    def settle(parts):
        held = pd.concat(list(parts), ignore_index=True)  # at most HEAD rows
        held["_ts"], held["_id"] = [f["ts"] for f in held["first"]], [f["id"] for f in held["first"]]
        held = held.sort_values(["_ts", "_id"], ignore_index=True)
        held = held[np.cumsum([len(t) for t in held["t"]]) - [len(t) for t in held["t"]] < HEAD_TERMS]
        found = _first_cover(triples(held), triples(held), threshold, True)
        yield held[["kind", "first", "t", "w", "norm"]].assign(leader=held["_id"].to_numpy()[found])

    settled: list[DataFrame] = []
    pending: list[DataFrame] = []  # settled since the table was written
    rounds = 0
    while left:
        gone = functools.reduce(DataFrame.unionByName, [p.select("kind") for p in pending]) if pending else None
        open_ = table if gone is None else table.join(F.broadcast(gone), "kind", "left_anti")  # at most PENDING numbers
        earliest = open_.select("kind", "first").orderBy("first").limit(HEAD).select("kind")  # without vectors, of which every partition would send as many
        head = kept(open_.join(F.broadcast(earliest), "kind", "left_semi").repartition(1).mapInPandas(settle, head_schema), f"head{rounds}")
        new = sorted(((r["first"]["ts"], r["first"]["id"], r["t"], r["w"], r["norm"]) for r in head.filter(F.col("leader") == F.col("first.id")).collect()), key=lambda x: x[:2])
        shown = spark.sparkContext.broadcast([(x[1], (np.asarray(x[2], np.int64), np.asarray(x[3], float), float(x[4]))) for x in new])  # at most HEAD vectors

        def compare(parts, shown=shown):
            ids = [i for i, _ in shown.value]
            for part in parts:
                for at in range(0, len(part), BATCH):
                    own = part.iloc[at : at + BATCH]
                    found = _first_cover([v for _, v in shown.value], triples(own), threshold, False)
                    yield pd.DataFrame({"kind": own["kind"].to_numpy()[found >= 0], "leader": pd.Series([ids[i] for i in found if i >= 0], dtype="object")})

        rest = open_.join(F.broadcast(head.select("kind")), "kind", "left_anti").select("kind", "t", "w", "norm")
        told = [head.select("kind", "leader"), kept(rest.mapInPandas(compare, schema), f"told{rounds}")]
        settled += told
        pending += told
        left -= sum(t.count() for t in told)
        rounds += 1
        if left and (left <= held // 2 or held - left > PENDING):
            gone = functools.reduce(DataFrame.unionByName, [p.select("kind") for p in pending])
            table, held, pending = kept(table.join(gone, "kind", "left_anti"), f"open{rounds}"), left, []
    return functools.reduce(DataFrame.unionByName, settled, spark.createDataFrame([], schema))


def cluster_semantic(df: DataFrame, key: str, text: str, order: str, threshold: float = 0.25) -> DataFrame:
    """``key, leader``: first-come clusters by TF-IDF cosine. Articles with equal term vectors are compared once; those without a term lead themselves."""
    docs = df.select(F.col(key).alias("id"), F.unix_micros(F.col(order).cast("timestamp")).alias("ts"), tokenise(F.col(text)).alias("tokens"))
    docs = docs.withColumn("kind", F.when(F.size("tokens") > 0, F.xxhash64(F.array_sort("tokens"))).otherwise(F.xxhash64(F.lit("empty"), "id")))
    idf = tf_idf(docs, "id", "tokens")
    first = docs.groupBy("kind").agg(F.min("id").alias("id"), F.min(F.struct("ts", "id")).alias("first"))
    weighed = idf.join(first.select("kind", "id"), "id").select("kind", "term", "weight", "df")
    vectors = _vectors(first.select("kind", "first"), weighed)
    led = _lead_vectors(vectors, threshold)
    return docs.select("id", "kind").join(led, "kind", "left").select(F.col("id").alias(key), F.coalesce("leader", "id").alias("leader"))


def cluster_stories(
    df: DataFrame, key: str, headline: str, ts: str, category: str, threshold: float = 0.25, same_category: float = 0.8, window: int = 86400
) -> DataFrame:
    """``key, leader``: first-come clusters by token Jaccard among headlines at most ``window`` seconds apart."""
    docs = df.select(F.col(key).alias("id"), F.unix_timestamp(ts).alias("ts"), F.col(category).alias("category"), F.col(headline).alias("text"))

    def described(rows: DataFrame) -> DataFrame:
        tokens = F.array_sort(F.array_distinct(F.filter(words(F.lower("text")), lambda w: F.length(w) > 2)))
        rows = rows.withColumn("tokens", tokens)
        kind = F.when(F.size("tokens") > 0, F.xxhash64("tokens", "category")).otherwise(F.xxhash64(F.lit("empty"), "id"))
        cat = F.when(F.col("category").isNull(), F.lit(0).cast("long")).otherwise(F.xxhash64("category"))
        rows = rows.withColumns({"kind": kind, "cat": cat})
        return rows.withColumn("terms", F.when(F.size("tokens") > 0, F.transform("tokens", lambda w: F.xxhash64(w))).otherwise(F.array("kind")))

    led = _lead_in_time(docs.filter("ts IS NOT NULL"), described, window, threshold, threshold * same_category)
    led = led.unionByName(docs.filter("ts IS NULL").select("id", F.col("id").alias("leader")))  # in no window: each leads itself
    return led.select(F.col("id").alias(key), "leader")


def story_summary(articles: DataFrame, now: Column) -> DataFrame:
    """One row per ``leader``: size, sources, lead article (best tier, then newest), tone, breaking flag, velocity."""
    best = F.struct(-F.col("tier"), F.unix_timestamp("ts"), -F.col("id"))
    tone = lambda s: F.count(F.when(F.col("sentiment") == s, 1))
    recent = F.count(F.when(F.unix_timestamp(now) - F.unix_timestamp("ts") < 7200, 1))
    older = F.count("*") - recent
    return articles.groupBy("leader").agg(
        F.count("*").alias("articles"),
        F.countDistinct("source").alias("sources"),
        F.max_by("id", best).alias("lead_id"),
        F.max_by("category", best).alias("category"),
        F.min("tier").alias("tier"),
        F.max("ts").alias("latest"),
        F.max(F.col("priority").isin("FLASH", "URGENT")).alias("is_breaking"),
        F.when(tone("BULLISH") > tone("BEARISH"), "BULLISH").when(tone("BEARISH") > tone("BULLISH"), "BEARISH").otherwise("NEUTRAL").alias("sentiment"),
        F.when(recent > older, "rising").when(recent == older, "stable").otherwise("falling").alias("velocity"),
    )


# ------------------------------------------------------------------------------------------------ correlation signals


def threat_counts(df: DataFrame, headline: str, threats: Sequence[tuple[str, str]] | None = None) -> DataFrame:
    """Number of headlines with each threat word, one pass: ``keyword, category, mentions``."""
    phrases = threats or [(w, c) for c, ws in voc.THREATS.items() for w in ws]
    low = F.lower(headline)
    counts = df.agg(*[F.count(F.when(low.contains(p), 1)).alias(f"k{i}") for i, (p, _) in enumerate(phrases)])
    rows = [F.struct(F.lit(p).alias("keyword"), F.lit(c).alias("category"), F.col(f"k{i}").alias("mentions")) for i, (p, c) in enumerate(phrases)]
    return counts.select(F.inline(F.array(*rows)))


def velocity_spikes(df: DataFrame, now: Column) -> DataFrame:
    """Categories whose last hour holds at least five articles and three times those of the hour before."""
    age = F.unix_timestamp(now) - F.unix_timestamp("ts")
    counts = df.filter(age <= 7200).groupBy("category").agg(
        F.count(F.when(age <= 3600, 1)).alias("recent"), F.greatest(F.count(F.when(age > 3600, 1)), F.lit(1)).alias("older")
    )
    ratio = F.col("recent") / F.col("older")
    return counts.filter((ratio >= 3) & (F.col("recent") >= 5)).select(
        F.lit("velocity_spike").alias("type"), F.col("category").alias("subject"), "category",
        F.when(ratio >= 5, "high").otherwise("medium").alias("severity"), F.round(ratio, 1).alias("value"),
    )


def triangulations(df: DataFrame, headline: str, sources: int = 3, prefix: int = 50) -> DataFrame:
    """Stories (same opening of the headline) told by several sources."""
    return (
        df.groupBy(F.substring(F.lower(headline), 1, prefix).alias("subject"))
        .agg(F.countDistinct("source").alias("value"))
        .filter(F.col("value") >= sources)
        .select(F.lit("triangulation").alias("type"), "subject", F.lit("").alias("category"), F.lit("medium").alias("severity"), F.col("value").cast("double").alias("value"))
    )


def geo_convergence(df: DataFrame, events: int = 5, categories: int = 2) -> DataFrame:
    return (
        df.filter(F.col("region") != "")
        .groupBy(F.col("region").alias("subject"))
        .agg(F.count("*").alias("value"), F.countDistinct("category").alias("_cats"))
        .filter((F.col("value") >= events) & (F.col("_cats") >= categories))
        .select(F.lit("geo_convergence").alias("type"), "subject", F.lit("").alias("category"), F.lit("high").alias("severity"), F.col("value").cast("double").alias("value"))
    )


def keyword_signals(counts: DataFrame, top: int = 10) -> DataFrame:
    """Keyword spikes among the ``top`` words, conflict escalation and military surge from ``threat_counts``.

    A word listed in two categories is counted for both, as one keyword of the first.
    """
    merged = counts.groupBy("keyword").agg(F.sum("mentions").alias("mentions"), F.first("category").alias("category"))
    spikes = merged.orderBy(F.desc("mentions"), "keyword").limit(top).filter(F.col("mentions") >= 5).select(
        F.lit("keyword_spike").alias("type"), F.col("keyword").alias("subject"), "category",
        F.when(F.col("mentions") >= 10, "high").otherwise("medium").alias("severity"), F.col("mentions").cast("double").alias("value"),
    )
    conflict = [p for p, c in [(w, c) for c, ws in voc.THREATS.items() for w in ws] if c == "conflict"]
    totals = merged.agg(
        F.sum(F.when(F.col("keyword").isin(conflict), F.col("mentions"))).cast("double").alias("c"),
        F.sum(F.when(F.col("keyword").isin(list(voc.MILITARY)), F.col("mentions"))).cast("double").alias("m"),
    )

    def signal(kind, subject, severity, value, floor):
        return F.struct(
            F.lit(kind).alias("type"), F.lit(subject).alias("subject"), F.lit("").alias("category"), severity.alias("severity"),
            value.alias("value"), F.lit(floor).alias("floor"),
        )

    surge = totals.select(F.inline(F.array(
        signal("hotspot_escalation", "conflict", F.when(F.col("c") >= 20, "critical").otherwise("high"), F.col("c"), 10),
        signal("military_surge", "military", F.lit("high"), F.col("m"), 8),
    ))).filter(F.col("value") >= F.col("floor")).drop("floor")
    return spikes.unionByName(surge)


def detect_signals(df: DataFrame, headline: str, now: Column) -> DataFrame:
    """All correlation signals: ``type, subject, category, severity, value``."""
    parts = [velocity_spikes(df, now), triangulations(df, headline), geo_convergence(df), keyword_signals(threat_counts(df, headline))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def focal_points(df: DataFrame, least: int = 3) -> DataFrame:
    """Grid cells of one degree with several events: counts, sources, categories and severity."""
    cell = lambda c, n: F.bround(F.col(c)).cast("int").alias(n)
    cells = df.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull()).groupBy(cell("lat", "cell_lat"), cell("lon", "cell_lon")).agg(
        F.count("*").alias("event_count"), F.countDistinct("category").alias("categories"), F.countDistinct("source").alias("source_count")
    )
    n = F.col("event_count")
    return cells.filter(n >= least).withColumn("severity", F.when(n >= 10, "critical").when(n >= 5, "high").otherwise("medium"))


def instability(signals: DataFrame, country: str) -> DataFrame:
    """Instability index 0–100 per country from its signals: baseline plus the best capped score of each signal kind."""
    weight = F.create_map(*[x for k, v in {"critical": 1.0, "high": 0.7, "medium": 0.4, "low": 0.2}.items() for x in (F.lit(k), F.lit(v))])
    cap = F.create_map(*[x for k, v in voc.SIGNAL_CAPS.items() for x in (F.lit(k), F.lit(v))])
    strength = F.col("value") * F.coalesce(F.element_at(weight, F.col("severity")), F.lit(0.1))
    scored = signals.select(country, F.explode(F.array(
        F.struct(F.col("type").alias("kind"), (strength * 5).alias("score")), F.struct(F.col("category").alias("kind"), (strength * 3).alias("score"))
    )).alias("s")).select(country, F.col("s.kind").alias("kind"), F.least(F.element_at(cap, F.col("s.kind")).cast("double"), F.col("s.score")).alias("score"), F.element_at(cap, F.col("s.kind")).alias("cap"))
    kept = scored.withColumn("score", F.when(F.col("cap").isNotNull(), F.greatest(F.col("score"), F.lit(0.0))))
    best = kept.groupBy(country, "kind").agg(F.max("score").alias("score"), F.count("*").alias("_n"))
    baseline = F.when(F.col(country).isin(list(voc.STABLE_COUNTRIES)), 10).otherwise(25)
    total = best.groupBy(country).agg(F.coalesce(F.sum("score"), F.lit(0.0)).alias("_score"), (F.sum("_n") / 2).cast("long").alias("total_signals"))
    cii = F.greatest(F.least(F.floor(baseline + F.col("_score")), F.lit(100)), F.lit(0)).cast("int")
    out = total.select(country, baseline.alias("baseline"), "total_signals", cii.alias("cii_score"))
    c = F.col("cii_score")
    return out.withColumn("level", F.when(c >= 75, "CRITICAL").when(c >= 50, "HIGH").when(c >= 30, "ELEVATED").otherwise("STABLE"))


def hourly_baseline(df: DataFrame, hours: int = 168, least: int = 24) -> DataFrame:
    """Count per category and hour against mean and deviation of the last ``hours`` hours with articles before it."""
    from candlewick.operators.series import Axis, over_blocks, trailing

    counts = df.groupBy("category", F.date_trunc("hour", "ts").alias("hour")).agg(F.count("*").alias("current"))
    axis = Axis(("category",), ("hour",))

    def stats(w):
        past = w.rowsBetween(-hours, -1)
        return {"mean": F.avg("current").over(past), "stddev": F.stddev_pop("current").over(past), "sample_size": F.count("current").over(past)}

    z = (F.col("current") - F.round("mean", 2)) / F.round("stddev", 2)
    out = over_blocks(counts, axis, [stats], back=hours)
    out = out.filter((F.col("sample_size") >= least) & (F.round("stddev", 2) >= 0.5) & (z >= 2))
    return out.select(
        "category", "hour", "current", F.round("mean", 2).alias("baseline_mean"), F.round(z, 2).alias("z_score"),
        F.round(F.col("current") / F.greatest(F.round("mean", 2), F.lit(0.1)), 1).alias("multiplier"),
        F.when(z >= 4, "critical").when(z >= 3, "high").otherwise("medium").alias("severity"),
    )


# ------------------------------------------------------------------------------------------------ monitors, search, places


def monitor_pattern(keywords: Sequence[str]) -> str:
    return "(?i)" + "|".join(rf"\b{re.escape(k.strip())}\b" for k in keywords)


def scan_monitors(df: DataFrame, text: str, monitors: Mapping[str, Sequence[str]]) -> DataFrame:
    """One row per article and monitor whose keywords (whole words, any case) it contains; all monitors in one pass."""
    hits = [F.when(F.col(text).rlike(monitor_pattern(words_)), F.lit(name)) for name, words_ in monitors.items() if words_]
    return df.withColumn("monitor", F.explode(F.array_compact(F.array(*hits))))


def search_ranked(df: DataFrame, key: str, text: str, query: str, n: int, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """BM25 of the articles that contain every query word, best ``n``; one pass for the counts, one for the scores."""
    wanted = sorted(set(re.findall(r"\w+", query.lower())))

    def count(q):
        return F.size(F.filter("_words", lambda w: w == q))

    base = df.withColumn("_words", words(F.lower(text)))
    base = base.select(*df.columns, F.size("_words").alias("_len"), *[
        count(q).alias(f"_tf{i}") for i, q in enumerate(wanted)
    ])
    totals = base.agg(F.count("*").alias("_docs"), F.avg("_len").alias("_mean"), *[F.count(F.when(F.col(f"_tf{i}") > 0, 1)).alias(f"_df{i}") for i in range(len(wanted))])
    both = base.join(F.broadcast(totals))  # one row
    score = F.lit(0.0)
    for i in range(len(wanted)):
        idf = F.greatest(F.log((F.col("_docs") - F.col(f"_df{i}") + 0.5) / (F.col(f"_df{i}") + 0.5)), F.lit(1e-6))
        tf = F.col(f"_tf{i}")
        score = score + idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * F.col("_len") / F.col("_mean")))
    every = F.lit(True)
    for i in range(len(wanted)):
        every = every & (F.col(f"_tf{i}") > 0)
    scored = both.filter(every).select(*df.columns, score.alias("score"))
    return scored.orderBy(F.desc("score"), F.asc(key)).limit(n)


def search_like(df: DataFrame, text: str, query: str, order: str, n: int) -> DataFrame:
    """Newest ``n`` articles with the query as a substring, any case."""
    return df.filter(F.lower(text).contains(query.lower())).orderBy(F.desc(order)).limit(n)


def geocode(df: DataFrame, text: str, most: int = 5, cities=None, countries=None) -> DataFrame:
    """Places named in the text (cities first) with coordinates; articles without one are left out."""
    low = F.lower(text)
    cities, countries = cities or [(n, *at) for n, at in voc.CITIES.items()], countries or [(n, *at) for n, at in voc.CENTRES.items()]
    known = {name for name, _, _ in cities}
    rows = [(p[0], *p, "city") for p in cities] + [(p[0], *p, "country") for p in countries if p[0] not in known]
    table = _table([(phrase, name.title(), lat, lon, kind) for phrase, name, lat, lon, kind in rows], ("phrase", "name", "lat", "lon", "kind"))
    found = _once(low, lambda t: F.filter(table, lambda p: t.contains(p["phrase"])))
    out = df.withColumn("locations", found).filter(F.size("locations") > 0)
    return out.withColumns({
        "locations": F.slice("locations", 1, most),
        "primary_lat": F.get("locations", F.lit(0))["lat"],
        "primary_lon": F.get("locations", F.lit(0))["lon"],
    })


# ------------------------------------------------------------------------------------------------ filings


def filing_score(text: Column, form: Column) -> Column:
    """Confidence 0–1 that a filing announces a merger or acquisition."""
    words_ = _strings(voc.DEAL_WORDS)
    patterns = "|".join(f"(?:{p})" for p in voc.DEAL_PATTERNS)

    def by_text(low: Column) -> Column:
        by_word = F.least(F.size(F.filter(words_, lambda w: low.contains(w))) * 0.07, F.lit(0.35))
        by_pattern = sum((F.when(low.rlike(p), 1).otherwise(0) for p in voc.DEAL_PATTERNS), F.lit(0)) * 0.10
        return by_word + F.when(low.rlike(patterns), by_pattern).otherwise(0.0)

    by_form = F.when(form.isin(list(voc.SURE_FORMS)), 0.45).when(form.isin(list(voc.LIKELY_FORMS)), 0.15).otherwise(0.0)
    items = F.regexp_extract_all(text, F.lit(r"Item\s+(\d+\.\d+)"), F.lit(1))
    by_item = F.when((form == "8-K") & F.arrays_overlap(items, _strings(voc.EVENT_ITEMS)), 0.20).otherwise(0.0)
    return F.least(by_form + _once(F.lower(text), by_text) + by_item, F.lit(1.0))


def scan_filings(df: DataFrame, text: str, form: str, least: float = 0.75) -> DataFrame:
    """Filings at or above a confidence."""
    return df.withColumn("confidence", filing_score(F.col(text), F.col(form))).filter(F.round("confidence", 9) >= least)


def required_words(pattern: str) -> list[str]:
    """Words of a lower-case pattern that every match holds: letters outside groups, classes and repetitions."""
    bare = re.sub(r"\[[^\]]*\]", " ", re.sub(r"\\.", " ", pattern))
    while "(" in bare:
        bare = re.sub(r"\([^()]*\)", " ", bare)
    return [] if "|" in bare else re.findall(r"[a-z]{2,}", re.sub(r".(?:[?*]|\{)", " ", bare))


def _search(text: Column, pattern: str, group: int, low: Column) -> Column:
    """Match of a pattern in any case, searched for only in texts (``low``: in lower case) that hold its required words."""
    found = F.regexp_extract(text, "(?i)" + pattern, group)
    needed = [low.contains(w) for w in required_words(pattern)]
    return F.when(functools.reduce(lambda a, b: a & b, needed), found) if needed else found


def _read(text: Column, pattern: str, low: Column, value: Callable[[Column, Column], Column]) -> Column:
    """``value`` of the match in lower case and of its number, null without a match; the number is looked up in the match alone."""
    return _once(_search(text, pattern, 0, low), lambda m: F.when(m != "", value(F.lower(m), F.regexp_extract(m, "(?i)" + pattern, 1))))


def deal_value(text: Column, low: Column | None = None) -> Column:
    """First stated value, in currency units; bare numbers are read as millions or billions by their size."""
    low = F.lower(text) if low is None else low

    def scaled(whole: Column, number: Column) -> Column:
        value = F.regexp_replace(number, ",", "").try_cast("double")
        plain = F.when(value > 1e6, value).when(value > 1e3, value * 1e6).otherwise(value * 1e9)
        return F.when(whole.contains("billion") | whole.contains("bn"), value * 1e9).when(whole.contains("million"), value * 1e6).otherwise(plain)

    return F.coalesce(*[_read(text, p, low, scaled) for p in voc.DEAL_VALUES])


def announcement_date(text: Column, filed: Column) -> Column:
    """First date stated in the text, else the filing date."""
    named = F.regexp_extract(text, r"(?:dated|entered\s+into|effective)\s+(?:as\s+of\s+)?(\w+\s+\d{1,2},\s*\d{4})", 1)
    slashed = F.regexp_extract(text, r"(\d{1,2}/\d{1,2}/\d{4})", 1)
    return F.coalesce(
        F.to_date(F.try_to_timestamp(F.nullif(F.regexp_replace(named, r",\s*", ", "), F.lit("")), F.lit("MMMM d, yyyy"))),
        F.to_date(F.try_to_timestamp(F.nullif(slashed, F.lit("")), F.lit("M/d/yyyy"))),
        filed,
    )


def payment_method(text: Column, low: Column | None = None) -> Column:
    low = F.lower(text) if low is None else low
    has = lambda terms: functools.reduce(lambda a, b: a | b, [low.contains(t) for t in terms])
    cash, stock = has(voc.PAID_IN_CASH), has(voc.PAID_IN_STOCK)
    return F.when(has(voc.PAID_IN_BOTH) | (cash & stock), "Mixed").when(cash, "Cash").when(stock, "Stock").otherwise("Cash")


def _first_number(text: Column, patterns: Sequence[str], keep, low: Column) -> Column:
    found = [_search(text, p, 1, low).try_cast("double") for p in patterns]
    return F.coalesce(*[_once(v, lambda x: F.when(keep(x), x)) for v in found])


def premium(text: Column, patterns: Sequence[str] = voc.PREMIUM_1DAY, low: Column | None = None) -> Column:
    """First premium in percent that is sane (0–200)."""
    return _first_number(text, patterns, lambda v: (v > 0) & (v < 200), F.lower(text) if low is None else low)


def synergies(text: Column, low: Column | None = None) -> Column:
    low = F.lower(text) if low is None else low
    scaled = lambda whole, number: number.try_cast("double") * F.when(whole.contains("billion"), 1e9).otherwise(1e6)
    return F.coalesce(*[_read(text, p, low, scaled) for p in voc.SYNERGIES])


def deal_type(text: Column, low: Column | None = None) -> Column:
    low = F.lower(text) if low is None else low
    has = lambda *p: F.greatest(*[low.contains(x) for x in p]) if len(p) > 1 else low.contains(p[0])
    return (
        F.when(has("merger of equals", "merger agreement"), "Merger").when(has("tender offer"), "Takeover")
        .when(has("asset purchase", "sale of assets"), "Asset Purchase").when(has("joint venture"), "Joint Venture").otherwise("Acquisition")
    )


def deal_status(text: Column, form: Column, low: Column | None = None) -> Column:
    low = F.lower(text) if low is None else low
    has = lambda *p: F.greatest(*[low.contains(x) for x in p])
    return (
        F.when(form.isin("DEFM14A", "PREM14A"), "Pending").when(has("closed", "completed", "consummated"), "Completed")
        .when(has("terminated", "abandoned"), "Terminated").when(has("pending", "subject to"), "Pending").otherwise("Announced")
    )


def deal_fields(df: DataFrame, text: str, form: str, filed: str) -> DataFrame:
    t, low = F.col(text), F.col("_low")
    return df.withColumn("_low", F.lower(t)).withColumns({
        "deal_value": deal_value(t, low),
        "announced": announcement_date(t, F.col(filed)),
        "payment": payment_method(t, low),
        "deal_type": deal_type(t, low),
        "status": deal_status(t, F.col(form), low),
        "premium_1day": premium(t, low=low),
        "premium_1week": premium(t, voc.PREMIUM_1WEEK, low),
        "premium_4week": premium(t, voc.PREMIUM_4WEEK, low),
        "synergies": synergies(t, low),
    }).drop("_low")
