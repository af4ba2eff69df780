"""Language-model scores by prediction by partial matching.

A text is coded byte by byte, with one end symbol after it. The model is a trie of byte contexts: the ``order`` symbols before, across words and
white space (end symbols stand for what lies before the text). A symbol is looked for in
the longest context that the training texts hold; if it is not there, an escape is paid (method C: as many chances as the
context has different successors) and the next shorter context is tried without the symbols already excluded, down to equal
chances for all that is left.

The trie is a set of tables, one per context length: edges (context, symbol, count) and contexts (total, successors, and what
the successors count for in the next shorter context, which is what exclusion takes away). A context and its symbol, a gram, are packed into a long, nine
bits a symbol. The probability of a gram is computed once for all its mentions.

Texts are read in batches (``words``). Bytes deep enough inside a token (a word with the white space after it) have a context inside it and are looked at once per distinct token of the batch; the first
bytes of a token once per distinct pair of what precedes it and how it begins. Distinct words and grams of a batch travel packed by lane, a lane of all batches
meets in one task, counts and probabilities come back the same way, and texts are put together from word numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.llm.common import runs, store
from candlewick.llm.words import Split, _by_lane, _coded, pack, unpack, words_of

END = 256  # symbol after a text; also stands for what lies before its first byte
BITS = 9
ALPHABET = 257
CHARS = 6_000_000  # of the texts of a batch
MOST_LANES = 65_521
BLANK = " \t\n\x0b\x0c\r"

SPLIT = Split(spaced=True)


class Batch:
    """Distinct words and grams of a batch of texts, in the order of their lanes, and where they are mentioned.

    ``tokens``: distinct tokens; ``codes``: tokens of all texts one after the other; ``counts``: tokens of each text.
    """

    def __init__(self, tokens: pa.Array, codes: np.ndarray, counts: np.ndarray, order: int, lanes: int):
        self.codes, self.counts = codes, counts
        self.row = np.repeat(np.arange(len(counts)), counts)
        coded = pc.ascii_lower(pc.ascii_rtrim(tokens, characters=BLANK)).dictionary_encode()
        rank_of, lane = _by_lane(coded.dictionary, lanes)
        place = np.empty(len(rank_of), np.int32)
        place[rank_of] = np.arange(len(rank_of), dtype=np.int32)
        self.words, self.word_cuts = coded.dictionary.take(pa.array(rank_of)), np.searchsorted(lane, np.arange(lanes + 1))
        self.word_of = place[np.asarray(coded.indices)] if len(tokens) else np.empty(0, np.int32)
        self.is_word = np.asarray(pc.binary_length(self.words)) > 0
        self._grams(tokens, order, lanes)

    def _grams(self, tokens: pa.Array, order: int, lanes: int) -> None:
        n = len(tokens)
        raw = tokens.cast(pa.large_binary())
        borders = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + n + 1] if n else np.zeros(1, np.int64)
        signs = np.frombuffer(raw.buffers()[2], np.uint8)[borders[0] : borders[-1]].astype(np.int64) if n else np.empty(0, np.int64)
        start, size = (borders - borders[0])[:-1], np.diff(borders)
        low = np.array([(1 << BITS * k) - 1 for k in range(order + 1)], np.int64)

        # bytes with their whole context inside the token
        inner = np.flatnonzero(np.arange(len(signs)) - np.repeat(start, size) >= order)
        gram = np.zeros(len(inner), np.int64)
        for back in range(order, -1, -1):
            gram = (gram << BITS) | signs[inner - back]
        self.inner_token = np.repeat(np.arange(n, dtype=np.int32), np.maximum(size - order, 0))

        # first and last symbols of each token; after the last one come the end symbol and the beginning of a text
        short = np.minimum(size, order)
        first, last = np.zeros(n + 2, np.int64), np.zeros(n + 2, np.int64)
        for j in range(order):
            has = np.flatnonzero(short > j)
            first[has] = (first[has] << BITS) | signs[start[has] + j]
            has = np.flatnonzero(short > order - 1 - j)
            last[has] = (last[has] << BITS) | signs[(start + size)[has] - (order - j)]
        end, begin = n, n + 1
        first[end] = last[end] = END
        for _ in range(order):
            last[begin] = (last[begin] << BITS) | END
        opens, known = np.concatenate([short, [1, 0]]), np.concatenate([short, [1, order]])

        # all tokens in order, each text between a beginning and an end
        where = np.concatenate([[0], np.cumsum(self.counts + 2)]).astype(np.int64)
        stream = np.full(where[-1], end, np.int32)
        stream[where[:-1]] = begin
        stream[np.arange(len(self.codes)) + 2 * self.row + 1] = self.codes
        tail, held = last[stream], known[stream]
        step = 1
        while step < order:  # what short tokens lack comes from those before
            at = np.flatnonzero(held < order)
            own, lack = held[at], order - held[at]
            tail[at], held[at] = ((tail[at - step] & low[lack]) << (BITS * own)) | tail[at], np.minimum(order, own + held[at - step])
            step *= 2
        scored = np.flatnonzero(stream != begin)
        heads, head_of = np.unique((first << 3) | opens, return_inverse=True)
        tails, tail_of = np.unique(tail[scored - 1], return_inverse=True)
        del tail, held
        pairs, self.pair_of = np.unique(tail_of.astype(np.int64) * len(heads) + head_of[stream[scored]], return_inverse=True)
        del tail_of, stream
        self.text_of = np.repeat(np.arange(len(self.counts), dtype=np.int32), self.counts + 1)
        before, head = tails[pairs // len(heads)], heads[pairs % len(heads)]
        length, head = head & 7, head >> 3
        grams, of_pair = [gram], []
        for j in range(order):
            has = np.flatnonzero(length > j)
            grams.append(((before[has] & low[order - j]) << (BITS * (j + 1))) | (head[has] >> (BITS * (length[has] - 1 - j))))
            of_pair.append(has)
        self.gram_pair = np.concatenate(of_pair)
        self.pairs = len(pairs)
        distinct, index = np.unique(np.concatenate(grams), return_inverse=True)
        by_lane = np.argsort(distinct % lanes, kind="stable")
        place = np.empty(len(distinct), np.int32)
        place[by_lane] = np.arange(len(distinct), dtype=np.int32)
        self.grams, self.index = distinct[by_lane], place[index]
        self.gram_cuts = np.searchsorted(self.grams % lanes, np.arange(lanes + 1))

    def mentions(self, trained: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Mentions of each word and gram in the texts that ``trained`` names."""
        token = np.bincount(self.codes, trained[self.row], len(self.word_of))
        pair = np.bincount(self.pair_of, trained[self.text_of], self.pairs)
        words = np.bincount(self.word_of, token, len(self.words)) * self.is_word
        grams = np.bincount(self.index, np.concatenate([token[self.inner_token], pair[self.gram_pair]]), len(self.grams))
        return words.astype(np.int64), grams.astype(np.int64)

    def totals(self, logp: np.ndarray) -> np.ndarray:
        """Sum over the grams of each text."""
        own = logp[self.index]
        cut = len(self.inner_token)
        token = np.bincount(self.inner_token, own[:cut], len(self.word_of))
        pair = np.bincount(self.gram_pair, own[cut:], self.pairs)
        return np.bincount(self.text_of, pair[self.pair_of], len(self.counts)) + np.bincount(self.row, token[self.codes], len(self.counts))

    def add_words(self, value: np.ndarray) -> np.ndarray:
        """Sum over the words of each text."""
        return np.bincount(self.row, (value * self.is_word)[self.word_of][self.codes], len(self.counts))


def _wide(values: np.ndarray) -> list[bytes]:
    """64-bit numbers by byte planes, compressed."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8).T
    return [pa.compress(np.ascontiguousarray(p).tobytes(), "zstd", asbytes=True) for p in planes]


def _narrow(planes: list[bytes], size: int, kind: type) -> np.ndarray:
    held = [np.frombuffer(pa.decompress(p, size, "zstd", asbytes=True), np.uint8) for p in planes]
    return np.ascontiguousarray(np.stack(held, axis=1)).view(kind).ravel() if size else np.empty(0, kind)


BINARIES = pa.list_(pa.binary())
LANES = pa.schema([("lane", pa.int32()), ("batch", pa.int64()), ("n_words", pa.int32()), ("words", pa.binary()), ("word_n", BINARIES), ("n_grams", pa.int32()), ("grams", BINARIES), ("gram_n", BINARIES)])


def lane_table(docs: DataFrame, order: int, lanes: int) -> DataFrame:
    """Distinct words and grams of each batch by lane, with their mentions in training texts."""

    def rows(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, table, tokens, codes, counts in _coded(stream, SPLIT, CHARS):
            batch = Batch(tokens, codes, counts, order, lanes)
            of_words, of_grams = batch.mentions(np.asarray(table.column("trained").to_numpy(zero_copy_only=False), np.float64))
            spelled = batch.words.cast(pa.binary()).to_pylist()
            out = []
            for lane in range(lanes):
                a, b = batch.word_cuts[lane : lane + 2]
                c, d = batch.gram_cuts[lane : lane + 2]
                if a < b or c < d:
                    packed = pa.compress(b"\n".join(spelled[a:b]), "zstd", asbytes=True)
                    out.append((lane, name, b - a, packed, pack(of_words[a:b]), d - c, _wide(np.diff(batch.grams[c:d], prepend=0)), pack(of_grams[c:d])))
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], f.type) for i, f in enumerate(LANES)], schema=LANES)

    return docs.mapInArrow(rows, "lane int, batch bigint, n_words int, words binary, word_n array<binary>, n_grams int, grams array<binary>, gram_n array<binary>")


COUNTED = pa.schema([("lane", pa.int32()), ("batch", pa.int64()), ("counts", BINARIES), ("total", pa.int64()), ("kinds", pa.int64()), ("gram", pa.int64()), ("n", pa.int64())])


def count_lanes(held: DataFrame) -> DataFrame:
    """Per lane: ``batch, counts`` (mentions of each of the batch's words in all batches) and ``gram, n``; words and distinct trained words in ``total`` and ``kinds`` of one row."""

    def rows(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(stream, ["lane"]):
            parts = table.to_pylist()
            lane = parts[0]["lane"]
            spelled = [pa.array(words_of(p["words"]) if p["n_words"] else [], pa.string()) for p in parts]
            coded = pa.concat_arrays(spelled).dictionary_encode()
            at = np.asarray(coded.indices)
            c = np.bincount(at, np.concatenate([unpack(p["word_n"], p["n_words"]) for p in parts]), len(coded.dictionary)).astype(np.int64)
            cuts = np.cumsum([p["n_words"] for p in parts])[:-1]
            out = [dict(lane=lane, batch=p["batch"], counts=_wide(x)) for p, x in zip(parts, np.split(c[at], cuts), strict=True)]
            out.append(dict(lane=lane, total=int(c.sum()), kinds=int((c > 0).sum())))
            grams = [np.cumsum(_narrow(p["grams"], p["n_grams"], np.int64)) for p in parts]
            distinct, index = np.unique(np.concatenate(grams), return_inverse=True)
            n = np.bincount(index, np.concatenate([unpack(p["gram_n"], p["n_grams"]) for p in parts]), len(distinct)).astype(np.int64)
            yield pa.RecordBatch.from_pylist(out, COUNTED)
            for i in range(0, len(distinct), 100_000):
                part = [pa.array(x[i : i + 100_000]) for x in (distinct, n)]
                empty = [pa.nulls(len(part[0]), f.type) for f in list(COUNTED)[1:5]]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part[0]), lane, np.int32)), *empty, *part], schema=COUNTED)

    ready = held.repartition("lane").sortWithinPartitions("lane", "batch")
    return ready.mapInArrow(rows, "lane int, batch bigint, counts array<binary>, total bigint, kinds bigint, gram bigint, n bigint")


def probabilities(counted: DataFrame, order: int) -> DataFrame:
    """``gram, n`` (distinct, n may be 0) -> ``gram, logp``: log10 of the probability of the symbol after its context."""
    mask = lambda g, symbols: F.bitwise_and(g, F.lit((1 << BITS * symbols) - 1)) if isinstance(g, str) else g.bitwiseAND(F.lit((1 << BITS * symbols) - 1))
    every = store(counted.select("gram", "n"), "grams")
    edges = {order: every.where("n > 0")}
    for k in range(order - 1, -1, -1):
        edges[k] = store(edges[k + 1].groupBy(mask(F.col("gram"), k + 1).alias("gram")).agg(F.sum("n").alias("n")), f"edges{k}")
    frame = every.select("gram").withColumns({"p": F.lit(1.0), "found": F.lit(False), "x": F.lit(0).cast("long"), "q": F.lit(0).cast("long")})
    for k in range(order, -1, -1):
        own = edges[k]
        if k:
            shorter = edges[k - 1].select(F.col("gram").alias("_g"), F.col("n").alias("_m"))
            own = own.join(shorter, mask(F.col("gram"), k) == F.col("_g"))
        else:
            own = own.withColumn("_m", F.lit(0).cast("long"))
        contexts = own.groupBy(F.shiftright("gram", BITS).alias("_c")).agg(F.sum("n").alias("_t"), F.count("*").alias("_q"), F.sum("_m").alias("_x"))
        edge = edges[k].select(F.col("gram").alias("_e"), F.col("n").alias("_n"))
        frame = frame.join(contexts, mask(F.shiftright("gram", BITS), k) == F.col("_c"), "left").join(edge, mask(F.col("gram"), k + 1) == F.col("_e"), "left")
        frame = store(_descend(frame).select("gram", "p", "found", "x", "q"), f"level{k}")
    left = F.greatest(F.lit(ALPHABET) - F.col("q"), F.lit(1))
    return frame.select("gram", F.log10(F.when(F.col("found"), F.col("p")).otherwise(F.col("p") / left)).alias("logp"))


def _descend(frame: DataFrame) -> DataFrame:
    """One context length: take the symbol if it is there, else pay the escape and exclude its successors below."""
    there = ~F.col("found") & F.col("_t").isNotNull()
    room = (F.col("_t") - F.col("x") + F.col("_q") - F.col("q")).cast("double")  # chances left after exclusion
    hit = there & F.col("_n").isNotNull()
    escape: Column = F.when(room > 0, (F.col("_q") - F.col("q")) / room).otherwise(1.0)
    miss = there & F.col("_n").isNull()
    return frame.withColumns({
        "p": F.when(hit, F.col("p") * F.col("_n") / room).when(miss, F.col("p") * escape).otherwise(F.col("p")),
        "found": F.col("found") | hit,
        "x": F.when(miss, F.col("_x")).otherwise(F.col("x")),
        "q": F.when(miss, F.col("_q")).otherwise(F.col("q")),
    })


def score_texts(df: DataFrame, train: Column, order: int = 4, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, trained, n_tokens, n_known, train_tokens, base_score, score`` of every text.

    Rows for which ``train`` holds (null: not) teach the counts. ``base_score`` is the smoothed unigram log10 probability of the words
    (A-Z lower-cased) and one end token; ``score`` that of the byte model over the whole text and its end. Null and empty texts are one end.
    Repeated rows count each time, as training text and as result; null ids stay; without training rows all chances are equal; an empty table gives an empty result. ``order`` is
    6 at most (symbols are packed into 63 bits). The documents are read more than once and must be a table or a checkpoint.
    """
    docs = df.select(F.col(doc).alias("doc_id"), F.coalesce(train, F.lit(False)).alias("trained"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    ends, size = docs.agg(F.count_if("trained"), F.coalesce(F.sum(F.octet_length("_text")), F.lit(0))).first()
    lanes = _prime(min(MOST_LANES, max(61, 4 * (int(size) // CHARS + 1))))
    held = store(lane_table(docs, order, lanes), "lanes")
    counted = store(count_lanes(held), "counted")
    words, kinds = counted.agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("kinds"), F.lit(0))).first()
    total, distinct = int(words) + ends, int(kinds) + (ends > 0)
    chances = probabilities(counted.where("gram IS NOT NULL"), order)

    def look_up(parts: pa.Table, known: pa.Table) -> pa.Table:
        known = known.sort_by("gram")
        gram, logp = np.asarray(known.column("gram")), np.asarray(known.column("logp"))
        out = [dict(lane=p["lane"], batch=p["batch"], chances=_wide(logp[np.searchsorted(gram, np.cumsum(_narrow(p["grams"], p["n_grams"], np.int64)))])) for p in parts.to_pylist()]
        return pa.Table.from_pylist(out, pa.schema([("lane", pa.int32()), ("batch", pa.int64()), ("chances", BINARIES)]))

    lane_of = F.pmod("gram", F.lit(lanes)).cast("int").alias("_lane")
    sides = held.select("lane", "batch", "n_grams", "grams").groupBy("lane").cogroup(chances.select(lane_of, "gram", "logp").groupBy("_lane"))
    of_grams = sides.applyInArrow(look_up, "lane int, batch bigint, chances array<binary>")
    of_words = counted.where("batch IS NOT NULL").select("lane", "batch", "counts")
    found = of_words.withColumn("chances", F.lit(None).cast("array<binary>")).unionByName(of_grams.withColumn("counts", F.lit(None).cast("array<binary>")))

    def text_rows(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, table, tokens, codes, counts in _coded(stream, SPLIT, CHARS):
            packed = pack(codes)
            ids = pa.BufferOutputStream()
            kept = pa.table({"doc_id": table.column("doc_id"), "trained": table.column("trained"), "_n": pa.array(counts)})
            with pa.ipc.new_stream(ids, kept.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                writer.write_table(kept)
            spelled = pa.BufferOutputStream()
            with pa.ipc.new_stream(spelled, pa.schema([("t", pa.string())]), options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                writer.write_table(pa.table({"t": tokens.cast(pa.string())}))
            row = dict(batch=name, rows=ids.getvalue().to_pybytes(), tokens=spelled.getvalue().to_pybytes(), codes=packed)
            yield pa.RecordBatch.from_pylist([row], pa.schema([("batch", pa.int64()), ("rows", pa.binary()), ("tokens", pa.binary()), ("codes", BINARIES)]))

    def add_up(packed: pa.Table, found: pa.Table) -> pa.Table:
        if packed.num_rows != 1:
            raise RuntimeError("the documents came in another order on the second read; write or checkpoint them first")
        row = packed.to_pylist()[0]
        rows = pa.ipc.open_stream(row["rows"]).read_all()
        tokens = pa.ipc.open_stream(row["tokens"]).read_all().column("t").combine_chunks()
        counts = np.asarray(rows.column("_n"))
        batch = Batch(tokens, unpack(row["codes"], int(counts.sum())), counts, order, lanes)
        c, logp = np.zeros(len(batch.words), np.int64), np.full(len(batch.grams), np.nan)
        for f in found.to_pylist():
            cuts, target, kind, planes = (batch.word_cuts, c, np.int64, f["counts"]) if f["counts"] is not None else (batch.gram_cuts, logp, np.float64, f["chances"])
            lo, hi = cuts[f["lane"] : f["lane"] + 2]
            target[lo:hi] = _narrow(planes, int(hi - lo), kind)
        if np.isnan(logp).any():
            raise RuntimeError("grams of a batch are missing; write or checkpoint the documents first")
        scale = total + 0.1 * (distinct + 1)
        columns = {
            "n_tokens": batch.add_words(np.ones(len(c))).astype(np.int64) + 1,
            "n_known": batch.add_words((c > 0).astype(float)).astype(np.int64) + (ends > 0),
            "train_tokens": np.full(len(counts), total, np.int64),
            "base_score": batch.add_words(np.log10((c + 0.1) / scale)) + np.log10((ends + 0.1) / scale),
            "score": batch.totals(logp),
        }
        return pa.table({"doc_id": rows.column("doc_id"), "trained": rows.column("trained"), **{n: pa.array(v) for n, v in columns.items()}})

    new = [T.StructField(n, T.LongType()) for n in ("n_tokens", "n_known", "train_tokens")] + [T.StructField(n, T.DoubleType()) for n in ("base_score", "score")]
    schema = T.StructType([docs.schema["doc_id"], docs.schema["trained"], *new])
    texts = docs.mapInArrow(text_rows, "batch bigint, rows binary, tokens binary, codes array<binary>")
    return texts.groupBy("batch").cogroup(found.groupBy("batch")).applyInArrow(add_up, schema)


def _prime(least: int) -> int:
    while any(least % d == 0 for d in range(2, int(least**0.5) + 1)):
        least += 1
    return least
