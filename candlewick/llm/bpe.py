"""BPE encoding and decoding over a table of distinct words.

Texts are split at white space; the distinct words of all documents meet by word, each is encoded once, and the ids go back
to the positions it holds (``words``). Decoding looks every id up in the table of pieces, which has one row per vocabulary
entry and is therefore bounded by the tokenizer file.
"""

from __future__ import annotations

import heapq
import itertools
import json
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.llm.words import Split, lane_rows, pack, put_back, text_rows, unpack, words_of

#: White space as the tokenizer's patterns know it (fixed values: code points).
SPACES = (9, 10, 11, 12, 13, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288)
MARK = "\u00a0"  # before a special string; white space, so in no ordinary word
LANES = 2048  # of distinct words
CHARS = 8_000_000  # of the texts of a batch
SHORT = 48  # symbols up to which scanning for the best pair beats a heap
IDS = 400_000  # decoded at once; a longer list is decoded by itself


def byte_letters() -> list[str]:
    """The printable character that stands for each byte: itself if printable, else the next one from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


@dataclass
class WordBpe:
    """Vocabulary and merges of a word-level BPE tokenizer file with an end-of-word suffix."""

    vocab: dict[str, int]
    ranks: dict[tuple[str, str], int]
    suffix: str
    special: dict[str, int]
    pattern: str
    letters: list[str] = field(default_factory=byte_letters)

    @staticmethod
    def load(path: str) -> WordBpe:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        return WordBpe(model["vocab"], {m: i for i, m in enumerate(merges)}, model["end_of_word_suffix"], special, pattern)

    def splitter(self) -> Split:
        """Words are what stands between white space, composed and in lower case, and special strings behind a ``MARK``."""
        others = "".join(chr(c) for c in SPACES if c > 127)
        blank = str.maketrans(dict.fromkeys(others, " "))
        starts = {s[0] for s in self.special}
        cut = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None

        def plain(text: str) -> str:
            # lower-casing goes letter by letter: no final form of sigma
            text = unicodedata.normalize("NFC", text).replace("\u03a3", "\u03c3").lower()
            return text.translate(blank) if any(c in text for c in others) else text

        def ready(text: str) -> str:
            if not any(s in text for s in starts) or not cut.search(text):
                return plain(text)
            return " ".join(MARK + part if i % 2 else plain(part) for i, part in enumerate(cut.split(text)))

        return Split(ready)

    def encoder(self):
        """Function from a word to its ids."""
        pieces, ranks, vocab, special = regex.compile(self.pattern).findall, self.ranks, self.vocab, self.special
        letters = self.letters

        def encode(word: str) -> list[int]:
            if word[0] == MARK:
                return [special[word[1:]]]
            ids: list[int] = []
            for piece in pieces(word):
                symbols = [letters[b] for b in piece.encode("utf-8")]
                symbols[-1] += self.suffix
                merged = _merge_short(symbols, ranks) if len(symbols) <= SHORT else _merge_long(symbols, ranks)
                ids += [vocab[s] for s in merged]
            return ids

        return encode

    def pieces(self) -> list[str | None]:
        """Piece of each id."""
        by_id = {i: s for s, i in {**self.vocab, **self.special}.items()}
        return [by_id.get(i) for i in range(max(by_id) + 1)]


def _merge_short(s: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    """Join the pair of lowest rank, the first of equals, until none is left; ranks of pairs are kept beside the symbols."""
    never, rank = len(ranks), ranks.get
    here = [rank(p, never) for p in zip(s, s[1:], strict=False)]
    while here and (best := min(here)) < never:
        i = here.index(best)
        s[i : i + 2] = [s[i] + s[i + 1]]
        del here[i]
        if i:
            here[i - 1] = rank((s[i - 1], s[i]), never)
        if i < len(here):
            here[i] = rank((s[i], s[i + 1]), never)
    return s


def _merge_long(s: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    """The same with a heap of pairs and links to the neighbours, for words of any length."""
    after, before = [*range(1, len(s)), -1], [*range(-1, len(s) - 1)]
    heap = [(ranks[p], i, *p) for i, p in enumerate(zip(s, s[1:], strict=False)) if p in ranks]
    heapq.heapify(heap)
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = after[i]
        if s[i] != a or j < 0 or s[j] != b:
            continue
        s[i], s[j] = a + b, ""
        after[i] = after[j]
        if after[i] >= 0:
            before[after[i]] = i
        for x in (before[i], i):
            if x >= 0 and after[x] >= 0 and (pair := (s[x], s[after[x]])) in ranks:
                heapq.heappush(heap, (ranks[pair], x, *pair))
    return [x for x in s if x]


def encode(df: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``ids``: token ids of every text, special strings in a text as their own ids.

    Null and empty texts get an empty list; every row counts by itself, so repeated rows and null keys stay; an empty table gives
    an empty result. ``path`` is the tokenizer file, read on the driver and sent to the tasks.
    """
    bpe = WordBpe.load(path)
    split, encoder = bpe.splitter(), bpe.encoder()
    docs = df.select(*[F.col(c) for c in keep], F.col(text).cast("string").alias("_text"))

    def encode_lanes(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lane, table = None, {}
        for b in stream:
            out = []
            for row in b.to_pylist():
                if row["lane"] != lane:  # rows of a lane are neighbours: a word is encoded once
                    lane, table = row["lane"], {}
                found = []
                for word in words_of(row["words"]):
                    ids = table.get(word)
                    if ids is None:
                        ids = table[word] = encoder(word)
                    found.append(ids)
                flat = np.fromiter(itertools.chain.from_iterable(found), np.int32)
                out.append({"batch": row["batch"], "lane": lane, "n": len(found), "total": len(flat), "sizes": pack(np.fromiter(map(len, found), np.int32, len(found))), "ids": pack(flat)})
            yield pa.RecordBatch.from_pylist(out, found_schema)

    found_schema = pa.schema([("batch", pa.int64()), ("lane", pa.int32()), ("n", pa.int32()), ("total", pa.int32()), ("sizes", pa.list_(pa.binary())), ("ids", pa.list_(pa.binary()))])
    words = lane_rows(docs, split, LANES, CHARS).repartition("lane").sortWithinPartitions("lane", "batch")
    found = words.mapInArrow(encode_lanes, "batch bigint, lane int, n int, total int, sizes array<binary>, ids array<binary>")

    def gather(rows: pa.Table, codes: np.ndarray, counts: np.ndarray, found: pa.Table) -> pa.Table:
        lanes = found.to_pylist()
        sizes = np.concatenate([np.empty(0, np.int32), *(unpack(x["sizes"], x["n"]) for x in lanes)])
        if len(codes) and codes.max() >= len(sizes):
            raise RuntimeError("words of a batch are missing; write or checkpoint the documents first")
        flat = np.concatenate([np.empty(0, np.int32), *(unpack(x["ids"], x["total"]) for x in lanes)])
        borders = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        ids = pc.take(pa.ListArray.from_arrays(pa.array(borders), pa.array(flat)), pa.array(codes))
        ends = np.concatenate([[0], np.cumsum(sizes[codes], dtype=np.int64)])[np.concatenate([[0], np.cumsum(counts)])]
        return rows.append_column("ids", pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), ids.flatten()))

    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return put_back(text_rows(docs, split, LANES, CHARS), found, gather, schema, order="lane")


def _slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """A batch in slices whose lists hold at most ``IDS`` values together, or one longer list."""
    ends = np.cumsum(np.asarray(pc.fill_null(pc.list_value_length(batch.column(column)), 0)), dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        until = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + IDS, "right")))
        yield batch.slice(at, until - at)
        at = until


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Adds ``out``: the pieces of ``ids`` joined by a blank, special ones included. Unknown ids are left out, null lists stay null."""
    pieces = pa.array(WordBpe.load(path).pieces(), pa.string())

    def look_up(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in itertools.chain.from_iterable(_slices(b, ids) for b in stream):
            lists = batch.column(ids)
            flat = lists.flatten()
            known = pc.and_(pc.greater_equal(flat, 0), pc.less(flat, len(pieces)))
            texts = pc.take(pieces, pc.if_else(known, flat, pa.scalar(None, pa.int32())))
            counts = np.asarray(pc.fill_null(pc.list_value_length(lists), 0))
            if texts.null_count:
                keep = np.asarray(texts.is_valid())
                counts = np.add.reduceat(np.append(keep, False).astype(np.int64), np.concatenate([[0], np.cumsum(counts)[:-1]])) * (counts > 0)
                texts = texts.drop_null()
            offsets = np.concatenate([[0], np.cumsum(counts)])
            joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), texts), " ")
            joined = pc.if_else(lists.is_valid(), joined, pa.scalar(None, pa.string()))
            yield pa.RecordBatch.from_arrays([*batch.columns, joined], names=[*batch.schema.names, out])

    return df.mapInArrow(look_up, T.StructType([f for f in df.schema.fields if f.name != out] + [T.StructField(out, T.StringType())]))
