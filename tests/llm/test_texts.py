"""BPE, personal data, language and language-model scores against plain computations."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from candlewick.llm import bpe, language_id, pii, ppm
from candlewick.llm.common import bucket_of

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")
SCHEMA = "doc_id long, text string, ids string, score string, spans string"
ODD = [
    (-1, "Hello wörld's 12 <|endoftext|> ΣΑΣ it's  \n</w> don't ÅÅ a<|startoftext|>b <|ENDOFTEXT|> \x1c x y ²½ Ⅷ_a"),
    (-2, None), (-3, ""), (-4, " \n\t "), (-5, "a" * 3000 + "bc" * 2000), (-6, "same"), (-6, "same"), (None, "no id"), (-7, "\U0001f600‍\U0001f600  123456.789"),
]


@pytest.fixture(scope="module")
def docs(spark, sf, tmp_path_factory):
    odd = spark.createDataFrame([(*r, "clash", "clash", "clash") for r in ODD], SCHEMA)
    given = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", *[F.lit("clash").alias(c) for c in ("ids", "score", "spans")])
    path = str(tmp_path_factory.mktemp("docs") / "docs")
    given.unionByName(odd).write.parquet(path)
    return spark.read.parquet(path)


def test_bpe_equals_the_library(docs):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = tokenizers.Tokenizer.from_file(path)
    got = bpe.decode(bpe.encode(docs, path, keep=("doc_id", "text")), path).collect()
    assert len(got) == docs.count()
    for r in got:
        want = library.encode(r.text or "", add_special_tokens=False).ids
        assert list(r.ids) == want
        assert r.decoded == library.decode(want, skip_special_tokens=False)


def test_bpe_edges(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    assert bpe.encode(spark.createDataFrame([], SCHEMA), path).collect() == []
    lists = spark.createDataFrame([([3306, 10**6, -1, 49407],), ([],), (None,)], "ids array<int>")
    assert [r.decoded for r in bpe.decode(lists, path).collect()] == ["hello</w> <|endoftext|>", "", None]


def test_decoding_takes_a_batch_in_bounded_slices(spark, monkeypatch):
    monkeypatch.setattr(bpe, "IDS", 7)
    lists = [[3306] * n if n is not None else None for n in (3, 0, 4, None, 1, 20, 2, 5, 0, 6, None)]
    parts = list(bpe._slices(pa.record_batch([pa.array(lists, pa.list_(pa.int32()))], names=["ids"]), "ids"))
    assert [x for part in parts for x in part.column("ids").to_pylist()] == lists
    assert all(part.num_rows == 1 or len(part.column("ids").flatten()) <= 7 for part in parts)
    takes = []
    monkeypatch.setattr(bpe.pc, "take", lambda values, at, take=bpe.pc.take: takes.append(len(at)) or take(values, at))
    look_up = []
    frame = SimpleNamespace(mapInArrow=lambda body, schema: look_up.append(body), schema=spark.createDataFrame([], "ids array<int>").schema)
    bpe.decode(frame, public_tokenizers.path("word_bpe_49k.json"))
    batch = pa.record_batch([pa.array(lists, pa.list_(pa.int32()))], names=["ids"])
    decoded = [x for part in look_up[0](iter([batch, batch])) for x in part.column("decoded").to_pylist()]
    assert decoded == 2 * [None if x is None else " ".join(["hello</w>"] * len(x)) for x in lists]
    assert max(takes) == 20 and sorted(takes)[-3] <= 7  # the longest list by itself, twice


def plain_spans(text):
    def luhn(digits):
        total = 0
        for i, c in enumerate(reversed(digits)):
            v = int(c) * (1 + i % 2)
            total += v - 9 if v > 9 else v
        return total % 10 == 0

    digits = lambda s: re.sub("[^0-9]", "", s)
    kinds = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda h: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda h: all(int(p) <= 255 for p in h.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda h: 12 <= len(digits(h)) <= 19 and luhn(digits(h))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda h: 9 <= len(digits(h)) <= 15),
    ]
    return sorted((m.start(), i, m.end()) for i, (_, pattern, ok) in enumerate(kinds) for m in re.finditer(pattern, text) if ok(m[0]))


def test_pii_equals_plain_matches(spark, docs):
    hard = [
        "mail a@b.com_x@c.org 1.2.3.4.5.6.7.8 4495-1148 2761 2972 +1 (274) 555-9629 a@b.c@d.e 300.1.1.1 001.2.3.4",
        "é4495114827612972 \U0001f600 x@y.z +12345678 +123456789 ++1 23 45 67 89 0", "1" * 4000 + " a@" + "b." * 3000 + "c", "a@b..c 1..2.3.4 0000000001.2.3.4 5-5 5--5", "9" * 19 + " +" + "1" * 15,
    ]
    rows = docs.select("doc_id", "text", "spans").unionByName(spark.createDataFrame([(100 + i, x, "clash") for i, x in enumerate(hard)], "doc_id long, text string, spans string"))
    kinds = [k.name for k in pii.BASE]
    got = pii.find_pii(rows.withColumn("doc_id", F.struct("doc_id", "text"))).collect()
    assert len(got) == rows.count()
    for r in got:
        text = r.doc_id.text or ""
        assert [(s.start, kinds.index(s.kind), s.end) for s in r.spans if s.kind in kinds] == plain_spans(text)
        assert all(text[s.start : s.end] == s.hit for s in r.spans)


def test_pii_checksums_and_context(spark):
    rows = [
        (1, "iban DE89 3704 0044 0532 0130 00."), (2, "iban DE88 3704 0044 0532 0130 00."), (3, "my ssn 123-45-6789"), (4, "part 123-45-6789"), (5, "pay by card 4495114827612972"), (6, "order 4495114827612972"),
    ]
    got = {r.doc_id: [(s.kind, round(s.score, 1)) for s in r.spans] for r in pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: [("iban", 1.0)], 2: [], 3: [("ssn", 0.7)], 4: [], 5: [("card", 0.9)], 6: [("card", 0.3)]}


def test_language_on_held_out_documents(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang", (bucket_of(F.col("doc_id"), 5) == 0).alias("held"), F.lit("clash").alias("score"))
    net = language_id.train(rows.where("NOT held"), per_label=150)
    odd = spark.createDataFrame([(-1, None, None, True, ""), (-2, "", None, True, ""), (-3, "12 !!", None, True, ""), (-4, "the thing is that " * 3000, "en", True, ""), (None, "die und der", None, True, "")], rows.schema)
    got = language_id.predict(rows.where("held").unionByName(odd), net).collect()
    assert {r.doc_id: (r.lang_pred, r.score) for r in got if r.doc_id in (-1, -2, -3)} == {-1: ("und", 0.0), -2: ("und", 0.0), -3: ("und", 0.0)}
    judged = [r for r in got if r.lang is not None]
    assert len(got) == rows.where("held").count() + 5 and all(0 <= r.score <= 1 for r in got)
    assert sum(r.lang == r.lang_pred for r in judged) >= 0.97 * len(judged)
    again = language_id.predict(rows.where("held"), language_id.train(rows.where("NOT held"), per_label=150)).collect()
    assert {r.doc_id: (r.lang_pred, r.score) for r in again} == {r.doc_id: (r.lang_pred, r.score) for r in got if r.doc_id is not None and r.doc_id >= 0}


def test_language_without_labels(spark):
    rows = spark.createDataFrame([(1, "some words", None)], "doc_id long, text string, lang string")
    assert language_id.train(rows) is None
    assert [(r.lang_pred, r.score) for r in language_id.predict(rows, None).collect()] == [("und", 0.0)]
    assert language_id.predict(rows.limit(0), None).collect() == []


def plain_scores(rows, order):
    """The same model with sets of symbols, one symbol after the other."""
    lower = lambda w: re.sub("[A-Z]", lambda m: m[0].lower(), w)
    words = lambda t: [lower(w) for w in re.findall(r"[^ \t-\r]+", t or "")]

    def symbols(text):
        yield [256] * order + list((text or "").encode()) + [256]

    trie, counts, ends = [defaultdict(Counter) for _ in range(order + 1)], Counter(), 0
    for _, text, trained in rows:
        if trained:
            ends += 1
            counts.update(words(text))
            for s in symbols(text):
                for i in range(order, len(s)):
                    for k in range(order + 1):
                        trie[k][tuple(s[i - k : i])][s[i]] += 1
    total, kinds = sum(counts.values()) + ends, len(counts) + (ends > 0)

    def chance(context, symbol):
        out, p = set(), 1.0
        for k in range(order, -1, -1):
            left = {a: n for a, n in trie[k].get(context[order - k :], {}).items() if a not in out}
            room = sum(left.values()) + len(left)
            if symbol in left:
                return p * left[symbol] / room
            p *= len(left) / room if room else 1
            out |= set(left)
        return p / (257 - len(out))

    smooth = lambda c: math.log10((c + 0.1) / (total + 0.1 * (kinds + 1)))
    for key, text, _ in rows:
        own = words(text)
        score = sum(math.log10(chance(tuple(s[i - order : i]), s[i])) for s in symbols(text) for i in range(order, len(s)))
        yield key, len(own) + 1, sum(counts[w] > 0 for w in own) + (ends > 0), total, sum(smooth(counts[w]) for w in own) + smooth(ends), score


@pytest.mark.parametrize("order", [2, 4])
def test_matching_model_equals_plain_trie(docs, order):
    part = docs.where("doc_id < 40 OR doc_id IS NULL")
    got = ppm.score_texts(part, bucket_of(F.col("doc_id"), 10) != 0, order=order).collect()
    rows = [(r.doc_id, r.text, zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 10 != 0) for r in part.collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[5])
    have = sorted([(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got], key=key)
    want = sorted(plain_scores(rows, order), key=key)
    assert [x[:4] for x in have] == [x[:4] for x in want]
    for h, w in zip(have, want, strict=True):
        assert h[4:] == pytest.approx(w[4:], rel=1e-9)


def test_contexts_run_across_words(spark, monkeypatch):
    monkeypatch.setattr(ppm, "CHARS", 300)  # several batches
    rng = random.Random(5)
    words = ["of", "a", "the", "house", "river", "in", "stone", "I", "bridge", "under"]
    follows = {w: rng.sample(words, 2) for w in words}
    texts = []
    for _ in range(60):
        text = [rng.choice(words)]
        while len(text) < 30:
            text.append(rng.choice(follows[text[-1]]))
        texts.append(text)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)] + [(100 + i, " ".join(rng.sample(t, len(t)))) for i, t in enumerate(texts)]
    got = {r.doc_id: r.score for r in ppm.score_texts(spark.createDataFrame(rows, "doc_id long, text string").repartition(2).checkpoint(), F.col("doc_id") < 50).collect()}
    assert all(got[i] > got[100 + i] + 3 for i in range(50, 60))


def test_matching_model_edges(spark):
    rows = spark.createDataFrame([(1, "some words"), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in ppm.score_texts(rows, F.lit(False)).collect()}
    assert got[2].n_tokens == 1 and got[2].n_known == 0 and got[1].score == pytest.approx(-math.log10(257) * 11)
    assert ppm.score_texts(rows.limit(0), F.lit(True)).collect() == []
