"""Joins, line deduplication, mixing and the pipeline against plain computations."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from candlewick.llm import components, line_dedup, mixing, ngram_join
from candlewick.llm.common import WORD

SCHEMA = "doc_id long, text string, source string, size string, component_id string"


def near_copies(seed=4):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(900)]
    rows, at = [], 0
    for n in (2, 3, 4, 5, 9, 14, 30, 60, 200, 900):
        base = [rng.choice(words) for _ in range(n)]
        for edits in (0, 0, 1, 1, 2, 5, 9, 20):
            own = list(base)
            for _ in range(min(edits, n)):
                own[rng.randrange(len(own))] = rng.choice(words).upper()
            rows.append((at, " \n".join(own), "s", "", ""))
            at += 1
    chain = [rng.choice(words) for _ in range(120)]
    for step in range(12):  # each links with its neighbours only
        rows.append((at, " ".join(chain[step * 4 : step * 4 + 60]), "s", "", ""))
        at += 1
    rows += [(at, None, None, "", ""), (at + 1, "", "s", "", ""), (at + 2, " \t", "s", "", ""), (None, rows[3][1], "s", "", ""), (5, rows[70][1], "s", "", ""), (at + 3, "x " * 30_000, "s", "", "")]
    rng.shuffle(rows)
    return rows


def plain_groups(rows, width, percent):
    sets = []
    for key, text, *_ in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append((key, {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()))
    root = {k: k for k, _ in sets if k is not None}

    def top(x):
        return x if root[x] == x else top(root[x])

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if None not in (a, b) and x and y and 100 * len(x & y) >= percent * len(x | y):
                low, high = sorted((top(a), top(b)))
                root[high] = low
    return sorted(((k, len(s), top(k) if k is not None else None) for k, s in sets), key=str)


@pytest.mark.parametrize("pairs", [None, 1])
def test_ngram_join_equals_all_pairs(spark, pairs, monkeypatch):
    if pairs:  # as many slot pairs with one-deletion neighbourhoods as there can be, and small blocks
        monkeypatch.setattr(ngram_join, "VOLUME", 300)
        monkeypatch.setattr(ngram_join, "COLUMNS", 64)
        monkeypatch.setattr(ngram_join, "allocate", lambda differ, *_: (differ + 1) // 2)
    rows = near_copies()
    got = ngram_join.ngram_join(spark.createDataFrame(rows, SCHEMA), width=3, percent=80)
    have = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()), key=str)
    assert have == plain_groups(rows, 3, 80)


def test_sets_that_share_phrases_only_are_not_sent_whole(spark, monkeypatch):
    rng = random.Random(9)
    phrases = [" ".join(f"p{i}x{j}" for j in range(8)) for i in range(12)]
    texts = [" ".join(rng.choice(phrases) if rng.random() < 0.3 else f"u{rng.randrange(10**9)}" for _ in range(120)) for _ in range(60)]
    texts += [texts[0] + " end", texts[1].replace(" u", " v", 3)]
    rows = [(i, t, "s", "", "") for i, t in enumerate(texts)]
    sent, whole = [], ngram_join._sets
    monkeypatch.setattr(ngram_join, "_sets", lambda docs, width: sent.append(docs) or whole(docs, width))
    monkeypatch.setattr(ngram_join, "allocate", lambda differ, *_: 0)
    got = ngram_join.ngram_join(spark.createDataFrame(rows, SCHEMA), width=3, percent=80)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()), key=str) == plain_groups(rows, 3, 80)
    # the first is the sample of the cost estimate; of 62 texts that share phrases four link
    assert all(d.count() <= 6 for d in sent[1:])


def test_rows_of_one_id_are_compared_with_all_their_texts(spark):
    one, other = (" ".join(f"{c}{i}" for i in range(40)) for c in "ab")
    rows = [(7, one, "s", "", ""), (7, other, "s", "", ""), (8, one + " x", "s", "", ""), (9, other + " x", "s", "", "")]
    left = spark.createDataFrame([(1, k, k) for k in (7, 8, 9)], "key long, node long, root long")
    found = ngram_join._between(spark.createDataFrame(rows, SCHEMA).select("doc_id", "text"), left, 3, 80)
    assert sorted(tuple(sorted(r)) for r in found.collect()) == [(7, 8), (7, 9)]


def test_allocation_follows_cost():
    assert ngram_join.allocate(20, 140, 1e6, 0.0) == 0
    assert ngram_join.allocate(20, 140, 1e6, 0.4) > 0
    starts = ngram_join.bands(85, 1000)
    assert all(100 * int(a) < 85 * int(b) for a, b in zip(starts, starts[1:], strict=False)) and starts[-1] > 1000


def test_groups_of_links(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(100, 160)] + [(0, i) for i in range(1, 90)] + [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(150)] + [(7, 7)]
    root = {}

    def top(x):
        root.setdefault(x, x)
        return x if root[x] == x else top(root[x])

    for a, b in links:
        low, high = sorted((top(a), top(b)))
        root[high] = low
    linked = {x for a, b in links if a != b for x in (a, b)}
    got = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: top(x) for x in linked}
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_lines(spark):
    common = "This very common line stands in many documents of the table, more or less"
    long = " ".join(f"word{i}" for i in range(60))
    rows = [
        (3, f"{common}\nown words of the third one", "s", "", ""), (1, f"first own line goes here\n{common}\n{common.upper()}!\nok\nok", "s", "", ""),
        (2, f"{common.replace('less', 'lesser')}\n{long}", "s", "", ""), (4, long.replace("word30", "word31") + "\n" + long, "s", "", ""), (5, common, "s", "", ""), (6, None, "s", "", ""), (7, "", "s", "", ""),
        (None, common, "s", "", ""), (8, "\n\n", "s", "", ""), (9, "a b c d e " * 40_000, "s", "", ""), (10, ("a b c d e " * 40_000).strip() + "\nx", "s", "", ""),
    ]
    got = {r.doc_id: r for r in line_dedup.dedup_lines(spark.createDataFrame(rows, SCHEMA), keep=("source",)).collect()}
    assert len(got) == len(rows) and got[1].source == "s"
    assert got[1].text == f"first own line goes here\n{common}\nok\nok" and got[1].removed == [2] and got[1].n_lines == 5
    assert got[3].text == "own words of the third one" and got[5].text == ""
    assert got[2].text.endswith(long) and got[6].text is None and got[6].n_lines == 0 and got[7].text == "" and got[8].text == "\n\n"
    assert got[None].text == common and got[9].removed == [] and got[10].text == "x"
    assert long not in got[4].text
    assert line_dedup.dedup_lines(spark.createDataFrame([], SCHEMA)).collect() == []


def test_letters_rule_out_only_lines_beyond_the_bound(spark):
    rng = random.Random(3)
    signs = "etaoin shrdlu 0123456789 \u00e9\u6f22"
    rows = []
    for i in range(120):
        x = [rng.choice(signs) for _ in range(rng.choice((5, 40, 300)))] if i else list("e" * 3000)
        y = list(x)
        for _ in range(rng.randrange(len(x) // 10 + 3)):
            at = rng.randrange(len(y))
            y[at : at + 1] = rng.choice(([], [rng.choice(signs)], [y[at], rng.choice(signs)]))
        rows += [(i, "".join(x), "".join(y)), (i, "".join(x), "".join(rng.choice(signs) for _ in x))]
    pairs = spark.createDataFrame(rows, "i int, x string, y string")
    for c, norm in (("a", "x"), ("b", "y")):
        pairs = pairs.select("*", F.length(norm).alias(f"{c}_chars"), *[v.alias(f"{c}_letters{k}") for k, v in enumerate(line_dedup._letters(F.col(norm)))])
    got = pairs.select((F.levenshtein("x", "y") <= F.floor(F.greatest(F.length("x"), F.length("y")) * 0.1 + 1e-9)).alias("link"), line_dedup._letters_allow(0.9).alias("allowed"))
    counts = {(r.link, r.allowed): r["count"] for r in got.groupBy("link", "allowed").count().collect()}
    assert not counts.get((True, False)) and counts[(True, True)] >= 60 and counts[(False, False)] >= 80


@pytest.mark.parametrize("held", [None, 40])
def test_beginnings_rule_out_only_lines_beyond_the_bound(spark, held):
    rng = random.Random(6)
    signs = "etaoinshrdlu \u00e9\u6f22"
    edits = {"any": lambda c: rng.choice(([], [rng.choice(signs)], [c, rng.choice(signs)])), "less": lambda c: [], "more": lambda c: [c, rng.choice(signs)]}
    rows = []
    for i in range(300):
        x = [rng.choice(signs) for _ in range(rng.choice((4, 30, 90, 130)))]
        y, kind, begin = list(x), edits[rng.choice(list(edits))], rng.random() < 0.5  # half of them near the beginning only
        for _ in range(rng.randrange(len(x) // 10 + 3)):
            at = rng.randrange(max(1, len(y) // (6 if begin else 1)))
            y[at : at + 1] = kind(y[at])
        x, y = (x, y) if rng.random() < 0.5 else (y, x)
        rows += [("".join(x), "".join(y)), ("".join(x), "".join(rng.choice(signs) for _ in x))]
    pairs = spark.createDataFrame(rows, "x string, y string").withColumns({"nx": F.length("x"), "ny": F.length("y")})
    link = F.levenshtein("x", "y") <= F.floor(F.greatest("nx", "ny") * 0.1 + 1e-9)
    head = lambda c: F.col(c) if held is None else F.left(c, F.lit(held))
    got = pairs.select(link.alias("link"), line_dedup._heads_allow(head("x"), head("y"), F.col("nx"), F.col("ny"), 0.9, held).alias("allowed"))
    counts = {(r.link, r.allowed): r["count"] for r in got.groupBy("link", "allowed").count().collect()}
    assert not counts.get((True, False)) and counts[(True, True)] >= 100 and counts[(False, False)] >= 200


def test_beginnings_spare_pairs_of_lines_that_share_common_words(spark, monkeypatch):
    """Different lines with common words meet under keys; their beginnings spare pairs of them, the same ones however a key is cut, and no copy is lost."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(4, 8)))
    rows = []
    for i in range(60):
        base = rng.sample([w for _ in range(20) for w in (word(), "of the", "and that")], 60)
        rows += [(2 * i, " ".join(base), "s", "", ""), (2 * i + 1, " ".join([*base[:30], word(), *base[31:]]), "s", "", "")]
    made, plain = [], line_dedup._compared
    monkeypatch.setattr(line_dedup, "_compared", lambda texts, pairs, similarity: made.append(pairs.count()) or plain(texts, pairs, similarity))
    docs = spark.createDataFrame(rows, SCHEMA)
    done = lambda: sorted((r.doc_id, r.removed) for r in line_dedup.dedup_lines(docs).collect())
    whole = done()
    assert [r for _, r in whole] == [[], [0]] * 60
    for name, value in (("MANY", 3), ("BLOCK", 7)):
        monkeypatch.setattr(line_dedup, name, value)
    assert done() == whole and made[3] == made[1]
    monkeypatch.setattr(line_dedup, "_heads_allow", lambda *rest: F.lit(True))
    assert done() == whole and made[5] > 1.4 * made[1]


def test_texts_are_normalised_once(spark, monkeypatch):
    seen, plain = [], line_dedup.normalise
    monkeypatch.setattr(line_dedup, "normalise", lambda line: seen.append(1) or plain(line))
    rows = [(i, f"one line of a few words, number {i % 3}\nanother line that is number {i} of all of them", "s", "", "") for i in range(9)]
    done = line_dedup.dedup_lines(spark.createDataFrame(rows, SCHEMA))
    assert sum(len(r.removed) for r in done.collect()) > 6 and len(seen) == 1


def test_line_hash_is_the_majority(spark):
    text = "The quick brown fox jumps over seven sleeping dogs, seven times a night"
    row = line_dedup.line_table(spark.createDataFrame([(1, text)], "doc_id long, text string"), 4).first()
    voters = [w for w in re.findall("[a-z]+", text.lower()) if len(w) >= line_dedup.LONG]
    hashes = [r.h for r in spark.createDataFrame([(w,) for w in voters], "w string").select(F.xxhash64("w").alias("h")).collect()]
    want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert row.sim & (2**64 - 1) == want and len(hashes) == 8
    short = line_dedup.line_table(spark.createDataFrame([(1, "to be or not to be")], "doc_id long, text string"), 4).first()
    assert short.sim == short.k1


def edit_distance(x, y):
    row = list(range(len(y) + 1))
    for i, c in enumerate(x, 1):
        last, row[0] = row[0], i
        for j, d in enumerate(y, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (c != d))
    return row[-1]


def line_pairs(sizes, each, seed=11):
    """Lines and copies with a tenth of the words replaced (one letter if that is under one word): similarity 0.9 and more."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.choice([2, 3, 4, 5, 6, 7, 9]))) for _ in range(3000)]
    pairs = []
    while len(pairs) < len(sizes) * each:
        n = sizes[len(pairs) // each]
        base = [rng.choice(words) for _ in range(n)]
        own = list(base)
        for at in rng.sample(range(n), max(1, n // 10)):
            own[at] = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in own[at]) if n >= 10 else own[at][:-1] + "0"
        x, y = " ".join(base), " ".join(own)
        if 0 < 10 * edit_distance(x, y) <= max(len(x), len(y)):
            pairs.append((n, x, y))
    return pairs


def removed_share(spark, pairs):
    rows = [(2 * i + k, (x, y)[k], "s", "", "") for i, (_, x, y) in enumerate(pairs) for k in (0, 1)]
    got = {r.doc_id: r for r in line_dedup.dedup_lines(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(got[2 * i].removed == [] for i in range(len(pairs)))
    return sum(got[2 * i + 1].removed == [0] for i in range(len(pairs))) / len(pairs)


def test_lines_with_a_tenth_of_the_words_replaced_meet(spark):
    pairs = line_pairs((11, 15, 25, 35, 59), 20)
    assert removed_share(spark, pairs) >= 0.95


def test_lines_at_the_bound_and_short_lines_meet(spark):
    assert removed_share(spark, line_pairs((5, 7, 10, 20, 30, 40, 60), 20)) >= 0.95


def test_lines_of_one_template_meet_their_copies(spark):
    """160 pairs share 17 long words; each has 22 short ones of its own, of which up to 7 are replaced in the copy."""
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    template = [word(rng.randrange(8, 13)) for _ in range(17)]
    pairs = []
    while len(pairs) < 160:
        own = [word(rng.randrange(2, 5)) for _ in range(22)]
        copy = list(own)
        for at in rng.sample(range(22), 7):
            copy[at] = word(len(own[at]))
        x, y = (" ".join(w for pair in zip([*template, *[""] * 5], words, strict=True) for w in pair if w) for words in (own, copy))
        if 10 * edit_distance(x, y) <= max(len(x), len(y)):
            pairs.append((39, x, y))
    assert removed_share(spark, pairs) >= 0.9


def test_a_very_long_line_meets_its_copy(spark):
    rng = random.Random(8)
    words = [f"word{rng.randrange(900)}" for _ in range(4000)]  # more characters than a whole number of 32 bits holds millionths
    rows = [(1, " ".join(words), "s", "", ""), (2, " ".join([*words[:-3], "end"]), "s", "", "")]
    assert {r.doc_id: r.removed for r in line_dedup.dedup_lines(spark.createDataFrame(rows, SCHEMA)).collect()} == {1: [], 2: [0]}


def test_lines_without_blanks(spark):
    rng = random.Random(3)
    line = "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(40))
    near = line[:20] + "\u4e00\u4e01" + line[22:]
    far = "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(40))
    rows = [(i, t, "s", "", "") for i, t in enumerate((line, line, near, far, "two words", "two words"))]
    got = {r.doc_id: r.removed for r in line_dedup.dedup_lines(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {0: [], 1: [0], 2: [0], 3: [], 4: [], 5: []}


def plain_targets(sizes, weights, share, most):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, full, target = share * sum(sizes.values()), set(), {}
    while True:
        level = left / sum(w[s] for s in order if s not in full) if len(full) < len(order) else 0
        over = [s for s in order if s not in full and level * w[s] > most * sizes[s]]
        if not over:
            return target | {s: level * w[s] for s in order if s not in full}
        for s in over:
            full.add(s)
            target[s] = most * sizes[s]
            left -= most * sizes[s]


def mixed_rows():
    rng = random.Random(9)
    rows = [(i, "w " * rng.choice([0, 3, 40, 700, 5000]), rng.choice(["a", "a", "a", "b", "B", "é", "zz", None, "c"]), "", "") for i in range(150)]
    return rows + [(500, None, "a", "", ""), (501, "same text here", "b", "", ""), (501, "same text here", "b", "", ""), (None, "x y", "only", "", ""), (502, "", "nothing", "", "")]


def test_mix_meets_its_targets(spark):
    rows = mixed_rows()
    df = spark.createDataFrame(rows, SCHEMA)
    got = mixing.mix(df, block=256, shards=7).collect()
    sizes, taken = {}, {}
    for _, text, source, *_ in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    want = plain_targets(sizes, (5, 2, 1), 1.5, 2)
    shards, cells = {}, {}
    for r in got:
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source]
        taken[r.source] = taken.get(r.source, 0) + sum(p.words for p in r.pieces)
        for turn in (0, 1):  # the pieces of a pass are disjoint parts of the document
            spans = sorted((p.start, p.start + p.words) for p in r.pieces if p["pass"] == turn)
            assert all(0 <= a < b <= r.size for a, b in spans) and all(x[1] <= y[0] for x, y in zip(spans, spans[1:], strict=False))
        for p in r.pieces:
            shards[p.shard] = shards.get(p.shard, 0) + p.words
            cells.setdefault(r.source, set()).add(p.shard)
    assert len(got) == len(rows)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 2 + sizes[s] / 256
    assert set(shards) == set(range(7)) and max(shards.values()) < 1.2 * min(shards.values())
    key = lambda r: (str(r.doc_id), r.size, str(r.pieces))
    assert sorted(map(key, mixing.mix(df.repartition(5), block=256, shards=7).collect())) == sorted(map(key, got))
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).collect() == []


def test_splitting_tree_is_hypergeometric(spark):
    u = spark.range(4000).select(mixing._uniform(F.lit(1), F.col("id")).alias("u"))
    good, bad, n = 30, 50, 25
    drawn = [r.x for r in u.select(mixing._hypergeometric(F.col("u"), *[F.lit(v).cast("long") for v in (good, bad, n)]).alias("x")).collect()]
    chance = np.array([math.comb(good, k) * math.comb(bad, n - k) / math.comb(good + bad, n) for k in range(n + 1)])
    seen = np.bincount(drawn, minlength=n + 1)
    big = chance * 4000 > 5
    assert ((seen - 4000 * chance)[big] ** 2 / (4000 * chance)[big]).sum() < 2.5 * big.sum()
    quotas = spark.createDataFrame([(0, 1000), (1, 0), (2, 333), (3, 1)], "source_no int, quota long")
    cuts = mixing.split_quotas(quotas, 5, 3).collect()
    for source, quota in ((0, 1000), (1, 0), (2, 333), (3, 1)):
        own = sorted((c.shard, c.begin, c.end) for c in cuts if c.source_no == source)
        assert [o[0] for o in own] == list(range(5)) and own[0][1] == 0 and own[-1][2] == quota
        assert all(x[2] == y[1] for x, y in zip(own, own[1:], strict=False))
    per_shard = {}
    for c in cuts:
        per_shard[c.shard] = per_shard.get(c.shard, 0) + c.end - c.begin
    assert max(per_shard.values()) - min(per_shard.values()) <= 1


def test_permutation_is_a_bijection(spark):
    for n in (1, 2, 7, 1000):
        got = spark.range(n).select(mixing._permuted(F.col("id"), F.lit(n).cast("long"), F.lit(5)).alias("p")).collect()
        assert sorted(r.p for r in got) == list(range(n))


def test_pipeline_joins_at_four_fifths_of_five_words(spark):
    import corpus_pipeline as P

    rows = []
    for i, n in enumerate((13, 12)):  # 9 and 8 shingles of five words, of which the last one differs: 8 of 10 and 7 of 9
        words = [f"w{i}x{j}" for j in range(n)]
        rows += [(2 * i, " ".join(words), "en", "s", 1), (2 * i + 1, " ".join([*words[:-1], "other"]), "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r.doc_id for r in P.join_ngrams(spark, docs, "").collect()) == [0, 2, 3]


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline as P

    rng = random.Random(6)
    words = ["the", "and", "with", "that", "were", "from", "have", "this", "they", "which", "their", "there", "would", "about", "could", "other", "after"]
    german = ["und", "der", "die", "nicht", "auch", "sich", "ein", "werden", "durch", "schon", "wird", "haben"]
    line = lambda w: " ".join(rng.choice(w) + rng.choice(["", "s", "er", "ing"]) for _ in range(12))
    rows = [(i, "\n".join(line(german if i % 3 == 0 else words) for _ in range(4)), "de" if i % 3 == 0 else "en", f"s{i % 4}", 7) for i in range(60)]
    rows += [(100, rows[1][1], "en", "s1", 7), (101, "!!! 12", None, "s1", 7), (102, None, "en", "s1", 7), (103, rows[2][1] + "\n" + line(words), None, "s2", 7), (None, line(words), "en", None, 7)]
    folder = str(tmp_path / "sf")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    docs, results = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in P.STAGES:
        docs = P.store(stage(spark, docs, folder), name)
        results.append(docs)
        if name != P.STAGES[-1][0]:
            assert tuple(docs.columns) == P.COLUMNS
    ids = [sorted(str(r.doc_id) for r in d.collect()) for d in results]
    given = {str(r[0]) for r in rows}
    assert set(ids[0]) == given - {"101", "102"}  # no letter, no text
    assert set(ids[1]) == set(ids[0]) - {"100"}  # every line of it stood before
    assert set(ids[2]) <= set(ids[1]) and len(ids[2]) == len(ids[1])
    filled = {r.doc_id: r for r in results[0].collect()}
    assert filled[103].lang in ("de", "en")
    left = {r.doc_id: r for r in results[1].collect()}
    assert left[103].text == rows[63][1].split("\n")[-1] and left[103].n_chars == len(left[103].text)
    sizes = {str(r.doc_id): len(re.findall(WORD, r.text)) for r in results[2].collect()}
    mixed = results[3].collect()
    assert all(r.text.split() and len(r.text.split()) <= sizes[str(r.doc_id)] for r in mixed)
    assert abs(sum(len(r.text.split()) for r in mixed) - 1.5 * sum(sizes.values())) < 0.02 * sum(sizes.values()) + 10
    assert len(ids[4]) == len(mixed) and all(len(r.ids) == r.n_tokens > 0 for r in results[4].collect())
