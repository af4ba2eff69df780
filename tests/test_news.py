"""News operators against brute force and hand-made texts."""

import glob
import math
import os
import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from candlewick.functions import vocabulary as voc
from candlewick.operators import news
from candlewick.operators.graph import components
from candlewick.operators.machines import Covers
from candlewick.plans.news import articles, headlines


def greedy(items, similar):
    """First-come clusters by definition: every item against every earlier leader."""
    leaders, out = [], {}
    for i in items:
        hit = next((l for l in leaders if similar(l, i)), None)
        if hit is None:
            leaders.append(i)
            hit = i
        out[i["id"]] = hit["id"]
    return out


def tokens(text):
    same = voc.SYNONYMS
    return [same.get(w, w) for w in re.findall("[a-z]{3,}", text.lower()) if w not in voc.STOP_WORDS]


@pytest.mark.parametrize("head", [2048, 5])
def test_semantic_clusters_match_brute_force(spark, sf, head, monkeypatch):
    monkeypatch.setattr(news, "HEAD", head)
    docs = articles(spark, sf).select("id", "text", "ts").filter("id < 60")
    more = docs.filter("id % 7 = 0").select((F.col("id") + 1000).alias("id"), "text", (F.col("ts") + F.expr("INTERVAL 1 DAY")).alias("ts"))
    docs = docs.unionByName(more)
    rows = sorted(docs.collect(), key=lambda r: (r.ts, r.id))
    bags = {r.id: Counter(tokens(r.text)) for r in rows}
    df = Counter(w for b in bags.values() for w in b)
    n = len(rows)
    vec = {i: {w: c / sum(b.values()) * (math.log((n + 1) / (df[w] + 1)) + 1) for w, c in b.items()} for i, b in bags.items()}
    norm = {i: math.sqrt(sum(x * x for x in v.values())) for i, v in vec.items()}
    for threshold in (0.25, 0.6):
        def similar(a, b):
            x, y = vec[a["id"]], vec[b["id"]]
            return norm[a["id"]] * norm[b["id"]] > 0 and sum(x[k] * y[k] for k in x.keys() & y.keys()) / (norm[a["id"]] * norm[b["id"]]) >= threshold
        got = {r.id: r.leader for r in news.cluster_semantic(docs, "id", "text", "ts", threshold).collect()}
        assert got == greedy([{"id": r.id} for r in rows], similar)


@pytest.mark.parametrize("small", [20_000, 0])
def test_story_clusters_match_brute_force(spark, sf, small, monkeypatch):
    monkeypatch.setattr(news, "SMALL", small)
    h = headlines(spark, sf).filter("id < 500").withColumn("ts", F.expr("TIMESTAMP '2024-01-01' + make_dt_interval(0, 0, cast(id * 37 as int))"))
    rows = sorted(h.collect(), key=lambda r: (r.ts, r.id))
    bag = {r.id: {w for w in re.findall(r"\w+", r.text.lower()) if len(w) > 2} for r in rows}
    at = {r.id: r for r in rows}

    for threshold in (0.25, 0.8):
        def similar(a, b):
            x, y = bag[a["id"]], bag[b["id"]]
            if abs((at[a["id"]].ts - at[b["id"]].ts).total_seconds()) > 86400:
                return False
            t = threshold * 0.8 if at[a["id"]].category == at[b["id"]].category else threshold
            return bool(x | y) and len(x & y) / len(x | y) >= t
        got = {r.id: r.leader for r in news.cluster_stories(h, "id", "text", "ts", "category", threshold).collect()}
        assert got == greedy([{"id": r.id} for r in rows], similar)


def test_a_mass_of_copies_is_one_story_per_day(spark):
    copies = spark.range(5000).select("id", F.lit("Central bank raises rates again").alias("text"), F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 60).alias("ts"), F.lit("ECO").alias("category"))
    got = news.cluster_stories(copies, "id", "text", "ts", "category").groupBy("leader").count().orderBy("leader").collect()
    assert [(r.leader, r["count"]) for r in got] == [(0, 1441), (1441, 1441), (2882, 1441), (4323, 677)]


def test_years_of_copies_take_no_round_a_day(spark, monkeypatch):
    monkeypatch.setattr(news, "_lead_in_rounds", None)
    days = spark.range(600).select("id", F.lit("Daily fixing report").alias("text"), F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 50_000).alias("ts"), F.lit("ECO").alias("category"))
    got = {r.id: r.leader for r in news.cluster_stories(days, "id", "text", "ts", "category").collect()}
    assert got == {i: i // 2 * 2 for i in range(600)}


def test_covers_in_pieces():
    rng = np.random.default_rng(2)
    for window in (3, 40, 1000):
        t = np.sort(rng.integers(0, 2000, 300)).tolist()
        machine = Covers(window, lambda p: p["ts"].tolist())
        last, want = -1e9, []
        for x in t:
            last = x if x > last + window else last
            want.append(last)
        cuts = [0, 1, 2, 40, 41, 130, 131, 260, 300]
        sums = [machine.summarize(pd.DataFrame({"ts": t[a:b]})) for a, b in zip(cuts, cuts[1:])]
        state = None
        for s, end in zip(sums, cuts[1:]):
            state = machine.advance(s, state)
            assert state == [want[end - 1]]
        whole = machine.compose(machine.compose(sums[1], sums[2]), machine.compose(sums[3], machine.compose(sums[4], sums[5])))
        assert machine.advance(whole, [want[0]]) == [want[130]]


def test_components(spark):
    rng = np.random.default_rng(1)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(i, i + 1) for i in range(1000, 1060)] + [(5, 5)]
    root = {}

    def top(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if a != b:
            root[top(a)] = top(b)
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    groups = lambda of: sorted(sorted(n for n in of if of[n] == r) for r in set(of.values()))
    assert groups(got) == groups({n: top(n) for n in root})


def one(spark, text):
    return spark.range(1).select(F.lit(text).alias("text"))


def test_entities(spark):
    r = news.extract_entities(one(spark, "Jerome Powell meets president Anna Berg in South Korea; NATO and the Fed watch AAPL, CEO and the truck from Thailand"), "text").first()
    assert r.countries == ["KR", "TH"]
    assert "NATO" in r.organisations and "Federal Reserve" in r.organisations
    assert r.people == ["Jerome Powell", "Anna Berg"]
    assert r.tickers == ["NATO", "AAPL"]


@pytest.mark.parametrize("text,label,score", [
    ("Shares surge on record high profit", "BULLISH", 1.0), ("Crash and fraud as growth fails", "BEARISH", round((2 - 7) / 9, 3)), ("Nothing to report", "NEUTRAL", 0.0),
])
def test_sentiment(spark, text, label, score):
    r = news.sentiment(one(spark, text), "text").first()
    assert (r.sentiment, r.score) == (label, score)


@pytest.mark.parametrize("text,value", [
    ("for $3.5 billion in cash", 3.5e9), ("valued at $ 250 million", 2.5e8), ("aggregate purchase price of $ 1,250,000", 1_250_000.0),
    ("consideration of $ 1,500", 1_500e6), ("a purchase price of $ 12", 12e9), ("no value", None),
])
def test_deal_value(spark, text, value):
    assert one(spark, text).select(news.deal_value(F.col("text"))).first()[0] == value


def test_monitors_match_whole_words(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 'Oil price up'), (2, 'Turmoil grows'), (3, 'C++ (and more)') AS t(id, text)")
    got = {(r.id, r.monitor) for r in news.scan_monitors(df, "text", {"energy": ["oil"], "code": ["(and"], "off": []}).collect()}
    assert got == {(1, "energy")}


@pytest.mark.parametrize("piece, shared", [(70, 4_000_000), (31, 50)])
def test_stories_in_pieces_of_time(spark, sf, monkeypatch, piece, shared):
    """Pieces walked at once are right as soon as the leaders before them are; no pairs are listed, and articles without a time lead themselves."""
    monkeypatch.setattr(news, "SMALL", 0)
    monkeypatch.setattr(news, "PIECE", piece)
    monkeypatch.setattr(news, "BATCH", 7)
    monkeypatch.setattr(news, "SHARED", shared)
    h = headlines(spark, sf).filter("id < 300").withColumn("ts", F.expr("TIMESTAMP '2024-01-01' + make_dt_interval(cast(id / 40 as int), 0, cast(id % 3 * 40000 as int))"))
    none = h.orderBy("id").limit(2).select((F.col("id") + 10_000).alias("id"), F.lit(None).cast("string").alias("text"), "source", F.lit(None).cast("string").alias("category"), F.lit(None).cast("timestamp").alias("ts"), "region")
    rows = sorted(h.collect(), key=lambda r: (r.ts, r.id))
    bag = {r.id: {w for w in re.findall(r"\w+", r.text.lower()) if len(w) > 2} for r in rows}
    at = {r.id: r for r in rows}

    def similar(a, b):
        a, b = a["id"], b["id"]
        if abs((at[a].ts - at[b].ts).total_seconds()) > 86400:
            return False
        return len(bag[a] & bag[b]) / len(bag[a] | bag[b]) >= (0.2 if at[a].category == at[b].category else 0.25)

    got = {r.id: r.leader for r in news.cluster_stories(h.unionByName(none), "id", "text", "ts", "category").collect()}
    assert got == greedy([{"id": r.id} for r in rows], similar) | {r.id: r.id for r in none.collect()}


def test_a_past_that_reaches_on_takes_no_round_a_piece(spark, monkeypatch):
    """Walked without what lies before them, pieces of such a chain never agree with each other: they are walked in a row, and leaders are looked up piece by piece."""
    monkeypatch.setattr(news, "SMALL", 0)
    monkeypatch.setattr(news, "PIECE", 5)
    days = spark.range(75).select("id", F.lit("Daily fixing report").alias("text"), F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 50_000).alias("ts"), F.lit("ECO").alias("category"))
    known = set(glob.glob(f"{news.checkpoint_folder(spark)}/candlewick-*"))
    led = news.cluster_stories(days, "id", "text", "ts", "category")
    assert {r.id: r.leader for r in led.collect()} == {i: i // 2 * 2 for i in range(75)}
    written = [p for f in set(glob.glob(f"{news.checkpoint_folder(spark)}/candlewick-*")) - known for p in os.listdir(f.removeprefix("file:")) if p.startswith("ro") and p != "rows"]
    assert 2 <= len(written) <= 4
    assert led.rdd.getNumPartitions() >= 15


def test_rounds_of_topics_do_not_write_the_open_vectors(spark, monkeypatch):
    """Texts that have nothing in common lead one by one: what the rounds write stays in proportion to the vectors."""
    rare = lambda i: " ".join("".join(chr(97 + (i * 40 + k) // 26**p % 26) for p in range(4)) for k in range(40))
    docs = spark.createDataFrame([(i, rare(i)) for i in range(240)], "id long, text string").withColumn("ts", F.timestamp_seconds(F.col("id")))
    size = lambda p: sum(os.path.getsize(os.path.join(at, f)) for at, _, files in os.walk(p) for f in files if f.startswith("part-"))
    folder = news.checkpoint_folder(spark).removeprefix("file:")

    def written(head):
        monkeypatch.setattr(news, "HEAD", head)
        before = size(folder)
        assert {r.id: r.leader for r in news.cluster_semantic(docs, "id", "text", "ts").collect()} == {i: i for i in range(240)}
        return size(folder) - before

    assert written(16) < 3 * written(240)
