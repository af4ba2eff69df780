"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree (DataFrame functions only).

Every source's words, its documents in hashed order, form one line that is cut into blocks of equal length. The target of a
source is a quota of blocks: whole passes over the line first, then blocks drawn without replacement by a keyed permutation of the
block numbers, the last of them in part. A binary tree divides the quotas of all sources among the output shards: a node
with N blocks gives n of them to its left half, the count of each source drawn from the hypergeometric law given what the
sources before it have got. A shard then takes the next blocks of each source's permuted sequence, so shards are disjoint, and
orders its pieces by a hash.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.llm.common import let, n_words, store

ROUNDS = 24  # of the swap-or-not permutation
TAIL = 9.0  # standard deviations of a hypergeometric draw; beyond them lies less than a double resolves


def _uniform(*parts: Column) -> Column:
    """A number in (0, 1) from a hash."""
    return (F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") + 0.5) * F.lit(2.0**-53)


def targets(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """``source, source_size`` -> with ``target``: ``share`` of all words dealt by weight, at most ``most`` times a source's size.

    Sources in code point order, null last, take the weights in turn. What a full source cannot take is dealt again: with
    sources sorted by capacity per weight, the full ones are a prefix, found with running sums over one row per source.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    ranked = sizes.withColumn("_n", F.row_number().over(order) - 1)
    values = F.array(*[F.lit(float(w)) for w in weights])
    ranked = ranked.withColumn("_w", F.get(values, F.col("_n") % len(weights))).withColumn("_cap", F.col("source_size") * F.lit(float(most)))
    by_room = Window.orderBy(F.col("_cap") / F.col("_w"), "_n")
    whole = Window.partitionBy()
    ranked = (
        ranked.withColumn("_total", F.sum("source_size").over(whole) * F.lit(float(share)))
        .withColumn("_before", F.sum("_cap").over(by_room) - F.col("_cap"))
        .withColumn("_weights", F.sum("_w").over(whole) - F.sum("_w").over(by_room) + F.col("_w"))
        .withColumn("_level", (F.col("_total") - F.col("_before")) / F.col("_weights"))
        .withColumn("_open", F.min(F.when(F.col("_level") * F.col("_w") <= F.col("_cap"), F.struct(F.col("_cap") / F.col("_w"), F.col("_n"), F.col("_level")))).over(whole))
    )
    level = F.coalesce(F.col("_open")["_level"], F.lit(float("inf")))
    return ranked.select("source", "source_size", F.least(F.col("_cap"), level * F.col("_w")).alias("target"), F.col("_n").alias("source_no"))


def _hypergeometric(u: Column, good: Column, bad: Column, n: Column) -> Column:
    """Number of good ones among ``n`` of ``good + bad``, by inversion: outcomes from the mode up, then from the mode down.

    The ratios of neighbouring probabilities are multiplied up from the mode; weights beyond ``TAIL`` deviations are below
    what a double resolves, so the draw is exact to rounding.
    """
    total = (good + bad).cast("double")
    low, high = F.greatest(F.lit(0).cast("long"), n - bad), F.least(n, good)
    mode = F.floor((n + 1) * ((good + 1).cast("double") / (total + 2))).cast("long")
    mode = F.least(high, F.greatest(low, mode))
    spread = F.sqrt(n * (good / total) * (bad / total) * (F.greatest(total - n, F.lit(0.0)) / F.greatest(total - 1, F.lit(1.0)))) * TAIL + 12
    climb = lambda w, x: w * (good - x + 1) * (n - x + 1) / (x.cast("double") * (bad - n + x))  # noqa: E731  weight of x from x - 1
    descend = lambda w, x: w * (x + 1) * (bad - n + x + 1) / ((good - x).cast("double") * (n - x))  # noqa: E731  from x + 1

    def walk(xs: Column, step, start: Column, goal: Column) -> Column:
        """Weights of ``xs`` summed up, and the outcome at which the sum reaches the goal."""

        def add(acc: Column, x: Column) -> Column:
            return let(step(acc["w"], x), lambda w: F.struct(w.alias("w"), (acc["sum"] + w).alias("sum"), F.when(acc["sum"] < goal, x).otherwise(acc["at"]).alias("at")))

        return F.aggregate(xs, F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum"), start.alias("at")), add)

    def draw(r: Column) -> Column:
        none = F.array().cast("array<bigint>")
        above = F.when(r["up"] > r["mode"], F.sequence(r["mode"] + 1, r["up"])).otherwise(none)
        below = F.when(r["down"] < r["mode"], F.sequence(r["mode"] - 1, r["down"], F.lit(-1).cast("long"))).otherwise(none)
        sums = F.struct(walk(above, climb, r["mode"], F.lit(0.0))["sum"].alias("over"), walk(below, descend, r["mode"], F.lit(0.0))["sum"].alias("under"))

        def pick(s: Column) -> Column:
            def reach(goal: Column) -> Column:
                up_there = walk(above, climb, r["mode"], goal - 1)["at"]
                down_there = walk(below, descend, r["mode"], goal - 1 - s["over"])["at"]
                return F.when(goal <= 1, r["mode"]).when(goal <= 1 + s["over"], up_there).otherwise(down_there)

            return let(u * (F.lit(1.0) + s["over"] + s["under"]), reach)

        return let(sums, pick)

    edges = let(F.struct(mode.alias("mode"), spread.alias("spread"), low.alias("low"), high.alias("high")), lambda m: F.struct(
        m["mode"].alias("mode"), F.greatest(m["low"], m["mode"] - F.ceil(m["spread"])).alias("down"), F.least(m["high"], m["mode"] + F.ceil(m["spread"])).alias("up"),
    ))
    return F.when((n <= 0) | (good <= 0), F.lit(0).cast("long")).otherwise(let(edges, draw))


def split_quotas(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """``source_no, quota`` -> ``source_no, shard, begin, end``: positions of each source's drawn sequence that a shard takes.

    One row per tree node and source; a level splits every node in two. The sources of a node are drawn one after the other,
    each given the draws before it; the first of a node need no other node, so a level is one grouping.
    """
    nodes = quotas.select(F.lit(0).alias("lo"), F.lit(shards).alias("hi"), "source_no", F.col("quota").alias("q"))
    entry = "array<struct<source_no:int,q:bigint>>"
    nodes = nodes.groupBy("lo", "hi").agg(F.array_sort(F.collect_list(F.struct(F.col("source_no").cast("int").alias("source_no"), "q"))).cast(entry).alias("all"))
    for _ in range(math.ceil(math.log2(shards)) if shards > 1 else 0):
        total = F.aggregate("all", F.lit(0).cast("long"), lambda a, s: a + s["q"])
        mid = F.col("lo") + F.floor((F.col("hi") - F.col("lo")) / 2).cast("int")
        nodes = nodes.withColumn("total", total).withColumn("mid", mid)
        # shards of a node get equal numbers of blocks, the first ones the odd blocks
        wide = (F.col("hi") - F.col("lo")).cast("long")
        left = F.floor(F.col("total") / wide).cast("long") * (F.col("mid") - F.col("lo")) + F.least(F.col("total") % wide, (F.col("mid") - F.col("lo")).cast("long"))
        nodes = nodes.withColumn("left", left)

        def draw(acc: Column, s: Column) -> Column:
            u = _uniform(F.lit(seed), F.col("lo"), F.col("hi"), s["source_no"])
            x = _hypergeometric(u, s["q"], acc["rest"] - s["q"], acc["n"])
            return let(x, lambda x: F.struct((acc["rest"] - s["q"]).alias("rest"), (acc["n"] - x).alias("n"), F.concat(acc["got"], F.array(x)).alias("got")))

        got = F.aggregate("all", F.struct(F.col("total").alias("rest"), F.col("left").alias("n"), F.array().cast("array<bigint>").alias("got")), draw)["got"]
        nodes = nodes.withColumn("got", got)
        lefts = F.zip_with("all", "got", lambda s, g: F.struct(s["source_no"].alias("source_no"), g.alias("q")))
        rights = F.zip_with("all", "got", lambda s, g: F.struct(s["source_no"].alias("source_no"), (s["q"] - g).alias("q")))
        whole = F.struct(F.col("lo").alias("lo"), F.col("hi").alias("hi"), F.col("all").cast(entry).alias("all"))
        halves = F.when(wide > 1, F.array(F.struct(F.col("lo").alias("lo"), F.col("mid").alias("hi"), lefts.cast(entry).alias("all")), F.struct(F.col("mid").alias("lo"), F.col("hi").alias("hi"), rights.cast(entry).alias("all")))).otherwise(F.array(whole))
        nodes = store(nodes.select(F.explode(halves).alias("h")).select("h.lo", "h.hi", "h.all"), "nodes")
    leaves = nodes.select(F.col("lo").alias("shard"), F.explode("all").alias("s")).select("shard", "s.source_no", "s.q")
    before = Window.partitionBy("source_no").orderBy("shard")
    return leaves.withColumn("end", F.sum("q").over(before)).select("source_no", "shard", (F.col("end") - F.col("q")).alias("begin"), "end")


def _permuted(x: Column, n: Column, *key: Column) -> Column:
    """Keyed bijection of 0 .. n - 1 computed point by point (swap-or-not shuffle)."""

    def swap(v: Column, r: Column) -> Column:
        partner = F.pmod(F.pmod(F.xxhash64(F.lit(17), r, *key), n) + n - v, n)
        return let(partner, lambda p: F.when(F.xxhash64(r, *key, F.greatest(v, p)) % 2 == 0, p).otherwise(v))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), x, swap)


def mix(
    df: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0, block: int = 1024, shards: int = 16, seed: int = 7,
    doc: str = "doc_id", text: str = "text", source: str = "source", keep_hash: bool = False,
) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, pieces``, and ``text_hash`` (xxhash64) if asked for.

    ``pieces`` lists what the mix takes of the document: shard, pass (0, 1, ...), start word, number of words and the order
    inside the shard. A piece is the part of a drawn block that falls into the document. ``most`` is a whole number of passes
    at least as large as ``share``. Words taken of a source come within one word per block of its target. Null and empty texts have size 0 and no
    pieces; null sources are a source of their own, last; rows that repeat are documents of their own; ids may be null. An
    empty table gives an empty result. All choices are hashes of ``seed``, ids and positions, so reruns agree.

    Word positions need running sums per source: documents fall into hash slices, the slices of a source (some two thousand
    documents each) are summed over one row per slice, and a window runs inside a slice only.
    """
    docs = df.select(F.col(doc).alias("doc_id"), F.col(source).alias("source"), n_words(F.col(text)).alias("size"), F.xxhash64(F.lit(seed), F.col(doc), F.col(text)).alias("_h"), F.xxhash64(F.col(text)).alias("text_hash"))
    docs = store(docs, "sizes")
    sizes = docs.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("_docs"))
    plan = targets(sizes.select("source", "source_size"), weights, share, most)
    plan = plan.withColumn("_n", F.greatest(F.lit(1), F.ceil(F.col("source_size") / block)).cast("long"))
    # in blocks: whole passes, then a part of one more; ``last`` is the share of the last block
    exact = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size") * F.col("_n")).otherwise(0.0)
    plan = plan.withColumn("_exact", F.when(F.abs(exact - F.round(exact)) < 1e-9, F.round(exact)).otherwise(exact)).withColumn("quota", F.ceil("_exact").cast("long"))
    plan = store(plan.withColumn("_last", F.col("_exact") - F.col("quota") + 1), "plan")
    cuts = split_quotas(plan.select("source_no", "quota"), shards, seed)
    cuts = cuts.groupBy("source_no").agg(F.array_sort(F.collect_list(F.struct("shard", "begin", "end"))).alias("cuts"))
    plan = store(plan.join(cuts, "source_no"), "cuts")

    slices = max(1, docs.count() // 2_000)
    placed = docs.withColumn("_slice", F.pmod(F.xxhash64("_h"), F.lit(slices)))
    sums = placed.groupBy("source", "_slice").agg(F.sum("size").alias("_sum"))
    sums = sums.withColumn("_base", F.sum("_sum").over(Window.partitionBy("source").orderBy("_slice")) - F.col("_sum"))
    inside = Window.partitionBy("source", "_slice").orderBy("_h", F.col("doc_id").cast("string"), "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = placed.withColumn("_in", F.sum("size").over(inside) - F.col("size"))
    sums = sums.select(F.col("source").alias("_s"), F.col("_slice").alias("_t"), "_base")
    placed = placed.join(sums, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_slice") == F.col("_t"))).drop("_s", "_t")
    placed = placed.join(plan.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    placed = placed.withColumn("_at", F.col("_base") + F.col("_in"))

    n, all_words = F.col("_n"), F.col("source_size")

    def border(j: Column) -> Column:
        """First word of block j: equal lengths up to one word."""
        rest = F.floor(j.cast("double") * (all_words % n) / n).cast("long")
        return F.when(j >= n, all_words).otherwise(j * F.floor(all_words / n).cast("long") + rest)

    def inside_block(x: Column) -> Column:
        guess = F.least(n - 1, F.floor(x.cast("double") * n / all_words).cast("long"))
        return guess + F.when(border(guess + 1) <= x, 1).when(border(guess) > x, -1).otherwise(0)

    first, final = inside_block(F.col("_at")), inside_block(F.col("_at") + F.col("size") - 1)

    def piece(d: Column) -> Column:
        whole_end = border(d["block"] + 1)
        until = F.when(d["at"] == F.col("quota") - 1, d["start"] + F.round((whole_end - d["start"]) * F.col("_last")).cast("long")).otherwise(whole_end)
        start, end = F.greatest(d["start"], F.col("_at")), F.least(until, F.col("_at") + F.col("size"))
        shard = F.filter("cuts", lambda c: (c["begin"] <= d["at"]) & (d["at"] < c["end"]))[0]["shard"]
        return F.struct(
            shard.alias("shard"), d["pass"].cast("int").alias("pass"), (start - F.col("_at")).alias("start"), (end - start).alias("words"),
            F.xxhash64(F.lit(seed), F.lit(3), d["pass"], d["block"], F.col("source_no")).alias("order"),
        )

    def place(b: Column, turn: Column) -> Column:
        return F.struct(b.alias("block"), turn.alias("pass"), border(b).alias("start"), (turn * n + _permuted(b, n, F.lit(seed), F.col("source_no"), turn)).alias("at"))

    turns = F.sequence(F.lit(0).cast("long"), F.lit(math.ceil(most) - 1).cast("long"))
    places = F.flatten(F.transform(F.sequence(first, final), lambda b: F.transform(turns, lambda t: place(b, t))))
    drawn = F.filter(places, lambda d: d["at"] < F.col("quota"))
    found = F.transform(drawn, piece)
    none = F.array().cast("array<struct<shard:int,pass:int,start:bigint,words:bigint,order:bigint>>")
    pieces = F.when(F.col("size") > 0, F.filter(found, lambda p: p["words"] > 0)).otherwise(none)
    return placed.select("doc_id", "source", "size", "source_size", "target", pieces.alias("pieces"), *["text_hash"] * keep_hash)
