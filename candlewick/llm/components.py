"""Connected components of a table of links, and links of nodes that meet under keys (DataFrame functions only).

Links are rewritten until every node points at the smallest node of its component: large-star hangs the larger neighbours of a
node under the smallest node of its neighbourhood, small-star the smaller ones. Both keep components and need a number of
rounds that grows with the logarithm of the size. Each step is written to the shared folder, so that joins see plain tables
(a node with very many links is then split by adaptive execution) and nothing is recomputed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.llm.common import store


ROWS = 100_000  # of a step that a task writes


def components(links: DataFrame) -> DataFrame:
    """``a, b`` (any order, repeats allowed) -> ``node, root`` for every node that has a link; ``root`` is the smallest node."""
    hi, lo = F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")
    edges = store(links.where(F.col("a") != F.col("b")).select(hi, lo).distinct(), "links")
    parts = max(1, edges.count() // ROWS)  # the steps never hold more than twice these rows
    keep = lambda df, name: store(df.coalesce(parts), name)
    while not _settled(edges):
        both = edges.unionByName(edges.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        least = keep(both.groupBy(F.col("hi").alias("_n")).agg(F.min("lo").alias("_m")).select("_n", F.least("_n", "_m").alias("_m")), "least")
        hung = both.where(F.col("lo") > F.col("hi")).join(least, F.col("hi") == F.col("_n")).select(F.col("lo").alias("hi"), F.col("_m").alias("lo"))
        edges = keep(hung.distinct(), "large")
        least = keep(edges.groupBy(F.col("hi").alias("_n")).agg(F.min("lo").alias("_m")), "least")
        small = edges.join(least, F.col("hi") == F.col("_n")).where(F.col("lo") != F.col("_m")).select(F.col("lo").alias("hi"), F.col("_m").alias("lo"))
        edges = keep(small.unionByName(least.select(F.col("_n").alias("hi"), F.col("_m").alias("lo"))).distinct(), "small")
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(edges.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())


def _settled(edges: DataFrame) -> bool:
    """Every node hangs under one other that hangs under none: the links are the stars of their components."""
    ends = edges.select(F.col("hi").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(edges.select(F.col("lo").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    nodes = ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not nodes.agg(F.count_if(F.expr("up > 1 OR up = 1 AND down = 1"))).first()[0]


def settle(met: DataFrame, links: DataFrame, verify: Callable[[DataFrame], DataFrame], finish: Callable[[DataFrame], DataFrame], close: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """``node, root`` of every node with a link, without a row for every pair of a key.

    ``met``: ``key, node``; ``links``: ``a, b`` known before; ``verify`` keeps the pairs ``a < b`` that really link. First the nodes
    of a key are compared with the smallest one; keys whose nodes are all in one group by then are done. ``finish`` gets ``key,
    node, root`` of the others and finds the links between nodes of a key that are still in different groups; these links
    then join the groups found before. ``close`` tells from two nodes alone which pairs are worth a look.
    """
    centres = met.groupBy("key").agg(F.min("node").alias("a")).select(F.col("key").alias("_k"), "a")
    pairs = met.join(centres, F.col("key") == F.col("_k")).where("node <> a").select("a", F.col("node").alias("b"))
    pairs = pairs.distinct() if close is None else pairs.where(close(F.col("a"), F.col("b"))).distinct()
    roots = store(components(links.unionByName(verify(store(pairs, "pairs")))), "roots")
    of = roots.select(F.col("node").alias("_n"), F.col("root").alias("_r"))
    met = store(met.join(of, F.col("node") == F.col("_n"), "left").select("key", "node", F.coalesce("_r", "node").alias("root")), "met")
    split = met.groupBy("key").agg(F.min("root").alias("_a"), F.max("root").alias("_b")).where("_a < _b").select(F.col("key").alias("_k"))
    left = store(met.join(split, F.col("key") == F.col("_k")).select("key", "node", "root"), "left")
    found = store(finish(left), "found")
    ends = found.select(F.col("a").alias("node")).unionByName(found.select(F.col("b").alias("node"))).distinct()
    ends = store(ends.join(of, F.col("node") == F.col("_n"), "left").select("node", F.coalesce("_r", "node").alias("root")), "ends")
    first, second = (ends.select(F.col("node").alias(f"_{c}"), F.col("root").alias(f"root_{c}")) for c in "ab")
    joins = found.join(first, F.col("a") == F.col("_a")).join(second, F.col("b") == F.col("_b")).select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))
    tops = store(components(joins), "tops").select(F.col("node").alias("_t"), F.col("root").alias("_top"))
    every = roots.unionByName(ends.join(of, F.col("node") == F.col("_n"), "left_anti").select("node", "root"))
    return every.join(tops, F.col("root") == F.col("_t"), "left").select("node", F.coalesce("_top", "root").alias("root"))


def meetings(rows: DataFrame) -> DataFrame:
    """The rows ``key, node`` whose key has more than one node."""
    by_key = Window.partitionBy("key")
    met = rows.withColumn("_low", F.min("node").over(by_key)).withColumn("_high", F.max("node").over(by_key))
    return store(met.where("_low < _high").select("key", "node"), "met")
