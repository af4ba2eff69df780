"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.session import checkpoint_folder


def components(links: DataFrame) -> DataFrame:
    """``node, root`` of every node of the links ``a, b`` (any order, repeats allowed); the root is some node of the component.

    A node points at its smallest neighbour if that is smaller; pointers are doubled until they end at a local minimum, and the minima are linked
    and pointed anew. At least half of the nodes that still have links go in a round, and doubling takes the logarithm of a chain.
    """
    checkpoint_folder(links.sparkSession)
    edges = links.filter("a <> b").select("a", "b")
    edges = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct().checkpoint()
    known = edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    while not edges.isEmpty():
        up = edges.groupBy("a").agg(F.min("b").alias("p")).select("a", F.least("a", "p").alias("p")).checkpoint()
        while True:
            twice = up.join(up.select(F.col("a").alias("_a"), F.col("p").alias("_p")), F.col("p") == F.col("_a"))
            if twice.filter(F.col("_p") != F.col("p")).isEmpty():
                break
            up = twice.select("a", F.col("_p").alias("p")).checkpoint()
        to = up.select(F.col("a").alias("_a"), F.col("p").alias("_p"))
        known = known.join(to, F.col("root") == F.col("_a"), "left").select("node", F.coalesce("_p", "root").alias("root")).checkpoint()
        left = edges.join(to, F.col("a") == F.col("_a")).select(F.col("_p").alias("x"), "b")
        left = left.join(to, F.col("b") == F.col("_a")).select(F.col("x").alias("a"), F.col("_p").alias("b"))
        edges = left.filter("a <> b").distinct().checkpoint()
    return known
