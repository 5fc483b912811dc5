"""Connected components of a graph of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plaza.llm.common import Scratch


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node that can be reached, for every node of a link.

    Each round hangs every node's larger neighbours on its smallest one, then its smaller neighbours
    likewise, until nothing changes: about log(n) rounds. Minima are summed up per task before they
    are shuffled and the joins may be split, so a node with most of the links is no bottleneck. Links
    of a node with itself and NULL ends link nothing; repeated links count once; nodes may be of any
    type with an order. Without links the result is empty.
    """
    spark = links.sparkSession
    scratch = Scratch(spark)
    edges = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a > b").distinct()
    edges, label, before = scratch.write(edges, "links-0"), "links-0", None
    if edges.isEmpty():
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    for number in range(1, 200):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        down = large.filter("a > b").distinct()
        lowest = down.groupBy("a").agg(F.min("b").alias("m"))
        moved = down.join(lowest, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = moved.union(lowest.select("a", F.col("m").alias("b"))).distinct()
        edges = scratch.write(small, f"links-{number}")
        scratch.drop(label)
        label = f"links-{number}"
        # A sum over hashes and their number tell whether the set of links is the same as before.
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("the components still change after 199 rounds")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
