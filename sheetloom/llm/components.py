"""Connected components by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetloom.sources.staging import stage


def connected_components(edges: DataFrame) -> DataFrame:
    """``a, b`` (longs, any order) -> ``node, root``: each linked node's smallest reachable node.

    Every round hangs neighbours under the smallest node in sight, first for larger
    and then for smaller neighbours, until nothing changes: a number of rounds that
    grows with the logarithm of the longest chain.  Rounds are written to the shared
    folder.  Minima combine before the shuffle; a hub's edges are only joined with
    one row, where Spark splits skewed partitions.
    """
    current = stage(edges.filter("a <> b").distinct(), "edges")
    seen = None
    while True:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
        down = stage(down, "edges")
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        current = stage(small.filter("a <> b").distinct(), "edges")
        sums = tuple(current.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first())
        if sums == seen:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = sums
