"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histora.llm.common import Scratch


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b) that is not a root itself; the root is the smallest reachable node.

    Each step takes one aggregate that combines before its exchange and one join on the same key. The aggregate is stored
    first, so the join has exchanges of its own, and a node with very many links is split like any hot key. Rounds grow
    with the logarithm of the longest path. Only the last table of links stays in the shared folder.
    """
    scratch = Scratch(links.sparkSession)
    e = links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    e, before = scratch.save(e.distinct(), "links"), None
    while True:
        state = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == before or not state[0]:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = scratch.save(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "low")
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = scratch.save(large, "large")
        low = scratch.save(large.groupBy("a").agg(F.min("b").alias("m")), "low")
        small = large.join(low, "a")
        small = small.select("a", F.col("m").alias("b")).union(small.select(F.col("b").alias("a"), F.col("m").alias("b")))
        e = scratch.save(small.where("a != b").distinct(), "links")
        scratch.drop("low", "large")
