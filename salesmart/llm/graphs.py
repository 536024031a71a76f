"""Connected components over written edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from salesmart.storage import Scratch


def components(edges: DataFrame, scratch: Scratch, most_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); a component is named by its smallest node.

    Alternates large-star and small-star steps: each node hands its larger, then its smaller neighbours to
    the smallest node it knows, until nothing changes; the rounds grow with the logarithm of the
    longest path. Every step groups edges by node, with partial minima before the shuffle, and is
    written, so no lineage builds up. Nulls and loops are left out.
    """
    pairs = edges.where((F.col("a") != F.col("b")) & F.col("a").isNotNull() & F.col("b").isNotNull())
    pairs = scratch.table(pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    for _ in range(most_rounds):
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("_least")).withColumn("_least", F.least("_least", "a"))
        large = both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("_least").alias("b"))
        large = scratch.table(large.where(F.col("a") != F.col("b")).distinct(), "large")
        small_least = large.groupBy("a").agg(F.min("b").alias("_least"))
        small = large.join(small_least, "a")
        small = small.select(F.explode(F.array(F.struct("a", F.col("_least").alias("b")), F.struct(F.col("b").alias("a"), F.col("_least").alias("b")))).alias("e"))
        after = scratch.table(small.select("e.*").where(F.col("a") != F.col("b")).distinct(), "small")
        # a forest of stars repeats itself: every node has one edge and no root has one
        moved = after.exceptAll(pairs).limit(1).count() or after.count() != pairs.count()
        pairs = after
        if not moved:
            break
    else:
        raise RuntimeError("components did not settle")
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        pairs.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
