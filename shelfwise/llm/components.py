"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfwise.llm.common import cut


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link neighbours to the smallest node next to (or equal to) their own: the larger neighbours, or all others."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    if not large:
        both = both.filter("v < u")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
    joined = both.join(least, F.col("u") == F.col("w"))
    if large:
        out = joined.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionAll(least.select(F.col("w").alias("a"), F.col("m").alias("b")))
    return out.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """Component of every node that has an edge: node, component (the smallest node that it is linked with).

    edges has two long columns, a and b; their order and repetitions don't matter, loops and nulls are left out. Large
    and small stars alternate until nothing changes; every node then hangs on the smallest of its component. The number
    of rounds grows with the logarithm of the size of a component, and every round goes to the shared checkpoint folder.
    """
    current = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct())
    state = None
    while True:
        seen = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == state or not seen[0]:
            break
        state = seen
        current = cut(_star(_star(current, large=True), large=False))
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
        current.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
