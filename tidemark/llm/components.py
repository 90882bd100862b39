"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch


def _both(edges: DataFrame) -> DataFrame:
    turned = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    return edges.select("a", "b").union(turned)


def _lowest(pairs: DataFrame) -> DataFrame:
    """The lowest neighbour of each node, itself included; reduced before the shuffle."""
    return pairs.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m")).select("n", F.least("n", "m").alias("m"))


def components(edges: DataFrame, space: Scratch) -> DataFrame:
    """`node` and `component` (its lowest node) for every node of the edges (`a`, `b`).

    Large-star and small-star steps in turn: every node's higher neighbours, then all
    its lower ones, are linked to its lowest neighbour, until nothing changes. No node's
    neighbours are ever collected; they meet their lowest one in a shuffled join that
    adaptive execution splits. Self loops and repeated edges do no harm.
    """
    edges = space.table(edges.select("a", "b").filter("a <> b").distinct())
    state = None
    while True:
        pairs = _both(edges)
        low = _lowest(pairs)
        large = (
            pairs.join(low, F.col("a").eqNullSafe(F.col("n")))
            .filter("b > a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .distinct()
        )
        down = space.table(large)  # a > b in every row
        low = down.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
        linked = down.join(low, F.col("a").eqNullSafe(F.col("n")))
        small = linked.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            low.select(F.col("n").alias("a"), F.col("m").alias("b"))
        )
        edges = space.table(small.distinct())
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
