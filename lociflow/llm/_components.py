"""Connected components of an edge list by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociflow.llm._stage import drop_stage, staged


def _sum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) of every node of edges (a, b): root is the least node of its component.

    Each round is two aggregations and two joins over the edges, written to the shared folder; the number of edges
    never grows. The least neighbours are written too: then the edges of a node of any degree meet a plain table, and
    Spark may split their partition. Null ends are dropped.
    """
    edges = staged(
        edges.where(F.col("a") != F.col("b")).select(
            F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
        ).distinct(),
        "edges"
    )
    before = _sum(edges)
    for _ in range(most_rounds):
        # Large star: every larger neighbour of u moves to the least of u's neighbourhood.
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        least = staged(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        large = both.where(F.col("v") > F.col("u")).join(least, "u").where(F.col("v") != F.col("m")).select(
            F.col("v").alias("a"), F.col("m").alias("b")
        ).distinct()
        # Small star: u's smaller neighbours and u itself move to the least of them.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where(F.col("b") != F.col("m")).select(
            F.col("b").alias("a"), F.col("m").alias("b")
        ).unionByName(low.select("a", F.col("m").alias("b"))).distinct()
        new = staged(small, "edges")
        # A fixed point is a set of stars: the same edges as before.
        after = _sum(new)
        drop_stage(edges)
        drop_stage(least)
        edges = new
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
