"""Connected components by alternating stars (Kiveris et al., 2014), as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mergelens.session import cut_lineage


def components(edges: DataFrame) -> DataFrame:
    """node and component (its smallest reachable node) of every node of (a, b) rows of longs.

    Loops and repeated edges are allowed; without edges there are no rows. Each round hangs every
    neighbour on the smallest one, first the larger neighbours, then the smaller; rounds grow
    with the logarithm of the longest path. Edges stay in Spark; a node with very many edges is
    aggregated before the shuffle, and its join can be split.
    """
    stars = cut_lineage(_ordered(edges.select("a", "b")))
    before = _mark(stars)
    while before[0]:
        stars = cut_lineage(_small_star(_large_star(stars)))
        after = _mark(stars)
        if after == before:
            break
        before = after
    centres = stars.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return centres.unionByName(stars.select(F.col("a").alias("node"), F.col("b").alias("component")))


def _ordered(edges: DataFrame) -> DataFrame:
    """Every edge once, from the larger node a to the smaller b."""
    return (
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def _large_star(stars: DataFrame) -> DataFrame:
    both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least"))
    joined = both.join(least, "a").where(F.col("b") > F.col("a"))
    return joined.select(F.col("b").alias("a"), F.least("a", "least").alias("b"))


def _small_star(stars: DataFrame) -> DataFrame:
    least = stars.groupBy("a").agg(F.min("b").alias("least"))
    moved = stars.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return _ordered(moved.unionByName(least.select("a", F.col("least").alias("b"))))


def _mark(stars: DataFrame) -> tuple[int, int]:
    """The number of edges and a sum of their hashes: equal if a round has changed nothing."""
    hashed = F.xxhash64("a", "b").cast("decimal(38,0)")
    row = stars.agg(F.count("*").alias("n"), F.sum(hashed).alias("mark")).first()
    return int(row["n"]), int(row["mark"] or 0)
