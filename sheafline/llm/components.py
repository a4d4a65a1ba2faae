"""Connected components of an edge table, by alternating stars.

A large star links every larger neighbour of a node to the smallest; a small star links a
node and its smaller neighbours to the smallest of them. Both keep the components, and in
the end every node is linked to the smallest of its component. A round is two aggregates
and joins; a hub's neighbours are reduced before they are shuffled, and the join back to
them is left to adaptive execution to split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sheafline.llm.staging import clean, cut_lineage


def components(edges: DataFrame) -> DataFrame:
    """Columns ``node`` and ``component`` (its smallest node), for every node of an edge.

    ``edges`` has columns ``a`` and ``b``; loops and repeated edges do no harm. A node
    without an edge has no row.
    """
    links = cut_lineage(_down(edges).distinct())
    before = None
    while (state := _state(links)) != before:
        before = state
        links = cut_lineage(_small_star(_large_star(links)).distinct())
    clean(edges.sparkSession)
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def _down(edges: DataFrame) -> DataFrame:
    """Edges from the larger to the smaller node."""
    return edges.filter(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )


def _state(links: DataFrame) -> tuple[int, int]:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    smallest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("root"))
    larger = links.select(F.col("b").alias("a"), F.col("a").alias("larger"))
    return larger.join(smallest, "a").select(F.col("larger").alias("a"), F.col("root").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    smallest = links.groupBy("a").agg(F.min("b").alias("root"))
    # the node itself is linked to the root as well; loops of the root are dropped
    moved = links.join(smallest, "a").select(F.col("b").alias("a"), F.col("root").alias("b"))
    own = smallest.select("a", F.col("root").alias("b"))
    return _down(moved.unionByName(own))
