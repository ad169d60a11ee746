"""Connected components of a large link table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from kandela.session import materialise


def components(links: DataFrame, max_rounds: int = 64) -> DataFrame:
    """``node, component`` (the smallest node reachable) for every node of ``links`` (columns a, b).

    Large and small stars alternate: first every node ties its larger neighbours to its smallest
    neighbour, then its smaller neighbours too, until nothing changes; rounds grow with the logarithm of
    the longest chain. Minima combine before the shuffle and hot nodes only meet in joins, which
    adaptive execution can split. Minima and rounds are tables in the shared folder: lineage stays short and
    a join shuffles both sides itself, which lets it split hot nodes;
    only a row count and a checksum come to the driver. Self-links, repeated links and an empty table are fine; links with
    a null end are left out.
    """
    edges = materialise(
        links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    seen = _state(edges)
    for _ in range(max_rounds):
        edges = materialise(_small_star(materialise(_large_star(edges), "large-star")), "small-star")
        state = _state(edges)
        if state == seen:
            # Stable: every edge goes from a node to the smallest of its component.
            roots = edges.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
        seen = state
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    smallest = materialise(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")), "smallest")
    tied = both.join(smallest, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    smallest = materialise(edges.groupBy("a").agg(F.min("b").alias("m")), "smallest")
    tied = edges.join(smallest, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.unionByName(smallest.select("a", F.col("m").alias("b"))).distinct()
