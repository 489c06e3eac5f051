"""Connected components of links, by alternating large-star and small-star steps.

Each step points every node at the least node it knows of, so links shrink to stars. Steps are
aggregates and joins of (node, node) rows; nothing is gathered, and the rows are staged after each
round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smelter.operators import stage


def _least(links: DataFrame) -> DataFrame:
    """(u, least) for links (u, v): the least of u and all its v."""
    return links.groupBy("u").agg(F.min("v").alias("v")).select(
        F.col("u").alias("n"), F.least("u", "v").alias("least")
    )


def _large_star(links: DataFrame) -> DataFrame:
    """Point the larger neighbours of each node at its least neighbour."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (
        both.join(stage(_least(both), "least"), F.col("u") == F.col("n"))
        .where(F.col("v") > F.col("u"))
        .select(F.col("v").alias("u"), F.col("least").alias("v"))
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Point each node's smaller neighbours, and the node, at the least of them."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = stage(_least(down), "least")
    moved = (
        down.join(least, F.col("u") == F.col("n"))
        .where(F.col("v") != F.col("least"))
        .select(F.col("v").alias("u"), F.col("least").alias("v"))
    )
    return moved.unionByName(
        least.where(F.col("n") != F.col("least")).select(F.col("n").alias("u"), F.col("least").alias("v"))
    )


def _are_stars(links: DataFrame) -> bool:
    """Whether each link points down to a root: no node has two links or a link at either end."""
    ends = links.select(
        F.col("u").alias("n"), F.lit(1).alias("out"), (F.col("u") < F.col("v")).cast("int").alias("bad")
    ).unionByName(links.select(F.col("v").alias("n"), F.lit(0).alias("out"), F.lit(0).alias("bad")))
    nodes = ends.groupBy("n").agg(
        F.sum("out").alias("out"), F.count("*").alias("all"), F.max("bad").alias("bad")
    )
    return nodes.where("bad = 1 or out > 1 or (out = 1 and all > 1)").isEmpty()


def components(links: DataFrame, rounds: int | None = None) -> DataFrame:
    """(node, root) for every node that the links (u, v) touch; the root is the component's least
    node.

    Links of a node with itself are ignored; repeated ones and both directions do no harm. With
    ``rounds``, it ends after so many: nodes with equal roots are then connected, but connected
    nodes may have different roots.
    """
    links = stage(links.where("u != v").select("u", "v"), "links")
    done = 0
    while (rounds is None or done < rounds) and not _are_stars(links):
        stars = stage(_large_star(links), "stars")
        links = stage(_small_star(stars).distinct(), "links")
        done += 1
    ends = links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        links.select(F.col("v").alias("node"), F.col("v").alias("root"))
    )
    return ends.groupBy("node").agg(F.min("root").alias("root"))
