"""Connected components of links, as joins and grouped minima.

Alternating large-star and small-star steps (Kiveris et al., 2014): every step
points links at smaller neighbours and keeps components as they are, and the
steps end in one star a component after about log^2 rounds. Links stay in Spark;
the driver sees a count and a checksum a round. The table of a round is written
to the shared folder, so lineage stays short and an executor can be lost.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.session import settled

MAX_ROUNDS = 100


def _large_star(links: DataFrame) -> DataFrame:
    """Each larger neighbour of a node is linked to the node's smallest neighbour."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node (``a``, the larger end) and its smaller neighbours are linked to the
    smallest of them."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (a, b); component = smallest node.

    Nodes may have any orderable type. Loops (a = b) and nulls are left out; nodes
    without links do not appear. Links may be repeated and have either direction.
    """
    ends = [F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")]
    links = settled(links.where("a <> b").select(*ends).distinct(), "links")
    seen = None
    for _ in range(MAX_ROUNDS):
        links = settled(_small_star(_large_star(links)), "links")
        state = tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    stars = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.union(stars.select("component", "component").distinct())
