"""Connected components by alternating large-star and small-star contraction.

Every round relinks nodes to the smallest neighbour known, by joins and minima that combine
map-side; no adjacency list is gathered and nothing but two numbers a round comes to the
driver. Rounds are written to the shared folder, which cuts lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.session import materialize


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("child", "parent"))).first()
    return row[0], row[1]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("parent").alias("child"), F.col("child").alias("parent")))
    least = both.groupBy("child").agg(F.min("parent").alias("low")).select(
        "child", F.least("child", "low").alias("low")
    )
    # Written, so that the join reads both sides from plain shuffles: a hub can be split.
    least = materialize(least, "least")
    return (
        both.join(least, "child")
        .where(F.col("parent") > F.col("child"))
        .select(F.col("parent").alias("child"), F.col("low").alias("parent"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("child").agg(F.min("parent").alias("low"))
    joined = edges.join(least, "child").where(F.col("parent") != F.col("low"))
    moved = joined.select(F.col("parent").alias("child"), F.col("low").alias("parent"))
    return moved.union(least.select("child", F.col("low").alias("parent"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each node of ``links`` (a, b) can reach.

    Nodes are longs. Loops and repeated links are allowed, null ends are left out. Nodes that
    are in no link have no row; neither have the components' smallest nodes.
    """
    edges = links.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("child"), F.least("a", "b").alias("parent")
    )
    edges = materialize(edges.distinct(), "links")
    state = _state(edges)
    while state[0]:
        edges = materialize(_small_star(_large_star(edges)), "stars")
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(F.col("child").alias("node"), F.col("parent").alias("component"))


def with_components(nodes: DataFrame, node: str, links: DataFrame) -> DataFrame:
    """``nodes`` with ``component``: a node that reaches no smaller one is its own."""
    found = components(links).select(F.col("node").alias(node), "component")
    return nodes.join(found, node, "left").withColumn(
        "component", F.coalesce("component", F.col(node))
    )
