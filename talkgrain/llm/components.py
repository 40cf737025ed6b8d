"""Connected components of a graph given as a DataFrame of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkgrain.llm.common import written


def connected_components(links: DataFrame) -> DataFrame:
    """The smallest node reachable from each linked node.

    ``links`` has two columns of one orderable type, a link a row, in any direction; self-links,
    repeated links and rows with a null are of no effect. Returns ``node``, ``root`` for every
    node of a proper link. Each round links every node to the smallest of its neighbourhood, first
    for the larger neighbours and then for the smaller ones, so a component becomes a star in a
    number of rounds that grows with the logarithm of its size. A round is a grouped minimum,
    folded before the shuffle, and an equi-join; its links are written to the shared folder, so
    that no round depends on an earlier one's executors.
    """
    a, b = links.columns
    edges = (
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"), F.col(a), F.col(b))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v")))
        .select("u", "v")
        .distinct()
    )
    edges = written(edges, "links")
    before = None
    while True:
        # Larger neighbours of each node go to the smallest of the node and all its neighbours.
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        low = low.select(F.col("u").alias("n"), F.least("u", "m").alias("m"))
        large = (
            edges.join(low, F.col("v") == F.col("n"))
            .select(F.col("u"), F.col("m").alias("v"))
            .where("u <> v")
            .distinct()
        )
        large = written(large, "links")
        # Smaller neighbours of each node, and the node, go to the smallest of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low.select(F.col("u").alias("n"), "m"), F.col("u") == F.col("n"))
        small = (
            joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(low.select("u", F.col("m").alias("v")))
            .where("u <> v")
            .distinct()
        )
        edges = written(small, "links")
        # A star forest stays as it is: as many links as nodes that have a smaller neighbour, and
        # the same links as a round before.
        state = edges.agg(
            F.count("*"), F.count_distinct("u"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if state == before or (state[0] == state[1] and _is_star(edges)):
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        before = state


def _is_star(edges: DataFrame) -> bool:
    """Whether no smaller end of a link has a smaller neighbour itself."""
    tops = edges.select("u")
    return edges.join(tops.withColumnRenamed("u", "t"), F.col("v") == F.col("t"), "semi").isEmpty()
