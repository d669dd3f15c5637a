"""Connected components of links that stay distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.llm.common import BROADCAST_ROWS, removed, work_dir, written


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); the root is the component's smallest node.

    Large-star and small-star steps in turn until nothing changes: each moves
    links towards smaller nodes, the number of rounds grows with the logarithm
    of the longest path. Every round starts from a table on shared storage and
    removes the one before. The
    minimum of each node is added up before the shuffle and meets the node's
    links by a broadcast while there are few nodes; beyond that a node with very
    many links is split by the skew-aware join, since its minimum is one row.
    """
    spark = links.sparkSession
    folder = work_dir(spark, name)
    ordered = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = written(ordered, f"{folder}/0")
    state, n = _state(edges), 0
    while state[0]:
        few = F.broadcast if 2 * state[0] <= BROADCAST_ROWS else (lambda table: table)
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(few(least), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        # the star of smaller neighbours: a's least neighbour takes a and its other smaller neighbours
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(few(low), "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b")).where("a <> b")
        n += 1
        edges = written(small.distinct(), f"{folder}/{n}")
        before, state = state, _state(edges)
        removed(spark, f"{folder}/{n - 1}")
        if state == before:
            break
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
