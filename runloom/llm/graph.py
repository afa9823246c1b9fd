"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .support import stored


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each larger neighbour of a node to the least of the node and its neighbours."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("m"))
    joined = both.join(least, F.col("u") == F.col("node")).filter("v > u")
    return joined.select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of them."""
    least = edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("m"))
    joined = edges.join(least, F.col("u") == F.col("node"))
    return (
        joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
        .filter("u <> v")
        .union(least.select(F.col("node").alias("u"), F.col("m").alias("v")))
        .distinct()
    )


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for each node of the links ``(u, v)``: the least node reachable.

    Large-star and small-star steps alternate until the table no longer changes; it then
    links every node to the least one of its component. Each round is a written table.
    A node without a link other than to itself has no row.
    """
    ordered = links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = stored(ordered.distinct(), "links")
    before = _fingerprint(edges)
    while before[0]:
        edges = stored(_small_star(_large_star(edges)), "links")
        after = _fingerprint(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
