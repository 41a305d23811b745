"""Connected components of links inside groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.scratch import cut


def components(links: DataFrame, group: list[str]) -> DataFrame:
    """links (group..., a, b) -> (group..., node, component): the least node that each linked node can reach in its group.

    Each round hangs every node's larger neighbours on the least of its neighbourhood, then its smaller ones and itself, until nothing
    changes: a number of rounds that grows with the logarithm of the longest path. Neighbourhoods are only ever reduced to their least
    node, by partial aggregation; nothing is gathered."""
    keys = [F.col(g) for g in group]
    edges = cut(links.filter("a <> b").select(*keys, F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())

    def hang(arcs: DataFrame, upward: bool) -> DataFrame:
        least = arcs.groupBy(*group, "a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        hung = arcs.join(least, [*group, "a"])
        moved = hung.filter("b > a" if upward else "true").select(*group, F.col("b").alias("a"), F.col("low").alias("b"))
        return (moved if upward else moved.unionByName(least.select(*group, "a", F.col("low").alias("b")))).filter("a > b").distinct()

    mark = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64(*group, "a", "b").cast("decimal(38,0)"))).first()
        if mark == tuple(now) or now[0] == 0:
            break
        mark = tuple(now)
        both = edges.unionByName(edges.select(*group, F.col("b").alias("a"), F.col("a").alias("b")))
        edges = cut(hang(hang(both, True), False))
    return edges.select(*group, F.col("a").alias("node"), F.col("b").alias("component")).unionByName(edges.select(*group, F.col("b").alias("node"), F.col("b").alias("component")).distinct())
