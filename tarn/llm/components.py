"""Connected components of a links table, by alternating large-star and small-star steps; nothing is gathered on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import discard, materialise


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges (a, b), a > b. Large: each node's larger neighbours hang on the least of its neighbourhood; small: its smaller ones and itself do."""
    if large:
        arcs = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        arcs = edges
    least = arcs.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("low"))
    hung = arcs.join(least, F.col("a") == F.col("node"))
    if large:
        out = hung.filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        out = hung.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(least.select(F.col("node").alias("a"), F.col("low").alias("b")))
    return out.filter("a > b").distinct()


def components(links: DataFrame) -> DataFrame:
    """links (a long, b long) -> (node, component): each linked node and the least node it can reach. Nulls and loops are ignored."""
    edges = materialise(links.filter("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    while True:
        mark = edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first()
        if seen is not None and tuple(mark) == seen or mark[0] == 0:
            break
        seen = tuple(mark)
        after = materialise(_star(_star(edges, True), False), "edges")
        discard(edges)
        edges = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
