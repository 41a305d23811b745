"""Exact positions in a global order, found without one task sorting everything."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frames import discard, fresh, materialise, partitions, small

#: monotonically_increasing_id() holds the partition above this bit and the row's number in it below.
_SHIFT = 33


def ranked(rows: DataFrame, group: str, order: list[Column], pos: str = "pos", total: str = "n") -> DataFrame:
    """rows and two columns: `pos`, the row's place (from 0) in its group by `order`, and `total`, the group's number of rows.

    rows: a materialised frame (ranges are sampled from it), whose order should end with a column that tells equal rows
    apart, so that a value that repeats in a third of all rows still spreads over many ranges. `group` is never null.
    Rows are dealt by range of (group, order) and sorted inside their partition; a partition's rows of one group follow
    each other, so their place is their number in the partition, shifted by the rows of that group in earlier partitions.
    These counts are one row for each group in each partition (at most groups + partitions).
    """
    seq, part, shift, of = (fresh(rows, c) for c in ("seq", "part", "shift", "of_group"))
    keys = [F.col(group), *order]
    laid = rows.repartitionByRange(partitions(rows.sparkSession), *keys).sortWithinPartitions(*keys)
    laid = materialise(laid.withColumn(seq, F.monotonically_increasing_id()), "ranked").withColumn(part, F.shiftright(seq, _SHIFT).cast("long"))
    runs = laid.groupBy(F.col(group).alias(of), part).agg(F.min(seq).alias("first"), F.count("*").alias("rows"))
    earlier = F.sum("rows").over(Window.partitionBy(of).orderBy(part).rowsBetween(Window.unboundedPreceding, -1))
    everywhere = F.sum("rows").over(Window.partitionBy(of))
    runs = materialise(runs.select(of, part, (F.coalesce(earlier, F.lit(0)) - F.col("first")).alias(shift), everywhere.alias(total)), "runs")
    placed = laid.join(small(runs).withColumnRenamed(part, part + "_"), (F.col(group) == F.col(of)) & (F.col(part) == F.col(part + "_")))
    out = materialise(placed.withColumn(pos, F.col(seq) + F.col(shift)).select(*rows.columns, pos, total), "placed")
    discard(laid)
    discard(runs)
    return out
