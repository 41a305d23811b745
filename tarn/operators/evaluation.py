"""What a detector's results are worth: overlaps and ranks, false alarms at fixed recall, calibration, recurrence over an archive.

Beyond the manifest's own operators.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarn.operators.positions import HOT_CELL, cell_join
from tarn.scratch import cut

RING = "array<struct<x:double,y:double>>"


#: Decimals of an overlap, so that equal ones are ties however their points were rounded.
DIGITS = 12

Ring = list[tuple[float, float]]


def _area(ring: Ring) -> float:
    return sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(ring, ring[1:] + ring[:1], strict=True)) / 2


def clip(ring: Ring, by: Ring) -> Ring:
    """The part of a ring inside a convex ring, edge by edge of the convex one."""
    by = by if _area(by) >= 0 else by[::-1]
    for (ax, ay), (bx, by_) in zip(by, by[1:] + by[:1], strict=True):
        dx, dy = bx - ax, by_ - ay
        side = [dx * (y - ay) - dy * (x - ax) for x, y in ring]
        kept = []
        for p, q, s, t in zip(ring, ring[1:] + ring[:1], side, side[1:] + side[:1], strict=True):
            if s >= 0:
                kept.append(p)
            if (s > 0 > t) or (s < 0 < t):
                part = s / (s - t)
                kept.append((p[0] + (q[0] - p[0]) * part, p[1] + (q[1] - p[1]) * part))
        ring = kept
    return ring


def iou(a: Ring, b: Ring) -> float:
    """Intersection over union of two rings, the second convex."""
    inner = abs(_area(clip(a, b)))
    union = abs(_area(a)) + abs(_area(b)) - inner
    return inner / union if union > 0 else 0.0


def _areas(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Signed areas of rings in rows of padded coordinates, n points each."""
    at = np.arange(x.shape[1])
    ahead = np.where(at + 1 < n[:, None], at + 1, 0)
    cross = x * np.take_along_axis(y, ahead, 1) - np.take_along_axis(x, ahead, 1) * y
    return np.where(at < n[:, None], cross, 0.0).sum(axis=1) / 2


def ious(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """`iou` of many pairs at a time: rings (pairs, points, 2), all of a with as many points, and all of b."""
    n, m = (np.full(len(r), r.shape[1]) for r in (a, b))
    own, other = _areas(a[:, :, 0], a[:, :, 1], n), _areas(b[:, :, 0], b[:, :, 1], m)
    b = np.where((other >= 0)[:, None, None], b, b[:, ::-1])
    x, y = a[:, :, 0], a[:, :, 1]
    for k in range(b.shape[1]):
        (ax, ay), (bx, by) = b[:, k].T, b[:, (k + 1) % b.shape[1]].T
        dx, dy = bx - ax, by - ay
        at = np.arange(x.shape[1])
        here = at < n[:, None]
        ahead = np.where(at + 1 < n[:, None], at + 1, 0)
        s = dx[:, None] * (y - ay[:, None]) - dy[:, None] * (x - ax[:, None])
        t = np.take_along_axis(s, ahead, 1)
        crossed = here & (((s > 0) & (t < 0)) | ((s < 0) & (t > 0)))
        part = s / np.where(crossed, s - t, 1.0)
        points = [np.stack([v, v + (np.take_along_axis(v, ahead, 1) - v) * part], axis=2).reshape(len(v), 2 * v.shape[1]) for v in (x, y)]
        kept = np.stack([here & (s >= 0), crossed], axis=2).reshape(len(x), 2 * x.shape[1])
        n = kept.sum(axis=1)
        order = np.argsort(~kept, axis=1, kind="stable")[:, : max(int(n.max(initial=0)), 1)]
        x, y = (np.take_along_axis(v, order, 1) for v in points)
    inner = np.abs(_areas(x, y, n))
    union = np.abs(own) + np.abs(other) - inner
    return np.divide(inner, union, out=np.zeros(len(a)), where=union > 0)


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(keys..., a_ring, b_ring) -> (keys..., iou); pairs of rings of the same numbers of points are clipped together."""
    for batch in batches:
        *keys, a, b = batch.columns
        sizes, points = [], []
        for ring in (a, b):
            flat = ring.flatten()
            sizes.append(np.diff(ring.offsets.to_numpy()))
            points.append(np.column_stack([flat.field(c).to_numpy(zero_copy_only=False) for c in "xy"]))
        out = np.zeros(len(a))
        starts = [np.cumsum(k) - k for k in sizes]
        for n, m in np.unique(np.column_stack(sizes), axis=0).tolist():
            rows = np.flatnonzero((sizes[0] == n) & (sizes[1] == m))
            out[rows] = ious(*(p[first[rows][:, None] + np.arange(k)] for p, first, k in zip(points, starts, (n, m), strict=True)))
        yield pa.RecordBatch.from_arrays([*keys, pa.array(np.round(out, DIGITS))], [*batch.schema.names[: len(keys)], "iou"])


def overlaps(found: DataFrame, truth: DataFrame, cell: float, least: float = 0.0, hot: int = HOT_CELL) -> DataFrame:
    """(scene, found_id, true_id, iou, rank): pairs of objects of a scene whose outlines share area, each pair once; iou to DIGITS decimals; rank 1 is a
    found object's best, ties to the smaller true_id.

    found: (scene, found_id, ring), any simple ring; truth: (scene, true_id, ring), convex. Rings of fewer than three points and null ones meet
    nothing. Objects are dealt to the cells (of `cell` on a side: about an object's size) that their boxes touch; a pair is
    looked at in one of the cells that it shares, that of its boxes' common corner. Busy cells are split."""
    edge = lambda of, c: of(F.transform("ring", lambda p: p[c].cast("double")))

    def dealt(rows: DataFrame, key: str, side: str) -> DataFrame:
        rows = rows.filter(F.size("ring") > 2).select("scene", key, F.col("ring").cast(RING).alias(f"{side}_ring"), *[edge(f, c).alias(f"{side}_{c}{n}") for c in "xy" for f, n in ((F.array_min, 0), (F.array_max, 1))])
        for c in "xy":
            low, high = (F.floor(F.col(f"{side}_{c}{n}") / cell).cast("long") for n in (0, 1))
            rows = rows.withColumn(f"_{c}", F.explode(F.sequence(low, high)))
        return rows

    met = cell_join(dealt(truth, "true_id", "b"), dealt(found, "found_id", "a"), ["scene", "_x", "_y"], hot)
    both = met.filter("a_x0 < b_x1 and b_x0 < a_x1 and a_y0 < b_y1 and b_y0 < a_y1")
    for c in "xy":
        both = both.filter(F.col(f"_{c}") == F.floor(F.greatest(f"a_{c}0", f"b_{c}0") / cell))

    asked = both.select("scene", "found_id", "true_id", "a_ring", "b_ring")
    schema = T.StructType([*asked.schema.fields[:3], T.StructField("iou", T.DoubleType())])
    pairs = asked.mapInArrow(_scored, schema).filter((F.col("iou") > 0) & (F.col("iou") >= least))
    best = Window.partitionBy("scene", "found_id").orderBy(F.desc("iou"), "true_id")
    return pairs.withColumn("rank", F.row_number().over(best))


def false_alarms(scored: DataFrame, area: DataFrame, recall: float, bins: int = 1000) -> DataFrame:
    """(wind_class, threshold, recall, false_alarms, per_1000_km2): of each class the highest threshold that keeps the recall, and
    the false alarms at it. scored: (wind_class, score in [0, 1], hit boolean), area: (wind_class, km2). Thresholds are the bins' lower
    edges; classes without a true object, or without area, have nulls. Scores are counted in bins where they lie and only classes x bins rows move."""
    bin_ = F.least(F.floor(F.col("score") * bins), F.lit(bins - 1)).cast("int")
    counts = scored.filter("score is not null and hit is not null").groupBy("wind_class", bin_.alias("bin")).agg(F.count_if("hit").alias("hits"), F.count_if(~F.col("hit")).alias("alarms"))
    down = Window.partitionBy("wind_class").orderBy(F.desc("bin"))
    total = F.sum("hits").over(Window.partitionBy("wind_class"))
    each = counts.select("wind_class", "bin", F.sum("hits").over(down).alias("kept"), F.sum("alarms").over(down).alias("alarms"), total.alias("total"))
    enough = each.filter("total > 0").filter(F.col("kept") >= recall * F.col("total"))
    top = enough.groupBy("wind_class").agg(F.max_by(F.struct("bin", "kept", "alarms", "total"), "bin").alias("at"))
    classes = counts.select("wind_class").distinct().join(top, "wind_class", "left").join(area, "wind_class", "left")
    return classes.select("wind_class", (F.col("at.bin") / bins).alias("threshold"), (F.col("at.kept") / F.col("at.total")).alias("recall"), F.col("at.alarms").alias("false_alarms"), F.try_divide(1000 * F.col("at.alarms"), F.col("km2")).alias("per_1000_km2"))


def pool(y: np.ndarray, w: np.ndarray, low: np.ndarray, high: np.ndarray) -> list[list]:
    """Neighbouring blocks [low, high, sum of values, weight], pooled until their means rise."""
    out: list[list] = []
    for a, b, s, n in zip(low.tolist(), high.tolist(), y.tolist(), w.tolist(), strict=True):
        block = [a, b, s, n]
        while out and out[-1][2] * block[3] >= block[2] * out[-1][3]:
            before = out.pop()
            block = [before[0], block[1], before[2] + block[2], before[3] + block[3]]
        out.append(block)
    return out


BLOCKS = "part int, low double, high double, total double, weight double"


def isotonic(rows: DataFrame, score: str = "score", hit: str = "hit", digits: int = 6, fan: int = 8) -> DataFrame:
    """(low, high, value, weight): the rising step function of score nearest to `hit` in least squares, as blocks of scores with one value.

    Scores lie in [0, 1] and are taken to `digits` decimals, so there are at most 10 ** digits blocks whatever the rows. Violators are
    pooled within ranges of scores first, then `fan` neighbouring ranges at a time: pooling blocks gives what pooling their members would."""
    known = rows.filter(F.col(score).isNotNull() & F.col(hit).isNotNull())
    each = known.groupBy(F.round(F.col(score), digits).alias("low")).agg(F.sum(F.col(hit).cast("double")).alias("total"), F.count("*").cast("double").alias("weight"))
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = each.repartitionByRange(parts, "low").sortWithinPartitions("low").select(F.spark_partition_id().alias("part"), "low", F.col("low").alias("high"), "total", "weight")

    def merged(frame: pd.DataFrame, part: int) -> pd.DataFrame:
        frame = frame.sort_values("low")
        blocks = pool(*(frame[c].to_numpy() for c in ("total", "weight", "low", "high")))
        return pd.DataFrame([[part, *b] for b in blocks], columns=["part", "low", "high", "total", "weight"])

    def local(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = [f for f in frames if len(f)]
        if held:
            yield merged(pd.concat(held), int(held[0]["part"].iloc[0]))

    blocks = cut(laid.mapInPandas(local, BLOCKS))
    while parts > 1:
        up = F.floor(F.col("part") / fan).cast("int")
        blocks = cut(blocks.withColumn("part", up).groupBy("part").applyInPandas(lambda f: merged(f, int(f["part"].iloc[0])), BLOCKS))
        parts = -(-parts // fan)
    return blocks.select("low", "high", (F.col("total") / F.col("weight")).alias("value"), F.col("weight").cast("long").alias("weight"))


def passes(seen: DataFrame, cell: str = "cell") -> DataFrame:
    """(cell, bucket, passes, hits): of each place which passes saw it and which found something there, as bitmaps.

    seen: (cell, pass_no long >= 0, hit boolean), in any order and with repeats; partial bitmaps merge before they move. Null cells and passes are left out."""
    at = F.col("pass_no")
    known = seen.filter(F.col(cell).isNotNull() & at.isNotNull())
    marked = known.select(cell, F.bitmap_bucket_number(at).alias("bucket"), F.bitmap_bit_position(at).alias("bit"), F.coalesce(F.col("hit"), F.lit(False)).alias("hit"))
    return marked.groupBy(cell, "bucket").agg(F.bitmap_construct_agg("bit").alias("passes"), F.bitmap_construct_agg(F.when(F.col("hit"), F.col("bit"))).alias("hits"))


def merge_passes(known: DataFrame, late: DataFrame, cell: str = "cell") -> DataFrame:
    """Two tables of bitmaps as one: late passes need no rescan of the archive."""
    return known.unionByName(late).groupBy(cell, "bucket").agg(F.bitmap_or_agg("passes").alias("passes"), F.bitmap_or_agg("hits").alias("hits"))


def recurrence(known: DataFrame, cell: str = "cell", share: float = 0.3, least_passes: int = 1) -> DataFrame:
    """(cell, n_passes, n_hits, share, recurrent): found on at least `share` of the passes that saw the place."""
    counts = known.groupBy(cell).agg(F.sum(F.bitmap_count("passes")).alias("n_passes"), F.sum(F.bitmap_count("hits")).alias("n_hits"))
    part = F.col("n_hits") / F.col("n_passes")
    return counts.select(cell, "n_passes", "n_hits", part.alias("share"), ((part >= share) & (F.col("n_passes") >= least_passes)).alias("recurrent"))
