"""Objects of a scene from its overlapping tiles: labelling, merging at seams, outlines and geometry metrics.

1. In each tile the connected pixels of a class are joined by union-find over runs: a part. A part is named by its first
   pixel in the scene's raster order, so that parts of two tiles that see the same whole object have the same name.
2. Tiles meet on seams: the lines of tile edges. A part that goes on in another tile crosses one, so it is enough that each
   part lists its pixels on the seams inside its tile, and the pixels just outside its tile that it touches. Parts listed
   at one pixel are linked (a touched pixel links only to a part that holds it), and components over all links are objects.
3. Every pixel belongs to one tile (that with the last origin before it), so areas and moments of parts add up, hulls merge
   as hulls of hulls, and outlines are the sum of the parts' outlines, in which inner borders cancel.

A row of a part is small: sums, a hull, seam pixels and outline segments. No pixel leaves its tile. What meets in one task is
one object's outline or hull, never a scene.

Defined results: null masks and classes that aren't asked for give no parts; tiles must be all windows of the scene by `spec`
(pixels of a missing tile are in no object); coordinates are x = column, y = row, an outline runs along pixel edges.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarn.model import TileSpec
from tarn.operators.components import components
from tarn.scratch import cut

POINT = "struct<x:int,y:int>"
PARTS = (
    "sample_id string, label int, node long, area long, sx long, sy long, sxx long, sxy long, syy long, x_min int, y_min int, x_max int, y_max int, "
    f"hull array<{POINT}>, seam array<struct<pixel:long,held:boolean>>, outline array<struct<x0:int,y0:int,x1:int,y1:int>>"
)
GROUP = ["sample_id", "label"]


def _starts(extent: int, spec: TileSpec) -> np.ndarray:
    last = extent - spec.size
    return np.zeros(1, dtype=np.int64) if last <= 0 else np.unique(np.append(np.arange(0, last + 1, spec.stride), last))


@lru_cache(maxsize=64)
def _layout(height: int, width: int, spec: TileSpec) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Origins of a scene's tiles, and for each line whether it is a seam; by row and by column. Tiles of equal scenes share them."""
    starts, seams = [_starts(n, spec) for n in (height, width)], []
    for s, n in zip(starts, (height, width), strict=True):
        line = np.zeros(n + spec.size, dtype=bool)
        line[s] = line[np.minimum(s + spec.size, n) - 1] = True
        seams.append(line)
    return starts, seams


def label_parts(mask: np.ndarray, wanted: list[int], diagonal: bool = False) -> np.ndarray:
    """For each pixel the raster index of the first pixel of its connected part, -1 outside the wanted classes."""
    h, w = mask.shape
    flat = mask.ravel()
    if not flat.size:
        return np.zeros(mask.shape, dtype=np.int64)
    new = np.ones(flat.size, dtype=bool)
    new[1:] = flat[1:] != flat[:-1]
    new[::w] = True
    start = np.flatnonzero(new)
    end = np.append(start[1:], flat.size) - 1
    used = np.isin(flat[start], wanted)
    size = end - start + 1
    start, end = start[used], end[used]
    reach = int(diagonal)
    # Runs of the row above that a run touches are neighbours in the list of runs.
    row = start // w
    lo = np.searchsorted(end, np.maximum(start - w - reach, (row - 1) * w))
    hi = np.searchsorted(start, np.minimum(end - w + reach, row * w - 1), "right")
    many = np.maximum(np.where(row > 0, hi - lo, 0), 0)
    below = np.repeat(np.arange(len(start)), many)
    above = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(lo, many)
    same = flat[start[below]] == flat[start[above]]
    parent = list(range(len(start)))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a, b in zip(below[same].tolist(), above[same].tolist(), strict=True):
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    out = np.full(len(used), -1, dtype=np.int64)
    out[used] = start[[find(i) for i in range(len(start))]] if len(start) else 0
    return np.repeat(out, size).reshape(h, w)


def convex_hull(points: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Corners of the hull of points (x, y), clockwise on a screen from the least; collinear points are left out."""
    points = sorted(set(points))
    if len(points) < 3:
        return points
    halves = []
    for side in (points, points[::-1]):
        chain: list[tuple[int, int]] = []
        for p in side:
            while len(chain) > 1 and (chain[-1][0] - chain[-2][0]) * (p[1] - chain[-2][1]) - (chain[-1][1] - chain[-2][1]) * (p[0] - chain[-2][0]) <= 0:
                chain.pop()
            chain.append(p)
        halves += chain[:-1]
    return halves


def _outline(own: np.ndarray) -> dict[str, np.ndarray]:
    """Directed pixel edges around every part, the part on the right hand, straight inner stretches joined; the edges of the array stay single."""
    h, w = own.shape
    pad = np.pad(own, 1, constant_values=-1)
    mid = pad[1:-1, 1:-1]
    found = []
    for dy, dx in ((-1, 0), (0, 1), (1, 0), (0, -1)):  # top, right, bottom, left
        open_ = (mid >= 0) & (pad[1 + dy : 1 + dy + h, 1 + dx : 1 + dx + w] != mid)
        turned = open_ if dy else open_.T
        part = mid if dy else mid.T
        line, at = np.nonzero(turned)
        name = part[line, at]
        edge = line + (1 if dy > 0 or dx > 0 else 0)
        rim = (edge == 0) | (edge == turned.shape[0])
        new = np.ones(len(line), dtype=bool)
        new[1:] = rim[1:] | (line[1:] != line[:-1]) | (at[1:] != at[:-1] + 1) | (name[1:] != name[:-1])
        first = np.flatnonzero(new)
        low = at[first]
        high = at[np.append(first[1:], len(at)) - 1] + 1 if len(at) else low
        forward = dy < 0 or dx > 0
        a, b = (low, high) if forward else (high, low)
        e = edge[first]
        found.append((name[first], *((a, e, b, e) if dy else (e, a, e, b))))
    name, x0, y0, x1, y1 = (np.concatenate(c) for c in zip(*found, strict=True))
    return {"name": name, "x0": x0, "y0": y0, "x1": x1, "y1": y1}


def tile_parts(mask: np.ndarray, row: int, col: int, height: int, width: int, spec: TileSpec, wanted: list[int], diagonal: bool) -> dict[str, list]:
    """The parts of a tile at (row, col) of a scene of height x width, by column."""
    h, w = mask.shape
    local = label_parts(mask, wanted, diagonal)
    pixel = (np.arange(row, row + h)[:, None] * width + np.arange(col, col + w)[None, :]).astype(np.int64)
    name = np.where(local >= 0, (local // w + row) * width + local % w + col, -1)
    (rows, cols), seams = _layout(height, width, spec)
    on_seam = seams[0][row : row + h][:, None] | seams[1][col : col + w][None, :]
    held = on_seam & (name >= 0)
    seam = [np.stack([name[held], pixel[held], np.ones(held.sum(), dtype=np.int64)])]
    steps = [(-1, 0), (0, 1), (1, 0), (0, -1)] + ([(-1, -1), (-1, 1), (1, -1), (1, 1)] if diagonal else [])
    rim_y, rim_x = np.nonzero((name >= 0) & ((np.arange(h) % max(h - 1, 1) == 0)[:, None] | (np.arange(w) % max(w - 1, 1) == 0)[None, :]))
    for dy, dx in steps:
        y, x = rim_y + dy, rim_x + dx
        out = ((y < 0) | (y >= h) | (x < 0) | (x >= w)) & (y + row >= 0) & (y + row < height) & (x + col >= 0) & (x + col < width)
        seam.append(np.stack([name[rim_y[out], rim_x[out]], (y[out] + row) * width + x[out] + col, np.zeros(out.sum(), dtype=np.int64)]))
    seam = np.unique(np.concatenate(seam, axis=1), axis=1)
    bottom, right = (int(s[s > at].min(initial=n)) for s, at, n in ((rows, row, height), (cols, col, width)))
    own = name[: bottom - row, : right - col]
    lines = _outline(own)
    names, first = np.unique(name, return_index=True)
    names, first = names[names >= 0], first[names >= 0]
    oy, ox = np.nonzero(own >= 0)
    of = np.searchsorted(names, own[oy, ox])
    oy, ox = oy + row, ox + col
    order = np.argsort(of, kind="stable")  # raster order inside a part
    of, oy, ox = of[order], oy[order], ox[order]
    n = len(names)
    total = lambda v: np.bincount(of, v, n).astype(np.int64).tolist()
    columns = {"label": mask.ravel()[first].tolist(), "node": names.tolist(), "area": np.bincount(of, minlength=n).tolist()}
    columns |= {"sx": total(ox), "sy": total(oy), "sxx": total(ox * ox), "sxy": total(ox * oy), "syy": total(oy * oy)}
    held_own = np.bincount(of, minlength=n) > 0
    start = np.searchsorted(of, np.flatnonzero(held_own))
    for c, v in (("x", ox), ("y", oy)):
        for f, end in ((np.minimum, "min"), (np.maximum, "max")):
            found = np.full(n, None, dtype=object)
            if len(start):
                found[held_own] = f.reduceat(v, start).tolist()
            columns[f"{c}_{end}"] = found.tolist()
    # The ends of a part's rows have the corners of its hull.
    line = np.ones(len(of), dtype=bool)
    line[1:] = (of[1:] != of[:-1]) | (oy[1:] != oy[:-1])
    at = np.flatnonzero(line)
    last = np.append(at[1:], len(of))[: len(at)] - 1
    cut_line = np.searchsorted(of[at], np.arange(n + 1)).tolist()
    left, right, where = ox[at].tolist(), (ox[last] + 1).tolist(), oy[at].tolist()
    hulls = []
    for k in range(n):
        ends = range(cut_line[k], cut_line[k + 1])
        corners = [(x, y) for i in ends for x in (left[i], right[i]) for y in (where[i], where[i] + 1)]
        hulls.append([{"x": x, "y": y} for x, y in convex_hull(corners)])
    cut_seam = np.searchsorted(seam[0], np.append(names, np.iinfo(np.int64).max)).tolist()
    seams_of = [{"pixel": p, "held": bool(t)} for p, t in zip(seam[1].tolist(), seam[2].tolist(), strict=True)]
    by_name = np.argsort(lines["name"], kind="stable")
    cut_edge = np.searchsorted(lines["name"][by_name], np.append(names, np.iinfo(np.int64).max)).tolist()
    shifted = [(lines[c][by_name] + d).tolist() for c, d in (("x0", col), ("y0", row), ("x1", col), ("y1", row))]
    edges = [{"x0": a, "y0": b, "x1": c, "y1": d} for a, b, c, d in zip(*shifted, strict=True)]
    columns["hull"] = hulls
    columns["seam"] = [seams_of[cut_seam[k] : cut_seam[k + 1]] for k in range(n)]
    columns["outline"] = [edges[cut_edge[k] : cut_edge[k + 1]] for k in range(n)]
    return columns


def parts(tiles: DataFrame, spec: TileSpec, wanted: list[int], diagonal: bool = False) -> DataFrame:
    """PARTS of tiles (sample_id, row, col, tile_h, tile_w, tile_mask, height, width); no exchange."""
    names = [f.split(" ")[0] for f in ("sample_id label node area sx sy sxx sxy syy x_min y_min x_max y_max hull seam outline").split()]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found: dict[str, list] = {c: [] for c in names}
            for t in frame.itertuples():
                if t.tile_mask is not None:
                    mask = np.asarray(t.tile_mask).reshape(t.tile_h, t.tile_w)
                    own = tile_parts(mask, t.row, t.col, t.height, t.width, spec, wanted, diagonal)
                    for c, values in own.items():
                        found[c] += values
                    found["sample_id"] += [t.sample_id] * len(own["node"])
            if found["node"]:
                yield pd.DataFrame(found, columns=names).astype({c: "Int32" for c in names if c[:2] in ("x_", "y_")})

    return tiles.select("sample_id", "row", "col", "tile_h", "tile_w", "tile_mask", "height", "width").mapInPandas(run, PARTS)


def links(found: DataFrame) -> DataFrame:
    """(sample_id, label, a, b): parts that meet at a seam's pixel (a handful of tiles hold one)."""
    at = found.select(*GROUP, "node", F.explode("seam").alias("s")).select(*GROUP, "node", "s.pixel", "s.held")
    met = at.groupBy(*GROUP, "pixel").agg(F.array_sort(F.collect_set("node")).alias("nodes"), F.max("held").alias("held"))
    met = met.filter("held and size(nodes) > 1")
    return met.select(*GROUP, F.explode(F.slice("nodes", 2, F.size("nodes"))).alias("a"), F.col("nodes")[0].alias("b")).distinct()


def with_objects(found: DataFrame) -> DataFrame:
    """The parts with object_id, the first pixel of their object."""
    of = components(links(found), GROUP)
    return found.join(of, [*GROUP, "node"], "left").withColumn("object_id", F.coalesce("component", "node")).drop("component")


def rings(x0: np.ndarray, y0: np.ndarray, x1: np.ndarray, y1: np.ndarray, diagonal: bool) -> list[list[tuple[int, int]]]:
    """Closed rings of directed segments, corners only: outer rings (clockwise on a screen) before holes, each from its least (y, x).

    Where two rings touch at a corner they stay apart, or are one if pixels that touch there are connected."""
    out: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for a, b, c, d in zip(x0.tolist(), y0.tolist(), x1.tolist(), y1.tolist(), strict=True):
        out.setdefault((a, b), []).append((c, d))
    found = []
    for first in sorted(out, key=lambda p: (p[1], p[0])):
        # The least point left is a corner with one way to go: whatever else met there lies higher up and is used.
        if first not in out:
            continue
        at, ring, step = first, [], None
        while not ring or at != first:
            ends = out[at]
            if len(ends) > 1:
                # Positive cross product: a turn to the right on a screen.
                ends.sort(key=lambda e: step[0] * (e[1] - at[1]) - step[1] * (e[0] - at[0]), reverse=not diagonal)
            to = ends.pop(0)
            if not ends:
                del out[at]
            way = ((to[0] > at[0]) - (to[0] < at[0]), (to[1] > at[1]) - (to[1] < at[1]))
            if way != step:
                ring.append(at)
            step, at = way, to
        found.append(ring)
    area = lambda r: sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(r, r[1:] + r[:1], strict=True))
    return sorted(found, key=lambda r: (area(r) <= 0, min((y, x) for x, y in r)))


def outlines(found: DataFrame, diagonal: bool = False) -> DataFrame:
    """(sample_id, label, object_id, rings, perimeter) from parts with object_id. Borders between parts cancel before an object's edges meet."""
    e = found.select(*GROUP, "object_id", F.explode("outline").alias("e")).select(*GROUP, "object_id", "e.*")
    turned = (F.col("x0") > F.col("x1")) | (F.col("y0") > F.col("y1"))
    ends = [F.when(turned, F.col(b)).otherwise(F.col(a)).alias(n) for a, b, n in (("x0", "x1", "xa"), ("y0", "y1", "ya"), ("x1", "x0", "xb"), ("y1", "y0", "yb"))]
    kept = e.select(*GROUP, "object_id", *ends, F.when(turned, -1).otherwise(1).alias("way"))
    kept = kept.groupBy(*GROUP, "object_id", "xa", "ya", "xb", "yb").agg(F.sum("way").alias("way")).filter("way <> 0")

    back = F.col("way") < 0
    line = F.struct(*[F.when(back, F.col(b)).otherwise(F.col(a)).alias(n) for a, b, n in (("xa", "xb", "x0"), ("ya", "yb", "y0"), ("xb", "xa", "x1"), ("yb", "ya", "y1"))])
    length = F.sum(F.abs(F.col("xb") - F.col("xa")) + F.abs(F.col("yb") - F.col("ya"))).cast("long")

    @F.pandas_udf(f"array<array<{POINT}>>")
    def trace(lines: pd.Series) -> pd.Series:
        closed = (rings(*(np.array([e[c] for e in own]) for c in ("x0", "y0", "x1", "y1")), diagonal) for own in lines)
        return pd.Series([[[{"x": x, "y": y} for x, y in r] for r in found] for found in closed])

    whole = kept.groupBy(*GROUP, "object_id").agg(F.collect_list(line).alias("lines"), length.alias("perimeter"))
    return whole.select(*GROUP, "object_id", trace("lines").alias("rings"), "perimeter")


def _axis(sign: int) -> Column:
    """Full length of an axis of the ellipse with the object's second moments (pixels as unit squares)."""
    n = F.col("area")
    xx = F.col("sxx") / n - (F.col("sx") / n) ** 2 + 1 / 12
    yy = F.col("syy") / n - (F.col("sy") / n) ** 2 + 1 / 12
    xy = F.col("sxy") / n - F.col("sx") * F.col("sy") / (n * n)
    root = F.sqrt(((xx - yy) / 2) ** 2 + xy * xy)
    return 4 * F.sqrt(F.greatest((xx + yy) / 2 + sign * root, F.lit(0.0)))


def metrics(found: DataFrame) -> DataFrame:
    """(sample_id, label, object_id, area, box, centroid_x, centroid_y, major_axis, minor_axis, hull, hull_area) from parts with object_id.

    Sums merge by partial aggregation; hulls by one array of corners for each part, a few points each."""
    sums = [F.sum(c).alias(c) for c in ("area", "sx", "sy", "sxx", "sxy", "syy")]
    box = [F.min("x_min").alias("x_min"), F.min("y_min").alias("y_min"), F.max("x_max").alias("x_max"), F.max("y_max").alias("y_max")]
    whole = found.groupBy(*GROUP, "object_id").agg(*sums, *box, F.flatten(F.collect_list("hull")).alias("corners"))

    @F.pandas_udf(f"array<{POINT}>")
    def merged(corners: pd.Series) -> pd.Series:
        return corners.map(lambda c: [{"x": x, "y": y} for x, y in convex_hull((p["x"], p["y"]) for p in c)])

    hull = whole.withColumn("hull", merged("corners"))
    ahead = F.concat(F.slice("hull", 2, F.size("hull")), F.slice("hull", 1, 1))
    doubled = F.aggregate(F.zip_with("hull", ahead, lambda p, q: (p["x"] * q["y"] - q["x"] * p["y"]).cast("long")), F.lit(0).cast("long"), lambda a, b: a + b)
    middle = [(F.col(s) / F.col("area") + 0.5).alias(c) for s, c in (("sx", "centroid_x"), ("sy", "centroid_y"))]
    return hull.select(*GROUP, "object_id", "area", "x_min", "y_min", "x_max", "y_max", *middle, _axis(1).alias("major_axis"), _axis(-1).alias("minor_axis"), "hull", (F.abs(doubled) / 2).alias("hull_area"))


def vectorise(tiles: DataFrame, spec: TileSpec, wanted: list[int], diagonal: bool = False) -> DataFrame:
    """The objects of all scenes with their metrics and outlines. Parts are labelled once and checkpointed."""
    found = cut(with_objects(cut(parts(tiles, spec, wanted, diagonal))))
    return metrics(found).join(outlines(found, diagonal), [*GROUP, "object_id"])
