import numpy as np
import pytest
from pyspark.sql import functions as F

from tarn.model import TileSpec
from tarn.operators import objects, tiling
from tarn.operators.components import components


def flood(mask, wanted, diagonal):
    """Objects by flood fill over the whole scene: (label, first pixel) -> set of (y, x)."""
    h, w = mask.shape
    steps = [(-1, 0), (1, 0), (0, -1), (0, 1)] + ([(-1, -1), (-1, 1), (1, -1), (1, 1)] if diagonal else [])
    seen, out = set(), {}
    for y in range(h):
        for x in range(w):
            if mask[y, x] in wanted and (y, x) not in seen:
                todo, own = [(y, x)], set()
                seen.add((y, x))
                while todo:
                    a, b = todo.pop()
                    own.add((a, b))
                    for dy, dx in steps:
                        p = (a + dy, b + dx)
                        if 0 <= p[0] < h and 0 <= p[1] < w and p not in seen and mask[p] == mask[y, x]:
                            seen.add(p)
                            todo.append(p)
                out[int(mask[y, x]), y * w + x] = own
    return out


def filled(rings, h, w):
    """Pixels inside the rings by the even-odd rule at pixel centres."""
    odd = np.zeros((h, w), dtype=bool)
    for ring in rings:
        for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1], strict=True):
            if ax == bx:
                odd[min(ay, by) : max(ay, by), :ax] ^= True
            else:
                assert ay == by
    return odd


def snake(h, w):
    """One line through the whole scene, back and forth."""
    mask = np.zeros((h, w), dtype=np.int16)
    mask[::4] = 1
    mask[2::8, w - 1] = mask[1::8, w - 1] = mask[3::8, w - 1] = 1
    mask[5::8, 0] = mask[6::8, 0] = mask[7::8, 0] = 1
    return mask


def scenes(spark, masks):
    rows = [(name, m.shape[0], m.shape[1], m.ravel().tolist(), []) for name, m in masks.items()]
    return spark.createDataFrame(rows, "sample_id string, height int, width int, mask array<smallint>, bands array<array<float>>")


@pytest.mark.parametrize(("size", "overlap", "diagonal"), [(16, 4, False), (16, 0, True), (8, 1, False), (7, 5, True), (64, 8, False)])
def test_objects_equal_the_whole_scene(spark, size, overlap, diagonal):
    rng = np.random.default_rng(size)
    masks = {"noise": rng.choice([0, 1, 2, 3], (40, 50), p=[0.3, 0.5, 0.15, 0.05]).astype(np.int16), "snake": snake(43, 37), "full": np.ones((33, 20), dtype=np.int16), "none": np.zeros((9, 9), dtype=np.int16)}
    spec = TileSpec(size=size, overlap=overlap)
    got = objects.vectorise(tiling.tile_masks(scenes(spark, masks), spec), spec, [1, 3], diagonal).collect()
    want = {(name, *key): own for name, m in masks.items() for key, own in flood(m, (1, 3), diagonal).items()}
    assert {(r.sample_id, r.label, r.object_id) for r in got} == set(want) and len(got) == len(want)
    for r in got:
        own = want[r.sample_id, r.label, r.object_id]
        ys, xs = (np.array(v) for v in zip(*own, strict=True))
        assert (r.area, r.x_min, r.y_min, r.x_max, r.y_max) == (len(own), xs.min(), ys.min(), xs.max(), ys.max())
        assert r.centroid_x == pytest.approx(xs.mean() + 0.5) and r.centroid_y == pytest.approx(ys.mean() + 0.5)
        values = np.linalg.eigvalsh(np.cov(np.stack([xs, ys]), bias=True) + np.eye(2) / 12)
        assert (r.minor_axis, r.major_axis) == pytest.approx(tuple(4 * np.sqrt(np.maximum(values, 0))), abs=1e-6)
        h, w = masks[r.sample_id].shape
        inside = filled([[(p.x, p.y) for p in ring] for ring in r.rings], h, w)
        assert set(zip(*np.nonzero(inside), strict=True)) == own
        corners = [(int(x) + i, int(y) + j) for y, x in own for i in (0, 1) for j in (0, 1)]
        assert sorted((p.x, p.y) for p in r.hull) == sorted(objects.convex_hull(corners))
        assert r.perimeter == sum((y + dy, x + dx) not in own for y, x in own for dy, dx in ((-1, 0), (1, 0), (0, -1), (0, 1)))


def test_rings_at_touching_corners():
    checks = np.array([[1, 0], [0, 1]])
    for diagonal, n in ((False, 1), (True, 1)):
        named = objects.label_parts(checks, [1], diagonal)
        e = objects._outline(named)
        for name in np.unique(named[named >= 0]):
            own = e["name"] == name
            assert len(objects.rings(*(e[k][own] for k in ("x0", "y0", "x1", "y1")), diagonal)) == n
    assert objects.label_parts(checks, [1], False).max() == 3 and objects.label_parts(checks, [1], True).max() == 0


def test_hull_and_empty(spark):
    assert objects.convex_hull([(0, 0), (2, 0), (2, 2), (0, 2), (1, 1), (1, 0)]) == [(0, 0), (2, 0), (2, 2), (0, 2)]
    spec = TileSpec(size=4, overlap=1)
    tiles = tiling.tile_masks(scenes(spark, {"a": np.ones((4, 4), dtype=np.int16)}), spec)
    assert objects.vectorise(tiles.limit(0), spec, [1]).count() == 0
    assert objects.parts(tiles.withColumn("tile_mask", F.lit(None).cast("array<smallint>")), spec, [1]).count() == 0


def test_pixels_do_not_leave_their_tile(spark):
    spec = TileSpec(size=4, overlap=1)
    tiles = tiling.tile_masks(scenes(spark, {"a": np.ones((9, 9), dtype=np.int16)}), spec)
    assert "Exchange" not in objects.parts(tiles, spec, [1])._jdf.queryExecution().executedPlan().toString()


def test_components_of_groups(spark):
    rng = np.random.default_rng(2)
    rows = [(g, int(a), int(b)) for g in ("x", "y") for a, b in rng.integers(0, 300, (200, 2))] + [("z", i, i + 1) for i in range(500)] + [("h", 0, i) for i in range(400)] + [("l", 7, 7)]
    want = {}
    for g, a, b in rows:
        if a != b:
            pa, pb = want.setdefault((g, a), {a}), want.setdefault((g, b), {b})
            if pa is not pb:
                pa |= pb
                for n in pb:
                    want[g, n] = pa
    got = {(r.g, r.node): r.component for r in components(spark.createDataFrame(rows, "g string, a long, b long"), ["g"]).collect()}
    assert got == {k: min(v) for k, v in want.items()}


def test_tiles_of_equal_scenes_share_their_layout():
    spec = TileSpec(size=4, overlap=1)
    (rows, cols), (of_row, of_col) = objects._layout(8, 3, spec)
    assert rows.tolist() == [0, 3, 4] and cols.tolist() == [0]
    assert np.flatnonzero(of_row).tolist() == [0, 3, 4, 6, 7] and np.flatnonzero(of_col).tolist() == [0, 2]
    known = objects._layout.cache_info().misses
    for row in (0, 3, 4):
        objects.tile_parts(np.ones((4, 3), dtype=np.int16), row, 0, 8, 3, spec, [1], False)
    assert objects._layout.cache_info().misses == known
