import numpy as np
import pytest
from pyspark.sql import functions as F

from tarn.functions import geometry, physics
from tarn.model import SchemaError
from tarn.operators import kernels as K
from tarn.operators import raster


def clamped(x, r, c):
    return x[min(max(r, 0), x.shape[0] - 1), min(max(c, 0), x.shape[1] - 1)]


def window(x, r, c, k):
    return [clamped(x, r + i, c + j) for i in range(-(k // 2), k - k // 2) for j in range(-(k // 2), k - k // 2)]


@pytest.mark.parametrize("shape", [(8, 8), (5, 11), (1, 7)])
def test_box_and_rank_equal_first_principles(shape):
    x = np.random.default_rng(1).normal(size=shape)
    for k in (1, 2, 3, 5):
        box, rank = K.box_mean(x[None], k)[0], K.rank_filter(x[None], k, 85.0)[0]
        for r in range(shape[0]):
            for c in range(shape[1]):
                w = sorted(window(x, r, c, k))
                assert box[r, c] == pytest.approx(np.mean(w)) and rank[r, c] == w[min(int(k * k * 0.85), k * k - 1)]


def test_blocks_upsample_and_distance():
    x = np.random.default_rng(2).normal(size=(7, 10))
    padded = np.pad(x, ((0, 2), (0, 2)), mode="edge")
    assert np.allclose(K.block_mean(x[None], 3)[0], [[padded[r : r + 3, c : c + 3].mean() for c in range(0, 12, 3)] for r in range(0, 9, 3)])
    y = K.upsample(np.array([[[0.0, 1.0], [2.0, 3.0]]]), 3, 5)[0]
    assert y[0, 0] == 0 and y[-1, -1] == 3 and y[1, 2] == 1.5
    land = np.random.default_rng(3).random((12, 9)) < 0.05
    land[4, 4] = True
    want = [[min(np.hypot(r - a, c - b) for a, b in np.argwhere(land)) * 0.01 for c in range(9)] for r in range(12)]
    assert np.allclose(K.distance_to_land_km(land[None])[0], want)
    assert (K.distance_to_land_km(np.zeros((1, 3, 3), dtype=bool)) == 1000).all()


def scene(wind=7.0, damping=9.0, size=512, seed=1):
    rng = np.random.default_rng(seed)
    y, x = np.mgrid[0:size, 0:size]
    a = np.radians(25)
    dy, dx = y - 0.45 * size, x - 0.55 * size
    oil = ((dx * np.cos(a) + dy * np.sin(a)) / (0.30 * size)) ** 2 + ((dy * np.cos(a) - dx * np.sin(a)) / (0.18 * size)) ** 2 < 1
    s = physics.forward_array(wind, 45.0, 35.0) * np.where(oil, 10 ** (-damping / 10), 1.0)
    return 10 * np.log10(np.maximum(s * rng.exponential(size=s.shape), 1e-12)), oil


def test_recovery_from_speckle():
    vv, oil = scene()
    d = K.damping_db(vv[None], 64)[0]
    assert 6 < np.median(d[oil]) < 12 and abs(np.median(d[~oil])) < 2.5 and np.median(d[oil]) - np.median(d[~oil]) > 5
    for wind in (4.0, 7.0, 9.5):
        vv, _ = scene(wind, 0.0, 384)
        assert abs(np.median(K.wind_ms(vv[None], np.full((1, 384, 384), 35.0))[0]) - wind) < 0.9


def test_column_forms_agree(spark):
    rng = np.random.default_rng(4)
    rows = [(i, 6, 8, rng.normal(size=48).tolist()) for i in range(3)] + [(3, 2, 2, [1.0, 2.0, 3.0, 4.0]), (4, 2, 2, None)]
    df = spark.createDataFrame(rows, "k int, height int, width int, a array<double>")
    got = {r.k: r.m for r in df.select("k", raster.multilook(F.col("a"), F.col("height"), F.col("width"), 5).alias("m")).collect()}
    assert got[4] is None and np.allclose(got[3], K.box_mean(np.array([[[1.0, 2], [3, 4]]]), 5).ravel())
    same = {r.k: r.m for r in df.filter("k < 3").select("k", raster.box_mean_native(F.col("a"), 6, 8, 5).alias("m")).collect()}
    assert all(np.allclose(same[k], got[k]) for k in same)


def test_feature_stack(spark):
    vv = scene(size=64)[0].ravel().tolist()
    df = spark.createDataFrame([(64, 64, vv, [0, 1] * 2048)], "height int, width int, vv_db array<double>, land array<int>")
    full = raster.feature_stack(df)
    assert [c for c in full.columns if c.startswith("ch_")] == ["ch_vv_db", "ch_incidence_deg", "ch_wind_ms", "ch_damping_db", "ch_local_var_db"]
    assert all(len(v) == 4096 for v in full.first()[4:])
    assert raster.feature_stack(df, ("dist_land_km",), land="land").first().ch_dist_land_km[0] == pytest.approx(0.01)
    with pytest.raises(SchemaError, match="unknown"):
        raster.feature_stack(df, ("nonsense",))
    with pytest.raises(SchemaError, match="inputs"):
        raster.feature_stack(df, ("vh_db",))
    assert "ArrowEvalPython" not in raster.feature_stack(df, ("incidence_deg",))._jdf.queryExecution().toString()


def test_polygons(spark):
    ring = [(1.0, 1.0), (6.0, 1.5), (3.0, 6.5)]
    inside = K.polygon_mask([ring], 8, 8)
    df = spark.createDataFrame([(i % 8, i // 8, [ring]) for i in range(64)], "x int, y int, rings array<array<struct<x double, y double>>>")
    got = df.select("x", "y", geometry.inside_rings(F.col("x").cast("double"), F.col("y").cast("double"), F.col("rings")).alias("v")).collect()
    assert 5 < inside.sum() < 30 and all(inside[r.y, r.x] == r.v for r in got)
    with pytest.raises(Exception, match="not a polygon"):
        spark.createDataFrame([("POINT (1 2)",)], "w string").select(geometry.wkt_rings(F.col("w"))).collect()
    at = spark.createDataFrame([(105.0, 40.0, [100.0, 0.5, 0.0, 50.0, 0.0, -2.0])], "x double, y double, t array<double>")
    assert tuple(at.select(geometry.to_pixel(F.col("x"), F.col("y"), F.col("t")).alias("p")).first().p) == (10.0, 5.0)


def test_distance_and_polygons_equal_brute_force():
    rng = np.random.default_rng(0)
    for shape, p in (((3, 20, 25), 0.02), ((2, 7, 9), 0.3), ((1, 30, 30), 0.002), ((2, 5, 1), 0.4), ((2, 1, 8), 0.3)):
        land = rng.random(shape) < p
        got = K.distance_to_land_km(land, 1000.0)
        for k in range(shape[0]):
            at = np.argwhere(land[k])
            grid = np.stack(np.mgrid[0 : shape[1], 0 : shape[2]], axis=-1)
            want = np.sqrt(((grid[:, :, None] - at[None, None]) ** 2).sum(-1)).min(-1) if len(at) else np.full(shape[1:], K.NO_LAND_KM)
            assert np.allclose(got[k], want)
    for k in range(60):
        rings = [[tuple(map(float, q)) for q in (rng.uniform(-5, 25, (5, 2)) if k % 2 else rng.integers(-3, 23, (rng.integers(1, 7), 2)))] for _ in range(rng.integers(0, 3))]
        want = np.zeros((17, 21), dtype=bool)
        for y in range(17):
            for x in range(21):
                for ring in rings:
                    odd = False
                    for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1], strict=True):
                        if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
                            odd = not odd
                    want[y, x] |= odd
        assert np.array_equal(K.polygon_mask(rings, 17, 21), want)
