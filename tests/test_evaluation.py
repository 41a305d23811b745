import random

import numpy as np
import pytest

from tarn.operators import evaluation as E
from tarn.operators.objects import convex_hull


def sampled_iou(a, b, n=200_000):
    """Intersection over union by points on a fine lattice."""
    rng = np.random.default_rng(0)
    p = rng.uniform(-1, 11, (n, 2))

    def inside(ring):
        odd = np.zeros(n, dtype=bool)
        for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1], strict=True):
            if ay != by:
                odd ^= ((ay > p[:, 1]) != (by > p[:, 1])) & (p[:, 0] < (bx - ax) * (p[:, 1] - ay) / (by - ay) + ax)
        return odd

    u, v = inside(a), inside(b)
    return (u & v).sum() / max((u | v).sum(), 1)


def hull(rng):
    return [tuple(map(float, p)) for p in convex_hull([(rng.randrange(11), rng.randrange(11)) for _ in range(7)])]


def test_iou_of_polygons():
    rng = random.Random(2)
    for _ in range(40):
        a, b = hull(rng), hull(rng)
        assert E.iou(a, b) == pytest.approx(sampled_iou(a, b), abs=0.01)
        assert E.iou(a[::-1], b) == pytest.approx(E.iou(a, b)) == pytest.approx(E.iou(a, b[::-1]))
    hook = [(0.0, 0.0), (6.0, 0.0), (6.0, 1.0), (1.0, 1.0), (1.0, 5.0), (6.0, 5.0), (6.0, 6.0), (0.0, 6.0)]
    box = [(0.5, 0.5), (5.0, 0.5), (5.0, 5.5), (0.5, 5.5)]
    assert E.iou(hook, box) == pytest.approx(sampled_iou(hook, box), abs=0.01)
    assert E.iou(box, box) == 1 and E.iou(box, [(20.0, 20.0), (21.0, 20.0), (21.0, 21.0)]) == 0


def test_ious_of_many_pairs_equal_single_ones():
    rng = random.Random(6)
    hook = [(0.0, 0.0), (6.0, 0.0), (6.0, 1.0), (1.0, 1.0), (1.0, 5.0), (6.0, 5.0), (6.0, 6.0), (0.0, 6.0)]
    box = lambda x, y, w, h: [(x, y), (x + w, y), (x + w, y + h), (x, y + h)]
    boxes = [box(*(float(rng.randrange(1, 9)) for _ in range(4))) for _ in range(300)]
    for a, b in ((boxes[:150], boxes[150:]), ([hook] * 300, boxes), ([hook[::-1]] * 300, [x[::-1] for x in boxes])):
        assert E.ious(np.array(a), np.array(b)).tolist() == pytest.approx([E.iou(x, y) for x, y in zip(a, b, strict=True)], abs=1e-14)


@pytest.mark.parametrize(("cell", "hot"), [(3.0, 10_000), (50.0, 5), (0.7, 2)])
def test_overlaps_equal_all_pairs(spark, cell, hot):
    rng = random.Random(5)

    def some(n):
        out = []
        for i in range(n):
            dx, dy = rng.randrange(-30, 30), rng.randrange(-30, 30)
            out.append((rng.choice("ab"), i, [(x + dx, y + dy) for x, y in hull(rng)]))
        return out

    found, true = some(60), some(50)
    ring = "ring array<struct<x:double,y:double>>"
    f = spark.createDataFrame([*found, ("a", 900, None), ("a", 901, [(0.0, 0.0)])], f"scene string, found_id long, {ring}")
    t = spark.createDataFrame(true, f"scene string, true_id long, {ring}").repartition(3)
    got = E.overlaps(f, t, cell, 0.05, hot).collect()
    want = {(s, i, k): E.iou(a, b) for s, i, a in found for u, k, b in true if s == u and E.iou(a, b) >= 0.05}
    assert {(r.scene, r.found_id, r.true_id): r.iou for r in got} == pytest.approx(want) and len(got) == len(want) > 20
    for s, i, _ in found:
        order = sorted((r for r in got if (r.scene, r.found_id) == (s, i)), key=lambda r: r.rank)
        assert [r.true_id for r in order] == [r.true_id for r in sorted(order, key=lambda r: (-r.iou, r.true_id))]
        assert [r.rank for r in order] == list(range(1, len(order) + 1))


def test_false_alarms(spark):
    rng = random.Random(1)
    rows = [(rng.choice("xy"), rng.random(), rng.random() < 0.3) for _ in range(500)] + [("x", 1.0, True), ("n", 0.5, False), ("x", None, True), ("y", 0.3, None)]
    area = spark.createDataFrame([("x", 500.0), ("n", 10.0)], "wind_class string, km2 double")
    got = {r.wind_class: r for r in E.false_alarms(spark.createDataFrame(rows, "wind_class string, score double, hit boolean"), area, 0.9, 50).collect()}
    for c in "xy":
        own = [(min(int(s * 50), 49), h) for k, s, h in rows if k == c and s is not None and h is not None]
        total = sum(h for _, h in own)
        edge = max(b for b in {b for b, _ in own} if sum(h for k, h in own if k >= b) >= 0.9 * total)
        alarms = sum(not h for k, h in own if k >= edge)
        assert got[c].threshold == edge / 50 and got[c].false_alarms == alarms
    assert got["x"].per_1000_km2 == 1000 * got["x"].false_alarms / 500 and got["y"].per_1000_km2 is None and got["n"].threshold is None


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_isotonic_equals_the_sequential_algorithm(spark, parts):
    rng = random.Random(4)
    for rows in ([(x := rng.random(), rng.random() < x * x) for _ in range(800)], [(i / 50, i % 3 == 0) for i in range(50)], [(i / 50, i >= 25) for i in range(50)], [(i / 50, i < 25) for i in range(50)], [(0.5, True)] * 3, []):
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        try:
            got = E.isotonic(spark.createDataFrame([*rows, (None, True), (0.4, None)], "score double, hit boolean").repartition(4), digits=3, fan=2).collect()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
        points = {}
        for x, y in rows:
            s = points.setdefault(float(f"{x:.3f}"), [0, 0])
            s[0] += y
            s[1] += 1
        blocks = []
        for x in sorted(points):
            blocks.append([x, x, *points[x]])
            while len(blocks) > 1 and blocks[-2][2] * blocks[-1][3] >= blocks[-1][2] * blocks[-2][3]:
                b = blocks.pop()
                blocks[-1] = [blocks[-1][0], b[1], blocks[-1][2] + b[2], blocks[-1][3] + b[3]]
        want = [(b[0], b[1], b[2] / b[3], b[3]) for b in blocks]
        got = sorted((r.low, r.high, r.value, r.weight) for r in got)
        assert len(got) == len(want) and np.allclose(np.array(got), np.array(want))


def test_late_passes_merge(spark):
    rng = random.Random(7)
    rows = [(rng.choice(["p", "q", None]), rng.choice([rng.randrange(100), rng.randrange(100_000), None]), rng.choice([True, False, None])) for _ in range(3000)]
    frame = lambda part: spark.createDataFrame(part, "cell string, pass_no long, hit boolean")
    state = E.passes(frame(rows[:1500]))
    for late in (rows[1500:2500], rows[2500:], rows[:10]):
        state = E.merge_passes(state, E.passes(frame(late)))
    got = {r.cell: (r.n_passes, r.n_hits, r.recurrent) for r in E.recurrence(state, share=0.4).collect()}
    for c in "pq":
        seen = {p for k, p, _ in rows if k == c and p is not None}
        hit = {p for k, p, h in rows if k == c and p is not None and h}
        assert got[c] == (len(seen), len(hit), len(hit) >= 0.4 * len(seen))
    assert set(got) == {"p", "q"}
