import math
import random

import numpy as np

from tarn.llm import bitsliced
from tarn.llm.bitsliced import Block, top_k


def brute(rows, k, every=50):
    q = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (i, v) in enumerate(q):
        if i % every == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j) for m, (j, w) in enumerate(q) if m != n and len(v) == len(w))
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best[:k])]
    return sorted(out)


def test_block_scores_and_ties():
    rng = np.random.default_rng(0)
    x = rng.integers(-200, 200, (300, 7))
    x[50:90] = x[10]
    ids = np.arange(300) * 3
    block = Block.load(Block.build(ids, ids + 5, x).dump(), 7)
    for q in (x[10], rng.integers(-50, 50, 7), np.zeros(7, dtype=np.int64)):
        got, score = block.top(q, 20, 35)
        want = sorted((-int(x[r] @ q), int(ids[r])) for r in range(300) if ids[r] != 30)[:20]
        assert sorted(zip((-score).tolist(), got.tolist(), strict=True)) == want


def test_equals_brute_force(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(i, [round(rng.gauss(0, 0.3), 3) for _ in range(6)]) for i in range(-60, 260)]
    rows += [(1000 + i, [0.25] * 6) for i in range(40)] + [(500, None), (550, [1.0, None] + [0.0] * 4), (600, [float("nan")] * 6), (650, [float("inf")] * 6), (None, [0.1] * 6), (700, []), (750, [3.0, -2.0]), (751, [1.0, 1.0]), (800, [1.0])]
    rows += [rows[5], (100, [0.0] * 6), (100, [9.0] * 6), (100, [9.0] * 6), (700, []), (7, []), (7, [8.5] * 6)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, rank int").repartition(5)
    from pyspark.sql import functions as F

    monkeypatch.setattr(bitsliced, "CHUNK", 3)
    monkeypatch.setattr(bitsliced, "GROUP", 2)
    for block in (64, 100_000):
        assert sorted(tuple(r) for r in top_k(df, F.col("vec_id") % 50 == 0, 5, block=block).collect()) == brute(rows, 5)
    assert top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0
