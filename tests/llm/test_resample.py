import hashlib
import math
import random
import re
import zlib

import numpy as np

from tarn.llm import resample as module
from tarn.llm.resample import GainPlanes, bucket_counts, resample, resampling_digest


def words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def feats(text):
    w = words(text)
    return [zlib.crc32(g.encode()) % 10000 for g in w + [f"{a} {b}" for a, b in zip(w, w[1:], strict=False)]]


def brute(docs, target):
    s, t = [0] * 10000, [0] * 10000
    for texts, total in (([d[1] for d in docs], s), (target, t)):
        for text in texts:
            for b in feats(text):
                total[b] += 1
    gain = [math.floor(1000 * math.log((y + 1) * (sum(s) + 10000) / ((x + 1) * (sum(t) + 10000)))) for x, y in zip(s, t, strict=True)]
    rows = []
    for doc, text in docs:
        f = feats(text)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        score = None
        if doc is not None:
            h = int(hashlib.sha256(f"7:{doc}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc, len(f), weight, score, None])
    able = sorted((r for r, (_, text) in zip(rows, docs, strict=True) if len(words(text)) >= 20 and r[3] is not None), key=lambda r: (-r[3], r[0], r[1]))
    for k, r in enumerate(able[: 25 * len(able) // 100]):
        r[4] = k + 1
    return sorted(map(tuple, rows), key=str)


def fixture_docs():
    rng = random.Random(9)
    vocab = [f"w{i}" for i in range(80)] + ["É", "ΑΒ", "naïve", "X9", "don't"]
    docs = [(i, rng.choice([" ", "-", "\n", "  "]).join(rng.choice(vocab) for _ in range(rng.randrange(0, 60)))) for i in range(300)]
    return docs + [(300, None), (301, ""), (302, " ... "), (None, "w1 " * 30), (303, "w1 " * 200_000), (5, docs[5][1]), (5, "w2 w3 " * 20), (-4, "W1 w1_w1")]


def test_digest_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(module, "SLICE", 1000)
    docs, target = fixture_docs(), ["W1 w2 w3", None, "é naïve", "w7"]
    got = resampling_digest(spark.createDataFrame(docs, "doc_id long, text string").repartition(6), spark.createDataFrame([(t,) for t in target], "text string"))
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, target)


def test_whole_sample_equals_brute_force(spark):
    docs, target = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "benchmark"))
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in target.collect()])
    assert sorted(map(tuple, resampling_digest(docs, target).collect()), key=str) == want


def test_slices_lose_no_feature(monkeypatch):
    text = "alpha BETA, gamma'delta é9 " * 50
    for size in (1, 7, 64, 10_000):
        monkeypatch.setattr(module, "SLICE", size)
        counts, n = bucket_counts(text.encode())
        assert n == len(words(text)) and np.array_equal(counts, np.bincount(feats(text), minlength=10000))


def test_planes_sum_exactly():
    rng = np.random.default_rng(0)
    for top in (0, 1, 5000, 40_000):
        gains = rng.integers(-top, top + 1, 10_000)
        counts = rng.integers(0, 3000, (5, 10_000)) * (rng.random((5, 10_000)) < 0.1)
        assert np.array_equal(GainPlanes(gains).sums(counts), counts @ gains)


def test_drawn_rows_keep_their_columns(spark):
    docs = [(i, f"w{i % 7} word " * 15, "x") for i in range(40)] + [(90, "short", None), (None, "w1 " * 30, "n")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, score string")
    target = spark.createDataFrame([("w3 word",)], "text string")
    got = resample(frame, target)
    ranks = {r.doc_id for r in resampling_digest(frame, target).filter("rank is not null").collect()}
    assert got.columns == frame.columns and {r.doc_id for r in got.collect()} == ranks and len(ranks) == 10
    assert resample(frame.limit(0), target.limit(0)).count() == 0 and resampling_digest(frame.limit(0), target).count() == 0
