import zlib

import numpy as np
import pyarrow as pa

from tarn.llm import quality
from tarn.llm.wordhash import Family, slices

SF = "/root/testdata/sf0.01"


def test_linear_time_identity():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((5, 12)).astype(np.float64)
    m = quality.Machine(0.5, None, None, 0.3, rng.standard_normal(12), rng.standard_normal((12, 3)))
    pairs = [sum(r[i] * r[j] * (m.factors[i] @ m.factors[j]) for i in range(12) for j in range(i)) for r in x]
    assert np.allclose(m._margin(x)[0], 0.3 + x @ m.linear + pairs)


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in quality.quality_scores(docs, labels).collect()}
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for d, r in got.items())
    held = [(got[r.doc_id].predicted, r.quality) for r in labels.collect() if got[r.doc_id].held_out]
    assert np.mean([p == q for p, q in held]) > 0.93


def test_held_out_labels_change_nothing(spark):
    from pyspark.sql import functions as F

    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    other = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert sorted(map(tuple, quality.quality_scores(docs, labels).collect())) == sorted(map(tuple, quality.quality_scores(docs, other).collect()))


def test_odd_inputs(spark):
    rows = [(1, None, "a"), (2, "", "b"), (2, "", "b"), (None, "some text", "c"), (4, "word " * 100_000, "d"), (5, "\n", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality string")
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, 0), (4, 1, 0), (None, 1, 1), (5, None, 0), (9, 7, 0)], "doc_id long, quality int, text int")
    got = quality.quality_scores(docs, labels).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    assert [r.score for r in quality.quality_scores(docs, labels.limit(0)).collect()] == [0.5] * 6
    assert quality.quality_scores(docs.limit(0), labels).count() == 0
    assert quality.keep_good(docs, labels.limit(0)).columns == docs.columns


def test_same_scores_in_any_batch():
    family = Family(quality.FAMILY, lower=True)
    texts = ["A b c c", "", "x!", "é | ü | ß " * 50]
    whole = [quality.features(o, r, family) for _, _, o, r in slices(pa.array(texts))][0]
    for i, t in enumerate(texts):
        one = [quality.features(o, r, family) for _, _, o, r in slices(pa.array([t]))][0]
        assert np.allclose(one[0][0], whole[0][i]) and np.allclose(one[1][0], whole[1][i])


def plain_features(text):
    """The same features from their description, one text at a time."""
    data = text.encode()
    kind = lambda b: next((k for k, has in enumerate([range(97, 123), range(65, 91), range(48, 58), b" \t\x0b\x0c", b"\n\r", b".,;:'\"-?"]) if b in has), 7 if b > 127 else {0x21: 8, 0x7C: 9}.get(b, 10 if b in b"()[]<>{}" else 6))
    words = data.split()
    hashed = [int(quality.word_hashes(np.array([0, len(w)]), np.frombuffer(w, np.uint8), [Family(quality.FAMILY, lower=True)]).hashes[0][0]) for w in words]
    n, buckets = max(len(words), 1), {}
    for h in hashed:
        buckets[h % quality.BUCKETS] = buckets.get(h % quality.BUCKETS, 0) + 1
    letter = lambda b: b > 127 or chr(b).isalnum()
    length = [len(w) for w in words]
    mean = sum(length) / n
    shares = [sum(kind(b) == k for b in data) / max(len(data), 1) for k in range(quality.KINDS)]
    lines = data.count(b"\n") + data.count(b"\r") + 1
    statistics = [
        *shares, np.log1p(len(words)), mean, np.sqrt(max(sum(x * x for x in length) / n - mean**2, 0)), sum(a == b for a, b in zip(hashed, hashed[1:], strict=False)) / n,
        sum(not letter(w[0]) for w in words) / n, sum(not letter(w[-1]) for w in words) / n, sum(len(w) > 1 and 65 <= w[0] < 91 and 65 <= w[-1] < 91 for w in words) / n,
        max(buckets.values(), default=0) / n, len(buckets) / min(n, quality.BUCKETS), np.log1p(len(words) / lines),
    ]
    row = np.zeros(quality.BUCKETS)
    for k, count in buckets.items():
        row[k] = np.sqrt(count / len(words))
    return row, np.array(statistics)


def test_features_equal_plain_ones():
    texts = ["The cat | sat (on) THE the the mat!", "", "  ", "One\nTwo\n\nthree 44 5.5 É ß", "x" * 500 + " AB-CD \"q\" <b>", "a a a a b"]
    hashed, statistics = next(quality.features(o, r, Family(quality.FAMILY, lower=True)) for _, _, o, r in slices(pa.array(texts)))
    for k, t in enumerate(texts):
        row, want = plain_features(t)
        assert np.allclose(hashed[k], row, atol=1e-6) and np.allclose(statistics[k], want)


def test_fit_lowers_the_loss_by_its_gradient():
    """Sparse rows are those they were made from, and the fitted machine has a smaller loss than the prior."""
    rng = np.random.default_rng(3)
    rows = np.where(rng.random((300, quality.BUCKETS)) < 0.01, 0.5, 0).astype(np.float32)
    label = (rows[:, :40].sum(axis=1) > 0.2).astype(np.int64)
    sparse = quality.Sparse.of([quality.Sparse.pack(r) for r in rows])
    assert (sparse.rows(np.arange(300)) == rows).all() and (sparse.rows(np.array([7, 2])) == rows[[7, 2]]).all()
    statistics = rng.standard_normal((300, quality.STATISTICS))
    p = quality.fit(sparse, statistics, label).scores(rows, statistics)
    loss = lambda q: -np.mean(label * np.log(q) + (1 - label) * np.log(1 - q))
    assert loss(np.clip(p, 1e-6, 1 - 1e-6)) < 0.5 * loss(np.full(300, label.mean()))
