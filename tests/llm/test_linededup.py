import hashlib
import random
import re

import numpy as np

from tarn.llm.linededup import dedup_lines, line_dedup_digest
from tarn.llm.perfecthash import PerfectHash


def key(line):
    return re.sub(r"[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))


def brute(texts, min_docs, min_chars=1):
    found = {}
    for text in texts:
        for k in {key(x) for x in (text or "").split("\n")}:
            found[k] = found.get(k, 0) + 1
    gone = {k for k, n in found.items() if n >= min_docs and len(k) >= min_chars}
    return [[x for x in (text or "").split("\n") if key(x) not in gone] for text in texts]


def fixture_rows():
    rng = random.Random(3)
    common = [f"Cookie notice {i} é" for i in range(12)] + ["", " \t", "x", " ", "ß\r"]
    rows = []
    for doc in range(300):
        lines = [rng.choice(common) if rng.random() < 0.5 else f"own line {rng.randrange(2000)}" for _ in range(rng.randrange(0, 12))]
        rows.append((doc // 2 if doc % 5 else None, "\n".join(rng.choice([x, x.upper(), f"  {x}\x0b"]) for x in lines)))
    rows += [(7, None), (7, ""), (8, "\n"), (9, "\n".join(f"long {i % 3000}" for i in range(30_000))), (10, "COOKIE NOTICE 1 É\ncookie notice 1 é")]
    return rows + [(500 + i, "same text\ntwice\nsame text") for i in range(100)]


def test_both_ways_equal_brute_force(spark):
    rows = fixture_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    for min_docs, min_chars in ((10, 1), (2, 3), (30, 0)):
        kept = brute([t for _, t in rows], min_docs, min_chars)
        want = sorted(((d, (t or "").count("\n") + 1, (t or "").count("\n") + 1 - len(k), hashlib.sha256("\n".join(k).encode()).hexdigest()) for (d, t), k in zip(rows, kept, strict=True)), key=str)
        for index_bytes in (1 << 20, 0):  # broadcast; asked of the shards
            got = line_dedup_digest(docs, min_docs, min_chars, index_bytes)
            assert sorted(map(tuple, got.collect()), key=str) == want


def test_whole_sample_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = {d: hashlib.sha256("\n".join(k).encode()).hexdigest() for (d, _), k in zip(rows, brute([t for _, t in rows], 10), strict=True)}
    assert {r.doc_id: r.kept_sha256 for r in line_dedup_digest(docs).collect()} == want


def test_rows_columns_and_empty_tables(spark):
    rows = [(1, "A\nb", "g"), (None, " a\nc", "h"), (1, None, None), (2, "", "g")]
    docs = spark.createDataFrame(rows, "name long, text string, gone string")
    for index_bytes in (1 << 20, 0):
        got = dedup_lines(docs, min_docs=2, index_bytes=index_bytes)
        assert got.columns == docs.columns
        assert sorted(map(tuple, got.collect()), key=str) == sorted([(1, "b", "g"), (None, "c", "h"), (1, None, None), (2, "", "g")], key=str)
        assert dedup_lines(docs.limit(0), index_bytes=index_bytes).count() == 0
    empty = spark.createDataFrame([], "doc_id long, text string, shard string")
    assert line_dedup_digest(empty).count() == 0


def test_perfect_hash_is_minimal_and_knows_its_keys():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 1000, 50_000):
        high, low = rng.integers(0, 2**63, (2, n), dtype=np.uint64)
        if n == 1000:
            high[:] = high[0]  # told apart by the other half
        table = PerfectHash.unpack(PerfectHash.build(high, low, np.arange(n)).pack())
        assert np.array_equal(np.sort(table.slots(high, low)), np.arange(n))
        assert np.array_equal(table.lookup(high, low), np.arange(n))
        assert not table.lookup(*rng.integers(0, 2**63, (2, 1000), dtype=np.uint64)).any()
        assert table.words.nbytes * 8 <= 8 * n + 640
