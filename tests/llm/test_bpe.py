import hashlib
import random

import public_tokenizers as P
import pytest

from tarn.llm import bpe

tiktoken = pytest.importorskip("tiktoken")
PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def known():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})


def hard_texts():
    rng = random.Random(3)
    alphabet = list("ab'stmdrevl  \n\t\r!?.,$0123") + ["'s", "'re", "'ll", "é", "ß", "日本", " ", " ", "\x85", "\x1c", "½", "٣", "😀", "é", "<|endoftext|>", "Ᲊ"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 60))) for _ in range(3000)]
    return [*texts, "", " ", "  ", " \n", "'", "''s", " 's", "\n's", "'s's're'vee", "$" * 5000, "ab" * 4000, " " * 3000, "x" * 100_000, "word " * 50_000]


def expected(known, text):
    ids = known.encode_ordinary(text or "")
    return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_digest_equals_library(spark, known):
    texts = [*hard_texts(), None]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(7, "again", "y"), (7, "again", "y")]
    got = bpe.encode_digest(spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(4), PATH).collect()
    assert sorted(map(tuple, got)) == sorted((i, *expected(known, t)) for i, t, _ in rows)


def test_sample_equals_library(spark, known):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = {r.doc_id: expected(known, r.text) for r in docs.collect()}
    assert {r.doc_id: tuple(r)[1:] for r in bpe.encode_digest(docs, PATH).collect()} == want


def test_round_trip_with_offsets(spark):
    rows = [(1, "It's  a test'll\n do", 5), (2, None, 6), (3, "", 7), (3, "日本 12", 8)]
    clash = spark.createDataFrame(rows, "doc_id long, text string, slice_offsets int")
    got = bpe.encode(clash, PATH)
    assert got.columns == [*clash.columns, "ids", "slice_offsets_", "slice_tokens"] and sorted(r.slice_offsets for r in got.collect()) == [5, 6, 7, 8]
    docs = clash.drop("slice_offsets")
    digests = bpe.encode(docs, PATH, digest=True).collect()
    assert all(r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest() for r in digests)
    out = bpe.decode(bpe.encode(docs, PATH), PATH)
    assert bpe.encode(docs.limit(0), PATH).count() == 0
    for r in out.collect():
        data = (r.text or "").encode()
        assert bytes(r.decoded) == data and sum(r.slice_tokens) == len(r.ids)
        assert list(r.slice_offsets) == sorted(set(r.slice_offsets)) and (not data or r.slice_offsets[0] == 0)


def test_cache_without_decimals_holds_ids_alone():
    ranks = {bytes([i]): i for i in range(256)}
    lean, full = bpe.Merger(ranks, decimals=False), bpe.Merger(ranks)
    for piece in (b"abc", b"x" * 300, b"", b"abc"):
        assert lean(piece) == full(piece)[0]
    assert lean.young == {b"abc": (97, 98, 99), b"": ()}
    assert full.young[b"abc"] == ((97, 98, 99), b"97,98,99")
