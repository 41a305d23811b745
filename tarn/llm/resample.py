"""Importance resampling towards a target distribution over hashed word features.

Features are all words and pairs of neighbouring words, hashed (CRC-32) into BUCKETS buckets. A bucket's gain is the log ratio
of its share in the target and in the documents, times 1000, floored; a document's weight is the floored mean of the gains of
its features. Rows with the highest weight plus Gumbel noise (fixed by the id) are drawn, so the draw is weighted sampling
without replacement.

Method: bit-sliced aggregation. A document's bucket counts become planes of BUCKETS bits, one for each binary digit of a
count; gains are planes of the digits of two's complement, whose last plane counts negative. The weighted sum is
sum over i, j of 2^(i+j) * popcount(count plane i AND gain plane j), in integers, so it is exact. Gains (BUCKETS numbers, a fixed
size) are broadcast; texts are read twice and never shuffled. Counts of the corpus meet as at most BUCKETS rows from each task.
The draw ranks narrow rows by range.

Defined results: a null text or one without words has no features and weight 0; a null id has no noise, so no score, and is
neither counted in the draw nor drawn; equal scores go by id, rows equal in both by their number of features; an empty table
gives an empty result, an empty target is a target without features; extra columns are ignored or, in `resample`, kept.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import arrow_stage, fresh, materialise, whole_texts
from .ranks import ranked

BUCKETS = 10_000
MIN_WORDS, PERCENT, SEED = 20, 25, 7
#: Bytes of text whose words are taken apart at a time.
SLICE = 1 << 19
#: Documents whose planes are held at a time.
GROUP = 64
#: What a byte is to the word pattern: A-Z as a-z, digits, a-z and all bytes of other characters as they are, else a blank.
TABLE = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()


def _slices(text: bytes) -> Iterator[bytes]:
    """text in pieces of about SLICE bytes that end at a blank, whole."""
    at = 0
    while at < len(text):
        end = text.find(b" ", at + SLICE)
        end = len(text) if end < 0 else end
        yield text[at:end]
        at = end


def features(text: bytes) -> Iterator[np.ndarray]:
    """Hashes of the words and of the pairs of neighbouring words of a text, some at a time: the words' and the pairs' in turn."""
    last = None
    for piece in _slices(text.translate(TABLE)):
        words = piece.split()
        if not words:
            continue
        own = list(map(zlib.crc32, words))
        yield np.array(own, dtype=np.int64)
        led = list(map(zlib.crc32, itertools.repeat(b" "), own))
        pairs = list(map(zlib.crc32, words[1:], led))
        if last is not None:
            pairs.append(zlib.crc32(words[0], last))
        last = led[-1]
        yield np.array(pairs, dtype=np.int64)


def bucket_counts(text: bytes, buckets: int = BUCKETS) -> tuple[np.ndarray, int]:
    """Features in each bucket, and the number of words."""
    total, words = np.zeros(buckets, dtype=np.int64), 0
    for k, hashes in enumerate(features(text)):
        total += np.bincount(hashes % buckets, minlength=buckets)
        words += 0 if k % 2 else len(hashes)
    return total, words


def corpus_counts(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts in each bucket; texts: (text)."""

    def make():
        def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(buckets, dtype=np.int64)
            for batch in batches:
                for text in batch.column(0):
                    for hashes in features(text.as_buffer().to_pybytes()):
                        total += np.bincount(hashes % buckets, minlength=buckets)
            met = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(met, pa.int32()), pa.array(total[met], pa.int64())], ["bucket", "found"])

        return stage

    out = np.zeros(buckets, dtype=np.int64)
    for row in arrow_stage(texts, make, "bucket int, found long").groupBy("bucket").agg(F.sum("found").alias("found")).collect():
        out[row.bucket] = row.found
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of each bucket's share in the target over that in the corpus), every bucket counted once more."""
    s, t, n = corpus.astype(float), target.astype(float), float(len(corpus))
    return np.floor(1000 * np.log((t + 1) * (s.sum() + n) / ((s + 1) * (t.sum() + n)))).astype(np.int64)


def planes(values: np.ndarray, digits: int) -> np.ndarray:
    """The binary digits of values (last axis: buckets), lowest first, as planes of packed bits: shape (..., digits, words)."""
    bits = (values[..., None, :] >> np.arange(digits)[:, None]) & 1
    packed = np.packbits(bits.astype(np.uint8), axis=-1, bitorder="little")
    short = -packed.shape[-1] % 8
    return np.pad(packed, [(0, 0)] * (packed.ndim - 1) + [(0, short)]).view(np.uint64)


class GainPlanes:
    """Gains as planes of two's complement digits."""

    def __init__(self, values: np.ndarray) -> None:
        self.digits = int(np.abs(values).max(initial=0)).bit_length() + 1
        self.planes = planes(values, self.digits)
        self.worth = np.left_shift(1, np.arange(self.digits, dtype=np.int64))
        self.worth[-1] = -self.worth[-1]

    def sums(self, counts: np.ndarray) -> np.ndarray:
        """Sum of count * gain over the buckets, for each row of counts."""
        out = np.zeros(len(counts), dtype=np.int64)
        for digit in range(int(counts.max(initial=0)).bit_length()):
            plane = planes(counts >> digit, 1)
            met = np.bitwise_count(plane & self.planes[None]).sum(axis=-1, dtype=np.int64)
            out += (met @ self.worth) << digit
        return out


def _noise(key: Column, seed: int) -> Column:
    """floor(-1000 * ln(-ln(u))), u fixed by the seed and the id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), key.cast("string")), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def weighed(docs: DataFrame, target: DataFrame, seed: int = SEED, buckets: int = BUCKETS) -> DataFrame:
    """docs: (doc_id long, text string and any others), target: (text). docs without text, with n_words, n_features, weight and score."""
    held = docs.sparkSession.sparkContext.broadcast(gains(corpus_counts(docs.select("text"), buckets), corpus_counts(target.select("text"), buckets)))
    others = [c for c in docs.columns if c != "text"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name != "text")

    def make():
        own = GainPlanes(held.value)

        def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                words, total, weight = [], [], []
                texts = batch.column(batch.schema.get_field_index("text"))
                for lo in range(0, len(texts), GROUP):
                    found = [bucket_counts(t.as_buffer().to_pybytes(), buckets) for t in texts.slice(lo, GROUP)]
                    counts = np.stack([f[0] for f in found])
                    n = counts.sum(axis=1)
                    words += [f[1] for f in found]
                    total += n.tolist()
                    weight += (own.sums(counts) // np.maximum(n, 1)).tolist()
                kept = [batch.column(batch.schema.get_field_index(c)) for c in others]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(words, pa.int64()), pa.array(total, pa.int64()), pa.array(weight, pa.int64())], [*others, "n_words", "n_features", "weight"])

        return stage

    found = arrow_stage(docs.select(*others, "text"), make, f"{schema}, n_words long, n_features long, weight long")
    return found.withColumn("score", F.col("weight") + _noise(F.col("doc_id"), seed))


def _drawn(docs: DataFrame, target: DataFrame, min_words: int, percent: int, seed: int) -> DataFrame:
    """The columns of docs but text, with n_words, n_features, weight, score and rank."""
    found = materialise(weighed(docs, target, seed).withColumn("salt", F.monotonically_increasing_id()), "weights")
    enough = F.coalesce((F.col("n_words") >= min_words) & F.col("score").isNotNull(), F.lit(False))
    grouped = found.withColumn("enough", F.when(enough, "1").otherwise("0"))
    placed = ranked(grouped, "enough", [F.desc("score"), F.col("doc_id"), F.col("n_features"), F.col("salt")])
    taken = (F.col("enough") == "1") & (F.col("pos") < F.expr(f"({percent} * n) div 100"))
    out = placed.withColumn("rank", F.when(taken, F.col("pos") + 1))
    return out


def _texts(target: DataFrame, text: str = "text") -> DataFrame:
    return target.select(F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))


def resampling_digest(docs: DataFrame, target: DataFrame, min_words: int = MIN_WORDS, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """Per document: doc_id, n_features, weight, score, rank (of the drawn, from 1; others null)."""
    return _drawn(whole_texts(docs), _texts(target), min_words, percent, seed).select("doc_id", "n_features", "weight", "score", "rank")


def resample(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """The drawn rows of docs with all their columns. Rows are joined back by id and text hash; of rows that are equal in both and
    meet the edge of the draw, all stay that any drawn one equals."""
    again = "text_hash"
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.xxhash64(F.col(f"`{text}`")).alias(again), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    own, other = fresh(docs, "drawn_id"), fresh(docs, "drawn_hash")
    chosen = _drawn(rows, _texts(target), min_words, percent, seed).filter("rank is not null").select(F.col("doc_id").alias(own), F.col(again).alias(other)).distinct()
    return docs.join(chosen, (F.col(f"`{key}`").cast("long") == F.col(own)) & (F.xxhash64(F.col(f"`{text}`")) == F.col(other)), "left_semi")
