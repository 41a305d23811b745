"""Quality classifier: a factorisation machine over hashed words, structure statistics and their pairwise interactions.

score = sigmoid(w0 + <w, x> + 1/2 * sum over f of ((sum over i of v_if x_i)^2 - sum over i of (v_if x_i)^2)),

which costs time linear in the features for each text. x holds the square roots of counts of hashed words (length 1), and standardised statistics of the text:
shares of byte classes, word lengths, repetition, line lengths. Labels, language, source and ids are no inputs.

Training reads at most SAMPLE labelled rows, those with the smallest hashes of their ids, so the driver's work has a fixed
bound; scoring reads every text whole. Same input, same model.

Defined results: null and empty texts are scored as texts without words; rows may repeat; labels other than 0 and 1 and null
ids are no training rows; a doc_id with several labels counts with its largest; without training rows of both labels every score is
the share of label 1 (0.5 without any).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import arrow_stage, fresh, whole_texts
from .wordhash import Family, slices, spans, word_hashes

#: Most labelled rows that training reads.
SAMPLE = 8000
BUCKETS = 2048
RANK = 4
EPOCHS = 40
BATCH = 256
RATE = 0.02
DECAY = 1e-4
THRESHOLD = 0.7
FAMILY = 21

#: Byte classes: lower, upper, digit, blank, line break, sentence sign, other ASCII sign, not ASCII, exclamation, bar, bracket.
KINDS = 11
_KIND = np.full(256, 6, dtype=np.int64)
_KIND[97:123], _KIND[65:91], _KIND[48:58] = 0, 1, 2
_KIND[[0x20, 0x09, 0x0B, 0x0C]], _KIND[[0x0A, 0x0D]] = 3, 4
_KIND[[ord(c) for c in ".,;:'\"-?"]] = 5
_KIND[128:], _KIND[0x21], _KIND[0x7C] = 7, 8, 9
_KIND[[ord(c) for c in "()[]<>{}"]] = 10
_LETTER = np.zeros(256, dtype=bool)
_LETTER[97:123] = _LETTER[65:91] = _LETTER[48:58] = _LETTER[128:] = True
STATISTICS = KINDS + 10


def _ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a / np.maximum(b, 1)


def features(offsets: np.ndarray, raw: np.ndarray, family: Family) -> tuple[np.ndarray, np.ndarray]:
    """(texts x BUCKETS hashed words, texts x STATISTICS) of one slice."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    of = np.repeat(np.arange(n), size)
    kinds = np.bincount(of * KINDS + _KIND[raw], minlength=n * KINDS).reshape(n, KINDS).astype(float)
    words = word_hashes(offsets, raw, [family])
    starts, ends, _ = spans(offsets, raw)
    count = words.counts().astype(float)
    per = lambda mask: np.bincount(words.doc[mask], minlength=n).astype(float)
    length = (ends - starts).astype(float)
    total = np.bincount(words.doc, weights=length, minlength=n)
    square = np.bincount(words.doc, weights=length * length, minlength=n)
    h = words.hashes[0]
    same = np.zeros(len(h), dtype=bool)
    same[1:] = (h[1:] == h[:-1]) & (words.doc[1:] == words.doc[:-1])
    bucket = (h % np.uint64(BUCKETS)).astype(np.int64)
    hashed = np.bincount(words.doc * BUCKETS + bucket, minlength=n * BUCKETS).reshape(n, BUCKETS).astype(np.float32)
    top = hashed.max(axis=1, initial=0)
    used = (hashed > 0).sum(axis=1)
    upper = (raw >= 65) & (raw < 91)
    lines = kinds[:, 4] + 1
    statistics = np.column_stack([
        kinds / np.maximum(size, 1)[:, None],
        np.log1p(count),
        _ratio(total, count),
        np.sqrt(np.maximum(_ratio(square, count) - _ratio(total, count) ** 2, 0)),
        _ratio(per(same), count),
        _ratio(per(~_LETTER[raw[starts]]), count),
        _ratio(per(~_LETTER[raw[ends - 1]]), count),
        _ratio(per(upper[starts] & upper[ends - 1] & (length > 1)), count),
        _ratio(top, count),
        _ratio(used, np.minimum(count, BUCKETS)),
        np.log1p(_ratio(count, lines)),
    ])
    np.sqrt(hashed, out=hashed)
    hashed /= np.maximum(np.sqrt((hashed * hashed).sum(axis=1, keepdims=True)), 1e-6)
    return hashed, statistics


@dataclass
class Machine:
    """The fitted model; `prior` alone where training had one label or none."""

    prior: float
    centre: np.ndarray | None = None
    scale: np.ndarray | None = None
    bias: float = 0.0
    linear: np.ndarray | None = None
    factors: np.ndarray | None = None

    def inputs(self, hashed: np.ndarray, statistics: np.ndarray) -> np.ndarray:
        return np.hstack([hashed, np.clip((statistics - self.centre) / self.scale, -4, 4).astype(np.float32)])

    def scores(self, hashed: np.ndarray, statistics: np.ndarray) -> np.ndarray:
        if self.linear is None:
            return np.full(len(hashed), self.prior)
        return 1 / (1 + np.exp(-np.clip(self._margin(self.inputs(hashed, statistics))[0].astype(np.float64), -30, 30)))

    def _margin(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sums = x @ self.factors
        return self.bias + x @ self.linear + 0.5 * ((sums * sums).sum(axis=1) - (x * x) @ (self.factors * self.factors).sum(axis=1)), sums


@dataclass
class Sparse:
    """Rows of hashed words without their zeros: a batch of rows is written out when it is needed."""

    first: np.ndarray
    bucket: np.ndarray
    value: np.ndarray

    @staticmethod
    def pack(row: np.ndarray) -> bytes:
        at = np.flatnonzero(row)
        return at.astype(np.uint16).tobytes() + row[at].astype(np.float16).tobytes()

    @staticmethod
    def of(packed: list[bytes]) -> Sparse:
        size = np.array([len(p) // 4 for p in packed], dtype=np.int64)
        halves = [(p[: len(p) // 2], p[len(p) // 2 :]) for p in packed]
        return Sparse(np.append(0, np.cumsum(size)), np.frombuffer(b"".join(h[0] for h in halves), np.uint16), np.frombuffer(b"".join(h[1] for h in halves), np.float16))

    def rows(self, at: np.ndarray) -> np.ndarray:
        out = np.zeros((len(at), BUCKETS), dtype=np.float32)
        for k, i in enumerate(at.tolist()):
            here = slice(self.first[i], self.first[i + 1])
            out[k, self.bucket[here]] = self.value[here]
        return out


def fit(hashed: Sparse, statistics: np.ndarray, label: np.ndarray) -> Machine:
    """Adam on the logistic loss in a fixed order."""
    model = Machine(float(label.mean()) if len(label) else 0.5)
    if not len(label) or label.min() == label.max():
        return model
    model.centre, model.scale = statistics.mean(axis=0), statistics.std(axis=0) + 1e-6
    y = label.astype(np.float32)
    rng = np.random.default_rng(0)
    width = BUCKETS + statistics.shape[1]
    model.linear = np.zeros(width, dtype=np.float32)
    model.factors = (rng.standard_normal((width, RANK)) * 0.02).astype(np.float32)
    model.bias = float(np.log(y.mean() / (1 - y.mean())))
    first = [np.zeros_like(p) for p in (model.linear, model.factors)]
    second = [np.zeros_like(p) for p in (model.linear, model.factors)]
    step = 0
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        order = rng.permutation(len(y))
        for lo in range(0, len(y), BATCH):
            at = order[lo : lo + BATCH]
            b = model.inputs(hashed.rows(at), statistics[at])
            margin, sums = model._margin(b)
            g = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y[at]) / len(at)
            slopes = b.T @ g, b.T @ (g[:, None] * sums) - ((b * b).T @ g)[:, None] * model.factors
            step += 1
            for p, slope, m, v in zip((model.linear, model.factors), slopes, first, second, strict=True):
                slope = slope + DECAY * p
                m += 0.1 * (slope - m)
                v += 0.01 * (slope * slope - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
            model.bias -= rate * float(g.sum())
    return model


def training_rows(docs: DataFrame, labels: DataFrame, part: Column, sample: int = SAMPLE) -> tuple[Sparse, np.ndarray, np.ndarray]:
    """Features and labels of at most `sample` labelled rows; part: condition on labels' doc_id. docs: (doc_id, text)."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).filter(part & F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    chosen = known.groupBy("doc_id").agg(F.max("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.join(F.broadcast(chosen), "doc_id").select("doc_id", "quality", "text")  # at most `sample` ids are broadcast

    def make():
        family = Family(FAMILY, lower=True)

        def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                packed = []
                for _, _, offsets, raw in slices(batch.column(2)):
                    hashed, statistics = features(offsets, raw, family)
                    packed += [s.tobytes() + Sparse.pack(h) for h, s in zip(hashed, statistics, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(packed, pa.binary())], ["doc_id", "quality", "packed"])

        return stage

    # A doc_id that several rows have gives one training row.
    found = arrow_stage(rows, make, "doc_id long, quality int, packed binary").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.min("packed").alias("packed"))
    got = found.toArrow().sort_by("doc_id")  # at most `sample` rows of some hundred bytes
    rows = got.column("packed").to_pylist()
    head = STATISTICS * 8
    statistics = np.frombuffer(b"".join(r[:head] for r in rows), np.float64).reshape(-1, STATISTICS)
    return Sparse.of([r[head:] for r in rows]), statistics, got.column("quality").to_numpy().astype(np.int64)


def _remainder(key: Column, of: int) -> Column:
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(of))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, key: str = "doc_id", text: str = "text") -> Machine:
    """Fit on labelled rows whose crc32(doc_id as text) mod 4 is not 2."""
    return fit(*training_rows(whole_texts(docs, key, text).filter("doc_id is not null"), labels, _remainder(F.col("doc_id").cast("long"), 4) != 2, sample))


def score(docs: DataFrame, model: Machine) -> DataFrame:
    """docs: (doc_id, text) -> (doc_id, score)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        family = Family(FAMILY, lower=True)

        def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                got = [shared.value.scores(*features(offsets, raw, family)) for _, _, offsets, raw in slices(batch.column(1))]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(got) if got else np.zeros(0))], ["doc_id", "score"])

        return stage

    return arrow_stage(docs, make, "doc_id long, score double")


def quality_scores(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    scored = score(whole_texts(docs), train(docs, labels, sample))
    held = F.coalesce(_remainder(F.col("doc_id"), 4) == 2, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> DataFrame:
    """docs without the rows scored under THRESHOLD; all columns stay."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, sample, key, text))
    name = fresh(docs, "quality_score")

    @F.pandas_udf("double")
    def scored(texts):
        family = Family(FAMILY, lower=True)
        column = pa.array(texts.fillna(""), pa.string())
        return pd.Series(np.concatenate([shared.value.scores(*features(o, r, family)) for _, _, o, r in slices(column)]) if len(column) else np.zeros(0))

    return docs.withColumn(name, scored(F.col(f"`{text}`"))).filter(F.col(name) >= THRESHOLD).drop(name)
