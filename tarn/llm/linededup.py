"""Line dedup: drop, in every document, the lines that many documents have.

Method: a sharded minimal perfect hash over distinct line hashes, indexing fingerprint and count arrays that documents probe.

1. A line's key is the line stripped of `[\\x20\\x09-\\x0D]` at both ends with A-Z in lower case; 128 bits of BLAKE2b stand for
   it. Each task gathers the distinct keys of each document, adds them up and sends (hash, number of documents) packed to
   the hash's shard, so a line of a third of all documents is one entry from each flush of a task.
2. A shard adds these up and builds a minimal perfect hash over its distinct line hashes that `min_docs` documents have
   (others can't change a result), with 64 bits of fingerprint and a count in each slot. Shards are rows of a Parquet table.
3. Documents probe. While all shards together measure at most INDEX_BYTES they are broadcast and no text moves. Beyond,
   each task sends the distinct line hashes of its distinct texts to the shards (each shard in SPREAD copies, so that one
   busy line is asked of many tasks), which probe the same arrays and answer by text; answers are joined to the texts.

Defined results: a null or empty text is one empty line, which has the empty key and stays while min_chars is at least 1;
every row is a document, also where a doc_id is null or repeats; an empty table gives an empty result; extra columns are
ignored or, in `dedup_lines`, kept, whatever their names. A long text is worked on line by line.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import arrow_stage, discard, fresh, materialise, partitions, spread_join, whole_texts
from .perfecthash import PerfectHash

MIN_DOCS, MIN_CHARS = 10, 1
BLANK = b" \t\n\x0b\x0c\r"
#: Entries that a task gathers before it sends them on, or a shard before it adds them up.
FLUSH = 500_000
#: Largest size of all shards together at which they are broadcast.
INDEX_BYTES = 32 << 20
#: Copies of each shard that requests are dealt to.
SPREAD = 16
ENTRY = np.dtype([("high", "<u8"), ("low", "<u8"), ("docs", "<u4")])
ASK = np.dtype([("high", "<u8"), ("low", "<u8"), ("text", "<i8"), ("again", "<i8")])


def _digests(lines: list[bytes], min_chars: int) -> list[bytes]:
    """The key's hash for each line, b"" where the key is too short."""
    out = []
    for line in lines:
        key = line.strip(BLANK).lower()
        size = len(key) if min_chars <= 1 else len(key.decode())
        out.append(hashlib.blake2b(key, digest_size=16).digest() if size >= min_chars else b"")
    return out


def _pairs(digests: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    flat = np.frombuffer(b"".join(digests), dtype="<u8").reshape(-1, 2)
    return flat[:, 0], flat[:, 1]


def _added(high: np.ndarray, low: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Distinct hashes with the sum of their documents, as ENTRY."""
    order = np.lexsort((low, high))
    high, low = high[order], low[order]
    new = np.ones(len(high), dtype=bool)
    new[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
    at = np.flatnonzero(new)
    out = np.empty(len(at), dtype=ENTRY)
    out["high"], out["low"] = high[at], low[at]
    out["docs"] = np.minimum(np.add.reduceat(docs[order].astype(np.int64), at), 2**32 - 1) if len(at) else 0
    return out


def _by_shard(entries: np.ndarray, shards: int) -> Iterator[tuple[int, np.ndarray]]:
    shard = (entries["high"] % np.uint64(shards)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    edge = np.searchsorted(shard[order], np.arange(shards + 1))
    for k in np.flatnonzero(np.diff(edge)).tolist():
        yield k, entries[order[edge[k] : edge[k + 1]]]


def line_index(texts: DataFrame, min_docs: int, min_chars: int) -> DataFrame:
    """(shard, body): one perfect hash for each shard, materialised; texts: (text)."""
    shards = partitions(texts.sparkSession)

    def make():
        def flush(held: bytearray) -> Iterator[pa.RecordBatch]:
            flat = np.frombuffer(bytes(held), dtype="<u8").reshape(-1, 2)
            found = [(k, e.tobytes()) for k, e in _by_shard(_added(flat[:, 0], flat[:, 1], np.ones(len(flat), np.uint32)), shards)]
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in found], pa.int32()), pa.array([e for _, e in found], pa.binary())], ["shard", "body"])

        def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = bytearray()
            for batch in batches:
                for text in batch.column(0):
                    held += b"".join(set(_digests(text.as_buffer().to_pybytes().split(b"\n"), min_chars)))
                    if len(held) >= 16 * FLUSH:
                        yield from flush(held)
                        held = bytearray()
            if held:
                yield from flush(held)

        return stage

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        waiting: dict[int, list[np.ndarray]] = {}

        def settle(k: int) -> None:
            e = np.concatenate([*([sums[k]] if k in sums else []), *waiting.pop(k)])
            sums[k] = _added(e["high"], e["low"], e["docs"])

        for batch in batches:
            for k, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                waiting.setdefault(k, []).append(np.frombuffer(body, ENTRY))
                if sum(map(len, waiting[k])) > FLUSH + (len(sums[k]) if k in sums else 0):
                    settle(k)
        for k in list(waiting):
            settle(k)
        for k, e in sums.items():
            e = e[e["docs"] >= min_docs]
            if len(e):
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([PerfectHash.build(e["high"], e["low"], e["docs"]).pack()], pa.binary())], ["shard", "body"])

    counted = arrow_stage(texts, make, "shard int, body binary")
    return materialise(counted.repartitionById(shards, F.col("shard")).mapInArrow(build, "shard int, body binary"), "lines")


class Index:
    """Some or all shards; unpacked once in each worker process."""

    def __init__(self, shards: int, bodies: dict[int, bytes]) -> None:
        self.shards, self.bodies, self.tables = shards, bodies, {}

    def __getstate__(self) -> tuple:
        return self.shards, self.bodies

    def __setstate__(self, state: tuple) -> None:
        self.__init__(*state)

    def counts(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        out = np.zeros(len(high), dtype=np.int64)
        shard = (high % np.uint64(self.shards)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        edge = np.searchsorted(shard[order], np.arange(self.shards + 1))
        for k in np.flatnonzero(np.diff(edge)).tolist():
            if k in self.bodies:
                if k not in self.tables:
                    self.tables[k] = PerfectHash.unpack(self.bodies[k])
                at = order[edge[k] : edge[k + 1]]
                out[at] = self.tables[k].lookup(high[at], low[at])
        return out


def _asked(texts: DataFrame, index: DataFrame, min_chars: int) -> DataFrame:
    """(name struct<text,again>, gone binary): for each distinct text with lines to drop, their hashes. texts: (text, again, body)."""
    shards = partitions(texts.sparkSession)

    def make():
        def flush(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            found = []
            for k, e in _by_shard(np.concatenate(held), shards):
                spread = np.argsort(e["text"] % SPREAD, kind="stable")
                cut = np.searchsorted((e["text"] % SPREAD)[spread], np.arange(SPREAD + 1))
                found += [(k, s, e[spread[cut[s] : cut[s + 1]]].tobytes()) for s in range(SPREAD) if cut[s] < cut[s + 1]]
            columns = [pa.array([f[0] for f in found], pa.int32()), pa.array([f[1] for f in found], pa.int32()), pa.array([1] * len(found), pa.int32()), pa.array([f[2] for f in found], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["shard", "copy", "kind", "body"])

        def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, count, seen = [], 0, set()
            for batch in batches:
                for name, again, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                    if (name, again) in seen:
                        continue
                    seen.add((name, again))
                    high, low = _pairs(list(set(_digests(text.as_buffer().to_pybytes().split(b"\n"), min_chars)) - {b""}))
                    e = np.empty(len(high), dtype=ASK)
                    e["high"], e["low"], e["text"], e["again"] = high, low, name, again
                    held.append(e)
                    count += len(e)
                    if count >= FLUSH:
                        yield from flush(held)
                        held, count, seen = [], 0, set()
            if count:
                yield from flush(held)

        return stage

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = None, None  # the copy of a shard comes before what is asked of it
        for batch in batches:
            for k, copy, kind, body in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if kind == 0:
                    held, key = PerfectHash.unpack(body), (k, copy)
                elif key == (k, copy):
                    e = np.frombuffer(body, ASK)
                    e = e[held.lookup(e["high"], e["low"]) > 0]
                    raw = np.stack([e["high"], e["low"]], axis=1).tobytes()
                    lines = [raw[at : at + 16] for at in range(0, len(raw), 16)]
                    yield pa.RecordBatch.from_arrays([pa.array(e["text"]), pa.array(e["again"]), pa.array(lines, pa.binary())], ["text", "again", "line"])

    asked = arrow_stage(texts, make, "shard int, copy int, kind int, body binary")
    copies = index.select("shard", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))).alias("copy"), F.lit(0).alias("kind"), "body")
    met = copies.unionByName(asked).repartition(shards, "shard", "copy").sortWithinPartitions("shard", "copy", "kind")
    found = met.mapInArrow(probe, "text long, again long, line binary")
    return found.groupBy(F.struct("text", "again").alias("name")).agg(F.collect_set("line").alias("gone"))


Lookup = Callable[[list[list[bytes]]], list[np.ndarray]]


def _cut(raws: list[bytes], goners: list | None, index: Index | None, min_chars: int) -> Iterator[tuple[bytes, int, int]]:
    """Kept text, lines and dropped lines of each text, by the index or by the hashes to drop."""
    lines = [raw.split(b"\n") for raw in raws]
    if index is None:
        for own, gone in zip(lines, goners, strict=True):
            drop = set(gone) if gone is not None and len(gone) else ()
            stay = [x for x, d in zip(own, _digests(own, min_chars), strict=True) if d not in drop] if drop else own
            yield b"\n".join(stay), len(own), len(own) - len(stay)
        return
    digests = [_digests(own, min_chars) for own in lines]
    flat = [d for own in digests for d in own if d]
    high, low = _pairs(flat)
    drop = iter((index.counts(high, low) > 0).tolist())
    for own, found in zip(lines, digests, strict=True):
        stay = [x for x, d in zip(own, found, strict=True) if not d or not next(drop)]
        yield b"\n".join(stay), len(own), len(own) - len(stay)


def _prepared(docs: DataFrame, text: str, min_docs: int, min_chars: int, index_bytes: int) -> tuple[DataFrame, str, Broadcast | None]:
    """docs with a column of hashes to drop, and None; or docs with a null in that column, and the broadcast index."""
    body, gone = F.coalesce(F.col(f"`{text}`"), F.lit("")), fresh(docs, "gone")
    spark = docs.sparkSession
    index = line_index(docs.select(body.alias("text")), min_docs, min_chars)
    if (index.agg(F.sum(F.octet_length("body"))).first()[0] or 0) <= index_bytes:
        held = spark.sparkContext.broadcast(Index(partitions(spark), {r.shard: bytes(r.body) for r in index.collect()}))
        discard(index)
        return docs.withColumn(gone, F.lit(None).cast("array<binary>")), gone, held
    names = [F.xxhash64(body), F.xxhash64(F.lit("again"), body)]
    found = materialise(_asked(docs.select(names[0].alias("text"), names[1].alias("again"), body.alias("body")), index, min_chars), "goners")
    discard(index)
    name = fresh(docs, "name")
    rows = docs.withColumn(name, F.struct(names[0].alias("text"), names[1].alias("again")))
    return spread_join(rows, found.select(F.col("name").alias(name), F.col("gone").alias(gone)), name, "left").drop(name), gone, None


def line_dedup_digest(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, index_bytes: int = INDEX_BYTES) -> DataFrame:
    """Per document: doc_id, n_lines, n_dropped, kept_sha256."""
    rows, gone, held = _prepared(whole_texts(docs), "text", min_docs, min_chars, index_bytes)

    def make():
        def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                goners = None if held is not None else batch.column(2).to_pylist()
                found = list(_cut([t.as_buffer().to_pybytes() for t in batch.column(1)], goners, held and held.value, min_chars))
                columns = [batch.column(0), pa.array([f[1] for f in found], pa.int64()), pa.array([f[2] for f in found], pa.int64()), pa.array([hashlib.sha256(f[0]).hexdigest() for f in found], pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_lines", "n_dropped", "kept_sha256"])

        return stage

    return arrow_stage(rows.select("doc_id", "text", gone), make, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")


def dedup_lines(docs: DataFrame, text: str = "text", min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, index_bytes: int = INDEX_BYTES) -> DataFrame:
    """docs with the lines that at least `min_docs` rows have cut out of `text`; a null text stays null, all rows and columns stay."""
    rows, gone, held = _prepared(docs, text, min_docs, min_chars, index_bytes)

    @F.pandas_udf("string")
    def cut(texts: pd.Series, goners: pd.Series) -> pd.Series:
        found = _cut([(t or "").encode() for t in texts], list(goners), held and held.value, min_chars)
        return pd.Series([None if t is None else f[0].decode() for t, f in zip(texts, found, strict=True)])

    return rows.select(*[cut(F.col(f"`{c}`"), F.col(gone)).alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])
