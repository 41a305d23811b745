"""Substring dedup: remove words of passages that another document with a smaller doc_id also has.

Method: a count-min prefilter and exact grouping.

1. Every window of `window` words has an anchor, the least hash of the `gram`-word runs inside it. Equal windows have equal
   anchors, and neighbouring windows mostly share one, so a document has few anchors. Each task counts the anchors of its
   documents (once a document) in a sketch of fixed size; the merged sketch overestimates in how many documents an anchor,
   and so any window under it, occurs.
2. Only windows whose anchor is estimated to occur in two documents are grouped, exactly, by anchor and window hash (128
   bits together). Within a task, a window that several documents have is decided on the spot and only its smallest doc_id
   travels on, so a passage that a third of all documents share sends one entry from each task. Entries go to buckets by
   anchor, packed as arrays; a bucket answers with the runs of windows that occur in a smaller doc_id.
3. The runs are joined to their rows by doc_id and text hash, and the words they cover are removed. Where few rows have
   runs (RUNS_BROADCAST, counted) these are broadcast and no text moves; beyond, rows are exchanged, hot keys spread.

Defined results: a null text has no words; a text of fewer than `window` words keeps all; every row is judged by its own
text, also where a doc_id repeats (equal ids never remove each other); a null doc_id removes nothing from others and loses
nothing. Extra columns are ignored or, in `dedup_substrings`, kept. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import SMALL_ROWS, arrow_stage, fresh, materialise, partitions, spread_join, whole_texts
from .sketch import SEGMENT_SCHEMA, Merged, TwiceSketch, merged, segments
from .wordhash import Family, Words, grams, slices, word_hashes

WINDOW = 50
GRAM = 8
FAMILIES = (11, 12)
#: Entries that a task gathers before it sends them on.
FLUSH_WINDOWS = 1_000_000
FOUND_SCHEMA = "bucket int, kind int, runs binary"
#: A row is named by its doc_id and 64 bits of its text's hash.
RUN = np.dtype([("doc", "<i8"), ("text", "<i8"), ("start", "<i4"), ("end", "<i4")])
HEAD = np.dtype([("anchor", "<u8"), ("doc", "<i8"), ("text", "<i8"), ("start", "<i4"), ("n", "<i4")])
#: Most runs in all that are broadcast, of SMALL_ROWS rows at most: some 16 MB.
RUNS_BROADCAST = 1_000_000


def _least(g: np.ndarray, span: int) -> np.ndarray:
    """Least of each `span` neighbours."""
    step = 1
    while step * 2 <= span:
        g = np.minimum(g[:-step], g[step:])
        step *= 2
    return np.minimum(g[: len(g) - (span - step)], g[span - step :]) if span > step else g


def _windows(words: Words, families: list[Family], window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start word, anchor and hash of every window."""
    start, whole = grams(words, families[1], 1, window)
    if not len(start):
        return start, whole, whole
    n = len(words.doc)
    at, g = grams(words, families[0], 0, gram)
    dense = np.zeros(n - gram + 1, dtype=np.uint64)
    dense[at] = g
    return start, _least(dense, window - gram + 1)[start], whole


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Indices at which any column differs from the entry before."""
    differs = np.zeros(len(columns[0]), dtype=bool)
    if len(differs):
        differs[0] = True
        for c in columns:
            differs[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(differs)


def repeated_anchors(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> Merged:
    """The merged sketch of the anchors of all documents."""

    def make():
        families = [Family(s, lower=False) for s in FAMILIES]

        def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sketch, waiting, count = TwiceSketch(), [], 0
            for batch in batches:
                for _, _, offsets, raw in slices(batch.column(0)):
                    words = word_hashes(offsets, raw, families)
                    start, anchor, _ = _windows(words, families, window, gram)
                    new = _changes(words.doc[start], anchor)
                    pairs = np.unique(np.rec.fromarrays([anchor[new], words.doc[start[new]]]))
                    waiting.append(pairs["f0"])
                    count += len(pairs)
                    if count > FLUSH_WINDOWS:
                        sketch.add(np.concatenate(waiting))
                        waiting, count = [], 0
            if waiting:
                sketch.add(np.concatenate(waiting))
            yield from segments(sketch)

        return stage

    return merged(TwiceSketch, arrow_stage(docs.select("text"), make, SEGMENT_SCHEMA))


def _packed(bucket: int, kind: int, *parts: np.ndarray) -> tuple[int, int, bytes]:
    return bucket, kind, b"".join([np.int64(len(parts[0])).tobytes(), *(p.tobytes() for p in parts)])


def _batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.binary())], ["bucket", "kind", "runs"])


def _runs(doc: np.ndarray, text: np.ndarray, start: np.ndarray, window: int) -> np.ndarray:
    """Windows (document, its text, start word), in any order, as runs of covered words."""
    order = np.lexsort((start, text, doc))
    doc, text, start = doc[order], text[order], start[order]
    if not len(doc):
        return np.zeros(0, dtype=RUN)
    cut = np.ones(len(doc), dtype=bool)
    cut[1:] = (doc[1:] != doc[:-1]) | (text[1:] != text[:-1]) | (start[1:] > start[:-1] + window)
    at = np.flatnonzero(cut)
    out = np.empty(len(at), dtype=RUN)
    out["doc"], out["text"], out["start"] = doc[at], text[at], start[at]
    out["end"] = start[np.append(at[1:], len(doc)) - 1] + window
    return out


def _later(anchor: np.ndarray, whole: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of windows with equal (anchor, hash): those whose document isn't the smallest, and one of the smallest for each."""
    order = np.lexsort((doc, whole, anchor))
    a, w, d = anchor[order], whole[order], doc[order]
    new = _changes(a, w)
    least = np.repeat(d[new], np.diff(np.append(new, len(d))))
    return order[d > least], order[d == least]


def repeated_runs(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc_id, mark, start, end): runs of words that lie in windows which a smaller doc_id also has; docs: (doc_id, text).
    mark: the hash of the row's text, F.xxhash64("text")."""
    spark = docs.sparkSession
    sketch = spark.sparkContext.broadcast(repeated_anchors(docs, window, gram))
    parts = partitions(spark)

    def make():
        families = [Family(s, lower=False) for s in FAMILIES]
        twice = TwiceSketch(sketch.value.counts)

        def flush(held: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
            doc, text, start, anchor, whole = (np.concatenate(x) for x in zip(*held, strict=True))
            later, least = _later(anchor, whole, doc)
            runs = _runs(doc[later], text[later], start[later], window)
            rows = [_packed(int(doc[later[0]]) % parts, 1, runs)] if len(later) else []
            least = np.sort(least)
            doc, text, start, anchor, whole = doc[least], text[least], start[least], anchor[least], whole[least]
            head = np.ones(len(doc), dtype=bool)
            head[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1]) | (text[1:] != text[:-1]) | (start[1:] != start[:-1] + 1)
            head = np.flatnonzero(head)
            heads = np.empty(len(head), dtype=HEAD)
            heads["anchor"], heads["doc"], heads["text"], heads["start"] = anchor[head], doc[head], text[head], start[head]
            heads["n"] = np.diff(np.append(head, len(doc)))
            bucket = (heads["anchor"] % np.uint64(parts)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            of = np.repeat(bucket, heads["n"])
            whole = whole[np.argsort(of, kind="stable")]
            heads, bucket = heads[order], bucket[order]
            each = np.cumsum(np.append(0, heads["n"]))
            edge = _changes(bucket)
            for lo, hi in zip(edge, np.append(edge[1:], len(bucket)), strict=True):
                rows.append(_packed(int(bucket[lo]), 0, heads[lo:hi], whole[each[lo] : each[hi]]))
            for at in range(0, len(rows), 64):
                yield _batch(rows[at : at + 64])

        def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[tuple[np.ndarray, ...]] = []
            count = 0
            for batch in batches:
                ids, marks = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 2))
                for lo, _, offsets, raw in slices(batch.column(1)):
                    words = word_hashes(offsets, raw, families)
                    start, anchor, whole = _windows(words, families, window, gram)
                    keep = np.flatnonzero(twice.repeated(anchor)) if len(anchor) else np.zeros(0, dtype=np.int64)
                    if len(keep):
                        start, doc = start[keep], words.doc[start[keep]]
                        held.append((ids[lo + doc], marks[lo + doc], (start - words.first[doc]).astype(np.int32), anchor[keep], whole[keep]))
                        count += len(keep)
                    if count > FLUSH_WINDOWS:
                        yield from flush(held)
                        held, count = [], 0
            if held:
                yield from flush(held)

        return stage

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads, wholes = [], []

        def out(runs: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(runs[c]) for c in RUN.names], ["doc_id", "mark", "start", "end"])

        for batch in batches:
            for kind, raw in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                n = int(np.frombuffer(raw, np.int64, 1)[0])
                if kind:
                    yield out(np.frombuffer(raw, RUN, n, 8))
                else:
                    heads.append(np.frombuffer(raw, HEAD, n, 8))
                    wholes.append(np.frombuffer(raw, np.uint64, -1, 8 + n * HEAD.itemsize))
        if not heads:
            return
        head, whole = np.concatenate(heads), np.concatenate(wholes)
        n = head["n"]
        step = np.arange(len(whole)) - np.repeat(np.cumsum(n) - n, n)
        doc, text, start = np.repeat(head["doc"], n), np.repeat(head["text"], n), np.repeat(head["start"], n) + step
        later, _ = _later(np.repeat(head["anchor"], n), whole, doc)
        if len(later):
            yield out(_runs(doc[later], text[later], start[later], window))

    found = arrow_stage(docs.filter("doc_id is not null").select("doc_id", "text", F.xxhash64("text").alias("mark")), make, FOUND_SCHEMA)
    return found.repartitionById(parts, F.col("bucket")).mapInArrow(decide, "doc_id long, mark long, start int, end int")


def _kept(text: str, runs: list[dict] | None) -> tuple[list[bytes], int]:
    words = text.encode().split()
    n = len(words)
    if not runs:
        return words, n
    gone = np.zeros(n, dtype=bool)
    for run in runs:
        gone[run["start"] : run["end"]] = True
    return [w for w, g in zip(words, gone.tolist(), strict=True) if not g], n


def with_runs(docs: DataFrame, runs: DataFrame, key: Column, text: Column, name: str) -> DataFrame:
    """docs and the column `name`, the array of that row's runs or null."""
    of = fresh(docs, "run_of")
    each = runs.groupBy(F.struct("doc_id", "mark").alias(of)).agg(F.collect_set(F.struct("start", "end")).alias(name))
    each = materialise(each, "runs")
    size = each.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.size(name)), F.lit(0)).alias("runs")).first()
    named = docs.withColumn(of, F.struct(key.alias("doc_id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("mark")))
    if size.rows <= SMALL_ROWS and size.runs <= RUNS_BROADCAST:
        return named.join(F.broadcast(each), of, "left").drop(of)
    return spread_join(named, each, of, "left").drop(of)


def substring_digest(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by one space)."""
    docs = whole_texts(docs)

    def make():
        def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                n, removed, digest = [], [], []
                for text, runs in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                    kept, count = _kept(text, runs)
                    n.append(count)
                    removed.append(count - len(kept))
                    digest.append(hashlib.sha256(b" ".join(kept)).hexdigest())
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(digest, pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256"])

        return stage

    joined = with_runs(docs, repeated_runs(docs, window, gram), F.col("doc_id"), F.col("text"), "runs").select("doc_id", "text", "runs")
    return arrow_stage(joined, make, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def dedup_substrings(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """docs with repeated passages cut out of `text`: a row that loses words keeps the others joined by one space, a row that
    loses none keeps its text as it is (null stays null). All columns and rows stay."""
    runs = repeated_runs(whole_texts(docs, key, text), window, gram)

    @F.pandas_udf("string")
    def cut(texts, found):
        return texts.combine(found, lambda t, r: t if r is None else b" ".join(_kept(t or "", list(r))[0]).decode())

    name = fresh(docs, "runs")
    joined = with_runs(docs, runs, F.col(f"`{key}`").cast("long"), F.col(f"`{text}`"), name)
    return joined.select(*[F.when(F.col(name).isNull(), F.col(f"`{c}`")).otherwise(cut(F.col(f"`{c}`"), F.col(name))).alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])
