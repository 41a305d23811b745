"""N-gram Jaccard join: links documents whose sets of word shingles have a Jaccard similarity of at least THRESHOLD percent.

1. One pass over the texts gives each document its set's size and digest (equal sets share one digest, so copies are one
   node from here on) and counts shingles in a count-min sketch of fixed size.
2. A second pass orders each set rare-first (by the sketch's estimate, then by hash: the same order in every document, so
   the estimate's error costs speed only) and sends the prefix that any partner must share, packed by bucket of the shingle.
   A bucket holds the posting lists of its shingles. From a list the least digest is the pivot: pairs of the pivot and each
   other member pass the length filter and the positional filter. Lists of three and more are kept.
3. Sets of the pairs' members are read in a third pass (a sketch of their digests keeps other documents out); pairs are
   verified once, after a suffix filter: counts by parts of the hash space bound the overlap before sets are intersected.
4. Of each kept list, the other pairs that pass the filters and lie in different components of the links so far are verified. In long lists a few
   pairs of each set outside the list's main component come first: near copies join it by these, so that a group of them isn't formed pair by pair.
5. Connected components of the links, labelled by the smallest doc_id.
6. All links lie inside components, so each set's links are counted there: a component is cut into blocks of sets, each pair of
   blocks is one group of its own, and its overlaps are counted for all pairs at once. No pair leaves its task.

Defined results of the join: null and empty texts, and texts without words, have empty sets, link with nothing and are their own
component; fewer words than a shingle make one shingle of the whole sequence; rows that repeat a doc_id are judged each by their own text; a null
doc_id gives a row with a null component and links nothing. Extra columns are ignored. An empty table gives an empty result.
`drop_near_duplicates` states its own cases.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .components import components
from .frames import TEXT_BATCH_ROWS, arrow_stage, discard, fresh, materialise, partitions, small, spread_join, whole_texts
from .sketch import SEGMENT_SCHEMA, CountSketch, merged, segments
from .wordhash import Family, Words, grams, mix, slices, word_hashes

SHINGLE = 5
#: Least similarity, in hundredths.
THRESHOLD = 75
FAMILY = 31
#: Entries that a task gathers before it sends them on, as one Arrow batch of some 6 MB.
FLUSH = 250_000
#: Pairs (8 bytes each) that a task gathers to find those that several lists have.
PAIRS = 1_000_000
#: Parts of the hash space whose counts bound an overlap (suffix filter).
PARTS = 512
ENTRY = np.dtype([("shingle", "<u8"), ("set", "<i8"), ("n", "<i4"), ("at", "<i4")])


def shingles(words: Words, family: Family, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, shingle hash), sorted; and each text's number of them."""
    at, g = grams(words, family, 0, size)
    doc = words.doc[at]
    short = np.flatnonzero((words.counts() > 0) & (words.counts() < size))
    if len(short):
        whole = np.zeros(len(short), dtype=np.uint64)
        for k in range(1, size):
            of = words.counts()[short] == k
            if of.any():
                start, h = grams(words, family, 0, k)
                whole[of] = h[np.searchsorted(start, words.first[short[of]])]
        doc, g = np.append(doc, short), np.append(g, whole)
    order = np.lexsort((g, doc))
    doc, g = doc[order], g[order]
    new = np.ones(len(g), dtype=bool)
    new[1:] = (g[1:] != g[:-1]) | (doc[1:] != doc[:-1])
    doc, g = doc[new], g[new]
    return doc, g, np.bincount(doc, minlength=len(words.first) - 1)


def digests(doc: np.ndarray, g: np.ndarray, n: np.ndarray) -> np.ndarray:
    """A 64-bit digest of each text's set; 0 for the empty set."""
    out = np.zeros(len(n), dtype=np.uint64)
    full = np.flatnonzero(n)
    if len(full):
        first = (np.cumsum(n) - n)[full]
        with np.errstate(over="ignore"):
            out[full] = mix(np.add.reduceat(mix(g), first) + np.uint64(3) * mix(np.bitwise_xor.reduceat(g, first) + n[full].astype(np.uint64)))
    return out.view(np.int64)


def _sets(column: pa.Array, family: Family, size: int) -> Iterator[tuple]:
    for lo, hi, offsets, raw in slices(column):
        doc, g, n = shingles(word_hashes(offsets, raw, [family]), family, size)
        yield lo, hi, doc, g, n, digests(doc, g, n)


def _first_pass(docs: DataFrame, size: int) -> DataFrame:
    """docs: (doc_id, copy, text). (doc_id, copy, n, set) of each document, and the segments of the sketch (segment not null, all else null)."""

    def make():
        family = Family(FAMILY, lower=True)

        def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sketch, waiting, count = CountSketch(), [], 0
            for batch in batches:
                for lo, hi, _, g, n, ids in _sets(batch.column(2), family, size):
                    waiting.append(g)
                    count += len(g)
                    if count > FLUSH:
                        sketch.add(np.concatenate(waiting))
                        waiting, count = [], 0
                    k = hi - lo
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, k), batch.column(1).slice(lo, k), pa.array(n, pa.int32()), pa.array(ids), pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary())], NAMES)
            if waiting:
                sketch.add(np.concatenate(waiting))
            for part in segments(sketch):
                yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.int64()), *part.columns], NAMES)

        return stage

    NAMES = ["doc_id", "copy", "n", "set", "segment", "cells"]
    return arrow_stage(docs, make, "doc_id long, copy long, n int, set long, segment int, cells binary")


def prefix_length(n: np.ndarray, threshold: int) -> np.ndarray:
    return n - -(-threshold * n // 100) + 1


def least_overlap(a: np.ndarray, b: np.ndarray, threshold: int) -> np.ndarray:
    """Least intersection size of sets of sizes a and b at the threshold."""
    return -(-threshold * (a + b) // (100 + threshold))


def part_counts(of: np.ndarray, g: np.ndarray, n: int) -> np.ndarray:
    """Of each of n sets, the number of hashes in each part of the hash space (255: that many or more)."""
    return np.minimum(np.bincount(of * PARTS + (g >> np.uint64(55)).astype(np.int64), minlength=n * PARTS), 255).astype(np.uint8).reshape(n, PARTS)


def suffix_bound(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """No intersection is larger: sums over the parts of the smaller count (unbounded where a part is full)."""
    return np.where((a == 255).any(axis=1) | (b == 255).any(axis=1), np.iinfo(np.int32).max, np.minimum(a, b).sum(axis=1, dtype=np.int64))


def _prefixes(docs: DataFrame, shared: Broadcast, size: int, threshold: int) -> DataFrame:
    """Once for each task and set: (bucket, null, entries), packed prefix entries; and (bucket, set, entries), the set's counts by parts of the hash space.

    shared: the merged sketch."""
    parts = partitions(docs.sparkSession)

    def make():
        family, counts = Family(FAMILY, lower=True), CountSketch(shared.value.counts)

        def flush(held: list[np.ndarray]) -> pa.RecordBatch:
            entries = np.concatenate(held)
            bucket = (entries["shingle"] % np.uint64(parts)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            entries, bucket = entries[order], bucket[order]
            lo = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            return pa.RecordBatch.from_arrays([pa.array(bucket[lo], pa.int32()), pa.nulls(len(lo), pa.int64()), pa.array([entries[a:b].tobytes() for a, b in zip(lo, np.append(lo[1:], len(entries)), strict=True)], pa.binary())], ["bucket", "set", "entries"])

        def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[np.ndarray] = []
            count, seen = 0, set()
            marks: list[tuple[int, bytes]] = []
            for batch in batches:
                for _, _, doc, g, n, ids in _sets(batch.column(0), family, size):
                    new = np.zeros(len(n), dtype=bool)
                    for k, (x, full) in enumerate(zip(ids.tolist(), n.tolist(), strict=True)):
                        if full and x not in seen:
                            seen.add(x)
                            new[k] = True
                    keep = new[doc]
                    doc, g = doc[keep], g[keep]
                    rows = np.flatnonzero(new)
                    signature = part_counts(np.searchsorted(rows, doc), g, len(rows))
                    marks += [(x, y.tobytes()) for x, y in zip(ids[rows].tolist(), signature, strict=True)]
                    order = np.argsort((doc << 32) + counts.estimate(g), kind="stable")
                    doc, g = doc[order], g[order]
                    m = np.where(new, n, 0)
                    at = np.arange(len(doc)) - (np.cumsum(m) - m)[doc]
                    front = at < prefix_length(n, threshold)[doc]
                    entries = np.empty(int(front.sum()), dtype=ENTRY)
                    entries["shingle"], entries["set"], entries["n"], entries["at"] = g[front], ids[doc[front]], n[doc[front]], at[front]
                    held.append(entries)
                    count += len(entries)
                    if count > FLUSH:
                        yield flush(held)
                        yield marked(marks)
                        held, count, marks = [], 0, []
            if count:
                yield flush(held)
                yield marked(marks)

        def marked(marks: list[tuple[int, bytes]]) -> pa.RecordBatch:
            ids = np.array([m[0] for m in marks], dtype=np.int64)
            return pa.RecordBatch.from_arrays([pa.array((ids % parts).astype(np.int32)), pa.array(ids), pa.array([m[1] for m in marks], pa.binary())], ["bucket", "set", "entries"])

        return stage

    return arrow_stage(docs.select("text"), make, "bucket int, set long, entries binary")


#: kind 0: a list of three members or more (packed sets, and each one's first place in its own order over the shingles with this list); kind 1: a
#: pivot and one other member, `good` if it passes the filters; kind 2: a set and its counts by parts (in members).
LISTS_SCHEMA = "kind int, pivot long, set long, n int, good boolean, members binary, places binary"
_LISTS = ["kind", "pivot", "set", "n", "good", "members", "places"]


def _lists(prefixes: DataFrame, threshold: int) -> DataFrame:
    parts = partitions(prefixes.sparkSession)

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, seen = [], set()
        for batch in batches:
            marks = []
            for of, x in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if of is None:
                    held.append(np.frombuffer(x, dtype=ENTRY))
                elif of not in seen:
                    seen.add(of)
                    marks.append((of, x))
            if marks:
                k = len(marks)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(k, 2), pa.int32()), pa.nulls(k, pa.int64()), pa.array([m[0] for m in marks], pa.int64()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.bool_()), pa.array([m[1] for m in marks], pa.binary()), pa.nulls(k, pa.binary())], _LISTS)
        if not held:
            return
        e = np.concatenate(held)
        held.clear()
        e = e[np.lexsort((e["set"], e["shingle"]))]
        new = np.ones(len(e), dtype=bool)
        new[1:] = (e["shingle"][1:] != e["shingle"][:-1]) | (e["set"][1:] != e["set"][:-1])
        e = e[new]
        lo = np.flatnonzero(np.append(True, e["shingle"][1:] != e["shingle"][:-1]))
        size = np.diff(np.append(lo, len(e)))
        lo, size = lo[size > 1], size[size > 1]
        if not len(lo):
            return
        first = np.repeat(lo, size - 1)
        other = np.concatenate([np.arange(a + 1, a + s) for a, s in zip(lo, size, strict=True)])
        p, m = e[first], e[other]
        a, b = p["n"].astype(np.int64), m["n"].astype(np.int64)
        good = (100 * np.minimum(a, b) >= threshold * np.maximum(a, b)) & (np.minimum(a - p["at"], b - m["at"]) >= least_overlap(a, b, threshold))
        # One row for each pivot and member, good if any shingle's pair was.
        order = np.lexsort((~good, m["set"], p["set"]))
        p, m, good = p[order], m[order], good[order]
        keep = np.append(True, (p["set"][1:] != p["set"][:-1]) | (m["set"][1:] != m["set"][:-1]))
        p, m, good = p[keep], m[keep], good[keep]
        k = len(p)
        yield pa.RecordBatch.from_arrays([pa.array(np.ones(k), pa.int32()), pa.array(p["set"]), pa.array(m["set"]), pa.array(m["n"]), pa.array(good), pa.nulls(k, pa.binary()), pa.nulls(k, pa.binary())], _LISTS)
        lists: dict[bytes, np.ndarray] = {}
        for at, s in zip(lo[size > 2].tolist(), size[size > 2].tolist(), strict=True):
            key, places = e["set"][at : at + s].tobytes(), e["at"][at : at + s]
            lists[key] = np.minimum(lists[key], places) if key in lists else places
        if lists:
            k = len(lists)
            pivots = np.array([int.from_bytes(m[:8], "little", signed=True) for m in lists], dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(k), pa.int32()), pa.array(pivots), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.bool_()), pa.array(list(lists), pa.binary()), pa.array([x.tobytes() for x in lists.values()], pa.binary())], _LISTS)

    return prefixes.repartitionById(parts, F.col("bucket")).mapInArrow(stage, LISTS_SCHEMA)


#: Stands for a null doc_id.
NONE = -(2**63)


def _owner(sets: np.ndarray, docs: np.ndarray) -> np.ndarray:
    return mix(sets.view(np.uint64) ^ mix(docs.view(np.uint64)))


def _read(docs: np.ndarray) -> np.ndarray:
    return mix(docs.view(np.uint64) ^ np.uint64(5))


def _member_sets(docs: DataFrame, members: DataFrame, size: int, name: str) -> DataFrame:
    """(set, n, shingles binary): sorted 64-bit hashes of the given sets, each from the rows with its smallest doc_id (once a task), and of a few others.

    members: (set, low). A sketch of fixed size tells the documents to read, before their shingles are made, and the sets to keep; where it errs, a set too many is returned."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, any_ = CountSketch(), False
        for batch in batches:
            sets, low = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            sketch.add(_owner(sets, low))
            sketch.add(_read(low))
            any_ = True
        if any_:
            yield from segments(sketch)

    shared = docs.sparkSession.sparkContext.broadcast(merged(CountSketch, members.select("set", "low").mapInArrow(mark, SEGMENT_SCHEMA)))

    def make():
        family, wanted, seen = Family(FAMILY, lower=True), CountSketch(shared.value.counts), set()

        def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                batch = batch.filter(pa.array(wanted.estimate(_read(batch.column(0).to_numpy(zero_copy_only=False))) > 0))
                keys = batch.column(0).to_numpy(zero_copy_only=False)
                for lo, hi, _, g, n, ids in _sets(batch.column(1), family, size):
                    first = np.cumsum(n) - n
                    rows = [k for k in np.flatnonzero((wanted.estimate(_owner(ids, keys[lo:hi])) > 0) & (n > 0)).tolist() if not (ids[k] in seen or seen.add(ids[k]))]
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(ids[rows]), pa.array(n[rows], pa.int32()), pa.array([g[first[k] : first[k] + n[k]].tobytes() for k in rows], pa.binary())], ["set", "n", "shingles"])

        return stage

    return materialise(arrow_stage(docs.select(F.coalesce("doc_id", F.lit(NONE)).alias("doc_id"), "text"), make, "set long, n int, shingles binary"), name, shared)


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted arrays."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    return int((b[np.minimum(at, len(b) - 1)] == a).sum())


def _verified(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Those of the distinct pairs (a, b) of sets that link."""

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                need = least_overlap(len(x), len(y), threshold)
                common = overlap(x, y) if suffix_bound(*(part_counts(np.zeros(len(z), dtype=np.int64), z, 1) for z in (x, y)))[0] >= need else 0
                good.append(100 * common >= threshold * (len(x) + len(y) - common))
            mask = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"])

    left = sets.select(F.col("set").alias("a"), F.col("shingles").alias("of_a"))
    right = sets.select(F.col("set").alias("b"), F.col("shingles").alias("of_b"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "of_a", "of_b")
    pairs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXT_BATCH_ROWS))
    return joined.mapInArrow(stage, "a long, b long").distinct()


#: Lists of a pivot that go to one task.
LISTS = 128
#: Pairs whose parts are compared at a time, and cells of a table of a list's members against each other.
BLOCK, CELLS = 1024, 1 << 20
#: From a list of LONG members on, each set is first compared with PROBES sets of the list's main component.
LONG, PROBES = 64, 8


def across(n: np.ndarray, label: np.ndarray, left: np.ndarray, threshold: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j) of a list's members with different labels that pass the length and positional filters, each once. Members ascend by n; left: each
    one's shingles from the list's on. Only members outside the commonest label are compared with all, so a list that is one component but for a few costs these few times its length."""
    _, of, times = np.unique(label, return_inverse=True, return_counts=True)
    main = of == times.argmax()
    others = np.flatnonzero(~main)
    step = max(1, min(BLOCK, CELLS // len(n)))
    for at in range(0, len(others), step):
        i = others[at : at + step]
        lo, hi = np.searchsorted(n, -(-n[i[0]] * threshold // 100)), np.searchsorted(n, n[i[-1]] * 100 // threshold, "right")
        j = np.arange(lo, hi)
        good = (of[i][:, None] != of[lo:hi][None, :]) & (main[lo:hi][None, :] | (i[:, None] < j[None, :]))
        short, long_ = np.minimum(n[i][:, None], n[lo:hi][None, :]), np.maximum(n[i][:, None], n[lo:hi][None, :])
        good &= (100 * short >= threshold * long_) & (np.minimum(left[i][:, None], left[lo:hi][None, :]) >= least_overlap(short, long_, threshold))
        x, y = np.nonzero(good)
        yield i[x], j[y]


def probes(n: np.ndarray, label: np.ndarray, left: np.ndarray, threshold: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """As `across`, but of pairs with the commonest label only those with its first PROBES members (by set: the same ones in lists that share members), and no others."""
    _, of, times = np.unique(label, return_inverse=True, return_counts=True)
    main = of == times.argmax()
    i, j = (x.ravel() for x in np.meshgrid(np.flatnonzero(~main), np.flatnonzero(main)[:PROBES], indexing="ij"))
    short, long_ = np.minimum(n[i], n[j]), np.maximum(n[i], n[j])
    good = (100 * short >= threshold * long_) & (np.minimum(left[i], left[j]) >= least_overlap(short, long_, threshold))
    yield i[good], j[good]


def _residual(lists: DataFrame, known: DataFrame, threshold: int, first: bool = False) -> DataFrame:
    """Pairs (a, b) of a kept list whose members have different labels and that pass the length, positional and suffix filters.

    known: (pivot, set, n, label, counts). first: only each set's probes in long lists, whose links leave few pairs of different labels to the whole pass."""
    parts = partitions(lists.sparkSession)
    none = F.lit(None).cast("long")
    # A pivot with many lists is dealt to several tasks, each with what is known of the pivot's members.
    shares = lists.groupBy("pivot").agg(F.ceil(F.count("*") / LISTS).cast("int").alias("shares"))
    share = F.pmod(F.xxhash64("members"), F.col("shares")).cast("int").alias("share")
    own = lists.join(shares, "pivot").select("pivot", share, none.alias("set"), none.alias("n"), none.alias("label"), "members", "places")
    facts = known.join(shares, "pivot").select("pivot", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), "set", F.col("n").cast("long").alias("n"), "label", F.lit(None).cast("binary").alias("members"), F.col("counts").alias("places"))
    rows = own.unionByName(facts)

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, np.ndarray] = {}
        facts, counts = [], {}
        for batch in batches:
            for _, _, s, n, label, members, places in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if members is None:
                    facts.append((s, n, label))
                    counts[s] = places
                else:
                    places = np.frombuffer(places, dtype=np.int32)
                    held[members] = np.minimum(held[members], places) if members in held else places
        if not held:
            return
        facts = np.unique(np.array(facts, dtype=[("set", "<i8"), ("n", "<i8"), ("label", "<i8")]))
        facts = facts[np.append(True, facts["set"][1:] != facts["set"][:-1])]
        counts = np.frombuffer(b"".join(counts[s] for s in facts["set"].tolist()), dtype=np.uint8).reshape(-1, PARTS)

        def bounded(keys: list[np.ndarray]) -> pa.RecordBatch:
            i, j = np.divmod(np.unique(np.concatenate(keys)), len(facts))
            fine = [np.zeros(0, dtype=bool)]
            for k in range(0, len(i), BLOCK):
                x, y = i[k : k + BLOCK], j[k : k + BLOCK]
                fine.append(suffix_bound(counts[x], counts[y]) >= least_overlap(facts["n"][x], facts["n"][y], threshold))
            fine = np.concatenate(fine)
            return pa.RecordBatch.from_arrays([pa.array(facts["set"][i[fine]]), pa.array(facts["set"][j[fine]])], ["a", "b"])

        # Lists of one pivot share most of their members: a pair is bounded once for all of them.
        keys, count = [], 0
        for members, places in held.items():
            at = np.searchsorted(facts["set"], np.frombuffer(members, dtype=np.int64)[1:])
            of = facts[at]
            if (of["label"] == of["label"][0]).all():
                continue
            if first:
                found = probes(of["n"], of["label"], of["n"] - places[1:], threshold)
            else:
                order = np.argsort(of["n"], kind="stable")
                of, at = of[order], at[order]
                found = across(of["n"], of["label"], of["n"] - places[1:][order], threshold)
            for i, j in found:
                i, j = at[i], at[j]
                keys.append(np.minimum(i, j) * len(facts) + np.maximum(i, j))
                count += len(i)
                if count > PAIRS:
                    keys = [np.unique(np.concatenate(keys))]
                    count = len(keys[0])
                    if count > PAIRS // 2:
                        yield bounded(keys)
                        keys, count = [], 0
        if count:
            yield bounded(keys)

    return rows.repartition(parts, "pivot", "share").mapInArrow(stage, "a long, b long").distinct()


#: A component's sets are cut into blocks of about BLOCK_SETS, at most FEW of them while a block's shingles stay under BLOCK_BYTES.
BLOCK_SETS, FEW, BLOCK_BYTES = 256, 16, 16 << 20
#: Sets whose overlaps are counted at a time, and columns of their table.
SIDE, COLUMNS = 512, 8192


def overlaps(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of each set of a with each of b.

    Shingles that many sets of both sides hold are columns of two 0/1 tables, whose product counts them; others are counted by their pairs of holders."""
    n, m = len(a), len(b)
    _, inverse = np.unique(np.concatenate([*a, *b]), return_inverse=True)
    size = int(inverse.max(initial=-1)) + 1
    cut = sum(map(len, a))
    left, right = inverse[:cut], inverse[cut:]
    of_left, of_right = (np.repeat(np.arange(len(x)), [len(y) for y in x]) for x in (a, b))
    times, other = np.bincount(left, minlength=size), np.bincount(right, minlength=size)
    dense = times * other * 100 >= n * m
    number = np.cumsum(dense) - 1
    out = np.zeros((n, m), dtype=np.float32)
    ends = [(number[x[dense[x]]], of[dense[x]]) for x, of in ((left, of_left), (right, of_right))]
    for lo in range(0, int(dense.sum()), COLUMNS):
        tables = [np.zeros((k, COLUMNS), dtype=np.float32) for k in (n, m)]
        for table, (column, of) in zip(tables, ends, strict=True):
            here = (column >= lo) & (column < lo + COLUMNS)
            table[of[here], column[here] - lo] = 1
        out += tables[0] @ tables[1].T
    rare = np.flatnonzero(~dense[left] & (other[left] > 0))
    rest = np.flatnonzero(~dense[right] & (times[right] > 0))
    rest = rest[np.argsort(right[rest], kind="stable")]
    first, each = np.searchsorted(right[rest], left[rare]), other[left[rare]]
    at = np.repeat(first - (np.cumsum(each) - each), each) + np.arange(each.sum())
    return out.astype(np.int64) + np.bincount(np.repeat(of_left[rare], each) * m + of_right[rest[at]], minlength=n * m).reshape(n, m)


def link_counts(a: list[np.ndarray], b: list[np.ndarray] | None, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each set of a, its links with sets of b, and the other way round; without b, links of the sets of a with each other."""
    other = a if b is None else b
    n, m = np.zeros(len(a), dtype=np.int64), np.zeros(len(other), dtype=np.int64)
    for lo in range(0, len(a), SIDE):
        for to in range(0 if b is not None else lo, len(other), SIDE):
            x, y = a[lo : lo + SIDE], other[to : to + SIDE]
            common = overlaps(x, y)
            both = np.array([len(z) for z in x])[:, None] + np.array([len(z) for z in y])[None, :]
            good = 100 * common >= threshold * (both - common)
            if b is None and lo == to:
                np.fill_diagonal(good, False)
            n[lo : lo + SIDE] += good.sum(axis=1)
            if b is not None or lo != to:
                m[to : to + SIDE] += good.sum(axis=0)
    return (n, m) if b is not None else (n + m, m[:0])


def _degrees(sets: DataFrame, label: DataFrame, threshold: int) -> DataFrame:
    """(set, n_links): how many other sets each set links with, for those that link. sets: (set, n, shingles); label: (set, label)."""
    parts = partitions(sets.sparkSession)
    owned = sets.select("set", "n").distinct().join(label, "set")
    sizes = owned.groupBy("label").agg(F.count("*").alias("sets"), F.sum("n").alias("shingles")).filter("sets > 1")
    two = owned.join(sizes.filter("sets = 2"), "label").select("set", F.lit(1).cast("long").alias("n_links"))
    blocks = F.greatest(F.least(F.ceil(F.col("sets") / BLOCK_SETS), F.lit(FEW)), F.ceil(F.col("shingles") * 8 / BLOCK_BYTES)).cast("int")
    dealt = label.join(sizes.filter("sets > 2").select("label", blocks.alias("blocks")), "label").withColumn("block", F.pmod(F.xxhash64("set"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).join(sets.select("set", "shingles"), "set")
    rows = dealt.select("label", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), (F.col("block") > F.col("other")).alias("right"), "set", "shingles")

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, ({}, {})

        def counted() -> pa.RecordBatch:
            left, right = ([np.frombuffer(x, np.uint64) for x in side.values()] for side in held)
            n, m = link_counts(left, right if key[1] != key[2] else None, threshold)
            return pa.RecordBatch.from_arrays([pa.array([*held[0], *held[1]], pa.int64()), pa.array(np.append(n, m))], ["set", "n_links"])

        for batch in batches:
            for label, i, j, right, s, x in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (label, i, j) != key:
                    if key:
                        yield counted()
                    key, held = (label, i, j), ({}, {})
                held[right][s] = x  # a set may come twice
        if key:
            yield counted()

    found = rows.repartition(parts, "label", "i", "j").sortWithinPartitions("label", "i", "j").mapInArrow(stage, "set long, n_links long")
    return two.unionByName(found.groupBy("set").agg(F.sum("n_links").alias("n_links")))


def _keyed(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, copy, text): null texts are read as empty; `copy` tells rows of one doc_id with different texts apart."""
    return whole_texts(docs, key, text).select("doc_id", F.xxhash64("text").alias("copy"), "text")


def linked_sets(docs: DataFrame, size: int = SHINGLE, threshold: int = THRESHOLD, among: Column | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """docs: (doc_id, copy, text). (doc_id, copy, n, set) of each row; (set, label), the component of each set that rows chosen by `among` (all) have; and
    (set, n, shingles) of the sets that link with others, and of some that don't."""
    context = docs.sparkSession.sparkContext
    among = F.lit(True) if among is None else among
    first = materialise(_first_pass(docs, size), "sets")
    of = first.filter("segment is null").select("doc_id", "copy", "n", "set")
    low = of.filter(among & (F.col("n") > 0)).groupBy("set").agg(F.coalesce(F.min("doc_id"), F.lit(NONE)).alias("low"))
    sketch = context.broadcast(merged(CountSketch, first.filter("segment is not null").select("segment", "cells")))
    docs = docs.filter(among).select("doc_id", "text")
    lists = materialise(_lists(_prefixes(docs, sketch, size, threshold), threshold), "lists", sketch)
    stars = materialise(lists.filter("kind = 1").groupBy("pivot", "set").agg(F.max("n").alias("n"), F.max("good").alias("good")), "stars")
    ends = lambda pairs: pairs.select(F.col("a").alias("set")).unionByName(pairs.select(F.col("b").alias("set"))).distinct()

    pairs = stars.filter("good").select(F.col("pivot").alias("a"), F.col("set").alias("b"))
    sets = _member_sets(docs, ends(pairs).join(low, "set"), size, "shingles")
    links = materialise(_verified(pairs, sets, threshold), "links")
    label = materialise(components(links).select(F.col("node").alias("set"), F.col("component").alias("label")), "labels")

    # What can still join two components: lists of a pivot with a member outside the pivot's own. Long lists come first with a few pairs for each
    # such member, which leaves few members outside, and then all lists with all pairs that are left.
    marks = lists.filter("kind = 2").select("set", F.col("members").alias("counts")).groupBy("set").agg(F.first("counts").alias("counts"))
    done, used = pairs, [lists, stars, links]
    long_ = F.length("members") > 8 * LONG
    for first in [False] if lists.filter((F.col("kind") == 0) & long_).isEmpty() else [True, False]:
        of_pivot = label.select(F.col("set").alias("pivot"), F.col("label").alias("own"))
        known = stars.join(label, "set", "left").join(of_pivot, "pivot", "left").select("pivot", "set", "n", F.coalesce("label", "set").alias("label"), F.coalesce("own", "pivot").alias("own"))
        open_ = known.filter("label <> own").select("pivot").distinct()
        kept = lists.filter((F.col("kind") == 0) & (long_ if first else F.lit(True))).join(open_, "pivot", "left_semi").select("pivot", "members", "places")
        rest = _residual(kept, known.join(open_, "pivot", "left_semi").drop("own").join(marks, "set"), threshold, first)
        rest = materialise(rest.join(done, ["a", "b"], "left_anti"), "pairs")
        if first:  # pairs whose sets have been read; the whole pass has the others
            rest = materialise(rest.join(sets.select(F.col("set").alias("a")).distinct(), "a", "left_semi").join(sets.select(F.col("set").alias("b")).distinct(), "b", "left_semi"), "pairs")
        else:
            sets = sets.unionByName(_member_sets(docs, ends(rest).join(ends(pairs), "set", "left_anti").join(low, "set"), size, "shingles"))
        more = materialise(_verified(rest, sets, threshold), "links")
        named = lambda end, label=label, more=more: more.join(label.select(F.col("set").alias(end), F.col("label").alias(f"of_{end}")), end, "left").select("a", "b", F.coalesce(f"of_{end}", end).alias(f"c{end}"))
        joined = components(named("a").join(named("b"), ["a", "b"]).select(F.col("ca").alias("a"), F.col("cb").alias("b")).filter("a <> b").distinct())
        label = low.select("set").join(label, "set", "left").select("set", F.coalesce("label", "set").alias("label"))
        label = label.join(joined, F.col("label") == F.col("node"), "left").select("set", F.coalesce("component", "label").alias("label"))
        label = materialise(label, "labels")
        done = done.unionByName(rest)
        used += [rest, more]
    for frame in used:
        discard(frame)
    return of, label, sets


def jaccard_components(docs: DataFrame, size: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (the smallest doc_id that links reach), n_links (other sets that its set links with, all counted; 0 for a null doc_id)."""
    of, label, sets = linked_sets(_keyed(docs), size, threshold, F.col("doc_id").isNotNull())
    low = of.filter("doc_id is not null and n > 0").groupBy("set").agg(F.min("doc_id").alias("low")).join(label, "set")
    least = low.groupBy("label").agg(F.min("low").alias("component"))
    named = spread_join(low, least, "label").join(_degrees(sets, label, threshold), "set", "left").select("set", "component", "n_links")
    out = spread_join(of, materialise(named, "components"), "set", "left")
    here = F.col("doc_id").isNotNull()
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("n") > 0, F.when(here, F.col("component"))).otherwise(F.col("doc_id")).alias("component_id"), F.when(here, F.coalesce("n_links", F.lit(0))).otherwise(0).cast("long").alias("n_links"))


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """docs with one row of each component: that with the smallest doc_id. All columns stay.

    Defined results: rows without words (null and empty texts too) all stay; rows with a null doc_id are compared like others and stay only
    where no row of their component has a doc_id; rows that repeat a doc_id are judged each by their own text, and of several of one component one
    stays; an empty table gives an empty result; columns may have any names."""
    of, label, _ = linked_sets(_keyed(docs, key, text), size, threshold)
    rows = of.filter("n > 0").groupBy("set", "doc_id", "copy").agg(F.count("*").alias("times"))
    rows = materialise(spread_join(rows, label, "set"), "rows")
    # The least of each component: a doc_id before none, then by doc_id and text.
    least = rows.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "copy")).alias("least"))
    judged = spread_join(rows, least, "label").withColumn("stays", F.col("doc_id").eqNullSafe(F.col("least.doc_id")) & (F.col("copy") == F.col("least.copy")))
    judged = materialise(judged.filter("not stays or times > 1").select(F.col("doc_id").alias("gone_doc"), F.col("copy").alias("gone_copy"), "stays"), "gone")
    out = docs.join(small(_renamed(judged, docs)), _same(docs, key, text), "left_anti")
    again = judged.filter("stays")
    if not again.isEmpty():  # rows with one doc_id and one text: one of them stays
        number = fresh(docs, "number")
        window = Window.partitionBy(F.col(f"`{key}`"), F.xxhash64(F.col(f"`{text}`"))).orderBy(F.lit(0))
        twice = docs.join(small(_renamed(again, docs)), _same(docs, key, text), "left_semi").withColumn(number, F.row_number().over(window))
        out = out.unionByName(twice.filter(F.col(number) == 1).drop(number))
    return out


def _renamed(judged: DataFrame, docs: DataFrame) -> DataFrame:
    return judged.select(F.col("gone_doc").alias(fresh(docs, "gone_doc")), F.col("gone_copy").alias(fresh(docs, "gone_copy")))


def _same(docs: DataFrame, key: str, text: str) -> Column:
    """Whether a row of docs is the one that a row of `_renamed` names."""
    return F.col(f"`{key}`").cast("long").eqNullSafe(F.col(fresh(docs, "gone_doc"))) & (F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit(""))) == F.col(fresh(docs, "gone_copy")))
