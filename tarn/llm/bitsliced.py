"""Exact top-k inner-product search over a bit-sliced index.

Components are quantised to floor(256 * x). The index holds blocks of BLOCK rows; in a block each component is stored as bit slices:
one bitmap over the rows for each bit of its value above the block's least. A query's inner products with all rows of a
block are added with bitmap arithmetic: every bit of a query component selects slices by weight (complemented where the component is negative),
and carry-save adders reduce the bitmaps of each weight to one, carrying into the next. That gives the scores as bit slices
again. The top rows are selected from the most significant slice downward; rows that tie at the boundary are taken by id.

Blocks are keyed by hash, so their number follows the rows. A task gets one block and one group of query chunks (GROUP of them), and holds one
chunk at a time, so more queries give more tasks. Each block answers each query with at most k rows; the k best of those are exact.

Defined results: vectors that are null or hold a null or non-finite component, and null ids, take no part; every other row is a candidate
for every query but itself, also where ids repeat: rows that share an id are queries, and candidates, each on its own (their answers have the same
query_id and their own ranks); a query meets only vectors of its own length, the empty vector too; fewer than k candidates give fewer
rows; an empty table gives none. Scores must fit 63 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frames import materialise, partitions

BLOCK = 8192
#: Queries that travel together, and chunks of them that meet a block in one task.
CHUNK, GROUP = 256, 16
#: Tasks of the search for each shuffle partition of the session, at most.
TASKS = 64
SCALE = 256


def _vectors(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(row, vec_id, embedding array<double>) of the rows that take part; row: a number of its own."""
    rows = df.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{key}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").cast("array<double>").alias("embedding"))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return rows.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).filter(F.coalesce(fine, F.lit(False)))


def _matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids in order, the numbers of their rows, and their quantised vectors."""
    ids, numbers = (table.column(c).to_numpy() for c in ("vec_id", "row"))
    x = table.column("embedding").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(ids), table.column("dim")[0].as_py())
    order = np.lexsort((numbers, ids))
    return ids[order], numbers[order], np.floor(SCALE * x).astype(np.int64)[order]


def _packed(kind: str, dim: int, number: int, data: bytes) -> pa.Table:
    return pa.table({"dim": pa.array([dim], pa.int32()), kind: pa.array([number], pa.int32()), "packed": pa.array([data], pa.binary())})


class Block:
    """Ids in order, row numbers, the least value and number of bits of each component, and slices: (bits of all components) x words."""

    def __init__(self, ids: np.ndarray, numbers: np.ndarray, low: np.ndarray, bits: np.ndarray, slices: np.ndarray) -> None:
        self.ids, self.numbers, self.low, self.bits, self.slices = ids, numbers, low, bits, slices
        self.first = np.cumsum(bits) - bits
        pad = np.zeros(-(-len(ids) // 64) * 64, dtype=bool)
        pad[: len(ids)] = True
        self.rows = np.packbits(pad, bitorder="little").view(np.uint64)

    @classmethod
    def build(cls, ids: np.ndarray, numbers: np.ndarray, x: np.ndarray) -> Block:
        low = x.min(axis=0)
        above = x - low
        bits = np.array([int(v).bit_length() for v in above.max(axis=0)], dtype=np.int64)
        words = -(-len(ids) // 64)
        pad = np.zeros((words * 64 - len(ids),), dtype=np.uint8)
        slices = [np.packbits(np.append(((above[:, d] >> b) & 1).astype(np.uint8), pad), bitorder="little") for d in range(x.shape[1]) for b in range(bits[d])]
        return cls(ids, numbers, low, bits, np.array(slices, dtype=np.uint8).reshape(-1, words * 8).view(np.uint64))

    def dump(self) -> bytes:
        return b"".join([np.int64(len(self.ids)).tobytes(), self.ids.astype(np.int64).tobytes(), self.numbers.astype(np.int64).tobytes(), self.low.tobytes(), self.bits.tobytes(), self.slices.tobytes()])

    @classmethod
    def load(cls, data: bytes, dim: int) -> Block:
        n = int(np.frombuffer(data, np.int64, 1)[0])
        head = np.frombuffer(data, np.int64)
        ids, numbers, low, bits, slices = np.split(head, np.cumsum([n, n, dim, dim]) + 1)
        return cls(ids[1:], numbers, low, bits, slices.view(np.uint64).reshape(-1, -(-n // 64)))

    def scores(self, query: np.ndarray) -> tuple[list[np.ndarray], int]:
        """Bit slices, least significant first, of (score - base) for all rows; and base."""
        size = np.abs(query)
        picked: dict[int, list[np.ndarray]] = {}
        for sign in (False, True):
            of = np.flatnonzero((query < 0) == sign)
            for bit in range(int(size[of].max(initial=0)).bit_length()):
                d = of[(size[of] >> bit) & 1 == 1]
                n = self.bits[d]
                at = np.repeat(self.first[d], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                weight = at - np.repeat(self.first[d], n) + bit
                order = np.argsort(weight, kind="stable")
                edges = np.searchsorted(weight[order], np.arange(int(weight.max(initial=-1)) + 2))
                for p, (lo, hi) in enumerate(zip(edges, edges[1:])):  # noqa: B905
                    if hi > lo:
                        chosen = self.slices[at[order[lo:hi]]]
                        picked.setdefault(p, []).append(~chosen if sign else chosen)
        negative = query < 0
        base = int((query * self.low).sum()) - int((size[negative] * ((1 << self.bits[negative]) - 1)).sum())
        out: list[np.ndarray] = []
        p = 0
        while picked:
            stack = picked.pop(p, None)
            out.append(_added(np.concatenate(stack), picked.setdefault(p + 1, [])) if stack else np.zeros_like(self.rows))
            if p + 1 in picked and not picked[p + 1]:
                del picked[p + 1]
            p += 1
        return out, base

    def top(self, query: np.ndarray, k: int, own: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows but that with number `own`: those above the boundary, and of the ties the smallest ids."""
        slices, base = self.scores(query)
        open_ = self.rows.copy()
        for at in np.flatnonzero(self.numbers == own).tolist():
            open_[at >> 6] &= ~(np.uint64(1) << np.uint64(at & 63))
        sure = np.zeros_like(open_)
        for s in reversed(slices):
            high = open_ & s
            n = int(np.bitwise_count(sure | high).sum())
            if n > k:
                open_ = high
            else:
                sure |= high
                open_ &= ~s
                if n == k:
                    open_[:] = 0
                    break
        rows = _positions(sure)
        rows = np.append(rows, _positions(open_)[: max(0, k - len(rows))])
        word, bit = rows >> 6, (rows & 63).astype(np.uint64)
        total = np.full(len(rows), base, dtype=np.int64)
        for p, s in enumerate(slices):
            total += ((s[word] >> bit) & np.uint64(1)).astype(np.int64) << p
        return self.ids[rows], total


def _positions(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def _added(stack: np.ndarray, carries: list[np.ndarray]) -> np.ndarray:
    """Sum of bitmaps of one weight: returns the bitmap of the sum's lowest bit; carries of twice the weight are appended."""
    while len(stack) > 2:
        n = len(stack) // 3
        a, b, c = stack[:n], stack[n : 2 * n], stack[2 * n : 3 * n]
        x = a ^ b
        carries.append((a & b) | (x & c))
        x ^= c
        stack = np.concatenate([x, stack[3 * n :]]) if 3 * n < len(stack) else x
    if len(stack) == 2:
        carries.append((stack[0] & stack[1])[None, :])
        return stack[0] ^ stack[1]
    return stack[0]


def _blocks(rows: DataFrame, block: int) -> int:
    return max(1, -(-rows.count() // block))


def _index(rows: DataFrame, count: int) -> DataFrame:
    def build(table: pa.Table) -> pa.Table:
        ids, numbers, x = _matrix(table)
        return _packed("block", x.shape[1], table.column("block")[0].as_py(), Block.build(ids, numbers, x).dump())

    keyed = rows.select("row", "vec_id", "embedding", F.size("embedding").alias("dim"), F.pmod(F.xxhash64("row"), F.lit(count)).cast("int").alias("block"))
    return keyed.groupBy("dim", "block").applyInArrow(build, "dim int, block int, packed binary")


def build_index(df: DataFrame, key: str = "vec_id", vector: str = "embedding", block: int = BLOCK) -> DataFrame:
    """(dim, block, packed): every row that takes part, in bit-sliced blocks of about `block` rows."""
    rows = materialise(_vectors(df, key, vector), "vectors")
    return _index(rows, _blocks(rows, block))


def _chunks(rows: DataFrame) -> DataFrame:
    def build(table: pa.Table) -> pa.Table:
        ids, numbers, q = _matrix(table)
        return _packed("chunk", q.shape[1], table.column("chunk")[0].as_py(), np.column_stack([ids, numbers, q]).astype(np.int64).tobytes())

    keyed = rows.select("row", "vec_id", "embedding", F.size("embedding").alias("dim"), F.pmod(F.xxhash64("row"), F.lit(_blocks(rows, CHUNK))).cast("int").alias("chunk"))
    return keyed.groupBy("dim", "chunk").applyInArrow(build, "dim int, chunk int, packed binary")


def top_k(df: DataFrame, wanted: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding", block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows of df for which `wanted` (a condition on vec_id) holds, against every other row."""
    spark = df.sparkSession
    rows = materialise(_vectors(df, key, vector), "vectors")
    count = _blocks(rows, block)
    index = materialise(_index(rows, count), "index")
    chunks = materialise(_chunks(rows.filter(wanted)), "chunks")
    # Each chunk of the stated query set goes to each block: blocks first within a key, then a group's chunks one after another.
    groups = -(-_blocks(rows.filter(wanted), CHUNK) // GROUP)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    sent = chunks.select("dim", every(count).alias("block"), F.pmod("chunk", F.lit(groups)).alias("group"), "chunk", "packed")
    both = index.select("dim", "block", every(groups).alias("group"), F.lit(-1).alias("chunk"), "packed").unionByName(sent)

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, of = None, None
        for batch in batches:
            for dim, at, group, chunk, packed in zip(*(batch.column(c).to_pylist() for c in range(4)), batch.column(4), strict=True):
                if chunk < 0:
                    held, of = Block.load(packed.as_py(), dim), (dim, at, group)
                if chunk < 0 or of != (dim, at, group):  # a block without vectors of this length isn't there
                    continue
                queries = np.frombuffer(packed.as_py(), np.int64).reshape(-1, dim + 2)
                found = [held.top(q[2:], k, int(q[1])) for q in queries]
                size = [len(f[0]) for f in found]
                yield pa.RecordBatch.from_arrays([*(pa.array(np.repeat(queries[:, c], size)) for c in (0, 1)), *(pa.array(np.concatenate([f[c] for f in found])) for c in (0, 1))], ["query_id", "query_row", "vec_id", "score"])

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    # A task streams any number of (block, group) keys, so their number, which grows with the square of the rows, isn't that of the tasks.
    tasks = min(max(count * groups, partitions(spark)), TASKS * partitions(spark))
    dealt = both.repartition(tasks, "dim", "block", "group").sortWithinPartitions("dim", "block", "group", "chunk")
    found = dealt.mapInArrow(stage, "query_id long, query_row long, vec_id long, score long")
    best = Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
