"""Count-min sketches of fixed size: filled in each task, merged across partitions in segments, never losing a count.

The size is a constant, whatever the input. On more data the estimates get looser (more keys look frequent), which costs
later stages time and never correctness. Segments are merged while they stream through a task, in two levels, so merging needs the
memory of one sketch however many partitions send theirs, and more partitions are merged by more tasks.

Two forms: CountSketch counts to 2**31, TwiceSketch to 2 (two bit planes: seen, seen again).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import partitions

SEGMENTS = 16
SEGMENT_SCHEMA = "segment int, cells binary"
_FACTORS = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


def _cells(keys: np.ndarray, row: int, width: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        mixed = (keys ^ (keys >> np.uint64(29))) * np.uint64(_FACTORS[row])
    return (mixed >> np.uint64(64 - width.bit_length() + 1)).astype(np.int64)


class CountSketch:
    """2 rows of four-byte counters."""

    WIDTH = 1 << 22
    SHAPE = (2, WIDTH)
    KIND = np.int32

    def __init__(self, counts: np.ndarray | None = None) -> None:
        self.counts = np.zeros(self.SHAPE, dtype=self.KIND) if counts is None else counts.reshape(self.SHAPE)

    def add(self, keys: np.ndarray) -> None:
        for row in range(2):
            self.counts[row] = self.merge(self.counts[row], np.bincount(_cells(keys, row, self.WIDTH), minlength=self.WIDTH))

    def estimate(self, keys: np.ndarray) -> np.ndarray:
        """At least the true count (to 2**31)."""
        return np.minimum(self.counts[0, _cells(keys, 0, self.WIDTH)], self.counts[1, _cells(keys, 1, self.WIDTH)])

    @staticmethod
    def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.minimum(a.astype(np.int64) + b, 2**31 - 1).astype(np.int32)


class TwiceSketch:
    """2 rows of counters that stop at 2, as bit planes: seen at least once, seen at least twice."""

    BITS = 1 << 26
    #: For each eighth of the cells of a row both planes lie together, so that a segment can be merged alone.
    SHAPE = (2, SEGMENTS // 2, 2, BITS // 8 // (SEGMENTS // 2))
    KIND = np.uint8

    def __init__(self, counts: np.ndarray | None = None) -> None:
        self.counts = np.zeros(self.SHAPE, dtype=self.KIND) if counts is None else counts.reshape(self.SHAPE)

    def _at(self, keys: np.ndarray, row: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        cell = _cells(keys, row, self.BITS)
        part, cell = np.divmod(cell, self.SHAPE[3] * 8)
        return part, cell >> 3, np.left_shift(1, cell & 7).astype(np.uint8)

    def add(self, keys: np.ndarray) -> None:
        for row in range(2):
            cell, times = np.unique(_cells(keys, row, self.BITS), return_counts=True)
            again = times > 1
            part, byte = np.divmod(cell >> 3, self.SHAPE[3])
            bit = np.left_shift(1, cell & 7).astype(np.uint8)
            seen = self.counts[row, part, 0, byte] & bit != 0
            again |= seen
            np.bitwise_or.at(self.counts, (row, part, 0, byte), bit)
            np.bitwise_or.at(self.counts, (row, part[again], 1, byte[again]), bit[again])

    def repeated(self, keys: np.ndarray) -> np.ndarray:
        """True for every key added at least twice, and for some others."""
        found = np.ones(len(keys), dtype=bool)
        for row in range(2):
            part, byte, bit = self._at(keys, row)
            found &= self.counts[row, part, 1, byte] & bit != 0
        return found

    @staticmethod
    def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        half = len(a) // 2
        out = a | b
        out[half:] |= a[:half] & b[:half]
        return out


def segments(sketch: CountSketch | TwiceSketch) -> Iterator[pa.RecordBatch]:
    for k, part in enumerate(sketch.counts.reshape(SEGMENTS, -1)):
        if part.any():
            yield _row(k, part)


def _row(k: int, part: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([zlib.compress(part.tobytes(), 1)], pa.binary())], ["segment", "cells"])


class Merged:
    """A merged sketch as compressed segments: what the driver collects and broadcasts. `counts` unpacks it, once in each worker process."""

    def __init__(self, kind: type, parts: dict[int, bytes]) -> None:
        self.kind, self.parts, self._counts = kind, parts, None

    def __getstate__(self) -> tuple:
        return self.kind, self.parts

    def __setstate__(self, state: tuple) -> None:
        self.__init__(*state)

    @property
    def counts(self) -> np.ndarray:
        if self._counts is None:
            out = np.zeros(self.kind.SHAPE, dtype=self.kind.KIND).reshape(SEGMENTS, -1)
            for k, raw in self.parts.items():
                out[k] = np.frombuffer(zlib.decompress(raw), dtype=self.kind.KIND)
            self._counts, self.parts = out.reshape(self.kind.SHAPE), {}
        return self._counts


def merged(kind: type, found: DataFrame) -> Merged:
    """The merged sketch, of fixed size. Segments are merged as they stream by: first those of some input partitions together, then of all."""

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                part = np.frombuffer(zlib.decompress(raw), dtype=kind.KIND)
                total[k] = kind.merge(total[k], part) if k in total else part
        for k, part in total.items():
            yield _row(k, part)

    parts = partitions(found.sparkSession)
    if parts > 2 * SEGMENTS:
        group = F.pmod(F.spark_partition_id(), F.lit(parts // SEGMENTS))
        found = found.repartition(parts, "segment", group).mapInArrow(stage, SEGMENT_SCHEMA)
    return Merged(kind, {row.segment: bytes(row.cells) for row in found.repartition(SEGMENTS, "segment").mapInArrow(stage, SEGMENT_SCHEMA).collect()})
