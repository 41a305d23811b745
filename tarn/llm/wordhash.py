"""Vectorised word hashing: whole Arrow string columns to word spans, word hashes and n-gram hashes.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D. All arithmetic is modulo 2**64: a word's hash is a
polynomial in its bytes (each byte mapped through a random table), finished by a bit mixer; an n-gram's hash is a
polynomial in its word hashes, mixed again. Equal word sequences always get equal hashes, in any process.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are hashed at a time; a longer single text is hashed alone.
SLICE_BYTES = 1 << 19

WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True


def _splitmix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = x + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


mix = _splitmix


class Family:
    """One hash function: byte table and the powers of two odd multipliers with their inverses."""

    def __init__(self, seed: int, lower: bool) -> None:
        seeds = _splitmix(np.arange(1, 259, dtype=np.uint64) + np.uint64(seed * 1009))
        self.bytes = seeds[:256].copy()
        if lower:
            self.bytes[65:91] = self.bytes[97:123]
        self.bytes[WHITE] = 0
        self.p, self.q = (int(x) | 5 for x in seeds[256:258])
        self._powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def powers(self, base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        """base**i and base**-i for i < n."""
        got = self._powers.get(base)
        if got is None or len(got[0]) < n:
            size = max(n, 1 << 16)
            got = tuple(self._row(b, size) for b in (base, pow(base, -1, 1 << 64)))
            if size <= 2 * SLICE_BYTES:
                self._powers[base] = got
        return got[0][:n], got[1][:n]

    @staticmethod
    def _row(base: int, n: int) -> np.ndarray:
        out = np.ones(n, dtype=np.uint64)
        done = 1
        while done < n:
            step = min(done, n - done)
            out[done : done + step] = out[:step] * np.uint64(pow(base, done, 1 << 64))
            done += step
        return out


@dataclass
class Words:
    """The words of a run of texts. doc: for each word the index of its text; first: for each text its first word."""

    doc: np.ndarray
    first: np.ndarray
    hashes: list[np.ndarray]

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def _buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    return offsets, raw


def spans(offsets: np.ndarray, raw: np.ndarray, white: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words in raw (offsets start at 0), and first: index of each text's first word."""
    inside = ~white[raw]
    edges = offsets[(offsets > 0) & (offsets < len(raw))]
    before = np.empty_like(inside)
    if len(raw):
        before[0] = False
        before[1:] = inside[:-1]
        before[edges] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    if len(raw):
        after[-1] = False
        after[:-1] = inside[1:]
        after[edges - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def slices(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, end text, offsets from 0, bytes) of consecutive runs of about SLICE_BYTES."""
    offsets, raw = _buffers(column)
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, "right")) - 1)
        yield at, to, offsets[at : to + 1] - offsets[at], raw[offsets[at] : offsets[to]]
        at = to


def word_hashes(offsets: np.ndarray, raw: np.ndarray, families: list[Family]) -> Words:
    starts, _, first = spans(offsets, raw)
    out = []
    with np.errstate(over="ignore"):
        for f in families:
            if not len(starts):
                out.append(np.zeros(0, dtype=np.uint64))
                continue
            powers, inverse = f.powers(f.p, len(raw))
            out.append(_splitmix(np.add.reduceat(f.bytes[raw] * powers, starts) * inverse[starts]))
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(doc, first, out)


def grams(words: Words, family: Family, which: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Start words and hashes of all runs of `size` words inside one text."""
    h = words.hashes[which]
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        powers, inverse = family.powers(family.q, len(h))
        sums = np.zeros(len(h) + 1, dtype=np.uint64)
        np.cumsum(h * powers, out=sums[1:])
        g = (sums[size:] - sums[:-size]) * inverse[:n]
    at = np.flatnonzero(words.doc[:n] == words.doc[size - 1 :])
    return at, _splitmix(g[at] ^ np.uint64(size))
