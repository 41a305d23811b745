"""A minimal perfect hash over 128-bit keys, in numpy, with a fingerprint and a count for each key.

Levels of bit arrays: at each level the keys that are left hash to GAMMA bits a key; a bit that exactly one key meets is
set and that key is settled, the others go on to the next level. A settled key's slot is the number of set bits before its
own, over all levels, so n keys fill slots 0 to n - 1 (some 3.7 bits a key). A key that was never put in may meet a set bit;
the fingerprint in that slot, 64 bits of the key itself, tells it apart.
"""

from __future__ import annotations

import numpy as np

GAMMA = 2
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def _at(high: np.ndarray, low: np.ndarray, level: int, bits: int) -> np.ndarray:
    """A bit's number for each key at a level; both halves of the key take part."""
    with np.errstate(over="ignore"):
        x = high ^ (low * (np.uint64(2 * level + 1) * _ODD))
        x = (x ^ (x >> np.uint64(32))) * _MIX
        x = (x ^ (x >> np.uint64(29))) * _ODD
    return ((x ^ (x >> np.uint64(32))) % np.uint64(bits)).astype(np.int64)


class PerfectHash:
    """Keys are distinct pairs (high, low) of 64 bits; `fingerprints` and `counts` are indexed by slot."""

    def __init__(self, sizes: np.ndarray, words: np.ndarray, fingerprints: np.ndarray, counts: np.ndarray) -> None:
        self.sizes, self.words, self.fingerprints, self.counts = sizes, words, fingerprints, counts
        self.first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])

    @classmethod
    def build(cls, high: np.ndarray, low: np.ndarray, counts: np.ndarray) -> PerfectHash:
        sizes, words, left, level = [], [], np.arange(len(high)), 0
        while len(left):
            bits = -(-len(left) * GAMMA // 64) * 64
            at = _at(high[left], low[left], level, bits)
            met = np.bincount(at, minlength=bits)
            words.append(np.packbits(met == 1, bitorder="little").view(np.uint64))
            sizes.append(bits)
            left, level = left[met[at] != 1], level + 1
        out = cls(np.array(sizes, np.int64), np.concatenate(words) if words else np.zeros(0, np.uint64), np.zeros(len(high), np.uint64), np.zeros(len(high), np.uint32))
        slot = out.slots(high, low)
        out.fingerprints[slot], out.counts[slot] = low, np.minimum(counts, 2**32 - 1)
        return out

    def slots(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """The slot of every key that was put in; some slot or -1 for any other."""
        found = np.full(len(high), -1, dtype=np.int64)
        left = np.arange(len(high))
        for level, bits in enumerate(self.sizes.tolist()):
            if not len(left):
                break
            at = _at(high[left], low[left], level, bits) + self.first[level]
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            held = self.words[word]
            hit = (held >> bit) & np.uint64(1) == 1
            found[left[hit]] = self.before[word[hit]] + np.bitwise_count(held[hit] & ((np.uint64(1) << bit[hit]) - np.uint64(1)))
            left = left[~hit]
        return found

    def lookup(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """The count of every key, 0 for those that weren't put in."""
        slot = self.slots(high, low)
        held = np.flatnonzero(slot >= 0)
        held = held[self.fingerprints[slot[held]] == low[held]]
        out = np.zeros(len(high), dtype=np.int64)
        out[held] = self.counts[slot[held]]
        return out

    def pack(self) -> bytes:
        head = np.array([len(self.sizes), len(self.words), len(self.counts)], np.int64)
        return b"".join(x.tobytes() for x in (head, self.sizes, self.words, self.fingerprints, self.counts))

    @classmethod
    def unpack(cls, raw: bytes) -> PerfectHash:
        levels, words, n = np.frombuffer(raw, np.int64, 3).tolist()
        at, parts = 24, []
        for kind, size in ((np.int64, levels), (np.uint64, words), (np.uint64, n), (np.uint32, n)):
            parts.append(np.frombuffer(raw, kind, size, at))
            at += parts[-1].nbytes
        return cls(*parts)
