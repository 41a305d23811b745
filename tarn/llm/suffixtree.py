"""Language-model scoring with a probabilistic suffix tree over words, beside exact word counts.

Model. A token is a word (A-Z lower-cased) or a text's end; all unknown words are one symbol. Contexts are the last one or two tokens (a text's
start is written as an end; a context of two doesn't reach beyond it). With c and C the counts of an event (context and next token) and of a context in
the training text, a shorter context being the suffix of a longer one:

- root: P0(w) = (c(w) - d) / (N + 1), unknown words share (d V + 1) / (N + 1), d the absolute discount n1 / (n1 + 2 n2);
- one token: P1(w) = (c + PRIOR * P0(w)) / (C + PRIOR);
- two tokens: P2(w) = (c + (REST + S) * P1(w)) / (C + REST). Events whose suffix event occurs once are not stored under the longer context: their
  number S goes back to the suffix.

Contexts need LEAST occurrences, whatever the corpus's size, so the tree grows with the corpus. Of these a context is retained if a divergence test finds its
distribution better than its suffix's: the sum, over its own training occurrences, of ln(P of the context / P of its suffix), each occurrence left out of the
counts that predict it, must be positive (for this test alone, P1 travels rounded to a tenth of its logarithm). A token is scored in the longest retained suffix of its history. Smoothing goes through all shorter contexts.

Training. Documents are written once, bucketed by chunk (a part of an input partition), so that texts aren't shuffled and each pass sees the same chunks.
Each chunk works on arrays of its tokens; what it asks travels packed to buckets by hash, is summed there over all chunks, and comes back in the order of the
question:

1. distinct words and pairs with their counts -> exact counts of both;
2. words: the chunk's part of their divergence sums -> retained or not; contexts of two tokens with their stored events -> retained or not, S, and event counts.
   All events of a context meet in one bucket, but those of contexts of HOT occurrences or more: these travel by event, so that no bucket holds them all.
3. only if there are such contexts: each chunk's part of their divergence sums, from the counts that came back -> retained or not. Both ways sum the same terms,
   in whole multiples of 1 / FINE, so HOT decides where a context is judged and never how.

Words are told apart by 48 bits of hash within a bucket, pairs and contexts by 32 (a few in ten thousand share their counts with another, at any size, as buckets grow
in number with the input).

Defined results: a null or empty text has the end token alone; a null doc_id counts as training text (its crc32 is null) and is scored like others;
rows may repeat and count each; without training text all words are unknown and every score is 0; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import materialise, partitions, shared_dir
from .wordhash import Family, mix, slices, word_hashes

#: Fewest occurrences of a context, and those from which on its events travel each by its own hash.
LEAST, HOT = 2, 1 << 20
#: Weights of the suffix's distribution, in occurrences, for contexts of one and of two tokens.
PRIOR, REST = 100.0, 1.0
FAMILY = 41
#: Bytes of input for a chunk.
CHUNK_BYTES = 4 << 20
#: Divergence sums of words and of contexts of two tokens are added as whole multiples of 1 / UNIT and 1 / FINE, so that their order doesn't matter.
UNIT, FINE = 64, 1 << 20
END_TOKEN = mix(np.array([0xE0D], dtype=np.uint64))[0]
_ODD = np.uint64(0x9E3779B97F4A7C15)
SENT = "target int, chunk long, bucket int, packed binary"
COUNTED = "chunk long, bucket int, step int, packed binary, tokens long, types long, ones long, twos long, most long"
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def held_out(key: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(5)) == 1, F.lit(False))


# Packing: parts of a row one after another, each with a known number of entries.


def planes(x: np.ndarray, width: int) -> bytes:
    """The lowest `width` bytes of each entry, byte by byte: sorted entries then compress well."""
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def small(x: np.ndarray) -> bytes:
    """Counts: one byte each, and eight more where that is full."""
    return np.minimum(x, 255).astype(np.uint8).tobytes() + x[x >= 255].astype("<i8").tobytes()


class Parts:
    """Reads what the functions above wrote."""

    def __init__(self, raw: bytes) -> None:
        self.raw, self.at = raw, 0

    def array(self, kind: type, n: int) -> np.ndarray:
        out = np.frombuffer(self.raw, kind, n, self.at)
        self.at += out.nbytes
        return out

    def number(self) -> int:
        return int(self.array(np.int64, 1)[0])

    def planes(self, n: int, width: int) -> np.ndarray:
        out = np.zeros((n, 8), dtype=np.uint8)
        out[:, :width] = self.array(np.uint8, n * width).reshape(width, n).T
        return out.view("<u8").ravel()

    def small(self, n: int) -> np.ndarray:
        out = self.array(np.uint8, n).astype(np.int64)
        full = np.flatnonzero(out == 255)
        out[full] = self.array(np.int64, len(full))
        return out

    def bits(self, n: int) -> np.ndarray:
        return np.unpackbits(self.array(np.uint8, -(-n // 8)), count=n).astype(bool)


def number(n: int) -> bytes:
    return np.int64(n).tobytes()


def width(parts: int) -> int:
    """Bits of a word's hash within its bucket."""
    return min(48, 64 - parts.bit_length())


def keyed(hashes: np.ndarray, parts: int, bits: int) -> np.ndarray:
    """Bucket (from the upper half of the hash), then `bits` bits of the hash: keys in order lie in order of their buckets."""
    bucket = ((hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    return (bucket << np.uint64(bits)) | (hashes & np.uint64((1 << bits) - 1))


def edges(keys: np.ndarray, parts: int, bits: int) -> np.ndarray:
    return np.searchsorted(keys >> np.uint64(bits), np.arange(parts + 1, dtype=np.uint64))


@dataclass
class Tokens:
    """The tokens of a run of texts, each text's end after its words; hashes of the events of two and three tokens that each ends (0: beyond the text's start)."""

    token: np.ndarray
    doc: np.ndarray
    first: np.ndarray
    events: list[np.ndarray]

    @staticmethod
    def of(hashes: np.ndarray, first: np.ndarray) -> Tokens:
        """first: for each text its first word, and the number of words."""
        texts = len(first) - 1
        doc = np.repeat(np.arange(texts, dtype=np.int32), np.diff(first) + 1)
        token = np.full(len(hashes) + texts, END_TOKEN, dtype=np.uint64)
        inner = np.ones(len(token), dtype=bool)
        inner[first[1:] + np.arange(texts)] = False
        token[inner] = hashes
        begins = first[:-1] + np.arange(texts)
        events = []
        before = np.append(END_TOKEN, token[:-1])[: len(token)]
        before[begins] = END_TOKEN
        with np.errstate(over="ignore"):
            for k in (1, 2):
                event = mix(mix(before + np.uint64(k)) ^ (token * _ODD))
                if k == 2:
                    event[begins] = 0
                events.append(event)
                before = np.append(np.uint64(0), event[:-1])[: len(token)]
        return Tokens(token, doc, begins, events)

    @staticmethod
    def read(column: pa.ChunkedArray) -> Tokens:
        family, hashes, sizes = Family(FAMILY, lower=True), [], []
        for piece in column.chunks:
            for _, _, offsets, raw in slices(piece):
                words = word_hashes(offsets, raw, [family])
                hashes.append(words.hashes[0])
                sizes.append(words.counts())
        return Tokens.of(np.concatenate(hashes), np.append(0, np.cumsum(np.concatenate(sizes))))

    def before(self, x: np.ndarray, at_start) -> np.ndarray:
        """x of the token before each; at_start for a text's first."""
        out = np.empty_like(x)
        out[1:] = x[:-1]
        out[self.first] = at_start
        return out


@dataclass
class Counted:
    """A chunk's tokens with the exact counts of words and pairs, and their probabilities at the root and after one token."""

    tokens: Tokens
    words: np.ndarray
    word: np.ndarray
    counts: np.ndarray
    end: int
    times: np.ndarray
    pairs: np.ndarray
    pair: np.ndarray
    pair_times: np.ndarray
    context: np.ndarray
    root: np.ndarray
    after: np.ndarray

    @staticmethod
    def of(tokens: Tokens, back: list[tuple[int, int, bytes]], parts: int, totals: Totals) -> Counted:
        words, word = np.unique(keyed(tokens.token, parts, width(parts)), return_inverse=True)
        pairs, pair = np.unique(keyed(tokens.events[0], parts, 32), return_inverse=True)
        of_word, of_pair = edges(words, parts, width(parts)), edges(pairs, parts, 32)
        counts, pair_counts = np.zeros(len(words), dtype=np.int64), np.zeros(len(pairs), dtype=np.int64)
        for step, b, raw in back:
            if step == 1:
                part = Parts(raw)
                counts[of_word[b] : of_word[b + 1]] = part.small(of_word[b + 1] - of_word[b])
                pair_counts[of_pair[b] : of_pair[b + 1]] = part.small(of_pair[b + 1] - of_pair[b])
        end = int(np.searchsorted(words, keyed(np.array([END_TOKEN]), parts, width(parts))[0]))
        times, pair_times = counts[word], pair_counts[pair]
        context = tokens.before(times, counts[end])
        root = totals.root(times)
        after = np.where(context >= LEAST, (pair_times + PRIOR * root) / (context + PRIOR), root)
        return Counted(tokens, words, word, counts, end, times, pairs, pair, pair_times, context, root, after)

    def word_before(self) -> np.ndarray:
        return self.tokens.before(self.word, self.end)

    def word_gains(self, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The words that are contexts, as places in `words`, and this chunk's part of their divergence sums, in units."""
        some = np.flatnonzero(train & (self.context >= LEAST))
        root = self.root[some]
        ratio = np.log((self.pair_times[some] - 1 + PRIOR * root) / ((self.context[some] - 1 + PRIOR) * root))
        total = np.bincount(self.word_before()[some], np.rint(UNIT * ratio), len(self.words))
        at = np.flatnonzero(self.counts >= LEAST)
        return at, total[at].astype(np.int64)


@dataclass
class Longer:
    """The contexts of two tokens of a chunk: which tokens have one, the distinct contexts, and their stored events: by context, those of hot contexts by event."""

    tokens: np.ndarray
    keys: np.ndarray
    of: np.ndarray
    hot: np.ndarray
    total: np.ndarray
    stored: np.ndarray
    events: np.ndarray
    sample: np.ndarray
    event: np.ndarray
    spread_stored: np.ndarray
    spread: np.ndarray
    spread_event: np.ndarray

    @staticmethod
    def find(c: Counted, parts: int, hottest: int) -> Longer:
        total = c.tokens.before(c.pair_times, 0)
        at = np.flatnonzero(total >= LEAST)
        total = total[at]
        keys, of = np.unique(c.tokens.before(c.pairs[c.pair], np.uint64(0))[at], return_inverse=True)
        hot = np.zeros(len(keys), dtype=bool)
        hot[of] = total >= hottest
        stored = np.flatnonzero(c.pair_times[at] > 1)
        spread_stored, stored = stored[hot[of[stored]]], stored[~hot[of[stored]]]
        events, sample, event = np.unique((of[stored].astype(np.uint64) << np.uint64(32)) | (c.tokens.token[at[stored]] >> np.uint64(32)), return_index=True, return_inverse=True)
        spread, spread_event = np.unique(keyed(c.tokens.events[1][at[spread_stored]], parts, 32), return_inverse=True)
        return Longer(at, keys, of, hot, total, stored, events, sample, event, spread_stored, spread, spread_event)

    def cuts(self, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where each bucket begins among the contexts, among their events and among the hot contexts' events."""
        own = edges(self.keys, parts, 32)
        return own, np.searchsorted(self.events >> np.uint64(32), own.astype(np.uint64)), edges(self.spread, parts, 32)


def level(after: np.ndarray) -> np.ndarray:
    """Probabilities after one token, as they travel for the divergence test."""
    return np.clip(np.rint(-10 * np.log(after)), 0, 255).astype(np.uint8)


def fine_gain(count: np.ndarray, rest: np.ndarray, total: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Of one training occurrence of a stored event: its gain by its context, in units of 1 / FINE."""
    suffix = np.exp(-0.1 * low)
    return np.rint(FINE * np.log(np.maximum(count - 1 + (REST + rest) * suffix, 1e-300) / (np.maximum(total - 1 + REST, REST) * suffix)))


def fine_rest(rest: np.ndarray, total: np.ndarray) -> np.ndarray:
    """The same of an occurrence whose event isn't stored."""
    return np.rint(FINE * np.log((REST + np.maximum(rest - 1, 0)) / np.maximum(total - 1 + REST, REST)))


@dataclass
class Totals:
    tokens: int
    types: int
    ones: int
    twos: int

    def root(self, times: np.ndarray) -> np.ndarray:
        discount = float(np.clip(self.ones / max(self.ones + 2 * self.twos, 1), 0.1, 0.9))
        return np.where(times > 0, times - discount, discount * self.types + 1) / (self.tokens + 1)

    def base(self, times: np.ndarray) -> np.ndarray:
        return np.log10((times + 0.5) / (self.tokens + 0.5 * (self.types + 1)))


def _rows(chunk: int, packed: Iterator[tuple[int, bytes]]) -> pa.Table:
    rows = [(b, raw) for b, raw in packed]
    bucket = pa.array([r[0] for r in rows], pa.int32())
    return pa.table([bucket, pa.array([chunk] * len(rows), pa.int64()), bucket, pa.array([r[1] for r in rows], pa.binary())], names=["target", "chunk", "bucket", "packed"])


def _train(texts: pa.Table, doc: np.ndarray) -> np.ndarray:
    return texts.column("train").to_numpy().astype(bool)[doc]


def _ask_counts(parts: int):
    def ask(texts: pa.Table) -> pa.Table:
        tokens = Tokens.read(texts.column("text"))
        train = _train(texts, tokens.doc)
        found = []
        for hashes, bits in ((tokens.token, width(parts)), (tokens.events[0], 32)):
            keys = keyed(hashes, parts, bits)
            own = np.sort(keys[train])
            keys = np.sort(keys)
            keys = keys[np.append(True, keys[1:] != keys[:-1])]
            found.append((keys, np.searchsorted(own, keys, "right") - np.searchsorted(own, keys), edges(keys, parts, bits), -(-bits // 8)))

        def packed() -> Iterator[tuple[int, bytes]]:
            for b in range(parts):
                out = []
                for keys, counts, edge, size in found:
                    here = slice(edge[b], edge[b + 1])
                    out += [number(edge[b + 1] - edge[b]), planes(keys[here], size), small(counts[here])]
                if found[0][2][b + 1] > found[0][2][b] or found[1][2][b + 1] > found[1][2][b]:
                    yield b, b"".join(out)

        return _rows(texts.column("chunk")[0].as_py(), packed())

    return ask


def _held(batches: Iterator[pa.RecordBatch]) -> tuple[list[tuple[int, int]], list[bytes]]:
    who, raw = [], []
    for batch in batches:
        who += zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)
        raw += batch.column(3).to_pylist()
    return who, raw


def _answers(who: list[tuple[int, int]], step: int, packed: list[bytes], totals: tuple = (0, 0, 0, 0, 0)) -> Iterator[pa.RecordBatch]:
    """A row for each question, and one with the bucket's totals."""
    names = [f.split()[0] for f in COUNTED.split(", ")]
    for lo in range(0, len(who), 64):
        part, n = who[lo : lo + 64], len(who[lo : lo + 64])
        yield pa.RecordBatch.from_arrays([pa.array([w[0] for w in part], pa.int64()), pa.array([w[1] for w in part], pa.int32()), pa.array([step] * n, pa.int32()), pa.array(packed[lo : lo + 64], pa.binary()), *[pa.array([0] * n, pa.int64())] * 5], names)
    yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int32()), pa.array([step], pa.int32()), pa.nulls(1, pa.binary()), *(pa.array([int(t)], pa.int64()) for t in totals)], names)


def _count(parts: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        who, raws = _held(batches)
        if not who:
            return
        readers, answers, totals = [Parts(r) for r in raws], [[] for _ in who], None
        for bits in (width(parts), 32):
            keys, counts = [], []
            for (_, b), reader in zip(who, readers, strict=True):
                n = reader.number()
                keys.append(reader.planes(n, -(-bits // 8)) & np.uint64((1 << bits) - 1) | np.uint64(b << bits))
                counts.append(reader.small(n))
            found, inverse = np.unique(np.concatenate(keys), return_inverse=True)
            total = np.bincount(inverse, np.concatenate(counts), len(found)).astype(np.int64)
            if totals is None:
                totals = total.sum(), (total > 0).sum(), (total == 1).sum(), (total == 2).sum()
            at = 0
            for answer, own in zip(answers, keys, strict=True):
                answer.append(small(total[inverse[at : at + len(own)]]))
                at += len(own)
        yield from _answers(who, 1, [b"".join(a) for a in answers], (*totals, total.max(initial=0)))

    return count


def _ask_contexts(parts: int, totals: Totals, hot: int):
    def ask(texts: pa.Table, counts: pa.Table) -> pa.Table:
        tokens = Tokens.read(texts.column("text"))
        train = _train(texts, tokens.doc)
        c = Counted.of(tokens, _back(counts), parts, totals)
        words, gains = c.word_gains(train)
        keys = c.words[words] >> np.uint64(width(parts) - 32)
        longer = Longer.find(c, parts, hot)
        used = train[longer.tokens]
        stored = np.zeros(len(used), dtype=bool)
        stored[longer.stored] = stored[longer.spread_stored] = True
        skipped = np.bincount(longer.of[used & ~stored], minlength=len(longer.keys))
        times = np.bincount(longer.event, used[longer.stored], len(longer.events)).astype(np.int64)
        spread_times = np.bincount(longer.spread_event, used[longer.spread_stored], len(longer.spread)).astype(np.int64)
        low = level(c.after[longer.tokens[longer.stored[longer.sample]]])
        each = np.bincount((longer.events >> np.uint64(32)).astype(np.int64), minlength=len(longer.keys))
        of_word, (of_context, of_event, of_spread) = edges(keys, parts, 32), longer.cuts(parts)

        def packed() -> Iterator[tuple[int, bytes]]:
            for b in range(parts):
                w, x, e, d = (slice(edge[b], edge[b + 1]) for edge in (of_word, of_context, of_event, of_spread))
                if w.stop > w.start or x.stop > x.start or d.stop > d.start:
                    head = [number(w.stop - w.start), planes(keys[w], 4), planes(gains[w], 4)]
                    body = [number(x.stop - x.start), planes(longer.keys[x], 4), small(each[x]), small(skipped[x]), number(e.stop - e.start), planes(longer.events[e], 4), small(times[e]), low[e].tobytes()]
                    yield b, b"".join([*head, *body, number(d.stop - d.start), planes(longer.spread[d], 4), small(spread_times[d])])

        return _rows(texts.column("chunk")[0].as_py(), packed())

    return ask


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums the divergence of words, and counts and judges contexts of two tokens with all their events."""
    who, raws = _held(batches)
    if not who:
        return
    words, gains, contexts, skipped, events, times, low, spread, spread_times = ([] for _ in range(9))
    at = 0
    owners = []
    for (_, b), raw in zip(who, raws, strict=True):
        part, high = Parts(raw), np.uint64(b << 32)
        n = part.number()
        words.append(part.planes(n, 4) | high)
        gains.append(part.planes(n, 4).astype(np.uint32).view(np.int32))
        n = part.number()
        contexts.append(part.planes(n, 4) | high)
        each = part.small(n)
        skipped.append(part.small(n))
        k = part.number()
        owners.append(np.repeat(np.arange(at, at + n), each))
        events.append(part.planes(k, 4))
        times.append(part.small(k))
        low.append(part.array(np.uint8, k))
        k = part.number()
        spread.append(part.planes(k, 4) | high)
        spread_times.append(part.small(k))
        at += n
    found, inverse = np.unique(np.concatenate(words), return_inverse=True)
    good = (np.bincount(inverse, np.concatenate(gains), len(found)) > 0)[inverse]
    names, of = np.unique(np.concatenate(contexts), return_inverse=True)
    rest = np.bincount(of, np.concatenate(skipped), len(names))
    owner = of[np.concatenate(owners)]
    distinct, sample, event = np.unique((owner.astype(np.uint64) << np.uint64(32)) | np.concatenate(events), return_index=True, return_inverse=True)
    count = np.bincount(event, np.concatenate(times), len(distinct))
    owner = owner[sample]
    total = rest + np.bincount(owner, count, len(names))
    seen = np.flatnonzero(count > 0)
    own = owner[seen]
    gain = np.bincount(own, count[seen] * fine_gain(count[seen], rest[own], total[own], np.concatenate(low)[sample][seen]), len(names))
    kept = gain + rest * fine_rest(rest, total) > 0
    split, split_of = np.unique(np.concatenate(spread), return_inverse=True)
    split_count = np.bincount(split_of, np.concatenate(spread_times), len(split)).astype(np.int64)
    rest, count = rest.astype(np.int64), count.astype(np.int64)
    answers, w, x, e, d = [], 0, 0, 0, 0
    for a, b, c, f in zip(words, contexts, events, spread, strict=True):
        here = of[x : x + len(b)]
        answers.append(b"".join([np.packbits(good[w : w + len(a)]).tobytes(), np.packbits(kept[here]).tobytes(), small(rest[here]), small(count[event[e : e + len(c)]]), small(split_count[split_of[d : d + len(f)]])]))
        w, x, e, d = w + len(a), x + len(b), e + len(c), d + len(f)
    yield from _answers(who, 2, answers)


@dataclass
class Judged:
    """What came back to a chunk: for each of its words and contexts whether it is retained, and the counts of its events."""

    good: np.ndarray
    kept: np.ndarray
    rest: np.ndarray
    times: np.ndarray

    @staticmethod
    def of(c: Counted, longer: Longer, back: list[tuple[int, int, bytes]], parts: int) -> Judged:
        words = np.flatnonzero(c.counts >= LEAST)
        of_word = edges(c.words[words] >> np.uint64(width(parts) - 32), parts, 32)
        of_context, of_event, of_spread = longer.cuts(parts)
        hot = np.flatnonzero(longer.hot)
        of_hot = edges(longer.keys[hot], parts, 32)
        good, kept, rest = np.zeros(len(c.words), dtype=bool), np.zeros(len(longer.keys), dtype=bool), np.zeros(len(longer.keys), dtype=np.int64)
        count, spread = np.zeros(len(longer.events), dtype=np.int64), np.zeros(len(longer.spread), dtype=np.int64)
        for step, b, raw in sorted(back, key=lambda row: row[0]):
            part = Parts(raw)
            if step == 2:
                w, x, e, d = (slice(edge[b], edge[b + 1]) for edge in (of_word, of_context, of_event, of_spread))
                good[words[w]] = part.bits(w.stop - w.start)
                kept[x] = part.bits(x.stop - x.start)
                rest[x] = part.small(x.stop - x.start)
                count[e] = part.small(e.stop - e.start)
                spread[d] = part.small(d.stop - d.start)
            elif step == 3:
                h = hot[of_hot[b] : of_hot[b + 1]]
                kept[h] = part.bits(len(h))
        times = np.zeros(len(longer.of), dtype=np.int64)
        times[longer.stored] = count[longer.event]
        times[longer.spread_stored] = spread[longer.spread_event]
        return Judged(good, kept, rest, times)


def _ask_hot(parts: int, totals: Totals, hot: int):
    """The chunk's parts of the divergence sums of hot contexts."""

    def ask(texts: pa.Table, counts: pa.Table) -> pa.Table:
        tokens = Tokens.read(texts.column("text"))
        back = _back(counts)
        c = Counted.of(tokens, back, parts, totals)
        longer = Longer.find(c, parts, hot)
        judged = Judged.of(c, longer, back, parts)
        some = np.flatnonzero(longer.hot[longer.of] & _train(texts, tokens.doc)[longer.tokens])
        of, total = longer.of[some], longer.total[some]
        stored = c.pair_times[longer.tokens[some]] > 1
        gain = np.where(stored, fine_gain(judged.times[some], judged.rest[of], total, level(c.after[longer.tokens[some]])), fine_rest(judged.rest[of], total))
        at = np.flatnonzero(longer.hot)
        sums = np.bincount(of, gain, len(longer.keys))[at].astype(np.int64)
        keys = longer.keys[at]
        edge = edges(keys, parts, 32)
        here = ((b, slice(edge[b], edge[b + 1])) for b in range(parts) if edge[b + 1] > edge[b])
        return _rows(texts.column("chunk")[0].as_py(), ((b, number(x.stop - x.start) + planes(keys[x], 4) + sums[x].tobytes()) for b, x in here))

    return ask


def _judge_hot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    who, raws = _held(batches)
    if not who:
        return
    keys, sums = [], []
    for (_, b), raw in zip(who, raws, strict=True):
        part = Parts(raw)
        n = part.number()
        keys.append(part.planes(n, 4) | np.uint64(b << 32))
        sums.append(part.array(np.int64, n))
    found, of = np.unique(np.concatenate(keys), return_inverse=True)
    kept = (np.bincount(of, np.concatenate(sums), len(found)) > 0)[of]
    ends = np.cumsum([len(k) for k in keys])
    yield from _answers(who, 3, [np.packbits(kept[end - len(k) : end]).tobytes() for k, end in zip(keys, ends, strict=True)])


def _back(counts: pa.Table) -> list[tuple[int, int, bytes]]:
    return list(zip(*(counts.column(c).to_pylist() for c in ("step", "bucket", "packed")), strict=True))


def log_probabilities(c: Counted, back: list[tuple[int, int, bytes]], parts: int, hot: int) -> np.ndarray:
    """Of each token, the natural logarithm of its probability in the longest retained suffix of its history."""
    longer = Longer.find(c, parts, hot)
    judged = Judged.of(c, longer, back, parts)
    p = np.where(judged.good[c.word_before()], c.after, c.root)
    here = np.flatnonzero(judged.kept[longer.of])
    at = longer.tokens[here]
    p[at] = (judged.times[here] + (REST + judged.rest[longer.of[here]]) * c.after[at]) / (longer.total[here] + REST)
    return np.log(p)


def _score(parts: int, totals: Totals, hot: int):
    def score(texts: pa.Table, counts: pa.Table) -> pa.Table:
        tokens = Tokens.read(texts.column("text"))
        back = _back(counts)
        c = Counted.of(tokens, back, parts, totals)
        n = texts.num_rows
        of = lambda x: np.bincount(tokens.doc, x, n)
        train = texts.column("train").to_numpy().astype(bool)
        whole = lambda x: pa.array(x.astype(np.int64))
        score = of(log_probabilities(c, back, parts, hot)) / math.log(10)
        return pa.table([texts.column("doc_id"), pa.array(~train), whole(np.bincount(tokens.doc, minlength=n)), whole(of(c.times > 0)), whole(np.full(n, totals.tokens)), pa.array(of(totals.base(c.times))), pa.array(score)], names=[f.split()[0] for f in SCORES.split(", ")])

    return score


def _chunked(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc_id, train, chunk, text), written once and bucketed by chunk: passes over it need no exchange of texts."""
    spark = docs.sparkSession
    split = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    own = F.col(f"`{key}`").cast("long")
    chunk = F.xxhash64(F.spark_partition_id(), F.pmod(F.xxhash64(own), F.lit(max(1, -(-int(split) // CHUNK_BYTES)))))
    rows = docs.select(own.alias("doc_id"), (~held_out(own)).alias("train"), chunk.alias("chunk"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    name = f"suffix_tree_texts_{uuid.uuid4().hex}"
    rows.write.format("parquet").bucketBy(partitions(spark), "chunk").option("path", f"{shared_dir(spark)}/{name}").saveAsTable(name)
    texts = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # its name alone: the files are in the shared folder
    return texts


def suffix_tree_scores(docs: DataFrame, key: str = "doc_id", text: str = "text", hot: int = HOT) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    parts = partitions(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    texts = _chunked(docs, key, text)
    dealt = lambda asked: asked.repartitionById(parts, F.col("target"))
    counts = materialise(dealt(texts.groupBy("chunk").applyInArrow(_ask_counts(parts), SENT)).mapInArrow(_count(parts), COUNTED), "counts")
    found = counts.agg(*(F.sum(c) for c in ("tokens", "types", "ones", "twos")), F.max("most")).first()
    *sums, most = (int(t or 0) for t in found)
    totals = Totals(*sums)
    counts = counts.filter("chunk is not null")
    asked = texts.groupBy("chunk").cogroup(counts.groupBy("chunk")).applyInArrow(_ask_contexts(parts, totals, hot), SENT)
    counts = counts.unionByName(materialise(dealt(asked).mapInArrow(_judge, COUNTED), "contexts").filter("chunk is not null"))
    if most >= hot:
        asked = texts.groupBy("chunk").cogroup(counts.groupBy("chunk")).applyInArrow(_ask_hot(parts, totals, hot), SENT)
        counts = counts.unionByName(materialise(dealt(asked).mapInArrow(_judge_hot, COUNTED), "hot").filter("chunk is not null"))
    return texts.groupBy("chunk").cogroup(counts.groupBy("chunk")).applyInArrow(_score(parts, totals, hot), SCORES)
