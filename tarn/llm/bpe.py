r"""Byte-level BPE encoding and decoding.

Pre-tokenisation uses no regular expression. Each code point has a class; each class (two more for an apostrophe that may
begin a contraction) is a function from states to states. These functions compose, and composition is associative, so a scan by
doubling steps finds the state before every code point of many texts at once; boundaries follow from that state and the
classes around it. The scan ends as soon as every prefix is a constant function, after two or three steps on ordinary
text and after logarithmically many on any text. The automaton is that of

    's|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+

The slices between boundaries go through a pair merger with a bounded cache. Encoding keeps each slice's byte offsets; decoding joins the bytes of the ids.

Defined results: a null or empty text has no ids (`encode` gives empty arrays, and decodes to no bytes); texts are encoded whole, whatever their length;
special tokens are ordinary text; rows may repeat; other columns are untouched by `encode`, which replaces columns of the same name as its results.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .frames import arrow_stage, fresh, whole_texts
from .wordhash import slices

LETTER, NUMBER, SPACE, WHITE, OTHER, QUOTE1, QUOTE2 = range(7)
CLASSES = 7
#: States: closed (a match has just ended, or the text begins), inside letters, numbers, other signs, after a space, after other white space, one or two letters of a contraction to come.
CLOSED, IN_LETTERS, IN_NUMBERS, IN_OTHER, AFTER_SPACE, AFTER_WHITE, ONE_MORE, TWO_MORE = range(8)
STEP = {
    LETTER: (1, 1, 1, 1, 1, 1, CLOSED, ONE_MORE),
    NUMBER: (IN_NUMBERS,) * 8,
    SPACE: (AFTER_SPACE,) * 8,
    WHITE: (AFTER_WHITE,) * 8,
    OTHER: (IN_OTHER,) * 8,
    QUOTE1: (ONE_MORE, ONE_MORE, ONE_MORE, IN_OTHER, IN_OTHER, ONE_MORE, IN_OTHER, IN_OTHER),
    QUOTE2: (TWO_MORE, TWO_MORE, TWO_MORE, IN_OTHER, IN_OTHER, TWO_MORE, IN_OTHER, IN_OTHER),
}
#: Slices of more bytes are merged with a heap, in time n log n.
LONG_SLICE = 48
#: Slices that a worker's cache holds in each of its two generations.
CACHE_SLICES = 400_000


def _monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids 0..6: the classes' functions; 7..13: the same at the begin of a text. Composition table (first, then second), constant value of each id or -1."""
    functions = [STEP[c] for c in range(CLASSES)] + [(STEP[c][CLOSED],) * 8 for c in range(CLASSES)]
    known: dict[tuple[int, ...], int] = {}
    for k, f in enumerate(functions):
        known.setdefault(f, k)
    done = 0
    while done < len(functions):
        for a in range(len(functions)):
            for f, g in ((functions[a], functions[done]), (functions[done], functions[a])):
                h = tuple(g[x] for x in f)
                if h not in known:
                    known[h] = len(functions)
                    functions.append(h)
        done += 1
    n = len(functions)
    table = np.array([[known[tuple(functions[b][x] for x in functions[a])] for b in range(n)] for a in range(n)], dtype=np.uint8)
    constant = np.array([f[0] if len(set(f)) == 1 else -1 for f in functions], dtype=np.int8)
    return table, constant, np.array([known[f] for f in functions[: 2 * CLASSES]], dtype=np.uint8)


COMPOSE, CONSTANT, FIRST_ID = _monoid()


def code_point_classes() -> np.ndarray:
    r"""The class of every code point. \p{L}, \p{N} and \s come from the engine behind tiktoken where that is installed
    (Unicode versions differ between libraries), else from unicodedata."""
    points = [i for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    out = np.full(0x110000, OTHER, dtype=np.uint8)
    try:
        import tiktoken

        whole = "".join(map(chr, points))
        for pattern, kind in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", WHITE)):
            probe = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks={bytes([i]): i for i in range(256)}, special_tokens={})
            out[np.frombuffer(bytes(probe.encode_ordinary(whole)).decode().encode("utf-32-le"), dtype=np.uint32)] = kind
    except ImportError:
        for i in points:
            c = chr(i)
            out[i] = {"L": LETTER, "N": NUMBER}.get(unicodedata.category(c)[0], WHITE if c.isspace() and not 0x1C <= i <= 0x1F else OTHER)
    out[0x20] = SPACE
    return out


def states_before(symbol: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """The automaton's state before each symbol; begins: True where a text begins (the first symbol always does)."""
    prefix = FIRST_ID[symbol + CLASSES * begins]
    step = 1
    open_ = np.flatnonzero(CONSTANT[prefix] < 0)
    while len(open_):
        prefix[open_] = COMPOSE[prefix[open_ - step], prefix[open_]]
        open_ = open_[CONSTANT[prefix[open_]] < 0]
        step *= 2
    before = np.empty(len(symbol), dtype=np.int8)
    before[0] = CLOSED
    before[1:] = CONSTANT[prefix[:-1]]
    before[begins] = CLOSED
    return before


def boundaries(points: np.ndarray, begins: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """True at each code point that begins a match of the pattern."""
    if not len(points):
        return np.zeros(0, dtype=bool)
    symbol = classes[points]
    quote = np.flatnonzero(points == 0x27)
    if len(quote):
        joined = np.concatenate([points, np.zeros(2, dtype=points.dtype)])
        cut = np.concatenate([begins, np.ones(2, dtype=bool)])
        one = np.where(cut[quote + 1], 0, joined[quote + 1])
        two = np.where(cut[quote + 1] | cut[quote + 2], 0, joined[quote + 2])
        symbol[quote[np.isin(one, [ord(c) for c in "stmd"])]] = QUOTE1
        pair = np.zeros(len(quote), dtype=bool)
        for a, b in ("re", "ve", "ll"):
            pair |= (one == ord(a)) & (two == ord(b))
        symbol[quote[pair]] = QUOTE2
    before = states_before(symbol, begins)
    white = (symbol == SPACE) | (symbol == WHITE)
    followed = np.zeros(len(points), dtype=bool)
    followed[:-1] = ~white[1:] & ~begins[1:]
    in_white = (before == AFTER_SPACE) | (before == AFTER_WHITE)
    spaced = before == AFTER_SPACE
    letter = (symbol == LETTER) & (before != IN_LETTERS) & ~spaced & (before != ONE_MORE) & (before != TWO_MORE)
    number = (symbol == NUMBER) & (before != IN_NUMBERS) & ~spaced
    other = (symbol >= OTHER) & (before != IN_OTHER) & ~spaced
    return begins | letter | number | other | (white & (~in_white | followed))


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file (base64 token and rank in each line), read on the driver; its size is the vocabulary's."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


class Merger:
    """Slices to token ids, with a cache of bounded size. decimals: with each slice's ids goes their text, as the digest of ids needs it; without, the cache takes half."""

    def __init__(self, ranks: dict[bytes, int], decimals: bool = True) -> None:
        self.ranks, self.decimals = ranks, decimals
        self.vocabulary: list[bytes] = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.vocabulary[rank] = token
        self.young: dict[bytes, tuple] = {}
        self.old: dict[bytes, tuple] = {}

    def __call__(self, piece: bytes) -> tuple:
        """The ids of a slice; with decimals, (ids, their decimals joined by commas)."""
        got = self.young.get(piece)
        if got is None:
            got = self.old.get(piece)
            if got is None:
                rank = self.ranks.get(piece)
                ids = (rank,) if rank is not None else self.merge(piece) if len(piece) <= LONG_SLICE else self.merge_long(piece)
                got = (ids, b",".join([b"%d" % i for i in ids])) if self.decimals else ids
            if len(self.young) >= CACHE_SLICES:
                self.old, self.young = self.young, {}
            if len(piece) <= 256:
                self.young[piece] = got
        return got

    def merge(self, piece: bytes) -> tuple[int, ...]:
        ranks = self.ranks
        last = len(self.vocabulary)
        parts = [piece[i : i + 1] for i in range(len(piece))]
        pairs = [ranks.get(piece[i : i + 2], last) for i in range(len(piece) - 1)]
        while pairs:
            least = min(pairs)
            if least == last:
                break
            at = pairs.index(least)
            token = parts[at] + parts[at + 1]
            parts[at : at + 2] = [token]
            del pairs[at]
            if at:
                pairs[at - 1] = ranks.get(parts[at - 1] + token, last)
            if at < len(pairs):
                pairs[at] = ranks.get(token + parts[at + 1], last)
        return tuple([ranks[p] for p in parts])

    def merge_long(self, piece: bytes) -> tuple[int, ...]:
        ranks, n = self.ranks, len(piece)
        token: list[bytes | None] = [piece[i : i + 1] for i in range(n)]
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r, i, piece[i : i + 2]) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, joined = heapq.heappop(heap)
            a = token[i]
            if a is None or right[i] >= n or len(a) >= len(joined) or a + token[right[i]] != joined:
                continue
            j = right[i]
            token[i], token[j] = joined, None
            right[i] = right[j]
            if right[i] < n:
                left[right[i]] = i
                if (r := ranks.get(pair := joined + token[right[i]])) is not None:
                    heapq.heappush(heap, (r, i, pair))
            if left[i] >= 0 and (r := ranks.get(pair := token[left[i]] + joined)) is not None:
                heapq.heappush(heap, (r, left[i], pair))
        return tuple([ranks[t] for t in token if t is not None])

    def decode(self, ids) -> bytes:
        return b"".join(map(self.vocabulary.__getitem__, ids))


def cut_slices(offsets: np.ndarray, raw: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets at which pre-tokens begin, with the end appended, and for each text its first pre-token."""
    data = raw.tobytes()
    points = np.frombuffer(data.decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    lead = np.flatnonzero((raw & 0xC0) != 0x80)
    begins = np.zeros(len(points), dtype=bool)
    begins[np.searchsorted(lead, offsets[:-1][np.diff(offsets) > 0])] = True
    starts = lead[boundaries(points, begins, classes)]
    return np.append(starts, len(raw)), np.searchsorted(starts, offsets)


def _encoded(column: pa.Array, classes: np.ndarray, merger: Merger) -> Iterator[tuple[bytes, list, np.ndarray]]:
    """For each text: its bytes, what the merger gives for each slice, and the byte offset of each slice in the text."""
    for _, _, offsets, raw in slices(column):
        starts, first = cut_slices(offsets, raw, classes)
        data, bounds = raw.tobytes(), starts.tolist()
        got = [merger(data[a:b]) for a, b in zip(bounds, bounds[1:])]  # noqa: B905
        for k, (lo, hi) in enumerate(zip(first[:-1], first[1:], strict=True)):
            yield data[offsets[k] : offsets[k + 1]], got[lo:hi], starts[lo:hi] - offsets[k]


def _stage(spark: SparkSession, vocabulary_path: str, at: int, build: Callable, decimals: bool = True) -> Callable:
    """A task's function: build(batch, encoded texts of column `at`, merger) for each batch."""
    shared = spark.sparkContext.broadcast((read_ranks(vocabulary_path), code_point_classes()))

    def make():
        ranks, classes = shared.value
        merger = Merger(ranks, decimals)
        return lambda batches: (build(b, _encoded(b.column(at), classes, merger), merger) for b in batches)

    return make


def encode_digest(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256 (of the decimal ids joined by commas), decoded_sha256 (of the bytes the ids decode to)."""

    def build(batch, encoded, merger):
        n, ids_sha, text_sha = [], [], []
        for _, got, _ in encoded:
            ids = list(chain.from_iterable([g[0] for g in got]))
            n.append(len(ids))
            ids_sha.append(hashlib.sha256(b",".join([g[1] for g in got])).hexdigest())
            text_sha.append(hashlib.sha256(merger.decode(ids)).hexdigest())
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    docs = whole_texts(docs)
    return arrow_stage(docs, _stage(docs.sparkSession, vocabulary_path, 1, build), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


RESULTS = ("ids", "slice_offsets", "slice_tokens")
DIGEST = "decoded_sha256"


def encode(docs: DataFrame, vocabulary_path: str, text: str = "text", offsets: bool = True, digest: bool = False) -> DataFrame:
    """docs with ids array<int>, and for each pre-token slice_offsets array<int> (its first byte in the text) and slice_tokens array<int> (its number of ids);
    without `offsets`, ids alone. With `digest` also decoded_sha256, of the bytes that the ids decode to: the round trip of every row.

    All columns of docs stay; where one has the name of a result, the result's name gets an underscore more."""
    results = [*RESULTS[: 3 if offsets else 1], *[DIGEST] * digest]
    names = [fresh(docs, r) for r in results]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    at = docs.columns.index(text)

    def build(batch, encoded, merger):
        found: dict[str, list] = {r: [] for r in (*RESULTS, DIGEST)}
        for _, got, starts in encoded:
            ids = np.fromiter(chain.from_iterable(got), dtype=np.int32)
            found["ids"].append(ids)
            found["slice_offsets"].append(starts.astype(np.int32))
            found["slice_tokens"].append(np.fromiter(map(len, got), dtype=np.int32))
            if digest:
                found[DIGEST].append(hashlib.sha256(merger.decode(ids.tolist())).hexdigest())
        return pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(found[r], pa.string() if r == DIGEST else pa.list_(pa.int32())) for r in results)], [*batch.schema.names, *names])

    make = _stage(docs.sparkSession, vocabulary_path, at, build, decimals=False)
    return arrow_stage(docs, make, ", ".join([fields, *(f"`{n}` {'string' if r == DIGEST else 'array<int>'}" for n, r in zip(names, results, strict=True))]))


def decode(encoded: DataFrame, vocabulary_path: str, ids: str = "ids") -> DataFrame:
    """encoded with decoded binary (decoded_ where that name is taken): the bytes of its ids (null for null)."""
    ranks = read_ranks(vocabulary_path)
    shared = encoded.sparkSession.sparkContext.broadcast(ranks)

    @F.pandas_udf("binary")
    def joined(column):
        merger = Merger(shared.value, decimals=False)
        return column.map(lambda x: None if x is None else merger.decode(x))

    return encoded.withColumn(fresh(encoded, "decoded"), joined(F.col(f"`{ids}`")))
