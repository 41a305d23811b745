import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from tarn.llm.suffixtree import HOT, LEAST, PRIOR, REST, UNIT, Parts, Tokens, Totals, edges, keyed, number, planes, small, suffix_tree_scores, width
from tarn.llm.wordhash import mix


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split(r"[\x20\x09-\x0D]+", low) if w]


def base(rows):
    held = {d for d, _ in rows if d is not None and zlib.crc32(str(d).encode()) % 5 == 1}
    count = Counter()
    for d, t in rows:
        if d not in held:
            count.update([*words(t), None])
    n, v = sum(count.values()), len(count)
    return sorted(((d, d in held, len(words(t)) + 1, sum(count[w] > 0 for w in [*words(t), None]), n, round(sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in [*words(t), None]), 6)) for d, t in rows), key=str)


def rounded(df):
    return sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in df.collect()), key=str)


def test_base_equals_brute_force(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice("The a of É ß x1 of-of on\x0bin".split(" ")) for _ in range(rng.randrange(0, 40)))) for i in range(150)]
    rows += [(3, rows[3][1]), (3, rows[3][1]), (None, "lonely word"), (900, None), (901, ""), (902, "w" * 50_000 + " y"), (903, "new unseen")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, chunk string").repartition(5)
    got = suffix_tree_scores(df)
    assert rounded(got) == base(rows)
    assert all(r.score < 0 and math.isfinite(r.score) for r in got.collect())
    assert suffix_tree_scores(df.limit(0)).count() == 0


def test_sample_beats_the_base_on_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = suffix_tree_scores(docs)
    assert rounded(got) == base([(r.doc_id, r.text) for r in docs.collect()])
    held = [(r.score, r.base_score) for r in got.collect() if r.held_out]
    assert sum(s for s, _ in held) > sum(b for _, b in held)


def plain_scores(rows):
    """The model of the module's description, with dictionaries; log10 scores by row."""
    training = [[*words(t), None] for d, t in rows if d is None or zlib.crc32(str(d).encode()) % 5 != 1]
    word, pair, triple = Counter(), Counter(), Counter()

    def spelt(tokens):
        before = [None, *tokens]
        for k, w in enumerate(tokens):
            yield w, before[k], (before[k - 1], before[k]) if k else None

    for t in training:
        for w, one, two in spelt(t):
            word[w] += 1
            pair[one, w] += 1
            if two:
                triple[two, w] += 1
    n, v, ones, twos = sum(word.values()), len(word), sum(c == 1 for c in word.values()), sum(c == 2 for c in word.values())
    d = min(max(ones / max(ones + 2 * twos, 1), 0.1), 0.9)
    p0 = lambda w: (word[w] - d if word[w] else d * v + 1) / (n + 1)
    p1 = lambda one, w: (pair[one, w] + PRIOR * p0(w)) / (word[one] + PRIOR) if word[one] >= LEAST else p0(w)
    stored = {k: c for k, c in triple.items() if pair[k[0][1], k[1]] > 1}
    rest = Counter()
    for (two, w), c in triple.items():
        if (two, w) not in stored:
            rest[two] += c
    p2 = lambda two, w: (stored.get((two, w), 0) + (REST + rest[two]) * p1(two[1], w)) / (pair[two] + REST)
    gain1, gain2 = Counter(), Counter()
    for t in training:
        for w, one, two in spelt(t):
            if word[one] >= LEAST:
                gain1[one] += round(UNIT * math.log((pair[one, w] - 1 + PRIOR * p0(w)) / (word[one] - 1 + PRIOR) / p0(w)))
            if two and pair[two] >= LEAST:
                low = math.exp(-0.1 * min(max(round(-10 * math.log(p1(two[1], w))), 0), 255))  # as it travels
                left = stored[two, w] - 1 + (REST + rest[two]) * low if (two, w) in stored else (REST + rest[two] - 1) * low
                gain2[two] += math.log(left / (pair[two] - 1 + REST) / low)
    kept1 = {k for k, g in gain1.items() if g > 0}
    kept2 = {k for k, g in gain2.items() if g > 1e-9}
    out = []
    for i, t in rows:
        total = sum(math.log10(p2(two, w) if two in kept2 else p1(one, w) if one in kept1 else p0(w)) for w, one, two in spelt([*words(t), None]))
        out.append((i, round(total, 3)))
    return sorted(out, key=str), len(kept1), len(kept2), len(gain1) + len(gain2)


def test_scores_equal_a_plain_model(spark):
    rng = random.Random(8)
    vocab = [f"w{int(rng.paretovariate(0.7))}" for _ in range(400)]
    phrases = [[rng.choice(vocab) for _ in range(6)] for _ in range(12)]
    rows = []
    for i in range(260):
        tokens = []
        for _ in range(rng.randrange(0, 9)):
            tokens += rng.choice(phrases) if rng.random() < 0.4 else [rng.choice(vocab) for _ in range(4)]
        rows.append((i, " ".join(tokens)))
    rows += [rows[5], (None, rows[7][1]), (901, None), (902, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want, one, two, candidates = plain_scores(rows)
    assert 10 < one and 10 < two and one + two < candidates
    for hot in (HOT, 20, 3):  # where contexts are judged doesn't matter
        got = sorted(((r.doc_id, round(r.score, 3)) for r in suffix_tree_scores(docs, hot=hot).collect()), key=str)
        assert all(g[0] == w[0] and abs(g[1] - w[1]) < 0.002 for g, w in zip(got, want, strict=True))


def test_distributions_sum_to_one():
    """Over all known words, the end and the unknown word, whatever the history: as in the formulas, with counts of a chunk."""
    rng = random.Random(1)
    texts = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 30))) for _ in range(60)]
    tokens = Tokens.read(pa.chunked_array([texts], pa.string()))
    words_, counts = np.unique(keyed(tokens.token, 4, width(4)), return_counts=True)
    totals = Totals(int(counts.sum()), len(counts), int((counts == 1).sum()), int((counts == 2).sum()))
    assert abs(totals.root(np.append(counts, 0)).sum() - 1) < 1e-9


def test_packing_round_trip():
    rng = np.random.default_rng(2)
    x = np.sort(rng.integers(0, 1 << 32, 1000).astype(np.uint64))
    counts = rng.integers(0, 600, 1000)
    flags = rng.random(1000) < 0.3
    part = Parts(number(1000) + planes(x, 4) + small(counts) + np.packbits(flags).tobytes() + planes(-counts, 4))
    n = part.number()
    assert (part.planes(n, 4) == x).all() and (part.small(n) == counts).all() and (part.bits(n) == flags).all()
    assert (part.planes(n, 4).astype(np.uint32).view(np.int32) == -counts).all() and part.at == len(part.raw)


def test_keys_lie_in_order_of_buckets():
    h = np.random.default_rng(3).integers(0, 1 << 63, 10_000).astype(np.uint64) * np.uint64(2)
    for parts, bits in ((1, 32), (7, 48), (211, 32)):
        keys = np.unique(keyed(h, parts, bits))
        assert int(keys.max() >> np.uint64(bits)) < parts and edges(keys, parts, bits)[-1] == len(keys)


def test_repeated_documents_score_above_others(spark):
    """Of two held-out documents of the same words, that whose phrases the training text repeats scores higher, at any corpus size."""
    train = [i for i in range(4000) if zlib.crc32(str(i).encode()) % 5 != 1]
    rows = [(i, "filler words that make every context rare " * 20) for i in train[20:]]
    rows += [(i, "leftabc yyone" if k % 2 else "rightabc yytwo") for k, i in enumerate(train[:20])]
    held = [i for i in range(4000, 5000) if zlib.crc32(str(i).encode()) % 5 == 1]
    rows += [(held[0], "leftabc yyone"), (held[1], "leftabc yytwo"), (held[2], "rightabc yytwo"), (held[3], "rightabc yyone")]
    got = {r.doc_id: r.score for r in suffix_tree_scores(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[held[0]] > got[held[1]] + 0.2 and got[held[2]] > got[held[3]] + 0.2


def test_events_are_those_of_plain_slicing():
    """One hash for each event of two and three tokens, and none that would reach beyond its text."""
    rng = random.Random(4)
    texts = [[rng.choice("abcdef") for _ in range(rng.randrange(0, 7))] for _ in range(300)]
    code = {c: mix(np.array([ord(c)], dtype=np.uint64))[0] for c in "abcdef"}
    hashes = np.array([code[c] for t in texts for c in t], dtype=np.uint64)
    tokens = Tokens.of(hashes, np.concatenate([[0], np.cumsum([len(t) for t in texts])]))
    name, at = {}, 0
    for i, t in enumerate(texts):
        for k, c in enumerate([*t, None]):
            two, three = (t[k - 1] if k else None, c), (t[k - 2] if k > 1 else None, t[k - 1], c) if k else None
            assert name.setdefault(int(tokens.events[0][at]), two) == two and tokens.doc[at] == i
            assert (tokens.events[1][at] == 0) == (three is None)
            if three:
                assert name.setdefault(int(tokens.events[1][at]), three) == three
            at += 1
    assert at == len(tokens.token) and len(set(name.values())) == len(name)
