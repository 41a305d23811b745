import random

import numpy as np

from tarn.llm import jaccard
from tarn.llm.components import components
from tarn.llm.jaccard import drop_near_duplicates, jaccard_components, link_counts, overlaps


def sets(text, size):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = low.encode().split()
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def brute(rows, size=5, threshold=75):
    s = {}
    for d, t in rows:
        s.setdefault((d, t), sets(t, size))
    keys = [k for k in s if k[0] is not None]
    root = {k: k for k in keys}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    index = {}
    for k in keys:
        for g in s[k]:
            index.setdefault(g, []).append(k)
    seen = set()
    for group in index.values():
        for i, a in enumerate(group):
            for b in group[:i]:
                if (a, b) not in seen:
                    seen.add((a, b))
                    both = len(s[a] & s[b])
                    if 100 * both >= threshold * (len(s[a]) + len(s[b]) - both):
                        x, y = sorted((find(a), find(b)), key=str)
                        root[y] = x
    least = {}
    for k in keys:
        least[find(k)] = min(least.get(find(k), k[0]), k[0])
    return sorted(((d, len(s[d, t]), least[find((d, t))] if d is not None else None) for d, t in rows), key=str)


def fixture_rows(copies=60):
    rng = random.Random(9)
    vocab = [f"w{i}" for i in range(60)] + ["Ä", "ß"]
    line = [rng.choice(vocab) for _ in range(12)]
    rows, doc = [], 0
    for family in range(8):
        base = [rng.choice(vocab) for _ in range(rng.choice([3, 6, 9, 40, 90, 200]))]
        for _ in range(copies if family == 0 else 12):
            w = list(base)
            for _ in range(int(len(w) * rng.choice([0, 0.01, 0.03, 0.06, 0.1]))):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            if rng.random() < 0.3:
                w += line
            rows.append((doc * 37 % 1009, " ".join(w)))
            doc += 1
    rows += [(2000 + i, t) for i, t in enumerate(["", None, " \n", "one", "ONE", "one two", "a b c d", "A B c d", "a b c d e", "a b c d e f", "x " * 5000, "x x x x x x"])]
    return rows


def test_components_equal_brute_force(spark):
    for size, threshold in ((5, 75), (2, 50)):
        rows = fixture_rows()
        docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n int").repartition(6)
        got = jaccard_components(docs, size, threshold).drop("n_links")
        assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, size, threshold)


def test_sample_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted((tuple(r) for r in jaccard_components(docs).drop("n_links").collect()), key=str) == brute(rows)


def test_nulls_repeats_and_empty(spark):
    text = " ".join(f"a{i}" for i in range(30))
    rows = [(7, text), (7, text), (None, text), (9, text + " b"), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((tuple(r) for r in jaccard_components(docs).drop("n_links").collect()), key=str) == sorted([(7, 26, 7), (7, 26, 7), (None, 26, None), (9, 27, 7), (3, 0, 3)], key=str)
    assert sorted((tuple(r) for r in drop_near_duplicates(docs).collect()), key=str) == sorted([(7, text), (3, None)], key=str)
    assert jaccard_components(docs.limit(0)).count() == 0


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(300, 200), (5, 5), (None, 1)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 200: 200, 300: 200}


def brute_kept(rows, size=5, threshold=75):
    """Rows that stay of (doc_id, text, ...): all without words, and of each component of rows the least by doc_id (none last)."""
    s = [sets(r[1], size) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if s[i] and s[j] and 100 * len(s[i] & s[j]) >= threshold * len(s[i] | s[j]):
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i) if s[i] else ("none", i), []).append(rows[i])
    return [min((r[0] is None, r[0] or 0) for r in g) for g in groups.values()], groups


def test_one_row_of_each_group_stays(spark):
    rng = random.Random(2)
    body = [" ".join(f"{c}{k}" for k in range(40)) for c in "abcd"]
    rows = []
    for k in range(90):
        text = body[k % 4] + rng.choice(["", " x", " y z", "\n"])
        rows.append((rng.choice([None, 1, 2, 3, k]), rng.choice([text, text.upper()]), k % 3))
    rows += [(1, None, 0), (None, None, 0), (1, " ", 1), (1, None, 0), (50, "other words", 5), (50, "quite different words here", 5), (None, "lonely", 1), (None, "lonely", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, gone_doc int").repartition(5)
    got = [tuple(r) for r in drop_near_duplicates(docs).collect()]
    least, groups = brute_kept(rows)
    assert sorted((r[0] is None, r[0] or 0) for r in got) == sorted(least)
    for g in groups.values():
        assert sum(r in got for r in set(g)) >= 1
    assert all(got.count(r) <= rows.count(r) for r in got)
    assert drop_near_duplicates(docs.limit(0)).count() == 0 and drop_near_duplicates(docs).columns == docs.columns


def test_overlaps_equal_sets():
    rng = np.random.default_rng(5)
    common = rng.integers(0, 2**63, 300).astype(np.uint64)
    draw = lambda: np.unique(np.concatenate([rng.choice(common, rng.integers(1, 250)), rng.integers(0, 40, 5).astype(np.uint64)]))
    a, b = [draw() for _ in range(130)], [draw() for _ in range(70)]
    want = np.array([[len(np.intersect1d(x, y)) for y in b] for x in a])
    assert (overlaps(a, b) == want).all()
    n, m = link_counts(a, b, 20)
    good = np.array([[100 * len(np.intersect1d(x, y)) >= 20 * len(np.union1d(x, y)) for y in b] for x in a])
    assert good.any() and not good.all() and (n == good.sum(axis=1)).all() and (m == good.sum(axis=0)).all()


def degrees(rows, size=5, threshold=75):
    """Per row: doc_id and the number of different sets of documents with a doc_id that its set links with."""
    s = [(d, frozenset(sets(t, size))) for d, t in rows]
    distinct = {x for d, x in s if d is not None and x}
    count = {x: sum(x != y and 100 * len(x & y) >= threshold * len(x | y) for y in distinct) for x in distinct}
    return sorted(((d, count.get(x, 0) if d is not None else 0) for d, x in s), key=str)


def test_links_equal_brute_force(spark):
    rows = fixture_rows(25)
    # Mutually similar texts, which meet in the same lists of one pivot.
    body = " ".join(f"v{k}" for k in range(100))
    rows += [(5000 + k, f"{body} end{k}") for k in range(12)]
    got = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert sorted(((r.doc_id, r.n_links) for r in got.collect()), key=str) == degrees(rows)
    assert {r.n_links for r in got.filter("doc_id >= 5000").collect()} == {11}


def test_links_of_a_component_of_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_SETS", 4)
    monkeypatch.setattr(jaccard, "SIDE", 3)
    rows = fixture_rows(40)
    got = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert sorted(((r.doc_id, r.n_links) for r in got.collect()), key=str) == degrees(rows)


def near_copies(n, seed=4):
    """A text of 300 words and n copies with 1 to 8 words changed: most pairs link, a few only through others."""
    rng = random.Random(seed)
    base = [f"w{k}" for k in range(300)]
    rows = []
    for d in range(n):
        words = list(base)
        for at in rng.sample(range(300), rng.randint(1, 8)):
            words[at] = f"x{rng.randrange(10**6)}"
        rows.append((d, " ".join(words)))
    return rows


def test_a_group_of_near_copies_is_not_formed_pair_by_pair(spark, monkeypatch):
    rows, formed, kept = near_copies(300), [], jaccard.materialise

    def counted(df, name, *used):
        out = kept(df, name, *used)
        if name == "pairs":
            formed.append(out.count())
        return out

    monkeypatch.setattr(jaccard, "materialise", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = jaccard_components(docs).drop("n_links").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)
    assert sum(formed) < 10 * len(rows)


def test_pairs_across_labels_equal_brute_force():
    rng = np.random.default_rng(8)
    for labels in (1, 2, 5, 200):
        n = np.sort(rng.integers(20, 60, 200))
        label, left = rng.integers(0, labels, 200), n - rng.integers(0, 12, 200)
        want = set()
        for i in range(200):
            for j in range(i):
                if label[i] != label[j] and 100 * n[j] >= 75 * n[i] and min(left[i], left[j]) >= jaccard.least_overlap(n[i], n[j], 75):
                    want.add((j, i))
        got = [tuple(sorted(p)) for i, j in jaccard.across(n, label, left, 75) for p in zip(i.tolist(), j.tolist(), strict=True)]
        assert len(got) == len(set(got)) and set(got) == want
