import hashlib
import random

from tarn.llm import substring
from tarn.llm.substring import dedup_substrings, substring_digest


def brute(rows, window):
    first, words = {}, {}
    for i, (doc, text) in enumerate(rows):
        w = words[i] = (text or "").encode().split()
        if doc is not None:
            for s in range(len(w) - window + 1):
                k = tuple(w[s : s + window])
                first[k] = min(first.get(k, doc), doc)
    out = []
    for i, (doc, _) in enumerate(rows):
        w = words[i]
        gone = set()
        if doc is not None:
            for s in range(len(w) - window + 1):
                if first[tuple(w[s : s + window])] < doc:
                    gone.update(range(s, s + window))
        kept = b" ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((doc, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def fixture_rows():
    rng = random.Random(5)
    vocab = [f"w{i}é" for i in range(40)] + ["A", "b\x0bc"]
    passage = [rng.choice(vocab) for _ in range(90)]
    rows = []
    for doc in range(120):
        w = [rng.choice(vocab) for _ in range(rng.randrange(0, 150))]
        if doc % 3 == 0:
            at, lo = rng.randrange(0, len(w) + 1), rng.randrange(0, 30)
            w[at:at] = passage[lo : lo + rng.randrange(45, 60)]
        rows.append((doc * 7 % 121, rng.choice([" ", "\n", "\t "]).join(w)))
    rows += [(500, " ".join(passage * 300)), (501, " ".join(passage * 3)), (502, ""), (503, None), (504, " \n "), (None, " ".join(passage))]
    rows += [(-4, " ".join(passage[:55])), (-4, " ".join(passage[:55]))]
    return rows


def test_digest_equals_brute_force(spark):
    rows = fixture_rows()
    for window, gram in ((50, 8), (10, 3)):
        got = substring_digest(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), window, gram)
        assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, window)


def test_whole_sample_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted((tuple(r) for r in substring_digest(docs).collect()), key=str) == brute(rows, 50)


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, start int, runs string")
    assert substring_digest(empty).count() == 0
    assert dedup_substrings(empty).columns == ["doc_id", "text", "start", "runs"]


def test_dedup_keeps_rows_and_columns(spark):
    text = " ".join(f"a{i}" for i in range(60))
    rows = [(1, text, 9), (2, "x  y " + text + " z", 8), (3, None, 7), (3, "short\ttext", 6)]
    got = dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string, start int"))
    assert got.columns == ["doc_id", "text", "start"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(1, text, 9), (2, "x y z", 8), (3, None, 7), (3, "short\ttext", 6)], key=str)


def test_rows_that_share_an_id_are_judged_by_their_own_text(spark, monkeypatch):
    w, u = ([f"{c}{i}" for i in range(80)] for c in "wu")
    rows = [(3, " ".join(w)), (7, " ".join(w[20:])), (7, " ".join(u)), (9, " ".join(u[:60]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for most in (substring.RUNS_BROADCAST, 0):  # runs broadcast; rows exchanged
        monkeypatch.setattr(substring, "RUNS_BROADCAST", most)
        assert sorted((r.doc_id, r.n_words, r.n_removed) for r in substring_digest(docs).collect()) == [(3, 80, 0), (7, 60, 60), (7, 80, 0), (9, 60, 60)]
        assert sorted(map(tuple, dedup_substrings(docs).collect())) == [(3, rows[0][1]), (7, ""), (7, rows[2][1]), (9, "")]


def test_both_joins_of_runs_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(substring, "RUNS_BROADCAST", 0)
    rows = fixture_rows() + [(7, "other text"), (None, None), (None, "")] * 30
    got = substring_digest(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), 10, 3)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, 10)
