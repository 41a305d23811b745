import hashlib
import random
import re

from tarn.llm.decontaminate import decontamination_digest, remove_documents, remove_spans


def split(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", low) if w]


def brute(docs, items, window=10):
    grams = {}
    for item, text in items:
        w = split(text)
        n = min(len(w), window)
        for s in range(len(w) - n + 1 if w and item is not None else 0):
            grams.setdefault(tuple(w[s : s + n]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, got = split(text), set(), set()
        for n in {len(g) for g in grams}:
            for s in range(len(w) - n + 1):
                if (g := tuple(w[s : s + n])) in grams:
                    hit.update(range(s, s + n))
                    got |= grams[g]
        names = ",".join(sorted(map(str, got)))
        out.append((doc, len(w), len(hit), len(got), hashlib.sha256(names.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def fixture_rows():
    rng = random.Random(2)
    vocab = [f"w{i}" for i in range(30)] + ["é1", "Ünder"]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.choice([25, 40, 12, 10, 9, 4])))) for i in range(12)]
    items += [(12, ""), (13, None), (14, items[0][1].upper()), (3, items[4][1]), (None, "w1"), (15, "!!")]
    docs = []
    for d in range(80):
        w = [rng.choice(vocab) for _ in range(rng.randrange(0, 80))]
        if d % 4 == 0:
            piece = split(items[rng.randrange(12)][1])
            lo = rng.randrange(0, max(1, len(piece) - 9))
            w[len(w) // 2 : len(w) // 2] = piece[lo : lo + rng.randrange(8, 30)]
        docs.append((d, rng.choice([" ", "-", ", "]).join(w)))
    docs += [(5, docs[0][1]), (5, docs[0][1]), (None, docs[4][1]), (90, None), (91, ""), (92, (docs[4][1] + " ") * 200)]
    return docs, items


def frames(spark, docs, items):
    return spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, items int").repartition(3), spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, doc_id string")


def test_digest_equals_brute_force(spark):
    docs, items = fixture_rows()
    for part in (items, [i for i in items if len(split(i[1])) >= 10], [], [(1, "w1")]):
        d, b = frames(spark, docs, part)
        assert sorted((tuple(r) for r in decontamination_digest(d, b).collect()), key=str) == brute(docs, part)


def test_shuffled_set_gives_the_same(spark):
    from tarn.llm import decontaminate

    docs, items = fixture_rows()
    d, b = frames(spark, docs, items)
    rows = decontaminate._rows(d, "doc_id", "text")
    assert sorted(map(str, decontaminate.hits(rows, b, set_bytes=0).drop("row").collect())) == sorted(map(str, decontaminate.hits(rows, b).drop("row").collect()))


def test_removal_judges_each_row_by_its_text(spark):
    docs, items = fixture_rows()
    d, b = frames(spark, docs, items)
    dirty = {x[1] for x in docs if brute([x], items)[0][5]}
    left = remove_documents(d, b)
    assert left.columns == d.columns
    assert sorted((tuple(r)[:2] for r in left.collect()), key=str) == sorted((x for x in docs if x[1] not in dirty), key=str)
    cut = [tuple(r)[:2] for r in remove_spans(d, b).collect()]
    assert remove_spans(d, b).columns == d.columns and len(cut) == len(docs)
    assert sorted((x for x in docs if x[1] not in dirty), key=str) == sorted((r for r in cut if r in docs and r[1] not in dirty), key=str)
    hit = {(x[0], x[1]): (x[0], n[1] - n[2]) for x in docs if x[1] in dirty for n in brute([x], items)}
    assert sorted(((r[0], len(split(r[1]))) for r in cut if r not in docs), key=str) == sorted((hit[x] for x in docs if x[1] in dirty), key=str)
    b2 = spark.createDataFrame([(1, "Alpha beta gamma")], "item_id long, text string")
    d2 = spark.createDataFrame([(1, "<x> ALPHA, beta; gamma! éa Keep-this.", 0), (2, "alpha beta", 1), (3, None, 2)], "doc_id long, text string, hit_text int")
    assert {r.doc_id: r.text for r in remove_spans(d2, b2).collect()} == {1: "<x> éa Keep-this.", 2: "alpha beta", 3: None}
    assert remove_documents(d2.limit(0), b2).count() == 0
    # A dirty and a clean row share an id; a dirty row has none.
    mixed = spark.createDataFrame([(None, "alpha beta gamma"), (7, "so Alpha beta gamma it is"), (7, "all clean here"), (None, "clean")], "doc_id long, text string")
    assert sorted((tuple(r) for r in remove_documents(mixed, b2).collect()), key=str) == [(7, "all clean here"), (None, "clean")]
    assert sorted((tuple(r) for r in remove_spans(mixed, b2).collect()), key=str) == sorted([(None, ""), (7, "so it is"), (7, "all clean here"), (None, "clean")], key=str)
