import hashlib
import re

import corpus_pipeline
from tarn.llm.quality import quality_scores
from tests.llm.test_decontaminate import brute as contaminated
from tests.llm.test_jaccard import brute as groups

SF = "/root/testdata/sf0.001"


def without_repeats(texts, window=50):
    """Of each document, its text without the words of windows that a smaller doc_id has; None where nothing goes."""
    words = {d: re.split(r"[ \t-\r]+", (t or "").strip(" \t\n\x0b\x0c\r")) for d, t in texts}
    least = {}
    for d, w in words.items():
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            least[key] = min(least.get(key, d), d)
    out = {}
    for d, w in words.items():
        gone = {x for i in range(len(w) - window + 1) if least[tuple(w[i : i + window])] < d for x in range(i, i + window)}
        out[d] = " ".join(x for k, x in enumerate(w) if k not in gone) if gone else None
    return out


def by_row(rows, window=50):
    """The text that each (doc_id, text) row keeps; rows with a null id neither cut nor are cut."""
    words = [(t or "").encode().split() for _, t in rows]
    least = {}
    for (d, _), w in zip(rows, words, strict=True):
        for i in range(len(w) - window + 1 if d is not None else 0):
            key = tuple(w[i : i + window])
            least[key] = min(least.get(key, d), d)
    out = []
    for (d, t), w in zip(rows, words, strict=True):
        gone = {x for i in range(len(w) - window + 1 if d is not None else 0) if least[tuple(w[i : i + window])] < d for x in range(i, i + window)}
        out.append(b" ".join(x for k, x in enumerate(w) if k not in gone).decode() if gone else t)
    return out


def odd_rows(good):
    """Rows with nulls, repeated ids, long and empty texts; `good` are texts that the classifier keeps."""
    a, b, c = good
    rows = [(None, a, "en", None, 1), (7, a, None, "s", 1), (7, a, "en", "s", 1), (7, b, "en", "s", 2), (9, a + " more", "en", "s", 3), (None, b, "en", "s", None)]
    rows += [(11, None, "en", "s", 0), (12, "", "en", "s", 0), (None, None, None, None, None), (13, " ".join([c] * 200), "en", "s", 5), (14, c, "en", "s", 5)]
    return rows


def test_stages_on_odd_rows(spark):
    read = spark.read.parquet(f"{SF}/documents.parquet")
    labels, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("labels", "benchmark"))
    leak = bench.filter("length(text) > 100").first().text
    scores = {r.doc_id: r.score for r in quality_scores(read, labels).collect()}
    good = [r.text for r in sorted(read.collect(), key=lambda r: -scores[r.doc_id]) if len(r.text.split()) > 60][:3]
    rows = [*odd_rows(good), (15, leak + " " + good[2], "en", "s", 6), (None, leak, "en", "s", 6)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    wide = spark.createDataFrame([(*r, 1, 2) for r in rows], schema + ", runs int, quality_score int").repartition(3)
    for docs in (wide.select(*[c.split()[0] for c in schema.split(", ")]), wide):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            if name != "tokenise":
                assert out.columns == docs.columns
            got = [tuple(r) for r in out.collect()]
            assert stage(spark, docs.limit(0), SF).count() == 0
            if name == "decontaminate":
                assert sorted(map(str, got)) == sorted(str(tuple(r)) for r in docs.collect() if r.text is None or leak not in r.text)
            if name == "near_duplicates":  # of (7, a) twice, (None, a) and (9, a + " more") one row stays, of the two b the one with an id
                assert sorted([r[0] for r in got if r[1] in (good[0], good[1])], key=str) == [7, 7] and not [r for r in got if r[0] == 9]
                assert sum(not r[1] for r in got) == 3
            if name == "substring_dedup":
                assert len(got) == len(rows) and sum(r[0] is None for r in got) == sum(r[0] is None for r in rows)
                # By row, whatever its id: only windows of a smaller id go; kept texts are as they were.
                given = [tuple(r) for r in docs.collect()]
                want = [(t[0], kept, *t[2:4]) for t, kept in zip(given, by_row([t[:2] for t in given]), strict=True)]
                assert sorted(map(str, want)) == sorted(str((r[0], r[1], *r[2:4])) for r in got)
            if name == "tokenise":
                assert len(got) == len(rows)


def test_stages_take_effect_and_keep_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r for r in docs.collect()}
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        kept[name] = {r.doc_id: r for r in out.collect()}
        texts = [(d, r.text) for d, r in sorted(before.items())]
        if name == "near_duplicates":
            assert set(kept[name]) == {d for d, _, c in groups(texts) if c == d}
        if name == "decontaminate":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            assert set(kept[name]) == {x[0] for x in contaminated(texts, items) if not x[5]}
        if name == "substring_dedup":
            assert set(kept[name]) == set(before)
            cut = without_repeats([(d, t) for d, t in texts])
            for d, r in kept[name].items():
                assert cut[d] is None and r.text == before[d].text or r.text == cut[d]
                assert r.n_chars == len(r.text) and (r.text == before[d].text or len(re.split(r"[ \t-\r]+", r.text)) < len(re.split(r"[ \t-\r]+", before[d].text)))
        if name == "quality_filter":
            scores = {r.doc_id: r.predicted for r in quality_scores(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect()}
            assert set(kept[name]) == {d for d, p in scores.items() if p} and len(kept[name]) < len(before)
        docs = spark.createDataFrame([tuple(r) for r in kept[name].values()], docs.schema)
    last = {r.doc_id: r for r in corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()}
    assert set(last) == set(kept["decontaminate"]) and all(len(r.ids) == r.n_tokens == sum(r.slice_tokens) for r in last.values())
    assert all(r.decoded_sha256 == hashlib.sha256(kept["decontaminate"][d].text.encode()).hexdigest() for d, r in last.items())
    whole = {r.doc_id: list(r.ids) for r in corpus_pipeline.run(spark, SF).collect()}
    assert whole == {d: list(r.ids) for d, r in last.items()}
