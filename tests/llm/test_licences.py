import hashlib
import re

from tarn.llm.licences import KNOWN, SPELLINGS, licence_scan


def form(line):
    low = line.lower()
    if re.search(r"^[^a-z0-9(©]*(copyright\b|©|\(c\))|^[^a-z]*all rights reserved[^a-z]*$", low):
        return ""
    text = " " + re.sub(r"[\W_]+", " ", low).strip(" ") + " "
    for a, b in SPELLINGS:
        text = text.replace(a, b)
    return text.strip(" ")


def brute(rows, known=KNOWN):
    digest = lambda f: hashlib.sha256(f.encode()).hexdigest()
    join = lambda lines: " ".join(x for x in lines if x)
    table = {}
    for name, body in known:
        table.setdefault(digest(join(map(form, body.split("\n")))), set()).add(name)
    out = []
    for doc, text in rows:
        lines = [form(x) for x in re.split(r"\r\n|\r|\n", text or "")]
        paragraphs = [join(p.split("\n")) for p in re.split(r"\n{2,}", "\n".join(lines)) if "\n" in p]
        units = [join(lines), *paragraphs, *(lines if len(lines) > 1 else [])]
        hits = [table[digest(u)] for u in units if u and digest(u) in table]
        names = sorted(set().union(*hits)) if hits else []
        whole = ",".join(sorted(table[digest(units[0])])) if units[0] and digest(units[0]) in table else None
        out.append((doc, ",".join(names), len(hits), whole))
    return sorted(out, key=str)


def test_equals_brute_force(spark):
    mit, apache = KNOWN[0][1], "Licensed under the Apache Licence, version 2.0"
    rows = [(1, mit), (2, "Copyright (c) 2020 Someone\n\n" + mit.upper().replace(",", " ;") + "\nAll rights reserved."), (3, f"text before\n{apache}!\nafter"), (4, apache), (5, f"{mit} and more"), (6, None), (7, ""), (7, ""), (None, apache)]
    rows += [(8, "intro\n\n" + mit.replace(". ", ".\n") + "\n\nend"), (9, "(c) x\n" * 500), (10, "long " * 100_000), (11, "Released under\nthe MIT License"), (12, apache + "\n" + apache + "\r\nThis work is licensed under the GNU GPL v3")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, names string").repartition(3)
    got = sorted((tuple(r) for r in licence_scan(df).collect()), key=str)
    assert got == brute(rows)
    assert {r[0]: r[1] for r in got}[2] == "MIT" and {r[0]: r[3] for r in got}[2] == "MIT" and {r[0]: r[1] for r in got}[12] == "Apache-2.0,GPL-3.0"
    assert licence_scan(df.limit(0)).count() == 0 and licence_scan(df, []).filter("n_units > 0").count() == 0


def test_sample(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = sorted((tuple(r) for r in licence_scan(docs).collect()), key=str)
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()]) and any(r[1] for r in got)


def test_usual_licence_files(spark):
    import textwrap
    from pathlib import Path

    mit, bsd = (next(b for n, b in KNOWN if n == name and len(b) > 500) for name in ("MIT", "BSD-3-Clause"))
    owner = "Copyright (c) 2021 Some Body"
    files = {}
    for k, width in enumerate((50, 72, 79, 100)):
        wrapped = lambda body, w=width: "\n\n".join(textwrap.fill(p, w) for p in body.split("\n"))
        files[f"MIT {k}"] = ("MIT", f"MIT License\n\n{owner}\n\n{wrapped(mit)}\n")
        files[f"BSD {k}"] = ("BSD-3-Clause", f"BSD 3-Clause License\n\nCopyright 2020, Some Body\nAll rights reserved.\n\n{wrapped(bsd)}\n")
        files[f"bullets {k}"] = ("BSD-3-Clause", f"Copyright The Project Authors\n\n{wrapped(re.sub(r'(?m)^[123][.] ', '* ', bsd))}\n")
    for name, file in {"Apache-2.0": "Apache-2.0", "GPL-2.0": "GPL-2", "GPL-3.0": "GPL-3", "LGPL-2.1": "LGPL-2.1", "LGPL-3.0": "LGPL-3", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0"}.items():
        text = (Path(__file__).parents[2] / "tarn/llm/licence_texts" / f"{file}.txt").read_text()
        files[file] = (name, text)
        files[f"{file} rewrapped"] = (name, "\n\n".join(textwrap.fill(p, 60) if "opyright (" not in p and "opyright [" not in p else p for p in re.split(r"\n\s*\n", text)))
        files[f"{file} without heading"] = (name, text.strip("\n").split("\n\n", 1)[1])
    rows = [(i, text) for i, (_, text) in enumerate(files.values())]
    got = {r.doc_id: r.whole for r in licence_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {n: got[i] for i, n in enumerate(files)} == {n: want for n, (want, _) in files.items()}
