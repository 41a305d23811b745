import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tarn.llm.merkle import build_tree, manifest_proofs


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, lower=False):
    doc, source, lang, n, text = row
    if lower and text is not None:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc, source, lang, n, text)))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][i : i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def others(tree, at):
    for level in tree[:-1]:
        lo = at // 8 * 8
        yield level[lo:at], level[at + 1 : lo + 8]
        at //= 8


def brute(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[g] = levels([leaf(r) for r in groups[g]])
    top = levels([trees[g][-1][0] for g in names])
    root = top[-1][0] if names else None
    out = []
    for k, g in enumerate(names):
        for at, row in enumerate(groups[g]):
            sides = [*others(trees[g], at), *others(top, k)]
            node = leaf(row, row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0)
            for left, right in sides:
                node = H(*left, node, *right)
            out.append((row[0], leaf(row), trees[g][-1][0], root, H(*(d for left, right in sides for d in (*left, *right))), node, node == root))
    return sorted(out, key=str)


def table(n):
    rows = [(i * 7 % 1000 - 5, ["web", None, "é"][i % 3], ["en", "en", "de", None, "ß", ""][i % 6] if i % 11 else f"l{i}", i if i % 4 else None, [None, "", "Text ABC é", "lower"][i % 4]) for i in range(n)]
    return rows + [(None, "web", "en", 1, "Null id"), (3, "a", "en", 1, "Twice"), (3, "a", "en", 1, "Twice"), (3, "b", "en", 1, "Again")] if n else rows


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


@pytest.mark.parametrize("height", [1, 2, 4])
def test_proofs_equal_brute_force(spark, height):
    # Lower blocks make several layers of blocks in a small table.
    rows = table(700)
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("tree", F.lit("clash")).withColumn("pos", F.lit(1)).repartition(5)
    got = sorted(map(tuple, manifest_proofs(docs, height=height).collect()), key=str)
    assert got == brute(rows)
    assert {r[-1] for r in got} == {True, False}


def test_small_trees(spark):
    for rows in ([], [(5, "a", None, 3, "X")], [(5, "a", "en", 3, "X"), (6, "a", "de", 3, "Y")], [(i, "s", "en", 1, "T") for i in range(9)]):
        assert sorted(map(tuple, manifest_proofs(spark.createDataFrame(rows, SCHEMA)).collect()), key=str) == brute(rows)


def test_one_id_in_a_third_of_rows(spark):
    rows = [(1, "a", "en", 1, "Same")] * 300 + [(i, "a", "en", 1, str(i)) for i in range(600)]
    assert sorted(map(tuple, manifest_proofs(spark.createDataFrame(rows, SCHEMA)).collect()), key=str) == brute(rows)


def test_versions_copy_one_path_and_share_the_rest(spark):
    rows = [(i, "s", "en" if i % 5 else "de", 1, "T") for i in range(200)]
    tree = build_tree(spark.createDataFrame(rows, SCHEMA), F.col("doc_id") == 77, F.sha2(F.lit("new"), 256))
    got = tree.versions().orderBy("level").collect()
    ids = [r[0] for r in rows if r[2] == "en"]
    nodes = levels([leaf(r) for r in rows if r[2] == "en"])
    at = ids.index(77)
    assert [r.level for r in got] == list(range(len(got))) and len(got) == len(nodes) + 1  # one level joins the groups
    assert {(r.doc_id, r.group, r.pos) for r in got} == {(77, "en", at)}
    node = H("new")
    for r, (left, right) in zip(got[1:], others(nodes, at), strict=False):
        node = H(*left, node, *right)
        assert r.digest == node
