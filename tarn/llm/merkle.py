"""Merkle dataset manifest: a hash tree over all rows, with proofs and a persistent version of the tree for each tampered leaf.

H is the lowercase hex SHA-256 of its inputs concatenated; digests enter as hex text. A row's leaf is H of its fields, each
`-` if null, else its UTF-8 byte count, `:` and its value. The leaves of one group (language) ascend by id; every ARITY
consecutive nodes (the last run may be shorter, even one) become their H, until one is left, the subroot. Subroots by group
(null first, UTF-8 bytewise) become the root in the same way.

Method: a persistent tree by path copying, worked on in aligned blocks.

1. Leaves are narrow rows; ranks by range sorting number them in their group, so blocks of ARITY ** HEIGHT leaves are aligned
   to the tree's own nodes. A group task builds one block's nodes. The blocks' tops are the next layer's leaves (4096 times
   fewer), and so on until each group has one node; the subroots are one more such tree. Layers are materialised.
2. Going down, each block of a layer learns the siblings above it, level by level: a few hundred bytes for each block.
3. A tampered leaf makes a version of its block: only the nodes on its path are copied, every other node is shared with the
   version before. Above the block the version goes on through the siblings that the block was given, so that versions are
   finished where their leaves are, however many share an upper node. Nothing is kept of a version but its copied nodes.

Defined results: null and repeated ids are rows like others (null first; equal ids by leaf); a null id is never tampered
with; an empty table gives an empty result; extra columns are ignored; a lone leaf is its own subroot, a lone subroot the root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import discard, materialise
from .ranks import ranked

ARITY = 8
#: Levels of a block: 4096 leaves.
HEIGHT = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PATH = "array<struct<left:string,right:string>>"
_PATH_TYPE = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))


def digest(*inputs: str) -> str:
    return hashlib.sha256("".join(inputs).encode()).hexdigest()


def leaf(*fields: Column) -> Column:
    """H of the fields, inside code generation."""
    part = lambda c: F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c))
    return F.sha2(F.concat(*[part(c.cast("string")) for c in fields]), 256)


class Block:
    """The nodes of one aligned block, bottom up; its top is the last level's only node."""

    def __init__(self, leaves: list[str], whole: bool, height: int) -> None:
        """whole: the block is all of its tree, and ends where one node is left; others have `height` levels above the leaves."""
        self.levels = [leaves]
        while len(self.levels[-1]) > 1 if whole else len(self.levels) <= height:
            below = self.levels[-1]
            self.levels.append([digest(*below[at : at + ARITY]) for at in range(0, len(below), ARITY)])

    @property
    def top(self) -> str:
        return self.levels[-1][0]

    def siblings(self, place: int) -> Iterator[tuple[str, str]]:
        """The other nodes of the run of `place`, before and after it, level by level."""
        for level in self.levels[:-1]:
            run = place // ARITY * ARITY
            yield "".join(level[run:place]), "".join(level[place + 1 : run + ARITY])
            place //= ARITY

    def version(self, place: int, changed: str) -> list[str]:
        """The copied nodes of the version in which the leaf at `place` is `changed`, bottom up; all others are shared with this one."""
        copied = [changed]
        for left, right in self.siblings(place):
            copied.append(digest(left, copied[-1], right))
        return copied


def _blocks(nodes: DataFrame, height: int) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"pos div {ARITY**height}"))


def _block(rows: pa.Table, height: int) -> tuple[pa.Table, Block]:
    rows = rows.sort_by("pos")
    return rows, Block(rows.column("digest").to_pylist(), rows.column("n")[0].as_py() <= ARITY**height, height)


def _tops(nodes: DataFrame, height: int) -> DataFrame:
    """The next layer: one node for each block of nodes (tree, pos, n, digest)."""

    def top(rows: pa.Table) -> pa.Table:
        rows, block = _block(rows, height)
        return pa.table({"tree": rows.column("tree")[:1], "pos": rows.column("block")[:1], "n": [-(-rows.column("n")[0].as_py() // ARITY**height)], "digest": [block.top]})

    narrow = _blocks(nodes.select("tree", "pos", "n", "digest"), height)
    return narrow.groupBy("tree", "block").applyInArrow(top, "tree string, pos long, n long, digest string")


def _layers(nodes: DataFrame, height: int) -> list[DataFrame]:
    """nodes and the layers above them, each ARITY ** height times smaller, until every tree has one node."""
    out, tall = [nodes], (nodes.agg(F.max("n")).first()[0] or 0)
    while True:
        out.append(materialise(_tops(out[-1].filter("n > 1") if len(out) > 1 else out[-1], height), "layer"))
        tall = -(-tall // ARITY**height)
        if tall <= 1:
            return out


def _descend(nodes: DataFrame, above: DataFrame, height: int) -> DataFrame:
    """The path of each node of a layer, given (tree, block, subroot, root, path) of its blocks."""

    def paths(rows: pa.Table, up: pa.Table) -> pa.Table:
        rows, block = _block(rows, height)
        upper = up.column("path")[0].as_py()
        found = [[{"left": a, "right": b} for a, b in block.siblings(i)] + upper for i in range(len(rows))]
        whole = lambda name: pa.array(up.column(name).to_pylist() * len(rows), pa.string())
        return pa.table({"tree": rows.column("tree"), "block": rows.column("pos"), "subroot": whole("subroot"), "root": whole("root"), "path": pa.array(found, _PATH_TYPE)})

    return _blocks(nodes, height).groupBy("tree", "block").cogroup(above.groupBy("tree", "block")).applyInArrow(paths, f"tree string, block long, subroot string, root string, path {_PATH}")


class Tree:
    """The materialised tree of a table.

    leaves: tree (the group, `0` for null, else `1` and its name), pos (place in the group), n (its leaves), doc_id, digest,
    changed (the tampered leaf or null). above: for each block of leaves its subroot, the root and the siblings above it.
    """

    def __init__(self, leaves: DataFrame, above: DataFrame, height: int) -> None:
        self.leaves, self.above, self.height = leaves, above, height

    def _each(self, make, schema: str) -> DataFrame:
        return _blocks(self.leaves, self.height).groupBy("tree", "block").cogroup(self.above.groupBy("tree", "block")).applyInArrow(make, schema)

    def proofs(self) -> DataFrame:
        """Per leaf: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""
        height = self.height

        def prove(rows: pa.Table, up: pa.Table) -> pa.Table:
            rows, block = _block(rows, height)
            subroot, root, upper = (up.column(c)[0].as_py() for c in ("subroot", "root", "path"))
            above = "".join(x["left"] + x["right"] for x in upper)
            leaves, proof, folded = block.levels[0], [], []
            for place, changed in enumerate(rows.column("changed").to_pylist()):
                proof.append(digest(*(side for pair in block.siblings(place) for side in pair), above))
                node = block.version(place, leaves[place] if changed is None else changed)[-1]
                for x in upper:
                    node = digest(x["left"], node, x["right"])
                folded.append(node)
            n = len(rows)
            verified = [f == root for f in folded]
            return pa.table({"doc_id": rows.column("doc_id"), "leaf": leaves, "subroot": [subroot] * n, "root": [root] * n, "proof_sha256": proof, "folded_root": folded, "verified": verified})

        return self._each(prove, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")

    def versions(self) -> DataFrame:
        """The copied nodes of every tampered leaf's version, bottom up: doc_id, group, pos (of the leaf), level (0 the leaf), digest."""
        height = self.height

        def copy(rows: pa.Table, up: pa.Table) -> pa.Table:
            rows, block = _block(rows, height)
            out: dict[str, list] = {"doc_id": [], "group": [], "pos": [], "level": [], "digest": []}
            group = rows.column("tree")[0].as_py()
            group = group[1:] if group[0] == "1" else None
            for place, (doc, pos, changed) in enumerate(zip(*(rows.column(c).to_pylist() for c in ("doc_id", "pos", "changed")), strict=True)):
                if changed is None:
                    continue
                nodes = block.version(place, changed)
                for x in up.column("path")[0].as_py():
                    nodes.append(digest(x["left"], nodes[-1], x["right"]))
                for level, node in enumerate(nodes):
                    for name, value in zip(out, (doc, group, pos, level, node), strict=True):
                        out[name].append(value)
            return pa.table(out, pa.schema([("doc_id", pa.int64()), ("group", pa.string()), ("pos", pa.int64()), ("level", pa.int32()), ("digest", pa.string())]))

        return self._each(copy, "doc_id long, group string, pos long, level int, digest string")


def build_tree(docs: DataFrame, tampered: Column, changed: Column, key: str = "doc_id", group: str = "lang", fields: tuple[str, ...] = FIELDS, height: int = HEIGHT) -> Tree:
    """The tree of docs, in blocks of `height` levels; where `tampered` holds, `changed` is the tampered leaf's digest."""
    own = leaf(*[F.col(f"`{c}`") for c in fields])
    tree = F.coalesce(F.concat(F.lit("1"), F.col(f"`{group}`").cast("string")), F.lit("0"))
    rows = docs.select(tree.alias("tree"), F.col(f"`{key}`").cast("long").alias("doc_id"), own.alias("digest"), F.when(tampered, changed).alias("changed"))
    rows = materialise(rows.withColumn("salt", F.monotonically_increasing_id()), "leaves")
    leaves = ranked(rows, "tree", [F.col("doc_id"), F.col("digest"), F.col("salt")])
    discard(rows)
    lower = _layers(leaves, height)
    ended = [layer.filter("n = 1").select("tree", "digest", F.lit(k).alias("layer")) for k, layer in enumerate(lower) if k]
    subroots = reduce(DataFrame.unionByName, ended).select(F.lit("").alias("all"), "tree", "digest", "layer")
    subroots = ranked(materialise(subroots, "subroots"), "all", [F.col("tree")])
    upper = _layers(subroots.select(F.col("all").alias("tree"), "pos", "n", "digest"), height)
    known = upper[-1].select("tree", F.col("pos").alias("block"), F.lit("").alias("subroot"), F.col("digest").alias("root"), F.array().cast(_PATH).alias("path"))
    for nodes in reversed(upper[:-1]):
        known = _descend(nodes, known, height)
    named = subroots.select(F.col("tree").alias("group"), F.col("pos").alias("block"), F.col("digest").alias("own"), "layer")
    tops = materialise(known.drop("tree", "subroot").join(named, "block").select(F.col("group").alias("tree"), "layer", F.col("own").alias("subroot"), "root", "path"), "tops")
    known = None
    for k in range(len(lower) - 1, 0, -1):
        here = tops.filter(F.col("layer") == k).select("tree", F.lit(0).cast("long").alias("block"), "subroot", "root", "path")
        known = here if known is None else here.unionByName(_descend(lower[k].filter("n > 1"), known, height))
    return Tree(leaves, materialise(known, "above"), height)


def manifest_proofs(docs: DataFrame, share: int = 3, height: int = HEIGHT) -> DataFrame:
    """Per row: its leaf, the roots, the digest of its proof, and the root folded from it; rows whose id's CRC-32 `share` divides
    are tampered with: A-Z of their text are in lower case."""
    changed = leaf(*[F.translate("text", UPPER, LOWER) if c == "text" else F.col(c) for c in FIELDS])
    return build_tree(docs, F.crc32(F.col("doc_id").cast("string")) % share == 0, changed, height=height).proofs()
