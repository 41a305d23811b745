"""Benchmark decontamination with DataFrame functions only (no Python on the executors).

Items are lower-cased (A-Z) and cut to words; every run of `window` words of an item, or the whole item if it has fewer
words, is a test n-gram. The n-grams form a hash set that is broadcast while it is small (SET_BYTES, measured before) and
shuffled otherwise, with a few numbers for each position of a text. Documents are scanned once: each position's n-gram is hashed inside code generation, probed, and the
words themselves are compared on a hit, so hash collisions can't count (in the shuffled form 128 bits of hash are). What survives the probe is one row for each hit
and one for each document, so only these are shuffled, never texts.

Defined results: a null text has no words and is never contaminated; a null item_id is no item; items without words match nothing; items
that repeat an id count once. Every input row gives its own result row, also where a doc_id repeats. A word is
hit if any occurrence of an n-gram covers it. `remove_documents` and `remove_spans` judge each row by its own text (rows are told apart by
128 bits of text hash), whatever its key, null and repeated keys included; `remove_spans` joins the words that stay with the original signs between them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import fresh, materialise, small

WINDOW = 10
#: Fixed pattern: what separates words, once A-Z are lower case.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same set before lower-casing: it leaves out A-Z.
SIGNS = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Largest size of all n-grams, in bytes of their words, at which the set is broadcast.
SET_BYTES = 64 << 20


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), SEPARATORS), "")


def test_ngrams(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(size, gram array<string>, hash, items array<bigint>): the distinct n-grams of all items."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), words(F.col("text")).alias("w")).filter("item_id is not null and size(w) > 0")
    starts = items.select("item_id", "w", F.least(F.size("w"), F.lit(window)).alias("size")).select("item_id", "w", "size", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("size") + 1)).alias("at"))
    grams = starts.select("item_id", "size", F.slice("w", F.col("at"), F.col("size")).alias("gram"))
    return grams.groupBy("size", "gram").agg(F.collect_set("item_id").alias("items")).select("size", "gram", F.xxhash64("gram").alias("hash"), "items")


def hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, set_bytes: int = SET_BYTES) -> DataFrame:
    """docs: (row, doc_id, text), where row and doc_id together name a text. Per row: n_words, spans array<struct<start,end>> of hit words (0-based, end excluded, sorted), items array<bigint> (distinct, sorted)."""
    grams = test_ngrams(benchmark, window)
    measured = grams.agg(F.collect_set("size").alias("sizes"), F.coalesce(F.sum(F.octet_length(F.concat_ws(" ", "gram")) + 24 * F.col("size") + 64), F.lit(0)).alias("bytes")).first()
    sizes = sorted(measured.sizes) or [window]  # at most `window` different ones
    again = lambda words: F.xxhash64(F.lit("again"), words)
    probe = grams.select(F.col("hash").alias("g_hash"), F.col("size").alias("g_size"), "gram", "items")
    # Beyond set_bytes 128 bits of hash stand for the words, so that a position's row is a few numbers.
    probe = F.broadcast(probe) if measured.bytes <= set_bytes else probe.withColumn("gram", again(F.col("gram")))
    scan = docs.select("row", "doc_id", words(F.col("text")).alias("w")).select("row", "doc_id", "w", F.size("w").alias("n_words"))
    # Position 1 is always there, so that each document leaves a row.
    scan = scan.select("row", "doc_id", "w", "n_words", F.explode(F.sequence(F.lit(1), F.greatest(F.col("n_words"), F.lit(1)))).alias("at"))
    gram = lambda size: F.slice("w", F.col("at"), size)
    if len(sizes) == 1:
        scan = scan.withColumn("size", F.lit(sizes[0])).withColumn("hash", F.xxhash64(gram(sizes[0])))
    else:
        each = F.array(*[F.struct(F.lit(s).alias("size"), F.xxhash64(gram(s)).alias("hash")) for s in sizes])
        scan = scan.select("row", "doc_id", "w", "n_words", "at", F.explode(each).alias("p")).select("row", "doc_id", "w", "n_words", "at", "p.size", "p.hash")
    own = F.slice("w", F.col("at"), F.col("size"))
    scan = scan.withColumn("own", own if measured.bytes <= set_bytes else again(own)).drop("w")
    found = scan.join(probe, (F.col("hash") == F.col("g_hash")) & (F.col("size") == F.col("g_size")) & (F.col("own") == F.col("gram")), "left")
    found = found.filter("g_size is not null or at = 1").select("row", "doc_id", "n_words", F.when(F.col("g_size").isNotNull(), F.struct((F.col("at") - 1).alias("start"), (F.col("at") - 1 + F.col("size")).alias("end"))).alias("span"), "items")
    gathered = found.groupBy("row", "doc_id").agg(F.max("n_words").cast("long").alias("n_words"), F.array_sort(F.collect_set("span")).alias("spans"), F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))
    return gathered.withColumn("items", F.array_sort("items"))


def _covered(spans: Column) -> Column:
    """Number of positions inside any of the spans, which are sorted by their start."""
    start = F.struct(F.lit(0).alias("to"), F.lit(0).alias("n"))
    step = lambda acc, s: F.struct(F.greatest(acc["to"], s["end"]).alias("to"), (acc["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(s["start"], acc["to"]))).alias("n"))
    return F.aggregate(spans, start, step, lambda acc: acc["n"])


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))


def decontamination_digest(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = hits(_rows(docs, "doc_id", "text"), benchmark, window)
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    out = found.select("doc_id", "n_words", _covered(F.col("spans")).cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", names).cast("binary"), 256).alias("items_sha256"))
    return out.withColumn("contaminated", F.col("n_hit") > 0)


def _named(text: Column) -> list[Column]:
    """128 bits that stand for a text."""
    return [F.xxhash64(text), F.xxhash64(F.lit("second"), text)]


def _found(docs: DataFrame, benchmark: DataFrame, text: str, window: int) -> tuple[DataFrame, Column]:
    """The distinct contaminated texts by their hashes, with spans; and the condition that joins them to docs. Names are those that docs doesn't have."""
    names = [fresh(docs, c) for c in ("hit_text", "hit_again")]
    keyed = docs.select(*[k.alias(c) for k, c in zip(_named(F.col(f"`{text}`")), ("row", "doc_id"), strict=True)], F.col(f"`{text}`").alias("text"))
    found = hits(keyed, benchmark, window).filter(F.size("spans") > 0)
    found = materialise(found.select(F.col("row").alias(names[0]), F.col("doc_id").alias(names[1]), F.col("spans").alias(fresh(docs, "hit_spans"))), "hits")
    same = [k == F.col(c) for k, c in zip(_named(F.col(f"`{text}`")), names, strict=True)]
    return found, same[0] & same[1]


def remove_documents(docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """docs without the rows whose text holds a test n-gram; all columns stay as they are, whatever their names."""
    found, same = _found(docs, benchmark, text, window)
    return docs.join(small(found.drop(fresh(docs, "hit_spans"))), same, "left_anti")


def remove_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """docs with the hit words cut out of `text`, each with the signs after it; rows without hits keep their text."""
    cut = fresh(docs, "hit_spans")
    found, same = _found(docs, benchmark, text, window)
    joined = docs.join(found, same, "left")
    body = F.col(f"`{text}`")
    pieces = F.regexp_extract_all(body, F.lit(f"([^{SIGNS}]+[{SIGNS}]*)"), F.lit(1))
    stay = F.filter(F.transform(pieces, lambda p, i: F.struct(p.alias("p"), i.alias("i"))), lambda x: ~F.exists(F.col(cut), lambda s: (x["i"] >= s["start"]) & (x["i"] < s["end"])))
    lead = F.regexp_extract(body, f"^([{SIGNS}]*)", 1)
    text_left = F.concat(lead, F.concat_ws("", F.transform(stay, lambda x: x["p"])))
    return joined.select(*[F.when(F.col(cut).isNull(), F.col(f"`{c}`")).otherwise(text_left).alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])
