"""The corpus pipeline: documents through quality filter, near-duplicate removal, passage dedup, decontamination and tokenising.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; all but the last return the columns of
documents. Side inputs (labels, benchmark) are read from sf_dir. `run` chains the stages with a Parquet table in the
shared folder after each, so that a lost executor costs one stage's work and no stage is computed twice.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarn.llm import bpe
from tarn.llm.decontaminate import remove_documents
from tarn.llm.frames import materialise
from tarn.llm.jaccard import drop_near_duplicates
from tarn.llm.quality import keep_good
from tarn.llm.substring import dedup_substrings

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the factorisation machine scores under its threshold.

    Rows are scored by their text alone, so null and repeated doc_ids make no difference; a null text is scored as empty. Other columns stay,
    whatever their names. An empty table gives an empty one."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by shingle similarity, keep that with the smallest doc_id.

    Rows that repeat a doc_id, or have none, are told apart by their texts, and one row of each group stays; documents without words are
    linked with nothing and stay. An empty table gives an empty one."""
    return drop_near_duplicates(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages of 50 words or more that a document with a smaller doc_id has; n_chars follows the text.

    Every row is judged by its own text: rows of one doc_id never cut each other, a row without doc_id neither cuts nor is cut. A row that
    loses nothing keeps its text as it is, null texts too; all rows stay. An empty table gives an empty one."""
    cut = dedup_substrings(docs)
    return cut.withColumn("n_chars", F.coalesce(F.char_length("text").cast("long"), F.col("n_chars")))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold an n-gram of a benchmark item.

    Rows are judged by their own text, whatever their doc_id; a null or empty text holds none and stays, items without words or
    without id match nothing. An empty table, on either side, drops nothing."""
    return remove_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document that is left, its pre-tokens' offsets and numbers of ids, and the digest of what the ids decode to.

    A row for each row, whatever its doc_id; a null or empty text has no ids. An empty table gives an empty one."""
    found = bpe.encode(docs.select("doc_id", "lang", "source", "text"), RANKS, digest=True)
    return found.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "slice_offsets", "slice_tokens", "decoded_sha256")


STAGES = [
    ("quality_filter", quality_filter),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("decontaminate", decontaminate),
    ("tokenise", tokenise),
]
#: The first two stages can't be expressed in SQL; tests compare the chain with its operators' brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
