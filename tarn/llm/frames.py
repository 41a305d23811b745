"""Small Spark helpers shared by the corpus operators: reading, Arrow stages, shared scratch tables."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of an Arrow batch that carries whole texts; keeps a batch at a few MB, in the Python worker and outside the heap of its executor.
TEXT_BATCH_ROWS = 250


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_texts(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key long, text string) with null texts read as empty; all other columns are pruned."""
    return df.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))


def arrow_stage(df: DataFrame, make: Callable[[], Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]], schema: str) -> DataFrame:
    """mapInArrow over small batches; make() builds the task's function on the executor. Workers live on for other stages, so a task gives its Arrow memory back."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXT_BATCH_ROWS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from make()(batches)
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def partitions(spark: SparkSession) -> int:
    """Number of shuffle partitions of the session: what an explicit repartition by bucket uses."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir, which driver and executors share; set here only where it is unset."""
    found = spark.sparkContext.getCheckpointDir()
    if found:
        return found
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not named:  # one machine, as in tests
        named = os.path.join(tempfile.gettempdir(), "checkpoints")
    spark.sparkContext.setCheckpointDir(named)
    return spark.sparkContext.getCheckpointDir() or named


def materialise(df: DataFrame, name: str, *used: Broadcast) -> DataFrame:
    """Cut the lineage: write df as Parquet in the shared folder and read it back; broadcasts that nothing else needs are freed."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    for one in used:
        one.destroy()
    return spark.read.schema(df.schema).parquet(path)


#: Most rows of two or three numbers that are broadcast: some 12 MB.
SMALL_ROWS = 200_000


def small(narrow: DataFrame) -> DataFrame:
    """narrow, a materialised frame of a few numbers a row: to be broadcast if it has at most SMALL_ROWS rows, joined by exchange beyond."""
    return F.broadcast(narrow) if narrow.count() <= SMALL_ROWS else narrow


#: A key with more than one in HOT_SHARE of the rows is hot (so there are fewer than HOT_SHARE such keys), and is dealt to SPREAD tasks.
HOT_SHARE, SPREAD = 1000, 64


def spread_join(rows: DataFrame, facts: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """rows joined to facts (one row for each key) on `key`; rows of hot keys are dealt out over SPREAD tasks, and their facts to each of these; so are rows with a null key, which meet none."""
    salt, hot = fresh(rows, "salt"), fresh(rows, "hot")
    least = max(1, rows.count() // HOT_SHARE)
    found = rows.groupBy(key).count().filter(F.col("count") > least).select(key, F.lit(True).alias(hot))
    found = F.broadcast(found)  # fewer than HOT_SHARE keys
    others = [c for c in rows.columns if c != key]
    dealt = rows.join(found, key, "left").withColumn(salt, F.when(F.col(hot) | F.col(key).isNull(), F.pmod(F.xxhash64(*others), F.lit(SPREAD))).otherwise(F.lit(0)).cast("int")).drop(hot)
    copies = F.when(F.col(hot), F.sequence(F.lit(0), F.lit(SPREAD - 1))).otherwise(F.array(F.lit(0)))
    table = facts.join(found, key, "left").withColumn(salt, F.explode(copies)).drop(hot)
    return dealt.join(table, [key, salt], how).drop(salt)


def discard(df: DataFrame) -> None:
    """Delete the files behind a materialised frame that nothing reads any more."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)
