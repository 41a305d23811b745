"""Both sides of every size switch give the same rows, and hot keys spread."""

import random

import pytest
from pyspark.sql import functions as F

from tarn.llm import frames
from tarn.llm.decontaminate import remove_documents
from tarn.llm.frames import materialise, spread_join
from tarn.llm.jaccard import drop_near_duplicates
from tarn.llm.ranks import ranked
from tarn.llm.resample import resampling_digest
from tarn.llm.warc import round_trip


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_exchanged_and_broadcast_facts_give_the_same_rows(spark, monkeypatch):
    read = {t: spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "benchmark", "pages")}
    jobs = {
        "near": lambda: drop_near_duplicates(read["documents"]),
        "leaks": lambda: remove_documents(read["documents"], read["benchmark"]),
        "warc": lambda: round_trip(read["pages"]),
        "draw": lambda: resampling_digest(read["documents"], read["benchmark"]),
    }
    few = {n: rows_of(job()) for n, job in jobs.items()}
    monkeypatch.setattr(frames, "SMALL_ROWS", -1)
    assert {n: rows_of(job()) for n, job in jobs.items()} == few


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_keys_are_dealt_out_and_meet_their_facts(spark, how):
    rng = random.Random(1)
    keys = [7] * 3000 + [None] * 1500 + [rng.randrange(2000) for _ in range(1500)]
    rows = spark.createDataFrame([(k, i, "s") for i, k in enumerate(keys)], "key long, n long, salt string").repartition(4)
    facts = spark.createDataFrame([(k, f"f{k}") for k in range(0, 2000, 3)] + [(7, "hot")], "key long, fact string")
    joined = spread_join(rows, facts, "key", how)
    assert rows_of(joined.select("key", "n", "salt", "fact")) == rows_of(rows.join(facts, "key", how).select("key", "n", "salt", "fact"))
    held = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    try:
        parts = spread_join(rows, facts, "key", how).groupBy("key", F.spark_partition_id().alias("p")).count().filter("key = 7 or key is null").collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    for key, many in [(7, 3000), *([(None, 1500)] if how == "left" else [])]:
        own = [r["count"] for r in parts if r.key == key]
        assert sum(own) >= many and len(own) > 4 and max(own) < many / 2
    named = rows.withColumn("key", F.struct("key", F.lit(1).alias("b")))
    assert spread_join(named, facts.withColumn("key", F.struct("key", F.lit(1).alias("b"))), "key", how).count() == (rows.join(facts, "key", how).count())


def test_ranks_over_many_ranges(spark):
    rng = random.Random(2)
    rows = [(rng.choice("abc"), rng.choice([5, rng.randrange(100)]), i) for i in range(2000)]
    frame = materialise(spark.createDataFrame(rows, "group string, v long, seq long").repartition(6), "rows")
    got = {(r.group, r.v, r.seq): (r.pos, r.n) for r in ranked(frame, "group", [F.desc("v"), F.col("seq")]).collect()}
    for g in "abc":
        own = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2]))
        assert [got[r] for r in own] == [(i, len(own)) for i in range(len(own))]
