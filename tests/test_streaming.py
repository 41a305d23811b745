import random

import pytest
from pyspark.sql import functions as F

from tarn.model import SplitConfig
from tarn.operators.splits import assign
from tarn.sources.snapshots import Snapshots
from tarn.streaming.append import append_stream, appended, compact, manifest_stream, newest, sessions
from tests.test_manifest import records

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def run(spark, tmp_path):
    append_stream(manifest_stream(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(120)


def test_the_newest_row_of_a_tile_counts(spark, tmp_path):
    m = records(spark)
    m.write.parquet(str(tmp_path / "in"))
    run(spark, tmp_path)
    out = str(tmp_path / "out")
    want = {r.tile_id: (r.split, r.lon) for r in assign(m, SplitConfig()).collect()}
    assert {r.tile_id: (r.split, r.lon) for r in appended(spark, out).collect()} == want
    reader = appended(spark, out)
    before = set(Snapshots(spark, out, "source").files.names("data/commit=*/*=*"))
    again = m.limit(5).withColumn("lon", F.lit(9.5)).unionByName(m.limit(2).withColumn("tile_id", F.concat("tile_id", F.lit("x"))))
    changed = {r.tile_id: 9.5 for r in m.limit(5).collect()}
    again.write.mode("append").parquet(str(tmp_path / "in"))
    run(spark, tmp_path)
    after = {r.tile_id: r.lon for r in appended(spark, out).collect()}
    assert len(after) == len(want) + 2 and all(after[k] == changed.get(k, lon) for k, (_, lon) in want.items())
    # What a batch writes is its own rows; readers that were open go on; nothing else was touched.
    table = Snapshots(spark, out, "source")
    assert before < set(table.files.names("data/commit=*/*=*")) and table.read().count() == len(want) + 7
    assert {r.tile_id: r.lon for r in reader.collect()} == {k: lon for k, (_, lon) in want.items()}
    compact(spark, out)
    assert table.read().count() == len(after) and {r.tile_id: r.lon for r in appended(spark, out).collect()} == after


def test_a_batch_tried_again_is_added_once(spark, tmp_path):
    m = records(spark)
    m.write.parquet(str(tmp_path / "in"))
    run(spark, tmp_path)
    table = Snapshots(spark, str(tmp_path / "out"), "source")
    n = table.read().count()
    # The stream's own record of the batch is lost, as when it stops between the table's commit and its own.
    for f in (tmp_path / "cp" / "commits").iterdir():
        f.unlink()
    run(spark, tmp_path)
    assert table.read().count() == n and table.versions() == [1]


def test_newest_of_equal_times(spark):
    rows = spark.createDataFrame([("a", 1, 5), ("a", 2, 9), ("b", 3, 1)], "tile_id string, v int, arrived long")
    assert sorted((r.tile_id, r.v) for r in newest(rows).collect()) == [("a", 2), ("b", 3)]


@pytest.fixture
def rocks(spark):
    old = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    yield spark
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", old)


def test_sessions_equal_a_batch_under_reordering_and_restart(rocks, tmp_path):
    rng = random.Random(6)
    events = sorted((rng.randrange(0, 40_000), rng.choice("abc")) for _ in range(150))
    want = []
    for key in "abc":
        own = [t for t, k in events if k == key]
        start = last = own[0]
        n = 0
        for t in own:
            if t - last > 600:
                want.append((key, start, last, n))
                start, n = t, 0
            last, n = t, n + 1
        want.append((key, start, last, n))
    # Files in order of time but for shuffling within an hour; the last one moves the watermark past everything.
    order = sorted(events, key=lambda e: e[0] + rng.uniform(0, 3000))
    parts = [order[i : i + 50] for i in range(0, 150, 50)] + [[(10**6, "z")], [(10**6 + 1, "z")]]
    got = []

    def go(n):
        for k in range(n[0], n[1]):
            rocks.createDataFrame(parts[k], "s long, key string").select(F.timestamp_seconds("s").alias("ts"), "key").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
            stream = rocks.readStream.schema("ts timestamp, key string").parquet(str(tmp_path / "in"))
            q = sessions(stream, "ts", "key", 600, "3600 seconds").writeStream.foreachBatch(lambda b, e: got.extend((r.key, int(r.start.timestamp()), int(r.end.timestamp()), r.n) for r in b.collect()))
            q.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination(180)

    go((0, 5))  # a new query for each file: state comes back from the checkpoint
    assert sorted(got) == sorted(want)
