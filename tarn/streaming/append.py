"""Streaming append: new tile records are split as they arrive, and the newest record of a tile is the one that counts.

Split assignment is a row-local expression of the group key, so a tile gets the same split in a stream, in a batch, and
whenever it arrives again. A micro-batch is one commit of its own rows: what it writes grows with the batch, not with the
table. Readers see the newest row of each tile_id; `compact` rewrites the table as it is read. A batch that is tried
again after a restart finds its number in the table's notes and isn't added twice.
"""

from __future__ import annotations

import time
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tarn.model import MANIFEST, SplitConfig
from tarn.operators.splits import assign
from tarn.sources.snapshots import Snapshot, Snapshots

#: When a row was added, in nanoseconds.
ARRIVED = "arrived"
_STORED = T.StructType([*MANIFEST.fields, T.StructField(ARRIVED, T.LongType())])


def manifest_stream(spark: SparkSession, folder: str, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(MANIFEST).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def append_stream(records: DataFrame, out: str, checkpoint: str, config: SplitConfig | None = None) -> StreamingQuery:
    """Add split-assigned records to the table at `out`, a batch in one commit; within a batch one row of a tile_id counts."""
    config = config or SplitConfig()

    def add(batch: DataFrame, epoch: int) -> None:
        table = Snapshots(batch.sparkSession, out, "source")
        done = table.latest().notes.get("epochs", {})
        if epoch <= done.get(checkpoint, -1) or batch.isEmpty():
            return
        rows = assign(batch.dropDuplicates(["tile_id"]), config).withColumn(ARRIVED, F.lit(time.time_ns()))
        table.commit(table.stage(rows), add=True, notes={"epochs": {**done, checkpoint: epoch}})

    return records.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def newest(rows: DataFrame) -> DataFrame:
    """Of each tile_id the row that was added last; a partial maximum before rows move."""
    return rows.groupBy("tile_id").agg(F.max_by(F.struct(*rows.columns), ARRIVED).alias("row")).select("row.*")


def appended(spark: SparkSession, out: str, version: int | None = None) -> DataFrame:
    """The records at `out`, one for each tile."""
    return newest(Snapshots(spark, out, "source").read(_STORED, version)).select(*[f.name for f in MANIFEST])


def compact(spark: SparkSession, out: str) -> Snapshot:
    """Rewrite the table with one row for each tile; made anew where a batch is added meanwhile."""
    return Snapshots(spark, out, "source").update(newest, _STORED)


def windowed_counts(events: DataFrame, time: str, key: str, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts of a stream by tumbling window and key, late rows dropped after the watermark."""
    return events.withWatermark(time, late).groupBy(F.window(time, window).alias("w"), key).agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), key, "n")


class _Sessions(StatefulProcessor):
    """Open sessions of one key, as (start, end, rows) in microseconds; a session closes when the watermark passes its end by the gap."""

    def __init__(self, gap: int) -> None:
        self.gap = gap

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", "start long, end long, n long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        found = [tuple(r) for r in self.open.get()]
        for frame in rows:
            found += [(int(t), int(t), 1) for t in frame["us"]]
        merged: list[tuple[int, int, int]] = []
        for start, end, n in sorted(found):
            if merged and start - merged[-1][1] <= self.gap:
                before = merged.pop()
                start, end, n = before[0], max(before[1], end), before[2] + n
            merged.append((start, end, n))
        self.open.put(merged)
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        for _, end, _ in merged:
            self.handle.registerTimer((end + self.gap) // 1000 + 1)
        return iter(())

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = expiredTimerInfo.getExpiryTimeInMs() * 1000
        held = [tuple(r) for r in self.open.get()]
        closed = [s for s in held if s[1] + self.gap < now]
        left = [s for s in held if s not in closed]
        if left:
            self.open.put(left)
        else:
            self.open.clear()
        if closed:
            yield pd.DataFrame([(key[0], pd.Timestamp(a, unit="us"), pd.Timestamp(b, unit="us"), n) for a, b, n in closed], columns=["key", "start", "end", "n"])

    def close(self) -> None:
        pass


def sessions(events: DataFrame, time: str, key: str, gap_seconds: float, late: str = "2 hours") -> DataFrame:
    """(key, start, end, n): runs of a key's events with at most `gap_seconds` between neighbours, each emitted once when the watermark has passed it.

    Events may come in any order within `late`: one that falls between two open sessions joins them. State is a few numbers for each
    open session, and leaves with it. Needs the RocksDB state store (`spark.sql.streaming.stateStore.providerClass`)."""
    kind = events.schema[key].dataType
    out = T.StructType([T.StructField("key", kind), T.StructField("start", T.TimestampType()), T.StructField("end", T.TimestampType()), T.StructField("n", T.LongType())])
    rows = events.filter(F.col(time).isNotNull()).withWatermark(time, late).withColumn("us", F.unix_micros(time))
    return rows.groupBy(key).transformWithStateInPandas(_Sessions(int(gap_seconds * 1_000_000)), out, "Append", "EventTime")
