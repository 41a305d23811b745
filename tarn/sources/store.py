"""The tile store and the manifest on disk: snapshot tables of Parquet, addressed by (store, shard, shard_index).

A source's tiles and its rows are replaced, never appended to; a manifest's snapshot notes the version of the tile store
that its addresses mean."""

from __future__ import annotations

import contextlib
import json
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarn.model import MANIFEST
from tarn.operators.labels import raise_if_any
from tarn.operators.manifest import band_layouts, sidecar
from tarn.sources.snapshots import Snapshot, Snapshots, Staged


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where, jvm


@contextlib.contextmanager
def staged(df: DataFrame, path: str) -> Iterator[DataFrame]:
    """df written once beside what lies at path, for as long as it is used; readers of the path don't see it."""
    spark = df.sparkSession
    where = f"{path}/_staged-{uuid.uuid4().hex}"
    df.write.parquet(where)
    try:
        yield spark.read.schema(df.schema).parquet(where)
    finally:
        fs, at, _ = _fs(spark, where)
        fs.delete(at, True)


def tile_store(spark: SparkSession, path: str) -> Snapshots:
    return Snapshots(spark, path, "store")


def stage_tiles(tiles: DataFrame, path: str, shard_size: int = 512, checked: bool = False) -> Staged:
    """Write tiles without showing them; stores with several band layouts are errors (checked: the caller has looked).

    A shard's tiles go to one task and lie together in one file, in order, so that an address reads one file's row groups."""
    if not checked:
        raise_if_any(band_layouts(tiles), "band layouts differ inside a store")
    dealt = tiles.repartition("store", "shard").sortWithinPartitions("store", "shard", "shard_index")
    return tile_store(tiles.sparkSession, path).stage(dealt, maxRecordsPerFile=16 * shard_size)


def commit_tiles(spark: SparkSession, path: str, staged: Staged, shard_size: int = 512, whole: bool = False) -> Snapshot:
    """Show staged tiles in place of their stores' (whole: of all) tiles; each store's description is noted with the snapshot."""
    table = tile_store(spark, path)
    told = {}
    if staged.parts:
        told = {r.store: json.loads(r.sidecar) for r in sidecar(table.frame(staged.parts), shard_size).collect()}  # a row for each store
    kept = {} if whole else table.latest().notes.get("stores", {})
    return table.commit(staged, whole, {"stores": {**kept, **told}})


def write_store(tiles: DataFrame, path: str, shard_size: int = 512, checked: bool = False) -> Snapshot:
    """Replace the tiles of the stores that `tiles` has."""
    return commit_tiles(tiles.sparkSession, path, stage_tiles(tiles, path, shard_size, checked), shard_size)


def read_tiles(spark: SparkSession, path: str, store: str | None = None, shard: str | None = None, index: int | None = None, version: int | None = None) -> DataFrame:
    """Tiles of a store, a shard or an address; the store prunes directories, the rest is pushed to the scan."""
    table = tile_store(spark, path)
    if not table.versions():
        raise FileNotFoundError(f"no tile store at {path}")
    tiles = table.read(version=version)
    for column, value in (("store", store), ("shard", shard), ("shard_index", index)):
        if value is not None:
            tiles = tiles.filter(F.col(column) == value)
    return tiles


def lookup(manifest: DataFrame, tiles: DataFrame) -> DataFrame:
    """The pixels of manifest rows, by address."""
    return manifest.select("tile_id", "store", "shard", "shard_index").join(tiles.drop("tile_id"), ["store", "shard", "shard_index"])


def describe_stores(spark: SparkSession, path: str) -> dict[str, dict]:
    """The description of each store: name, prefix, shard size, bands, numbers of shards and tiles."""
    return tile_store(spark, path).latest().notes.get("stores", {})


def stores(spark: SparkSession, path: str) -> list[str]:
    return sorted(describe_stores(spark, path))


def manifest_table(spark: SparkSession, path: str) -> Snapshots:
    return Snapshots(spark, path, "source")


def typed(rows: DataFrame) -> DataFrame:
    """The manifest's columns with the declared types."""
    have = set(rows.columns)
    return rows.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in MANIFEST])


def read_manifest(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """With the declared types, whatever types the file has; a plain file or folder of Parquet is read as it is."""
    table = manifest_table(spark, path)
    if version is None and not table.versions():
        return typed(spark.read.parquet(path))
    return typed(table.read(MANIFEST, version))


def write_manifest(manifest: DataFrame, path: str) -> Snapshot:
    """Replace all rows of the manifest at path, also by a frame that reads it."""
    return manifest_table(manifest.sparkSession, path).replace(manifest, whole=True)


def append_source(spark: SparkSession, path: str, new: DataFrame) -> Snapshot:
    """Upsert by source: rows of the sources that `new` has are replaced, the others' files aren't touched."""
    return manifest_table(spark, path).replace(new)


def tiles_of(spark: SparkSession, path: str) -> DataFrame:
    """The tiles that the manifest at path means, in the version of the store that it was built with."""
    where, version = manifest_table(spark, path).latest().notes["tiles"]
    return read_tiles(spark, where, version=version)
