import pytest
from pyspark.sql import functions as F

from tarn.functions.hashing import unit_fraction_blake2b
from tarn.model import MANIFEST, SchemaError, SplitConfig, TileSpec, label_map, rgb_key, source_specs
from tarn.operators import labels, manifest, splits, tiling
from tarn.sources import store


def records(spark, n=120, sources=("a", "b")):
    rows = [(f"{s}:{k // 6}:{k}", f"scene_{k // 6}", s, k % 6, float(-10 + 0.7 * (k // 6)), float(35 + 0.6 * (k // 6 % 5)), 100 if k % 2 else 0, 50) for s in sources for k in range(n)]
    df = spark.createDataFrame(rows, "tile_id string, sample_id string, source string, row int, lon double, lat double, n_px_oil long, n_px_sea long")
    for c in ("n_px_look_alike", "n_px_ship", "n_px_land", "n_px_ignore"):
        df = df.withColumn(c, F.lit(0).cast("long"))
    return manifest.tile_records(df.withColumn("kept_as", tiling.classify()).withColumn("store", F.col("source")))


def test_records_have_the_manifest_schema(spark):
    got = records(spark)
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in MANIFEST]
    assert got.filter("split <> '' or label_completeness <> 'unknown'").count() == 0
    assert manifest.build_manifest([], spark).columns == MANIFEST.names


def test_splits_keep_scenes_together_and_are_stable(spark):
    m = records(spark)
    for config in (SplitConfig(), SplitConfig("spatial"), SplitConfig("random"), SplitConfig("cross_source", test_sources=("b",))):
        done = splits.assign(m, config, check=True)
        assert splits.leaked_groups(done, config).count() == 0
        part = {r.tile_id: r.split for r in splits.assign(m.filter("row < 3"), config).collect()}
        whole = {r.tile_id: r.split for r in done.repartition(7).collect()}
        assert all(whole[k] == v for k, v in part.items()) and set(whole.values()) <= {"train", "val", "test"}
    assert splits.leaked_groups(splits.assign(m, SplitConfig("random")), SplitConfig()).count() > 0
    assert {r.source for r in splits.assign(m, SplitConfig("cross_source", test_sources=("b",))).filter("split = 'test'").collect()} == {"b"}


def test_impossible_splits(spark):
    m = records(spark)
    with pytest.raises(SchemaError, match="unknown test source"):
        splits.assign(m, SplitConfig("cross_source", test_sources=("z",)), check=True)
    with pytest.raises(SchemaError, match="no tile has a position"):
        splits.assign(m.withColumn("lon", F.lit(None).cast("double")), SplitConfig("spatial"), check=True)
    for bad in (dict(strategy="x"), dict(train=0.9, val=0.2), dict(strategy="cross_source")):
        with pytest.raises(ValueError):
            SplitConfig(**bad)


def test_blake2b_convention(spark):
    import hashlib

    got = spark.createDataFrame([("20260910:a",), (None,)], "k string").select(unit_fraction_blake2b("k").alias("f")).collect()
    assert got[0].f == int.from_bytes(hashlib.blake2b(b"20260910:a", digest_size=8).digest(), "big") / 2**64 and got[1].f is None


def test_integrity(spark):
    m = records(spark)
    assert {r.check for r in manifest.integrity(m).collect()} >= {"no split assigned", "shared address"}
    placed = manifest.assign_shards(m, shard_size=7)
    assert manifest.duplicates(placed, "store", "shard", "shard_index").first().n_duplicates == 0
    assert placed.filter("shard_index >= 7").count() == 0
    bad = placed.unionByName(placed.limit(3)).withColumn("label_completeness", F.lit("binary_oil_only")).withColumn("oil_fraction", F.lit(1.5))
    got = {r.check: r.n for r in manifest.integrity(bad).collect()}
    assert got["duplicate tile_id"] == 3 and got["shared address"] == 3 and got["oil_fraction outside [0, 1]"] == 243 and got["binary source asserts other classes"] == 243 * 50
    assert [r.check for r in manifest.integrity(m.limit(0)).collect()] == ["empty manifest"]


def test_store_round_trip(spark, tmp_path):
    path = str(tmp_path / "m.parquet")
    m = records(spark)
    store.write_manifest(m, path)
    store.write_manifest(splits.assign(store.read_manifest(spark, path), SplitConfig()), path)
    again = store.read_manifest(spark, path)
    assert again.count() == 240 and again.filter("split = ''").count() == 0
    store.append_source(spark, path, m.filter("source = 'a' and row = 0"))
    assert {r["source"]: r["count"] for r in store.read_manifest(spark, path).groupBy("source").count().collect()} == {"a": 20, "b": 120}
    tiles = manifest.assign_shards(m).withColumn("band_names", F.array(F.lit("vv_db"))).withColumn("pixels", F.array(F.col("row")))
    store.write_store(tiles, str(tmp_path / "tiles"))
    assert store.stores(spark, str(tmp_path / "tiles")) == ["a", "b"]
    got = store.lookup(manifest.assign_shards(m), store.read_tiles(spark, str(tmp_path / "tiles"), store="a"))
    assert got.count() == 120 and got.filter(F.element_at("pixels", 1) != F.col("row")).count() == 0
    with pytest.raises(SchemaError, match="band layouts"):
        store.write_store(tiles.withColumn("band_names", F.array(F.col("row").cast("string"))), str(tmp_path / "other"))


def test_labels_fail_loudly(spark):
    rows = spark.createDataFrame([("zenodo_s1", 0.0), ("zenodo_s1", 1.0), ("zenodo_s1", 7.0), ("mklab", 2.5), ("mklab", float("nan"))], "source string, native double")
    found = labels.unmapped(rows, "index", labels.index_key(F.col("native")), label_map(spark))
    assert {(r.source, r.value): r.n for r in found.collect()} == {("zenodo_s1", "index:7"): 1, ("mklab", "index:null"): 2}
    with pytest.raises(SchemaError, match="index:7"):
        labels.raise_if_any(found.filter("source = 'zenodo_s1'"), "undeclared")
    rgb = spark.createDataFrame([("mklab", 12 << 16 | 34 << 8 | 56)], "source string, native int")
    assert labels.unmapped(rgb, "rgb", F.col("native").cast("string"), label_map(spark)).first().value == "rgb:12,34,56"
    with pytest.raises(SchemaError):
        rgb_key("1,2")
    assert source_specs(spark).filter("source = 'zenodo_s1'").first().background_id == 255


def test_tiling(spark):
    with pytest.raises(ValueError):
        TileSpec(size=10, overlap=10)
    spec = TileSpec(size=128, overlap=0, negative_keep_ratio=1.0)
    mask = [1 if 100 <= i // 256 < 160 and 100 <= i % 256 < 200 else 0 for i in range(256 * 256)]
    df = spark.createDataFrame([("s", "src", 256, 256, mask, [[float(i) for i in range(256 * 256)]])], "sample_id string, source string, height int, width int, mask array<int>, bands array<array<float>>")
    df = df.withColumn("mask", F.col("mask").cast("array<smallint>"))
    got = {r.tile_id: r for r in tiling.tile_scenes(df, spec).collect()}
    assert sorted(got) == [f"src:s:{r:06d}:{c:06d}" for r in (0, 128) for c in (0, 128)]
    assert sum(r.n_px_oil for r in got.values()) == 60 * 100 and all(r.kept_as == "oil" for r in got.values())
    one = got["src:s:000128:000128"]
    assert one.tile_bands[0][0] == 128 * 256 + 128 and len(one.tile_bands[0]) == 128 * 128
    few = df.withColumn("mask", F.transform("mask", lambda m: F.when(m == 1, 1).otherwise(255).cast("smallint")))
    assert tiling.tile_scenes(few, spec).count() < tiling.tile_scenes(few, TileSpec(size=128, overlap=0, protect_positives=True)).count() == 4
