"""The manifest: records, append by source, summaries, integrity and pivots."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarn.model import MANIFEST, PIXEL_COLUMNS
from tarn.operators.tiling import oil_fraction, supervised_fraction
from tarn.scratch import cut


def tile_records(tiles: DataFrame) -> DataFrame:
    """The manifest's columns from tiles with their scene's columns; what is not known is null, completeness `unknown`, split empty."""
    have = set(tiles.columns)
    derived = {"oil_fraction": oil_fraction(), "supervised_fraction": supervised_fraction(), "split": F.lit(""), "label_completeness": F.coalesce("label_completeness", F.lit("unknown")) if "label_completeness" in have else F.lit("unknown")}
    return tiles.select(*[(derived[f.name] if f.name in derived else F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in MANIFEST])


def empty_manifest(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], MANIFEST)


def build_manifest(parts: list[DataFrame], spark: SparkSession | None = None) -> DataFrame:
    """Union by name, with all columns typed and in order, sorted by tile_id."""
    parts = [p for p in parts if p.columns]
    if not parts:
        return empty_manifest(spark or SparkSession.active())
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    have = set(whole.columns)
    return whole.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in MANIFEST]).orderBy("tile_id")


def replace_source(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Append by source: rows of the sources that `new` has are replaced."""
    sources = F.broadcast(new.select("source").distinct())  # a handful of registry names
    return existing.join(sources, "source", "left_anti").unionByName(new)


def assign_shards(tiles: DataFrame, store: str = "store", shard_size: int = 512, order: tuple[str, ...] = ("sample_id", "row", "col", "tile_id")) -> DataFrame:
    """Logical addresses: tiles of a store in scene and raster order, `shard_size` to a shard.

    Positions are counted in two steps, within 256 parts of the scenes and then by the parts' offsets, so that no task sorts a whole store."""
    part = F.conv(F.substring(F.md5(F.col(order[0]).cast("string").cast("binary")), 1, 2), 16, 10).cast("int")
    keyed = tiles.withColumn("_part", part)
    local = keyed.withColumn("_n", F.row_number().over(Window.partitionBy(store, "_part").orderBy(*order)))
    sizes = keyed.groupBy(store, "_part").count().withColumn("_before", F.coalesce(F.sum("count").over(Window.partitionBy(store).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select(store, "_part", "_before")
    placed = local.join(F.broadcast(sizes), [store, "_part"]).withColumn("_at", F.col("_before") + F.col("_n") - 1)  # 256 rows to a store
    number = F.floor(F.col("_at") / shard_size)
    return placed.withColumn("shard", F.concat(F.lit("tiles_"), F.lpad(number.cast("string"), 5, "0"), F.lit(".npz"))).withColumn("shard_index", (F.col("_at") % shard_size).cast("int")).drop("_part", "_n", "_before", "_at")


#: Tiles whose addresses are broadcast, so that pixels move once, to their shard: some 20 MB.
BROADCAST_TILES = 200_000


def place_tiles(tiles: DataFrame, shard_size: int = 512) -> DataFrame:
    """tiles with their shard addresses, numbered on narrow rows alone (tile_id must be unique); beyond BROADCAST_TILES rows meet their address by an exchange."""
    narrow = tiles.select("tile_id", "sample_id", "row", "col", "store")
    numbers = cut(assign_shards(narrow, shard_size=shard_size).select("tile_id", "shard", "shard_index"))
    few = numbers.count() <= BROADCAST_TILES
    return tiles.join(F.broadcast(numbers) if few else numbers, "tile_id")


def summarise(manifest: DataFrame) -> DataFrame:
    """Per source: tiles, scenes, kinds, mean fractions, pixel percentages and the share of observable tiles."""
    total = reduce(lambda a, b: a + b, [F.sum(c) for c in PIXEL_COLUMNS])
    percent = [F.round(100 * F.try_divide(F.sum(c).cast("double"), total), 3).alias(c.replace("n_px_", "pct_")) for c in PIXEL_COLUMNS]
    seen = F.when(F.count("observability") > 0, F.round(F.avg(F.when(F.col("observability") == "observable", 1.0).otherwise(0.0)), 3))
    return manifest.groupBy("source").agg(
        F.count("tile_id").alias("n_tiles"),
        F.countDistinct("sample_id").alias("n_scenes"),
        *[F.count_if(F.col("kept_as") == k).alias(f"{k}_tiles") for k in ("oil", "look_alike", "negative")],
        F.avg("oil_fraction").alias("mean_oil_fraction"),
        F.avg("supervised_fraction").alias("mean_supervised_fraction"),
        *percent,
        seen.alias("frac_scenes_observable"),
    )


def duplicates(manifest: DataFrame, *columns: str) -> DataFrame:
    """One row: how many rows repeat another's key (nulls count as equal)."""
    each = manifest.groupBy(*columns).count()
    return each.agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("long").alias("n_duplicates"))


def integrity(manifest: DataFrame) -> DataFrame:
    """(severity, check, n) of what is wrong: a row only where n > 0. One scan for the aggregates, one exchange for each kind of duplicate."""
    other = ["n_px_sea", "n_px_look_alike", "n_px_ship", "n_px_land"]
    total = reduce(lambda a, b: a + b, [F.coalesce(F.sum(c), F.lit(0)) for c in PIXEL_COLUMNS])
    facts = manifest.agg(
        F.count("*").alias("rows"),
        F.coalesce(F.sum(F.when(F.col("label_completeness") == "binary_oil_only", sum((F.coalesce(F.col(c), F.lit(0)) for c in other), F.lit(0)))), F.lit(0)).alias("leak"),
        F.count_if((F.col("oil_fraction") > 1) | (F.col("oil_fraction") < 0)).alias("range"),
        (F.coalesce(F.sum("n_px_oil"), F.lit(0)) / F.greatest(total, F.lit(1))).alias("share"),
        F.count_if(F.coalesce(F.col("split"), F.lit("?")) != "").alias("assigned"),
        F.count("lon").alias("placed"),
    )
    one = lambda severity, check, n: F.struct(F.lit(severity).alias("severity"), F.lit(check).alias("check"), n.cast("long").alias("n"))
    rows = F.col("rows") > 0
    flag = lambda test: (rows & test).cast("long")
    found = facts.select(F.explode(F.array(
        one("error", "empty manifest", (~rows).cast("long")), one("error", "binary source asserts other classes", F.col("leak")), one("error", "oil_fraction outside [0, 1]", F.col("range")),
        one("warning", "oil under 0.001 of pixels", flag(F.col("share") < 0.001)), one("warning", "no split assigned", flag(F.col("assigned") == 0)), one("warning", "no position", flag(F.col("placed") == 0)),
    )).alias("f")).select("f.*")
    dup = lambda check, *c: duplicates(manifest, *c).select(F.lit("error").alias("severity"), F.lit(check).alias("check"), F.col("n_duplicates").alias("n"))
    return found.unionByName(dup("duplicate tile_id", "tile_id")).unionByName(dup("shared address", "store", "shard", "shard_index")).filter("n > 0")


def split_pivot(manifest: DataFrame, splits: tuple[str, ...] = ("train", "val", "test")) -> DataFrame:
    return manifest.groupBy("source").pivot("split", list(splits)).agg(F.count("tile_id")).fillna(0)


def band_layouts(tiles: DataFrame) -> DataFrame:
    """Stores whose tiles differ in their band names."""
    return tiles.groupBy("store").agg(F.countDistinct("band_names").alias("n_layouts")).filter("n_layouts > 1")


def sidecar(tiles: DataFrame, shard_size: int = 512, prefix: str = "tiles") -> DataFrame:
    """One JSON description of each store."""
    facts = tiles.groupBy("store").agg(F.max(F.array_join("band_names", ",")).alias("bands"), F.countDistinct("shard").alias("n_shards"), F.count("*").alias("n_tiles"))
    return facts.select("store", F.to_json(F.struct(F.col("store").alias("store_name"), F.lit(prefix).alias("prefix"), F.lit(shard_size).alias("shard_size"), F.split("bands", ",").alias("band_names"), "n_shards", "n_tiles")).alias("sidecar"))
