"""Content-aware tiling: origins, pixel counts of overlapping tiles, kinds, validity and deterministic sub-sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarn.functions.hashing import FRACTIONS
from tarn.model import CLASS_ID, IGNORE, PIXEL_COLUMNS, TileSpec
from tarn.operators.labels import class_counts


def origins(extent: Column, size: int, stride: int) -> Column:
    """Tile origins along an axis: a grid whose last tile is flush with the edge."""
    last = extent - size
    return F.when(last <= 0, F.array(F.lit(0))).otherwise(F.array_distinct(F.concat(F.sequence(F.lit(0), F.greatest(last, F.lit(0)), F.lit(stride)), F.array(last))))


def windows(scenes: DataFrame, spec: TileSpec) -> DataFrame:
    """One row for each window of each scene in raster order, with the scene's columns; no shuffle."""
    rows = scenes.withColumn("row", F.explode(origins(F.col("height"), spec.size, spec.stride)))
    return rows.withColumn("col", F.explode(origins(F.col("width"), spec.size, spec.stride)))


def tile_id(source: Column, sample: Column, row: Column, col: Column) -> Column:
    return F.concat_ws(":", source, sample, F.lpad(row.cast("string"), 6, "0"), F.lpad(col.cast("string"), 6, "0"))


def covering(position: Column, extent: Column, size: int, stride: int) -> Column:
    """Origins of the tiles that hold a position: what a pixel explodes to, in place of a range join."""
    return F.filter(origins(extent, size, stride), lambda o: (o <= position) & (position < o + size))


def count_tiles(pixels: DataFrame, keys: list[str], height: Column, width: Column, spec: TileSpec) -> DataFrame:
    """Class counts of every (overlapping) tile from long pixels with a `label`: a pixel explodes to its few tiles, then one aggregation."""
    rows = pixels.select(*keys, "label", "col", height.alias("_h"), width.alias("_w"), F.explode(covering(F.col("row"), height, spec.size, spec.stride)).alias("tile_row"))
    both = rows.select(*keys, "label", "_h", "_w", "tile_row", F.explode(covering(F.col("col"), F.col("_w"), spec.size, spec.stride)).alias("tile_col"))
    return both.groupBy(*keys, F.col("tile_row").alias("row"), F.col("tile_col").alias("col")).agg(*class_counts(F.col("label")), F.count("*").alias("n_px"))


def tile_masks(scenes: DataFrame, spec: TileSpec) -> DataFrame:
    """Windows of dense scenes with their own mask and bands cut from the flat arrays, and class counts; native, one row for each tile."""
    w = F.least(F.col("width"), F.lit(spec.size))
    h = F.least(F.col("height"), F.lit(spec.size))
    cut = lambda a: F.flatten(F.transform(F.sequence(F.lit(0), F.col("tile_h") - 1), lambda r: F.slice(a, ((F.col("row") + r) * F.col("width") + F.col("col") + 1).cast("int"), F.col("tile_w"))))
    out = windows(scenes, spec).withColumn("tile_h", h).withColumn("tile_w", w)
    out = out.withColumn("tile_mask", cut(F.col("mask"))).withColumn("tile_bands", F.transform("bands", cut))
    holds = lambda k: F.size(F.filter("tile_mask", lambda m: m == k)).cast("long")
    counted = [holds(k).alias(f"n_px_{n}") for n, k in [*CLASS_ID.items(), ("ignore", IGNORE)]]
    return out.select("*", *counted, (F.col("tile_h") * F.col("tile_w")).cast("long").alias("n_px"))


def _sum(names: list[str]) -> Column:
    out = F.col(names[0])
    for n in names[1:]:
        out = out + F.col(n)
    return out


def labelled_pixels() -> Column:
    return _sum([c for c in PIXEL_COLUMNS if c != "n_px_ignore"])


def oil_fraction() -> Column:
    """Oil among supervised pixels, 0 where none is supervised."""
    return F.coalesce(F.try_divide(F.col("n_px_oil").cast("double"), labelled_pixels()), F.lit(0.0))


def supervised_fraction() -> Column:
    return F.coalesce(F.try_divide(labelled_pixels().cast("double"), _sum(PIXEL_COLUMNS)), F.lit(0.0))


def classify() -> Column:
    """What supervision a tile carries; oil wins over look-alikes."""
    return F.when(F.col("n_px_oil") > 0, "oil").when(F.col("n_px_look_alike") > 0, "look_alike").when(labelled_pixels() > 0, "negative").otherwise("empty")


def keep_valid(tiles: DataFrame, spec: TileSpec) -> DataFrame:
    """Drop tiles without labels and tiles under the least valid share."""
    total = labelled_pixels() + F.col("n_px_ignore")
    enough = F.coalesce(F.try_divide(labelled_pixels().cast("double"), total), F.lit(0.0)) >= spec.min_valid_fraction
    if spec.protect_positives:
        enough = enough | (F.col("n_px_oil") > 0) | (F.col("n_px_look_alike") > 0)
    return tiles.filter((labelled_pixels() > 0) & enough if spec.drop_all_ignore else enough)


def subsample_negatives(tiles: DataFrame, spec: TileSpec, hash_mode: str = "md5") -> DataFrame:
    """Keep a negative tile if the fraction of its id is under the ratio; other kinds stay."""
    fraction = FRACTIONS[hash_mode](F.concat_ws(":", F.lit(str(spec.seed)), F.col("tile_id")))
    return tiles.filter((F.col("kept_as") != "negative") | (fraction < spec.negative_keep_ratio))


def tile_scenes(scenes: DataFrame, spec: TileSpec, hash_mode: str = "md5") -> DataFrame:
    """Scenes to kept tiles: row-local from scan to result."""
    tiles = keep_valid(tile_masks(scenes, spec), spec).withColumn("kept_as", classify())
    tiles = tiles.withColumn("tile_id", tile_id(F.col("source"), F.col("sample_id"), F.col("row"), F.col("col")))
    return subsample_negatives(tiles, spec, hash_mode)
