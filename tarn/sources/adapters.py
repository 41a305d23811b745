"""Scene discovery and loading: an adapter names the files of a source, `load` turns its items into scenes.

Discovery reads paths only. Decoding of image codecs (optional packages) runs in the executors; scenes already in Parquet need none.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarn.functions.geometry import bbox_ring, geojson_rings, wkt_rings
from tarn.model import SCENES, SOURCES, class_id
from tarn.operators.kernels import polygon_mask
from tarn.operators.labels import normalise_object_label, raise_if_any
from tarn.sources.codecs import read_image
from tarn.sources.images import open_file, reachable

# Directory and file names that the sources use.
IMAGE_DIRS, MASK_DIRS = ("images", "image", "img"), ("masks", "mask", "labels", "label")
LABEL_DIRS = ("labels_1D", "labels_1d", "labels_index", "labels", "labels_rgb", "masks")
ANNOTATION_NAMES = ("annotations.geojson", "annotations.json", "labels.geojson", "labels.json", "annotations.csv", "labels.csv")
PATCH_DIRS = ("patches", "images", "rasters", "tiles")

_REGISTRY: dict[str, type[Adapter]] = {}


def register(name: str) -> Callable[[type], type]:
    def wrap(cls: type) -> type:
        cls.name = name
        _REGISTRY[name] = cls
        return cls

    return wrap


def get_adapter(name: str) -> type[Adapter]:
    if name not in _REGISTRY:
        raise KeyError(f"no adapter {name!r}; registered: {registered()}")
    return _REGISTRY[name]


def registered() -> list[str]:
    return sorted(_REGISTRY)


class Adapter:
    """discover(): one row for each scene (sample_id first, sorted), no pixels; load(): rows of SCENES."""

    name = ""

    def __init__(self, spark: SparkSession, root: str, sources: dict | None = None) -> None:
        self.spark, self.root, self.spec = spark, root, (sources or SOURCES)[self.name]

    def files(self) -> DataFrame:
        """(path) of every file under the root; contents aren't read."""
        found = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(self.root)
        return found.select("path")

    def discover(self) -> DataFrame:
        raise NotImplementedError

    def load(self, items: DataFrame) -> DataFrame:
        raise NotImplementedError

    def describe(self) -> dict:
        return {"source": self.name, "root": self.root, "n_items": self.discover().count(), **{k: self.spec[k] for k in ("expresses", "encoding", "background_policy", "provisional")}}


def path_parts(path: Column) -> tuple[Column, Column, Column]:
    """Partition (directory two up), directory and stem of a path."""
    return F.regexp_extract(path, r"([^/]+)/[^/]+/[^/]+$", 1), F.regexp_extract(path, r"([^/]+)/[^/]+$", 1), F.regexp_extract(path, r"([^/]+?)(?:\.[^./]*)?$", 1)


def pair_by_stem(files: DataFrame, left_dirs: tuple[str, ...], right_dirs: tuple[str, ...], item: str | None = None) -> DataFrame:
    """(partition, stem, left, right): in each partition the first present directory of each list, files joined by stem; right is null where it is missing, unmatched right files are ignored.

    item: a column of files that tells apart what shares a path (listings merged from several stores); files of different items
    never pair, and it comes out beside the others. Without it a path is one file, however often it is listed."""
    part, folder, stem = path_parts(F.col("path"))
    own_keys = [item] if item else []
    keys = ["partition", "stem", *own_keys]
    rows = files.select("path", part.alias("partition"), folder.alias("dir"), stem.alias("stem"), *own_keys)

    def side(dirs: tuple[str, ...], name: str) -> DataFrame:
        rank = F.array_position(F.array(*map(F.lit, dirs)), F.col("dir"))
        own = rows.filter(F.col("dir").isin(*dirs)).withColumn("rank", rank)
        best = own.groupBy("partition").agg(F.min("rank").alias("rank"))
        return own.join(best, ["partition", "rank"]).groupBy(*keys).agg(F.min("path").alias(name))

    return side(left_dirs, "left").join(side(right_dirs, "right"), keys, "left")


def paired_items(pairs: DataFrame) -> DataFrame:
    """(sample_id, image, mask), sorted by sample_id."""
    return pairs.select(F.concat_ws("/", "partition", "stem").alias("sample_id"), F.col("left").alias("image"), F.col("right").alias("mask")).orderBy("sample_id")


def first_items(items: DataFrame, limit: int | None) -> DataFrame:
    """The first items of a sorted discovery, before any is decoded."""
    return items.limit(limit) if limit else items


def missing_pairs(pairs: DataFrame) -> DataFrame:
    return pairs.filter("right is null").select("partition", "stem", "left")


def _decode(row: dict, role: str) -> tuple[np.ndarray, bool]:
    """The image of a column of paths, from its bytes where the row carries them, else from the file; and whether it holds palette indices."""
    content = row.get(f"{role}_bytes")
    if content is None:
        with open_file(row[role]) as f:
            content = f.read()
    return read_image(content)


def scene_files(spark: SparkSession, items: DataFrame, root: str, columns: list[str]) -> DataFrame:
    """items dealt out for loading: by path, opened where they are decoded. Only where the executors' Python can't open
    the files (a store that Spark alone reads) do the rows carry the bytes."""
    if reachable(root):
        return items.repartition(max(spark.sparkContext.defaultParallelism, 1) * 4, "sample_id")
    return with_contents(spark, items, root, columns)


def with_contents(spark: SparkSession, items: DataFrame, root: str, columns: list[str]) -> DataFrame:
    """items (one row for each sample_id) with the bytes of the files that the given columns name.

    The root is read once: each file finds its item by the narrow table of paths, and an item's files meet by sample_id."""
    content = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", "content")
    named = F.explode(F.array(*[F.struct(F.lit(c).alias("role"), F.col(c).alias("path")) for c in columns])).alias("of")
    found = content.join(items.select("sample_id", named).select("sample_id", "of.role", "of.path"), "path")
    gathered = found.groupBy("sample_id").agg(*[F.first(F.when(F.col("role") == c, F.col("content")), ignorenulls=True).alias(f"{c}_bytes") for c in columns])
    return items.join(gathered, "sample_id", "left")


def _scene(sample: str, source: str, bands: dict[str, np.ndarray], mask: np.ndarray, attrs: dict[str, str]) -> tuple:
    h, w = mask.shape
    return sample, source, h, w, list(bands), [np.asarray(b, dtype=np.float32).ravel() for b in bands.values()], mask.astype(np.int16).ravel(), None, None, None, None, attrs


def _scenes(make: Callable[[dict], tuple]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    names = [part.split()[0] for part in SCENES.replace("map<string,string>", "map").split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame([make(row) for row in frame.to_dict("records")], columns=names)

    return run


def _looked_up(native: np.ndarray, table: dict[int, int], what: str) -> np.ndarray:
    """Labels by table; undeclared values raise with their counts."""
    values, inverse, counts = np.unique(native, return_inverse=True, return_counts=True)
    missing = {int(v): int(c) for v, c in zip(values, counts, strict=True) if int(v) != v or int(v) not in table}
    if missing:
        raise ValueError(f"undeclared {what}: {missing}")
    return np.array([table[int(v)] for v in values], dtype=np.int16)[inverse].reshape(native.shape)


class _Paired(Adapter):
    left_dirs, right_dirs = IMAGE_DIRS, MASK_DIRS

    def discover(self) -> DataFrame:
        pairs = pair_by_stem(self.files(), self.left_dirs, self.right_dirs)
        raise_if_any(missing_pairs(pairs), f"{self.name}: images without a mask")
        return paired_items(pairs)

    def load(self, items: DataFrame) -> DataFrame:
        rows = scene_files(self.spark, items, self.root, ["image", "mask"])
        self.spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")  # a scene is tens of MB
        return rows.mapInPandas(_scenes(self._make()), SCENES)

    def _make(self) -> Callable[[dict], tuple]:
        raise NotImplementedError


@register("zenodo_s1")
class BinaryPairs(_Paired):
    """Two-channel backscatter with a binary mask that only asserts oil."""

    def _make(self) -> Callable[[dict], tuple]:
        table = {int(k): class_id(v) for k, v in self.spec["index_map"].items()}

        def make(row: dict) -> tuple:
            (image, _), (mask, _) = _decode(row, "image"), _decode(row, "mask")
            image = image[:, :, None] if image.ndim == 2 else image
            if image.shape[2] not in (1, 2):
                raise ValueError(f"{row['sample_id']}: {image.shape[2]} channels")
            if mask.ndim == 3:
                if (mask != mask[:, :, :1]).any():
                    raise ValueError(f"{row['sample_id']}: mask channels differ")
                mask = mask[:, :, 0]
            if set(np.unique(mask)) <= {0, 255} and (mask == 255).any():
                mask = mask > 0
            bands = {n: image[:, :, k] for k, n in enumerate(("vv_db", "vh_db")[: image.shape[2]])}
            return _scene(row["sample_id"], "zenodo_s1", bands, _looked_up(mask, table, "mask values"), {"label_completeness": "binary_oil_only", "radiometry": "calibrated_db"})

        return make


@register("mklab")
class PalettePairs(_Paired):
    """8-bit renders with palette or RGB labels."""

    left_dirs, right_dirs = ("images",), LABEL_DIRS

    def _make(self) -> Callable[[dict], tuple]:
        index = {int(k): class_id(v) for k, v in self.spec["index_map"].items()}
        colour = {sum(int(p) << s for p, s in zip(k.split(","), (16, 8, 0), strict=True)): class_id(v) for k, v in self.spec["rgb_map"].items()}

        def make(row: dict) -> tuple:
            (image, _), (label, _) = _decode(row, "image"), _decode(row, "mask")
            image = image if image.ndim == 2 else image[:, :, 0]
            if label.ndim == 3:
                packed = label[:, :, :3].astype(np.int64) @ np.array([1 << 16, 1 << 8, 1])
                mask = _looked_up(packed, colour, "colours (r << 16 | g << 8 | b)")
            else:
                mask = _looked_up(label, index, "label indices")
            return _scene(row["sample_id"], "mklab", {"vv_render_norm": image / 255.0}, mask, {"label_completeness": "full", "radiometry": "8bit_render_not_calibrated"})

        return make


FEATURES = "features array<struct<properties:map<string,string>,geometry:struct<type:string,coordinates:string>>>"


def geojson_annotations(spark: SparkSession, text: DataFrame, column: str = "value") -> DataFrame:
    """(patch_id, obj_order, label, rings, coord_space) of a FeatureCollection, or a bare list of features, given as text rows."""
    body = F.when(F.ltrim(F.col(column)).startswith("["), F.concat(F.lit('{"features":'), F.col(column), F.lit("}"))).otherwise(F.col(column))
    rows = text.select(F.posexplode(F.from_json(body, FEATURES)["features"]).alias("obj_order", "f")).withColumn("obj_order", F.col("obj_order").cast("long"))
    named = lambda *keys: F.coalesce(*[F.nullif(F.try_element_at(F.col("f.properties"), F.lit(k)), F.lit("")) for k in keys])
    geometry = F.concat(F.lit('{"coordinates":'), F.col("f.geometry.coordinates"), F.lit("}"))
    return rows.select(named("patch_id", "patch", "image_id", "scene").alias("patch_id"), "obj_order", named("class", "label", "type").alias("label"), geojson_rings(F.col("f.geometry.type"), geometry).alias("rings"), F.coalesce(named("coord_space"), F.lit("pixel")).alias("coord_space"))


def csv_annotations(table: DataFrame) -> DataFrame:
    """The same from a CSV's rows: headers in any case, `wkt` or xmin, ymin, xmax, ymax; anything else is an error."""
    low = table.select(*[F.trim(F.col(f"`{c}`")).alias(c.strip().lower()) for c in table.columns])
    have = set(low.columns)
    pick = lambda *names: F.coalesce(*[F.nullif(F.col(n), F.lit("")) for n in names if n in have], F.lit(None).cast("string"))
    box = {"xmin", "ymin", "xmax", "ymax"} <= have
    rings = bbox_ring(*[F.col(n).cast("double") for n in ("xmin", "ymin", "xmax", "ymax")]) if box else None
    shape = F.when(pick("wkt").isNotNull(), wkt_rings(pick("wkt"))) if "wkt" in have else F.when(F.lit(False), F.array(F.array(F.struct(F.lit(0.0).alias("x"), F.lit(0.0).alias("y")))))
    shape = shape.when(rings[0]["x"].isNotNull(), F.array(rings)) if box else shape
    return low.select(pick("patch_id", "patch", "image_id", "scene").alias("patch_id"), pick("class", "label", "type").alias("label"), shape.otherwise(F.raise_error(F.lit("annotation without wkt or box"))).alias("rings"), F.coalesce(pick("coord_space"), F.lit("pixel")).alias("coord_space"))


def patches_with_objects(patches: DataFrame, annotations: DataFrame) -> DataFrame:
    """Every patch with its objects in file order; patches without any keep an empty list."""
    grouped = annotations.groupBy("patch_id").agg(F.array_sort(F.collect_list(F.struct(F.col("obj_order").cast("long").alias("obj_order"), "label", "rings"))).alias("objects"))
    empty = F.array().cast("array<struct<obj_order:bigint,label:string,rings:array<array<struct<x:double,y:double>>>>>")
    return patches.join(grouped, "patch_id", "left").withColumn("objects", F.coalesce("objects", empty))


def dangling_annotations(patches: DataFrame, annotations: DataFrame) -> DataFrame:
    return annotations.join(patches, "patch_id", "left_anti").select("patch_id").distinct()


@register("pangaea_emed")
class VectorObjects(Adapter):
    """Rasters with polygon annotations; unannotated pixels are sea."""

    def annotations(self) -> DataFrame:
        found = [r.path for r in self.files().filter(F.regexp_extract("path", r"([^/]+)$", 1).isin(*ANNOTATION_NAMES)).orderBy("path").limit(1).collect()]
        if not found:
            raise FileNotFoundError(f"no annotation file under {self.root}")
        if found[0].endswith(".csv"):
            return csv_annotations(self.spark.read.option("header", "true").csv(found[0])).withColumn("obj_order", F.monotonically_increasing_id())
        return geojson_annotations(self.spark, self.spark.read.option("wholetext", "true").text(found[0]))

    def discover(self) -> DataFrame:
        _, folder, stem = path_parts(F.col("path"))
        patches = self.files().filter(folder.isin(*PATCH_DIRS)).select(stem.alias("patch_id"), F.col("path").alias("image"))
        notes = self.annotations()
        raise_if_any(dangling_annotations(patches, notes), "annotations without a raster")
        known = F.array(*map(F.lit, self.spec["object_class_map"]))
        raise_if_any(notes.filter(~F.array_contains(known, normalise_object_label(F.col("label")))).groupBy("label").count(), "undeclared object labels")
        raise_if_any(notes.filter("coord_space <> 'pixel'").select("patch_id", "coord_space"), "annotations must be in pixel coordinates")
        return patches_with_objects(patches, notes).withColumnRenamed("patch_id", "sample_id").orderBy("sample_id")

    def load(self, items: DataFrame) -> DataFrame:
        table = {k: class_id(v) for k, v in self.spec["object_class_map"].items()}

        def make(row: dict) -> tuple:
            image = np.atleast_3d(_decode(row, "image")[0])
            mask = np.zeros(image.shape[:2], dtype=np.int16)
            for o in row["objects"]:
                inside = polygon_mask([[(p["x"], p["y"]) for p in ring] for ring in o["rings"]], *mask.shape)
                mask[inside] = table[o["label"].strip().lower().replace(" ", "_").replace("-", "_")]
            return _scene(row["sample_id"], "pangaea_emed", {"vv_db": image[:, :, 0]}, mask, {"label_completeness": "full", "radiometry": "calibrated_db"})

        rows = scene_files(self.spark, items, self.root, ["image"])
        self.spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
        return rows.mapInPandas(_scenes(make), SCENES)
