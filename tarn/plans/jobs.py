"""Jobs: build, split, stats, verify, sources, disk, search; each returns frames and raises where the command should fail."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarn.model import CHANNELS, CLASS_ID, MANIFEST, BuildConfig, SplitConfig, classes, label_map, read_sources, source_specs
from tarn.operators import catalogue, labels, manifest, raster, splits, tiling
from tarn.sources import fetch as remote
from tarn.sources import store
from tarn.sources.adapters import first_items, get_adapter


def sources(spark: SparkSession) -> DataFrame:
    return source_specs(spark).orderBy("source")


def prepare_scenes(scenes: DataFrame, config: BuildConfig) -> DataFrame:
    """Scenes whose bands are the feature stack, with their wind summary: what a row's own pixels give, without an exchange.

    Physics is skipped, and the bands stay as they are, for scenes without VV, uncalibrated ones, broken ones (`problems`) and where the configuration says so
    (`features_computed` tells). All computed scenes have the same channels: one whose input a scene lacks (VH, land) is null there."""
    names, bands = F.col("band_names"), F.col("bands")
    calibrated = F.coalesce(F.try_element_at("attrs", F.lit("radiometry")) != "8bit_render_not_calibrated", F.lit(True))
    rows = scenes.withColumn("problems", raster.problems())
    usable = calibrated & (F.size("problems") == 0) & F.lit(config.compute_features)
    rows = rows.withColumn("_vv", F.when(usable, raster.band(names, bands, raster.VV_NAMES))).withColumn("_vh", F.when(usable, raster.band(names, bands, raster.VH_NAMES)))
    land = F.transform("mask", lambda m: (m == CLASS_ID["land"]).cast("int"))
    rows = rows.withColumn("_land", F.when(F.col("_vv").isNotNull() & F.array_contains("mask", CLASS_ID["land"]), land))
    rows = rows.withColumn("_wind", raster.wind_channel(F.col("_vv"), F.col("height"), F.col("width"), None, config.phi, F.col("incidence")))
    channels = config.channels or CHANNELS
    stack = raster.feature_stack(rows, channels, "_vv", "_vh", "_land", None, config.phi, config.pixel_metres, "incidence", "_wind")
    made = F.col("_vv").isNotNull()
    stack = stack.select("*", *raster.field_summary(F.col("_wind"), config.phi)).withColumn("features_computed", made)
    stack = stack.withColumn("band_names", F.when(made, F.array(*map(F.lit, channels))).otherwise(names))
    stack = stack.withColumn("bands", F.when(made, F.array(*[F.col(f"ch_{c}") for c in channels])).otherwise(bands))
    return stack.drop("_vv", "_vh", "_land", "_wind", *[f"ch_{c}" for c in channels])


def build_source(spark: SparkSession, source: str, root: str, out: str, config: BuildConfig | None = None, limit: int | None = None) -> store.Staged:
    """Raw files of one source to tiles, staged in the store at `out`; limit takes the first scenes by id before any is decoded.

    Scenes are decoded, checked and given their features in one pass, whose result is staged beside the store until the tiles are written."""
    config = config or BuildConfig()
    adapter = get_adapter(source)(spark, root, read_sources(config.registry) if config.registry else None)
    items = adapter.discover()
    prepared = prepare_scenes(adapter.load(first_items(items, limit)), config)
    with store.staged(prepared, out) as scenes:
        labels.raise_if_any(scenes.filter(F.size("problems") > 0).select("sample_id", F.explode("problems").alias("problem")), f"{source}: broken scenes")
        labels.raise_if_any(manifest.band_layouts(scenes.withColumn("store", F.col("source"))), "band layouts differ inside a store")
        tiles = tiling.tile_scenes(scenes, config.tile).withColumn("store", F.col("source"))
        tiles = tiles.withColumn("label_completeness", F.try_element_at("attrs", F.lit("label_completeness")))
        tiles = manifest.place_tiles(tiles, config.shard_size)
        kept = tiles.select("tile_id", "sample_id", "source", "store", "shard", "shard_index", "row", "col", "kept_as", "label_completeness", "band_names", "tile_bands", "tile_mask", F.col("tile_h").alias("height"), F.col("tile_w").alias("width"), *[c for c in tiles.columns if c.startswith(("n_px_", "wind_", "observ"))], "lon", "lat", "acquired")
        return store.stage_tiles(kept, out, config.shard_size, checked=True)


def _sound(rows: DataFrame) -> None:
    labels.raise_if_any(manifest.integrity(store.typed(rows)).filter("severity = 'error'"), "the manifest is broken")


def build(spark: SparkSession, roots: dict[str, str], out: str, manifest_path: str, config: BuildConfig | None = None, append: bool = False, limit: int | None = None) -> DataFrame:
    """Build several sources into the store at `out` and the manifest; append: other sources of both stay.

    All sources are staged and the manifest to come is checked before anything is shown: a build that fails leaves store and
    manifest as they were. Then the tiles are committed, and the manifest with the version of the store that it means."""
    config = config or BuildConfig()
    tiles, staged = store.tile_store(spark, out), store.Staged("", {})
    table = store.manifest_table(spark, manifest_path)
    try:
        for source, root in roots.items():
            one = build_source(spark, source, root, out, config, limit)
            staged = store.Staged(one.commit, {**staged.parts, **one.parts})
        records = manifest.build_manifest([manifest.tile_records(tiles.frame(staged.parts))] if staged.parts else [], spark)
        rows = table.stage(records.repartitionByRange("source", "tile_id").sortWithinPartitions("source", "tile_id"))
        try:
            _sound(table.frame({**(table.latest().parts if append else {}), **rows.parts}, MANIFEST))
        except Exception:
            table.drop(rows)
            raise
    except Exception:
        tiles.drop(staged)
        raise
    shown = store.commit_tiles(spark, out, staged, config.shard_size, whole=not append)
    table.commit(rows, whole=not append, notes={"tiles": [out, shown.version]}, check=_sound)
    return store.read_manifest(spark, manifest_path)


def split(spark: SparkSession, manifest_path: str, config: SplitConfig | None = None, hash_mode: str = "md5") -> DataFrame:
    """Assign splits in place, and raise if a group leaks; made anew if another writer changes the manifest meanwhile."""
    config = config or SplitConfig()
    store.manifest_table(spark, manifest_path).update(lambda rows: splits.assign(rows, config, hash_mode, check=True), MANIFEST)
    written = store.read_manifest(spark, manifest_path)
    labels.raise_if_any(splits.leaked_groups(written, config), "groups straddle splits")
    return splits.split_sizes(written)


def stats(spark: SparkSession, manifest_path: str) -> dict[str, DataFrame]:
    found = store.read_manifest(spark, manifest_path)
    return {"summary": manifest.summarise(found), "splits": manifest.split_pivot(found), "integrity": manifest.integrity(found)}


def report(frames: dict[str, DataFrame], as_json: bool = False, rows: int = 200) -> str:
    """The frames of a job as text, a titled table or one JSON object each; `rows` of each at most."""
    found = {title: frame.limit(rows).toPandas() for title, frame in frames.items()}
    if as_json:
        return "{" + ", ".join(f"{json.dumps(title)}: {table.to_json(orient='records')}" for title, table in found.items()) + "}"
    return "\n\n".join(f"{title}\n{'-' * len(title)}\n{table.to_string(index=False) if len(table) else 'nothing'}" for title, table in found.items())


def verify(spark: SparkSession, native: DataFrame, kind: str, limit: int = 50) -> DataFrame:
    """Undeclared native values (source, native), commonest first; scanned before unification."""
    key = labels.index_key(F.col("native")) if kind == "index" else F.col("native").cast("string")
    return labels.unmapped(native, kind, key, label_map(spark)).orderBy(F.desc("n"), "source", "value").limit(limit)


def fetch(spark: SparkSession, registry: dict, name: str, root: str | None = None, verify: bool = True, tasks: int = 8) -> dict:
    """Bring a registered dataset's files under `root`/name, `tasks` at a time; what the lock has is verified (or skipped), and the lock then holds all that is there.

    Sources whose discovery is manual give their instructions. Files that fail, or differ from their recorded digest, raise once the others are recorded."""
    known, defaults = registry.get("sources", {}), registry.get("defaults", {})
    if name not in known:
        raise KeyError(f"no dataset {name!r}; registered: {sorted(known)}")
    entry = known[name]
    mode = entry.get("discovery", "manual")
    told = {"source": name, "status": mode, **{k: entry.get(k) for k in ("landing", "licence", "citation")}}
    if mode in ("manual", "unavailable"):
        return {**told, "manual_instructions": entry.get("manual_instructions") or entry.get("notes", ""), "downloaded": [], "verified": [], "skipped": []}
    if mode != "zenodo_api":
        raise NotImplementedError(f"discovery {mode!r} of {name!r}")
    folder = f"{root or defaults.get('root', 'data/raw')}/{name}"
    files = remote_listing(spark, entry["api"])
    lock = remote.read_lock(folder)
    locked = spark.createDataFrame([(k, v.get("size")) for k, v in lock.items() if v.get("sha256")], "relpath string, size bigint")
    plan = catalogue.fetch_plan(files, locked, verify).repartition(tasks, "relpath")
    limits = {"retries": int(defaults.get("retries", remote.RETRIES)), "backoff": float(defaults.get("backoff_seconds", remote.BACKOFF_SECONDS)), "chunk": int(defaults.get("chunk_bytes", remote.CHUNK))}
    found = remote.fetch_files(plan, folder, {k: v["sha256"] for k, v in lock.items() if v.get("sha256")}, **limits).orderBy("relpath").collect()  # a row for each file of a listing
    for r in found:
        if r.status == "downloaded":
            lock[r.relpath] = {"sha256": r.sha256, "size": r.size, "url": r.url, "fetched_at": r.fetched_at}
    remote.write_lock(folder, lock)
    if problems := [f"{r.relpath}: {r.problem}" for r in found if r.problem]:
        raise OSError(f"{name}: " + "; ".join(problems))
    return {**told, "status": "ok", "root": folder, **{s: [r.relpath for r in found if r.status == s] for s in ("downloaded", "verified", "skipped")}}


def remote_listing(spark: SparkSession, api: str) -> DataFrame:
    """(relpath, url, size) of a record's files; a record without any is an error."""
    files = catalogue.remote_files(spark.createDataFrame([(remote.listing(api),)], "body string"))
    if files.isEmpty():
        raise FileNotFoundError(f"no files at {api}")
    return files


def disk(files: DataFrame, free_bytes: int) -> DataFrame:
    return catalogue.disk_estimate(files).withColumn("fits", F.col("total_bytes") <= free_bytes)


def search(spark: SparkSession, url: str, query: catalogue.Search, top: int = 20) -> DataFrame:
    from tarn.sources.fetch import CatalogueSource

    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(CatalogueSource)
    found = spark.read.format("catalogue").option("url", url).option("filter", query.odata()).option("top", top).load()
    return catalogue.summarise_products(found)


__all__ = ["build", "build_source", "classes", "disk", "fetch", "prepare_scenes", "remote_listing", "report", "search", "sources", "split", "stats", "verify"]
