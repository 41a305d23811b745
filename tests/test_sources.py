import json
import os
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarn.model import CHANNELS, BuildConfig, SchemaError, SplitConfig, TileSpec, label_map, read_sources, source_specs
from tarn.operators import catalogue
from tarn.plans import jobs
from tarn.sources import fetch, store
from tarn.sources.adapters import get_adapter, registered
from tests.test_raster import scene


def pairs(root, n=3, size=64, value=1, missing=False):
    for k in range(n):
        vv, oil = scene(size=size, seed=k)
        for d, a in (("images", np.dstack([vv, vv - 9]).astype(np.float32)), ("masks", (oil * value).astype(np.uint8))):
            (root / "train" / d).mkdir(parents=True, exist_ok=True)
            if not (missing and k == 1 and d == "masks"):
                np.save(root / "train" / d / f"scene_{k:03d}.npy", a)


def objects(root, label="oil_slick"):
    (root / "patches").mkdir(parents=True)
    features = []
    for k in range(2):
        np.save(root / "patches" / f"oil_{k}.npy", scene(size=64, seed=k)[0].astype(np.float32))
        features.append({"type": "Feature", "properties": {"patch_id": f"oil_{k}", "class": label}, "geometry": {"type": "Polygon", "coordinates": [[[5, 5], [40, 5], [40, 40], [5, 40]]]}})
        features.append({"type": "Feature", "properties": {"patch_id": f"oil_{k}", "class": "biogenic"}, "geometry": {"type": "Polygon", "coordinates": [[[30, 30], [50, 30], [50, 50], [30, 50]]]}})
    np.save(root / "patches" / "clean_0.npy", scene(size=64, damping=0)[0].astype(np.float32))
    (root / "annotations.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": features}))


def test_binary_pairs(spark, tmp_path):
    for value in (1, 255):
        root = tmp_path / str(value)
        pairs(root, value=value)
        a = get_adapter("zenodo_s1")(spark, str(root))
        assert [r.sample_id for r in a.discover().collect()] == [f"train/scene_{k:03d}" for k in range(3)]
        s = a.load(a.discover()).collect()
        assert set(s[0].mask) == {1, 255} and s[0].band_names == ["vv_db", "vh_db"] and len(s[0].bands[0]) == 4096
    assert a.describe()["n_items"] == 3 and registered() == ["mklab", "pangaea_emed", "zenodo_s1"]
    with pytest.raises(KeyError, match="registered"):
        get_adapter("nothing")


def test_bad_pairs(spark, tmp_path):
    pairs(tmp_path / "a", value=7)
    a = get_adapter("zenodo_s1")(spark, str(tmp_path / "a"))
    with pytest.raises(Exception, match="undeclared mask values"):
        a.load(a.discover()).collect()
    pairs(tmp_path / "b", missing=True)
    with pytest.raises(ValueError, match="without a mask"):
        get_adapter("zenodo_s1")(spark, str(tmp_path / "b")).discover()


def test_palette_and_rgb_labels_agree(spark, tmp_path):
    index = np.random.default_rng(0).integers(0, 5, (32, 32)).astype(np.uint8)
    colours = np.array([(0, 0, 0), (0, 255, 255), (255, 0, 0), (153, 76, 0), (0, 153, 0)], dtype=np.uint8)
    for name, folder, label in (("i", "labels_1D", index), ("c", "labels", colours[index])):
        for d, a in (("images", index * 50), (folder, label)):
            (tmp_path / name / "train" / d).mkdir(parents=True, exist_ok=True)
            np.save(tmp_path / name / "train" / d / "p.npy", a)
    got = []
    for name in "ic":
        a = get_adapter("mklab")(spark, str(tmp_path / name))
        got.append(a.load(a.discover()).first())
    assert got[0].mask == got[1].mask == index.ravel().tolist() and got[0].attrs["radiometry"] == "8bit_render_not_calibrated"


def test_vector_objects(spark, tmp_path):
    objects(tmp_path / "a")
    a = get_adapter("pangaea_emed")(spark, str(tmp_path / "a"))
    rows = {r.sample_id: np.array(r.mask).reshape(64, 64) for r in a.load(a.discover()).collect()}
    assert (rows["clean_0"] == 0).all() and rows["oil_0"][10, 10] == 1 and rows["oil_0"][35, 35] == 2 and rows["oil_0"][60, 60] == 0
    objects(tmp_path / "b", label="unheard of")
    with pytest.raises(ValueError, match="undeclared object labels"):
        get_adapter("pangaea_emed")(spark, str(tmp_path / "b")).discover()


def test_build_split_stats(spark, tmp_path):
    pairs(tmp_path / "z")
    objects(tmp_path / "p")
    out, path = str(tmp_path / "tiles"), str(tmp_path / "manifest.parquet")
    config = BuildConfig(tile=TileSpec(size=32, overlap=0, negative_keep_ratio=1.0, min_valid_fraction=0.01))
    m = jobs.build(spark, {"zenodo_s1": str(tmp_path / "z"), "pangaea_emed": str(tmp_path / "p")}, out, path, config)
    n = m.count()
    assert n > 10 and m.filter("wind_ms_scene is null").count() == 0
    sizes = jobs.split(spark, path, SplitConfig())
    assert sum(r.n_tiles for r in sizes.collect()) == n
    found = jobs.stats(spark, path)
    assert {r["source"] for r in found["summary"].collect()} == {"zenodo_s1", "pangaea_emed"}
    assert found["integrity"].filter("severity = 'error'").count() == 0
    assert [r["source"] for r in jobs.sources(spark).collect()] == ["inhouse", "mklab", "pangaea_emed", "zenodo_s1"]
    text = jobs.report(found)
    assert "zenodo_s1" in text and "integrity" in text and json.loads(jobs.report(found, as_json=True))["splits"]
    # Tiles hold the feature stack, in one layout whatever a scene has, and a shard's tiles lie in one file.
    tiles = store.read_tiles(spark, out)
    assert {tuple(r.band_names) for r in tiles.select("band_names").distinct().collect()} == {CHANNELS}
    files = tiles.select("store", "shard", F.input_file_name().alias("file")).groupBy("store", "shard").agg(F.countDistinct("file").alias("n"))
    assert {r.n for r in files.collect()} == {1} and not [p for p in os.listdir(out) if p.startswith("_staged")]


def test_broken_scenes_stop_a_build(spark, tmp_path):
    pairs(tmp_path / "z")
    for p in list((tmp_path / "z").rglob("masks/*.npy"))[:1]:
        np.save(p, np.zeros((3, 3), dtype=np.uint8))
    with pytest.raises(Exception, match="broken scenes"):
        jobs.build(spark, {"zenodo_s1": str(tmp_path / "z")}, str(tmp_path / "t"), str(tmp_path / "m"), BuildConfig(tile=TileSpec(size=32, overlap=0)))


def test_build_with_a_registry_file(tmp_path, spark):
    """A label that only the file declares builds with it, and stops the build without it."""
    objects(tmp_path / "p", label="Bilge-Water")
    (tmp_path / "r.yaml").write_text("""
sources:
  pangaea_emed: {expresses: [sea, oil, look_alike], encoding: vector_objects, background_policy: sea, provisional: false, object_class_map: {bilge_water: oil, biogenic: look_alike}}
""")
    tile = TileSpec(size=32, overlap=0, negative_keep_ratio=1.0, min_valid_fraction=0.01)
    build = lambda name, **more: jobs.build(spark, {"pangaea_emed": str(tmp_path / "p")}, str(tmp_path / name), str(tmp_path / f"{name}_m"), BuildConfig(tile=tile, **more))
    assert build("with", registry=str(tmp_path / "r.yaml")).filter("n_px_oil > 0").count() > 0
    with pytest.raises(ValueError, match="undeclared object labels"):
        build("without")


def test_registry_of_a_file(tmp_path, spark):
    text = """
schema:
  classes: [{id: 0, name: sea}, {id: 1, name: oil}]
sources:
  own: {expresses: [oil], encoding: index_raster, background_policy: ignore, index_map: {0: ignore, 7: oil}, object_class_map: {film: oil}}
"""
    path = tmp_path / "r.yaml"
    path.write_text(text)
    found = read_sources(path)
    assert {(r.kind, r.native, r.unified) for r in label_map(spark, found).collect()} == {("index", "0", 255), ("index", "7", 1), ("object", "film", 1)}
    assert [(r.source, r.expressible_ids, r.background_id) for r in source_specs(spark, found).collect()] == [("own", [1], 255)]
    for bad in (text.replace("7: oil", "7: unheard"), text.replace("id: 1", "id: 4"), text.replace("expresses: [oil], ", "")):
        path.write_text(bad)
        with pytest.raises(SchemaError):
            read_sources(path)


def test_search_clauses(spark):
    q = catalogue.Search(start="2024-01-01", end="2024-01-31", bbox=(72, 18, 73.5, 19.5))
    text = q.odata()
    assert text.startswith("Collection/Name eq 'SENTINEL-1' and ") and text.count("Value eq ") == 3
    assert "ContentDate/Start gt 2024-01-01" in text and "ContentDate/Start lt 2024-01-31" in text
    assert text.count("72 18") == 2 and "VV&VH" in text


class _Server(BaseHTTPRequestHandler):
    data = bytes(range(256)) * 40

    def do_GET(self):
        if self.path.startswith("/Products"):
            second = "skip" in self.path
            n = 3 if second else 1000
            page = {"value": [{"Id": f"{'b' if second else 'a'}{k}", "Name": "n", "ContentDate": {"Start": "2024"}, "ContentLength": 5, "Online": True, "Attributes": [{"Name": "orbitDirection", "Value": "UP"}]} for k in range(n)]}
            if not second:
                page["@odata.nextLink"] = f"http://127.0.0.1:{self.server.server_port}/Products?skip=1"
            body, status = json.dumps(page).encode(), 200
        elif self.path == "/records/1":
            files = [{"key": f"part/{k}.bin", "size": len(self.data), "links": {"self": f"http://127.0.0.1:{self.server.server_port}/file{k}"}} for k in range(5)]
            body, status = json.dumps({"files": [*files, {"key": "no link", "size": 3, "links": {}}]}).encode(), 200
        elif self.path == "/records/2":
            body, status = b'{"files": []}', 200
        else:
            at = int(self.headers.get("Range", "bytes=0-")[6:-1])
            body, status = self.data[at:], 206 if at else 200
        self.send_response(status)
        self.send_header("Content-Length", str(len(body)))
        self.end_headers()
        self.wfile.write(body)

    def log_message(self, *_):
        pass


@pytest.fixture
def server():
    s = HTTPServer(("127.0.0.1", 0), _Server)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_port}"
    s.shutdown()


def test_catalogue_source_follows_pages(spark, server):
    found = jobs.search(spark, f"{server}/Products", catalogue.Search(), top=1002)
    assert found.count() == 1002 and found.filter("id like 'b%'").count() == 2 and found.first().orbit_direction == "UP"


def test_download_resumes_and_checks(server, tmp_path):
    dest = tmp_path / "x" / "f.bin"
    dest.parent.mkdir()
    dest.with_name("f.bin.part").write_bytes(_Server.data[:1000])
    fetch.download(f"{server}/file", dest, size=len(_Server.data))
    assert dest.read_bytes() == _Server.data
    with pytest.raises(OSError, match="expected"):
        fetch.download(f"{server}/file", tmp_path / "g.bin", size=1, retries=1)
    fetch.write_lock(tmp_path, {"f": {"sha256": fetch.sha256_file(dest)}})
    assert fetch.read_lock(tmp_path)["f"]["sha256"] == fetch.sha256_file(dest)
    now, asked = [0.0], []
    client = fetch.TokenClient(fetch.CatalogueConfig(user="u", password="p"), lambda u, d: asked.append(d) or {"access_token": str(len(asked)), "expires_in": 100}, lambda: now[0])
    assert [client.token(), client.token()] == ["1", "1"]
    now[0] = 75
    assert client.token() == "2"


def test_a_registered_dataset_is_fetched_verified_and_guarded(spark, server, tmp_path):
    registry = {"defaults": {"retries": 1, "backoff_seconds": 0}, "sources": {"one": {"discovery": "zenodo_api", "api": f"{server}/records/1", "licence": "CC"}, "none": {"discovery": "zenodo_api", "api": f"{server}/records/2"}, "hand": {"notes": "write to them"}, "odd": {"discovery": "carrier"}}}
    names = [f"part/{k}.bin" for k in range(5)]
    first = jobs.fetch(spark, registry, "one", str(tmp_path))
    assert first["downloaded"] == names and first["licence"] == "CC" and all((tmp_path / "one" / n).read_bytes() == _Server.data for n in names)
    lock = fetch.read_lock(tmp_path / "one")
    assert sorted(lock) == names and lock[names[0]]["sha256"] == fetch.sha256_file(tmp_path / "one" / names[0]) and lock[names[0]]["size"] == len(_Server.data)
    assert jobs.fetch(spark, registry, "one", str(tmp_path))["verified"] == names
    assert jobs.fetch(spark, registry, "one", str(tmp_path), verify=False)["skipped"] == names
    # One file is gone, one is damaged: the first comes back and is recorded, the second stops the job.
    (tmp_path / "one" / names[1]).unlink()
    (tmp_path / "one" / names[2]).write_bytes(b"x" * len(_Server.data))
    with pytest.raises(OSError, match="part/2.bin.*sha256"):
        jobs.fetch(spark, registry, "one", str(tmp_path))
    assert (tmp_path / "one" / names[1]).read_bytes() == _Server.data
    assert jobs.fetch(spark, registry, "hand", str(tmp_path))["manual_instructions"] == "write to them"
    for name, error in (("none", FileNotFoundError), ("odd", NotImplementedError), ("what", KeyError)):
        with pytest.raises(error):
            jobs.fetch(spark, registry, name, str(tmp_path))
    config = fetch.CatalogueConfig.from_registry({"c": {"catalogue": "http://x", "client_id": "me", "other": 1}}, "c")
    assert (config.catalogue, config.client_id, config.token_url) == ("http://x", "me", "") and fetch.CatalogueConfig.from_registry({}, "c").client_id == "public"
    assert jobs.disk(jobs.remote_listing(spark, registry["sources"]["one"]["api"]), 10**9).first().total_bytes == 5 * len(_Server.data)


def test_windowed_counts_of_a_stream(spark, tmp_path):
    from tarn.streaming.append import windowed_counts

    spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(F.col("ts").cast("timestamp").alias("ts"), "event_type").write.parquet(str(tmp_path / "ev"))
    stream = windowed_counts(spark.readStream.schema("ts timestamp, event_type string").parquet(str(tmp_path / "ev")), "ts", "event_type")
    q = stream.writeStream.format("memory").queryName("counts").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("counts").agg(F.sum("n")).first()[0] == spark.read.parquet(str(tmp_path / "ev")).count()


def test_pages_that_share_a_path_stay_apart(spark, tmp_path):
    """Page numbers of six digits are cut to five in a stem, as in the oracle."""
    import duckdb

    from tarn import queries

    pages = spark.range(99_990, 100_080).unionByName(spark.range(9_995, 10_010)).select(F.col("id").alias("page_id"))
    pages.coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    for name in ("pair_by_stem", "missing_pair_guard"):
        got = queries.QUERIES[name](spark, str(tmp_path))
        want = con.sql(queries.ORACLES[name])
        assert got.columns == want.columns
        assert sorted(map(tuple, got.collect()), key=str) == sorted(want.fetchall(), key=str)
