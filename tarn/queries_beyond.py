"""Registered queries of operators beyond the manifest: objects, positions and passes. Registered by tarn.queries."""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from tarn.model import MANIFEST, TileSpec
from tarn.operators import evaluation, manifest, objects, positions, tiling
from tarn.queries import M, _records, _t, query
from tarn.scratch import cut, shared_dir
from tarn.sources import store
from tarn.sources.codecs import read_image


def _object_parts(spark, sf):
    """8 x 8 scenes of oil where a component is positive, in overlapping tiles of 4 x 4."""
    spec = TileSpec(size=4, overlap=1)
    oil = F.transform("embedding", lambda v: F.when(v > 0, 1).otherwise(0).cast("smallint"))
    scenes = _t(spark, sf, "embeddings").select(F.col("vec_id").cast("string").alias("sample_id"), F.lit(8).alias("height"), F.lit(8).alias("width"), oil.alias("mask"), F.array().cast("array<array<float>>").alias("bands"))
    return tiling.tile_masks(scenes, spec), spec


_OBJECTS = """WITH RECURSIVE px AS MATERIALIZED (SELECT vec_id, i AS p FROM (SELECT vec_id, unnest(range(64)) AS i, unnest(embedding) AS v FROM embeddings) WHERE v > 0),
e AS MATERIALIZED (SELECT a.vec_id, a.p AS a, b.p AS b FROM px a JOIN px b ON a.vec_id = b.vec_id AND (abs(a.p - b.p) = 8 OR (abs(a.p - b.p) = 1 AND a.p // 8 = b.p // 8))),
r AS (SELECT vec_id, p AS a, p AS b FROM px UNION SELECT r.vec_id, r.a, e.b FROM r JOIN e ON r.vec_id = e.vec_id AND r.b = e.a),
o AS MATERIALIZED (SELECT vec_id, a AS p, min(b) AS object_id FROM r GROUP BY vec_id, a),
n AS (SELECT vec_id, a AS p, count(*) AS n FROM e GROUP BY vec_id, a)
SELECT CAST(o.vec_id AS VARCHAR) AS sample_id, CAST(object_id AS BIGINT) AS object_id, CAST(count(*) AS BIGINT) AS area, CAST(min(p % 8) AS INTEGER) AS x_min, CAST(min(p // 8) AS INTEGER) AS y_min,
       CAST(max(p % 8) AS INTEGER) AS x_max, CAST(max(p // 8) AS INTEGER) AS y_max, round(avg(p % 8) + 0.5, 9) AS centroid_x, round(avg(p // 8) + 0.5, 9) AS centroid_y,
       CAST(sum(4 - coalesce(n, 0)) AS BIGINT) AS perimeter, CAST(count(*) AS BIGINT) AS ring_area,
       round(4 * sqrt(greatest((var_pop(p % 8) + var_pop(p // 8) + 1.0 / 6) / 2 + sqrt(power((var_pop(p % 8) - var_pop(p // 8)) / 2, 2) + power(covar_pop(p % 8, p // 8), 2)), 0)), 6) AS major_axis
FROM o LEFT JOIN n USING (vec_id, p) GROUP BY o.vec_id, object_id"""


@query(_OBJECTS)
def scene_objects(spark, sf):
    """Objects over tiles; the area inside the traced rings (holes are negative) must be the number of pixels."""
    tiles, spec = _object_parts(spark, sf)
    found = objects.vectorise(tiles, spec, [1])
    ahead = lambda r: F.concat(F.slice(r, 2, F.size(r)), F.slice(r, 1, 1))
    twice = lambda r: F.aggregate(F.zip_with(r, ahead(r), lambda p, q: (p["x"] * q["y"] - q["x"] * p["y"]).cast("long")), F.lit(0).cast("long"), lambda a, b: a + b)
    inside = F.aggregate(F.transform("rings", twice), F.lit(0).cast("long"), lambda a, b: a + b)
    return found.select(
        "sample_id", "object_id", "area", "x_min", "y_min", "x_max", "y_max", F.round("centroid_x", 9).alias("centroid_x"), F.round("centroid_y", 9).alias("centroid_y"),
        "perimeter", (inside / 2).cast("long").alias("ring_area"), F.round("major_axis", 6).alias("major_axis"),
    )


@query(f"""WITH {M}, n AS (SELECT source, tile_id, n_px_oil + 1 AS n_px_oil FROM t WHERE source = 'A' AND "row" = 1), o AS (SELECT source, tile_id, n_px_oil FROM t WHERE source <> 'A')
SELECT source, n_px_oil * 2 AS n_px_oil, count(*) AS n, count(DISTINCT tile_id) AS n_tiles FROM (SELECT * FROM n UNION ALL SELECT * FROM o) GROUP BY ALL""")
def rebuilt_source(spark, sf):
    """A manifest on disk: built, one source built again, a broken rebuild refused, then all rows changed in place."""
    table = store.manifest_table(spark, f"{shared_dir(spark)}/rebuilt-{uuid.uuid4().hex}")
    records = _records(spark, sf)
    table.replace(records, whole=True)
    again = records.filter("source = 'A' AND row = 1").withColumn("n_px_oil", F.col("n_px_oil") + 1)
    table.replace(again)

    def refuse(rows):
        raise ValueError("broken")

    try:
        table.replace(records.filter("source = 'N'").limit(0), whole=True, check=refuse)
    except ValueError:
        pass
    table.update(lambda rows: rows.withColumn("n_px_oil", F.col("n_px_oil") * 2), MANIFEST)
    return table.read(MANIFEST).groupBy("source", "n_px_oil").agg(F.count("*").alias("n"), F.countDistinct("tile_id").alias("n_tiles"))


_POSITION = "user_id AS vessel, epoch(ts) AS time, (user_id % 40) * 0.5 - 180 + (event_id % 100) * 0.01 AS lon, (user_id % 15) * 4 + 28 + (event_id % 77) * 0.01 AS lat"
_HAVERSINE = "2 * 6371008.8 * asin(least(1.0, sqrt(power(sin(radians(p.lat - d.lat) / 2), 2) + cos(radians(d.lat)) * cos(radians(p.lat)) * power(sin(radians(p.lon - d.lon) / 2), 2))))"


def _tracks(spark, sf):
    """Events as positions of vessels, along the 180th meridian and up to high latitudes."""
    e, k = F.col("event_id"), F.col("user_id")
    return _t(spark, sf, "events").select(e, "event_type", k.alias("vessel"), F.unix_micros(F.col("ts").cast("timestamp")).cast("double").alias("us"), ((k % 40) * 0.5 - 180 + (e % 100) * 0.01).alias("lon"), ((k % 15) * 4 + 28 + (e % 77) * 0.01).alias("lat")).withColumn("time", F.col("us") / 1e6).drop("us")


@query(f"""WITH p AS (SELECT event_id AS position, {_POSITION} FROM events), d AS (SELECT event_id AS detection, epoch(ts) + 900 AS time, CASE WHEN p.lon < -179.97 THEN p.lon + 359.96 ELSE p.lon - 0.03 END AS lon, p.lat + 0.01 AS lat FROM (SELECT event_id, ts, {_POSITION} FROM events WHERE event_type = 'error') p)
SELECT detection, position, round({_HAVERSINE}, 3) AS metres_apart, round(abs(d.time - p.time), 3) AS seconds_apart FROM d JOIN p ON abs(d.time - p.time) <= 43200 WHERE {_HAVERSINE} <= 15000""")
def positions_near_detections(spark, sf):
    rows = _tracks(spark, sf)
    shifted = F.when(F.col("lon") < -179.97, F.col("lon") + 359.96).otherwise(F.col("lon") - 0.03)
    detections = rows.filter("event_type = 'error'").select(F.col("event_id").alias("detection"), (F.col("time") + 900).alias("time"), shifted.alias("lon"), (F.col("lat") + 0.01).alias("lat"))
    found = positions.near(detections, rows.select(F.col("event_id").alias("position"), "time", "lon", "lat"), 15_000, 43_200, tile=positions.TILE)
    return found.select("detection", "position", F.round("metres_apart", 3).alias("metres_apart"), F.round("seconds_apart", 3).alias("seconds_apart"))


@query(f"""WITH p AS (SELECT vessel, time, max(lon) AS lon, max(lat) AS lat FROM (SELECT {_POSITION} FROM events) GROUP BY vessel, time HAVING count(*) = 1), w AS (SELECT event_id, user_id AS vessel, epoch(ts) + 3600 * (event_id % 30) AS time FROM events WHERE event_id % 3 = 0),
a AS (SELECT w.*, p.time AS ta, p.lon AS lona, p.lat AS lata FROM w ASOF LEFT JOIN p ON w.vessel = p.vessel AND w.time >= p.time),
b AS (SELECT a.*, p.time AS tb, p.lon AS lonb, p.lat AS latb FROM a ASOF LEFT JOIN p ON a.vessel = p.vessel AND a.time < p.time),
c AS (SELECT *, CASE WHEN ta = time THEN 0.0 ELSE tb - ta END AS gap, CASE WHEN ta = time THEN 0.0 ELSE (time - ta) / (tb - ta) END AS share, (((lonb - lona + 540) % 360) + 360) % 360 - 180 AS turn FROM b)
SELECT event_id, vessel, round(gap, 3) AS gap, CASE WHEN gap <= 172800 THEN round(CASE WHEN ta = time THEN lona ELSE ((lona + share * turn + 180) % 360 + 360) % 360 - 180 END, 6) END AS lon, CASE WHEN gap <= 172800 THEN round(CASE WHEN ta = time THEN lata ELSE lata + share * (latb - lata) END, 6) END AS lat FROM c""")
def track_positions_at_times(spark, sf):
    rows = _tracks(spark, sf)
    wanted = rows.filter("event_id % 3 = 0").select("event_id", "vessel", (F.col("time") + 3600 * (F.col("event_id") % 30)).alias("time"))
    found = positions.at_times(rows.select("vessel", "time", "lon", "lat"), wanted, longest_gap=172_800)
    return found.select("event_id", "vessel", F.round("gap", 3).alias("gap"), F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"))


@query("""WITH p AS (SELECT DISTINCT user_id % 40 AS cell, event_id * 7919 % 70000 AS pass_no, event_type = 'error' AS hit FROM events)
SELECT cell, CAST(count(DISTINCT pass_no) AS BIGINT) AS n_passes, CAST(count(DISTINCT CASE WHEN hit THEN pass_no END) AS BIGINT) AS n_hits, round(count(DISTINCT CASE WHEN hit THEN pass_no END) / count(DISTINCT pass_no)::DOUBLE, 9) AS share,
       count(DISTINCT CASE WHEN hit THEN pass_no END) / count(DISTINCT pass_no)::DOUBLE >= 0.3 AS recurrent FROM p GROUP BY cell""")
def archive_recurrence(spark, sf):
    """Bitmaps of an archive with those of late passes merged in."""
    e = F.col("event_id")
    seen = _t(spark, sf, "events").select((F.col("user_id") % 40).alias("cell"), (e * 7919 % 70000).alias("pass_no"), (F.col("event_type") == "error").alias("hit"), (e % 5 == 0).alias("late"))
    both = evaluation.merge_passes(evaluation.passes(seen.filter("not late")), evaluation.passes(seen.filter("late")))
    return evaluation.recurrence(both).withColumn("share", F.round("share", 9))


_SCORED = "SELECT CASE WHEN l_quantity < 15 THEN 'low' WHEN l_quantity < 35 THEN 'fit' ELSE 'high' END AS wind_class, ((l_orderkey * 37 + l_linenumber * 11) % 10007) / 10007.0::DOUBLE AS score, l_returnflag = 'R' AS hit FROM lineitem"


def _scored(spark, sf):
    q = F.col("l_quantity")
    return _t(spark, sf, "lineitem").select(F.when(q < 15, "low").when(q < 35, "fit").otherwise("high").alias("wind_class"), ((F.col("l_orderkey") * 37 + F.col("l_linenumber") * 11) % 10007 / F.lit(10007.0)).alias("score"), (F.col("l_returnflag") == "R").alias("hit"))


@query(f"""WITH s AS (SELECT wind_class, least(floor(score * 1000), 999) / 1000 AS edge, hit FROM ({_SCORED})), t AS (SELECT DISTINCT wind_class, edge FROM s),
k AS (SELECT t.wind_class, t.edge, count(*) FILTER (hit AND s.edge >= t.edge) AS kept, count(*) FILTER (hit) AS total, count(*) FILTER (NOT hit AND s.edge >= t.edge) AS alarms FROM t JOIN s USING (wind_class) GROUP BY ALL)
SELECT wind_class, max(edge) AS threshold, round(arg_max(kept, edge) / arg_max(total, edge)::DOUBLE, 9) AS recall, CAST(arg_max(alarms, edge) AS BIGINT) AS false_alarms, round(1000 * arg_max(alarms, edge) / CASE wind_class WHEN 'low' THEN 1500.0::DOUBLE WHEN 'fit' THEN 4000.0::DOUBLE ELSE 2500.0::DOUBLE END, 6) AS per_1000_km2
FROM k WHERE kept >= 0.8 * total GROUP BY wind_class""")
def false_alarms_at_recall(spark, sf):
    area = spark.createDataFrame([("low", 1500.0), ("fit", 4000.0), ("high", 2500.0)], "wind_class string, km2 double")
    found = evaluation.false_alarms(_scored(spark, sf), area, 0.8)
    return found.select("wind_class", "threshold", F.round("recall", 9).alias("recall"), "false_alarms", F.round("per_1000_km2", 6).alias("per_1000_km2"))


@query(f"""WITH s AS (SELECT round(score, 2) AS x, sum(hit::INTEGER)::DOUBLE AS y, count(*)::DOUBLE AS w FROM ({_SCORED}) GROUP BY 1),
c AS MATERIALIZED (SELECT x, sum(y) OVER (ORDER BY x) AS cy, sum(w) OVER (ORDER BY x) AS cw, y, w FROM s),
a AS (SELECT j.x AS xj, k.x AS xk, (k.cy - j.cy + j.y) / (k.cw - j.cw + j.w) AS mean FROM c j JOIN c k ON j.x <= k.x),
v AS (SELECT c.x, c.w, (SELECT max(m) FROM (SELECT xj, min(mean) AS m FROM a WHERE xj <= c.x AND xk >= c.x GROUP BY xj)) AS value FROM c)
SELECT min(x) AS low, max(x) AS high, round(value, 9) AS value, CAST(sum(w) AS BIGINT) AS weight FROM v GROUP BY round(value, 9)""")
def isotonic_calibration(spark, sf):
    """Against the max-min form: the value at x is the greatest over starts of the least over ends of the means between them."""
    return evaluation.isotonic(_scored(spark, sf), digits=2).withColumn("value", F.round("value", 9))


_BOX = "(l_partkey * 13 % 400) AS x0, (l_partkey * 29 % 300) AS y0, 5 + l_linenumber * 3 AS w, 4 + l_suppkey % 17 AS h"


@query(f"""WITH a AS (SELECT l_orderkey // 150 AS scene, l_orderkey * 10 + l_linenumber AS id, l_returnflag = 'R' AS true_one, {_BOX} FROM lineitem),
p AS (SELECT f.scene, f.id AS found_id, t.id AS true_id, (least(f.x0 + f.w, t.x0 + t.w) - greatest(f.x0, t.x0)) * (least(f.y0 + f.h, t.y0 + t.h) - greatest(f.y0, t.y0)) AS inner_, f.w * f.h + t.w * t.h AS both_
      FROM a f JOIN a t ON f.scene = t.scene AND NOT f.true_one AND t.true_one AND f.x0 < t.x0 + t.w AND t.x0 < f.x0 + f.w AND f.y0 < t.y0 + t.h AND t.y0 < f.y0 + f.h),
s AS (SELECT scene, found_id, true_id, inner_ / (both_ - inner_)::DOUBLE AS iou FROM p)
SELECT scene, found_id, true_id, round(iou, 9) AS iou, CAST(row_number() OVER (PARTITION BY scene, found_id ORDER BY round(iou, 9) DESC, true_id) AS INTEGER) AS rank FROM s WHERE iou >= 0.2""")
def overlap_rank(spark, sf):
    """Boxes as rings: found objects against true ones."""
    e = F.expr
    corner = lambda dx, dy: F.struct((F.col("x0") + dx).cast("double").alias("x"), (F.col("y0") + dy).cast("double").alias("y"))
    rows = _t(spark, sf, "lineitem").select(e("l_orderkey div 150").alias("scene"), e("l_orderkey * 10 + l_linenumber").alias("id"), (F.col("l_returnflag") == "R").alias("t"), e("l_partkey * 13 % 400").alias("x0"), e("l_partkey * 29 % 300").alias("y0"), e("5 + l_linenumber * 3").alias("w"), e("4 + l_suppkey % 17").alias("h"))
    rows = rows.withColumn("ring", F.array(corner(F.lit(0), F.lit(0)), corner(F.col("w"), F.lit(0)), corner(F.col("w"), F.col("h")), corner(F.lit(0), F.col("h"))))
    found = evaluation.overlaps(rows.filter("not t").select("scene", F.col("id").alias("found_id"), "ring"), rows.filter("t").select("scene", F.col("id").alias("true_id"), "ring"), 20.0, 0.2)
    return found.withColumn("iou", F.round("iou", 9))


@query(f"WITH {M} SELECT tile_id, row_number() OVER (ORDER BY tile_id) - 1 AS position FROM t")
def manifest_in_order(spark, sf):
    """Where each row of a built manifest stands: its number in its partition after those of the partitions before."""
    rows = cut(manifest.build_manifest([_records(spark, sf)]).select("tile_id").withColumn("seq", F.monotonically_increasing_id()))
    part = F.shiftright("seq", 33)
    sizes = rows.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    before = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))  # a row for each partition
    placed = rows.withColumn("part", part).join(F.broadcast(before), "part")
    return placed.select("tile_id", (F.col("before") + F.col("seq").bitwiseAND((1 << 33) - 1)).alias("position"))


def _tiff(image: np.ndarray, rows: int) -> bytes:
    """A TIFF of float32, `rows` to a packed strip."""
    strips = [zlib.compress(image[at : at + rows].astype("<f4").tobytes()) for at in range(0, len(image), rows)]
    starts = np.cumsum([8, *map(len, strips)]).tolist()
    lists = struct.pack(f"<{len(strips)}I", *starts[:-1]) + struct.pack(f"<{len(strips)}I", *map(len, strips))
    at, n = starts[-1], len(strips)
    tags = [(256, 1, image.shape[1]), (257, 1, image.shape[0]), (258, 1, 32), (259, 1, 8), (273, n, at), (277, 1, 1), (278, 1, rows), (279, n, at + 4 * n), (339, 1, 3)]
    return struct.pack("<2sHI", b"II", 42, at + 8 * n) + b"".join(strips) + lists + struct.pack("<H", len(tags)) + b"".join(struct.pack("<HHII", k, 4, c, v) for k, c, v in tags) + struct.pack("<I", 0)


@query("""SELECT vec_id, CAST(i // 8 AS INTEGER) AS "row", round(sum(v), 5) AS total, round(arg_max(v, i), 6) AS last FROM (SELECT vec_id, unnest(range(64)) AS i, unnest(embedding)::DOUBLE AS v FROM embeddings) GROUP BY ALL""")
def tiff_rows(spark, sf):
    """Rasters written as TIFF files of packed strips and read again."""

    @F.pandas_udf("binary")
    def written(values: pd.Series) -> pd.Series:
        return values.map(lambda v: _tiff(np.asarray(v).reshape(8, 8), 3))

    @F.pandas_udf("array<struct<total:double,last:double>>")
    def read(files: pd.Series) -> pd.Series:
        images = (read_image(f)[0].astype(float) for f in files)
        return pd.Series([[{"total": line.sum(), "last": line[-1]} for line in image] for image in images])

    lines = _t(spark, sf, "embeddings").select("vec_id", F.posexplode(read(written("embedding"))).alias("row", "line"))
    return lines.select("vec_id", "row", F.round("line.total", 5).alias("total"), F.round("line.last", 6).alias("last"))
