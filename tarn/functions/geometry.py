"""Rings, boxes and cells as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

POINT = "struct<x double, y double>"


def _points(text: Column, between: str) -> Column:
    """`x y, x y` text to an array of points."""
    return F.transform(F.split(F.trim(text), r"\s*,\s*"), lambda p: F.struct(*[F.split(F.trim(p), between)[k].cast("double").alias(n) for k, n in enumerate("xy")]))


def wkt_rings(wkt: Column) -> Column:
    """All rings of a POLYGON or MULTIPOLYGON text, in order; other heads are errors."""
    rings = F.transform(F.regexp_extract_all(wkt, F.lit(r"\(([^()]+)\)"), F.lit(1)), lambda r: _points(r, r"\s+"))
    return F.when(F.upper(F.split(wkt, r"\(")[0]).contains("POLYGON"), rings).otherwise(F.raise_error(F.concat(F.lit("not a polygon: "), wkt)))


def bbox_ring(xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    """The four corners of a box."""
    corner = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    return F.array(corner(xmin, ymin), corner(xmax, ymin), corner(xmax, ymax), corner(xmin, ymax))


def geojson_rings(geometry_type: Column, geometry_json: Column) -> Column:
    """Rings of a Polygon or MultiPolygon (flattened) geometry given as JSON text; other types are errors."""
    to_points = lambda rings: F.transform(rings, lambda r: F.transform(r, lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))))
    one = F.from_json(geometry_json, "coordinates array<array<array<double>>>")["coordinates"]
    many = F.from_json(geometry_json, "coordinates array<array<array<array<double>>>>")["coordinates"]
    return F.when(geometry_type == "Polygon", to_points(one)).when(geometry_type == "MultiPolygon", to_points(F.flatten(many))).otherwise(F.raise_error(F.concat(F.lit("unsupported geometry: "), geometry_type)))


def to_pixel(x: Column, y: Column, transform: Column) -> Column:
    """(column, row) under a north-up geotransform (x0, dx, 0, y0, 0, dy); rotated ones are errors."""
    rotated = (transform[2] != 0) | (transform[4] != 0)
    return F.when(rotated, F.raise_error(F.lit("rotated geotransform"))).otherwise(F.struct(((x - transform[0]) / transform[1]).alias("x"), ((y - transform[3]) / transform[5]).alias("y")))


def closed_ring(west: Column, south: Column, east: Column, north: Column) -> Column:
    """A box as a closed five-point polygon literal in SRID 4326."""
    corners = [F.concat_ws(" ", x, y) for x, y in ((west, south), (east, south), (east, north), (west, north), (west, south))]
    return F.concat(F.lit("geography'SRID=4326;POLYGON(("), F.concat_ws(",", *corners), F.lit("))'"))


def closed_ring_wkt(west: float, south: float, east: float, north: float) -> str:
    """A box as a closed five-point polygon literal in SRID 4326."""
    corners = [(west, south), (east, south), (east, north), (west, north), (west, south)]
    return "geography'SRID=4326;POLYGON((" + ",".join(f"{x} {y}" for x, y in corners) + "))'"


def cell(lon: Column, lat: Column, degrees: float) -> Column:
    """Grid cell of a position: floors towards minus infinity, joined by a bar."""
    return F.concat_ws("|", F.floor(lon / degrees), F.floor(lat / degrees))


def inside_rings(x: Column, y: Column, rings: Column) -> Column:
    """Even-odd test of a pixel centre against each ring; true if any ring holds it."""

    def crossings(ring):
        n = F.size(ring)
        after = lambda i: F.element_at(ring, (i % n) + 1)
        edges = F.sequence(F.lit(1), n)

        def crosses(i):
            a, b = F.element_at(ring, i), after(i)
            spans = (a["y"] > y) != (b["y"] > y)
            return spans & (x < F.when(spans, (b["x"] - a["x"]) * F.try_divide(y - a["y"], b["y"] - a["y"]) + a["x"]))

        return F.size(F.filter(edges, lambda i: F.coalesce(crosses(i), F.lit(False)))) % 2 == 1

    return F.exists(rings, crossings)
