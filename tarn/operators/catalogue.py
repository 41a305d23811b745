"""Remote catalogues and downloads as tables: predicates, product summaries, file listings and fetch plans."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarn.functions.geometry import closed_ring_wkt


@dataclass(frozen=True)
class Search:
    """A catalogue query; both time bounds are strict."""

    collection: str = "SENTINEL-1"
    product_type: str | None = "GRD"
    sensor_mode: str | None = "IW"
    polarisation: str | None = "VV&VH"
    start: str | None = None
    end: str | None = None
    bbox: tuple[float, float, float, float] | None = None

    def odata(self) -> str:
        """The conjunction as an OData filter."""
        attribute = lambda name, value: f"Attributes/OData.CSC.StringAttribute/any(att:att/Name eq '{name}' and att/OData.CSC.StringAttribute/Value eq '{value}')"
        parts = [f"Collection/Name eq '{self.collection}'"]
        parts += [attribute(n, v) for n, v in (("productType", self.product_type), ("operationalMode", self.sensor_mode), ("polarisationChannels", self.polarisation)) if v]
        parts += [f"ContentDate/Start {op} {t}" for op, t in (("gt", self.start), ("lt", self.end)) if t]
        if self.bbox:
            parts.append(f"OData.CSC.Intersects(area={closed_ring_wkt(*self.bbox)})")
        return " and ".join(parts)

    def condition(self, start: Column, lon: Column | None = None, lat: Column | None = None, attributes: Column | None = None) -> Column:
        """The same conjunction on a table: attributes is a map; a position stands for the footprint."""
        out = F.lit(True)
        if self.start:
            out = out & (start > F.lit(self.start).cast("timestamp_ntz"))
        if self.end:
            out = out & (start < F.lit(self.end).cast("timestamp_ntz"))
        if self.bbox and lon is not None and lat is not None:
            west, south, east, north = self.bbox
            out = out & lon.between(west, east) & lat.between(south, north)
        if attributes is not None:
            for name, value in (("productType", self.product_type), ("operationalMode", self.sensor_mode), ("polarisationChannels", self.polarisation)):
                if value:
                    out = out & (F.try_element_at(attributes, F.lit(name)) == value)
        return out


def most_recent(products: DataFrame, top: int, start: str = "start", key: str = "id") -> DataFrame:
    """Top-k by start, newest first, ties by key."""
    return products.orderBy(F.desc(start), key).limit(top)


def attribute_map(attributes: Column) -> Column:
    """array<struct<Name,Value>> to a map in which the last of equal names wins."""
    names = F.transform(attributes, lambda a: a["Name"])
    last = F.filter(attributes, lambda a, i: ~F.array_contains(F.slice(names, i + 2, F.greatest(F.size(names) - i - 1, F.lit(0))), a["Name"]))
    return F.map_from_entries(last)


def summarise_products(products: DataFrame) -> DataFrame:
    """id, name, start, size_gb, orbit_direction, relative_orbit, polarisation, online of OData records."""
    a = attribute_map(F.col("Attributes"))
    value = lambda n: F.try_element_at(a, F.lit(n))
    return products.select(
        F.col("Id").alias("id"), F.col("Name").alias("name"), F.col("ContentDate.Start").alias("start"), F.round(F.col("ContentLength") / 1e9, 3).alias("size_gb"),
        value("orbitDirection").alias("orbit_direction"), value("relativeOrbitNumber").alias("relative_orbit"), value("polarisationChannels").alias("polarisation"), F.col("Online").alias("online"),
    )


LISTING = "files array<struct<key:string,size:bigint,links:struct<self:string,download:string>>>"


def remote_files(listings: DataFrame, body: str = "body") -> DataFrame:
    """(relpath, url, size) of JSON file listings; files without a link are skipped."""
    files = listings.select(F.explode(F.from_json(body, LISTING)["files"]).alias("f"))
    url = F.coalesce(F.nullif(F.col("f.links.self"), F.lit("")), F.nullif(F.col("f.links.download"), F.lit("")))
    return files.select(F.col("f.key").alias("relpath"), url.alias("url"), F.col("f.size").alias("size")).filter("url is not null")


def fetch_plan(files: DataFrame, lock: DataFrame, verify: bool = True) -> DataFrame:
    """files with `action`: download what the lock lacks or has with another size, verify (or skip) the rest."""
    held = lock.select("relpath", F.col("size").alias("_locked"), F.lit(True).alias("_have"))
    same = F.col("_have") & F.coalesce(F.col("size") == F.col("_locked"), F.col("size").isNull())
    return files.join(held, "relpath", "left").withColumn("action", F.when(F.coalesce(same, F.lit(False)), "verify" if verify else "skip").otherwise("download")).drop("_locked", "_have")


def disk_estimate(files: DataFrame) -> DataFrame:
    return files.agg(F.count("*").alias("n_files"), F.coalesce(F.sum(F.coalesce("size", F.lit(0))), F.lit(0)).alias("total_bytes")).withColumn("total_gb", F.round(F.col("total_bytes") / 1e9, 2))


def checksums(files: DataFrame, content: str = "content", path: str = "path") -> DataFrame:
    return files.select(F.col(path).alias("path"), F.sha2(F.col(content), 256).alias("sha256"))
