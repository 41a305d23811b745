"""Raster operators: native forms on flat array columns or long pixels, the feature stack, and scene checks."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarn.functions.physics import GATE, INCIDENCE, verdict
from tarn.model import CHANNELS, SchemaError
from tarn.operators import kernels
from tarn.operators.kernels import on_arrays, on_scenes

VV_NAMES = ("vv_db", "vv_render_norm", "vv")
VH_NAMES = ("vh_db", "vh")


def pixels(df: DataFrame, key: str, values: str, width: int, *keep: str) -> DataFrame:
    """Long form (key, row, col, v) of a flat array column: one row for each pixel, no shuffle."""
    out = df.select(key, *keep, F.posexplode(values).alias("_i", "_v"))
    return out.select(key, *keep, F.floor(F.col("_i") / width).cast("int").alias("row"), (F.col("_i") % width).cast("int").alias("col"), F.col("_v").cast("double").alias("v"))


def incidence_at(position: Column, extent: Column | int, near: float = INCIDENCE[0], far: float = INCIDENCE[1]) -> Column:
    """Incidence at a row or column: linear from near to far range."""
    return near + (far - near) * position / ((extent if isinstance(extent, Column) else F.lit(extent)) - 1)


def box_mean_native(values: Column, height: int, width: int, size: int) -> Column:
    """Boxcar mean of a flat array column with higher-order functions: one pass over clamped positions."""
    before = size // 2
    clamp = lambda i, n: F.greatest(F.lit(0), F.least(i, F.lit(n - 1)))
    offsets = F.sequence(F.lit(0), F.lit(size * size - 1))

    def mean(i):
        row, col = F.floor(i / width).cast("int"), i % width
        place = lambda d: clamp(row + F.floor(d / size).cast("int") - before, height) * width + clamp(col + d % size - before, width)
        return F.aggregate(offsets, F.lit(0.0), lambda acc, d: acc + F.get(values, place(d)).cast("double")) / (size * size)

    return F.transform(F.sequence(F.lit(0), F.lit(height * width - 1)), mean)


def block_means(df: DataFrame, keys: list[str], height: int, width: int, block: int) -> DataFrame:
    """Per block of long pixels the mean, ragged edges weighted as if their last row and column were repeated."""
    weight = lambda at, n: F.when(F.col(at) == n - 1, F.lit(1 + (-n % block))).otherwise(F.lit(1))
    w = weight("row", height) * weight("col", width)
    return df.groupBy(*keys, F.floor(F.col("row") / block).alias("block_row"), F.floor(F.col("col") / block).alias("block_col")).agg((F.sum(F.col("v") * w) / F.sum(w)).alias("mean"))


def multilook(values: Column, height, width, size: int = 5) -> Column:
    return on_arrays(lambda x: kernels.box_mean(x, size), values, height, width)


def rank_filter(values: Column, height, width, size: int = 5, percentile: float = 85.0) -> Column:
    return on_arrays(lambda x: kernels.rank_filter(x, size, percentile), values, height, width)


def background_sigma0(values: Column, height, width, block: int = 64, percentile: float = 85.0, neighbourhood: int = 5) -> Column:
    return on_arrays(lambda x: kernels.background_sigma0(x, block, percentile, neighbourhood), values, height, width)


def damping_ratio(vv_db: Column, height, width, block: int = 64, **options) -> Column:
    return on_arrays(lambda x: kernels.damping_db(x, block, **options), vv_db, height, width)


def local_variance(vv_db: Column, height, width, size: int = 7) -> Column:
    return on_arrays(lambda x: kernels.local_variance_db(x, size), vv_db, height, width)


def no_incidence() -> Column:
    return F.lit(None).cast("array<float>")


def wind_channel(vv_db: Column, height, width, block: int | None = 64, phi: float = 45.0, incidence: Column | None = None) -> Column:
    """Wind of the background level at each pixel's incidence (the scene's own, clipped to the valid domain, or the ramp); block None: by the scene's size."""
    own = no_incidence() if incidence is None else incidence
    return on_scenes(lambda x, angle: kernels.wind_ms(x, angle, phi, block or kernels.adaptive_block(*x.shape[1:])), vv_db, own, height, width)


def distance_to_land(land: Column, height, width, pixel_metres: float = 10.0) -> Column:
    """land: array of 0 and 1."""
    return on_arrays(lambda x: kernels.distance_to_land_km(x > 0, pixel_metres), land, height, width)


def band(names: Column, bands: Column, wanted: tuple[str, ...]) -> Column:
    """The first present of the wanted bands."""
    by_name = F.map_from_arrays(names, bands)
    return F.coalesce(*[F.try_element_at(by_name, F.lit(n)) for n in wanted])


def scene_incidence(incidence: Column, height: Column, width: Column) -> Column:
    """Each pixel's incidence: the scene's own, or the ramp along its columns."""
    every = F.sequence(F.lit(0), height * width - 1)
    ramp = F.transform(every, lambda i: incidence_at(i % width, width))
    own = F.when(F.size(incidence) == 1, F.transform(every, lambda i: F.get(incidence, F.lit(0)).cast("double"))).otherwise(incidence.cast("array<double>"))
    return F.when(incidence.isNull(), ramp).otherwise(own)


def feature_stack(
    df: DataFrame, channels: tuple[str, ...] | None = None, vv: str = "vv_db", vh: str | None = None, land: str | None = None, block: int | None = None,
    phi: float = 45.0, pixel_metres: float = 10.0, incidence: str | None = None, wind: str | None = None,
) -> DataFrame:
    """df with a column for each requested channel; each is its own expression, so unselected ones are never computed.

    df has height and width; incidence: the scenes' own, where they have one; wind: a column that already holds that channel. Where an input is null in a row, so is
    the channel. Unknown channels and known ones without their input are different errors."""
    have = {"vv_db": True, "vh_db": vh is not None, "incidence_deg": True, "wind_ms": True, "damping_db": True, "local_var_db": True, "dist_land_km": land is not None}
    wanted = channels or tuple(c for c in CHANNELS if have[c])
    if unknown := [c for c in wanted if c not in CHANNELS]:
        raise SchemaError(f"unknown channels {unknown}; known: {CHANNELS}")
    if absent := [c for c in wanted if not have[c]]:
        raise SchemaError(f"channels {absent} need inputs that were not given")
    h, w, x = F.col("height"), F.col("width"), F.col(vv)
    size = (lambda s: block) if block else (lambda s: kernels.adaptive_block(*s.shape[1:]))
    own = no_incidence() if incidence is None else F.col(incidence)
    made = {
        "vv_db": lambda: x.cast("array<double>"),
        "vh_db": lambda: F.col(vh).cast("array<double>"),
        "incidence_deg": lambda: F.when(x.isNotNull(), scene_incidence(own, h, w)),
        "wind_ms": lambda: F.col(wind) if wind else wind_channel(x, h, w, block, phi, own),
        "damping_db": lambda: on_arrays(lambda s: kernels.damping_db(s, size(s)), x, h, w),
        "local_var_db": lambda: local_variance(x, h, w),
        "dist_land_km": lambda: distance_to_land(F.col(land), h, w, pixel_metres),
    }
    return df.select(*df.columns, *[made[c]().cast("array<float>").alias(f"ch_{c}") for c in wanted])


def field_summary(field: Column, phi: float = 45.0) -> list[Column]:
    """What `physics.wind_summary` says of a scene's winds, from the scene's own array in one pass over it: no exchange, no row for each pixel."""

    @F.pandas_udf("wind_ms_mean double, wind_ms_min double, wind_ms_max double, wind_ms_scene double, wind_fraction_observable double")
    def run(fields: pd.Series) -> pd.DataFrame:
        rows = []
        for own in fields:
            known = np.asarray([] if own is None else own, dtype=float)
            known = known[~np.isnan(known)]
            inside = ((known >= GATE[0]) & (known <= GATE[1])).mean() if len(known) else 0.0
            rows.append((*((known.mean(), known.min(), known.max(), np.median(known)) if len(known) else (None,) * 4), inside))
        return pd.DataFrame(rows, columns=["wind_ms_mean", "wind_ms_min", "wind_ms_max", "wind_ms_scene", "wind_fraction_observable"], dtype=float)

    found = run(field)
    names = ("wind_ms_mean", "wind_ms_min", "wind_ms_max", "wind_ms_scene", "wind_fraction_observable")
    out = {n: F.nanvl(found[n], F.lit(None).cast("double")) for n in names} | {"observability": verdict(found["wind_fraction_observable"])}
    return [*[F.when(field.isNotNull(), c).alias(n) for n, c in out.items()], F.when(field.isNotNull(), F.lit(float(phi))).alias("wind_phi_assumed_deg")]


def problems() -> Column:
    """The structural rules that a scene breaks, by name."""
    n = F.col("height") * F.col("width")
    bad = {
        "no pixels": F.coalesce(n, F.lit(0)) <= 0,
        "bands and band_names differ in number": F.size("bands") != F.size("band_names"),
        "a band has another shape": F.exists("bands", lambda b: F.size(b) != n),
        "the mask has another shape": F.coalesce(F.size("mask"), F.lit(-1)) != n,
        "mask values outside 0..255": F.exists("mask", lambda m: m.isNull() | (m < 0) | (m > 255)),
        "the incidence has another shape": F.col("incidence").isNotNull() & ~F.size("incidence").isin(1) & (F.size("incidence") != n),
    }
    return F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in bad.items()]))


def scene_violations(scenes: DataFrame) -> DataFrame:
    """(sample_id, problem) for each broken structural rule of a scene; an empty frame is a valid set."""
    return scenes.select("sample_id", F.explode(problems()).alias("problem"))
