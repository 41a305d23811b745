"""Backscatter and wind as Column expressions: decibels, the CMOD5.N model and its inverse, the observability gate."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarn.model import SchemaError

FLOOR = 1e-12
INCIDENCE = (29.1, 46.0)
SPEED = (0.2, 30.0)
#: What rounding may add to an incidence at the edge.
MARGIN = 1e-9
ITERATIONS = 40
GATE = (3.0, 10.0)

# Coefficients c1 to c28 of the published CMOD5.N geophysical model function.
C = [
    -0.6878, -0.7957, 0.3380, -0.1728, 0.0000, 0.0040, 0.1103, 0.0159, 6.7329, 2.7713, -2.2885, 0.4971, -0.7250, 0.0450,
    0.0066, 0.3222, 0.0120, 22.7000, 2.0813, 3.0000, 8.3659, -3.3428, 1.3236, 6.2437, 2.3893, 0.3249, 4.1590, 1.6930,
]


def _poly(x, *coefficients):
    """Horner's rule for Columns and arrays alike."""
    return reduce(lambda acc, c: acc * x + c, reversed(coefficients))


def db_to_linear(x: Column) -> Column:
    return F.pow(F.lit(10.0), x / 10)


def linear_to_db(x: Column, floor: float = FLOOR) -> Column:
    return 10 * F.log10(F.greatest(x, F.lit(floor)))


class _Columns:
    """The few functions that the model needs, on Columns."""

    exp, tanh, cos = staticmethod(F.exp), staticmethod(F.tanh), staticmethod(F.cos)
    pow = staticmethod(F.pow)
    radians = staticmethod(F.radians)

    @staticmethod
    def where(test, yes, no):
        return F.when(test, yes).otherwise(no)


class _Arrays:
    """The same on numpy arrays."""

    exp, tanh, cos, pow, radians = np.exp, np.tanh, np.cos, np.power, np.radians
    where = staticmethod(np.where)


def _model(m, v, phi, theta):
    x = (theta - 40.0) / 25.0
    logistic = lambda z: 1.0 / (1.0 + m.exp(-z))
    # Isotropic term, with a power law below the knee s0.
    a0, a1, a2 = _poly(x, *C[0:4]), _poly(x, *C[4:6]), _poly(x, *C[6:8])
    gamma, s0 = _poly(x, *C[8:11]), _poly(x, *C[11:13])
    s = a2 * v
    at_knee = logistic(s0)
    a3 = m.where(s < s0, at_knee * m.pow(s / s0, s0 * (1.0 - at_knee)), logistic(s))
    b0 = m.pow(a3, gamma) * m.pow(10.0, a0 + a1 * v)
    # Upwind/downwind term.
    b1 = (C[13] * (1.0 + x) - C[14] * v * (0.5 + x - m.tanh(4.0 * (x + C[15] + C[16] * v)))) / (m.exp(0.34 * (v - C[17])) + 1.0)
    # Upwind/crosswind term, with a smooth start.
    y0, n = C[18], C[19]
    a, b = y0 - (y0 - 1.0) / n, 1.0 / (n * (y0 - 1.0) ** (n - 1.0))
    w = v / _poly(x, *C[20:23]) + 1.0
    w = m.where(w < y0, a + b * m.pow(w - 1.0, n), w)
    b2 = (_poly(x, *C[26:28]) * w - _poly(x, *C[23:26])) * m.exp(-w)
    angle = m.radians(phi)
    return b0 * m.pow(1.0 + b1 * m.cos(angle) + b2 * m.cos(2.0 * angle), 1.6)


def cmod5n_forward(speed: Column, phi: Column, incidence: Column) -> Column:
    """sigma0 (linear) for a wind speed, a relative direction and an incidence angle, as one expression inside code generation."""
    return _model(_Columns, speed.cast("double"), phi.cast("double"), incidence.cast("double"))


def forward_array(speed: np.ndarray, phi: np.ndarray, incidence: np.ndarray) -> np.ndarray:
    with np.errstate(all="ignore"):
        return _model(_Arrays, *(np.asarray(a, dtype=np.float64) for a in (speed, phi, incidence)))


def check_domain(incidence: np.ndarray, high: float = SPEED[1]) -> None:
    """Raise where halving isn't valid: a speed bound over 30 m/s, or a finite incidence outside INCIDENCE."""
    if high > SPEED[1]:
        raise SchemaError(f"the inverse is not unique above {SPEED[1]} m/s, asked for {high}")
    outside = np.isfinite(incidence) & ((incidence < INCIDENCE[0] - MARGIN) | (incidence > INCIDENCE[1] + MARGIN))
    if outside.any():
        raise SchemaError(f"incidence {float(incidence[outside][0]):.2f} is outside {INCIDENCE}; clip it, or pass strict=False")


def inverse_array(sigma0: np.ndarray, incidence: np.ndarray, phi: np.ndarray | float = 45.0, low: float = SPEED[0], high: float = SPEED[1], iterations: int = ITERATIONS, strict: bool = True) -> np.ndarray:
    """Wind speed by a fixed number of halvings of [low, high]; out-of-range values end at a bound, missing ones stay missing."""
    sigma0, incidence, phi = np.broadcast_arrays(*(np.asarray(a, dtype=np.float64) for a in (sigma0, incidence, phi)))
    if strict:
        check_domain(incidence, high)
    lo, hi = np.full(sigma0.shape, low), np.full(sigma0.shape, high)
    for _ in range(iterations):
        middle = 0.5 * (lo + hi)
        below = forward_array(middle, phi, incidence) < sigma0
        lo, hi = np.where(below, middle, lo), np.where(below, hi, middle)
    return np.where(np.isnan(sigma0) | np.isnan(incidence) | np.isnan(phi), np.nan, 0.5 * (lo + hi))


def wind_speed_from_sigma0(sigma0: Column, incidence: Column, phi: Column | float = 45.0, strict: bool = True) -> Column:
    """The inverse model: an Arrow kernel that halves whole batches at once; null where an input is missing.

    strict: an incidence outside the valid domain fails the query (`domain_violations` lists such rows)."""

    @F.pandas_udf(T.DoubleType())
    def inverse(sigma0: pd.Series, incidence: pd.Series, phi: pd.Series) -> pd.Series:
        return pd.Series(inverse_array(sigma0.to_numpy(float), incidence.to_numpy(float), phi.to_numpy(float), strict=strict))

    phi = phi if isinstance(phi, Column) else F.lit(float(phi))
    return F.nullif(inverse(sigma0.cast("double"), incidence.cast("double"), phi.cast("double")), F.lit(float("nan")))


def wind_speed_native(sigma0: Column, incidence: Column, phi: Column | float = 45.0) -> Column:
    """The same inversion with higher-order functions only; slower, kept as a cross-check."""
    phi = phi if isinstance(phi, Column) else F.lit(float(phi))

    def step(acc, _):
        middle = 0.5 * (acc["lo"] + acc["hi"])
        below = cmod5n_forward(middle, phi, incidence) < sigma0
        return F.struct(F.when(below, middle).otherwise(acc["lo"]).alias("lo"), F.when(below, acc["hi"]).otherwise(middle).alias("hi"))

    start = F.struct(F.lit(SPEED[0]).alias("lo"), F.lit(SPEED[1]).alias("hi"))
    found = F.aggregate(F.sequence(F.lit(1), F.lit(ITERATIONS)), start, step, lambda acc: 0.5 * (acc["lo"] + acc["hi"]))
    return F.when(sigma0.isNotNull() & incidence.isNotNull(), found)


def domain_violations(df: DataFrame, incidence: str, highest_speed: float = SPEED[1]) -> DataFrame:
    """Rows on which a strict inversion fails: finite incidence beyond INCIDENCE; all rows if the speed bound exceeds 30."""
    angle = F.col(incidence)
    outside = angle.isNotNull() & ~F.isnan(angle) & ~angle.between(*INCIDENCE)
    return df.filter(outside | F.lit(highest_speed > SPEED[1]))


def finite_positive(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (x > 0) & (x < float("inf"))


def background_wind(df: DataFrame, keys: list[str], sigma0: str, incidence: str, phi: float = 45.0, percentile: float = 90.0) -> DataFrame:
    """Per key: the wind of the linearly interpolated percentile of finite positive sigma0 at the mean known incidence; null without any."""
    angle = F.nullif(F.col(incidence).cast("double"), F.lit(float("nan")))
    level = F.percentile(F.when(finite_positive(F.col(sigma0)), F.col(sigma0)), percentile / 100)
    levels = df.groupBy(*keys).agg(level.alias("sigma0_background"), F.avg(angle).alias("incidence_mean"))
    return levels.withColumn("background_wind_ms", wind_speed_from_sigma0(F.col("sigma0_background"), F.col("incidence_mean"), phi))


def direction_sensitivity(df: DataFrame, sigma0: str, incidence: str, step: int = 10) -> DataFrame:
    """df with wind_low and wind_high: the extremes of the wind over relative directions 0, step, ... below 360."""
    turns = np.arange(0, 360, step, dtype=float)

    @F.pandas_udf("struct<wind_low double, wind_high double>")
    def extremes(s: pd.Series, t: pd.Series) -> pd.DataFrame:
        wind = inverse_array(s.to_numpy(float)[:, None], t.to_numpy(float)[:, None], turns[None, :])
        return pd.DataFrame({"wind_low": wind.min(axis=1), "wind_high": wind.max(axis=1)})

    return df.withColumn("_w", extremes(F.col(sigma0).cast("double"), F.col(incidence).cast("double"))).select(*df.columns, "_w.wind_low", "_w.wind_high")


def gate(wind: Column, low: float = GATE[0], high: float = GATE[1]) -> Column:
    """Inside the detection band, bounds included; false for missing wind."""
    return F.coalesce(~F.isnan(wind) & wind.between(low, high), F.lit(False))


def fraction_observable(wind: Column, low: float = GATE[0], high: float = GATE[1]) -> Column:
    """Aggregate: share of the finite winds inside the band, 0 without any."""
    finite = wind.isNotNull() & ~F.isnan(wind) & (F.abs(wind) < float("inf"))
    return F.coalesce(F.try_divide(F.count_if(gate(wind, low, high)).cast("double"), F.count_if(finite).cast("double")), F.lit(0.0))


def verdict(fraction: Column, least: float = 0.5) -> Column:
    return F.when(fraction >= least, "observable").when(fraction > 0, "marginal").otherwise("not_observable")


def wind_summary(df: DataFrame, keys: list[str], wind: str, phi: float = 45.0) -> DataFrame:
    """Per key: mean, extremes and median of the known winds, the observable fraction, the verdict and the assumed direction."""
    w = F.nullif(F.col(wind), F.lit(float("nan")))
    out = df.groupBy(*keys).agg(F.avg(w).alias("wind_ms_mean"), F.min(w).alias("wind_ms_min"), F.max(w).alias("wind_ms_max"), F.median(w).alias("wind_ms_scene"), fraction_observable(F.col(wind)).alias("wind_fraction_observable"))
    return out.withColumn("observability", verdict(F.col("wind_fraction_observable"))).withColumn("wind_phi_assumed_deg", F.lit(float(phi)))
