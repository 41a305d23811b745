import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarn.functions import physics
from tarn.model import SchemaError


def scalar(v, phi, theta):
    """The published formula, one number at a time."""
    x = (theta - 40) / 25
    a0 = -0.6878 - 0.7957 * x + 0.3380 * x * x - 0.1728 * x**3
    a1, a2 = 0.0040 * x, 0.1103 + 0.0159 * x
    g, s0 = 6.7329 + 2.7713 * x - 2.2885 * x * x, 0.4971 - 0.7250 * x
    s, sig = a2 * v, lambda z: 1 / (1 + math.exp(-z))
    a3 = sig(s0) * (s / s0) ** (s0 * (1 - sig(s0))) if s < s0 else sig(s)
    b0 = a3**g * 10 ** (a0 + a1 * v)
    b1 = (0.0450 * (1 + x) - 0.0066 * v * (0.5 + x - math.tanh(4 * (x + 0.3222 + 0.0120 * v)))) / (math.exp(0.34 * (v - 22.7)) + 1)
    w = v / (8.3659 - 3.3428 * x + 1.3236 * x * x) + 1
    if w < 2.0813:
        w = 2.0813 - 1.0813 / 3 + (w - 1) ** 3 / (3 * 1.0813**2)
    b2 = (-(6.2437 + 2.3893 * x + 0.3249 * x * x) + (4.1590 + 1.6930 * x) * w) * math.exp(-w)
    c = math.cos(math.radians(phi))
    return b0 * (1 + b1 * c + b2 * (2 * c * c - 1)) ** 1.6


GRID = [(v, p, t) for t in (17, 22, 29.1, 33, 38, 41, 46, 50) for v in (0.2, 0.5, 1, 2, 3, 5, 7.5, 10, 15, 20, 30, 45, 50) for p in (0, 30, 45, 90, 135, 180, 250, 359)]


def test_forward_equals_scalar_on_the_grid(spark):
    want = np.array([scalar(*g) for g in GRID])
    assert np.allclose(physics.forward_array(*np.array(GRID).T), want, rtol=1e-12, atol=1e-15)
    df = spark.createDataFrame([(i, *map(float, g)) for i, g in enumerate(GRID)], "i int, v double, p double, t double")
    got = [r.s for r in df.select("i", physics.cmod5n_forward(F.col("v"), F.col("p"), F.col("t")).alias("s")).orderBy("i").collect()]
    assert np.allclose(got, want, rtol=1e-12, atol=1e-15)
    assert abs(scalar(7, 45, 35) - 0.0304392216) < 1e-9


def test_monotone_in_the_valid_domain_and_turnover():
    v = np.linspace(0.2, 30, 2000)
    t, p = np.linspace(29.1, 46, 25)[:, None, None], np.arange(0, 360, 5)[None, :, None]
    assert (np.diff(physics.forward_array(v[None, None, :], p, t), axis=2) > 0).all()
    wide = np.linspace(20, 50, 3001)
    assert 31 < wide[physics.forward_array(wide, 0.0, 29.1).argmax()] < 33


def test_round_trip_clamps_and_missing(spark):
    for v in (0.3, 1, 4, 7, 12, 18, 25, 29.5):
        for t in (29.1, 35, 41, 46):
            for p in (0, 45, 90, 180):
                assert abs(float(physics.inverse_array(scalar(v, p, t), t, p)) - v) < 1e-6
    df = spark.createDataFrame([(1e-12, 35.0), (1e6, 35.0), (scalar(7, 45, 35), 35.0), (None, 35.0)], "s double, t double")
    for f in (physics.wind_speed_from_sigma0, physics.wind_speed_native):
        got = [r.w for r in df.select(f(F.col("s"), F.col("t")).alias("w")).collect()]
        assert got[3] is None and np.allclose(got[:3], [0.2, 30, 7], atol=1e-6)


def test_gate_and_verdict(spark):
    df = spark.createDataFrame([(3.0,), (10.0,), (2.9,), (float("nan"),), (None,)], "w double")
    r = df.agg(F.count_if(physics.gate(F.col("w"))).alias("n"), physics.fraction_observable(F.col("w")).alias("f")).first()
    assert (r.n, r.f) == (2, pytest.approx(2 / 3))
    assert df.limit(0).agg(physics.fraction_observable(F.col("w")).alias("f")).first().f == 0
    got = spark.createDataFrame([(0.5,), (0.1,), (0.0,)], "f double").select(physics.verdict(F.col("f")).alias("v"))
    assert [r.v for r in got.collect()] == ["observable", "marginal", "not_observable"]


def test_direction_ambiguity_and_domain(spark):
    df = spark.createDataFrame([(scalar(7, 45, 35), 35.0)], "s double, t double")
    r = physics.direction_sensitivity(df, "s", "t").first()
    assert r.wind_high - r.wind_low > 1 and r.wind_low <= 7 <= r.wind_high
    rows = spark.createDataFrame([(29.0,), (29.1,), (46.0,), (46.1,), (float("nan"),)], "t double")
    assert sorted(x.t for x in physics.domain_violations(rows, "t").collect()) == [29.0, 46.1]
    assert physics.domain_violations(rows, "t", 31.0).count() == 5


def test_background_wind_is_robust_to_a_slick(spark):
    rng = np.random.default_rng(0)
    s = np.full(2000, scalar(7, 45, 35))
    s[rng.random(2000) < 0.08] *= 10**-0.8
    df = spark.createDataFrame([("a", float(x), 35.0) for x in s] + [("b", -1.0, 35.0), ("b", None, None)], "k string, s double, t double")
    got = {r.k: r.background_wind_ms for r in physics.background_wind(df, ["k"], "s", "t").collect()}
    assert abs(got["a"] - 7) < 0.05 and got["b"] is None


def test_strict_inversion_refuses_what_it_cannot_do(spark):
    good = physics.inverse_array(np.array([0.05]), np.array([35.0]))
    assert np.allclose(physics.inverse_array(np.array([0.05, 0.05]), np.array([35.0, np.nan]))[0], good)
    for incidence, high in ((20.0, 30.0), (46.5, 30.0), (35.0, 40.0)):
        with pytest.raises(SchemaError):
            physics.inverse_array(np.array([0.05]), np.array([incidence]), high=high)
        physics.inverse_array(np.array([0.05]), np.array([incidence]), high=high, strict=False)
    rows = spark.createDataFrame([(0.05, 20.0)], "s double, t double")
    with pytest.raises(Exception, match="outside"):
        rows.select(physics.wind_speed_from_sigma0(F.col("s"), F.col("t"))).collect()
    assert rows.select(physics.wind_speed_from_sigma0(F.col("s"), F.col("t"), strict=False)).count() == 1
