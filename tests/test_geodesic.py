"""The geodesic model against an independent solution: the direct problem, integrated."""

import math
import random
import time

from pyspark.sql import functions as F

from skytally.functions.geo import WGS84_AXIS_M as A
from skytally.functions.geo import WGS84_FLATTENING as FLAT
from skytally.functions.geo import st_distance

E2 = FLAT * (2 - FLAT)


def direct(lat, lon, azimuth, metres, steps=400):
    """Follow a geodesic by its differential equations (Runge-Kutta); not the series used.

    In three dimensions: on the ellipsoid the acceleration is along the normal, which has no
    trouble at poles."""
    b = A * (1 - FLAT)

    def normal(p):
        return (p[0] / A**2, p[1] / A**2, p[2] / b**2)

    def acceleration(p, v):
        n = normal(p)
        bend = v[0] ** 2 / A**2 + v[1] ** 2 / A**2 + v[2] ** 2 / b**2
        scale = -bend / sum(x * x for x in n)
        return tuple(scale * x for x in n)

    phi, lam = math.radians(lat), math.radians(lon)
    n = A / math.sqrt(1 - E2 * math.sin(phi) ** 2)
    p = (n * math.cos(phi) * math.cos(lam), n * math.cos(phi) * math.sin(lam), n * (1 - E2) * math.sin(phi))
    east = (-math.sin(lam), math.cos(lam), 0.0)
    north = (-math.sin(phi) * math.cos(lam), -math.sin(phi) * math.sin(lam), math.cos(phi))
    v = tuple(math.sin(azimuth) * e + math.cos(azimuth) * k for e, k in zip(east, north))
    h = metres / steps
    add = lambda x, y, s: tuple(a + s * c for a, c in zip(x, y))
    for _ in range(steps):
        a1 = acceleration(p, v)
        p2, v2 = add(p, v, h / 2), add(v, a1, h / 2)
        a2 = acceleration(p2, v2)
        p3, v3 = add(p, v2, h / 2), add(v, a2, h / 2)
        a3 = acceleration(p3, v3)
        p4, v4 = add(p, v3, h), add(v, a3, h)
        a4 = acceleration(p4, v4)
        p = tuple(x + h / 6 * (q + 2 * r + 2 * s + t) for x, q, r, s, t in zip(p, v, v2, v3, v4))
        v = tuple(x + h / 6 * (q + 2 * r + 2 * s + t) for x, q, r, s, t in zip(v, a1, a2, a3, a4))
    out = math.atan2(p[2], (1 - E2) * math.hypot(p[0], p[1]))
    return math.degrees(out), math.degrees(math.atan2(p[1], p[0]))


def measured(spark, pairs):
    frame = spark.createDataFrame(pairs, "a double, b double, c double, d double")
    found = frame.select("*", st_distance("a", "b", "c", "d", model="geodesic").alias("m")).collect()
    return {(r.a, r.b, r.c, r.d): r.m for r in found}


def test_random_pairs(spark):
    """A geodesic shorter than half the least circumference is the shortest way, apart from
    ends near the antipode; those are looked at below."""
    draw = random.Random(4)
    expected = {}
    for _ in range(1000):
        lat, lon = math.degrees(math.asin(draw.uniform(-1, 1))), draw.uniform(-180, 180)
        metres = draw.uniform(0, 1.97e7)
        expected[(lat, lon, *direct(lat, lon, draw.uniform(-math.pi, math.pi), metres))] = metres
    found = measured(spark, list(expected))
    assert max(abs(found[k] - m) for k, m in expected.items()) < 1e-3


def meridian():
    """Half a meridian, by Simpson's rule on its curvature."""
    n = 2000
    f = [(1 - E2) * A / (1 - E2 * math.sin(math.pi * i / n) ** 2) ** 1.5 for i in range(n + 1)]
    return math.pi / n / 3 * (f[0] + f[-1] + 4 * sum(f[1:-1:2]) + 2 * sum(f[2:-1:2]))


def test_antipodes_and_poles(spark):
    half = meridian()
    pairs = [(0.0, 0.0, 0.0, 180.0), (90.0, 0.0, -90.0, 50.0), (30.0, 10.0, -30.0, -170.0), (-12.5, 179.0, 12.5, -1.0)]
    found = measured(spark, pairs)
    assert all(abs(m - half) < 1e-3 for m in found.values())
    assert measured(spark, [(90.0, 3.0, 90.0, 99.0)]).popitem()[1] < 1e-3


def test_near_the_antipode(spark):
    """Ends of ways that stop short of where they cease to be shortest, a few hundred metres to
    a few hundred kilometres from the antipode: no way found may be longer, and one that starts
    along the meridian is exact."""
    draw = random.Random(9)
    expected = {}
    for _ in range(300):
        lat, lon = draw.uniform(-80, 80), draw.uniform(-180, 180)
        metres = draw.uniform(1.97e7, 2.0e7)
        expected[(lat, lon, *direct(lat, lon, draw.uniform(-math.pi, math.pi), metres, 800))] = metres
    found = measured(spark, list(expected))
    assert all(found[k] <= m + 1e-3 for k, m in expected.items())
    short = [(k, m) for k, m in expected.items() if m < 1.99e7]
    assert sum(abs(found[k] - m) < 1e-3 for k, m in short) >= 0.9 * len(short)
    back = {(c, d, a, b): m for (a, b, c, d), m in found.items()}
    assert max(abs(m - back[k]) for k, m in measured(spark, list(back)).items()) < 1e-3


def test_equator_same_points_and_nulls(spark):
    pairs = [(0.0, 0.0, 0.0, 90.0), (0.0, 170.0, 0.0, -170.0), (5.0, 6.0, 5.0, 6.0)]
    found = measured(spark, pairs)
    assert [round(found[p], 6) for p in pairs] == [
        round(A * math.pi / 2, 6), round(A * math.radians(20), 6), 0.0,
    ]
    none = measured(spark, [(None, 0.0, 1.0, 2.0), (1.0, 2.0, 3.0, None)])
    assert set(none.values()) == {None}
    near = measured(spark, [(10.0, 20.0, 10.0, 20.00001)]).popitem()[1]
    assert abs(near - 1.09639) < 1e-3


def test_agrees_with_the_short_series(spark):
    frame = spark.createDataFrame([(29.76, -95.8, 29.9, -95.1), (51.5, 0.0, 40.7, -74.0)], "a double, b double, c double, d double")
    both = frame.select(*[st_distance(*"abcd", model=m).alias(m) for m in ("wgs84", "geodesic")])
    for row in both.collect():
        assert abs(row.wgs84 - row.geodesic) < 1e-5 * row.geodesic


def test_many_rows_in_one_task(spark):
    """40,000 rows took a task most of a minute when each had a loop of its own."""
    rows = spark.range(40_000, numPartitions=1).select((F.col("id") % 179 - 89.0).alias("a"), (F.col("id") % 359 - 179.0).alias("b"))
    metres = st_distance(12.0, 34.0, "a", "b", model="geodesic")
    start = time.monotonic()
    assert rows.where(metres.between(0, 2.01e7)).count() == 40_000
    assert time.monotonic() - start < 20
