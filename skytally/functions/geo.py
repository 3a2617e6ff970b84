"""Distances and points as Column expressions.

Arguments are columns, column names or plain numbers. Latitude always comes before
longitude in the arguments; a GeoJSON point stores longitude first.
"""

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Mean Earth radius, and semi-major axis and flattening of WGS84.
EARTH_RADIUS_M = 6371008.8
WGS84_AXIS_M = 6378137.0
WGS84_FLATTENING = 1 / 298.257223563

# The default home point.
HOME_LAT = 29.75959
HOME_LON = -95.80341


def _col(value):
    if isinstance(value, Column):
        return value
    return F.col(value) if isinstance(value, str) else F.lit(float(value))


def _central_angle(lat1, lon1, lat2, lon2):
    """Angle between two points on a sphere, all in radians (haversine)."""
    half_lat = F.sin((lat2 - lat1) / 2)
    half_lon = F.sin((lon2 - lon1) / 2)
    h = half_lat * half_lat + F.cos(lat1) * F.cos(lat2) * half_lon * half_lon
    # Rounding may take h past 1 for antipodes. Not least(): it passes over a null.
    return F.when(h >= 1, F.lit(math.pi)).otherwise(2 * F.asin(F.sqrt(h)))


def st_distance(lat1, lon1, lat2, lon2, model="sphere"):
    """Metres between two points; null when any coordinate is null.

    ``model='wgs84'`` uses Lambert's formula on reduced latitudes, within a few
    millionths of the geodesic for distances short of the antipode. ``model='geodesic'`` is
    within a millimetre of it everywhere, at the price of a loop of fixed length for each batch of rows.
    """
    if model == "geodesic":
        return _geodesic(*(_col(v) for v in (lat1, lon1, lat2, lon2)))
    lat1, lon1, lat2, lon2 = (F.radians(_col(v)) for v in (lat1, lon1, lat2, lon2))
    if model == "sphere":
        return F.lit(EARTH_RADIUS_M) * _central_angle(lat1, lon1, lat2, lon2)
    if model != "wgs84":
        raise ValueError(f"unknown distance model {model!r}")
    squash = F.lit(1 - WGS84_FLATTENING)
    beta1, beta2 = (F.atan(squash * F.tan(lat)) for lat in (lat1, lat2))
    sigma = _central_angle(beta1, lon1, beta2, lon2)
    p, q = (beta1 + beta2) / 2, (beta2 - beta1) / 2
    x = (sigma - F.sin(sigma)) * F.pow(F.sin(p) * F.cos(q) / F.cos(sigma / 2), F.lit(2.0))
    y = (sigma + F.sin(sigma)) * F.pow(F.cos(p) * F.sin(q) / F.sin(sigma / 2), F.lit(2.0))
    metres = F.lit(WGS84_AXIS_M) * (sigma - F.lit(WGS84_FLATTENING / 2) * (x + y))
    return F.when(sigma == 0, F.lit(0.0)).otherwise(metres)


_HALVINGS = 56


def _geodesic(lat1, lon1, lat2, lon2):
    """The shortest way on the ellipsoid, found by the azimuth it starts with.

    The points are mirrored so that the first is the farther one from the equator, south of it,
    and the second lies to the east. The longitude that a way reaches then rises with its azimuth
    from north, so halving the range of azimuths finds the way, also to the antipode, where the
    usual iteration on the longitude does not converge. Longitude and length come from the series
    of Vincenty (1975), exact to a fraction of a millimetre. Batches of rows are halved together.
    """
    turn = F.abs(F.pmod(F.radians(lon2) - F.radians(lon1) + math.pi, F.lit(2 * math.pi)) - math.pi)
    swap = F.abs(lat2) > F.abs(lat1)
    first, second = F.when(swap, lat2).otherwise(lat1), F.when(swap, lat1).otherwise(lat2)
    sign = F.when(first > 0, -1.0).otherwise(1.0)

    def reduced(lat):
        return F.atan((1 - F.lit(WGS84_FLATTENING)) * F.tan(F.radians(lat * sign)))

    # Never quite on the equator or at a pole, where azimuths lose their meaning.
    edge = math.pi / 2 - 1e-12
    low = F.greatest(F.least(reduced(first), F.lit(-1e-14)), F.lit(-edge))
    high = F.greatest(F.least(reduced(second), F.lit(edge)), F.lit(-edge))
    # Along the equator the way is the equator, as far as it is the shortest.
    level = (lat1 == 0) & (lat2 == 0) & (turn <= (1 - WGS84_FLATTENING) * math.pi)
    same = (lat1 == lat2) & (turn == 0)
    known = lat1.isNotNull() & lat2.isNotNull() & lon1.isNotNull() & lon2.isNotNull()
    found = _geodesic_length()(turn, low, high)
    distance = F.when(same, F.lit(0.0)).when(level, WGS84_AXIS_M * turn).otherwise(found)
    return F.when(known, distance)


def _geodesic_length():
    """The length of ways, from their turn and the reduced latitudes of their ends. The function
    is made in here so that it goes to workers whole, which need not have this package."""
    flat, halvings = WGS84_FLATTENING, _HALVINGS
    axis = WGS84_AXIS_M * (1 - flat)
    square = (WGS84_AXIS_M**2 - axis**2) / axis**2

    def way(s1, c1, s2, c2, azimuth):
        """What starts in some directions come to at the second points' latitudes."""
        sin0, north = np.sin(azimuth) * c1, np.cos(azimuth) * c1
        south = np.sqrt(np.maximum(north * north + (c2 - c1) * (c2 + c1), 0.0))
        arc1, arc2 = np.arctan2(s1, north), np.arctan2(s2, south)
        ahead = np.arctan2(sin0 * np.sin(arc2), np.cos(arc2)) - np.arctan2(sin0 * np.sin(arc1), np.cos(arc1))
        return sin0, 1 - sin0 * sin0, arc2 - arc1, np.cos(arc1 + arc2), ahead

    def reached(sin0, cos2, arc, middle, ahead):
        c = flat / 16 * cos2 * (4 + flat * (4 - 3 * cos2))
        bent = middle + c * np.cos(arc) * (2 * middle * middle - 1)
        return ahead - (1 - c) * flat * sin0 * (arc + c * np.sin(arc) * bent)

    def length(_, cos2, arc, m, __):
        u = cos2 * square
        a = 1 + u / 16384 * (4096 + u * (-768 + u * (320 - 175 * u)))
        b = u / 1024 * (256 + u * (-128 + u * (74 - 47 * u)))
        inner = np.cos(arc) * (2 * m * m - 1)
        inner = inner - b / 6 * m * (4 * np.sin(arc) * np.sin(arc) - 3) * (4 * m * m - 3)
        return axis * a * (arc - b * np.sin(arc) * (m + b / 4 * inner))

    @F.pandas_udf("double")
    def lengths(turn: pd.Series, first: pd.Series, second: pd.Series) -> pd.Series:
        turn = turn.to_numpy(float)
        ends = [f(x.to_numpy(float)) for x in (first, second) for f in (np.sin, np.cos)]
        low, high = np.zeros(len(turn)), np.full(len(turn), np.pi)
        for _ in range(halvings):
            middle = (low + high) / 2
            beyond = reached(*way(*ends, middle)) >= turn
            low, high = np.where(beyond, low, middle), np.where(beyond, middle, high)
        return pd.Series(length(*way(*ends, (low + high) / 2)))

    return lengths


def create_point(lat, lon):
    """A plain position, latitude first."""
    return F.struct(_col(lat).alias("lat"), _col(lon).alias("lon"))


def st_distance_points(p, q, model="sphere"):
    """Distance between two positions made by :func:`create_point`."""
    return st_distance(p["lat"], p["lon"], q["lat"], q["lon"], model=model)


def geojson_point(lat, lon):
    """A GeoJSON point: coordinates are [longitude, latitude]."""
    return F.struct(
        F.lit("Point").alias("type"), F.array(_col(lon), _col(lat)).alias("coordinates")
    )


def st_distance_point(lat, lon, location="location", model="sphere"):
    """Distance from a position to a GeoJSON point column; null location gives null."""
    coordinates = _col(location)["coordinates"]
    return st_distance(
        lat, lon, F.get(coordinates, F.lit(1)), F.get(coordinates, F.lit(0)), model=model
    )


def bounding_box(lat0, lon0, radius, lat="lat", lon="lon", model="sphere"):
    """A cheap condition that holds for every point within ``radius`` of a position.

    It only compares columns with literals, so a Parquet scan can skip row groups by
    it. None when no such box exists: round a pole or across the date line.
    """
    reach = radius * (1.01 if model == "wgs84" else 1.0) / EARTH_RADIUS_M
    if reach < 0 or abs(math.radians(lat0)) + reach >= math.pi / 2:
        return None
    d_lat = math.degrees(reach) + 1e-6
    d_lon = math.degrees(math.asin(math.sin(reach) / math.cos(math.radians(lat0)))) + 1e-6
    if lon0 - d_lon < -180 or lon0 + d_lon > 180:
        return None
    return F.col(lat).between(lat0 - d_lat, lat0 + d_lat) & F.col(lon).between(
        lon0 - d_lon, lon0 + d_lon
    )
