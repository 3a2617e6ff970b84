"""Reports over the per-flight rollup and the flight log."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytally.functions.geo import HOME_LAT, HOME_LON, st_distance_point
from skytally.functions.text import round_metres
from skytally.functions.timeconv import to_datetime
from skytally.operators.aggregates import CLOSEST
from skytally.operators.filters import time_after, time_between, within_radius


def seen_within_radius(spotter: DataFrame, radius=1000) -> DataFrame:
    """Flights that came within ``radius``, last seen first."""
    near = within_radius(spotter, radius, CLOSEST)
    return near.orderBy(F.desc("last_seen"), "id").select(
        "id", CLOSEST, F.timestamp_micros(F.round(F.col("last_seen") * 1e6).cast("bigint")).alias("last_seen")
    )


def _rounded(spotter):
    return spotter.select(
        "id", round_metres(CLOSEST).alias(CLOSEST), to_datetime("last_seen").alias("last_seen_utc")
    )


def closest_10(spotter: DataFrame, radius=1000, k=10) -> DataFrame:
    """The ``k`` flights that came nearest; ties go by id."""
    near = within_radius(spotter, radius, CLOSEST)
    return _rounded(near.orderBy(CLOSEST, "id").limit(k))


def within_100m(spotter: DataFrame, radius=100) -> DataFrame:
    """Flights that came within ``radius``, nearest first."""
    return _rounded(within_radius(spotter, radius, CLOSEST).orderBy(CLOSEST, "id"))


def flight_log(flights: DataFrame, lat=HOME_LAT, lon=HOME_LON) -> DataFrame:
    """Every sighting with its time and distance, oldest first."""
    distance = round_metres(st_distance_point(lat, lon))
    return flights.orderBy("Timestamp", "flight", "id").select(
        "flight",
        to_datetime("Timestamp").alias("Timestamp"),
        distance.alias("distanceInMetresFromMyLocation"),
    )


def recent_flights(flights: DataFrame, as_of, lookback: int, until: int | None = None) -> DataFrame:
    """Documents of the last ``lookback`` seconds before ``as_of`` (epoch seconds).

    With ``until`` the last ``until`` seconds are left out again.
    """
    if until is None:
        return time_after(flights, as_of - lookback)
    return time_between(flights, as_of - lookback, as_of - until)
