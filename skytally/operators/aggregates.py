"""Per-flight aggregates, distinct flights and counters.

All use count, min, max or distinct, which combine before the shuffle: a flight with
most of the rows sends one partial row per task.
"""

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from skytally.functions.geo import HOME_LAT, HOME_LON, st_distance_point
from skytally.operators.filters import distance_eq, flight_eq, time_eq
from skytally.operators.flatten import const_columns, rename_keys

CLOSEST = "closestDistanceInMetresFromMyLocation"


def flight_rollup(
    flights: DataFrame, lat=HOME_LAT, lon=HOME_LON, model="sphere", by=()
) -> DataFrame:
    """Per flight: how often seen, when last, and the closest approach to a position.

    A document without a point counts, but has no distance. ``by`` names more columns
    to keep groups apart by.
    """
    return flights.groupBy(F.col("flight").alias("id"), *by).agg(
        F.count("flight").alias("count"),
        F.max("Timestamp").cast("double").alias("last_seen"),
        F.min(st_distance_point(lat, lon, model=model)).alias(CLOSEST),
    )


def flight_rollup_one(flights: DataFrame, flight, lat=HOME_LAT, lon=HOME_LON) -> DataFrame:
    return flight_rollup(flight_eq(flights, flight), lat, lon)


def first_at_distance(
    flights: DataFrame, flight, metres, lat=HOME_LAT, lon=HOME_LON, tol=0.0
) -> DataFrame:
    """First time, altitude and place at which a flight was ``metres`` from a position."""
    there = distance_eq(flight_eq(flights, flight), lat, lon, metres, tol)
    return (
        there.groupBy("flight", "alt_geom", F.col("location").alias("Location"))
        .agg(F.min("Timestamp").alias("TimeStamp"))
        .select("flight", "TimeStamp", "alt_geom", "Location")
    )


def distinct_flights(flights: DataFrame) -> DataFrame:
    """Every flight once, with zeros for the figures a rollup fills in."""
    ids = rename_keys(flights.select("flight").distinct(), {"flight": "id"})
    return const_columns(
        ids, {"count": (0, "bigint"), "last_seen": (0, "double"), CLOSEST: (0, "double")}
    )


def distinct_flights_at(flights: DataFrame, moment) -> DataFrame:
    """Every flight seen at one instant, once."""
    return time_eq(flights, moment).select("flight").distinct()


def window_parts(close: DataFrame, duration="3 minutes") -> DataFrame:
    """Distance of the closest approach, not rounded, and count per flight and tumbling window,
    in batch or on a stream. Those of several batches add up to those of all.

    A window leaves out its start and takes in its end. Event times have whole
    microseconds, so that is a start-inclusive window moved by one microsecond.
    FirstSeen and LastSeen are the bounds of the window.
    """
    tick = F.expr("INTERVAL 1 MICROSECOND")
    span = F.window("event_ts", duration, startTime="1 microsecond")
    return (
        close.groupBy("flight", span)
        .agg(
            F.min("distanceInMetresFromHome").alias("nearest"),
            F.count(F.lit(1)).alias("RecordCount"),
        )
        .select(
            "flight",
            (F.col("window.start") - tick).alias("FirstSeen"),
            (F.col("window.end") - tick).alias("LastSeen"),
            "nearest",
            "RecordCount",
        )
    )


def nearby_windows(close: DataFrame, duration="3 minutes") -> DataFrame:
    """Closest approach in whole metres and count per flight and window: :func:`window_parts`."""
    return window_parts(close, duration).select(
        "flight",
        "FirstSeen",
        "LastSeen",
        F.round("nearest", 0).alias("closestDistanceInMetresFromHome"),
        "RecordCount",
    )


def flight_metric(flights: DataFrame, key="flight") -> DataFrame:
    """How many documents were handled, per flight or by another key."""
    return flights.groupBy(key).count()


def batch_size_metric(rows: DataFrame, name="fetched") -> tuple[DataFrame, Observation]:
    """The rows, and an observation that knows their number once they were used."""
    seen = Observation(name)
    return rows.observe(seen, F.count(F.lit(1)).alias("rows")), seen
