"""The live path in batch form: one set of snapshots, three tables."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytally.functions.geo import HOME_LAT, HOME_LON, create_point, st_distance_points
from skytally.functions.timeconv import event_time
from skytally.operators.aggregates import nearby_windows, window_parts
from skytally.operators.flatten import DISTANCE, all_flights, close_aircraft, with_event_time
from skytally.session import drop_scratch, scratch_dir
from skytally.sinks.tables import write_aircraft, write_flights, write_nearby
from skytally.sources.snapshots import usable


def nearby(
    snapshots: DataFrame, duration="3 minutes", radius=1000, home_lat=HOME_LAT, home_lon=HOME_LON
) -> DataFrame:
    """Nearby windows straight from snapshots; on a stream, time them first."""
    timed = snapshots if "event_ts" in snapshots.columns else with_event_time(snapshots)
    sightings = all_flights(timed, home_lat, home_lon)
    return nearby_windows(close_aircraft(sightings, radius, home_lat, home_lon), duration)


def nearby_parts(
    snapshots: DataFrame, duration="3 minutes", radius=1000, home_lat=HOME_LAT, home_lon=HOME_LON
) -> DataFrame:
    """What some snapshots add to the nearby windows, with the ``date`` each window ends on."""
    sightings = all_flights(with_event_time(snapshots), home_lat, home_lon)
    parts = window_parts(close_aircraft(sightings, radius, home_lat, home_lon), duration)
    return parts.withColumn("date", F.to_date("LastSeen"))


def repaired_nearby(
    windows: DataFrame,
    aircraft: DataFrame,
    days: Callable[[Column], Column],
    duration="3 minutes",
    radius=1000,
    home_lat=HOME_LAT,
    home_lon=HOME_LON,
) -> DataFrame:
    """Stored windows, those that end on some days counted anew from the stored sightings.

    ``days`` is a condition on a date, e.g. ``lambda day: day == "2024-01-10"``. A window may
    begin on the day before, so the sightings of that day are read as well.
    """
    day = F.to_date(F.timestamp_seconds("RowKey"))
    some = aircraft.where(days(day) | days(F.date_add(day, 1)))
    home = create_point(home_lat, home_lon)
    timed = some.withColumns(
        {
            "event_ts": event_time("RowKey"),
            DISTANCE: st_distance_points(home, create_point("lat", "lon")),
        }
    )
    counted = nearby_windows(close_aircraft(timed, radius, home_lat, home_lon), duration)
    ends = F.to_date("LastSeen")
    return windows.where(~days(ends)).unionByName(
        counted.where(days(ends)).select(*windows.columns)
    )


def fan_out(snapshots: DataFrame, aircraft: str, near: str, flights: str, **home) -> None:
    """Write all three tables from a batch of snapshots; unusable ones are left out.

    The snapshots are parsed and flattened once, into a scratch table all three are made of.
    """
    spark = snapshots.sparkSession
    staged = scratch_dir(spark, "sightings")
    timed = all_flights(with_event_time(usable(snapshots)), **home)
    timed.write.parquet(staged)
    timed = spark.read.schema(timed.schema).parquet(staged)
    write_aircraft(timed, aircraft)
    write_flights(timed, flights)
    write_nearby(nearby_windows(close_aircraft(timed, 1000, **home), "3 minutes"), near)
    drop_scratch(spark, staged)
