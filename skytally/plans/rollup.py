"""The daily rollup: one pass over the flights instead of one query per flight."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytally.functions.geo import HOME_LAT, HOME_LON
from skytally.operators.aggregates import CLOSEST, flight_rollup
from skytally.operators.upsert import upsert_by_key
from skytally.schemas import DISTINCT_FLIGHT
from skytally.session import drop_scratch, scratch_dir
from skytally.sinks.tables import VersionedTable, read_if_there


def refresh_flight_spotter(
    flights: DataFrame, spotter: DataFrame, lat=HOME_LAT, lon=HOME_LON
) -> DataFrame:
    """The rollup table with the row of every flight now in ``flights`` put in."""
    fresh = flight_rollup(flights, lat, lon)
    return upsert_by_key(spotter, fresh, order=[F.desc("count")])


def publish_flight_spotter(
    flights: DataFrame, table: VersionedTable, lat=HOME_LAT, lon=HOME_LON
) -> int:
    """Refresh the stored rollup and publish it as its next version. Runs at the same time
    lose nothing of each other: the later one builds on the version of the first."""
    return table.update(
        lambda spotter: refresh_flight_spotter(flights, spotter, lat, lon), DISTINCT_FLIGHT
    )


def rollup_by_day(flights: DataFrame, lat=HOME_LAT, lon=HOME_LON) -> DataFrame:
    """The rollup per flight and day, for documents stored by day."""
    return flight_rollup(flights, lat, lon, by=("date",))


def combine_days(days: DataFrame) -> DataFrame:
    """The rollup per flight out of daily ones: counts add up, extremes stay extremes."""
    return days.where("id IS NOT NULL").groupBy("id").agg(
        F.sum("count").alias("count"),
        F.max("last_seen").alias("last_seen"),
        F.min(CLOSEST).alias(CLOSEST),
    )


def refresh_days(
    flights: DataFrame, days: str, which: Column, lat=HOME_LAT, lon=HOME_LON
) -> None:
    """Recompute the stored daily rollups of some days, given as a condition on ``date``.

    The daily job then reads the days that changed instead of all flights, and combines
    the stored days. Doing a day again replaces it. A day that has no documents any more
    is stored as one row without an id, which :func:`combine_days` leaves out.
    """
    spark = flights.sparkSession
    fresh = rollup_by_day(flights.where(which), lat, lon)
    stored = read_if_there(spark, days, T.StructType([*fresh.schema.fields]))
    empty = stored.where(which).select("date").distinct()
    empty = empty.join(fresh.select("date").distinct(), "date", "left_anti")
    fresh = fresh.unionByName(empty, allowMissingColumns=True)
    # Staged, as the days that are overwritten are read for it.
    path = scratch_dir(spark, "days")
    fresh.write.parquet(path)
    (
        spark.read.schema(fresh.schema).parquet(path)
        .repartitionByRange("date", "id")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date")
        .parquet(days)
    )
    drop_scratch(spark, path)
