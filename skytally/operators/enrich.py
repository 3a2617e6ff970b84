"""Turn a document's position into a point and its timestamp into a number."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytally.functions.cells import cell_of_point
from skytally.functions.geo import geojson_point
from skytally.functions.text import plain_number
from skytally.functions.timeconv import numeric_timestamp
from skytally.operators.filters import location_missing
from skytally.schemas import POINT


def with_location(flights: DataFrame) -> DataFrame:
    """Documents from the live path have no ``location`` field yet: add it as null."""
    if "location" in flights.columns:
        return flights
    return flights.withColumn("location", F.lit(None).cast(POINT))


def seconds_of(flights: DataFrame) -> Column:
    """The document's timestamp as decimal seconds, whatever type it is stored as."""
    if isinstance(flights.schema["Timestamp"].dataType, T.StringType):
        return numeric_timestamp("Timestamp")
    return F.col("Timestamp").try_cast("decimal(20,6)")


def enrich(flights: DataFrame) -> DataFrame:
    """The documents that need a point, with it. Those with an unreadable timestamp are
    left to :func:`enrich_rejects`; those that have a point already are left out.

    Also runs on a stream.
    """
    flights = with_location(flights)
    patched = (
        flights.where(location_missing())
        .withColumn("Timestamp", seconds_of(flights))
        .where(F.col("Timestamp").isNotNull())
        .withColumn("location", geojson_point("lat", "lon"))
    )
    rest = [c for c in flights.columns if c not in ("id", "flight", "Timestamp", "location", "lat", "lon")]
    return patched.select("id", "flight", "Timestamp", "location", *rest)


def with_cell(flights: DataFrame) -> DataFrame:
    """Add ``cell``, the place of the point on a space-filling curve. A table ordered by it
    inside its days can be searched by area without reading all of it."""
    return flights.withColumn("cell", cell_of_point())


def enrich_rejects(flights: DataFrame) -> DataFrame:
    """The documents that need a point but whose timestamp cannot be read, unchanged."""
    flights = with_location(flights)
    return flights.where(location_missing() & seconds_of(flights).isNull())


def patch_locations(flights: DataFrame, only: Column | None = None) -> DataFrame:
    """All documents; the ones that need a point (and meet ``only``) get it in place.

    One pass without a join. ``Timestamp`` keeps its column type, a patched text one
    then holds plain seconds. A document with an unreadable timestamp stays as it is.
    """
    flights = with_location(flights)
    seconds = seconds_of(flights)
    need = location_missing() & seconds.isNotNull()
    if only is not None:
        need = need & only
    need = F.coalesce(need, F.lit(False))
    text = isinstance(flights.schema["Timestamp"].dataType, T.StringType)
    number = plain_number(seconds) if text else seconds.cast(flights.schema["Timestamp"].dataType)
    return flights.withColumns(
        {
            "location": F.when(need, geojson_point("lat", "lon")).otherwise(F.col("location")),
            "lat": F.when(~need, F.col("lat")),
            "lon": F.when(~need, F.col("lon")),
            "Timestamp": F.when(need, number).otherwise(F.col("Timestamp")),
        }
    )
