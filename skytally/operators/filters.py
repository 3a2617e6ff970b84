"""Row filters. Times are epoch seconds, bounds are exclusive."""

from decimal import ROUND_CEILING, ROUND_FLOOR, Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, IntegralType, StringType

from skytally.functions.cells import cell_ranges, in_ranges
from skytally.functions.geo import bounding_box, st_distance_point
from skytally.functions.text import clean_callsign, str_len
from skytally.functions.timeconv import numeric_timestamp


def callsign_ok(flight) -> Column:
    return str_len(clean_callsign(flight)) > 1


def has_callsign(rows: DataFrame, flight="flight") -> DataFrame:
    """Rows whose callsign has more than one character once its padding is cut."""
    return rows.where(callsign_ok(flight))


def position_ok(lat="lat", lon="lon") -> Column:
    return F.col(lon).isNotNull() & F.col(lat).isNotNull()


def has_position(rows: DataFrame, lat="lat", lon="lon") -> DataFrame:
    return rows.where(position_ok(lat, lon))


def within_radius(
    rows: DataFrame, radius, distance="distanceInMetresFromHome", near=None, model="sphere"
) -> DataFrame:
    """Rows strictly nearer than ``radius`` metres by their ``distance`` column.

    With ``near=(lat, lon)``, the point the distances are measured from, a bounding box
    on the lat and lon columns goes first: it reaches the scan, the distance does not.
    """
    box = bounding_box(*near, radius, model=model) if near else None
    if box is not None:
        rows = rows.where(box)
    return rows.where(F.col(distance) < radius)


def location_missing() -> Column:
    return F.col("location").isNull() & position_ok()


def needs_location(flights: DataFrame) -> DataFrame:
    """Documents that have a position but no point yet. Guards the change feed."""
    return flights.where(location_missing())


def _unprocessed(hemisphere_safe):
    return F.col("lat").isNotNull() if hemisphere_safe else F.col("lat") > 0


def unprocessed_flights(flights: DataFrame, hemisphere_safe=False) -> DataFrame:
    """Documents with ``lat > 0``, or with any latitude when ``hemisphere_safe``."""
    return flights.where(_unprocessed(hemisphere_safe))


def backfill_due(as_of, lag_seconds=7200, hemisphere_safe=False) -> Column:
    return _unprocessed(hemisphere_safe) & (F.col("ingest_ts") < as_of - lag_seconds)


def backfill_candidates(
    flights: DataFrame, as_of, lag_seconds=7200, hemisphere_safe=False
) -> DataFrame:
    """Unprocessed documents stored before ``as_of`` (epoch seconds) less the lag."""
    return flights.where(backfill_due(as_of, lag_seconds, hemisphere_safe))


def flight_eq(flights: DataFrame, flight) -> DataFrame:
    return flights.where(F.col("flight") == F.lit(flight))


def _dates(flights, low=None, high=None):
    """Narrow a table partitioned by date to the days a time range touches."""
    if "date" in flights.columns:
        day = F.col("date")
        if isinstance(low, (int, float)):
            flights = flights.where(day >= F.to_date(F.timestamp_seconds(F.lit(low))))
        if isinstance(high, (int, float)):
            flights = flights.where(day <= F.to_date(F.timestamp_seconds(F.lit(high))))
    return flights


def _moment(flights, time):
    """The time column to compare: text, of whatever layout, as seconds."""
    text = isinstance(flights.schema[time].dataType, StringType)
    return numeric_timestamp(time) if text else F.col(time)


def _bound(flights, time, moment, rounding):
    """A bound in the type of the time column, so that the column itself is not cast:
    only then does the comparison reach the scan.

    Numbers with a fixed count of places compare with a bound of more places as with the
    number of theirs that ``rounding`` makes of it.
    """
    if isinstance(moment, Column):
        return moment
    kind = flights.schema[time].dataType
    if isinstance(kind, StringType):
        kind = DecimalType(20, 6)
    if not isinstance(kind, (IntegralType, DecimalType)):
        return F.lit(Decimal(str(moment))).cast(kind)
    places = kind.scale if isinstance(kind, DecimalType) else 0
    exact = Decimal(str(moment))
    if not exact.is_finite() or abs(exact) >= 1 << 62:
        return F.lit(float(moment))
    rounded = exact.quantize(Decimal(1).scaleb(-places), rounding)
    if isinstance(kind, DecimalType):
        fits = abs(rounded) < Decimal(10) ** (kind.precision - kind.scale)
    else:
        fits = abs(rounded) < 1 << {"tinyint": 7, "smallint": 15, "int": 31}.get(kind.simpleString(), 63)
    value = rounded if places else int(rounded)
    return F.lit(value).cast(kind) if fits else F.lit(float(moment))


def _above(flights, time, low):
    return _moment(flights, time) > _bound(flights, time, low, ROUND_FLOOR)


def _below(flights, time, high):
    return _moment(flights, time) < _bound(flights, time, high, ROUND_CEILING)


def time_between(flights: DataFrame, low, high, time="Timestamp") -> DataFrame:
    """Rows between two times. A time given as text is compared as the time it means; text
    that is no time is in no range."""
    inside = _above(flights, time, low) & _below(flights, time, high)
    return _dates(flights, low, high).where(inside)


def time_after(flights: DataFrame, low, time="Timestamp") -> DataFrame:
    return _dates(flights, low).where(_above(flights, time, low))


def time_eq(flights: DataFrame, moment, time="Timestamp") -> DataFrame:
    """Rows at one instant, compared as decimals of six places.

    ``moment`` is a number or a column, e.g. a scalar subquery.
    """
    flights = _dates(flights, moment, moment)
    if isinstance(moment, (int, float)) and isinstance(flights.schema[time].dataType, DoubleType):
        # The decimals differ by less than this; unlike them it reaches the scan.
        flights = flights.where(F.col(time).between(moment - 1e-6, moment + 1e-6))
    instant = moment if isinstance(moment, Column) else F.lit(Decimal(str(moment)))
    own = _moment(flights, time).try_cast("decimal(20,6)")
    return flights.where(own == instant.try_cast("decimal(20,6)"))


def _area(flights, lat, lon, nearest, farthest, model) -> DataFrame:
    """Narrow a table that has ``cell`` to the cells that may be this far from a position."""
    if "cell" not in flights.columns:
        return flights
    if model != "sphere":  # other models differ by less than a hundredth
        nearest, farthest = nearest / 1.01, farthest * 1.01
    return flights.where(in_ranges(cell_ranges(lat, lon, nearest, farthest)))


def distance_eq(flights: DataFrame, lat, lon, metres, tol=0.0, model="sphere") -> DataFrame:
    """Rows whose point lies ``metres`` from a position, give or take ``tol``.

    On a table with ``cell`` (:func:`skytally.operators.enrich.with_cell`) the cells of the
    ring reach the scan, if the position and ``metres`` are plain numbers.
    """
    if all(isinstance(v, (int, float)) for v in (lat, lon, metres, tol)):
        flights = _area(flights, lat, lon, metres - tol, metres + tol, model)
    gap = st_distance_point(lat, lon, model=model) - metres
    return flights.where(F.abs(gap) <= tol)


def points_within(flights: DataFrame, lat: float, lon: float, radius, model="sphere") -> DataFrame:
    """Rows whose point lies strictly nearer than ``radius`` metres to a position. On a table
    with ``cell`` the cells of the circle reach the scan."""
    near = _area(flights, lat, lon, 0.0, radius, model)
    return near.where(st_distance_point(lat, lon, model=model) < radius)
