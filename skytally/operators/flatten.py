"""From nested snapshots to flat sightings. All of it also runs on streams."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytally.functions.geo import HOME_LAT, HOME_LON, create_point, st_distance_points
from skytally.functions.text import (
    clean_callsign,
    plain_number,
    sighting_id,
    squawk_num,
    whole_number,
)
from skytally.functions.timeconv import event_time
from skytally.operators.filters import callsign_ok, position_ok, within_radius
from skytally.schemas import SIGHTING_FIELDS

DISTANCE = "distanceInMetresFromHome"

SIGHTING_COLUMNS = ["PartitionKey", "RowKey", "id", *SIGHTING_FIELDS, DISTANCE]
# geom_rate and the distance stay inside the pipeline.
AIRCRAFT_COLUMNS = [c for c in SIGHTING_COLUMNS if c not in ("id", "geom_rate", DISTANCE)]


def with_event_time(rows: DataFrame, delay: str | None = None) -> DataFrame:
    """Time rows by their own ``now``; ``delay`` sets how long late rows are waited for."""
    timed = rows.withColumn("event_ts", event_time("now"))
    return timed.withWatermark("event_ts", delay) if delay else timed


def explode_aircraft(snapshots: DataFrame) -> DataFrame:
    """One row per aircraft, as struct ``a``; an empty or missing list gives no row.

    Exploding the bare column would make Spark filter out empty lists further down, also
    below the watermark: a snapshot of an empty sky would not move time on.
    """
    outer = [c for c in snapshots.columns if c != "aircraft"]
    listed = F.coalesce("aircraft", F.array().cast(snapshots.schema["aircraft"].dataType))
    return snapshots.select(*outer, F.explode(listed).alias("a"))


def flatten_aircraft(rows: DataFrame) -> DataFrame:
    """The struct ``a`` as plain columns; a value of the wrong kind becomes null."""
    outer = [c for c in rows.columns if c != "a"]
    stored = {f.name: f.dataType.simpleString() for f in rows.schema["a"].dataType}

    def field(name, kind):
        value = F.col(f"a.{name}")
        if stored[name] == "string" and kind == "int":
            value = whole_number(value)
        return value.alias(name)

    fields = [field(name, kind) for name, kind in SIGHTING_FIELDS.items()]
    return rows.select(*outer, F.col("a.flight").alias("flight"), *fields)


def one_per_callsign(snapshots: DataFrame) -> DataFrame:
    """Within one snapshot keep one usable aircraft per callsign, the lowest hex.

    The list is handled inside its row, so nothing is shuffled.
    """

    def usable(a):
        return (
            (F.length(F.rtrim(a["flight"])) > 1) & a["lat"].isNotNull() & a["lon"].isNotNull()
        )

    keyed = F.transform(
        F.filter("aircraft", usable),
        lambda a: F.struct(F.rtrim(a["flight"]).alias("key"), a["hex"].alias("hex"), a.alias("a")),
    )
    ordered = snapshots.withColumn("_keyed", F.array_sort(keyed))
    firsts = F.filter(
        "_keyed",
        lambda k, i: (i == 0) | (k["key"] != F.get(F.col("_keyed"), i - 1)["key"]),
    )
    return ordered.withColumn("aircraft", F.transform(firsts, lambda k: k["a"])).drop("_keyed")


def clean_sightings(
    rows: DataFrame, home_lat=HOME_LAT, home_lon=HOME_LON, model="sphere"
) -> DataFrame:
    """Flat reports as sightings: cleaned, filtered and measured from home; 18 columns.

    ``event_ts`` is kept as one more column when :func:`with_event_time` added it.
    """
    usable = rows.where(callsign_ok("flight") & position_ok())
    home = create_point(home_lat, home_lon)
    distance = st_distance_points(home, create_point("lat", "lon"), model=model)
    measures = [
        squawk_num("squawk").alias("squawk") if name == "squawk" else F.col(name)
        for name in SIGHTING_FIELDS
    ]
    timed = ["event_ts"] if "event_ts" in rows.columns else []
    return usable.select(
        clean_callsign("flight").alias("PartitionKey"),
        F.col("now").alias("RowKey"),
        sighting_id("now", "flight").alias("id"),
        *measures,
        distance.alias(DISTANCE),
        *timed,
    )


def all_flights(
    snapshots: DataFrame, home_lat=HOME_LAT, home_lon=HOME_LON, model="sphere"
) -> DataFrame:
    """Sightings straight from snapshots; what all three stored tables start from."""
    rows = flatten_aircraft(explode_aircraft(snapshots))
    return clean_sightings(rows, home_lat, home_lon, model)


def close_aircraft(
    sightings: DataFrame, radius=1000, home_lat=HOME_LAT, home_lon=HOME_LON, model="sphere"
) -> DataFrame:
    """Callsign and distance of the sightings within ``radius`` metres of home."""
    near = within_radius(sightings, radius, near=(home_lat, home_lon), model=model)
    timed = ["event_ts"] if "event_ts" in sightings.columns else []
    return near.select(F.col("PartitionKey").alias("flight"), DISTANCE, *timed)


def aircraft_rows(sightings: DataFrame, *more: str) -> DataFrame:
    """The wide row per sighting, in its stored column order."""
    return sightings.select(*AIRCRAFT_COLUMNS, *more)


def flight_documents(sightings: DataFrame, *more: str) -> DataFrame:
    """The document per sighting, keyed by ``id`` and placed by ``flight``."""
    keyed = rename_keys(sightings, {"PartitionKey": "flight", "RowKey": "Timestamp"})
    return keyed.select("id", "flight", "Timestamp", *AIRCRAFT_COLUMNS[2:], *more)


def select_star(rows: DataFrame, predicate=None) -> DataFrame:
    """Whole documents, optionally those a predicate (column or SQL text) holds for."""
    chosen = rows.select("*")
    return chosen if predicate is None else chosen.where(predicate)


def const_columns(rows: DataFrame, constants: dict) -> DataFrame:
    """Add literal columns: ``{name: value}`` or ``{name: (value, type)}``."""

    def literal(value):
        return F.lit(value[0]).cast(value[1]) if isinstance(value, tuple) else F.lit(value)

    return rows.withColumns({name: literal(value) for name, value in constants.items()})


def rename_keys(rows: DataFrame, names: dict) -> DataFrame:
    return rows.withColumnsRenamed(names)


def envelope(snapshots: DataFrame) -> DataFrame:
    """Four text properties per forwarded snapshot; needs the ``sequence`` column that
    :func:`skytally.operators.ordered.number_snapshots` adds."""
    return snapshots.withColumns(
        {
            "MessageCount": F.coalesce("messages", F.lit(0)).cast("string"),
            "TimeStamp": plain_number("now"),
            "CountOfAircraft": F.size("aircraft").cast("string"),
            "SequenceNumber": F.col("sequence").cast("string"),
        }
    ).drop("sequence")
