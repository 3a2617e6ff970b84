"""Schemas of the records the engine works on.

Every field is nullable: receivers leave out what they have not heard yet.
All aircraft fields are read as text, so that one aircraft with a text altitude ("ground")
loses that field and nothing else. The reader makes doubles of those that are; whole
numbers are cast after the explode.
"""

from pyspark.sql import types as T

# Aircraft fields that the flattened sighting keeps, with the type they get there.
SIGHTING_FIELDS = {
    "alt_baro": "int",
    "alt_geom": "int",
    "geom_rate": "int",
    "baro_rate": "int",
    "category": "string",
    "gs": "double",
    "hex": "string",
    "lat": "double",
    "lon": "double",
    "nav_altitude_mcp": "int",
    "nav_heading": "double",
    "nav_qnh": "double",
    "squawk": "double",
    "track": "double",
}

_TYPES = {"int": T.IntegerType(), "double": T.DoubleType(), "string": T.StringType()}
_TEXT = T.StringType()
_DOUBLE = T.DoubleType()
_TEXT_LIST = T.ArrayType(T.StringType())

_AIRCRAFT_TYPES = {
    "hex": _TEXT,
    "flight": _TEXT,
    "alt_baro": _TEXT,
    "alt_geom": _TEXT,
    "gs": _DOUBLE,
    "track": _DOUBLE,
    "baro_rate": _TEXT,
    "geom_rate": _TEXT,
    "squawk": _TEXT,
    "emergency": _TEXT,
    "category": _TEXT,
    "nav_qnh": _DOUBLE,
    "nav_altitude_mcp": _TEXT,
    "nav_heading": _DOUBLE,
    "nav_modes": _TEXT_LIST,
    "lat": _DOUBLE,
    "lon": _DOUBLE,
    "nic": _TEXT,
    "rc": _TEXT,
    "seen_pos": _DOUBLE,
    "version": _TEXT,
    "nic_baro": _TEXT,
    "nac_p": _TEXT,
    "nac_v": _TEXT,
    "sil": _TEXT,
    "sil_type": _TEXT,
    "gva": _TEXT,
    "sda": _TEXT,
    "mlat": _TEXT_LIST,
    "tisb": _TEXT_LIST,
    "messages": _TEXT,
    "seen": _DOUBLE,
    "rssi": _DOUBLE,
}


def _snapshot(aircraft_fields):
    aircraft = T.StructType(
        [T.StructField(name, _AIRCRAFT_TYPES[name]) for name in aircraft_fields]
    )
    return T.StructType(
        [
            T.StructField("receiver", T.StringType()),
            T.StructField("arrival", T.DoubleType()),
            T.StructField("now", T.DoubleType()),
            T.StructField("messages", T.LongType()),
            T.StructField("aircraft", T.ArrayType(aircraft)),
        ]
    )


def numbers_as_text(schema: T.StructType) -> T.StructType:
    """The schema to read documents with: every number of an aircraft as text."""

    def textual(field):
        is_number = isinstance(field.dataType, T.DoubleType)
        return T.StructField(field.name, _TEXT if is_number else field.dataType)

    aircraft = T.StructType([textual(f) for f in schema["aircraft"].dataType.elementType.fields])
    return T.StructType(
        [
            T.StructField(f.name, T.ArrayType(aircraft)) if f.name == "aircraft" else f
            for f in schema.fields
        ]
    )


# Whole snapshot, as published.
SNAPSHOT_FULL = _snapshot(_AIRCRAFT_TYPES)

# Only what the pipeline reads. Catalyst does not prune several fields through an
# explode, so the scan gets the narrow schema up front.
SNAPSHOT = _snapshot(["flight", *SIGHTING_FIELDS])

POINT = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("coordinates", T.ArrayType(T.DoubleType())),
    ]
)

_MEASURES = [
    T.StructField(name, _TYPES[kind])
    for name, kind in SIGHTING_FIELDS.items()
    if name not in ("geom_rate", "lat", "lon")
]

# Flight document as written by the live path; ingest_ts is when, in epoch seconds.
FLIGHT_RAW = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("flight", T.StringType()),
        T.StructField("Timestamp", T.DoubleType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        *_MEASURES,
        T.StructField("ingest_ts", T.LongType()),
    ]
)

# Flight document with its position as a point and its timestamp as a number.
FLIGHT = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("flight", T.StringType()),
        T.StructField("Timestamp", T.DecimalType(20, 6)),
        T.StructField("location", POINT),
        *_MEASURES,
        T.StructField("ingest_ts", T.LongType()),
    ]
)

# One row per flight: how often, when last and how near it was seen. The count is a
# long: one flight may have more rows than an int can count.
DISTINCT_FLIGHT = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("count", T.LongType()),
        T.StructField("last_seen", T.DoubleType()),
        T.StructField("closestDistanceInMetresFromMyLocation", T.DoubleType()),
    ]
)
