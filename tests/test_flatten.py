from collections import defaultdict

from pyspark.sql import functions as F

from skytally.functions.geo import HOME_LAT, HOME_LON
from skytally.operators import flatten
from tests.conftest import aircraft, snapshots, values

AT_HOME = {"lat": HOME_LAT, "lon": HOME_LON}


def test_callsign_and_position_filters(spark):
    craft = [
        aircraft(hex="1", flight="AB1     ", **AT_HOME),
        aircraft(hex="2", flight="        ", **AT_HOME),
        aircraft(hex="3", flight="X       ", **AT_HOME),
        aircraft(hex="4", flight=None, **AT_HOME),
        aircraft(hex="5", flight="CD2     ", lat=1.0),
        aircraft(hex="6", flight="EF3     ", lon=1.0),
        aircraft(hex="7", flight="XY", **AT_HOME),
    ]
    got = flatten.all_flights(snapshots(spark, [("r", 1, 5, craft)]))
    assert values(got, "hex", "PartitionKey", "id") == [("1", "AB1", "5-AB1"), ("7", "XY", "5-XY")]
    assert got.columns == flatten.SIGHTING_COLUMNS and len(got.columns) == 18


def test_empty_and_missing_lists_give_no_rows(spark):
    rows = snapshots(spark, [("r", 1, 5, []), ("r", 2, 6, None)])
    assert flatten.all_flights(rows).count() == 0


def test_text_in_a_number_field_costs_only_that_field(spark):
    craft = [aircraft(hex="1", flight="AB1", alt_baro="ground", alt_geom="120", squawk="0012", **AT_HOME)]
    got = flatten.all_flights(snapshots(spark, [("r", 1, 5, craft)]))
    assert values(got, "alt_baro", "alt_geom", "squawk") == [(None, 120, 12.0)]


def test_explode_undoes_nesting(spark):
    flat = [(s, f"{i:06x}") for s in range(5) for i in range(s * 3)]
    groups = defaultdict(list)
    for now, hex_ in flat:
        groups[now].append(aircraft(hex=hex_))
    rows = snapshots(spark, [("r", now, now, craft) for now, craft in groups.items()])
    got = values(flatten.explode_aircraft(rows), F.col("now").cast("int"), "a.hex")
    assert got == sorted(flat)


def test_close_aircraft_is_strict(spark):
    metres_north = lambda m: HOME_LAT + m / 111195.0797
    craft = [
        aircraft(hex="1", flight="NEAR", lat=metres_north(999), lon=HOME_LON),
        aircraft(hex="2", flight="FAR", lat=metres_north(1001), lon=HOME_LON),
        aircraft(hex="3", flight="HERE", **AT_HOME),
    ]
    sightings = flatten.all_flights(snapshots(spark, [("r", 1, 5, craft)]))
    assert values(flatten.close_aircraft(sightings), "flight") == [("HERE",), ("NEAR",)]
    assert values(flatten.close_aircraft(sightings, radius=0), "flight") == []


def test_one_per_callsign_keeps_lowest_hex(spark):
    craft = [
        aircraft(hex="b", flight="AB1 ", **AT_HOME),
        aircraft(hex="a", flight="AB1", **AT_HOME),
        aircraft(hex="0", flight="AB1", lat=1.0),
        aircraft(hex="c", flight="CD2", **AT_HOME),
        aircraft(hex=None, flight="CD2", **AT_HOME),
        aircraft(hex="d", flight="X", **AT_HOME),
    ]
    rows = flatten.one_per_callsign(
        snapshots(spark, [("r", 1, 5, craft), ("r", 2, 6, []), ("r", 3, 7, None), ("r", 4, 8, craft[:1])])
    )
    got = values(flatten.all_flights(rows), "id", "hex")
    assert got == [("5-AB1", "a"), ("5-CD2", None), ("8-AB1", "b")]
    assert rows.schema["aircraft"].dataType == snapshots(spark, []).schema["aircraft"].dataType


def test_constants_and_renames(spark):
    rows = spark.createDataFrame([("A",)], "flight STRING")
    got = flatten.const_columns(flatten.rename_keys(rows, {"flight": "id"}), {"n": (0, "int"), "t": "x"})
    assert got.columns == ["id", "n", "t"] and values(got) == [("A", 0, "x")]
    assert values(flatten.select_star(rows, "flight = 'B'")) == []


def test_sinks_leave_out_climb_rate_and_distance(spark):
    sightings = flatten.all_flights(snapshots(spark, []))
    assert flatten.aircraft_rows(sightings).columns == [
        "PartitionKey", "RowKey", "alt_baro", "alt_geom", "baro_rate", "category", "gs", "hex",
        "lat", "lon", "nav_altitude_mcp", "nav_heading", "nav_qnh", "squawk", "track",
    ]
    assert flatten.flight_documents(sightings).columns[:4] == ["id", "flight", "Timestamp", "alt_baro"]
