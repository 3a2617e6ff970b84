"""Stored tables, and the plans they make possible."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from skytally.catalog import samples
from skytally.functions.geo import HOME_LAT, HOME_LON, st_distance
from skytally.operators import aggregates, enrich, filters, flatten, ordered, reports
from skytally.operators.upsert import keep_one
from skytally.plans import ingest, live, rollup
from skytally.schemas import DISTINCT_FLIGHT, FLIGHT_RAW, SNAPSHOT, SNAPSHOT_FULL
from skytally.session import scratch_dir
from skytally.sinks import tables
from skytally.sources import flights as flight_source
from skytally.sources import snapshots as source
from tests.conftest import SF_DIR, aircraft, plan, snapshots, values


def test_snapshot_documents(spark, folder, tmp_path):
    os.makedirs(folder("in"))
    documents = {
        "a": {"now": 5.5, "messages": 3, "extra": {"x": 1},
              "aircraft": [{"hex": "1", "alt_baro": "ground", "unknown": 1}, {"hex": "2", "alt_baro": 7}]},
        "b": {"now": 6, "aircraft": []},
        "c": {"messages": 3, "aircraft": []},
        "d": {"now": 7},
    }
    for name, document in documents.items():
        (tmp_path / "in" / f"{name}.json").write_text(json.dumps(document, indent=1))
    (tmp_path / "in" / "e.json").write_text('{"now": 8, "aircraft": [')
    good, bad = source.split_rejects(source.read_snapshots(spark, folder("in"), multiline=True))
    assert values(good, "now", "messages", F.size("aircraft")) == [(5.5, 3, 2), (6.0, None, 0)]
    assert bad.select("receiver", "_corrupt").count() == 3
    rows = flatten.flatten_aircraft(flatten.explode_aircraft(good))
    assert values(rows, "hex", "alt_baro") == [("1", None), ("2", 7)]
    assert {r[0] for r in good.select("receiver").collect()} == {"default"}
    assert good.where("arrival > 1.6e9").count() == 2


def test_schemas_agree():
    wide = {f.name: f.dataType for f in SNAPSHOT_FULL["aircraft"].dataType.elementType}
    narrow = {f.name: f.dataType for f in SNAPSHOT["aircraft"].dataType.elementType}
    assert len(wide) == 33 and narrow.items() <= wide.items()


def test_wire_messages_round_trip(spark):
    rows = spark.createDataFrame([("A", 2, 1634905178.5, None), ("B", 1, 3.0, 4.5)], DISTINCT_FLIGHT)
    back = source.from_wire_message(source.to_wire_message(rows), DISTINCT_FLIGHT)
    assert values(back) == values(rows) and back.schema == rows.schema
    broken = spark.createDataFrame([("{nope",)], "message STRING")
    assert values(source.from_wire_message(broken, DISTINCT_FLIGHT)) == [(None,) * 4]


@pytest.fixture
def sightings(spark):
    craft = [
        aircraft(hex=h, flight=f, lat=HOME_LAT + i / 1000, lon=HOME_LON)
        for i, (h, f) in enumerate([("b", "AB1"), ("a", "AB1"), ("c", "CD2")])
    ]
    return flatten.all_flights(
        snapshots(spark, [("r", 1, 86399.5, craft), ("r", 2, 86400, craft), ("s", 1, 86400, craft)])
    )


def test_flights_are_stored_once_per_id(spark, folder, sightings):
    tables.write_flights(sightings, folder("flights"))
    stored = flight_source.read_flights(spark, folder("flights"), FLIGHT_RAW)
    assert values(stored, "id", "hex") == [
        ("86399.5-AB1", "a"), ("86399.5-CD2", "c"), ("86400-AB1", "a"), ("86400-CD2", "c"),
    ]
    assert sorted(n for n in os.listdir(folder("flights")) if "=" in n) == [
        "date=1970-01-01", "date=1970-01-02",
    ]


def test_aircraft_rows_are_stored_once_per_key(spark, folder, sightings):
    tables.write_aircraft(sightings, folder("aircraft"))
    stored = spark.read.parquet(folder("aircraft"))
    assert stored.count() == 4 and stored.columns == [*flatten.AIRCRAFT_COLUMNS, "date"]


def test_versions(spark, folder):
    table = tables.VersionedTable(spark, folder("spotter"))
    assert table.version() is None and table.read(DISTINCT_FLIGHT).count() == 0
    row = lambda n: spark.createDataFrame([("A", n, 1.0, 2.0)], DISTINCT_FLIGHT)
    assert table.publish(row(1)) == 1
    held = table.read(DISTINCT_FLIGHT)
    # A run that failed before publishing leaves a folder that the next one replaces.
    row(7).write.parquet(folder("spotter", "v=2"))
    assert values(table.read(DISTINCT_FLIGHT), "count") == [(1,)]
    assert table.publish(row(2).unionByName(held)) == 2
    assert values(table.read(DISTINCT_FLIGHT), "count") == [(1,), (2,)]
    assert values(held, "count") == [(1,)]


def test_scratch_lies_in_the_shared_folder(spark):
    assert scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


# Plans


def test_time_and_flight_filters_reach_the_scan(spark, folder, sightings):
    tables.write_flights(sightings, folder("flights"))
    stored = spark.read.parquet(folder("flights"))
    text = plan(filters.flight_eq(filters.time_after(stored, 86400.0), "AB1").select("id"))
    assert "date" in text.split("PartitionFilters:")[1].split("\n")[0]
    pushed = text.split("PushedFilters:")[1].split("\n")[0]
    assert "EqualTo(flight,AB1)" in pushed and "GreaterThan(Timestamp,86400.0)" in pushed
    assert "hex" not in text.split("ReadSchema:")[1].split("\n")[0]
    found = filters.time_between(stored, 86399.5, 86401)
    assert values(found, "id") == [("86400-AB1",), ("86400-CD2",)]


def test_radius_search_pushes_its_box(spark, folder, sightings):
    tables.write_aircraft(sightings, folder("aircraft"))
    stored = spark.read.parquet(folder("aircraft"))
    rows = stored.withColumn(flatten.DISTANCE, st_distance(HOME_LAT, HOME_LON, "lat", "lon"))
    near = filters.within_radius(rows, 150, near=(HOME_LAT, HOME_LON))
    pushed = plan(near).split("PushedFilters:")[1].split("\n")[0]
    assert "GreaterThanOrEqual(lat" in pushed and "LessThanOrEqual(lon" in pushed
    assert near.count() == filters.within_radius(rows, 150).count() == 2


def test_top_k_does_not_sort_everything(spark):
    text = plan(reports.closest_10(samples.spotter(spark, SF_DIR)))
    assert "TakeOrderedAndProject" in text


def test_aggregates_combine_before_the_shuffle(spark):
    for frame in (
        samples.spotter(spark, SF_DIR),
        aggregates.distinct_flights(samples.documents(spark, SF_DIR)),
        aggregates.nearby_windows(
            flatten.close_aircraft(
                flatten.all_flights(flatten.with_event_time(samples.snapshots(spark, SF_DIR)))
            )
        ),
    ):
        text = plan(frame).split("\n\n")[0]
        assert text.count("HashAggregate") == 2 and text.count("Exchange") == 1
        assert "SortAggregate" not in text


def test_copies_are_cut_before_the_shuffle(spark):
    text = plan(keep_one(samples.documents(spark, SF_DIR), ["id"], ["hex"])).split("\n\n")[0]
    tree = [line.strip(" *+-:") for line in text.splitlines()]
    limits = [i for i, line in enumerate(tree) if line.startswith("WindowGroupLimit")]
    exchange = next(i for i, line in enumerate(tree) if line.startswith("Exchange"))
    assert len(limits) == 2 and limits[0] < exchange < limits[1]


def test_snapshots_are_shuffled_once_for_order(spark):
    """The rows with their aircraft lists cross one exchange, all others are narrow."""
    sliced = ordered.with_slices(samples.polled_snapshots(spark, SF_DIR), 4)
    kept = ordered.dedupe_snapshots(sliced, unique_arrival=True)
    text = plan(ordered.number_snapshots(kept))
    details = [block for block in text.split("\n\n") if " Exchange" in block.split("\n")[0]]
    assert len([block for block in details if "aircraft" in block]) == 1
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_flattening_needs_no_shuffle(spark):
    text = plan(flatten.all_flights(samples.snapshots(spark, SF_DIR)))
    assert "Exchange" not in text and "Python" not in text


def test_daily_rollups_combine_to_the_whole(spark, folder):
    flights = samples.flights(spark, SF_DIR)
    flights = flights.withColumn("date", F.to_date(F.timestamp_seconds("Timestamp")))
    early = F.col("date") < F.lit("2024-01-12").cast("date")
    rollup.refresh_days(flights.where("flight <> 'FL1'"), folder("days"), F.lit(True))
    rollup.refresh_days(flights, folder("days"), early)
    rollup.refresh_days(flights, folder("days"), ~early)
    whole = values(aggregates.flight_rollup(flights))
    assert values(rollup.combine_days(spark.read.parquet(folder("days")))) == whole


def test_time_bounds_reach_the_scan_for_both_timestamp_types(spark, folder):
    double = spark.createDataFrame([("1", 10.5), ("2", 11.25)], "id STRING, Timestamp DOUBLE")
    double.write.parquet(folder("double"))
    double.selectExpr("id", "CAST(Timestamp AS DECIMAL(20,6)) AS Timestamp").write.parquet(folder("decimal"))
    for name in ("double", "decimal"):
        stored = spark.read.parquet(folder(name))
        for found in (
            filters.time_between(stored, 10.5, 12),
            filters.time_after(stored, 11),
            filters.time_eq(stored, 11.25),
        ):
            pushed = plan(found).split("PushedFilters:")[1].split("\n")[0]
            assert "Timestamp," in pushed, (name, pushed)
            assert values(found, "id") == [("2",)]


def test_bad_snapshots_and_fields_cost_only_themselves(spark, folder, tmp_path):
    (tmp_path / "in").mkdir()
    craft = '{"flight": "AB1", "hex": "a", "lat": %s, "lon": 2.5, "alt_baro": 32000.0}'
    lines = [
        '{"arrival": 1, "now": 1704844800000000, "aircraft": []}',
        '{"arrival": 2, "now": NaN, "aircraft": []}',
        '{"arrival": 3, "aircraft": [], "messages": 9}',
        '{"arrival": 4, "now": 4}',
        '{"arrival": 5, "now": 5, "aircraft": [%s, %s]}' % (craft % '"?"', craft % "1.5"),
        '{"arrival": 6, "now": 6',
    ]
    (tmp_path / "in" / "0").write_text("\n".join(lines))
    parsed = source.read_snapshots(spark, folder("in"))
    good, bad = source.split_rejects(parsed)
    assert values(bad.where("reason <> 'unparsable'"), "arrival", "reason", "messages") == [
        (1.0, "impossible time", None), (2.0, "impossible time", None), (3.0, "no time", 9),
        (4.0, "no list", None),
    ]
    assert bad.where("reason = 'unparsable'").first()["_corrupt"] == lines[5]
    assert values(flatten.all_flights(source.usable(parsed)), "id", "lat", "alt_baro") == [("5-AB1", 1.5, 32000)]
    craft = flatten.flatten_aircraft(flatten.explode_aircraft(good))
    assert values(craft, "lat") == [(1.5,), (None,)]
    for _ in range(2):
        ingest.ingest_snapshots(parsed, folder("landing"), folder("rejects"))
        assert spark.read.parquet(folder("landing")).count() == 1


def test_order_inside_a_file_is_kept(spark, folder, tmp_path):
    (tmp_path / "in").mkdir()
    nows = [5, 6, 5, 7] + [100 + i % 2 for i in range(4000)]
    lines = [f'{{"now": {n}, "aircraft": [], "messages": {i}}}' for i, n in enumerate(nows)]
    (tmp_path / "in" / "0").write_text("\n".join(lines))
    size = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(size)
    for bytes_ in ("128m", "16k"):
        spark.conf.set(size, bytes_)
        try:
            parsed = source.read_snapshots(spark, folder("in"))
            kept = ingest.forwarded(source.usable(parsed)).collect()
        finally:
            spark.conf.set(size, before)
        kept = sorted((int(r.SequenceNumber), int(r.MessageCount)) for r in kept)
        assert kept == [(i, i) for i in range(len(nows))]


def test_repair_counts_the_windows_of_a_day_anew(spark, folder):
    craft = [aircraft(hex="a", flight="AB1", lat=HOME_LAT, lon=HOME_LON)]
    times = [86000, 86390, 86410, 86500, 90000]
    all_ = snapshots(spark, [("r", t, t, craft) for t in times])
    tables.write_aircraft(flatten.all_flights(all_), folder("aircraft"))
    stored = live.nearby(all_.where("now NOT IN (86390, 86500)"))
    stored_rows = spark.read.parquet(folder("aircraft"))
    whole = live.repaired_nearby(stored, stored_rows, lambda day: day == F.lit("1970-01-02").cast("date"))
    assert values(whole) == values(live.nearby(all_))


def test_writes_can_be_repeated(spark, folder, sightings):
    for _ in range(2):
        tables.write_flights(sightings, folder("flights"))
        tables.write_aircraft(sightings, folder("aircraft"))
        assert spark.read.parquet(folder("flights")).count() == 4
        assert spark.read.parquet(folder("aircraft")).count() == 4


def test_a_day_without_documents_leaves_the_rollup(spark, folder, sightings):
    tables.write_flights(sightings, folder("flights"))
    flights = enrich.enrich(spark.read.parquet(folder("flights")))
    rollup.refresh_days(flights, folder("days"), F.lit(True))
    late = F.col("date") >= F.lit("1970-01-02").cast("date")
    for _ in range(2):
        rollup.refresh_days(flights.where("date < '1970-01-02'"), folder("days"), late)
        assert values(rollup.combine_days(spark.read.parquet(folder("days"))), "id", "count") == [
            ("AB1", 1), ("CD2", 1),
        ]


def test_batch_ingest_lands_changes_and_sets_rejects_aside(spark, folder, tmp_path):
    (tmp_path / "in").mkdir()
    lines = ['{"now": 5, "aircraft": []}', '{"now": 5, "aircraft": [', '{"now": 5, "aircraft": []}', '{"now": 6}']
    lines.append('{"now": 7, "messages": 2, "aircraft": [{"hex": "a"}]}')
    (tmp_path / "in" / "0").write_text("\n".join(lines))
    parsed = source.read_snapshots(spark, folder("in"))
    ingest.ingest_snapshots(parsed, folder("landing"), folder("rejects"))
    names = ["now", "MessageCount", "TimeStamp", "CountOfAircraft", "SequenceNumber"]
    assert values(spark.read.parquet(folder("landing")), *names) == [
        (5.0, "0", "5", "0", "0"), (7.0, "2", "7", "1", "1"),
    ]
    rejects = spark.read.schema("receiver STRING, _corrupt STRING").json(folder("rejects"))
    assert values(rejects) == [("default", lines[1]), ("default", None)]


LANDED = "receiver STRING, arrival DOUBLE, now DOUBLE, SequenceNumber STRING"


def polled(*polls):
    return [(r, a, n, []) for r, a, n in polls]


def land(spark, folder, *polls, name="landing"):
    frame = snapshots(spark, polled(*polls)).withColumn("_corrupt", F.lit(None).cast("string"))
    ingest.ingest_snapshots(frame, folder(name), folder(f"{name}-rejects"), slices=2)
    return values(spark.read.schema(LANDED).parquet(folder(name)))


def test_ingest_goes_on_from_the_last_run(spark, folder):
    first, second, third = ("r", 1, 11), ("r", 2, 12), ("r", 3, 13)
    assert land(spark, folder, first, second) == [("r", 1.0, 11.0, "0"), ("r", 2.0, 12.0, "1")]
    expected = [("r", 1.0, 11.0, "0"), ("r", 2.0, 12.0, "1"), ("r", 3.0, 13.0, "2")]
    for _ in range(2):
        assert land(spark, folder, second, third) == expected
    assert land(spark, folder, ("r", 4, 13), ("s", 1, 5)) == [*expected, ("s", 1.0, 5.0, "0")]


def test_runs_over_overlapping_parts_equal_one_run(spark, folder):
    rng = random.Random(7)
    polls, clock = [], {"r": 1, "s": 1}
    for arrival in range(60):
        receiver = rng.choice("rrrs")
        clock[receiver] += rng.choice([0, 0, 1])
        polls.append((receiver, arrival, clock[receiver]))
    for part in (polls[:25], polls[15:40], polls[10:12], polls[40:]):
        parts = land(spark, folder, *part, name="parts")
    assert parts == land(spark, folder, *polls, name="whole")


def test_ingest_makes_up_for_a_run_that_failed(spark, folder, monkeypatch):
    land(spark, folder, ("r", 1, 11))
    publish = tables.VersionedTable.publish

    def fail(self, rows, **marks):
        if not marks:
            raise RuntimeError("lost")
        return publish(self, rows, **marks)

    monkeypatch.setattr(tables.VersionedTable, "publish", fail)
    with pytest.raises(RuntimeError):
        land(spark, folder, ("r", 2, 12), ("s", 2, 5))
    monkeypatch.undo()
    assert land(spark, folder, ("r", 2, 12), ("r", 3, 12), ("r", 4, 13), ("s", 3, 5)) == [
        ("r", 1.0, 11.0, "0"), ("r", 2.0, 12.0, "1"), ("r", 4.0, 13.0, "2"), ("s", 2.0, 5.0, "0"),
    ]


def test_fractions_bound_whole_numbers(spark):
    def kept(kind, condition, *numbers):
        frame = spark.createDataFrame([(float(n),) for n in numbers], "t double").select(F.col("t").cast(kind))
        return [float(r.t) for r in sorted(condition(frame).collect())]

    for kind in ("bigint", "int", "decimal(9,0)"):
        between = lambda rows: filters.time_between(rows, 8.5, 10.5, "t")
        assert kept(kind, between, 8, 9, 10, 11) == [9, 10]
        assert kept(kind, lambda rows: filters.time_between(rows, 8, 10, "t"), 8, 9, 10) == [9]
        assert kept(kind, lambda rows: filters.time_after(rows, -1.5, "t"), -2, -1, 0) == [-1, 0]
        assert kept(kind, lambda rows: filters.time_after(rows, -1e30, "t"), -2) == [-2]
        assert kept(kind, lambda rows: filters.time_after(rows, 3e9, "t"), 5) == []
    fine = lambda rows: filters.time_between(rows, 1.0000005, 1.0000025, "t")
    assert kept("decimal(20,6)", fine, 1.000000, 1.000001, 1.000002, 1.000003) == [1.000001, 1.000002]


def test_writes_read_their_input_once(spark, folder, sightings, monkeypatch):
    """Appending to a stored table computes the rows once."""
    tables.write_flights(sightings, folder("flights"))
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(value):
        seen.add(1)
        return value

    counting = sightings.withColumn("gs", counted(F.lit(1.0)).cast("double"))
    tables.write_flights(counting, folder("flights"))
    assert seen.value == sightings.count()
