"""Streams give what the batch jobs give, also in many batches and after a restart."""

import json
import os

import pytest
from pyspark.sql import functions as F

from skytally.functions.geo import HOME_LAT, HOME_LON
from skytally.operators import flatten
from skytally.plans.ingest import forwarded
from skytally.plans.live import nearby, repaired_nearby
from skytally.schemas import FLIGHT, FLIGHT_RAW
from skytally.sinks import tables
from skytally.sources import flights as flight_source
from skytally.sources import snapshots as source
from skytally.streaming import queries as streams
from tests.conftest import aircraft, values

NEAR = {"lat": HOME_LAT, "lon": HOME_LON}


def drop(folder, name, documents, at):
    """Put a file of snapshots, one per line, into the folder, with a given file time."""
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w") as out:
        out.writelines(json.dumps(d) + "\n" for d in documents)
    os.utime(path, (at, at))


def snapshot(now, *flights, arrival=None, receiver="r", messages=1):
    craft = [aircraft(hex=f.lower(), flight=f.ljust(8), **NEAR) for f in flights]
    arrival = now if arrival is None else arrival
    return {"receiver": receiver, "arrival": arrival, "now": now, "messages": messages, "aircraft": craft}


def finish(*started):
    for one in started:
        one.awaitTermination()


def window_rows(frame):
    return values(
        frame,
        "flight",
        F.unix_seconds("FirstSeen"),
        F.unix_seconds("LastSeen"),
        "closestDistanceInMetresFromHome",
        "RecordCount",
    )


def test_windows_equal_batch_over_many_files_and_a_restart(spark, folder):
    docs = [snapshot(60.0 * i, "AB1", *(["CD2"] if i % 3 else [])) for i in range(1, 13)]

    def run():
        stream = source.stream_snapshots(spark, folder("in"), max_files_per_trigger=1)
        finish(streams.write_nearby_stream(stream, folder("out"), folder("cp")))

    for i, doc in enumerate(docs[:6]):
        drop(folder("in"), f"{i:02d}", [doc], 1000 + i)
    run()
    for i, doc in enumerate(docs[6:], 6):
        drop(folder("in"), f"{i:02d}", [doc], 1000 + i)
    drop(folder("in"), "99", [snapshot(9999.0)], 2000)
    run()
    expected = nearby(source.split_rejects(source.read_snapshots(spark, folder("in")))[0])
    got = window_rows(spark.read.parquet(folder("out")))
    assert got == window_rows(expected) and len(got) == 8


def test_late_rows_are_dropped_and_others_counted(spark, folder):
    drop(folder("in"), "0", [snapshot(1000.0, "AB1")], 1000)
    drop(folder("in"), "1", [snapshot(1300.0, "AB1")], 1001)
    # A watermark holds for late rows from the batch after next on: 1270 by then. The
    # first row is behind it, the second is not.
    drop(folder("in"), "2", [snapshot(1300.0)], 1002)
    drop(folder("in"), "3", [snapshot(1001.0, "LATE"), snapshot(1290.0, "AB1")], 1003)
    drop(folder("in"), "4", [snapshot(9999.0)], 1004)
    stream = source.stream_snapshots(spark, folder("in"), max_files_per_trigger=1)
    finish(streams.write_nearby_stream(stream, folder("out"), folder("cp")))
    assert window_rows(spark.read.parquet(folder("out"))) == [
        ("AB1", 900, 1080, 0.0, 1),
        ("AB1", 1260, 1440, 0.0, 2),
    ]


def test_a_clock_ahead_silences_nobody_and_repair_counts_all(spark, folder):
    times = [1000.0, 1100.0, 4e9, 2000.0, 2300.0, 2600.0]
    for i, now in enumerate(times):
        drop(folder("in"), str(i), [snapshot(now, "AB1", arrival=min(now, 3000.0))], 1000 + i)
    drop(folder("in"), "9", [snapshot(9999.0)], 1009)
    stream = source.stream_snapshots(spark, folder("in"), max_files_per_trigger=1)
    finish(streams.write_nearby_stream(stream, folder("out"), folder("cp")))
    batch = source.usable(source.read_snapshots(spark, folder("in")))
    near = spark.read.parquet(folder("out"))
    assert window_rows(near) == window_rows(nearby(batch.where("now < 9999")))
    tables.write_aircraft(flatten.all_flights(batch), folder("rows"))
    whole = repaired_nearby(near, spark.read.parquet(folder("rows")), lambda day: day.isNotNull())
    assert window_rows(whole) == window_rows(nearby(batch))


def test_fan_out_equals_batch_and_keeps_late_rows(spark, folder):
    docs = [
        [snapshot(100.0, "AB1", "CD2"), snapshot(101.0, "AB1")],
        [snapshot(90000.0, "AB1")],
        # Seen before, and far behind.
        [snapshot(100.0, "AB1", "EF3"), snapshot(90000.0, "AB1")],
        [snapshot(999999.0)],
    ]
    for i, lines in enumerate(docs):
        drop(folder("in"), str(i), lines, 1000 + i)
    stream = source.stream_snapshots(spark, folder("in"), max_files_per_trigger=1)
    out = {name: folder(name) for name in ("aircraft", "near", "flights")}
    finish(*streams.fan_out_sinks(stream, **out, checkpoint=folder("cp")))
    good, _ = source.split_rejects(source.read_snapshots(spark, folder("in")))
    batch = flatten.all_flights(good)
    tables.write_aircraft(batch, folder("batch-aircraft"))
    tables.write_flights(batch, folder("batch-flights"))
    stored = spark.read.parquet(out["flights"])
    columns = [c for c in FLIGHT_RAW.names if c != "ingest_ts"]
    assert values(stored, *columns) == values(spark.read.parquet(folder("batch-flights")), *columns)
    assert stored.where("ingest_ts > 1.6e9").count() == 5
    assert values(stored, "id") == [
        ("100-AB1",), ("100-CD2",), ("100-EF3",), ("101-AB1",), ("90000-AB1",),
    ]
    wide = flatten.AIRCRAFT_COLUMNS
    assert values(spark.read.parquet(out["aircraft"]), *wide) == values(
        spark.read.parquet(folder("batch-aircraft")), *wide
    )
    assert ("AB1", -80, 100, 0.0, 1) not in window_rows(spark.read.parquet(out["near"]))


def ingest(spark, folder):
    parsed = source.stream_snapshots(spark, folder("in"), max_files_per_trigger=1)
    out = [folder(n) for n in ("landing", "rejects", "state", "cp")]
    return streams.ingest_stream(parsed, *out, slices=2)


LANDED = "receiver STRING, arrival DOUBLE, now DOUBLE, SequenceNumber STRING, batch_id BIGINT"


@pytest.fixture
def polls(folder):
    lines = [
        [snapshot(5.0, arrival=1), snapshot(5.0, arrival=2), snapshot(6.0, arrival=3)],
        [snapshot(6.0, arrival=4), snapshot(5.0, arrival=5), snapshot(3.0, arrival=1, receiver="s")],
        [{"now": None}, snapshot(3.0, arrival=2, receiver="s"), snapshot(7.0, arrival=6)],
    ]
    for i, docs in enumerate(lines):
        drop(folder("in"), str(i), docs, 1000 + i)


def test_ingest_carries_order_across_batches(spark, folder, polls):
    finish(ingest(spark, folder))
    drop(folder("in"), "3", [snapshot(7.0, arrival=7), snapshot(8.0, arrival=8)], 2000)
    finish(ingest(spark, folder))
    good, bad = source.split_rejects(source.read_snapshots(spark, folder("in")))
    columns = ("receiver", "arrival", "now", "SequenceNumber")
    landed = spark.read.schema(LANDED).parquet(folder("landing"))
    assert values(landed, *columns) == values(forwarded(good), *columns)
    assert values(landed, "now", "SequenceNumber", "batch_id") == [
        (3.0, "0", 1), (5.0, "0", 0), (5.0, "2", 1), (6.0, "1", 0), (7.0, "3", 2), (8.0, "4", 3),
    ]
    assert spark.read.parquet(folder("rejects")).count() == bad.count() == 1


def test_order_inside_a_file_on_a_stream(spark, folder):
    """A, B, A without arrivals in one file: all three stay, as in batch."""
    lines = ['{"now": 5, "aircraft": []}', "", '{"now": 6, "aircraft": []}', "{broken", '{"now": 5, "aircraft": []}']
    lines += ['{"now": 5, "aircraft": [{"hex": "a", "gs": "?"}]}', "  "]
    os.makedirs(folder("in"))
    for name, more in (("0", []), ("1", ['{"now": 7, "aircraft": []}'])):
        with open(folder("in", name), "w") as out:
            out.write("\n".join([*lines, *more]))
        os.utime(folder("in", name), (1000 + int(name), 1000 + int(name)))
    parsed = source.stream_snapshots_in_order(spark, folder("in"), max_files_per_trigger=1)
    out = [folder(n) for n in ("landing", "rejects", "state", "cp")]
    finish(streams.ingest_stream(parsed, *out, slices=2))
    landed = values(spark.read.schema(LANDED).parquet(folder("landing")), "now", "SequenceNumber")
    assert landed == [(5.0, "0"), (5.0, "2"), (5.0, "4"), (6.0, "1"), (6.0, "3"), (7.0, "5")]
    good, bad = source.split_rejects(source.read_snapshots(spark, folder("in")))
    assert landed == values(forwarded(good), "now", "SequenceNumber")
    rejects = spark.read.parquet(folder("rejects"))
    assert values(rejects, "_corrupt", "reason") == values(bad, "_corrupt", "reason")


def test_a_file_is_read_by_many_tasks_in_order(spark, folder):
    """A file longer than a split: no task reads all of it, and places rise along it."""
    os.makedirs(folder("in"))
    with open(folder("in", "0"), "w") as out:
        out.writelines(f'{{"now": {n % 7}, "messages": {n}, "aircraft": []}}\n' + "\n" * (n % 3) for n in range(4000))
    sizes = {"spark.sql.files.maxPartitionBytes": "20000", "spark.sql.files.openCostInBytes": "1"}
    for name, size in sizes.items():
        spark.conf.set(name, size)
    read = []

    def keep(batch, _):
        read.extend(batch.select("place", "messages", F.spark_partition_id().alias("task")).collect())

    try:
        parsed = source.stream_snapshots_in_order(spark, folder("in"))
        query = parsed.writeStream.foreachBatch(keep).option("checkpointLocation", folder("cp"))
        finish(query.trigger(availableNow=True).start())
    finally:
        for name in sizes:
            spark.conf.unset(name)
    assert len({r.task for r in read}) > 4
    assert [r.messages for r in sorted(read, key=lambda r: r.place)] == list(range(4000))
    assert len({r.place for r in read}) == 4000


def test_a_batch_can_be_run_again(spark, folder, polls):
    finish(ingest(spark, folder))
    before = values(spark.read.schema(LANDED).parquet(folder("landing")))
    # Forget that the last batch was finished, as after a crash.
    for name in ("2", ".2.crc"):
        path = folder("cp", "commits", name)
        if os.path.exists(path):
            os.remove(path)
    finish(ingest(spark, folder))
    assert values(spark.read.schema(LANDED).parquet(folder("landing"))) == before


def test_ingest_holds_no_batch_in_memory(spark, folder, polls, monkeypatch):
    """A batch may be of any size: while it is stored, no executor keeps rows of it."""
    held, write_batch = [], streams.write_batch

    def write(*args, **more):
        write_batch(*args, **more)
        held.append(len(spark.sparkContext._jsc.sc().getRDDStorageInfo()))

    before = len(spark.sparkContext._jsc.sc().getRDDStorageInfo())
    monkeypatch.setattr(streams, "write_batch", write)
    shared = spark.conf.get("spark.checkpoint.dir")
    scratch = set(os.listdir(shared))
    finish(ingest(spark, folder))
    assert held == [before] * 6
    assert set(os.listdir(shared)) == scratch
    assert spark.read.schema(LANDED).parquet(folder("landing")).count() == 5


def test_changes_are_enriched_once_each(spark, folder):
    document = (1634905178.5, 1.0, 2.0)
    rows = [("1", "A", *document), ("2", "A", 7.0, None, 2.0), ("3", "B", *document)]
    short = "id STRING, flight STRING, Timestamp DOUBLE, lat DOUBLE, lon DOUBLE"
    more = [c for c in FLIGHT_RAW.fields if c.name not in ("id", "flight", "Timestamp", "lat", "lon")]

    def add(some):
        frame = spark.createDataFrame(some, short).withColumns(
            {c.name: F.lit(None).cast(c.dataType) for c in more}
        )
        frame.coalesce(1).write.mode("append").parquet(folder("raw"))

    def run():
        changes = flight_source.flights_changes(spark, folder("raw"))
        out = [folder(n) for n in ("enriched", "rejects", "metric", "cp")]
        finish(streams.enrich_changes(changes, *out))

    add(rows[:2])
    run()
    add([rows[2], rows[0]])
    run()
    stored = spark.read.schema(FLIGHT).parquet(folder("enriched"))
    stamp = F.col("Timestamp").cast("string")
    assert values(stored, "id", stamp, "location.coordinates") == [
        ("1", "1634905178.500000", [2.0, 1.0]),
        ("3", "1634905178.500000", [2.0, 1.0]),
    ]
    metric = spark.read.parquet(folder("metric")).groupBy("flight").agg(F.sum("count"))
    assert values(metric) == [("A", 1), ("B", 1)]


def test_whole_chain_from_documents_to_tables(spark, folder):
    docs = [snapshot(100.0, "AB1", arrival=1)] + [snapshot(100.0, "AB1", arrival=2 + i) for i in range(50)]
    docs += [snapshot(101.0, "AB1", arrival=90), snapshot(9999.0, arrival=91)]
    drop(folder("in"), "0", docs, 1000)
    finish(ingest(spark, folder))
    landed = source.stream_landing(spark, folder("landing"))
    out = {name: folder(name) for name in ("aircraft", "near", "flights")}
    finish(*streams.fan_out_sinks(landed, **out, checkpoint=folder("cp-tables"), max_ahead=None))
    assert window_rows(spark.read.parquet(out["near"])) == [("AB1", 0, 180, 0.0, 2)]
    assert values(spark.read.parquet(out["flights"]), "id") == [("100-AB1",), ("101-AB1",)]
    changes = flight_source.flights_changes(spark, out["flights"])
    enriched = [folder(n) for n in ("enriched", "rejects-2", "metric", "cp-enrich")]
    finish(streams.enrich_changes(changes, *enriched))
    stored = spark.read.schema(FLIGHT).parquet(enriched[0])
    assert values(stored, "id", "location.coordinates") == [
        ("100-AB1", [HOME_LON, HOME_LAT]),
        ("101-AB1", [HOME_LON, HOME_LAT]),
    ]
