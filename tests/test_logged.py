"""Tables with a log of commits: nothing is lost or doubled by batches that run again, by
compaction, or by two writers at once; readers keep what they began with."""

import os
import threading

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytally.plans.live import nearby
from skytally.schemas import FLIGHT, FLIGHT_RAW
from skytally.sinks.commits import CommitLog, Conflict
from skytally.sinks.logged import LoggedTable, MergedTable, WindowTable, day_of_key
from skytally.sinks.tables import VersionedTable
from skytally.sources import flights as flight_source
from skytally.sources import snapshots as source
from skytally.streaming import queries as streams
from tests.conftest import plan, values
from tests.test_streaming import drop, snapshot, window_rows

ROW = T.StructType([T.StructField("id", T.StringType()), T.StructField("n", T.LongType())])


def rows(spark, *data):
    """(id, n, date) rows."""
    frame = spark.createDataFrame(data, "id STRING, n BIGINT, date STRING")
    return frame.withColumn("date", F.col("date").cast("date"))


def files_of(folder, day):
    found = [os.path.join(p, f) for p, _, names in os.walk(folder) for f in names if f.endswith(".parquet")]
    return [f for f in found if f"date={day}" in f]


def test_a_number_is_given_once(spark, folder):
    log = CommitLog(spark, folder("t"))
    assert log.numbers() == [] and log.put(1, {"by": "a"}) and not log.put(1, {"by": "b"})
    assert log.read(1) == {"by": "a"}
    assert log.commit(lambda base: {"on": base}) == 2 and log.commit(lambda base: None) == 2
    with pytest.raises(Conflict):
        log.commit(lambda base: log.put(base + 1, {}) and {}, attempts=2)


def test_batches_are_added_once(spark, folder):
    table = LoggedTable(spark, folder("t"), ROW, ["id"])
    assert table.read().count() == 0 and table.version() == 0
    for batch, data in enumerate([("a", 1, "2024-01-01"), ("b", 2, "2024-01-02")]):
        table.append(rows(spark, data), "w", batch)
    assert table.append(rows(spark, ("b", 2, "2024-01-02")), "w", 1) == 2
    table.append(rows(spark, ("b", 3, None)), "other", 0)
    assert values(table.read(), "id", "n") == [("a", 1), ("b", 2), ("b", 3)]
    assert values(table.read(days=["2024-01-02", "2030-01-01"]), "n") == [(2,)]
    assert values(table.read(version=1), "n") == [(1,)]


def test_compaction_under_readers_and_writers(spark, folder):
    table = LoggedTable(spark, folder("t"), ROW, ["id"])
    for batch in range(20):  # past a commit that holds the whole state
        table.append(rows(spark, (f"k{batch:02d}", batch, "2024-01-01"), ("x", batch, "2024-01-09")), "w", batch)
    held = table.read()
    before = values(held)
    assert table.compact(before="2024-01-05") == ["2024-01-01"]
    assert len(table.state().days["2024-01-01"]) == 1 and len(table.state().days["2024-01-09"]) == 20
    assert len(files_of(folder("t"), "2024-01-01")) == 21
    assert values(held) == before == values(table.read())
    assert table.compact(before="2024-01-05") == []
    table.append(rows(spark, ("new", 1, "2024-01-01")), "w", 20)
    assert table.compact() == ["2024-01-01", "2024-01-09"]
    assert table.vacuum(keep=1) == 42
    assert len(files_of(folder("t"), "2024-01-01")) == len(files_of(folder("t"), "2024-01-09")) == 1
    assert values(table.read()) == sorted([*before, *values(rows(spark, ("new", 1, "2024-01-01")))])
    assert not table.log.numbers()[0] == 1
    assert not table.append(rows(spark, ("again", 1, "2024-01-01")), "w", 20) > table.version()
    assert table.read().where("id = 'again'").count() == 0


def test_what_comes_during_a_compaction_stays(spark, folder, monkeypatch):
    table, other = (LoggedTable(spark, folder("t"), ROW, ["id"]) for _ in range(2))
    for n in range(3):
        table.append(rows(spark, ("a", n, "2024-01-01"), ("a", n, "2024-01-02")))
    write = table._write

    def meanwhile(frame):
        written = write(frame)
        other.append(rows(spark, ("late", 9, "2024-01-01")))
        other.compact(days=["2024-01-02"])
        return written

    monkeypatch.setattr(table, "_write", meanwhile)
    assert table.compact() == ["2024-01-01"]
    assert values(other.read(), "id", "n") == sorted([("a", n) for n in range(3)] * 2 + [("late", 9)])


def merged(spark, folder):
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("n", T.LongType())])
    return MergedTable(spark, folder("m"), schema, keys=["id"], order=["id"])


def changes(spark, *data):
    """(id, n, version, gone)."""
    frame = spark.createDataFrame(data, "id STRING, n BIGINT, version DOUBLE, gone BOOLEAN")
    return frame.withColumn("date", day_of_key())


def test_day_of_key(spark):
    ids = ["86400.5-AB1", "x-1", None, "1e300-A", "0-A-B"]
    frame = spark.createDataFrame([(i,) for i in ids], "id STRING").select("id", day_of_key().cast("string"))
    assert dict(map(tuple, frame.collect())) == {
        "86400.5-AB1": "1970-01-02", "x-1": None, None: None, "1e300-A": None, "0-A-B": "1970-01-01",
    }


def test_newest_version_wins_before_and_after_compaction(spark, folder):
    table = merged(spark, folder)
    table.append(changes(spark, ("1-A", 1, 1.0, False), ("1-B", 1, 1.0, False), ("90000-C", 1, 5.0, False)))
    table.append(changes(spark, ("1-A", 2, 2.0, False), ("1-B", None, 3.0, True), ("x", 1, None, False)))
    table.append(changes(spark, ("1-A", 9, 1.5, False), ("90000-C", 1, 5.0, False)))
    expected = [("1-A", 2), ("90000-C", 1), ("x", 1)]
    assert values(table.read(), "id", "n") == expected
    table.compact(before="1970-01-02")
    assert values(table.read(), "id", "n") == expected
    # An older version that comes after the compaction, also of a row that is gone.
    table.append(changes(spark, ("1-B", 7, 2.0, False), ("1-A", 7, 1.9, False)))
    assert values(table.read(), "id", "n") == expected
    table.compact()
    assert values(table.read(), "id", "n") == expected
    table.append(changes(spark, ("1-B", 8, 4.0, False)))
    assert values(table.read(), "id", "n") == sorted([*expected, ("1-B", 8)])


def test_days_without_changes_are_only_scanned(spark, folder):
    table = merged(spark, folder)
    table.append(changes(spark, ("1-A", 1, 1.0, False), ("90000-C", 1, 5.0, False)))
    assert "Window" in plan(table.read())
    table.compact()
    assert "Window" not in plan(table.read()) and "Exchange" not in plan(table.read())
    table.append(changes(spark, ("90000-C", 2, 6.0, False)))
    assert "Window" not in plan(table.read(days=["1970-01-01"]))
    names = table.state().days["1970-01-01"]
    table.compact()
    assert table.state().days["1970-01-01"] == names


DOCUMENT = {f.name: None for f in FLIGHT_RAW.fields}


def feed(spark, folder, *documents):
    frame = spark.createDataFrame([tuple((DOCUMENT | d).values()) for d in documents], FLIGHT_RAW)
    frame.coalesce(1).write.mode("append").parquet(folder("raw"))


def run(spark, folder, table):
    out = [folder(n) for n in ("rejects", "metric", "cp")]
    source = flight_source.flights_changes(spark, folder("raw"))
    streams.merge_changes(source, table, *out).awaitTermination()


def document(number, version, **fields):
    return {
        "id": f"{number}-AB1", "flight": "AB1", "Timestamp": float(number), "lat": 1.0, "lon": 2.0,
        "ingest_ts": version, **fields,
    }


def test_change_feed_with_updates(spark, folder):
    """A, B, then A again long after, a new version of B, and one of A without a position."""
    table = MergedTable(spark, folder("enriched"), FLIGHT, order=["flight", "Timestamp"])
    feed(spark, folder, document(100, 5, gs=1.0), document(200, 5, gs=1.0))
    run(spark, folder, table)
    feed(spark, folder, document(100, 5, gs=1.0), document(200, 6, gs=2.0), document(200, 4, gs=3.0))
    run(spark, folder, table)
    point = F.col("location.coordinates").alias("p")
    assert values(table.read(), "id", "gs", point) == [
        ("100-AB1", 1.0, [2.0, 1.0]), ("200-AB1", 2.0, [2.0, 1.0]),
    ]
    feed(spark, folder, document(100, 7, lat=None), document(200, 5, gs=9.0))
    run(spark, folder, table)
    assert values(table.read(), "id", "gs") == [("200-AB1", 2.0)]
    # The last batch once more, as after a crash.
    for name in ("2", ".2.crc"):
        if os.path.exists(folder("cp", "commits", name)):
            os.remove(folder("cp", "commits", name))
    run(spark, folder, table)
    assert table.version() == 3
    table.compact()
    assert values(table.read(), "id", "gs") == [("200-AB1", 2.0)]


def test_appending_feed_leaves_late_copies_out(spark, folder):
    """Copies that come after the stream forgot their ids."""
    out = [folder(n) for n in ("enriched", "rejects", "metric")]
    for n in range(2):
        feed(spark, folder, document(100, 5), document(200 + n, 5))
        source = flight_source.flights_changes(spark, folder("raw"))
        streams.enrich_changes(source, *out, folder(f"cp-{n}")).awaitTermination()
        # A new checkpoint forgets all; it numbers its batches anew, so what is there moves on.
        os.rename(folder("enriched", "batch_id=0"), folder("enriched", f"batch_id={10 + n}"))
    stored = spark.read.schema(FLIGHT).parquet(out[0])
    assert values(stored, "id") == [("100-AB1",), ("200-AB1",), ("201-AB1",)]


def test_two_publishers_lose_no_update(spark, folder):
    table = VersionedTable(spark, folder("spotter"))
    meet = threading.Barrier(2)
    failed = []

    def work(name):
        first = True

        def change(old):
            nonlocal first
            if first:
                first = False
                meet.wait(60)  # both have begun from the same version
            return old.unionByName(spark.createDataFrame([(name, 1)], ROW))

        try:
            VersionedTable(spark, folder("spotter")).update(change, ROW)
        except Exception as error:
            failed.append(error)

    threads = [threading.Thread(target=work, args=(n,)) for n in ("a", "b")]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert not failed and table.version() == 2
    assert values(table.read(ROW), "id") == [("a",), ("b",)]
    assert len(os.listdir(folder("spotter", "data"))) == 2
    assert table.vacuum(keep=1) == 1 and len(os.listdir(folder("spotter", "data"))) == 1
    assert values(table.read(ROW), "id") == [("a",), ("b",)]


def test_windows_add_up_whenever_rows_come(spark, folder):
    """Late rows and clocks ahead change their own window and no other."""
    table = WindowTable(spark, folder("windows"))
    times = [[1000.0, 1010.0], [4e9], [1300.0], [1001.0, 1290.0], [90000.0], [1002.0]]
    for i, nows in enumerate(times):
        drop(folder("in"), str(i), [snapshot(now, "AB1") for now in nows], 1000 + i)
    for _ in range(2):
        stream = source.stream_snapshots(spark, folder("in"), max_files_per_trigger=2)
        streams.merge_nearby_stream(stream, table, folder("cp")).awaitTermination()
    batch = source.usable(source.read_snapshots(spark, folder("in")))
    expected = window_rows(nearby(batch))
    assert window_rows(table.read()) == expected and len(expected) == 4
    assert table.compact(before="1970-01-02") == ["1970-01-01"]
    assert window_rows(table.read()) == expected
    assert "Aggregate" not in plan(table.read(days=["1970-01-01"]))
    drop(folder("in"), "late", [snapshot(1003.0, "AB1", "CD2")], 2000)
    stream = source.stream_snapshots(spark, folder("in"))
    streams.merge_nearby_stream(stream, table, folder("cp")).awaitTermination()
    batch = source.usable(source.read_snapshots(spark, folder("in")))
    assert window_rows(table.read()) == window_rows(nearby(batch))
