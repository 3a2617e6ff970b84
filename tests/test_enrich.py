import pytest
from pyspark.sql import functions as F

from skytally.operators import enrich, filters, upsert
from skytally.plans import enrichment
from skytally.schemas import FLIGHT, FLIGHT_RAW
from skytally.sinks.logged import LoggedTable, day_of_key
from tests.conftest import plan, values

COLUMNS = "id STRING, flight STRING, Timestamp STRING, lat DOUBLE, lon DOUBLE, hex STRING, ingest_ts BIGINT"


@pytest.fixture
def raw(spark):
    return spark.createDataFrame(
        [
            ("1", "A", "100.5", 1.0, 2.0, "h", 10),
            ("2", "A", "1970-01-01T00:05:00Z", 3.0, 4.0, "h", 10),
            ("3", "B", "junk", 5.0, 6.0, "h", 10),
            ("4", "B", "300", None, 6.0, "h", 10),
            ("5", "C", "400", 7.0, 8.0, "h", 9000),
            ("6", "C", "500", -7.0, 8.0, "h", 10),
        ],
        COLUMNS,
    )


def flat(frame):
    point = F.to_json(F.struct("location.type", "location.coordinates"))
    return values(frame, "id", F.col("Timestamp").cast("string"), point)


def test_enrich_and_its_rejects(raw):
    done = enrich.enrich(raw)
    assert "lat" not in done.columns and "lon" not in done.columns
    assert flat(done.where("flight = 'A'")) == [
        ("1", "100.500000", '{"type":"Point","coordinates":[2.0,1.0]}'),
        ("2", "300.000000", '{"type":"Point","coordinates":[4.0,3.0]}'),
    ]
    assert values(done, "id") == [("1",), ("2",), ("5",), ("6",)]
    assert values(enrich.enrich_rejects(raw), "id", "Timestamp") == [("3", "junk")]


def test_patching_in_place_touches_only_what_needs_it(raw):
    once = enrich.patch_locations(raw)
    assert once.count() == 6
    rows = {r["id"]: r for r in once.collect()}
    assert rows["2"]["Timestamp"] == "300" and rows["2"]["lat"] is None
    assert rows["2"]["location"]["coordinates"] == [4.0, 3.0]
    assert rows["3"]["Timestamp"] == "junk" and rows["3"]["lat"] == 5.0
    assert rows["4"]["lon"] == 6.0 and rows["4"]["location"] is None


def test_patching_is_idempotent(raw):
    once = enrich.patch_locations(raw)
    assert flat(enrich.patch_locations(once)) == flat(once)
    assert enrich.enrich(once).count() == 0


def test_patching_keeps_a_numeric_timestamp_type(raw):
    numbers = raw.withColumn("Timestamp", F.lit(1634905178.5))
    patched = enrich.patch_locations(numbers)
    assert patched.schema["Timestamp"].dataType.simpleString() == "double"
    assert enrich.enrich(numbers).schema["Timestamp"].dataType.simpleString() == "decimal(20,6)"


def test_backfill_handles_what_is_due(raw):
    patched, metric = enrichment.backfill_locations(raw, as_of=8000)
    with_point = patched.where("location is not null")
    assert values(with_point, "id") == [("1",), ("2",)]
    assert values(metric) == [("A", 2)]
    patched, metric = enrichment.backfill_locations(raw, as_of=8000, hemisphere_safe=True)
    assert values(metric) == [("A", 2), ("C", 1)]


def test_backfill_increment_can_be_repeated(raw):
    stored = enrich.enrich(raw.where("id = '1'"))
    added, rejects = enrichment.backfill_missing(raw, stored, as_of=8000)
    assert values(added, "id") == [("2",)] and values(rejects, "id") == [("3",)]
    stored = stored.unionByName(added)
    assert enrichment.backfill_missing(raw, stored, as_of=8000)[0].count() == 0


def test_increment_since_goes_by_when_documents_were_stored(spark):
    raw = spark.createDataFrame(
        [
            ("1", "A", "1/10/2024 10:00:00", 1.0, 2.0, "h", 50),
            ("2", "A", "2000-01-10T10:00:00Z", 3.0, 4.0, "h", 50),
            ("3", "B", "junk", 5.0, 6.0, "h", 50),
            ("4", "B", "2024-01-10T10:00:00Z", 5.0, 6.0, "h", 40),
        ],
        COLUMNS,
    )
    added, rejects = enrichment.backfill_missing(
        raw, enrich.enrich(raw.where("false")), as_of=8000, since=50
    )
    assert values(added, "id") == [("1",), ("2",)] and values(rejects, "id") == [("3",)]


def test_times_of_any_type_are_compared_alike(spark):
    texts = ["1/10/2024 10:00:00", "2000-01-10T10:00:00Z", "junk", "1704844801.5", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "id INT, Timestamp STRING")
    seconds = rows.withColumn("Timestamp", enrich.seconds_of(rows))
    for some in (rows, seconds, seconds.withColumn("Timestamp", F.col("Timestamp").cast("double"))):
        assert values(filters.time_after(some, 1704844800), "id") == [(0,), (3,)]
        assert values(filters.time_between(some, 0, 1704844802), "id") == [(1,), (3,)]
        assert values(filters.time_eq(some, 1704844801.5), "id") == [(3,)]


def test_view_keeps_what_pending_documents_hold(raw):
    whole = enrichment.flights_view(raw, enrich.enrich(raw.where("id = '1'")))
    rows = {r.id: r for r in whole.collect()}
    assert (rows["1"].lat, rows["1"].timestamp_text) == (None, None)
    assert (rows["3"].lat, rows["3"].Timestamp, rows["3"].timestamp_text) == (5.0, None, "junk")
    assert float(rows["2"].Timestamp) == 300 and rows["2"].timestamp_text.startswith("1970")


def test_view_holds_every_document_once(raw):
    for some in (raw, raw.withColumn("Timestamp", F.lit(5.0))):
        whole = enrichment.flights_view(some, enrich.enrich(some.where("id = '1'")))
        assert values(whole, "id", F.col("location").isNotNull()) == [
            ("1", True), ("2", False), ("3", False), ("4", False), ("5", False), ("6", False),
        ]


def test_upsert_replaces_and_adds(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2)], "id STRING, n INT")
    updates = spark.createDataFrame([("b", 3), ("b", 4), ("c", 5)], "id STRING, n INT")
    got = upsert.upsert_by_key(target, updates, order=[F.desc("n")])
    assert values(got) == [("a", 1), ("b", 4), ("c", 5)]
    assert values(upsert.upsert_by_key(got, updates, order=[F.desc("n")])) == values(got)


def test_upsert_with_null_keys_can_be_repeated(spark):
    target = spark.createDataFrame([(None, 1), ("b", 2)], "id STRING, n INT")
    updates = spark.createDataFrame([(None, 3), (None, 9)], "id STRING, n INT")
    for _ in range(3):
        target = upsert.upsert_by_key(target, updates, order=[F.desc("n")])
        assert values(target) == [("b", 2), (None, 9)]


def test_patch_changes_only_named_fields(spark):
    rows = spark.createDataFrame(
        [("1", "A", 1, "x"), ("2", "A", 2, None), ("3", "B", 3, "z")],
        "id STRING, flight STRING, n INT, t STRING",
    )
    patches = spark.createDataFrame(
        [("1", "A", None, 9), ("2", "A", "y", 8), ("3", "A", "no", 7), ("9", "Z", "no", 6)],
        "id STRING, flight STRING, t STRING, new INT",
    )
    got = upsert.patch_by_key(rows, patches, remove=["n"])
    assert got.columns == ["id", "flight", "n", "t", "new"]
    assert values(got) == [
        ("1", "A", None, None, 9), ("2", "A", None, "y", 8), ("3", "B", 3, "z", None),
    ]


def test_keep_one_is_settled_by_order(spark):
    rows = spark.createDataFrame([("k", i) for i in range(1000)] + [("j", 5)], "id STRING, n INT")
    assert values(upsert.keep_one(rows.repartition(8), ["id"], ["n"])) == [("j", 5), ("k", 0)]


def test_closed_days_are_the_enriched_table_alone(spark, folder):
    raw = LoggedTable(spark, folder("raw"), FLIGHT_RAW, ["flight"])
    done = LoggedTable(spark, folder("enriched"), FLIGHT, ["flight"])
    closed = enrichment.ClosedDays(raw, done, folder("closed"))
    empty = {f.name: None for f in FLIGHT_RAW.fields}

    def documents(*times, **fields):
        rows = [
            tuple((empty | {"id": f"{t}-A", "flight": "A", "Timestamp": float(t), "lat": 1.0, "lon": 2.0,
                            "ingest_ts": 5} | fields).values())
            for t in times
        ]
        return spark.createDataFrame(rows, FLIGHT_RAW).withColumn("date", day_of_key())

    raw.append(documents(10, 20, 86410, 172810))
    done.append(enrich.enrich(documents(10, 20, 172810)))
    assert closed.close(before="1970-01-03") == ["1970-01-01"] and closed.close(before="1970-01-03") == []
    assert closed.split() == (["1970-01-01"], ["1970-01-02", "1970-01-03"])
    seen = lambda **how: values(closed.view(**how), "id", "gs", F.col("location").isNotNull())
    day = {"days": ["1970-01-01"]}
    assert seen(**day) == [("10-A", None, True), ("20-A", None, True)]
    text = plan(closed.view(**day))
    assert "raw" not in text and "Join" not in text and "Window" not in text
    # A changed pending document shows once, as it is now.
    raw.append(documents(86410, gs=3.0, ingest_ts=6))
    # A document that comes later opens its day.
    raw.append(documents(30))
    assert closed.split()[0] == []
    assert seen() == [
        ("10-A", None, True), ("172810-A", None, True), ("20-A", None, True), ("30-A", None, False),
        ("86410-A", 3.0, False),
    ]
    done.append(enrich.enrich(documents(30)))
    assert closed.close(before="1970-01-05") == ["1970-01-01", "1970-01-03"]
    assert closed.split()[1] == ["1970-01-02"]
