"""Every operator as a query over the given tables: ``(spark, sf_dir) -> DataFrame``.

Results hold text and numbers only; times come as epoch numbers and distances that are
not rounded by the operator itself are rounded to millimetres.
"""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytally.catalog import samples as s
from skytally.functions import geo, text, timeconv
from skytally.operators import aggregates, enrich, filters, flatten, ordered, reports, upsert
from skytally.plans import enrichment, ingest, live, rollup
from skytally.schemas import DISTINCT_FLIGHT, FLIGHT, FLIGHT_RAW
from skytally.session import configure, scratch_dir
from skytally.sinks import logged, tables
from skytally.sources import flights as flight_source
from skytally.sources import snapshots as snapshot_source
from skytally.streaming import queries as streams

QUERIES = {}
HOME = (geo.HOME_LAT, geo.HOME_LON)
CLOSEST = aggregates.CLOSEST
DISTANCE = flatten.DISTANCE


def query(name):
    def register(function):
        def run(spark, sf_dir):
            return function(configure(spark), sf_dir)

        QUERIES[name] = run
        return function

    return register


def _mm(column):
    return F.round(column, 3).alias(column)


def _measured(rows, *columns):
    return rows.withColumns({c: F.round(c, 3) for c in columns})


def _epoch_us(rows, *columns):
    return rows.withColumns({c: F.unix_micros(c) for c in columns})


def _epoch(rows, *columns):
    return rows.withColumns({c: F.unix_seconds(c) for c in columns})


def _flat_point(rows):
    """The point as two columns, the decimal timestamp as a double."""
    coordinates = F.col("location.coordinates")
    rows = rows.withColumns({"p_lon": coordinates[0], "p_lat": coordinates[1]})
    return rows.withColumn("Timestamp", F.col("Timestamp").cast("double")).drop("location")


def _drain(*started):
    for one in started:
        one.awaitTermination()


def _json_folder(spark, snapshots):
    path = scratch_dir(spark, "snapshots")
    snapshots.write.json(path)
    return path


def _ordered_for_one(rows, order):
    """The rows in order, for one task to write: each range is sorted by itself, and the task goes
    through the sorted ranges one after the other."""
    return rows.orderBy(order).coalesce(1)


def _stored_flights(spark, sf_dir):
    path = scratch_dir(spark, "flights")
    tables.write_flights(s.sightings(spark, sf_dir), path, stored_at=F.floor("Timestamp"))
    return path


# Sources


def _snapshot_summary(parsed):
    good, _ = snapshot_source.split_rejects(parsed)
    return good.select("receiver", "arrival", "now", "messages", F.size("aircraft").alias("n"))


@query("read_snapshots")
def _(spark, d):
    path = _json_folder(spark, s.grouped_snapshots(spark, d))
    return _snapshot_summary(snapshot_source.read_snapshots(spark, path))


@query("stream_snapshots")
def _(spark, d):
    path = _json_folder(spark, s.grouped_snapshots(spark, d))
    out = scratch_dir(spark, "streamed")
    parsed = _snapshot_summary(snapshot_source.stream_snapshots(spark, path))
    _drain(
        parsed.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", f"{out}-checkpoint")
        .trigger(**streams.DRAIN)
        .start()
    )
    return spark.read.schema(parsed.schema).parquet(out)


@query("read_flights")
def _(spark, d):
    stored = flight_source.read_flights(spark, _stored_flights(spark, d), FLIGHT_RAW)
    return stored.select(*FLIGHT_RAW.names)


@query("flights_changes")
def _(spark, d):
    out = scratch_dir(spark, "changes")
    changes = flight_source.flights_changes(spark, _stored_flights(spark, d))
    _drain(
        changes.select(*FLIGHT_RAW.names)
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", f"{out}-checkpoint")
        .trigger(**streams.DRAIN)
        .start()
    )
    return spark.read.schema(FLIGHT_RAW).parquet(out)


@query("from_wire_message")
def _(spark, d):
    messages = snapshot_source.to_wire_message(s.spotter(spark, d))
    records = snapshot_source.from_wire_message(messages, DISTINCT_FLIGHT)
    return _measured(records, CLOSEST)


# Sinks


@query("write_aircraft")
def _(spark, d):
    path = scratch_dir(spark, "aircraft")
    sightings = s.sightings(spark, d)
    tables.write_aircraft(sightings, path)
    return spark.read.parquet(path).select(*flatten.AIRCRAFT_COLUMNS)


@query("write_nearby")
def _(spark, d):
    path = scratch_dir(spark, "nearby")
    tables.write_nearby(live.nearby(s.snapshots(spark, d)), path)
    return _epoch(spark.read.parquet(path).drop("date"), "FirstSeen", "LastSeen")


@query("write_flights")
def _(spark, d):
    stored = spark.read.parquet(_stored_flights(spark, d))
    return stored.withColumn("date", F.col("date").cast("string"))


@query("write_flights_twice")
def _(spark, d):
    """A run repeated adds nothing."""
    path = _stored_flights(spark, d)
    again = s.sightings(spark, d)
    tables.write_flights(again, path, stored_at=F.floor("Timestamp"))
    stored = spark.read.parquet(path)
    return stored.withColumn("date", F.col("date").cast("string"))


@query("compacted_flights")
def _(spark, d):
    """The documents a stream stored in batches, compacted between two of its runs."""
    out = scratch_dir(spark, "logged")
    wide = flatten.aircraft_rows(s.sightings(spark, d)).schema
    aircraft = logged.LoggedTable(spark, f"{out}/aircraft", wide, ["PartitionKey", "RowKey"])
    flights = logged.LoggedTable(spark, f"{out}/flights", FLIGHT_RAW, ["flight", "Timestamp", "id"])
    source = s.snapshots(spark, d)
    early = F.col("messages") % 3 == 0
    for part in (early, ~early):
        source.where(part).repartition(2).write.mode("append").json(f"{out}/snapshots")
        stream = snapshot_source.stream_snapshots(spark, f"{out}/snapshots", max_files_per_trigger=1)
        _drain(streams.write_sightings_stream(stream, aircraft, flights, f"{out}/checkpoint"))
        flights.compact(before="2024-01-25")
    return flights.read().select(*[c for c in FLIGHT_RAW.names if c != "ingest_ts"])


@query("upsert_by_key")
def _(spark, d):
    flights = s.flights(spark, d)
    earlier = aggregates.flight_rollup(filters.time_between(flights, 0, s.AS_OF))
    target = earlier.withColumn("id", F.concat("id", F.lit("-old"))).unionByName(earlier)
    return _measured(upsert.upsert_by_key(target, aggregates.flight_rollup(flights), order=["count"]), CLOSEST)


@query("patch_by_key")
def _(spark, d):
    documents = enrich.with_location(s.text_documents(spark, d))
    patches = enrich.enrich(documents).select(
        "id", "flight", "location", text.plain_number("Timestamp").alias("Timestamp")
    )
    patched = upsert.patch_by_key(documents, patches, remove=("lat", "lon"))
    return _patched(patched)


def _patched(documents):
    coordinates = F.col("location.coordinates")
    return documents.select(
        "id",
        "flight",
        "Timestamp",
        "lat",
        "lon",
        F.get(coordinates, F.lit(0)).alias("p_lon"),
        F.get(coordinates, F.lit(1)).alias("p_lat"),
        "ingest_ts",
    )


@query("fan_out_sinks")
def _(spark, d):
    out = scratch_dir(spark, "fan-out")
    source = s.snapshots(spark, d)
    path = _json_folder(spark, source.unionByName(s.closing_snapshot(source)))
    stream = snapshot_source.stream_snapshots(spark, path)
    _drain(
        *streams.fan_out_sinks(
            stream,
            f"{out}/aircraft",
            f"{out}/nearby",
            f"{out}/flights",
            f"{out}/checkpoint",
            max_ahead=None,  # arrival is no clock time here
        )
    )
    aircraft, near, flights = (
        spark.read.parquet(f"{out}/{name}") for name in ("aircraft", "nearby", "flights")
    )

    def rows(sink, frame, flight, at, detail):
        return frame.select(
            F.lit(sink).alias("sink"),
            F.col(flight).alias("flight"),
            at.cast("double").alias("at"),
            F.col(detail).cast("string").alias("detail"),
        )

    return (
        rows("aircraft", aircraft, "PartitionKey", F.col("RowKey"), "hex")
        .unionByName(rows("flights", flights, "flight", F.col("Timestamp"), "hex"))
        .unionByName(rows("nearby", near, "flight", F.unix_seconds("LastSeen"), "RecordCount"))
    )


# Projection, unnest, naming


@query("explode_aircraft")
def _(spark, d):
    rows = flatten.explode_aircraft(s.grouped_snapshots(spark, d))
    return rows.select("now", "arrival", "a.hex", "a.flight", "a.alt_baro", "a.track")


@query("flatten_aircraft")
def _(spark, d):
    rows = flatten.flatten_aircraft(flatten.explode_aircraft(s.snapshots(spark, d)))
    return rows.drop("receiver", "arrival", "messages")


@query("all_flights")
def _(spark, d):
    return _measured(flatten.all_flights(s.snapshots(spark, d)), DISTANCE)


@query("close_aircraft")
def _(spark, d):
    return _measured(flatten.close_aircraft(flatten.all_flights(s.snapshots(spark, d))), DISTANCE)


@query("aircraft_rows")
def _(spark, d):
    return flatten.aircraft_rows(s.sightings(spark, d))


@query("flight_documents")
def _(spark, d):
    return flatten.flight_documents(s.sightings(spark, d))


@query("one_per_callsign")
def _(spark, d):
    snapshots = flatten.one_per_callsign(s.grouped_snapshots(spark, d))
    return flatten.all_flights(snapshots).select("PartitionKey", "RowKey", "id", "hex")


@query("select_star")
def _(spark, d):
    return flatten.select_star(s.documents(spark, d), F.col("alt_baro") > 10000)


@query("const_columns")
def _(spark, d):
    ids = s.documents(spark, d).select("flight").distinct()
    return flatten.const_columns(ids, {"count": (0, "int"), "last_seen": (0, "double")})


@query("rename_keys")
def _(spark, d):
    rows = s.sightings(spark, d).select("PartitionKey", "RowKey", "hex")
    return flatten.rename_keys(rows, {"PartitionKey": "flight", "RowKey": "Timestamp"})


@query("envelope")
def _(spark, d):
    snapshots = s.polled_snapshots(spark, d)
    return ingest.forwarded(snapshots, unique_arrival=True).drop("aircraft", "messages")


# Filters


@query("dedupe_snapshots")
def _(spark, d):
    kept = ordered.dedupe_snapshots(s.polled_snapshots(spark, d))
    return kept.select("receiver", "arrival", "now", "messages")


@query("has_callsign")
def _(spark, d):
    return filters.has_callsign(s.reports(spark, d)).select("arrival", "flight", "hex")


@query("has_position")
def _(spark, d):
    return filters.has_position(s.reports(spark, d)).select("arrival", "lat", "lon")


@query("within_radius")
def _(spark, d):
    near = filters.within_radius(s.sightings(spark, d), 100, near=HOME)
    return near.select("id", "lat", "lon", _mm(DISTANCE))


@query("needs_location")
def _(spark, d):
    documents = s.text_documents(spark, d)
    half = enrich.patch_locations(documents, F.col("alt_baro") < 2000)
    return filters.needs_location(half).select("id", "flight", "Timestamp", "lat", "lon")


@query("unprocessed_flights")
def _(spark, d):
    documents = s.text_documents(spark, d)
    half = enrich.patch_locations(documents, F.col("alt_baro") < 2000)
    return filters.unprocessed_flights(half).select("id", "flight", "Timestamp", "lat", "lon")


@query("backfill_candidates")
def _(spark, d):
    due = filters.backfill_candidates(s.documents(spark, d), s.AS_OF)
    return due.select("id", "flight", "Timestamp", "lat", "lon", "ingest_ts")


@query("flight_eq")
def _(spark, d):
    return _flat_point(filters.flight_eq(s.flights(spark, d), s.FLIGHT))


@query("time_between")
def _(spark, d):
    return _flat_point(filters.time_between(s.flights(spark, d), s.RANGE_FROM, s.RANGE_TO))


@query("time_between_whole")
def _(spark, d):
    """Fractions as bounds of a column of whole seconds."""
    documents = s.documents(spark, d)
    inside = filters.time_between(documents, s.RANGE_FROM - 0.5, s.RANGE_TO + 0.5, "ingest_ts")
    return inside.select("id", "flight", "ingest_ts")


@query("time_after")
def _(spark, d):
    return _flat_point(filters.time_after(s.flights(spark, d), s.RANGE_FROM))


def _last_moment(flights):
    return flights.agg(F.max("Timestamp")).scalar()


@query("time_eq")
def _(spark, d):
    flights = s.flights(spark, d)
    return _flat_point(filters.time_eq(flights, _last_moment(flights)))


def _first_distance(flights):
    """How far the flight of the fixed inputs was when first seen."""
    one = filters.flight_eq(flights, s.FLIGHT)
    return one.agg(F.min_by(geo.st_distance_point(*HOME), "Timestamp")).scalar()


@query("distance_eq")
def _(spark, d):
    flights = s.flights(spark, d)
    there = filters.distance_eq(flights, *HOME, _first_distance(flights), tol=0.01)
    return _flat_point(there.select("id", "flight", "Timestamp", "location"))


def _by_place(spark, d):
    """Enriched documents, stored by day and place."""
    flights = enrich.with_cell(s.flights(spark, d)).withColumn("date", logged.day_of_key())
    schema = T.StructType([*FLIGHT.fields, T.StructField("cell", T.LongType())])
    table = logged.LoggedTable(spark, scratch_dir(spark, "by-place"), schema, ["cell"])
    table.append(flights)
    table.compact()
    return table.read()


@query("points_within")
def _(spark, d):
    near = filters.points_within(_by_place(spark, d), *HOME, 400)
    return near.select("id", "flight", F.round(geo.st_distance_point(*HOME), 3).alias("metres"))


@query("points_in_ring")
def _(spark, d):
    ring = filters.distance_eq(_by_place(spark, d), *HOME, 1000, tol=25)
    return ring.select("id", "flight", F.round(geo.st_distance_point(*HOME), 3).alias("metres"))


# Aggregates and distinct


@query("flight_rollup")
def _(spark, d):
    return _measured(s.spotter(spark, d), CLOSEST)


@query("flight_rollup_one")
def _(spark, d):
    return _measured(aggregates.flight_rollup_one(s.flights(spark, d), s.FLIGHT), CLOSEST)


@query("first_at_distance")
def _(spark, d):
    flights = s.flights(spark, d)
    there = aggregates.first_at_distance(flights, s.FLIGHT, _first_distance(flights), tol=0.01)
    coordinates = F.col("Location.coordinates")
    return there.select(
        "flight",
        F.col("TimeStamp").cast("double").alias("TimeStamp"),
        "alt_geom",
        coordinates[0].alias("p_lon"),
        coordinates[1].alias("p_lat"),
    )


@query("distinct_flights")
def _(spark, d):
    return aggregates.distinct_flights(s.documents(spark, d))


@query("distinct_flights_at")
def _(spark, d):
    flights = s.flights(spark, d)
    return aggregates.distinct_flights_at(flights, _last_moment(flights))


@query("nearby_windows_3m")
def _(spark, d):
    return _epoch(live.nearby(s.snapshots(spark, d)), "FirstSeen", "LastSeen")


@query("nearby_windows_1d")
def _(spark, d):
    return _epoch(live.nearby(s.snapshots(spark, d), "1 day"), "FirstSeen", "LastSeen")


@query("flight_metric")
def _(spark, d):
    return aggregates.flight_metric(enrich.enrich(s.text_documents(spark, d)))


@query("batch_size_metric")
def _(spark, d):
    due = filters.backfill_candidates(s.documents(spark, d), s.AS_OF)
    rows, seen = aggregates.batch_size_metric(due)
    rows.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([("fetched", seen.get["rows"])], "metric STRING, n BIGINT")


# Sort, limit, top-k


@query("seen_within_radius")
def _(spark, d):
    return _epoch_us(_measured(reports.seen_within_radius(s.spotter(spark, d)), CLOSEST), "last_seen")


@query("closest_10")
def _(spark, d):
    return _epoch_us(reports.closest_10(s.spotter(spark, d)), "last_seen_utc")


@query("within_100m")
def _(spark, d):
    return _epoch_us(reports.within_100m(s.spotter(spark, d)), "last_seen_utc")


@query("flight_log")
def _(spark, d):
    return _epoch_us(reports.flight_log(s.flights(spark, d)), "Timestamp")


# Geospatial


def _placed(spark, d):
    """Every report with a position, callsign or not."""
    return filters.has_position(s.reports(spark, d)).select("arrival", "lat", "lon")


@query("st_distance")
def _(spark, d):
    metres = geo.st_distance(*HOME, "lat", "lon")
    return s.reports(spark, d).select("arrival", F.round(metres, 3).alias("metres"))


@query("st_distance_wgs84")
def _(spark, d):
    metres = geo.st_distance(*HOME, "lat", "lon", model="wgs84")
    return s.reports(spark, d).select("arrival", F.round(metres, 3).alias("metres"))


@query("st_distance_geodesic")
def _(spark, d):
    metres = geo.st_distance(*HOME, "lat", "lon", model="geodesic")
    return s.reports(spark, d).select("arrival", F.round(metres, 2).alias("metres"))


@query("create_point")
def _(spark, d):
    points = _placed(spark, d).withColumn("p", geo.create_point("lat", "lon"))
    metres = geo.st_distance_points(F.col("p"), geo.create_point(*HOME))
    return points.select("arrival", "p.lat", "p.lon", F.round(metres, 3).alias("metres"))


@query("geojson_point")
def _(spark, d):
    point = geo.geojson_point("lat", "lon")
    placed = _placed(spark, d).select("arrival", point.alias("p"))
    coordinates = F.col("p.coordinates")
    return placed.select(
        "arrival", "p.type", coordinates[0].alias("first"), coordinates[1].alias("second")
    )


@query("st_distance_point")
def _(spark, d):
    flights = s.flights(spark, d)
    return flights.select("id", F.round(geo.st_distance_point(*HOME), 3).alias("metres"))


# Text and numbers


@query("clean_callsign")
def _(spark, d):
    return s.reports(spark, d).select("arrival", text.clean_callsign("flight").alias("callsign"))


@query("str_len")
def _(spark, d):
    padded, cut = text.str_len("flight"), text.str_len(text.clean_callsign("flight"))
    return s.reports(spark, d).select("arrival", padded.alias("padded"), cut.alias("cut"))


@query("sighting_id")
def _(spark, d):
    return s.reports(spark, d).select("arrival", text.sighting_id("now", "flight").alias("id"))


@query("squawk_num")
def _(spark, d):
    events = s.events(spark, d)
    code = F.when(F.col("event_type") == "signup", "n/a").otherwise(
        F.lpad(F.get_json_object("props", "$.k"), 4, "0")
    )
    return events.select("event_id", code.alias("code")).select(
        "event_id", "code", text.squawk_num("code").alias("squawk")
    )


@query("round_metres")
def _(spark, d):
    value = F.col("value") * F.when(F.col("event_id") % 2 == 0, -0.5).otherwise(0.5)
    return s.events(spark, d).select("event_id", text.round_metres(value).alias("rounded"))


@query("scale_ms")
def _(spark, d):
    ms, back = timeconv.scale_ms("now"), timeconv.scale_ms("now", to="s")
    return s.snapshots(spark, d).select("arrival", ms.alias("ms"), back.alias("s"))


@query("parse_number")
def _(spark, d):
    number = text.parse_number("Timestamp").cast("double")
    return s.text_documents(spark, d).select("id", "Timestamp", number.alias("number"))


@query("numeric_timestamp")
def _(spark, d):
    number = timeconv.numeric_timestamp("Timestamp").cast("double")
    return s.text_documents(spark, d).select("id", "Timestamp", number.alias("seconds"))


# Dates and times


@query("event_time")
def _(spark, d):
    moment = timeconv.event_time("now")
    return s.snapshots(spark, d).select("arrival", F.unix_micros(moment).alias("us"))


@query("to_datetime")
def _(spark, d):
    moment = timeconv.to_datetime("now")
    return s.snapshots(spark, d).select("arrival", F.unix_micros(moment).alias("us"))


def _moments(spark, d):
    """The time of each event as a timestamp."""
    return s.events(spark, d).select("event_id", F.col("ts").cast("timestamp").alias("moment"))


@query("to_epoch_ms")
def _(spark, d):
    return _moments(spark, d).select("event_id", timeconv.to_epoch_ms("moment").alias("ms"))


@query("date_add_part")
def _(spark, d):
    moved = {
        "two_hours_before": timeconv.date_add_part("hh", -2, "moment"),
        "three_minutes_before": timeconv.date_add_part("minute", -3, "moment"),
        "ninety_seconds_after": timeconv.date_add_part("second", 90, "moment"),
    }
    rows = _moments(spark, d)
    return rows.select("event_id", *[F.unix_micros(m).alias(name) for name, m in moved.items()])


@query("now_fn")
def _(spark, d):
    now = F.unix_micros(timeconv.now_fn("moment"))
    ahead = timeconv.now_fn() > F.col("moment")
    return _moments(spark, d).select("event_id", now.alias("us"), ahead.alias("past"))


@query("ago_epoch")
def _(spark, d):
    return _moments(spark, d).select(
        "event_id",
        timeconv.ago_epoch("hh", 2, "moment").alias("two_hours_ago"),
        timeconv.ago_epoch("minute", 2, "moment").alias("two_minutes_ago"),
        timeconv.ago_epoch("minute", 3, "moment").alias("three_minutes_ago"),
    )


@query("recent_flights")
def _(spark, d):
    return _flat_point(reports.recent_flights(s.flights(spark, d), s.AS_OF, 2 * 86400, 3600))


# Jobs and streams


@query("with_event_time")
def _(spark, d):
    timed = flatten.with_event_time(s.snapshots(spark, d), "30 seconds")
    return timed.select("arrival", F.unix_seconds("event_ts").alias("event_ts"))


@query("partition_by_flight")
def _(spark, d):
    return tables.partition_by_flight(flatten.flight_documents(s.sightings(spark, d)))


@query("enrich_locations")
def _(spark, d):
    patched, _ = enrichment.backfill_locations(s.text_documents(spark, d), s.AS_OF)
    return _patched(patched)


@query("backfill_missing")
def _(spark, d):
    raw = s.text_documents(spark, d)
    enriched = enrich.enrich(raw.where(F.col("alt_baro") < 2000))
    added, _ = enrichment.backfill_missing(raw, enriched, s.AS_OF)
    return _flat_point(added.select("id", "flight", "Timestamp", "location"))


@query("backfill_since")
def _(spark, d):
    """The increment over what was stored since a time, with its rejects."""
    raw = s.text_documents(spark, d)
    enriched = enrich.enrich(raw.where(F.col("alt_baro") < 2000))
    added, rejects = enrichment.backfill_missing(raw, enriched, s.AS_OF, since=s.RANGE_FROM)
    return _with_rejects(added, rejects)


def _with_rejects(done, rejects):
    seconds = F.col("Timestamp").cast("double").alias("seconds")
    text = F.col("Timestamp").alias("rejected")
    return done.select("id", "flight", seconds, F.lit(None).cast("string").alias("rejected")).unionByName(
        rejects.select("id", "flight", F.lit(None).cast("double").alias("seconds"), text)
    )


@query("flights_view")
def _(spark, d):
    raw = s.text_documents(spark, d)
    enriched = enrich.enrich(raw.where(F.col("alt_baro") < 2000))
    whole = enrichment.flights_view(raw, enriched)
    point = F.col("location.coordinates")
    return whole.select(
        "id",
        "flight",
        F.col("Timestamp").cast("double").alias("Timestamp"),
        "lat",
        "lon",
        F.get(point, F.lit(0)).alias("p_lon"),
        F.get(point, F.lit(1)).alias("p_lat"),
        "timestamp_text",
    )


@query("flights_view_by_day")
def _(spark, d):
    """The same view over logged tables: days before a date are enriched and closed, later ones
    have pending documents, and one closed day gets a document again."""
    out = scratch_dir(spark, "by-day")
    raw = logged.LoggedTable(spark, f"{out}/raw", FLIGHT_RAW, ["flight"])
    done = logged.LoggedTable(spark, f"{out}/enriched", FLIGHT, ["flight"])
    documents = s.documents(spark, d).withColumn("date", logged.day_of_key())
    first = F.col("Timestamp") == documents.agg(F.min("Timestamp")).scalar()
    raw.append(documents.where(~first))
    due = (F.col("date") < "2024-01-15") | (F.col("alt_baro") < 2000)
    done.append(enrich.enrich(documents.where(~first & due)))
    closed = enrichment.ClosedDays(raw, done, f"{out}/closed")
    closed.close(before="2024-01-20")
    raw.append(documents.where(first))
    point = F.col("location.coordinates")
    return closed.view().select(
        "id",
        "flight",
        F.col("Timestamp").cast("double").alias("Timestamp"),
        "lat",
        "lon",
        F.get(point, F.lit(0)).alias("p_lon"),
        F.get(point, F.lit(1)).alias("p_lat"),
    )


@query("refresh_flight_spotter")
def _(spark, d):
    table = tables.VersionedTable(spark, scratch_dir(spark, "spotter"))
    flights = s.flights(spark, d)
    earlier = aggregates.flight_rollup(filters.time_between(flights, 0, s.AS_OF))
    gone = earlier.withColumn("id", F.concat("id", F.lit("-old")))
    table.publish(earlier.unionByName(gone))
    rollup.publish_flight_spotter(flights, table)
    return _measured(table.read(DISTINCT_FLIGHT), CLOSEST)


@query("refresh_days")
def _(spark, d):
    """Daily rollups stored in two goes, one day of them twice, then combined."""
    out = scratch_dir(spark, "days")
    flights = s.flights(spark, d)
    flights = flights.withColumn("date", F.to_date(F.timestamp_seconds("Timestamp")))
    middle = F.to_date(F.timestamp_seconds(F.lit(s.AS_OF)))
    rollup.refresh_days(flights, out, F.col("date") <= middle)
    rollup.refresh_days(flights, out, F.col("date") >= middle)
    return _measured(rollup.combine_days(spark.read.parquet(out)), CLOSEST)


def _landed(path, spark):
    columns = "receiver STRING, arrival DOUBLE, now DOUBLE, MessageCount STRING, TimeStamp STRING,"
    columns += " CountOfAircraft STRING, SequenceNumber STRING"
    landed = spark.read.schema(columns).parquet(path)
    return landed.drop("batch_id")


@query("ingest_snapshots")
def _(spark, d):
    path = _json_folder(spark, s.polled_snapshots(spark, d))
    out = scratch_dir(spark, "landing")
    parsed = snapshot_source.read_snapshots(spark, path)
    ingest.ingest_snapshots(parsed, out, f"{out}-rejects", unique_arrival=True)
    return _landed(out, spark)


@query("ingest_twice")
def _(spark, d):
    """Two runs over snapshots that overlap land what one run over all of them lands."""
    polled = s.polled_snapshots(spark, d)
    half = polled.agg(F.max("arrival")).scalar() / 2
    out = scratch_dir(spark, "landing")
    for part in (F.col("arrival") <= half, F.col("arrival") >= half * 0.8):
        path = _json_folder(spark, polled.where(part))
        parsed = snapshot_source.read_snapshots(spark, path)
        ingest.ingest_snapshots(parsed, out, f"{out}-rejects", unique_arrival=True)
    return _landed(out, spark)


@query("ingest_rejects")
def _(spark, d):
    """What ingest sets aside, with its content; a bad field alone rejects nothing."""
    kind = F.col("arrival").cast("bigint") % 50
    polled = s.polled_snapshots(spark, d)
    odd = polled.withColumns(
        {
            "now": F.when(kind == 0, None).when(kind == 1, F.lit(1.7e15)).otherwise(F.col("now")),
            "aircraft": F.when(kind != 2, F.col("aircraft")),
        }
    )
    text = F.to_json(F.struct(*polled.columns))
    text = F.when(kind == 3, "{broken").when(kind == 4, F.regexp_replace(text, '"gs":[^,}]*', '"gs":"?"'))
    lines = odd.select(F.coalesce(text, F.to_json(F.struct(*polled.columns))).alias("value"))
    path, out = scratch_dir(spark, "snapshots"), scratch_dir(spark, "landing")
    lines.write.text(path)
    ingest.ingest_snapshots(snapshot_source.read_snapshots(spark, path), out, f"{out}-rejects")
    columns = "receiver STRING, arrival DOUBLE, now DOUBLE, messages BIGINT, _corrupt STRING,"
    rejects = spark.read.schema(columns + " aircraft ARRAY<STRING>, reason STRING").json(f"{out}-rejects")
    parsed = F.col("_corrupt").isNull()
    return rejects.select(
        "receiver",
        F.when(parsed, F.col("arrival")).alias("arrival"),
        "now",
        "messages",
        F.when(F.col("aircraft").isNotNull(), F.size("aircraft")).alias("n"),
        "reason",
        "_corrupt",
    )


@query("stream_ingest")
def _(spark, d):
    path = _json_folder(spark, s.polled_snapshots(spark, d))
    out = scratch_dir(spark, "landing")
    parsed = snapshot_source.stream_snapshots(spark, path)
    _drain(
        streams.ingest_stream(parsed, out, f"{out}-rejects", f"{out}-state", f"{out}-checkpoint")
    )
    return _landed(out, spark)


@query("stream_nearby_windows")
def _(spark, d):
    out = scratch_dir(spark, "nearby")
    source = s.snapshots(spark, d)
    path = _json_folder(spark, source.unionByName(s.closing_snapshot(source)))
    stream = snapshot_source.stream_snapshots(spark, path)
    _drain(streams.write_nearby_stream(stream, out, f"{out}-checkpoint", max_ahead=None))
    return _epoch(spark.read.parquet(out), "FirstSeen", "LastSeen")


@query("merged_nearby")
def _(spark, d):
    """Windows added up from batches in no order of time, some days compacted in between."""
    out = scratch_dir(spark, "windows")
    table = logged.WindowTable(spark, f"{out}/windows")
    source = s.snapshots(spark, d)
    late = F.col("messages") % 3 == 0
    for part in (~late, late):
        source.where(part).repartition(2).write.mode("append").json(f"{out}/snapshots")
        stream = snapshot_source.stream_snapshots(spark, f"{out}/snapshots", max_files_per_trigger=1)
        _drain(streams.merge_nearby_stream(stream, table, f"{out}/checkpoint"))
        table.compact(before="2024-01-15")
    return _epoch(table.read(), "FirstSeen", "LastSeen")


@query("stream_ingest_in_order")
def _(spark, d):
    """Snapshots without arrivals in one file of many lines, as a stream."""
    path, out = scratch_dir(spark, "snapshots"), scratch_dir(spark, "landing")
    polled = s.polled_snapshots(spark, d)
    without = [c for c in polled.columns if c != "arrival"]
    lines = polled.select("arrival", F.to_json(F.struct(*without)).alias("value"))
    # Made in many tasks; one writes the file.
    _ordered_for_one(lines, "arrival").select("value").write.text(path)
    parsed = snapshot_source.stream_snapshots_in_order(spark, path)
    _drain(
        streams.ingest_stream(parsed, out, f"{out}-rejects", f"{out}-state", f"{out}-checkpoint")
    )
    return _landed(out, spark).drop("arrival")


@query("repaired_nearby")
def _(spark, d):
    """Windows that missed every third sighting, with all days from the middle on repaired
    and the days before it complete."""
    out = scratch_dir(spark, "nearby")
    source = s.snapshots(spark, d)
    middle = F.to_date(F.timestamp_seconds(F.lit(s.AS_OF)))
    early = F.to_date(F.timestamp_seconds("now")) < middle
    tables.write_nearby(live.nearby(source.where(early | (F.col("messages") % 3 == 0))), out)
    tables.write_aircraft(s.sightings(spark, d), f"{out}-aircraft")
    windows = spark.read.parquet(out).drop("date")
    whole = live.repaired_nearby(windows, spark.read.parquet(f"{out}-aircraft"), lambda day: day >= middle)
    return _epoch(whole, "FirstSeen", "LastSeen")


@query("stream_enrich")
def _(spark, d):
    out = scratch_dir(spark, "enriched")
    changes = flight_source.flights_changes(spark, _stored_flights(spark, d))
    _drain(
        streams.enrich_changes(
            changes, f"{out}/rows", f"{out}/rejects", f"{out}/metric", f"{out}/checkpoint"
        )
    )
    stored = spark.read.schema(FLIGHT).parquet(f"{out}/rows")
    return _flat_point(stored.select(*FLIGHT.names))


@query("stream_enrich_text")
def _(spark, d):
    """The change feed with timestamps as text; what cannot be read is set aside."""
    out, path = scratch_dir(spark, "enriched"), scratch_dir(spark, "flights")
    s.text_documents(spark, d).select(*FLIGHT_RAW.names).write.parquet(path)
    kept = [f for f in FLIGHT_RAW.fields if f.name != "Timestamp"]
    schema = T.StructType([*kept, T.StructField("Timestamp", T.StringType())])
    changes = flight_source.flights_changes(spark, path, schema)
    _drain(
        streams.enrich_changes(
            changes, f"{out}/rows", f"{out}/rejects", f"{out}/metric", f"{out}/checkpoint"
        )
    )
    stored = spark.read.schema(FLIGHT).parquet(f"{out}/rows")
    return _with_rejects(stored, spark.read.schema(schema).parquet(f"{out}/rejects"))


@query("stream_enrich_updates")
def _(spark, d):
    """A change feed with updates, documents that lose their position, and copies that come
    late, into a merged table; the days before a date are compacted."""
    out, path = scratch_dir(spark, "merged"), scratch_dir(spark, "flights")
    documents = s.documents(spark, d).select(*FLIGHT_RAW.names)
    kind = F.col("alt_baro")
    updates = documents.where(kind % 3 == 0).withColumns(
        {
            "alt_baro": kind + 1,
            "lat": F.when(kind % 9 != 0, F.col("lat")),
            "ingest_ts": F.col("ingest_ts") + 10,
        }
    )
    late = documents.where(kind % 5 == 0).withColumns(
        {"gs": F.lit(-1.0), "ingest_ts": F.col("ingest_ts") - 10}
    )
    table = logged.MergedTable(spark, f"{out}/rows", FLIGHT, order=["flight", "Timestamp"])
    for part in (documents, updates.unionByName(documents.where(kind % 7 == 0)), late):
        part.coalesce(1).write.mode("append").parquet(path)
        _drain(
            streams.merge_changes(
                flight_source.flights_changes(spark, path),
                table,
                f"{out}/rejects",
                f"{out}/metric",
                f"{out}/checkpoint",
            )
        )
        table.compact(before="2024-01-15")
    return _flat_point(table.read().select(*FLIGHT.names))
