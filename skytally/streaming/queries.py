"""Starting the queries. ``trigger`` holds keyword arguments of ``writeStream.trigger``;
the default handles all input there is and stops.

Batches are handed to plain functions, so each batch may be run again after a failure;
everything they write is replaced, not added to, when that happens.
"""

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skytally.functions.geo import HOME_LAT, HOME_LON
from skytally.operators.aggregates import flight_metric
from skytally.operators.enrich import enrich, enrich_rejects
from skytally.operators.flatten import (
    aircraft_rows,
    all_flights,
    flight_documents,
    one_per_callsign,
    with_event_time,
)
from skytally.operators.upsert import without_keys
from skytally.plans.ingest import STATE, forwarded, state_after
from skytally.plans.live import nearby, nearby_parts
from skytally.session import drop_scratch, scratch_dir
from skytally.sinks.logged import LoggedTable, MergedTable, WindowTable, day_of_key
from skytally.sinks.tables import (
    clustered,
    fresh_only,
    read_if_there,
    stamped,
    stored_keys,
    with_date,
    write_batch,
)
from skytally.sources.snapshots import split_ahead, split_rejects, usable

DRAIN = {"availableNow": True}
WATERMARK_DELAY = "30 seconds"
MAX_AHEAD = 3600.0


def first_seen_only(rows: DataFrame, keys, within: str) -> DataFrame:
    """Drop rows whose keys came by in the last ``within`` of arrival time.

    The watermark runs on the time of arrival, so a row that is old by its own clock is
    not lost.
    """
    timed = rows.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", within)
    return timed.dropDuplicatesWithinWatermark(list(keys)).drop("_arrived")


def write_nearby_stream(
    snapshots: DataFrame,
    out: str,
    checkpoint: str,
    duration="3 minutes",
    delay=WATERMARK_DELAY,
    radius=1000,
    home_lat=HOME_LAT,
    home_lon=HOME_LON,
    max_ahead: float | None = MAX_AHEAD,
    trigger=DRAIN,
) -> StreamingQuery:
    """Append each nearby window once the watermark has passed its end.

    Rows more than ``delay`` behind the newest event time are not counted, and neither are
    snapshots whose clock is over ``max_ahead`` seconds ahead of their arrival, so that these
    do not make all others late. Both kinds are in the stored sightings, from which
    :func:`skytally.plans.live.repaired_nearby` counts the windows of a day anew.
    """
    snapshots = usable(snapshots)
    if max_ahead is not None:
        snapshots, _ = split_ahead(snapshots, max_ahead)
    timed = with_event_time(snapshots, delay)
    windows = nearby(timed, duration, radius, home_lat, home_lon)
    return (
        windows.writeStream.outputMode("append")
        .format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def merge_nearby_stream(
    snapshots: DataFrame,
    table: WindowTable,
    checkpoint: str,
    duration="3 minutes",
    radius=1000,
    home_lat=HOME_LAT,
    home_lon=HOME_LON,
    trigger=DRAIN,
) -> StreamingQuery:
    """Add what each batch sees nearby to the windows, whenever its snapshots are from.

    Without watermark and state: no snapshot is late, and none whose clock is ahead makes
    others so. Windows show what was seen so far and are never closed. To be fed from the
    landing table, which is free of repeats: a snapshot that comes twice counts twice.
    """

    def store(batch, batch_id):
        parts = nearby_parts(usable(batch), duration, radius, home_lat, home_lon)
        table.append(parts, checkpoint, batch_id)

    return _each_batch(snapshots, store, checkpoint, trigger)


def write_sightings_stream(
    snapshots: DataFrame,
    aircraft: str | LoggedTable,
    flights: str | LoggedTable,
    checkpoint: str,
    home_lat=HOME_LAT,
    home_lon=HOME_LON,
    same_id_within="2 hours",
    trigger=DRAIN,
) -> StreamingQuery:
    """Store the wide row and the document of each sighting, sharing one pass.

    The key holds time and callsign, so taking the first row per key equals
    insert-or-replace, without rewriting what is stored. Copies that come later than the
    stream remembers ids are found among the stored ids of their day.

    The tables are folders, which get one more for each batch, or logged tables, whose days
    can be compacted while the stream runs.
    """
    sightings = first_seen_only(
        all_flights(one_per_callsign(usable(snapshots)), home_lat, home_lon), ["id"], same_id_within
    )
    spark = snapshots.sparkSession

    def store(batch, batch_id):
        # Kept before it is ordered: finding the ranges would run the whole batch once more.
        with kept(batch) as batch:
            dated = with_date(batch, "RowKey")
            stored = stored_keys(spark, flights, batch_id, "id STRING")
            fresh = clustered(fresh_only(dated, stored, ["id"]), "PartitionKey", "RowKey")
            with kept(fresh) as rows:
                documents = stamped(flight_documents(rows, "date"))
                write_batch(aircraft_rows(rows, "date"), aircraft, batch_id, "date", writer=checkpoint)
                write_batch(documents, flights, batch_id, "date", writer=checkpoint)

    return _each_batch(sightings, store, checkpoint, trigger)


def fan_out_sinks(
    snapshots: DataFrame,
    aircraft: str,
    near: str,
    flights: str,
    checkpoint: str,
    max_ahead: float | None = MAX_AHEAD,
    trigger=DRAIN,
) -> tuple[StreamingQuery, StreamingQuery]:
    """All three tables from one stream. The windows are a query of their own, because
    their state has to live in the stream and not inside a batch function."""
    rows = write_sightings_stream(
        snapshots, aircraft, flights, f"{checkpoint}/sightings", trigger=trigger
    )
    windows = write_nearby_stream(
        snapshots, near, f"{checkpoint}/nearby", max_ahead=max_ahead, trigger=trigger
    )
    return rows, windows


def ingest_stream(
    parsed: DataFrame, out: str, rejects: str, state: str, checkpoint: str, slices=None, trigger=DRAIN
) -> StreamingQuery:
    """Land changed snapshots with their envelope; carry order across batches.

    ``state`` holds one row per receiver, its last ``now`` and how many snapshots were
    forwarded, in two slots used in turn: a batch reads the slot of the one before and
    replaces the other, so it can be run again and the state does not grow. ``out``,
    ``rejects`` and ``state`` belong to ``checkpoint``: give a new one new folders.

    A batch may hold any number of snapshots. As in batch ingest, it is parsed once, into a
    scratch table, and the passes that find the order read a few columns of that.
    """
    spark = parsed.sparkSession

    def land(batch, batch_id):
        before = read_if_there(spark, f"{state}/slot={(batch_id + 1) % 2}", STATE)
        if batch_id == 0:
            before = before.where("false")
        with staged(spark, batch) as batch:
            good, bad = split_rejects(batch)
            write_batch(forwarded(good, slices, before), out, batch_id)
            write_batch(bad, rejects, batch_id)
            columns = "receiver STRING, SequenceNumber STRING"
            landed = read_if_there(spark, f"{out}/batch_id={batch_id}", columns)
            after = state_after(before, good, landed)
            after.write.mode("overwrite").parquet(f"{state}/slot={batch_id % 2}")

    return _each_batch(parsed, land, checkpoint, trigger)


def enrich_changes(
    changes: DataFrame,
    enriched: str,
    rejects: str,
    metric: str,
    checkpoint: str,
    same_id_within="2 hours",
    trigger=DRAIN,
) -> StreamingQuery:
    """Append the enriched form of each new document that needs a point.

    It goes to a table of its own, so it does not come round again as a change. For feeds
    that only add documents: a copy that comes again, however late, is left out, whatever is
    in it. :func:`merge_changes` takes updates.
    """
    fresh = first_seen_only(changes, ["id"], same_id_within)
    spark = changes.sparkSession

    def store(batch, batch_id):
        with kept(batch) as batch:
            done = with_date(enrich(batch), "Timestamp")
            stored = stored_keys(spark, enriched, batch_id, "id STRING")
            with kept(clustered(fresh_only(done, stored, ["id"]), "flight", "Timestamp", "id")) as rows:
                write_batch(rows, enriched, batch_id, "date")
                write_batch(enrich_rejects(batch), rejects, batch_id)
                write_batch(flight_metric(rows), metric, batch_id)

    return _each_batch(fresh, store, checkpoint, trigger)


def merge_changes(
    changes: DataFrame,
    enriched: MergedTable,
    rejects: str,
    metric: str,
    checkpoint: str,
    version="ingest_ts",
    trigger=DRAIN,
) -> StreamingQuery:
    """Keep the enriched form of each document as it is at its newest version.

    ``version`` is a column that rises with each change of a document. A changed document
    replaces its row; one that lost its position, or whose timestamp cannot be read any more,
    takes the row away. Copies and older versions change nothing, whenever they come, so
    nothing has to be remembered, and no stored row is read: a batch only adds what it brings,
    to the day that is in the documents' ids.
    """

    def store(batch, batch_id):
        marked = batch.withColumn("version", F.col(version).cast("double"))
        with kept(enriched.newest(marked)) as newest:
            done = enrich(newest).withColumn("gone", F.lit(False))
            lost = newest.select(*enriched.keys, "version")
            lost = without_keys(lost, done, enriched.keys).withColumn("gone", F.lit(True))
            rows = done.unionByName(lost, allowMissingColumns=True)
            rows = rows.withColumn(enriched.day, day_of_key())
            keys = [enriched.day, *enriched.order]
            rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
            enriched.append(rows, checkpoint, batch_id)
            write_batch(enrich_rejects(newest), rejects, batch_id)
            write_batch(flight_metric(done), metric, batch_id)

    return _each_batch(changes, store, checkpoint, trigger)


@contextmanager
def kept(rows: DataFrame) -> Iterator[DataFrame]:
    """The rows, held while the block runs, also if it fails."""
    rows = rows.persist()
    try:
        yield rows
    finally:
        rows.unpersist()


@contextmanager
def staged(spark: SparkSession, rows: DataFrame) -> Iterator[DataFrame]:
    """The rows, in a scratch table while the block runs: no executor holds any of them."""
    path = scratch_dir(spark, "batch")
    try:
        rows.write.parquet(path)
        yield spark.read.schema(rows.schema).parquet(path)
    finally:
        drop_scratch(spark, path)


def _each_batch(stream, handle, checkpoint, trigger):
    return (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
