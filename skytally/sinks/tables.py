"""Parquet layouts of the stored tables."""

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from skytally.functions.timeconv import now_fn
from skytally.operators.flatten import aircraft_rows, flight_documents
from skytally.operators.upsert import keep_one, without_keys
from skytally.session import drop_scratch, scratch_dir
from skytally.sinks.commits import CommitLog
from skytally.sinks.logged import LoggedTable


def partition_by_flight(rows: DataFrame, flight="flight", spread="id", partitions=None) -> DataFrame:
    """Bring the rows of a flight together.

    By ranges of (flight, spread): a flight with a large share of the rows is cut into
    several partitions, where a hash of the flight alone would give it to one task.
    """
    keys = [flight, spread]
    if partitions:
        return rows.repartitionByRange(partitions, *keys)
    return rows.repartitionByRange(*keys)


def with_date(rows: DataFrame, time: str) -> DataFrame:
    return rows.withColumn("date", F.to_date(F.timestamp_seconds(time)))


def clustered(rows: DataFrame, flight: str, time: str, *more: str) -> DataFrame:
    """Add the day and bring days, and in them flights, together.

    Each task then writes few days, and a filter on the flight can skip row groups by
    their min and max. Ranges end inside a flight that is too large for one task.
    """
    keys = ["date", flight, time, *more]
    return with_date(rows, time).repartitionByRange(*keys).sortWithinPartitions(*keys)


def stamped(documents: DataFrame, stored_at: Column | None = None) -> DataFrame:
    """Add when the documents were stored, in epoch seconds: now, unless given."""
    return documents.withColumn(
        "ingest_ts", F.unix_seconds(now_fn()) if stored_at is None else stored_at
    )


def _one_of_each(rows: DataFrame, keys) -> DataFrame:
    """One row per key: the one with the lowest hex, then by the other fields."""
    return keep_one(rows, keys, ["hex", *[c for c in rows.columns if c not in (*keys, "hex")]])


def fresh_only(rows: DataFrame, stored: DataFrame, keys) -> DataFrame:
    """Rows whose keys are not in ``stored`` on the row's day; both have ``date``.

    Stored rows are narrowed to the days at hand before the join.
    """
    days = rows.select("date").distinct()
    stored = stored.select("date", *keys).join(days, "date", "left_semi")
    return without_keys(rows, stored, ["date", *keys])


def _add(rows: DataFrame, path: str, mode: str, keys, order) -> None:
    """Store rows, which have ``date``, by day and in ``order``.

    They are computed once, into a scratch table: what is stored already is found, and the
    ranges of the order are sampled, from that.
    """
    spark = rows.sparkSession
    staged = scratch_dir(spark, "rows")
    try:
        rows.write.parquet(staged)
        rows = spark.read.schema(rows.schema).parquet(staged)
        if mode == "append":
            rows = fresh_only(rows, read_if_there(spark, path, rows.schema), keys)
        rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
        rows.write.mode(mode).partitionBy("date").parquet(path)
    finally:
        drop_scratch(spark, staged)


def write_flights(
    sightings: DataFrame, path: str, mode="append", stored_at: Column | None = None
) -> None:
    """Store the document of each sighting, one per id, by day and flight.

    Ids that are stored already are left out, so that a run can be repeated: the id holds
    time and callsign, the document behind it does not change. The same holds for the other
    tables.
    """
    documents = stamped(_one_of_each(flight_documents(sightings), ["id"]), stored_at)
    rows = with_date(documents, "Timestamp")
    _add(rows, path, mode, ["id"], ["date", "flight", "Timestamp", "id"])


def write_aircraft(sightings: DataFrame, path: str, mode="append") -> None:
    """Store the wide row of each sighting, one per (PartitionKey, RowKey)."""
    keys = ["PartitionKey", "RowKey"]
    rows = with_date(_one_of_each(aircraft_rows(sightings), keys), "RowKey")
    _add(rows, path, mode, keys, ["date", *keys])


def write_nearby(windows: DataFrame, path: str, mode="append") -> None:
    """Store closed windows of a batch run, by the day they ended."""
    rows = windows.withColumn("date", F.to_date("LastSeen"))
    _add(rows, path, mode, ["flight", "LastSeen"], ["date", "flight", "LastSeen"])


def write_batch(rows: DataFrame, table: str | LoggedTable, batch_id: int, *by: str, writer="") -> None:
    """Store one micro-batch. Running the batch again replaces what it wrote before, or, where
    the table has a log, adds nothing: ``writer`` names whose batches are counted."""
    if isinstance(table, LoggedTable):
        table.append(rows, writer, batch_id)
        return
    out = rows.write.mode("overwrite")
    if by:
        out = out.partitionBy(*by)
    out.parquet(f"{table}/batch_id={batch_id}")


def stored_keys(spark: SparkSession, table: str | LoggedTable, batch_id: int, keys: str) -> DataFrame:
    """``keys`` (column definitions) and date of what batches other than this one stored."""
    if isinstance(table, LoggedTable):
        # A batch that is in the log is not written again, so it need not be left out.
        return table.read()
    stored = read_if_there(spark, table, f"{keys}, date DATE, batch_id BIGINT")
    return stored.where(F.col("batch_id") != batch_id)


def read_if_there(spark: SparkSession, path: str, schema) -> DataFrame:
    """The table at ``path``, or no rows when nothing was written there yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


class VersionedTable:
    """A table that is replaced as a whole: a folder per version and a log of commits.

    A version is written first and then committed, so a reader sees the old or the new one,
    never a half-written one, and the path being read is never overwritten. Of two writers that
    build on the same version one is first; :meth:`update` lets the other build anew on what
    the first one made.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self.log = CommitLog(spark, self.path)

    def version(self) -> int | None:
        return (self.log.numbers() or [None])[-1]

    def read(self, schema, version: int | None = None) -> DataFrame:
        version = self.version() if version is None else version
        if not version:
            return self.spark.createDataFrame([], schema)
        folder = self.log.read(version)["folder"]
        return self.spark.read.schema(schema).parquet(f"{self.path}/{folder}")

    def _write(self, rows: DataFrame) -> str:
        folder = f"data/{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.path}/{folder}")
        return folder

    def marks(self) -> dict | None:
        """What the latest version was marked with; None if there is no version."""
        version = self.version()
        return version and {k: v for k, v in self.log.read(version).items() if k != "folder"}

    def publish(self, rows: DataFrame, **marks) -> int:
        """Make ``rows`` the next version, whatever the one before holds."""
        entry = {"folder": self._write(rows), **marks}
        return self.log.commit(lambda base: entry)

    def update(self, change: Callable[[DataFrame], DataFrame], schema) -> int:
        """Make ``change`` of the latest version the next one.

        When another writer commits meanwhile, what was written is thrown away and ``change``
        is asked again, with that writer's version. So no update is lost.
        """
        written = []

        def build(base):
            if written:
                drop_scratch(self.spark, f"{self.path}/{written.pop()}")
            written.append(self._write(change(self.read(schema, base))))
            return {"folder": written[0]}

        return self.log.commit(build)

    def vacuum(self, keep: int = 2) -> int:
        """Delete all versions but the last ``keep``; returns how many went."""
        old = self.log.numbers()[:-keep]
        for number in old:
            drop_scratch(self.spark, f"{self.path}/{self.log.read(number)['folder']}")
        if old:
            self.log.drop_before(old[-1] + 1)
        return len(old)
