"""Batch ingest: parse, drop unchanged snapshots, number and label the rest, store."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytally.operators.flatten import envelope
from skytally.operators.ordered import changed_snapshots, order_of
from skytally.session import drop_scratch, scratch_dir
from skytally.sinks.tables import VersionedTable, read_if_there
from skytally.sources.snapshots import split_rejects

STATE = "receiver STRING, last_now DOUBLE, forwarded BIGINT"
_CARRIED = f"{STATE}, last_arrival DOUBLE"


def forwarded(
    snapshots: DataFrame,
    slices: int | None = None,
    state: DataFrame | None = None,
    unique_arrival=False,
    landed: DataFrame | None = None,
) -> DataFrame:
    """Changed snapshots with their four envelope properties."""
    return envelope(changed_snapshots(snapshots, slices, state, unique_arrival, landed))


def state_after(before: DataFrame, snapshots: DataFrame, landed: DataFrame) -> DataFrame:
    """The state once ``snapshots`` were handled and ``landed`` of them stored."""
    counted = landed.groupBy("receiver").agg(
        (F.max(F.col("SequenceNumber").cast("bigint")) + 1).alias("_count")
    )
    newest = snapshots.groupBy("receiver").agg(
        F.max_by("now", F.struct(*order_of(snapshots))).alias("_now")
    )
    return (
        before.join(newest, "receiver", "full")
        .join(counted, "receiver", "left")
        .select(
            "receiver",
            F.coalesce("_now", "last_now").alias("last_now"),
            F.coalesce("_count", "forwarded", F.lit(0)).cast("bigint").alias("forwarded"),
        )
    )


def _caught_up(state: DataFrame, landed: DataFrame) -> DataFrame:
    """The state, per receiver clock, count and arrival of the last landed snapshot, brought up
    to some landed ones."""
    newest = landed.groupBy("receiver").agg(
        F.max_by("now", F.struct(*order_of(landed))).alias("_now"),
        F.max("arrival").alias("_arrival"),
        (F.max(F.col("SequenceNumber").cast("bigint")) + 1).alias("_count"),
    )
    later = F.coalesce(F.col("_arrival") >= F.col("last_arrival"), F.col("_arrival").isNotNull())
    return state.join(newest, "receiver", "full").select(
        "receiver",
        F.when(later, F.col("_now")).otherwise(F.col("last_now")).alias("last_now"),
        F.greatest("_count", "forwarded").alias("forwarded"),
        F.greatest("_arrival", "last_arrival").alias("last_arrival"),
    )


def _overlap(carried: DataFrame, landed: DataFrame, begins: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """For receivers whose first arrival (``begin``) is not after what was landed: the state
    with the clock before it, and the landed snapshots from it on; None if there are none."""
    begins = carried.join(begins, "receiver").where("begin <= last_arrival").select("receiver", "begin")
    first = begins.agg(F.min("begin")).first()[0]
    if first is None:
        return carried, None
    there = landed.join(begins, "receiver")
    clock = there.where("arrival < begin").groupBy("receiver").agg(
        F.max_by("now", F.struct(*order_of(landed))).alias("_clock")
    )
    state = carried.join(begins, "receiver", "left").join(clock, "receiver", "left")
    own = F.when(F.col("begin").isNull(), F.col("last_now")).otherwise(F.col("_clock"))
    old = there.where((F.col("arrival") >= first) & (F.col("arrival") >= F.col("begin")))
    return state.withColumn("last_now", own), old


def ingest_snapshots(
    parsed: DataFrame,
    out: str,
    rejects: str,
    slices: int | None = None,
    unique_arrival=False,
    state: str | None = None,
) -> None:
    """Store parsed snapshots in the landing table, unusable ones with their reason beside it.

    Runs go on from one another: a snapshot is compared with the one before it, whichever run
    landed that, and numbers continue. So runs over overlapping snapshots land what one run over
    all of them lands, as long as no run brings arrivals from between those of an earlier one.
    Such a late snapshot is landed if its clock differs from that of the landed one before it,
    with a number after all others. The rejects are a log.

    ``state`` (by default beside ``out``) keeps where each receiver stands, so that only a run
    that overlaps earlier ones reads landed snapshots. It is marked before a run stores its rows
    and replaced after; what a run left that failed in between is made up for by the next one.
    One run at a time may fill a landing table.

    Finding the order takes several passes over a few columns. So the documents are parsed
    once, into a columnar scratch table, and the passes read that.
    """
    spark = parsed.sparkSession
    table = VersionedTable(spark, state or f"{out.rstrip('/')}-state")
    staged = scratch_dir(spark, "parsed")
    try:
        parsed.write.parquet(staged)
        good, bad = split_rejects(spark.read.schema(parsed.schema).parquet(staged))
        place = ", place DOUBLE" if "place" in good.columns else ""
        columns = f"receiver STRING, arrival DOUBLE{place}, now DOUBLE, SequenceNumber STRING"

        carried, marked = table.read(_CARRIED), table.marks()
        if marked is None or "pending" in marked:
            landed = read_if_there(spark, out, columns)
            if marked is not None:
                landed = landed.where(F.col("arrival") >= marked["pending"])
            carried = _caught_up(carried, landed)
        begins = good.groupBy("receiver").agg(F.min("arrival").alias("begin"))
        begin = begins.agg(F.min("begin")).first()[0]
        if begin is not None:
            carried = table.read(_CARRIED, table.publish(carried, pending=begin))
            before, old = _overlap(carried, read_if_there(spark, out, columns), begins)
            fresh = forwarded(good, slices, before, unique_arrival, old)
            fresh.write.mode("append").parquet(out)
            landed = read_if_there(spark, out, columns).where(F.col("arrival") >= begin)
            table.publish(_caught_up(carried, landed))
            table.vacuum()
        bad.write.mode("append").json(rejects)
    finally:
        drop_scratch(spark, staged)
