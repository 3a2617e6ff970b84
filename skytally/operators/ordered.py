"""Work that needs the order of snapshots: change detection and numbering.

One receiver may hold any share of the rows, so its order is never handled by one
task. The rows are cut into slices of about equal size by arrival; each
(receiver, slice) is handled on its own, and what one slice hands to the next - a
single value - comes from one summary row per (receiver, slice).

Order is ``arrival``, then ``place`` where there is such a column, then ``now``. None may be
null. ``place`` is what readers add to keep the order inside a file.
"""

import math
from collections import Counter

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skytally.operators.upsert import keep_one

_KEYS = ["receiver", "_slice"]


def order_of(snapshots: DataFrame) -> list[str]:
    return ["arrival", "place", "now"] if "place" in snapshots.columns else ["arrival", "now"]


def _in_slice(snapshots):
    return Window.partitionBy(*_KEYS).orderBy(*order_of(snapshots))


def _by_slice():
    """Over summary rows: as many per receiver as there are slices."""
    return Window.partitionBy("receiver").orderBy("_slice")


def _quantiles(rows, column, parts):
    """Cut points for ``parts`` equal parts; a value may come up more than once."""
    shares = [i / parts for i in range(1, parts)]
    return rows.approxQuantile(column, shares, 1 / (4 * parts))


def _bucket(rows, column, cuts, out):
    """Number of cut points at or below the value, by binary search in the JVM."""
    edges = [-math.inf, *sorted(set(cuts)), math.inf]
    found = Bucketizer(splits=edges, inputCol=column, outputCol=out).transform(rows)
    return found.withColumn(out, F.col(out).cast("int"))


def with_slices(snapshots: DataFrame, slices: int | None = None) -> DataFrame:
    """Add ``_slice``, rising with the order, so that slices hold about equally many rows.

    Cut points are quantiles of ``arrival``, found by a scan of that column alone. An
    arrival that fills whole slices gets one for itself, which is cut further by what comes
    next in the order.
    """
    spark = snapshots.sparkSession
    slices = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = _quantiles(snapshots, "arrival", slices) if slices > 1 else []
    if not found:
        return snapshots.withColumn("_slice", F.lit(0))
    heavy = [value for value, times in Counter(found).items() if times > 1]
    cuts = [*found, *(math.nextafter(value, math.inf) for value in heavy)]
    rows = _bucket(snapshots, "arrival", cuts, "_slice")
    if heavy:
        crowded = F.col("arrival").isin(heavy)
        second = order_of(snapshots)[1]
        inner = _quantiles(snapshots.where(crowded), second, slices)
        rows = _bucket(rows, second, inner, "_inner")
        inner_slice = F.when(crowded, F.col("_inner")).otherwise(0)
        rows = rows.withColumn("_slice", F.col("_slice") * slices + inner_slice).drop("_inner")
    return rows


def _runs(rows: DataFrame, known) -> DataFrame:
    """One summary per (receiver, slice), which can be joined to the one of the next slice.

    ``first`` and ``last`` are the clocks at its ends, ``changes`` the rows after the first
    whose clock differs from that of the row before. What the first row is, only the slice
    before can tell. Reads no wide column.
    """
    order = order_of(rows)
    before = F.lag("now").over(_in_slice(rows))
    narrow = rows.select(*_KEYS, *dict.fromkeys([*order, "now"]), known.alias("_known"))
    if "_arrived_once" not in rows.columns:
        # Copies go before the shuffle; a known one counts for all.
        narrow = narrow.groupBy(*_KEYS, *dict.fromkeys([*order, "now"])).agg(F.max("_known").alias("_known"))
    changed = (before != F.col("now")) & ~F.col("_known")
    place = F.struct(*order)
    return (
        narrow.withColumn("_changed", F.coalesce(changed, F.lit(False)).cast("long"))
        .groupBy(*_KEYS)
        .agg(
            F.min_by("now", place).alias("_first"),
            F.min_by("_known", place).alias("_first_known"),
            F.max_by("now", place).alias("_last"),
            F.sum("_changed").alias("_changes"),
        )
    )


def _carried(runs: DataFrame, state: DataFrame | None) -> DataFrame:
    """What each (receiver, slice) begins with: the clock before it, and how many snapshots
    were forwarded before it. One scan over the summaries."""
    if state is None:
        runs = runs.withColumns({"_clock": F.lit(0.0), "_count": F.lit(0).cast("bigint")})
    else:
        known = state.select("receiver", F.col("last_now").alias("_clock"), F.col("forwarded").alias("_count"))
        runs = runs.join(known, "receiver", "left").fillna({"_clock": 0.0, "_count": 0})
    clock = F.coalesce(F.lag("_last").over(_by_slice()), F.col("_clock"))
    opens = ((F.col("_first") != F.col("_before")) & ~F.col("_first_known")).cast("long")
    forwarded = F.col("_changes") + opens
    earlier = F.coalesce(
        F.sum("_forwarded").over(_by_slice().rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    return (
        runs.withColumn("_before", clock)
        .withColumn("_forwarded", forwarded)
        .select(*_KEYS, "_before", (F.col("_count") + earlier).alias("_start"))
    )


def changed_snapshots(
    snapshots: DataFrame,
    slices: int | None = None,
    state: DataFrame | None = None,
    unique_arrival=False,
    landed: DataFrame | None = None,
) -> DataFrame:
    """The snapshots whose ``now`` differs from that of the one before, per receiver, with
    ``sequence``: 0, 1, 2, ... per receiver in order.

    The one before the first is taken to have ``now`` 0, and the count to start at 0, or what
    ``state`` (receiver, last_now, forwarded) says. A, B, A keeps all three. ``landed`` are
    snapshots that were forwarded before (receiver and the columns of the order): they take
    their place in the order, so that a copy of one is no change, but are not returned or
    counted again. With ``unique_arrival`` no two snapshots of a receiver share an arrival,
    which saves a shuffle: otherwise those that share ``now`` as well are first reduced to one.

    A segmented prefix scan: every slice is summed up by itself, the summaries, one small row
    each, are scanned, and the rows are numbered inside their slices from what was carried
    there. The input is read twice, for the summaries and for the rows, and the whole rows are
    shuffled once.
    """
    columns = snapshots.columns
    known = F.lit(False)
    if landed is not None:
        keys = dict.fromkeys(["receiver", *order_of(snapshots), "now"])
        old = landed.select(*keys).withColumn("_known", F.lit(True))
        fresh = snapshots.withColumn("_known", F.lit(False))
        snapshots = fresh.unionByName(old, allowMissingColumns=True)
        known, unique_arrival = F.col("_known"), False
    if "_slice" not in snapshots.columns:
        snapshots = with_slices(snapshots, slices)
    order = order_of(snapshots)
    if unique_arrival:
        snapshots = snapshots.withColumn("_arrived_once", F.lit(True))
    carried = _carried(_runs(snapshots, known), state)
    if not unique_arrival:
        first = [known.desc(), "messages"]
        snapshots = keep_one(snapshots, ["receiver", *order], first)
    rows = snapshots.join(carried, _KEYS, "left")
    before = F.coalesce(F.lag("now").over(_in_slice(rows)), F.col("_before"))
    rows = rows.withColumn("_changed", (before != F.col("now")) & ~known)
    so_far = F.sum(F.col("_changed").cast("bigint")).over(_in_slice(rows))
    numbered = rows.withColumn("sequence", (F.col("_start") + so_far - 1).cast("bigint"))
    return numbered.where("_changed").select(*columns, "sequence")


def dedupe_snapshots(
    snapshots: DataFrame,
    slices: int | None = None,
    state: DataFrame | None = None,
    unique_arrival=False,
) -> DataFrame:
    """Drop a snapshot whose ``now`` equals that of the one before it, per receiver.

    As :func:`changed_snapshots`, without the numbers; ``state`` needs no count.
    """
    if state is not None and "forwarded" not in state.columns:
        state = state.withColumn("forwarded", F.lit(0).cast("bigint"))
    return changed_snapshots(snapshots, slices, state, unique_arrival).drop("sequence")


def number_snapshots(
    snapshots: DataFrame, slices: int | None = None, state: DataFrame | None = None
) -> DataFrame:
    """Add ``sequence``: 0, 1, 2, ... per receiver in order.

    With ``state`` (receiver, forwarded) the count goes on from there.
    """
    if "_slice" not in snapshots.columns:
        snapshots = with_slices(snapshots, slices)
    counts = (
        snapshots.groupBy(*_KEYS)
        .count()
        .select(*_KEYS, (F.sum("count").over(_by_slice()) - F.col("count")).alias("_before"))
    )
    rows = snapshots.join(counts, _KEYS, "left")
    sequence = F.col("_before") + F.row_number().over(_in_slice(snapshots)) - 1
    if state is not None:
        known = state.select("receiver", F.col("forwarded").alias("_known"))
        rows = rows.join(known, "receiver", "left")
        sequence = sequence + F.coalesce("_known", F.lit(0))
    return rows.withColumn("sequence", sequence.cast("bigint")).drop("_slice", "_before", "_known")
