"""Dealing groups of documents to shards of even bytes by Karmarkar-Karp differencing.

A *partial partition* is some items dealt to ``k`` bins. Two of them are combined by adding
their bins oppositely ordered, the fullest of one to the emptiest of the other, which keeps
their difference only. Differencing combines the two partial partitions of largest spread
until one is left.

Groups (equal texts) number as many as the documents, so this runs on two levels. Small groups
are dealt inside tasks: each of a fixed number of buckets keeps one running partial partition
and combines it with that of every next chunk of its groups. Its bins, a bounded number, and
the groups that are large by themselves are then the items of the last differencing.
"""

import heapq
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytally.llm.common import boxed, scratch, staged

BUCKETS = 1024
FINE = 1024
_CHUNK = 1 << 14

# A bin that holds something: (bytes, content); content is an item, or a pair of contents.
# A partial partition lists its bins from the fullest on and leaves out the empty ones.
Bins = list[tuple[int, object]]


def combine(one: Bins, other: Bins, k: int) -> Bins:
    """Both partial partitions in one: fullest bins to emptiest bins."""
    # Bin i of the one meets bin k - 1 - i of the other; where that is empty, it stays alone.
    alone, other_alone = k - len(other), k - len(one)
    bins = one[:alone] + other[:other_alone]
    for (a, x), (b, y) in zip(one[alone:], reversed(other[other_alone:])):
        bins.append((a + b, (x, y)))
    bins.sort(key=lambda bin: -bin[0])
    return bins


def difference(items: Iterable[tuple[int, object]], k: int) -> Bins:
    """Items (bytes, name) dealt to ``k`` bins; names must not be tuples. Ties go by place."""
    heap = []
    for place, (size, name) in enumerate(items):
        heap.append((-size, place, [(size, name)]))
    heapq.heapify(heap)
    place = len(heap)
    while len(heap) > 1:
        _, _, one = heapq.heappop(heap)
        _, _, other = heapq.heappop(heap)
        bins = combine(one, other, k)
        spread = bins[0][0] - (bins[-1][0] if len(bins) == k else 0)
        heapq.heappush(heap, (-spread, place, bins))
        place += 1
    return heap[0][2] if heap else []


def contents(content: object) -> Iterator[object]:
    """The items in a bin."""
    left = [content]
    while left:
        one = left.pop()
        if isinstance(one, tuple):
            left.extend(one)
        else:
            yield one


def _dealt(sizes: list[int], running: list[int]) -> tuple[list[int], list[int]]:
    """A chunk dealt to the bins of a running partial partition: (bin of each, new bytes)."""
    k = len(running)
    bins = difference(((s, i) for i, s in enumerate(sizes)), k)
    emptiest = sorted(range(k), key=lambda b: (running[b], b))
    places, running = [0] * len(sizes), list(running)
    for (size, content), b in zip(bins, emptiest):
        running[b] += size
        for i in contents(content):
            places[i] = b
    return places, running


def _bundles(groups: DataFrame, k: int, tasks: int) -> DataFrame:
    """Small groups (key, bytes) with ``bucket`` and the ``item``, a bin of it, they are in."""
    dealt = (
        groups.withColumn("bucket", F.pmod("key", F.lit(BUCKETS)).cast("int"))
        .repartition(tasks, "bucket")
        .sortWithinPartitions("bucket", F.desc("bytes"), "key")
    )

    def run(batches):
        running, bucket = [0] * k, None
        for batch in batches:
            buckets = batch.column("bucket").to_numpy()
            sizes = batch.column("bytes").to_pylist()
            places = []
            cuts = np.flatnonzero(np.diff(buckets)) + 1
            for start, end in zip([0, *cuts], [*cuts, len(sizes)]):
                if buckets[start] != bucket:
                    running, bucket = [0] * k, buckets[start]
                for at in range(start, end, _CHUNK):
                    some, running = _dealt(sizes[at : min(at + _CHUNK, end)], running)
                    places += some
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(places, pa.int64())],
                [*batch.schema.names, "item"],
            )

    return dealt.mapInArrow(run, "key long, bytes long, bucket int, item long")


def _ranked(rows: DataFrame, shard: str) -> DataFrame:
    """Rows, stored, with their task ``_part`` and their ``_rank`` among its rows of a shard."""
    schema = T.StructType(
        [*rows.schema.fields, T.StructField("_part", T.IntegerType()), T.StructField("_rank", T.LongType())]
    )

    def run(batches):
        seen, part = Counter(), TaskContext.get().partitionId()
        for batch in batches:
            shards = batch.column(shard).to_numpy(zero_copy_only=False)
            ranks = np.empty(len(shards), np.int64)
            order = np.argsort(shards, kind="stable")
            found, starts, counts = np.unique(shards[order], return_index=True, return_counts=True)
            for s, start, count in zip(found.tolist(), starts.tolist(), counts.tolist()):
                ranks[order[start : start + count]] = np.arange(seen[s], seen[s] + count)
                seen[s] += count
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([part] * len(ranks), pa.int32()), pa.array(ranks)],
                schema.names,
            )

    return staged(rows.mapInArrow(run, schema), "slots")


def _slots(ranked: DataFrame, shard: str) -> DataFrame:
    """``slot``: 0, 1, ... in each shard. What earlier tasks hold of a shard, one number for
    each task and shard, is added to the rank; no shard passes through one task."""
    before = Window.partitionBy(shard).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        ranked.groupBy(shard, "_part")
        .count()
        .select(shard, "_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_base"))
    )
    placed = ranked.join(bases, [shard, "_part"])
    return placed.withColumn("slot", F.col("_base") + F.col("_rank"))


def shard_documents(docs: DataFrame, shards=40, overhead=16, text="text") -> DataFrame:
    """Every document with its ``shard`` (from 0) and its ``slot`` in it, gapless from 0.

    Columns: doc (struct of the other columns), size (UTF-8 bytes of the text and
    ``overhead``), text_crc32, shard, slot. Equal texts are one group and share a shard; a null
    text is grouped with the empty ones. Shards hold about equally many bytes: a group above the
    mean has a shard as near to alone as it can be, all others are evened out to within
    1 / ``FINE`` of the mean at worst. Repeated rows are documents like any other; which slot a
    document has is arbitrary. An empty table gives no rows. Groups are found by 64-bit hashes:
    two texts that share one only share a shard.
    """
    spark = docs.sparkSession
    whole = F.coalesce(F.col("text"), F.lit(""))
    sizes = boxed(docs, text).select(
        "doc",
        (F.octet_length(whole) + F.lit(overhead)).cast("long").alias("size"),
        F.crc32(whole.cast("binary")).alias("text_crc32"),
        F.xxhash64(whole).alias("key"),
    )
    with scratch(spark) as stage:
        sized = stage(sizes, "sized")
        groups = stage(sized.groupBy("key").agg(F.sum("size").alias("bytes")), "groups")
        total, count = groups.agg(F.sum("bytes"), F.count("*")).first()
        # At most shards * FINE groups are large, and the buckets have BUCKETS * shards bins.
        large = F.col("bytes") >= F.lit((total or 0) / (shards * FINE))
        heavy = groups.where(large).select("key", F.lit(-1).alias("bucket"), F.col("key").alias("item"), "bytes")
        tasks = min(BUCKETS, count // _CHUNK + 1)
        small = stage(_bundles(groups.where(~large), shards, tasks), "bundles")
        shard_of = _shards(heavy.unionByName(small.select(*heavy.columns)), shards)
        placed = (
            heavy.unionByName(small.select(*heavy.columns))
            .join(F.broadcast(shard_of), ["bucket", "item"])
            .select("key", "shard")
        )
        numbered = _ranked(sized.join(placed, "key").drop("key"), "shard")
    return _slots(numbered, "shard").select("doc", "size", "text_crc32", "shard", "slot")


def _shards(items: DataFrame, shards: int) -> DataFrame:
    """The shard of each item (bucket, item), by differencing all of them.

    There are at most shards * (FINE + BUCKETS) items, whatever the input, so they fit the
    driver and the result may be broadcast.
    """
    found = items.groupBy("bucket", "item").agg(F.sum("bytes").alias("bytes")).collect()
    found.sort(key=lambda r: (-r.bytes, r.bucket, r.item))
    bins = difference(((r.bytes, i) for i, r in enumerate(found)), shards)
    rows = [
        (found[i].bucket, found[i].item, shard)
        for shard, (_, content) in enumerate(bins)
        for i in contents(content)
    ]
    return items.sparkSession.createDataFrame(rows, "bucket int, item long, shard int")
