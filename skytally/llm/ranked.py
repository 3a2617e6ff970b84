"""Ranked lexical search by pipelined term partitioning.

The documents are indexed in blocks: one posting row per block and term. The terms of the
query items are dealt to owners, those of the largest weight to the first. Items travel in
bundles: for each block a bundle starts with no accumulators and passes the owners one after
the other. Each stage is a cogroup of the bundles with the postings of its owner; it adds whole
numbers to the sparse accumulators of the block's documents and hands them on.

A stage also drops what can no longer be among a block's best: the terms still to come add at
most their weights times a million, so a document that stays below the block's k-th best with
that has lost. The result is exact.
"""

from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skytally.llm.common import scratch, staged

SCALE = 1_000_000_000
UNIT = 1000
FIXED, SLOPE, PERCENT = 75, 25, 12
_CEILING = SCALE // UNIT

# Bytes of a UTF-8 text that belong to terms: ASCII letters and digits, all of what is no ASCII.
_TERMS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)
_BLOCK_TERMS = 1 << 22
SLOTS = 1 << 20


def terms(text: bytes | None) -> list[bytes]:
    """The terms of a text in UTF-8, A-Z lower-cased, in order; none if it is null."""
    return (text or b"").translate(_TERMS).split()


class Block:
    """The documents of one block and the postings of the terms that are asked for."""

    def __init__(self, asked: np.ndarray):
        self.asked = asked
        self.ids, self.lengths = [], []
        self.postings = {}
        self.size = 0

    def add(self, key: int | None, text: bytes | None) -> None:
        words = terms(text)
        place, postings = len(self.ids), self.postings
        self.ids.append(key)
        self.lengths.append(len(words))
        self.size += len(words)
        for term, count in Counter(words).items():
            if term not in postings:
                postings[term] = ([], []) if self.asked[crc32(term) % SLOTS] else None
            lists = postings[term]
            if lists is not None:
                lists[0].append(place)
                lists[1].append(count)

    def rows(self, number: int) -> pa.RecordBatch:
        """One row with the documents by ascending id, null last, and one for each term."""
        order = sorted(range(len(self.ids)), key=lambda i: (self.ids[i] is None, self.ids[i] or 0))
        place = np.empty(len(order), "<u4")
        place[order] = np.arange(len(order))
        held = {term: lists for term, lists in self.postings.items() if lists}
        n = len(held)
        columns = [
            [number] * (n + 1),
            [[self.ids[i] for i in order], *[None] * n],
            [np.asarray([self.lengths[i] for i in order], "<i8").tobytes(), *[None] * n],
            [self.size, *[None] * n],
            [sum(size > 0 for size in self.lengths), *[None] * n],
            [None, *(term.decode() for term in held)],
            [None, *(len(places) for places, _ in held.values())],
            [None, *(place[places].tobytes() for places, _ in held.values())],
            [None, *(np.asarray(counts, "<u4").tobytes() for _, counts in held.values())],
        ]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _KINDS)], _NAMES)


_INDEX = """block long, ids array<long>, lengths binary, total long, with_terms long,
    term string, df long, places binary, counts binary"""
_NAMES = [part.split()[0] for part in _INDEX.split(",")]
_KINDS = [
    pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.int64(), pa.int64(),
    pa.string(), pa.int64(), pa.binary(), pa.binary(),
]


def index(docs: DataFrame, asked: DataFrame, block=4096, key="doc_id", text="text") -> DataFrame:
    """Block rows (``term`` null) and posting rows of whole documents.

    A block row holds the ids, how many terms each document has, their sum and how many have
    any. A posting row holds, for one term, the places of its documents in the block and how
    often it occurs in each. There are postings for the terms in ``asked`` and for a few that
    share a slot with one of these: what is sent to the tasks is a bitmap of ``SLOTS`` places,
    however many terms are asked for. A block ends at ``block`` documents, or earlier when their
    texts are long.
    """
    slots = asked.select(F.pmod(F.crc32(F.col("term").cast("binary")), F.lit(SLOTS)).alias("slot"))
    found = [r.slot for r in slots.distinct().toLocalIterator()]
    bits = np.zeros(SLOTS, bool)
    bits[found] = True
    packed = np.packbits(bits).tobytes()

    def run(batches):
        bits = np.unpackbits(np.frombuffer(packed, np.uint8)).astype(bool)
        number = TaskContext.get().partitionId() << 32
        open_block = Block(bits)
        for batch in batches:
            for i, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                open_block.add(i, value.as_py())
                if len(open_block.ids) == block or open_block.size >= _BLOCK_TERMS:
                    yield open_block.rows(number)
                    open_block, number = Block(bits), number + 1
        if open_block.ids:
            yield open_block.rows(number)

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(run, _INDEX)


def item_terms(items: DataFrame, key="item_id", text="text") -> DataFrame:
    """(item, term, repeats) of the query items. Equal rows count once; rows that share an item
    add up."""
    kind = items.schema[key].dataType.simpleString()
    rows = items.select(F.col(key).alias("item"), F.col(text).cast("binary").alias("text"))

    def run(batches):
        for batch in batches:
            places, words, repeats = [], [], []
            for place, value in enumerate(batch.column(1).to_pylist()):
                found = Counter(terms(value))
                places += [place] * len(found)
                words += [term.decode() for term in found]
                repeats += found.values()
            item = batch.column(0).take(pa.array(places, pa.int64()))
            columns = [item, pa.array(words, pa.string()), pa.array(repeats, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["item", "term", "repeats"])

    found = rows.distinct().mapInArrow(run, f"item {kind}, term string, repeats long")
    return found.groupBy("item", "term").agg(F.sum("repeats").alias("repeats"))


def _numbers(binary, kind: str) -> np.ndarray:
    return np.frombuffer(binary.as_py() or b"", kind)


_STATE = """block long, bundle int, ids array<long>, lengths binary, rest binary,
    starts binary, places binary, scores binary, open binary"""
_STATE_NAMES = [part.split()[0] for part in _STATE.split(",")]


def _owner_stage(owner: int, owners: int, k: int, n_docs: int, n_terms: int):
    """The function of one stage, for the cogroup of a bundle with the owner's postings."""

    def add(state: pa.Table, postings: pa.Table) -> pa.Table:
        if not state.num_rows:
            return state
        row = {name: state.column(name)[0] for name in state.column_names}
        lengths = _numbers(row["lengths"], "<i8")
        rest = _numbers(row["rest"], "<i8").reshape(owners, -1)
        starts, places = _numbers(row["starts"], "<i8"), _numbers(row["places"], "<u4")
        entering = _numbers(row["open"], "u1").astype(bool)
        n_items = rest.shape[1]
        sums = np.zeros((n_items, len(lengths)), np.int64)
        of_item = np.repeat(np.arange(n_items), np.diff(starts)) if len(starts) else []
        sums[of_item, places] = _numbers(row["scores"], "<i8")
        held = sums[~entering] > 0
        damping = PERCENT * (FIXED + SLOPE * lengths * n_docs // max(n_terms, 1))
        for places, counts, numbers, gains in zip(
            *(postings.column(c) for c in ("places", "counts", "numbers", "gains"))
        ):
            there, often = _numbers(places, "<u4"), _numbers(counts, "<u4").astype(np.int64)
            worth = SCALE * often // (UNIT * often + damping[there])
            gain = np.asarray(gains.as_py(), np.int64)
            sums[np.ix_(numbers.as_py(), there)] += gain[:, None] * worth
        sums[~entering] *= held
        best = np.zeros(n_items, np.int64)
        if k <= len(lengths):
            best = np.partition(sums, len(lengths) - k, axis=1)[:, len(lengths) - k]
        left = rest[owner + 1 :].sum(axis=0)
        keep = (sums > 0) & (sums + left[:, None] >= best[:, None])
        of_item, there = np.nonzero(keep)
        columns = {
            "starts": np.searchsorted(of_item, np.arange(n_items + 1)).astype("<i8"),
            "places": there.astype("<u4"),
            "scores": sums[of_item, there].astype("<i8"),
            "open": (entering & (left >= best)).astype("u1"),
        }
        for name, value in columns.items():
            place = state.column_names.index(name)
            state = state.set_column(place, name, pa.array([value.tobytes()], pa.binary()))
        return state

    return add


def _best_of_blocks(states: DataFrame, k: int) -> DataFrame:
    """(bundle, number, id, score): the k best of each item in each block."""

    def run(batches):
        for batch in batches:
            bundles, numbers, found, scores = [], [], [], []
            for at in range(batch.num_rows):
                row = {name: batch.column(name)[at] for name in batch.schema.names}
                ids, sums = row["ids"].as_py(), _numbers(row["scores"], "<i8")
                starts, places = _numbers(row["starts"], "<i8"), _numbers(row["places"], "<u4")
                for number, (start, end) in enumerate(zip(starts[:-1], starts[1:])):
                    # Places go up with the ids, so a stable sort settles ties.
                    top = start + np.argsort(-sums[start:end], kind="stable")[:k]
                    bundles += [row["bundle"].as_py()] * len(top)
                    numbers += [number] * len(top)
                    found += [ids[p] for p in places[top].tolist()]
                    scores += sums[top].tolist()
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64()]
            columns = [bundles, numbers, found, scores]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, kinds)], ["bundle", "number", "id", "score"]
            )

    return states.mapInArrow(run, "bundle int, number int, id long, score long")


def search(
    docs: DataFrame,
    items: DataFrame,
    k=20,
    bundle_items=256,
    edges=(0.002, 0.02, 0.1),
    block=4096,
    key="doc_id",
    text="text",
    item_key="item_id",
    item_text="text",
) -> DataFrame:
    """The ``k`` documents of highest score for each item: (item_key, rank, key, score).

    Only scores above 0; equal scores by ascending id, documents without an id last. A null or
    empty text has no terms; it is found by no item and finds nothing. Rows that repeat are
    documents of their own; equal items count once, and items that share an id are one item.
    Owners hold terms by the share of documents that hold them: those below the first of
    ``edges`` the first owner, and so on. Empty tables give no rows.
    """
    spark = docs.sparkSession
    with scratch(spark) as stage:
        asked = stage(item_terms(items, item_key, item_text), "item-terms")
        indexed = stage(index(docs, asked, block, key, text), "index")
        blocks = indexed.where("term IS NULL")
        n_docs, n_terms = blocks.agg(F.sum("with_terms"), F.sum("total")).first()
        n_docs, n_terms = n_docs or 0, n_terms or 0

        # Every item gets a bundle and a number in it; bundles hold about bundle_items items.
        names = asked.select("item").distinct()
        bundles = -(-names.count() // bundle_items) or 1
        names = names.withColumn("bundle", F.pmod(F.xxhash64("item"), F.lit(bundles)).cast("int"))
        number = F.row_number().over(Window.partitionBy("bundle").orderBy("item")) - 1
        names = stage(names.withColumn("number", number), "items")

        df = indexed.where("term IS NOT NULL").groupBy("term").agg(F.sum("df").alias("df"))
        weight = F.floor(1000 * F.log((2.0 * n_docs + 2) / (2 * F.col("df") + 1))).cast("long")
        owner = sum((F.col("df") >= edge * n_docs).cast("int") for edge in edges)
        owners = len(edges) + 1
        wanted = (
            asked.join(df, "term")
            .join(names, asked["item"].eqNullSafe(names["item"]))
            .select("bundle", "number", "term", (F.col("repeats") * weight).alias("gain"), owner.alias("owner"))
        )
        wanted = stage(wanted, "wanted")
        # What an owner can add to an item at most.
        most = [F.coalesce(F.sum(F.when(F.col("owner") == o, F.col("gain"))), F.lit(0)) for o in range(owners)]
        rest = wanted.groupBy("bundle", "number").agg(F.array(*most).alias("most"))
        rest = (
            names.select("bundle", "number")
            .join(rest, ["bundle", "number"], "left")
            .groupBy("bundle")
            .agg(F.sort_array(F.collect_list(F.struct("number", "most"))).alias("list"))
        )
        states = _first_states(blocks, rest, bundles, owners)
        routes = wanted.groupBy("term", "owner", "bundle").agg(
            F.collect_list("number").alias("numbers"), F.collect_list("gain").alias("gains")
        )
        routed = indexed.where("term IS NOT NULL").select("block", "term", "places", "counts")
        routed = stage(routed.join(routes, "term").drop("term"), "postings")
        for o in range(owners):
            postings = routed.where(F.col("owner") == o).drop("owner")
            states = (
                states.groupBy("block", "bundle")
                .cogroup(postings.groupBy("block", "bundle"))
                .applyInArrow(_owner_stage(o, owners, k, n_docs, n_terms), _STATE)
            )
        best = _best_of_blocks(states, k).join(names, ["bundle", "number"])
        rank = F.row_number().over(
            Window.partitionBy("bundle", "number").orderBy(F.desc("score"), F.asc_nulls_last("id"))
        )
        ranked = best.withColumn("rank", rank).where(F.col("rank") <= k)
        return staged(
            ranked.select(
                F.col("item").alias(item_key), "rank", F.col("id").alias(key), "score"
            ),
            "ranked",
        )


def _first_states(blocks: DataFrame, rest: DataFrame, bundles: int, owners: int) -> DataFrame:
    """Every block for every bundle, without accumulators."""

    def run(batches):
        for batch in batches:
            rest, starts, entering = [], [], []
            for value in batch.column("list"):
                most = [one["most"] or [0] * owners for one in value.as_py()]
                rest.append((np.asarray(most, "<i8").T * _CEILING).tobytes())
                starts.append(np.zeros(len(most) + 1, "<i8").tobytes())
                entering.append(np.ones(len(most), "u1").tobytes())
            empty = pa.array([b""] * len(rest), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("block", "bundle", "ids", "lengths")),
                    pa.array(rest, pa.binary()),
                    pa.array(starts, pa.binary()),
                    empty,
                    empty,
                    pa.array(entering, pa.binary()),
                ],
                _STATE_NAMES,
            )

    every = F.explode(F.sequence(F.lit(0), F.lit(bundles - 1)))
    rows = blocks.select("block", "ids", "lengths", every.alias("bundle")).join(rest, "bundle")
    return rows.mapInArrow(run, _STATE)
