"""Removal of byte strings that occurred before, by suffix arrays in shards.

Equal strings of ``length`` bytes must meet in one shard. Each window of that length has an
anchor, the gram in it with the least hash, which depends on the window's bytes only; windows
with the same anchor follow each other and form a fragment of the document. A window that
repeats has an anchor that repeats, so only fragments whose anchor occurs twice go on. Equal
fragments are merged where they are cut; the distinct ones go to the shard of their anchor,
where one suffix array over them shows every window that an earlier one equals.

A fragment equal to an earlier one repeats as a whole. So a document needs to hear only about
those of its fragments that are the first of their kind, and what frequent passages send
around are a row per task, not a row per copy.

Very frequent grams are bad anchors: they would call all their surroundings to one shard. The
grams frequent in a sample of documents are therefore taken last. This moves anchors, for all
documents alike, and changes no result.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytally.llm.common import boxed, quoted, scratch, staged, whole_number
from skytally.llm.suffixes import permuted_prefixes, suffix_array

_CHUNK = 1 << 18
_SHARD_BYTES = 2 << 20
_MERGED = 50_000
_SEPARATOR = 0xFF  # in no UTF-8 text
_PLANNING_DOCS = 1000
_FREQUENT = 0.01
_HIGH = np.uint64(0xFFFFFFFF00000000)
_LAST = np.uint64(1 << 63)


def gram_size(length: int) -> int:
    """The power of two that is about a third of the window."""
    return 1 << max(length // 3, 1).bit_length() - 1


def _gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of the ``size`` bytes from each position on, by doubling."""
    table = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    table = (table ^ (table >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    hashes, step = table[data], 1
    while step < size:
        joined = hashes[:-step] * np.uint64(0xD6E8FEB86659FD93 + 2 * step)
        joined += hashes[step:]
        hashes, step = joined ^ (joined >> np.uint64(32)), 2 * step
    return hashes * np.uint64(0x94D049BB133111EB)


def _window_minima(keys: np.ndarray, width: int) -> np.ndarray:
    """The least key of each ``width`` neighbours."""
    size = 1
    while 2 * size <= width:
        keys, size = np.minimum(keys[:-size], keys[size:]), 2 * size
    rest = width - size
    return np.minimum(keys[:-rest], keys[rest:]) if rest else keys


def fragments(data: np.ndarray, offsets: np.ndarray, length: int, frequent: np.ndarray):
    """Cut texts, which lie one behind the other, into fragments of windows with one anchor.

    Yields arrays (text number, first window's start in the text, number of windows, anchor),
    for stretches of the data. Each window that lies in one text is in one fragment. Windows
    whose bytes are equal have equal anchors. ``frequent``: sorted hashes that come last.
    """
    gram = gram_size(length)
    width = length - gram + 1
    for start in range(0, len(data) - length + 1, _CHUNK):
        stop = min(start + _CHUNK, len(data) - length + 1)  # of the windows' starts
        hashes = _gram_hashes(data[start : stop + length - 1], gram)
        places = np.arange(len(hashes), dtype=np.uint64)
        keys = ((hashes >> np.uint64(1)) & _HIGH) | places
        least = _window_minima(keys, width)
        if len(frequent):
            bad = _among(hashes[least.astype(np.uint32)], frequent)
            if bad.any():
                # All grams in windows with a frequent anchor, and of them the frequent ones.
                reach = np.zeros(len(hashes) + 1, np.int32)
                reach[: len(bad)] += bad
                reach[width : width + len(bad)] -= bad
                near = np.flatnonzero(np.cumsum(reach[:-1]) > 0)
                keys[near[_among(hashes[near], frequent)]] |= _LAST
                least = _window_minima(keys, width)
        anchor = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
        first = np.searchsorted(offsets, start, "right") - 1
        last = np.searchsorted(offsets, stop, "left")
        begin, end = offsets[first:last], offsets[first + 1 : last + 1]
        crossing = np.zeros(stop - start + 1, np.int32)  # windows that leave their text
        low = np.clip(np.maximum(begin, end - length + 1) - start, 0, stop - start)
        high = np.clip(end - start, 0, stop - start)
        np.add.at(crossing, low, 1)
        np.add.at(crossing, high, -1)
        anchor[np.cumsum(crossing[:-1]) > 0] = -1
        edges = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
        sizes = np.diff(np.append(edges, len(anchor)))
        keep = anchor[edges] >= 0
        edges, sizes = edges[keep], sizes[keep]
        text = np.searchsorted(offsets, edges + start, "right") - 1
        yield text, edges + start - offsets[text], sizes, hashes[anchor[edges]].astype(np.int64)


def _among(values: np.ndarray, sorted_: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(sorted_, values), len(sorted_) - 1)
    return sorted_[at] == values


def _bytes_of(column: pa.Array):
    """All texts of an Arrow column as one array of bytes, and where each begins."""
    column = column.fill_null("") if column.null_count else column
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets.astype(np.int64) - offsets[0]


def _frequent_grams(docs: DataFrame, length: int) -> np.ndarray:
    """Hashes of grams in a hundredth of a sample of about a thousand documents. At most a
    hundred times a document's size of them."""
    step = max(1, docs.count() // _PLANNING_DOCS)
    sample = docs.where(F.pmod(F.xxhash64("id", F.lit("plan")), F.lit(step)) == 0)

    def grams(batches):
        size = gram_size(length)
        for batch in batches:
            for text in batch.column("text"):
                data = np.frombuffer((text.as_py() or "").encode(), np.uint8)
                for at in range(0, max(len(data) - size + 1, 0), _CHUNK):
                    found = np.unique(_gram_hashes(data[at : at + _CHUNK + size - 1], size))
                    yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int64))], ["gram"])

    least = max(4, int(_FREQUENT * docs.count() / step))
    found = (
        sample.select("text")
        .mapInArrow(grams, "gram long")
        .groupBy("gram")
        .count()
        .where(F.col("count") >= least)
        .select("gram")
        .toArrow()
    )
    return np.sort(found.column(0).to_numpy().astype(np.uint64))


def _fragment_rows(docs: DataFrame, length: int, frequent: np.ndarray) -> DataFrame:
    def run(batches):
        for batch in batches:
            data, offsets = _bytes_of(batch.column("text"))
            ids = batch.column("id").to_numpy()
            for text, start, windows, anchor in fragments(data, offsets, length, frequent):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[text]),
                        pa.array(start.astype(np.int32)),
                        pa.array(windows.astype(np.int32)),
                        pa.array(anchor),
                    ],
                    ["id", "start", "windows", "anchor"],
                )

    return docs.mapInArrow(run, "id long, start int, windows int, anchor long")


def _distinct_fragments(length: int):
    """Cut the spans out of their texts and merge equal ones, as far as a task sees them."""

    def run(batches):
        merged: dict[tuple, tuple] = {}

        def rows():
            keys, firsts = list(merged), list(merged.values())
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k in keys], pa.int64()),
                    pa.array([k[1] for k in keys], pa.binary()),
                    pa.array([f[0] for f in firsts], pa.int64()),
                    pa.array([f[1] for f in firsts], pa.int32()),
                ],
                ["anchor", "fragment", "id", "start"],
            )

        for batch in batches:
            for i, text, spans in zip(
                batch.column("id").to_pylist(),
                batch.column("text").to_pylist(),
                batch.column("spans"),
            ):
                data = text.encode()
                parts = (part.to_numpy() for part in spans.values.flatten())
                for start, windows, anchor in zip(*(p.tolist() for p in parts)):
                    key = (anchor, data[start : start + windows + length - 1])
                    if merged.get(key, (i, start)) >= (i, start):
                        merged[key] = (i, start)
                if len(merged) >= _MERGED:
                    yield rows()
                    merged.clear()
        if merged:
            yield rows()

    return run


def _repeats_in_shard(length: int):
    """For each distinct fragment of a shard, its first place and which of its windows equal
    an earlier one: pairs of a first and a number of windows."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        # A fragment that several tasks cut comes several times; its first place counts.
        rows = rows.sort_values(["id", "start"]).drop_duplicates(["anchor", "fragment"])
        cut = rows["fragment"].tolist()
        sizes = np.array([len(x) for x in cut])
        text = np.frombuffer(bytes([_SEPARATOR]).join(cut), np.uint8)
        begin = np.cumsum(sizes + 1) - sizes - 1
        windows = sizes - length + 1
        starts = np.zeros(len(text) + 1, np.int32)
        starts[begin] += 1
        np.add.at(starts, begin + windows, -1)
        is_start = np.cumsum(starts[:-1]) > 0
        order = suffix_array(text, length)
        order = order[is_start[order]]
        shares = permuted_prefixes(text, order, length)
        # Runs of equal windows; fragments lie in the order of their places, so the least
        # position in a run is its first occurrence.
        heads = np.flatnonzero(~shares)
        earliest = np.minimum.reduceat(order, heads)
        earliest = np.repeat(earliest, np.diff(np.append(heads, len(order))))
        repeated = np.zeros(len(text) + 1, bool)
        repeated[order[order != earliest]] = True
        change = np.flatnonzero(repeated[1:] != repeated[:-1]) + 1
        change = np.r_[0, change] if repeated[0] else change
        low, high = change[::2], change[1::2]
        # Runs of repeated windows, by fragment; a run ends at its fragment's last window.
        owner = np.searchsorted(begin, low, "right") - 1
        cuts = np.searchsorted(owner, np.arange(len(cut) + 1))
        first, count = low - begin[owner], high - low
        return pd.DataFrame(
            {
                "id": rows["id"].to_numpy(),
                "start": rows["start"].to_numpy(),
                "first": [first[a:b].tolist() for a, b in zip(cuts, cuts[1:])],
                "count": [count[a:b].tolist() for a, b in zip(cuts, cuts[1:])],
            }
        )

    return run


def remove_repeats(docs: DataFrame, length=100, key="doc_id", text="text") -> DataFrame:
    """Every document with ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept``.

    Columns: doc (struct of the other columns), text, n_bytes (of the UTF-8 text), n_removed,
    n_spans (runs of removed bytes), kept (binary, the remaining bytes) and kept_text (the
    same as text, without characters of which a part was removed). A byte goes if a string of
    ``length`` bytes that covers it also starts earlier: in a document with a smaller id, or
    in the same one before. Matches lie inside documents and are judged on the input.

    A null text is empty. Rows with the same id and text are one document, and what is done
    to it is done to all of them. Of rows with one id and different texts those with the least
    text hash take part; the others, and rows without an id, stay whole. An empty table gives
    no rows.
    """
    spark = docs.sparkSession
    boxes = boxed(docs, text).withColumn("id", whole_number(F.col("doc")[key]))
    named = docs.select(whole_number(quoted(key)).alias("id"), quoted(text).alias("text"))
    named = named.where("id IS NOT NULL")
    mark = F.xxhash64(F.coalesce("text", F.lit("")))
    twins = staged(
        named.groupBy("id")
        .agg(F.min(mark).alias("low"), F.max(mark).alias("high"))
        .where("low < high")
        .drop("high"),
        "twins",
    )
    if not twins.isEmpty():
        chosen = F.col("low").isNull() | (F.col("low") == mark)
        named = named.join(twins, "id", "left").where(chosen).drop("low")
        boxes = boxes.join(twins, "id", "left").withColumn("id", F.when(chosen, F.col("id")))
        boxes = boxes.drop("low")
    named = named.where(F.octet_length("text") >= length)

    frequent = _frequent_grams(named, length)
    with scratch(spark) as stage:
        # Hashing all texts costs more than keeping where they were cut.
        cut = stage(_fragment_rows(named, length, frequent), "fragments")
        repeated = cut.groupBy("anchor").count().where("count > 1").select("anchor")
        repeated = stage(repeated, "anchors")
        spans = staged(
            cut.join(repeated, "anchor")
            .groupBy("id")
            .agg(F.collect_list(F.struct("start", "windows", "anchor")).alias("spans")),
            "spans",
        )

    total = spans.select(
        F.sum(F.expr(f"aggregate(spans, 0L, (s, x) -> s + x.windows + {length - 1})"))
    ).first()[0]
    shards = max(1, (total or 0) // _SHARD_BYTES)
    firsts = staged(
        named.join(spans, "id")
        .select("id", "text", "spans")
        .mapInArrow(
            _distinct_fragments(length), "anchor long, fragment binary, id long, start int"
        )
        .withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)).cast("int"))
        .groupBy("shard")
        .applyInPandas(
            _repeats_in_shard(length), "id long, start int, first array<int>, count array<int>"
        ),
        "firsts",
    )
    firsts = firsts.groupBy("id").agg(
        F.collect_list(F.struct("start", "first", "count")).alias("firsts")
    )
    marks = staged(
        spans.join(firsts, "id", "left").select(
            "id", F.transform("spans", lambda s: s.dropFields("anchor")).alias("spans"), "firsts"
        ),
        "marks",
    )
    return _without(boxes.join(marks, "id", "left"), length)


def _covered(size: int, spans, firsts, length: int) -> np.ndarray:
    """Which bytes of a text go. ``spans``: (start, windows) of fragments that repeat or are
    the first of their kind; ``firsts``: of the latter, (start, [first], [count])."""
    own = {start: (first, count) for start, first, count in firsts}
    change = np.zeros(size + 1, np.int32)
    low, high = [], []
    for start, windows in spans:
        if start in own:
            for first, count in zip(*own[start]):
                low.append(start + first)
                high.append(start + first + count - 1 + length)
        else:
            low.append(start)
            high.append(start + windows - 1 + length)
    np.add.at(change, low, 1)
    np.add.at(change, high, -1)
    return np.cumsum(change[:-1]) > 0


def _without(rows: DataFrame, length: int) -> DataFrame:
    schema = T.StructType(
        [
            rows.schema["doc"],
            rows.schema["text"],
            T.StructField("n_bytes", T.LongType()),
            T.StructField("n_removed", T.LongType()),
            T.StructField("n_spans", T.LongType()),
            T.StructField("kept", T.BinaryType()),
            T.StructField("kept_text", T.StringType()),
        ]
    )

    def run(batches):
        for batch in batches:
            out = []
            for text, spans, firsts in zip(
                batch.column("text").to_pylist(), batch.column("spans"), batch.column("firsts")
            ):
                data = (text or "").encode()
                if not spans.is_valid:
                    out.append((len(data), 0, 0, data, text or ""))
                    continue
                places = [x.to_pylist() for x in spans.values.flatten()]
                own = [x.to_pylist() for x in firsts.values.flatten()] if firsts.is_valid else [()] * 3
                gone = _covered(len(data), zip(*places), zip(*own), length)
                kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
                runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                out.append((len(data), int(gone.sum()), runs, kept, kept.decode(errors="ignore")))
            columns = list(zip(*out)) or [()] * 5
            kinds = [pa.int64()] * 3 + [pa.binary(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("text")]
                + [pa.array(c, k) for c, k in zip(columns, kinds)],
                schema.names,
            )

    return rows.select("doc", "text", "spans", "firsts").mapInArrow(run, schema)
