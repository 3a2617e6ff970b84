"""Removal of lines that several documents share.

Distinct lines are known by a 128-bit hash. The hashes found in two documents or more are
spread over shards; each shard is a minimal perfect hash over one half of them, with compact
arrays in the order of its numbers: the other half as fingerprint, the count of documents, and
the first document. Documents send the hashes of their lines, not the lines, to the shards and
probe the arrays there. A shard that many lines go to, as a frequent line makes it, is copied
and the probing lines are dealt over the copies by document.
"""

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytally.llm import perfect_hash
from skytally.llm.common import boxed, staged, whole_number

_WHITE = b" \t\n\x0b\x0c\r"
_SHARD_KEYS = 1 << 15
_SHARD_LINES = 1 << 16
_HASHES = "key long, fingerprint long"


def line_hash(line: bytes, min_chars: int) -> bytes | None:
    """16 bytes for a line's key, or None if the key is shorter than ``min_chars``."""
    key = line.strip(_WHITE).lower()
    if len(key) < min_chars or len(key) < 4 * min_chars and len(key.decode()) < min_chars:
        return None
    return xxhash.xxh3_128_digest(key)


def line_hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    """One row for each document id and each distinct line of a document."""

    def run(batches):
        for batch in batches:
            ids, hashes = [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = {line_hash(x, min_chars) for x in text.encode().split(b"\n")} - {None}
                ids += [key] * len(found)
                hashes += found
            halves = np.frombuffer(b"".join(hashes), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(halves[:, 0]), pa.array(halves[:, 1])],
                ["id", "key", "fingerprint"],
            )

    return docs.mapInArrow(run, f"id long, {_HASHES}")


def _shard_arrays(rows: pd.DataFrame) -> pd.DataFrame:
    """The arrays of one shard. Two hashes that share a key are told apart by a list."""
    rows = rows.sort_values(["key", "fingerprint"])
    twins = rows["key"].duplicated()
    plain = rows[~twins]
    keys = plain["key"].to_numpy().astype(np.uint64)
    levels = perfect_hash.build(keys)
    order = np.argsort(perfect_hash.numbers(levels, keys))
    sizes, bits = perfect_hash.packed(levels)
    ordered = pd.concat([plain.iloc[order], rows[twins]])
    return pd.DataFrame(
        {
            "shard": [int(rows["shard"].iloc[0])],
            "n_lines": [int(rows["count"].sum())],
            "sizes": [sizes],
            "bits": [bits],
            "twin_keys": [rows["key"][twins].tolist()],
            "fingerprints": [ordered["fingerprint"].to_numpy("<i8").tobytes()],
            "counts": [ordered["count"].to_numpy("<i8").tobytes()],
            "firsts": [ordered["first"].to_numpy("<i8").tobytes()],
        }
    )


_ARRAYS = (
    "shard int, n_lines long, sizes array<long>, bits array<binary>, twin_keys array<long>,"
    " fingerprints binary, counts binary, firsts binary"
)


def probe(shard, keys: np.ndarray, fingerprints: np.ndarray):
    """Count and first document of each (key, fingerprint); count 0 if it isn't in the shard."""
    prints, counts, firsts = (
        np.frombuffer(shard[n], "<i8") for n in ("fingerprints", "counts", "firsts")
    )
    count, first = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
    places = perfect_hash.numbers(
        perfect_hash.unpacked(shard["sizes"], shard["bits"]), keys.astype(np.uint64)
    )
    candidates = [(np.arange(len(keys)), places)]
    base = len(prints) - len(shard["twin_keys"])
    for i, twin in enumerate(shard["twin_keys"]):
        same = np.flatnonzero(keys == twin)
        candidates.append((same, np.full(len(same), base + i)))
    for rows, at in candidates:
        ok = at >= 0
        rows, at = rows[ok], at[ok]
        ok = prints[at] == fingerprints[rows]
        count[rows[ok]], first[rows[ok]] = counts[at[ok]], firsts[at[ok]]
    return count, first


def dedup_lines(
    docs: DataFrame, min_chars=10, min_docs=2, key="doc_id", text="text"
) -> DataFrame:
    """Every document with ``n_lines``, ``n_dropped`` and ``kept``, its text without the lines
    that at least ``min_docs`` documents hold, except in the smallest id holding them.

    Columns: doc (struct of the other columns), text, n_lines, n_dropped, kept. A line's key is
    the line stripped of ASCII white space and with A-Z lower-cased; shorter keys than
    ``min_chars`` code points stay. A null or empty text is one empty line. Rows that share an
    id are one document for the count; rows without an id keep all their lines. ``min_docs``
    is 2 at least. Empty tables give no rows.
    """
    boxes = boxed(docs, text).withColumn("id", whole_number(F.col("doc")[key]))
    known = boxes.where("id IS NOT NULL AND text IS NOT NULL").select("id", "text")
    lines = staged(line_hashes(known, min_chars), "lines")
    shared = (
        lines.groupBy("key", "fingerprint")
        .agg(
            F.min("id").alias("first"),
            F.max("id").alias("last"),
            (F.count("*") if min_docs == 2 else F.count_distinct("id")).alias("count"),
        )
        .where((F.col("first") < F.col("last")) & (F.col("count") >= min_docs))
        .drop("last")
    )
    shared = staged(shared, "shared-lines")
    n_keys, n_lines = shared.count(), lines.count()
    shards = max(math.ceil(n_keys / _SHARD_KEYS), math.ceil(n_lines / _SHARD_LINES), 1)
    shard = F.pmod(F.xxhash64("fingerprint"), F.lit(shards)).cast("int").alias("shard")
    arrays = (
        shared.select("*", shard).groupBy("shard").applyInPandas(_shard_arrays, _ARRAYS)
    )
    arrays = staged(arrays, "line-arrays").withColumn(
        "copies", (F.col("n_lines") / _SHARD_LINES).cast("int") + 1
    )

    copies = arrays.select("shard", "copies")
    dealt = lines.select("*", shard).join(copies, "shard").withColumn(
        "copy", F.pmod(F.xxhash64("id"), F.col("copies")).cast("int")
    )
    copied = arrays.withColumn("copy", F.explode(F.expr("sequence(0, copies - 1)")))

    def probed(rows: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
        if not len(shard) or not len(rows):
            return pd.DataFrame({"id": [], "fingerprint": [], "key": []}).astype("int64")
        count, first = probe(
            shard.iloc[0], rows["key"].to_numpy(), rows["fingerprint"].to_numpy()
        )
        drop = (count >= min_docs) & (first != rows["id"].to_numpy())
        return rows.loc[drop, ["id", "fingerprint", "key"]]

    drops = (
        dealt.select("shard", "copy", "id", "key", "fingerprint")
        .groupBy("shard", "copy")
        .cogroup(copied.drop("copies", "n_lines").groupBy("shard", "copy"))
        .applyInPandas(probed, f"id long, fingerprint long, key long")
        .groupBy("id")
        .agg(F.collect_list(F.struct("key", "fingerprint")).alias("drops"))
    )
    return _without(boxes.join(drops, "id", "left").drop("id"), min_chars)


def _without(rows: DataFrame, min_chars: int) -> DataFrame:
    """The documents without the lines in ``drops``."""
    schema = T.StructType(
        [
            rows.schema["doc"],
            rows.schema["text"],
            T.StructField("n_lines", T.LongType()),
            T.StructField("n_dropped", T.LongType()),
            T.StructField("kept", T.StringType()),
        ]
    )

    def run(batches):
        for batch in batches:
            total, dropped, kept = [], [], []
            for text, drops in zip(batch.column("text").to_pylist(), batch.column("drops")):
                lines = (text or "").encode().split(b"\n")
                left = lines
                if drops.is_valid:
                    halves = drops.values.flatten()
                    halves = np.stack([h.to_numpy() for h in halves], axis=1).astype("<i8")
                    gone = {h.tobytes() for h in halves}
                    left = [x for x in lines if line_hash(x, min_chars) not in gone]
                total.append(len(lines))
                dropped.append(len(lines) - len(left))
                kept.append(b"\n".join(left).decode())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc"),
                    batch.column("text"),
                    pa.array(total, pa.int64()),
                    pa.array(dropped, pa.int64()),
                    pa.array(kept, pa.string()),
                ],
                ["doc", "text", "n_lines", "n_dropped", "kept"],
            )

    return rows.select("doc", "text", "drops").mapInArrow(run, schema)
