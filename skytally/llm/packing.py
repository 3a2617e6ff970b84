"""Packing by concatenation and cutting.

All token sequences, taken as one stream, are cut every ``length`` ids. The place of a
document in the stream is a prefix sum, taken in two passes: each task numbers the ids it
makes and the table of documents with their ids is stored; the totals of the tasks, one
number each, give the place where each task's part begins. Nothing is shuffled.
"""

from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytally.llm.common import staged
from skytally.llm.tokens import byte_bpe


def tokenised(docs: DataFrame, path: str, end_id=0, key="doc_id", text="text") -> DataFrame:
    """Each document with its ids and its place among the ids of its task.

    Columns: the key, part, part_start, n_tokens, ids (binary, little-endian unsigned 32-bit,
    closed by ``end_id``). A null text is an empty one.
    """
    schema = T.StructType(
        [
            T.StructField("key", docs.schema[key].dataType),
            T.StructField("part", T.IntegerType()),
            T.StructField("part_start", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids", T.BinaryType()),
        ]
    )
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        encoder, part, seen = byte_bpe(path), TaskContext.get().partitionId(), 0
        for batch in batches:
            ids = [encoder.ids(t) + end for t in batch.column(1).to_pylist()]
            sizes = [len(i) // 4 for i in ids]
            starts = list(accumulate(sizes, initial=seen))
            seen = starts.pop()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([part] * len(ids), pa.int32()),
                    pa.array(starts, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(ids, pa.binary()),
                ],
                ["key", "part", "part_start", "n_tokens", "ids"],
            )

    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, schema)


def pack(
    docs: DataFrame, path: str, length=1024, end_id=0, key="doc_id", text="text"
) -> DataFrame:
    """One row per piece: key, start, length, ids, doc_tokens, sequence_id, offset.

    Every id lies in exactly one piece; a document that crosses a cut has a piece on either
    side. All sequences but the last are full. ``ids`` is binary, little-endian unsigned
    32-bit. Documents keep the order of the input's partitions; repeated rows are packed as
    often as they come; an empty table gives no rows. The task totals that reach the driver
    are one number per input partition.
    """
    spark = docs.sparkSession
    stored = staged(tokenised(docs, path, end_id, key, text), "packing")
    totals = stored.groupBy("part").agg(F.sum("n_tokens").alias("total")).orderBy("part").collect()
    bases = accumulate((r.total for r in totals), initial=0)
    # From Arrow: rows would be made in Python workers, other ones than those of the ids, which stay.
    bases = spark.createDataFrame(
        pa.table(
            {
                "part": pa.array([r.part for r in totals], pa.int32()),
                "base": pa.array([b for _, b in zip(totals, bases)], pa.int64()),
            }
        )
    )
    placed = stored.join(F.broadcast(bases), "part").withColumn(
        "begin", F.col("base") + F.col("part_start")
    )
    end = F.col("begin") + F.col("n_tokens")
    first = F.floor(F.col("begin") / length).cast("long")
    last = F.floor((end - 1) / length).cast("long")
    pieces = placed.select(
        "*", F.explode(F.sequence(first, last, F.lit(1).cast("long"))).alias("sequence_id")
    )
    cut = F.col("sequence_id") * length
    start = F.greatest(cut, "begin") - F.col("begin")
    size = F.least(cut + length, end) - F.greatest(cut, "begin")
    return pieces.select(
        F.col("key").alias(key),
        start.alias("start"),
        size.alias("length"),
        F.substring("ids", (start * 4 + 1).cast("int"), (size * 4).cast("int")).alias("ids"),
        F.col("n_tokens").alias("doc_tokens"),
        "sequence_id",
        (F.greatest(cut, "begin") - cut).alias("offset"),
    )
