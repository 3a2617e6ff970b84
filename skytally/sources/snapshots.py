"""Snapshot documents as a table, in batch and as a stream."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytally.functions.text import real_number
from skytally.functions.timeconv import usable_time
from skytally.schemas import SNAPSHOT, numbers_as_text

CORRUPT = "_corrupt"


def _typed(aircraft, schema: T.StructType):
    """The list with its numbers as numbers; one that is none costs its field and no more."""
    fields = schema["aircraft"].dataType.elementType.fields

    def element(a):
        return F.struct(
            *[
                (real_number(a[f.name]) if isinstance(f.dataType, T.DoubleType) else a[f.name]).alias(f.name)
                for f in fields
            ]
        )

    return F.transform(aircraft, element).alias("aircraft")


def _shape(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Fill in receiver and arrival, which a single receiver's documents do not carry.

    A document without an arrival gets its file's time, and ``place`` is where in the file it
    stands: where its split begins and how many rows the task has read. A split is as long
    as all that a task reads, so this rises along the file. With an arrival, ``place`` is
    ``now``. Streams cannot number rows and have no ``place``: there documents without an
    arrival that share a file are ordered by ``now``.
    """
    modified = F.unix_micros("_metadata.file_modification_time") / 1e6
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    place = (F.col("_metadata.file_block_start") + row).cast("double")
    placed = F.when(F.col("arrival").isNull(), place).otherwise(F.col("now")).alias("place")
    return raw.select(
        F.coalesce("receiver", F.lit("default")).alias("receiver"),
        F.coalesce("arrival", modified).alias("arrival"),
        *([] if raw.isStreaming else [placed]),
        "now",
        "messages",
        _typed("aircraft", schema),
        CORRUPT,
    )


def _json(reader, schema, multiline):
    return (
        reader.schema(
            T.StructType([*numbers_as_text(schema).fields, T.StructField(CORRUPT, T.StringType())])
        )
        .option("multiLine", multiline)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
    )


def read_snapshots(
    spark: SparkSession, path, schema: T.StructType = SNAPSHOT, multiline=False
) -> DataFrame:
    """JSON snapshots under ``path``: one per line, or one per file with ``multiline``.

    Keys outside the schema are ignored. A document that cannot be parsed stays as a
    row with its text in ``_corrupt``; see :func:`split_rejects`.
    """
    return _shape(_json(spark.read, schema, multiline).json(path), schema)


def stream_snapshots(
    spark: SparkSession,
    path,
    schema: T.StructType = SNAPSHOT,
    multiline=False,
    max_files_per_trigger=None,
) -> DataFrame:
    """The same documents as an unbounded stream of files dropped into ``path``."""
    reader = _json(spark.readStream, schema, multiline)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return _shape(reader.json(path), schema)


def stream_snapshots_in_order(
    spark: SparkSession, path, schema: T.StructType = SNAPSHOT, max_files_per_trigger=None
) -> DataFrame:
    """Snapshots, one per line, as a stream that knows the order inside a file.

    Many tasks may share a file, and none holds more of it than some lines. ``place`` is, for
    documents without an arrival, where the line's split begins and how many lines the task has
    read, which rises along the file: see :func:`read_snapshots`. Else it is ``now``.
    """
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    modified = F.unix_micros("_metadata.file_modification_time") / 1e6
    lines = reader.text(path).select(
        modified.alias("_modified"), F.col("_metadata.file_block_start").alias("_line"), F.col("value").alias("_text")
    )
    # Lines of white space are no documents. A split has more bytes than it has other lines.
    lines = lines.where(F.length(F.trim(F.translate("_text", "\t", " "))) > 0)

    def number(batches):
        done = 0
        for batch in batches:
            place = batch.column("_line").to_numpy() + np.arange(done, done + len(batch))
            done += len(batch)
            columns = [batch.column("_modified"), pa.array(place, pa.int64()), batch.column("_text")]
            yield pa.RecordBatch.from_arrays(columns, ["_modified", "_line", "_text"])

    # Spark's own row numbers do not run on streams.
    lines = lines.mapInArrow(number, "_modified double, _line long, _text string")
    shape = T.StructType([*numbers_as_text(schema).fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    raw = lines.select("_modified", "_line", F.from_json("_text", shape, options).alias("r")).select(
        "_modified", "_line", "r.*"
    )
    placed = F.when(F.col("arrival").isNull(), F.col("_line").cast("double")).otherwise(F.col("now"))
    return raw.select(
        F.coalesce("receiver", F.lit("default")).alias("receiver"),
        F.coalesce("arrival", "_modified").alias("arrival"),
        placed.alias("place"),
        "now",
        "messages",
        _typed("aircraft", schema),
        CORRUPT,
    )


def stream_landing(
    spark: SparkSession, path, schema: T.StructType = SNAPSHOT, max_files_per_trigger=None
) -> DataFrame:
    """Snapshots from the landing table as they are added: already free of repeats, which
    is what the queries that fill the stored tables should be fed with."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path).select(*schema.names)


def _fault():
    """Why a snapshot cannot be used; null for one that can."""
    return (
        F.when(F.col(CORRUPT).isNotNull(), "unparsable")
        .when(F.col("now").isNull(), "no time")
        .when(~usable_time("now"), "impossible time")
        .when(F.col("aircraft").isNull(), "no list")
    )


def split_rejects(snapshots: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Usable snapshots, and the ones to log with their whole content and a ``reason``:
    unparsable, without a time or with one no clock can show, or without a list."""
    good = snapshots.where(_fault().isNull()).drop(CORRUPT)
    return good, snapshots.withColumn("reason", _fault()).where("reason IS NOT NULL")


def split_ahead(snapshots: DataFrame, seconds: float) -> tuple[DataFrame, DataFrame]:
    """Snapshots whose clock is at most ``seconds`` ahead of their arrival, and the others.

    One clock that runs ahead must not move a watermark that all receivers share.
    """
    ahead = F.coalesce(F.col("now") > F.col("arrival") + seconds, F.lit(False))
    return snapshots.where(~ahead), snapshots.where(ahead)


def usable(snapshots: DataFrame) -> DataFrame:
    """The usable ones of snapshots, whether they come from a reader or from the landing table."""
    if CORRUPT not in snapshots.columns:
        snapshots = snapshots.withColumn(CORRUPT, F.lit(None).cast("string"))
    return split_rejects(snapshots)[0]


def from_wire_message(messages: DataFrame, schema: T.StructType, column="message") -> DataFrame:
    """Records out of a column of JSON text; one that is not JSON gives null fields."""
    return messages.select(F.from_json(column, schema).alias("record")).select("record.*")


def to_wire_message(records: DataFrame, column="message") -> DataFrame:
    """Records as a column of JSON text."""
    return records.select(F.to_json(F.struct("*")).alias(column))
