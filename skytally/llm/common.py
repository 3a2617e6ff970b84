"""What several operators of this subpackage share."""

import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skytally.session import drop_scratch, scratch_dir, ship_package


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables. What is computed from it may need this package in workers."""
    ship_package(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of steps that nothing refers to any more.

    It does so when the driver's garbage is collected, which is asked for here so that the
    files of a job with many steps do not pile up.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def staged(frame: DataFrame, label: str) -> DataFrame:
    """The rows, written to the shared scratch folder and read again.

    Cuts the lineage in a way that survives the loss of executors. Pass the frame without
    keeping it, so that the files of its steps can go.
    """
    spark, schema = frame.sparkSession, frame.schema
    ship_package(spark)
    path = scratch_dir(spark, label)
    release(spark)
    frame.write.option("compression", "zstd").parquet(path)
    del frame
    release(spark)
    return spark.read.schema(schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Gives a function like :func:`staged` for tables that are used up when the block ends.

    They are deleted then, also when it ends by an error.
    """
    ship_package(spark)
    paths = []

    def stage(frame: DataFrame, label: str) -> DataFrame:
        paths.append(scratch_dir(spark, label))
        frame.write.option("compression", "zstd").parquet(paths[-1])
        return spark.read.schema(frame.schema).parquet(paths[-1])

    try:
        yield stage
    finally:
        for path in paths:
            drop_scratch(spark, path)


def quoted(name: str):
    """The column of that very name, whatever characters are in it."""
    return F.col(f"`{name.replace('`', '``')}`")


def boxed(docs: DataFrame, text: str) -> DataFrame:
    """The text, and all other columns in one struct ``doc``, safe from clashing names."""
    others = [quoted(c).alias(c) for c in docs.columns if c != text]
    return docs.select(F.struct(*others).alias("doc"), quoted(text).alias("text"))


def unboxed(frame: DataFrame, columns: list[str], text: str, value) -> DataFrame:
    """The columns of documents again, with ``value`` as the text."""
    return frame.select(
        *[value.alias(c) if c == text else F.col("doc")[c].alias(c) for c in columns]
    )


def whole_number(value: Column) -> Column:
    """As a long; the ids these operators order documents by are whole numbers."""
    return value.cast("long")
