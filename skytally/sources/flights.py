"""Stored flight documents, as a whole and as a feed of what is new."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from skytally.schemas import FLIGHT_RAW


def read_flights(spark: SparkSession, path, schema: T.StructType | None = None) -> DataFrame:
    """Every flight document under ``path``; pages of the scan are its partitions."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def flights_changes(
    spark: SparkSession, path, schema: T.StructType = FLIGHT_RAW, max_files_per_trigger=None
) -> DataFrame:
    """New flight documents in micro-batches; the query's checkpoint keeps the position."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)
