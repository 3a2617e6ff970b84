"""Snapshots and flight documents derived from the ``events`` table.

The given tables hold no aircraft. Each event stands for one report: its user is the
aircraft, its number places it around home. Blank and one-letter callsigns and missing
coordinates occur, so that every filter has something to drop.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skytally.functions.geo import HOME_LAT, HOME_LON
from skytally.operators.aggregates import flight_rollup
from skytally.operators.enrich import enrich
from skytally.operators.flatten import clean_sightings, flight_documents
from skytally.session import configure

# Fixed inputs of the registered queries. Times are epoch seconds.
FLIGHT = "FL12"
RANGE_FROM = 1704844800  # 2024-01-10 00:00:00
RANGE_TO = 1705017600  # 2024-01-12 00:00:00
AS_OF = 1706140800  # 2024-01-25 00:00:00
AIRCRAFT_PER_SNAPSHOT = 16

# k is the number in the event's properties.
_FIELDS = {
    "flight": """
        CASE WHEN event_type = 'error' THEN '        '
             WHEN event_type = 'view' AND user_id % 5 = 0 THEN 'X       '
             ELSE rpad('FL' || user_id, 8, ' ') END""",
    "alt_baro": "CAST(floor(value * 100) AS INT)",
    "alt_geom": """
        CASE WHEN event_type = 'purchase' THEN NULL ELSE CAST(floor(value * 100) AS INT) + 25 END""",
    "geom_rate": "CAST(NULL AS INT)",
    "baro_rate": "CAST(floor(value) AS INT) * 64",
    "category": "'A' || (user_id % 8)",
    "gs": "value * 4D",
    "hex": "format_string('%06x', user_id)",
    "lat": f"""
        CASE WHEN event_id % 17 = 0 THEN NULL
             ELSE {HOME_LAT}D + (event_id % 41 - 20) * 0.001D END""",
    "lon": f"""
        CASE WHEN event_id % 19 = 0 THEN NULL
             ELSE {HOME_LON}D + (event_id % 37 - 18) * 0.001D END""",
    "nav_altitude_mcp": "CAST(k AS INT) * 400",
    "nav_heading": "CAST(k AS INT) * 3.5D",
    "nav_qnh": "1000D + CAST(k AS INT)",
    "squawk": "lpad(k, 4, '0')",
    "track": "CAST(event_id % 360 AS DOUBLE)",
}
_WHOLE_NUMBERS = ["alt_baro", "alt_geom", "geom_rate", "baro_rate", "nav_altitude_mcp"]


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One flat report per event, as it comes out of flattening snapshots."""
    keyed = events(spark, sf_dir).withColumn("k", F.get_json_object("props", "$.k"))
    return keyed.select(
        F.lit("r0").alias("receiver"),
        F.col("event_id").cast("double").alias("arrival"),
        (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("now"),
        (F.col("event_id") * 7).alias("messages"),
        *[F.expr(sql).alias(name) for name, sql in _FIELDS.items()],
    )


def _aircraft():
    """The report's fields as receivers send them: whole numbers may be any text."""
    fields = []
    for name in _FIELDS:
        value = F.col(name)
        if name in _WHOLE_NUMBERS:
            value = value.cast("string")
        if name == "alt_geom":
            value = F.coalesce(value, F.lit("ground"))
        fields.append(value.alias(name))
    return F.struct(*fields)


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One snapshot per report. No shuffle."""
    listed = F.when(F.col("now").isNotNull(), F.array(_aircraft()))
    return reports(spark, sf_dir).select(
        "receiver", "arrival", "now", "messages", listed.alias("aircraft")
    )


def grouped_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots of up to 16 aircraft: runs of event numbers, timed by their last whole
    second. Event numbers are unique, so no list can grow longer."""
    one = F.struct(F.col("arrival"), _aircraft().alias("a"))
    return (
        reports(spark, sf_dir)
        .groupBy(F.floor(F.col("arrival") / AIRCRAFT_PER_SNAPSHOT).cast("double").alias("g"))
        .agg(
            F.max(F.floor("now")).cast("double").alias("now"),
            F.max("messages").alias("messages"),
            F.sort_array(F.collect_list(one)).alias("items"),
        )
        .select(
            F.lit("r0").alias("receiver"),
            F.col("g").alias("arrival"),
            "now",
            "messages",
            F.col("items.a").alias("aircraft"),
        )
    )


def polled_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots of two receivers, one with most of the rows, whose clock stands still
    for some polls."""
    return snapshots(spark, sf_dir).select(
        F.when(F.col("messages") % 5 == 0, "r1").otherwise("r0").alias("receiver"),
        "arrival",
        F.floor(F.col("arrival") / 3).cast("double").alias("now"),
        "messages",
        "aircraft",
    )


def closing_snapshot(rows: DataFrame) -> DataFrame:
    """An empty snapshot a week after the last one; on a stream it closes all windows."""
    return rows.agg((F.max("now") + 7 * 86400).alias("now")).select(
        F.lit("r0").alias("receiver"),
        F.lit(-1.0).alias("arrival"),
        "now",
        F.lit(0).cast("bigint").alias("messages"),
        F.array().cast(rows.schema["aircraft"].dataType).alias("aircraft"),
    )


def sightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_sightings(reports(spark, sf_dir))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flight documents as the live path stores them, with the time they were stored."""
    rows = flight_documents(sightings(spark, sf_dir))
    return rows.withColumn("ingest_ts", F.floor("Timestamp"))


def text_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose timestamp is text: ISO, month first, fractional, whole, or junk."""
    moment = F.timestamp_seconds(F.floor("Timestamp"))
    kind = F.col("alt_baro")
    text = (
        F.when(kind % 97 == 13, "unknown")
        .when(kind % 4 == 0, F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(kind % 4 == 1, F.date_format(moment, "M/d/yyyy H:mm:ss"))
        .when(kind % 4 == 2, F.col("Timestamp").cast("decimal(20,6)").cast("string"))
        .otherwise(F.floor("Timestamp").cast("string"))
    )
    return documents(spark, sf_dir).withColumn("Timestamp", text)


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enriched flight documents: point and decimal timestamp."""
    return enrich(documents(spark, sf_dir))


def spotter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flight_rollup(flights(spark, sf_dir))
