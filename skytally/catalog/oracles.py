"""The same queries as SQL over the given tables, written without the engine's code.

Each statement is put together from named common table expressions; only those a
statement needs are included.
"""

import re

from skytally.catalog.samples import AS_OF, FLIGHT, RANGE_FROM, RANGE_TO

_HOME_LAT, _HOME_LON = "29.75959e0", "(-95.80341e0)"


def _plain(number):
    return f"rtrim(rtrim(CAST(CAST({number} AS DECIMAL(20,6)) AS VARCHAR), '0'), '.')"


def _haversine(lat, lon):
    # least() passes over a null, hence the CASE.
    return (
        f"CASE WHEN {lat} IS NOT NULL AND {lon} IS NOT NULL THEN"
        f" 2 * 6371008.8e0 * asin(least(1e0, sqrt("
        f"pow(sin((radians({lat}) - radians({_HOME_LAT})) / 2), 2) + cos(radians({_HOME_LAT}))"
        f" * cos(radians({lat})) * pow(sin((radians({lon}) - radians({_HOME_LON})) / 2), 2)))) END"
    )


_CTES = {
    # One report per event.
    "report": f"""
        SELECT event_id, CAST(event_id AS DOUBLE) AS arrival, epoch_us(ts) / 1e6 AS "now",
               event_id * 7 AS messages,
               CASE WHEN event_type = 'error' THEN '        '
                    WHEN event_type = 'view' AND user_id % 5 = 0 THEN 'X       '
                    ELSE rpad('FL' || user_id, 8, ' ') END AS flight,
               CAST(floor(value * 100) AS INTEGER) AS alt_baro,
               CASE WHEN event_type = 'purchase' THEN NULL
                    ELSE CAST(floor(value * 100) AS INTEGER) + 25 END AS alt_geom,
               CAST(NULL AS INTEGER) AS geom_rate,
               CAST(floor(value) AS INTEGER) * 64 AS baro_rate,
               'A' || (user_id % 8) AS category,
               value * 4e0 AS gs,
               printf('%06x', user_id) AS hex,
               CASE WHEN event_id % 17 = 0 THEN NULL
                    ELSE {_HOME_LAT} + (event_id % 41 - 20) * 0.001e0 END AS lat,
               CASE WHEN event_id % 19 = 0 THEN NULL
                    ELSE {_HOME_LON} + (event_id % 37 - 18) * 0.001e0 END AS lon,
               CAST(json_extract_string(props, '$.k') AS INTEGER) * 400 AS nav_altitude_mcp,
               CAST(json_extract_string(props, '$.k') AS INTEGER) * 3.5e0 AS nav_heading,
               1000e0 + CAST(json_extract_string(props, '$.k') AS INTEGER) AS nav_qnh,
               lpad(json_extract_string(props, '$.k'), 4, '0') AS code,
               CAST(event_id % 360 AS DOUBLE) AS track
        FROM events""",
    # Reports that pass the callsign and position filters, measured from home.
    "sighting": f"""
        SELECT event_id, rtrim(flight) AS PartitionKey, "now" AS RowKey,
               {_plain('"now"')} || '-' || rtrim(flight) AS id,
               alt_baro, alt_geom, geom_rate, baro_rate, category, gs, hex, lat, lon,
               nav_altitude_mcp, nav_heading, nav_qnh, CAST(code AS DOUBLE) AS squawk, track,
               {_haversine("lat", "lon")} AS metres
        FROM report
        WHERE length(rtrim(flight)) > 1 AND lon IS NOT NULL AND lat IS NOT NULL""",
    # The flight documents, one per id; seconds is the enriched timestamp.
    "document": """
        SELECT id, PartitionKey AS flight, RowKey AS "Timestamp", alt_baro, alt_geom, baro_rate,
               category, gs, hex, lat, lon, nav_altitude_mcp, nav_heading, nav_qnh, squawk, track,
               CAST(floor(RowKey) AS BIGINT) AS ingest_ts, metres
        FROM sighting
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY hex) = 1""",
    # The documents with a timestamp in mixed text forms.
    "texted": """
        SELECT * REPLACE (
            CASE WHEN alt_baro % 97 = 13 THEN 'unknown'
                 WHEN alt_baro % 4 = 0
                     THEN strftime(make_timestamp(ingest_ts * 1000000), '%Y-%m-%dT%H:%M:%SZ')
                 WHEN alt_baro % 4 = 1
                     THEN strftime(make_timestamp(ingest_ts * 1000000), '%-m/%-d/%Y %-H:%M:%S')
                 WHEN alt_baro % 4 = 2
                     THEN CAST(CAST("Timestamp" AS DECIMAL(20,6)) AS VARCHAR)
                 ELSE CAST(ingest_ts AS VARCHAR) END AS "Timestamp")
        FROM document""",
    # The same with the text read back as seconds.
    "readable": """
        SELECT *, coalesce(
            TRY_CAST("Timestamp" AS DECIMAL(20,6)),
            CAST(epoch(try_strptime("Timestamp", '%Y-%m-%dT%H:%M:%SZ')) AS DECIMAL(20,6)),
            CAST(epoch(try_strptime("Timestamp", '%m/%d/%Y %H:%M:%S')) AS DECIMAL(20,6))) AS seconds
        FROM texted""",
    "spotter": """
        SELECT flight AS id, count(flight) AS "count",
               max("Timestamp") AS last_seen, min(metres) AS closest
        FROM document GROUP BY flight""",
    "earlier": f"""
        SELECT flight AS id, count(flight) AS "count",
               max("Timestamp") AS last_seen, min(metres) AS closest
        FROM document WHERE "Timestamp" > 0 AND "Timestamp" < {AS_OF} GROUP BY flight""",
    # Runs of event numbers as snapshots of up to 16 aircraft.
    "groups": """
        SELECT event_id // 16 AS g, CAST(max(floor("now")) AS DOUBLE) AS "now",
               max(messages) AS messages, CAST(count(*) AS INTEGER) AS n
        FROM report GROUP BY event_id // 16""",
    # Polls of two receivers; a poll is kept when the clock moved since the one before.
    "polled": """
        SELECT event_id, CASE WHEN messages % 5 = 0 THEN 'r1' ELSE 'r0' END AS receiver, arrival,
               CAST(event_id // 3 AS DOUBLE) AS "now", messages
        FROM report""",
    "kept": """
        SELECT receiver, arrival, "now", messages FROM (
            SELECT *, coalesce(lag("now") OVER (PARTITION BY receiver ORDER BY event_id), 0) AS past
            FROM polled) WHERE past <> "now" """,
}

_MEASURES = (
    "alt_baro, baro_rate, category, gs, hex, lat, lon, nav_altitude_mcp, nav_heading, nav_qnh,"
    " squawk, track"
)
_DOCUMENT = f'id, flight, "Timestamp", alt_geom, {_MEASURES}'
_FLAT_POINT = (
    'id, flight, "Timestamp", alt_baro, alt_geom, baro_rate, category, gs, hex,'
    " nav_altitude_mcp, nav_heading, nav_qnh, squawk, track, lon AS p_lon, lat AS p_lat"
)
_AIRCRAFT = f"SELECT PartitionKey, RowKey, alt_geom, {_MEASURES} FROM sighting"
_CLOSEST = "closestDistanceInMetresFromMyLocation"
_SPOTTER = f'id, "count", last_seen, round(closest, 3) AS "{_CLOSEST}"'


def _windows(seconds):
    last = f"CAST(ceil(floor(RowKey) / {seconds}e0) * {seconds} AS BIGINT)"
    return f"""
        SELECT PartitionKey AS flight, {last} - {seconds} AS "FirstSeen", {last} AS "LastSeen",
               round(min(metres), 0) AS "closestDistanceInMetresFromHome",
               count(*) AS "RecordCount"
        FROM sighting WHERE metres < 1000 GROUP BY 1, 2, 3"""


def _patched(due):
    """Documents after patching those that are due and readable."""
    need = f"(seconds IS NOT NULL AND {due})"
    return f"""
        SELECT id, flight,
               CASE WHEN {need} THEN {_plain("seconds")} ELSE "Timestamp" END AS "Timestamp",
               CASE WHEN NOT {need} THEN lat END AS lat,
               CASE WHEN NOT {need} THEN lon END AS lon,
               CASE WHEN {need} THEN lon END AS p_lon,
               CASE WHEN {need} THEN lat END AS p_lat,
               ingest_ts
        FROM readable"""


_UNPATCHED = """
    SELECT id, flight, "Timestamp", lat, lon FROM readable
    WHERE NOT (seconds IS NOT NULL AND alt_baro < 2000)"""

_LANDED = f"""
    SELECT receiver, arrival, "now", CAST(messages AS VARCHAR) AS "MessageCount",
           {_plain('"now"')} AS "TimeStamp", '1' AS "CountOfAircraft",
           CAST(row_number() OVER (PARTITION BY receiver ORDER BY arrival) - 1 AS VARCHAR)
               AS "SequenceNumber"
    FROM kept"""

_FIRST_DISTANCE = f"(SELECT min_by(metres, \"Timestamp\") FROM document WHERE flight = '{FLIGHT}')"

_REFRESHED = f"""
    SELECT {_SPOTTER} FROM (
        SELECT * FROM spotter
        UNION ALL SELECT id || '-old', "count", last_seen, closest FROM earlier)"""

_REPORT_DISTANCE = f"SELECT arrival, round({_haversine('lat', 'lon')}, 3) AS metres FROM report"

_F = "(1 / 298.257223563e0)"
_WGS84 = f"""
    WITH radian AS (
        SELECT arrival, atan((1 - {_F}) * tan(radians(lat))) AS b2,
               atan((1 - {_F}) * tan(radians({_HOME_LAT}))) AS b1,
               radians(lon) - radians({_HOME_LON}) AS dl
        FROM report),
    angle AS (
        SELECT *, 2 * asin(least(1e0, sqrt(pow(sin((b2 - b1) / 2), 2)
                  + cos(b1) * cos(b2) * pow(sin(dl / 2), 2)))) AS s
        FROM radian)
    SELECT arrival, round(CASE WHEN b2 IS NULL OR dl IS NULL THEN NULL WHEN s = 0 THEN 0 ELSE 6378137e0 * (s - {_F} / 2 * (
        (s - sin(s)) * pow(sin((b1 + b2) / 2) * cos((b2 - b1) / 2) / cos(s / 2), 2)
        + (s + sin(s)) * pow(cos((b1 + b2) / 2) * sin((b2 - b1) / 2) / sin(s / 2), 2))) END, 3)
        AS metres
    FROM angle"""



def _geodesic():
    """Vincenty's iteration on the longitude, which converges at once for places near home."""
    angles = """
        sqrt(pow(cos(b2) * sin(w), 2) + pow(cos(b1) * sin(b2) - sin(b1) * cos(b2) * cos(w), 2)) AS ss,
        sin(b1) * sin(b2) + cos(b1) * cos(b2) * cos(w) AS cs, atan2(ss, cs) AS s,
        CASE WHEN ss = 0 THEN 0 ELSE cos(b1) * cos(b2) * sin(w) / ss END AS sa, 1 - sa * sa AS ca,
        cs - 2 * sin(b1) * sin(b2) / ca AS cm"""
    steps = [
        f"""step0 AS (
            SELECT arrival, atan((1 - {_F}) * tan(radians(lat))) AS b2,
                   atan((1 - {_F}) * tan(radians({_HOME_LAT}))) AS b1,
                   radians(lon) - radians({_HOME_LON}) AS dl, dl AS w
            FROM report)"""
    ]
    for i in range(1, 6):
        steps.append(f"""step{i} AS (
            SELECT arrival, b1, b2, dl, dl + (1 - c) * {_F} * sa * (
                s + c * ss * (cm + c * cs * (2 * cm * cm - 1))) AS w
            FROM (SELECT *, {angles}, {_F} / 16 * ca * (4 + {_F} * (4 - 3 * ca)) AS c FROM step{i - 1}))""")
    axis = f"(6378137e0 * (1 - {_F}))"
    return f"""
        WITH {", ".join(steps)},
        last AS (SELECT *, {angles}, ca * (pow(6378137e0 / {axis}, 2) - 1) AS u FROM step5),
        series AS (
            SELECT *, 1 + u / 16384 * (4096 + u * (-768 + u * (320 - 175 * u))) AS a,
                   u / 1024 * (256 + u * (-128 + u * (74 - 47 * u))) AS b
            FROM last)
        SELECT arrival, round({axis} * a * (s - b * ss * (cm + b / 4 * (cs * (2 * cm * cm - 1)
            - b / 6 * cm * (4 * ss * ss - 3) * (4 * cm * cm - 3)))), 2) AS metres
        FROM series"""


_SUMMARY = "SELECT 'r0' AS receiver, CAST(g AS DOUBLE) AS arrival, \"now\", messages, n FROM groups"

_SQL = {
    "read_snapshots": _SUMMARY,
    "stream_snapshots": _SUMMARY,
    "read_flights": f"SELECT {_DOCUMENT}, ingest_ts FROM document",
    "flights_changes": f"SELECT {_DOCUMENT}, ingest_ts FROM document",
    "from_wire_message": f"SELECT {_SPOTTER} FROM spotter",
    "write_aircraft": f"""{_AIRCRAFT}
        QUALIFY row_number() OVER (PARTITION BY PartitionKey, RowKey ORDER BY hex) = 1""",
    "write_nearby": _windows(180),
    "write_flights": f"""
        SELECT {_DOCUMENT}, ingest_ts, strftime(make_timestamp(ingest_ts * 1000000), '%Y-%m-%d') AS "date"
        FROM document""",
    "write_flights_twice": f"""
        SELECT {_DOCUMENT}, ingest_ts, strftime(make_timestamp(ingest_ts * 1000000), '%Y-%m-%d') AS "date"
        FROM document""",
    "compacted_flights": f"SELECT {_DOCUMENT} FROM document",
    "upsert_by_key": _REFRESHED,
    "patch_by_key": _patched("TRUE"),
    "fan_out_sinks": f"""
        SELECT 'aircraft' AS sink, flight, "Timestamp" AS at, hex AS detail FROM document
        UNION ALL SELECT 'flights', flight, "Timestamp", hex FROM document
        UNION ALL SELECT 'nearby', flight, CAST("LastSeen" AS DOUBLE), CAST("RecordCount" AS VARCHAR)
        FROM ({_windows(180)})""",
    "explode_aircraft": """
        SELECT groups."now", CAST(g AS DOUBLE) AS arrival, hex, flight,
               CAST(alt_baro AS VARCHAR) AS alt_baro, track
        FROM report JOIN groups ON g = event_id // 16""",
    "flatten_aircraft": f"""
        SELECT "now", flight, alt_geom, geom_rate, {_MEASURES.replace("squawk", "code AS squawk")}
        FROM report""",
    "all_flights": f"""
        SELECT PartitionKey, RowKey, id, alt_geom, geom_rate, {_MEASURES},
               round(metres, 3) AS "distanceInMetresFromHome"
        FROM sighting""",
    "close_aircraft": """
        SELECT PartitionKey AS flight, round(metres, 3) AS "distanceInMetresFromHome"
        FROM sighting WHERE metres < 1000""",
    "aircraft_rows": _AIRCRAFT,
    "flight_documents": f"""
        SELECT id, PartitionKey AS flight, RowKey AS "Timestamp", alt_geom, {_MEASURES}
        FROM sighting""",
    "one_per_callsign": f"""
        SELECT rtrim(flight) AS PartitionKey, groups."now" AS RowKey,
               {_plain('groups."now"')} || '-' || rtrim(flight) AS id, min(hex) AS hex
        FROM report JOIN groups ON g = event_id // 16
        WHERE length(rtrim(flight)) > 1 AND lat IS NOT NULL AND lon IS NOT NULL
        GROUP BY g, groups."now", rtrim(flight)""",
    "select_star": f"SELECT {_DOCUMENT}, ingest_ts FROM document WHERE alt_baro > 10000",
    "const_columns": """
        SELECT DISTINCT flight, CAST(0 AS INTEGER) AS "count", CAST(0 AS DOUBLE) AS last_seen
        FROM document""",
    "rename_keys": 'SELECT PartitionKey AS flight, RowKey AS "Timestamp", hex FROM sighting',
    "envelope": _LANDED,
    "dedupe_snapshots": 'SELECT receiver, arrival, "now", messages FROM kept',
    "has_callsign": "SELECT arrival, flight, hex FROM report WHERE length(rtrim(flight)) > 1",
    "has_position": """
        SELECT arrival, lat, lon FROM report WHERE lat IS NOT NULL AND lon IS NOT NULL""",
    "within_radius": """
        SELECT id, lat, lon, round(metres, 3) AS "distanceInMetresFromHome"
        FROM sighting WHERE metres < 100""",
    "needs_location": _UNPATCHED,
    "unprocessed_flights": _UNPATCHED,
    "backfill_candidates": f"""
        SELECT id, flight, "Timestamp", lat, lon, ingest_ts FROM document
        WHERE lat > 0 AND ingest_ts < {AS_OF} - 7200""",
    "flight_eq": f"SELECT {_FLAT_POINT}, ingest_ts FROM document WHERE flight = '{FLIGHT}'",
    "time_between": f"""
        SELECT {_FLAT_POINT}, ingest_ts FROM document
        WHERE "Timestamp" > {RANGE_FROM} AND "Timestamp" < {RANGE_TO}""",
    "time_between_whole": f"""
        SELECT id, flight, ingest_ts FROM document
        WHERE ingest_ts >= {RANGE_FROM} AND ingest_ts <= {RANGE_TO}""",
    "time_after": f"""
        SELECT {_FLAT_POINT}, ingest_ts FROM document WHERE "Timestamp" > {RANGE_FROM}""",
    "time_eq": f"""
        SELECT {_FLAT_POINT}, ingest_ts FROM document
        WHERE "Timestamp" = (SELECT max("Timestamp") FROM document)""",
    "distance_eq": f"""
        SELECT id, flight, "Timestamp", lon AS p_lon, lat AS p_lat FROM document
        WHERE abs(metres - {_FIRST_DISTANCE}) <= 0.01""",
    "points_within": """
        SELECT id, flight, round(metres, 3) AS metres FROM document WHERE metres < 400""",
    "points_in_ring": """
        SELECT id, flight, round(metres, 3) AS metres FROM document
        WHERE abs(metres - 1000) <= 25""",
    "flight_rollup": f"SELECT {_SPOTTER} FROM spotter",
    "flight_rollup_one": f"SELECT {_SPOTTER} FROM spotter WHERE id = '{FLIGHT}'",
    "first_at_distance": f"""
        SELECT flight, min("Timestamp") AS "TimeStamp", alt_geom, lon AS p_lon, lat AS p_lat
        FROM document
        WHERE flight = '{FLIGHT}' AND abs(metres - {_FIRST_DISTANCE}) <= 0.01
        GROUP BY flight, alt_geom, lon, lat""",
    "distinct_flights": f"""
        SELECT DISTINCT flight AS id, CAST(0 AS BIGINT) AS "count", CAST(0 AS DOUBLE) AS last_seen,
               CAST(0 AS DOUBLE) AS "{_CLOSEST}"
        FROM document""",
    "distinct_flights_at": """
        SELECT DISTINCT flight FROM document
        WHERE "Timestamp" = (SELECT max("Timestamp") FROM document)""",
    "nearby_windows_3m": _windows(180),
    "nearby_windows_1d": _windows(86400),
    "flight_metric": """
        SELECT flight, count(*) AS "count" FROM readable WHERE seconds IS NOT NULL
        GROUP BY flight""",
    "batch_size_metric": f"""
        SELECT 'fetched' AS metric, count(*) AS n FROM document
        WHERE lat > 0 AND ingest_ts < {AS_OF} - 7200""",
    "seen_within_radius": f"""
        SELECT id, round(closest, 3) AS "{_CLOSEST}",
               CAST(round(last_seen * 1e6) AS BIGINT) AS last_seen
        FROM spotter WHERE closest < 1000 ORDER BY last_seen DESC, id""",
    "closest_10": f"""
        SELECT id, round(closest) AS "{_CLOSEST}",
               CAST(round(last_seen * 1000) AS BIGINT) * 1000 AS last_seen_utc
        FROM spotter WHERE closest < 1000 ORDER BY closest, id LIMIT 10""",
    "within_100m": f"""
        SELECT id, round(closest) AS "{_CLOSEST}",
               CAST(round(last_seen * 1000) AS BIGINT) * 1000 AS last_seen_utc
        FROM spotter WHERE closest < 100 ORDER BY closest, id""",
    "flight_log": """
        SELECT flight, CAST(round("Timestamp" * 1000) AS BIGINT) * 1000 AS "Timestamp",
               round(metres) AS "distanceInMetresFromMyLocation"
        FROM document ORDER BY document."Timestamp", flight, id""",
    "st_distance": _REPORT_DISTANCE,
    "st_distance_wgs84": _WGS84,
    "st_distance_geodesic": _geodesic(),
    "create_point": f"""
        SELECT arrival, lat, lon, round({_haversine('lat', 'lon')}, 3) AS metres
        FROM report WHERE lat IS NOT NULL AND lon IS NOT NULL""",
    "geojson_point": """
        SELECT arrival, 'Point' AS "type", lon AS "first", lat AS "second"
        FROM report WHERE lat IS NOT NULL AND lon IS NOT NULL""",
    "st_distance_point": "SELECT id, round(metres, 3) AS metres FROM document",
    "clean_callsign": "SELECT arrival, rtrim(flight) AS callsign FROM report",
    "str_len": """
        SELECT arrival, CAST(length(flight) AS INTEGER) AS padded,
               CAST(length(rtrim(flight)) AS INTEGER) AS cut
        FROM report""",
    "sighting_id": f"SELECT arrival, {_plain('now')} || '-' || rtrim(flight) AS id FROM report",
    "squawk_num": """
        SELECT event_id, code, TRY_CAST(code AS DOUBLE) AS squawk FROM (
            SELECT event_id, CASE WHEN event_type = 'signup' THEN 'n/a'
                   ELSE lpad(json_extract_string(props, '$.k'), 4, '0') END AS code
            FROM events)""",
    "round_metres": """
        SELECT event_id, round(value * CASE WHEN event_id % 2 = 0 THEN -0.5e0 ELSE 0.5e0 END, 0)
            AS rounded
        FROM events""",
    "scale_ms": 'SELECT arrival, "now" * 1000e0 AS ms, "now" / 1000e0 AS s FROM report',
    "parse_number": """
        SELECT id, "Timestamp", CAST(TRY_CAST("Timestamp" AS DECIMAL(20,6)) AS DOUBLE) AS number
        FROM texted""",
    "numeric_timestamp": """
        SELECT id, "Timestamp", CAST(seconds AS DOUBLE) AS seconds FROM readable""",
    "event_time": 'SELECT arrival, CAST(floor("now") AS BIGINT) * 1000000 AS us FROM report',
    "to_datetime": 'SELECT arrival, CAST(round("now" * 1000) AS BIGINT) * 1000 AS us FROM report',
    "to_epoch_ms": "SELECT event_id, epoch_us(ts) // 1000 AS ms FROM events",
    "date_add_part": """
        SELECT event_id, epoch_us(ts - INTERVAL 2 HOUR) AS two_hours_before,
               epoch_us(ts - INTERVAL 3 MINUTE) AS three_minutes_before,
               epoch_us(ts + INTERVAL 90 SECOND) AS ninety_seconds_after
        FROM events""",
    "now_fn": "SELECT event_id, epoch_us(ts) AS us, TRUE AS past FROM events",
    "ago_epoch": """
        SELECT event_id,
               CAST(round((epoch_us(ts) // 1000 - 7200000) / 1000e0) AS BIGINT) AS two_hours_ago,
               CAST(round((epoch_us(ts) // 1000 - 120000) / 1000e0) AS BIGINT) AS two_minutes_ago,
               CAST(round((epoch_us(ts) // 1000 - 180000) / 1000e0) AS BIGINT) AS three_minutes_ago
        FROM events""",
    "recent_flights": f"""
        SELECT {_FLAT_POINT}, ingest_ts FROM document
        WHERE "Timestamp" > {AS_OF} - 2 * 86400 AND "Timestamp" < {AS_OF} - 3600""",
    "with_event_time": 'SELECT arrival, CAST(floor("now") AS BIGINT) AS event_ts FROM report',
    "partition_by_flight": f"""
        SELECT id, PartitionKey AS flight, RowKey AS "Timestamp", alt_geom, {_MEASURES}
        FROM sighting""",
    "enrich_locations": _patched(f"lat > 0 AND ingest_ts < {AS_OF} - 7200"),
    "backfill_missing": f"""
        SELECT id, flight, CAST(seconds AS DOUBLE) AS "Timestamp", lon AS p_lon, lat AS p_lat
        FROM readable
        WHERE alt_baro >= 2000 AND seconds IS NOT NULL AND ingest_ts < {AS_OF} - 7200""",
    "backfill_since": f"""
        SELECT id, flight, CAST(seconds AS DOUBLE) AS seconds,
               CASE WHEN seconds IS NULL THEN "Timestamp" END AS rejected
        FROM readable
        WHERE (alt_baro >= 2000 OR seconds IS NULL)
            AND ingest_ts >= {RANGE_FROM} AND ingest_ts < {AS_OF} - 7200""",
    "flights_view": """
        SELECT id, flight, CAST(seconds AS DOUBLE) AS "Timestamp",
               CASE WHEN NOT done THEN lat END AS lat, CASE WHEN NOT done THEN lon END AS lon,
               CASE WHEN done THEN lon END AS p_lon, CASE WHEN done THEN lat END AS p_lat,
               CASE WHEN NOT done THEN "Timestamp" END AS timestamp_text
        FROM (SELECT *, alt_baro < 2000 AND seconds IS NOT NULL AS done FROM readable)""",
    "flights_view_by_day": """
        SELECT id, flight, "Timestamp",
               CASE WHEN NOT done THEN lat END AS lat, CASE WHEN NOT done THEN lon END AS lon,
               CASE WHEN done THEN lon END AS p_lon, CASE WHEN done THEN lat END AS p_lat
        FROM (
            SELECT *, "Timestamp" <> (SELECT min("Timestamp") FROM document)
                AND (ingest_ts < 1705276800 OR alt_baro < 2000) AS done
            FROM document)""",
    "refresh_flight_spotter": _REFRESHED,
    "refresh_days": f"SELECT {_SPOTTER} FROM spotter",
    "ingest_snapshots": _LANDED,
    "ingest_twice": _LANDED,
    "ingest_rejects": """
        SELECT CASE WHEN k = 3 THEN 'default' ELSE receiver END AS receiver,
               CASE WHEN k <> 3 THEN arrival END AS arrival,
               CASE k WHEN 1 THEN 1.7e15 WHEN 2 THEN "now" END AS "now",
               CASE WHEN k <> 3 THEN messages END AS messages,
               CASE WHEN k < 2 THEN 1 END AS n,
               CASE k WHEN 0 THEN 'no time' WHEN 1 THEN 'impossible time' WHEN 2 THEN 'no list'
                   ELSE 'unparsable' END AS reason,
               CASE WHEN k = 3 THEN '{broken' END AS _corrupt
        FROM (SELECT *, event_id % 50 AS k FROM polled) WHERE k < 4""",
    "stream_ingest": _LANDED,
    "stream_nearby_windows": _windows(180),
    "repaired_nearby": _windows(180),
    "merged_nearby": _windows(180),
    "stream_ingest_in_order": f"SELECT * EXCLUDE (arrival) FROM ({_LANDED})",
    "stream_enrich_text": """
        SELECT id, flight, CAST(seconds AS DOUBLE) AS seconds,
               CASE WHEN seconds IS NULL THEN "Timestamp" END AS rejected
        FROM readable""",
    "stream_enrich": f"SELECT {_FLAT_POINT}, ingest_ts FROM document",
    "stream_enrich_updates": f"""
        SELECT {_FLAT_POINT}, ingest_ts FROM (
            SELECT * REPLACE (
                CASE WHEN alt_baro % 3 = 0 THEN alt_baro + 1 ELSE alt_baro END AS alt_baro,
                CASE WHEN alt_baro % 3 = 0 THEN ingest_ts + 10 ELSE ingest_ts END AS ingest_ts)
            FROM document WHERE alt_baro % 9 <> 0)""",
}


def _with_ctes(sql):
    """Put the common table expressions a statement uses, and those they use, before it."""
    needed = []

    def need(text):
        for name, body in _CTES.items():
            if re.search(rf"\b(FROM|JOIN) {name}\b", text) and name not in needed:
                need(body)
                needed.append(name)

    need(sql)
    heads = [f"{name} AS ({_CTES[name]})" for name in needed]
    body = sql.strip()
    if body.startswith("WITH "):
        return f"WITH {', '.join(heads)}, {body[5:]}"
    return f"WITH {', '.join(heads)} {body}" if heads else body


ORACLES = {name: _with_ctes(sql) for name, sql in _SQL.items()}
