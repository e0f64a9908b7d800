"""The same questions as SQL over the driver's tables, written row by row where the library aggregates."""

from __future__ import annotations

from workload.queries import BOX, DEVICE_TIME_ROWS, FENCES, POLYGON, PROCESSED_AT, STALE_AS_OF, TTL_AS_OF

NUMBER = r"([-+]?[0-9]*\.?[0-9]+)"
PATTERN = rf"{NUMBER}\|{NUMBER}\|{NUMBER}"
STATE = "'drone-state-sensor;v1'"
EVENT = "'drone-event-sensor;v1'"


def text(time: str) -> str:
    return f"strftime({time}, '%Y-%m-%d %H:%M:%S.%f')"


def iso(time: str) -> str:
    return f"strftime({time}, '%Y-%m-%dT%H:%M:%S.%fZ')"


M = f"""
m AS (
  SELECT event_id AS seq, CAST(user_id % 4 AS INT) AS part,
         'drone-' || user_id || CASE WHEN user_id % 5 = 0 AND off BETWEEN 1200000000 AND 2399999999
                                THEN '-spare' ELSE '' END AS device,
         'dlv-' || user_id || '-' || (off // 600000000) AS delivery,
         CASE WHEN event_type IN ('error', 'view') THEN 'drone-state-sensor;v1'
              WHEN event_type IN ('click', 'purchase') THEN 'drone-event-sensor;v1'
              ELSE 'drone-event-sensor;v2' END AS sensor,
         make_timestamp(1704067200000000 + off) AS occ,
         make_timestamp(1704067200000000 + off
           + 1000000 * (event_id % 11 + CASE WHEN event_id % 97 = 0 THEN 1200 ELSE 0 END)) AS enq,
         (h // 100) || '.' || lpad(CAST(h % 100 AS VARCHAR), 2, '0') AS temptext,
         CAST((h // 100) || '.' || lpad(CAST(h % 100 AS VARCHAR), 2, '0') AS DOUBLE) AS temp,
         CASE WHEN event_id % 101 = 0 THEN 'a|b|c'
              WHEN event_id % 103 = 0 THEN '+95|-121.989734|93.98'
              WHEN event_id % 107 = 0 THEN '+47.757084|-190|93.98'
              WHEN event_id % 109 = 0 THEN '47.757084||-121.989734'
              ELSE '+' || (47 + event_id % 3) || '.' || lpad(CAST(event_id * 7919 % 1000000 AS VARCHAR), 6, '0')
                   || '|-' || (121 + event_id % 4) || '.' || lpad(CAST(event_id * 104729 % 1000000 AS VARCHAR), 6, '0')
                   || '|' || (event_id % 400) || '.' || lpad(CAST(event_id % 100 AS VARCHAR), 2, '0') END AS pos,
         CAST(event_id % 6 AS INT) AS code,
         CAST(event_id % 31 AS DOUBLE) + 0.5 AS velocity, CAST(event_id % 7 AS DOUBLE) + 0.25 AS acceleration,
         TIMESTAMP '{PROCESSED_AT}' AS proc
  FROM (SELECT *, (epoch_us(ts) - 1704067200000000) // 720 AS off,
               6000 + CAST(round(value * 100) AS BIGINT) % 2100 AS h FROM events)
)"""

# Valid positions of the flight sensor; checked has every message with its problem.
CHECKED = rf"""
parsed AS (
  SELECT *, try_cast(nullif(regexp_extract(pos, '{PATTERN}', 1), '') AS DOUBLE) AS lat,
         try_cast(nullif(regexp_extract(pos, '{PATTERN}', 2), '') AS DOUBLE) AS lon FROM m),
checked AS (
  SELECT *, CASE WHEN lat IS NULL OR lon IS NULL THEN 'invalid_position'
                 WHEN lat NOT BETWEEN -90 AND 90 OR lon NOT BETWEEN -180 AND 180 THEN 'invalid_range' END AS problem
  FROM parsed),
v AS (SELECT * FROM checked WHERE sensor = {EVENT} AND problem IS NULL)"""

STATUS = "['DPS', 'INF', 'PUP', 'DOP', 'ARS'][code + 1]"


def part_of(index: int) -> str:
    return f"string_split(pos, '|')[{index}]"


BODY = f"""CAST(to_json({{'occurrenceUtcTime': {iso('occ')}, 'deviceId': device, 'sensorType': sensor,
  'deliveryId': delivery, 'temperature': temptext, 'velocity': velocity, 'acceleration': acceleration,
  'position': pos, 'flightStatus': code}}) AS VARCHAR)"""

ENRICHED = f"""
enriched AS (
  SELECT {iso('occ')} AS occurrenceUtcTime, device AS deviceId, sensor AS sensorType, delivery AS deliveryId,
         velocity, acceleration, try_cast({part_of(1)} AS DOUBLE) AS latitude, try_cast({part_of(2)} AS DOUBLE) AS longitude,
         try_cast({part_of(3)} AS DOUBLE) AS altitude, {STATUS} AS flightStatus
  FROM m WHERE sensor LIKE 'drone-event-sensor%')"""


def hot(name: str, seconds: int, by_partition: bool, threshold: float = 75) -> str:
    part = "part" if by_partition else "0"
    micros = seconds * 1_000_000
    return f"""
{name} AS (
  SELECT 'hotTemperature' AS message, CAST({part} AS INT) AS partitionid, device AS deviceid, delivery AS deliveryid,
         avg(temp) AS avgtemperature, max(enq) AS lastenqueuedutctime, max(occ) AS lastoccurrenceutctime,
         max(proc) AS lastprocessedutctime,
         make_timestamp((epoch_us(occ) // {micros} + 1) * {micros}) AS windowend
  FROM m WHERE sensor = {STATE}
  GROUP BY epoch_us(occ) // {micros}, device, delivery{', part' if by_partition else ''}
  HAVING avg(temp) >= {threshold})"""


HOT180, HOT90 = hot("hot180", 180, True), hot("hot90", 90, False)


def silent(name: str, by_partition: bool, unanswered: str) -> str:
    return f"""
{name} AS (
  SELECT 'noTelemetry' AS message, CAST({'part' if by_partition else '0'} AS INT) AS partitionid, device AS deviceid,
         delivery AS deliveryid, temp AS avgtemperature, enq AS lastenqueuedutctime, occ AS lastoccurrenceutctime,
         proc AS lastprocessedutctime
  FROM m l WHERE sensor = {STATE} AND {unanswered})"""


_NO_MINUTE = """NOT EXISTS (SELECT 1 FROM m r WHERE r.device = l.device AND r.part = l.part
    AND epoch_us(r.occ) // 60000000 - epoch_us(l.occ) // 60000000 BETWEEN 2 AND 10)"""
_NO_GAP = f"""NOT EXISTS (SELECT 1 FROM m r WHERE r.sensor = {STATE} AND r.device = l.device
    AND r.occ > l.occ AND r.occ <= l.occ + INTERVAL 5 MINUTE)"""
SILENT_MINUTES = silent(
    "silent_minutes",
    True,
    f"{_NO_MINUTE} AND (epoch_us(l.occ) // 60000000 + 11) * 60000000 <= (SELECT max(epoch_us(occ)) FROM m)",
)
SILENT_MINUTES_ALL = silent("silent_minutes", True, _NO_MINUTE)
SILENT_GAPS = silent(
    "silent_gaps", False, f"{_NO_GAP} AND l.occ + INTERVAL 5 MINUTE <= (SELECT max(occ) FROM m)"
)
SILENT_GAPS_ALL = silent("silent_gaps", False, _NO_GAP)
SILENT_30S_ALL = silent("silent_gaps", False, _NO_GAP.replace("5 MINUTE", "30 SECOND"))
SILENT_FIRST = """(SELECT * FROM silent_minutes QUALIFY row_number() OVER (
      PARTITION BY deviceid, partitionid, epoch_us(lastoccurrenceutctime) // 300000000
      ORDER BY lastoccurrenceutctime, deliveryid) = 1)"""

ALERT_NAMES = (
    "message, partitionid, deviceid, deliveryid, avgtemperature, "
    "lastenqueuedutctime, lastoccurrenceutctime, lastprocessedutctime"
)
BUS = f"""
bus AS (SELECT {ALERT_NAMES} FROM hot90 UNION ALL SELECT {ALERT_NAMES} FROM silent_gaps)"""
NOTIFIED = """
notified AS (
  SELECT * FROM bus QUALIFY row_number() OVER (
    PARTITION BY deviceid, deliveryid, message, epoch_us(lastoccurrenceutctime) // 150000000
    ORDER BY lastoccurrenceutctime, partitionid, avgtemperature, lastenqueuedutctime) = 1)"""
NEWEST = """
newest AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY device ORDER BY enq DESC, seq DESC) = 1)"""


def ctes(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


def alerts(source: str, *, processed: bool = True) -> str:
    times = ["lastenqueuedutctime", "lastoccurrenceutctime"] + (["lastprocessedutctime"] if processed else [])
    return (
        "SELECT message, partitionid, deviceid, deliveryid, round(avgtemperature, 6) AS avgtemperature, "
        + ", ".join(f"{text(t)} AS {t}" for t in times)
        + f" FROM {source}"
    )


ALERT_JSON = f"""to_json({{'message': message, 'partitionid': partitionid, 'deviceid': deviceid, 'deliveryid': deliveryid,
  'avgtemperature': round(avgtemperature, 6), 'lastenqueuedutctime': {text('lastenqueuedutctime')},
  'lastoccurrenceutctime': {text('lastoccurrenceutctime')}, 'lastprocessedutctime': {text('lastprocessedutctime')}}})"""


def _ring(polygon: str = POLYGON) -> list[tuple[float, float]]:
    pairs = polygon.removeprefix("POLYGON((").removesuffix("))").split(",")
    return [tuple(map(float, pair.split())) for pair in pairs]


def _inside(polygon: str = POLYGON) -> str:
    ring = _ring(polygon)
    crossings = " + ".join(
        f"CASE WHEN (({ya!r} > lat) <> ({yb!r} > lat)) AND lon < ({xb!r}::DOUBLE - {xa!r}::DOUBLE) * (lat - {ya!r}::DOUBLE)"
        f" / ({yb!r}::DOUBLE - {ya!r}::DOUBLE) + {xa!r}::DOUBLE THEN 1 ELSE 0 END"
        for (xa, ya), (xb, yb) in zip(ring, ring[1:])
    )
    return f"(({crossings}) % 2 = 1)"


INSIDE_BOX = f"lon BETWEEN {BOX[0]} AND {BOX[2]} AND lat BETWEEN {BOX[1]} AND {BOX[3]}"
POINT = f"device AS deviceId, {text('enq')} AS eventTime, round(lat, 6) AS latitude, round(lon, 6) AS longitude"
STALE = f"enq < TIMESTAMP '{STALE_AS_OF}' - INTERVAL 5 MINUTE"
IN_ORDER = """
arrived AS (
  SELECT *, max(occ) OVER (PARTITION BY device, part ORDER BY enq, seq
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ahead FROM m),
in_order AS (SELECT seq, device FROM arrived WHERE ahead IS NULL OR ahead - occ <= INTERVAL 5 SECOND)"""
SUMMARY = """SELECT deliveryId AS deliveryid,
  max(CASE WHEN flightStatus = 'DPS' THEN occurrenceUtcTime END) AS startdate,
  max(CASE WHEN flightStatus = 'DOP' THEN occurrenceUtcTime END) AS completedate
FROM enriched WHERE flightStatus IN ('DPS', 'DOP') GROUP BY deliveryId"""
LOG = f"""
log AS (
  SELECT enq AS timestamp,
         CASE WHEN {STALE} THEN 'Dropping late message. Sequence number = ' || seq
              WHEN sensor = {EVENT} AND problem IS NOT NULL THEN 'Error processing message ' || seq || ': ' || problem
         END AS message FROM checked)"""

RAW_POINTS = f"""SELECT device AS device_id, {text('enq')} AS event_time,
  'POINT (' || {part_of(2)} || ' ' || {part_of(1)} || ')' AS location FROM m WHERE sensor = {EVENT}"""
NOTIFICATIONS_STREAM = ctes(M, HOT90, SILENT_GAPS_ALL, BUS, NOTIFIED) + alerts("notified", processed=False)
HOT_STREAM = ctes(M, HOT90) + alerts("hot90", processed=False)
HOT_FIRST = """(SELECT * FROM hot180 QUALIFY row_number() OVER (
  PARTITION BY deviceid, partitionid, epoch_us(windowend) // 300000000 ORDER BY windowend, deliveryid) = 1)"""
HISTORY = f"SELECT DISTINCT {POINT} FROM v"

# Messages whose 180 s window was still open when their trigger began. Triggers have DEVICE_TIME_ROWS messages in order of
# arrival; windows close 5 s behind their device's clock or 900 s behind arrival.
ON_TIME = f"""
trig AS (SELECT *, (row_number() OVER (ORDER BY enq, seq) - 1) // {DEVICE_TIME_ROWS} AS trig FROM m),
arrived AS (
  SELECT trig, max(enq) OVER (ORDER BY trig ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 900 SECOND AS floor
  FROM (SELECT trig, max(enq) AS enq FROM trig GROUP BY trig)),
clocks AS (
  SELECT a.trig, t.device, t.part, max(t.occ) - INTERVAL 5 SECOND AS clock
  FROM (SELECT trig, device, part, max(occ) AS occ FROM trig GROUP BY ALL) t JOIN arrived a ON t.trig < a.trig GROUP BY ALL),
on_time AS (
  SELECT t.* FROM trig t LEFT JOIN arrived a ON a.trig = t.trig
  LEFT JOIN clocks c ON c.trig = t.trig AND c.device = t.device AND c.part = t.part
  WHERE (epoch_us(t.occ) // 180000000 + 1) * 180000000 > greatest(coalesce(epoch_us(a.floor), 0), coalesce(epoch_us(c.clock), 0)))"""
HOT_ON_TIME = HOT180.replace("FROM m ", "FROM on_time ")

ORACLES: dict[str, str] = {
    "raw_envelope_scan": ctes(M)
    + f"SELECT seq AS sequenceNumber, part AS partition, {text('enq')} AS enqueuedTime, {BODY} AS telemetryJson FROM m",
    "table_preview": ctes(M, ENRICHED) + SUMMARY,
    "cold_tables_incremental": ctes(M, ENRICHED) + SUMMARY,
    "body_decode": ctes(M) + f"SELECT seq AS sequenceNumber, {BODY} AS telemetryJson FROM m",
    "state_projection": ctes(M)
    + f"""SELECT {text('occ')} AS occurrenceUtcTime, {text('enq')} AS enqueuedUtcTime, {text('proc')} AS processedUtcTime,
      device AS deviceId, sensor AS sensorType, delivery AS deliveryId, round(temp, 6) AS temperature
      FROM m WHERE sensor = {STATE}""",
    "enrich_telemetry": ctes(M, ENRICHED)
    + """SELECT occurrenceUtcTime, deviceId, sensorType, deliveryId, round(velocity, 6) AS velocity,
      round(acceleration, 6) AS acceleration, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude,
      round(altitude, 6) AS altitude, flightStatus FROM enriched""",
    "alert_projection": ctes(M, HOT90, SILENT_GAPS, BUS)
    + alerts("bus").replace(
        "SELECT ", f"SELECT '{PROCESSED_AT}.000000' AS enqueuedUtcTime, '{PROCESSED_AT}.000000' AS processedutctime, ", 1
    ),
    "position_split": ctes(M)
    + f"""SELECT seq AS sequenceNumber, round(try_cast({part_of(1)} AS DOUBLE), 6) AS latitude,
      round(try_cast({part_of(2)} AS DOUBLE), 6) AS longitude, round(try_cast({part_of(3)} AS DOUBLE), 6) AS altitude FROM m""",
    "position_valid": ctes(M, CHECKED)
    + "SELECT seq AS sequenceNumber, device AS deviceId, round(lat, 6) AS latitude, round(lon, 6) AS longitude FROM v",
    "position_quarantine": ctes(M, CHECKED)
    + f"""SELECT seq AS sequenceNumber, device AS deviceId, pos AS position, problem AS reason
      FROM checked WHERE sensor = {EVENT} AND problem IS NOT NULL""",
    "wkt_point": ctes(M) + RAW_POINTS,
    "geojson_point": ctes(M, CHECKED)
    + f"SELECT device AS id, 'Point' AS kind, round(lon, 6) AS longitude, round(lat, 6) AS latitude, {text('enq')} AS time FROM v",
    "flight_status_decode": ctes(M) + f"SELECT seq AS sequenceNumber, {STATUS} AS status FROM m",
    "alert_record": ctes(M, HOT180) + alerts("hot180"),
    "alert_json_encode": ctes(M, HOT90, SILENT_GAPS, BUS) + f"SELECT CAST({ALERT_JSON} AS VARCHAR) AS body FROM bus",
    "alert_json_decode": ctes(M, HOT90, SILENT_GAPS, BUS) + alerts("bus"),
    "try_cast_times": ctes(M)
    + f"SELECT seq AS sequenceNumber, CASE WHEN seq % 7 = 0 THEN NULL ELSE {text('occ')} END AS time FROM m",
    "temperature_flag": ctes(M)
    + """SELECT seq AS sequenceNumber, sensor AS kind, CASE WHEN temp > 75 THEN 'true' ELSE 'false' END AS temperatureAlert
      FROM m""",
    "state_filter": ctes(M)
    + f"SELECT seq AS sequenceNumber, device AS deviceId, round(temp, 6) AS temperature FROM m WHERE sensor = {STATE}",
    "event_filter": ctes(M)
    + f"SELECT seq AS sequenceNumber, device AS deviceId, pos AS position FROM m WHERE sensor = {EVENT}",
    "event_prefix_filter": ctes(M)
    + """SELECT seq AS sequenceNumber, device AS deviceId, sensor AS sensorType
      FROM m WHERE sensor LIKE 'drone-event-sensor%'""",
    "stale_drop": ctes(M) + f"SELECT seq AS sequenceNumber, CAST(CASE WHEN {STALE} THEN 1 ELSE 0 END AS INT) AS stale FROM m",
    "late_arrival_filter": ctes(M)
    + "SELECT seq AS sequenceNumber, device AS deviceId FROM m WHERE enq - occ <= INTERVAL 900 SECOND",
    "out_of_order_filter": ctes(M, IN_ORDER) + "SELECT seq AS sequenceNumber, device AS deviceId FROM in_order",
    "dps_dop_filter": ctes(M, ENRICHED)
    + "SELECT deliveryId, occurrenceUtcTime, flightStatus FROM enriched WHERE flightStatus = 'DPS' OR flightStatus = 'DOP'",
    "nonempty_body": ctes(M) + "SELECT seq AS sequenceNumber FROM m WHERE seq % 11 <> 0 AND seq % 13 <> 0",
    "having_threshold": ctes(M, hot("warmer", 180, True, 78.5))
    + "SELECT deviceid, deliveryid, round(avgtemperature, 6) AS avgtemperature FROM warmer",
    "route_messages": ctes(M)
    + """SELECT seq AS sequenceNumber, 'events' AS endpoint FROM m UNION ALL
      SELECT seq, 'storage' FROM m UNION ALL
      SELECT seq, 'batching' FROM m WHERE sensor LIKE 'drone-event-sensor%'""",
    "no_telemetry_minute_2_10": ctes(M, SILENT_MINUTES) + alerts("silent_minutes"),
    "no_telemetry_gap_5m": ctes(M, SILENT_GAPS) + alerts("silent_gaps"),
    "last_known_position": ctes(M, CHECKED)
    + f"""SELECT {POINT}, seq AS sequenceNumber FROM v e
      WHERE enq = (SELECT max(e2.enq) FROM v e2 WHERE e2.device = e.device)""",
    "hot_tumbling_180": ctes(M, HOT180) + alerts("hot180"),
    "hot_tumbling_90": ctes(M, HOT90) + alerts("hot90"),
    "alert_first_150": ctes(M, HOT90, SILENT_GAPS, BUS, NOTIFIED) + alerts("notified"),
    "delivery_summary": ctes(M, ENRICHED) + SUMMARY,
    "devices_in_polygon": ctes(M, CHECKED) + f"SELECT DISTINCT device AS deviceId FROM v WHERE {_inside()}",
    "positions_envelope": ctes(M, CHECKED)
    + """SELECT round(coalesce(min(lon), 180), 6) AS swLon, round(coalesce(min(lat), 90), 6) AS swLat,
      round(coalesce(max(lon), -180), 6) AS neLon, round(coalesce(max(lat), -90), 6) AS neLat FROM v""",
    "ingest_counters": ctes(M, CHECKED)
    + f"""SELECT count(*) AS received, count(*) FILTER ({STALE}) AS dropped,
      count(*) FILTER (NOT ({STALE}) AND sensor = {EVENT} AND problem IS NULL) AS created,
      round((epoch_us(TIMESTAMP '{STALE_AS_OF}') - arg_min(epoch_us(enq), seq)) / 1000, 6) AS freshnessMs,
      round(coalesce(avg(seq % 5) FILTER (NOT ({STALE}) AND sensor = {EVENT} AND problem IS NULL), 0), 6) AS meanWriteMs
      FROM checked""",
    "hot_alert_isfirst_5m": ctes(M, HOT180) + alerts(HOT_FIRST),
    "no_telemetry_alert_isfirst_5m": ctes(M, SILENT_MINUTES)
    + alerts(SILENT_FIRST),
    "points_in_bbox": ctes(M, CHECKED) + f"SELECT {POINT}, seq AS sequenceNumber FROM v WHERE {INSIDE_BOX}",
    "points_in_polygon": ctes(M, CHECKED) + f"SELECT {POINT}, seq AS sequenceNumber FROM v WHERE {_inside()}",
    "points_in_fences": ctes(M, CHECKED)
    + " UNION ALL ".join(
        f"SELECT {POINT}, seq AS sequenceNumber, '{name}' AS fence FROM v WHERE {_inside(wkt)}" for name, wkt in FENCES.items()
    ),
    "stored_points_in_polygon": ctes(M, CHECKED) + f"SELECT {POINT}, seq AS sequenceNumber FROM v WHERE {_inside()}",
    "recent_in_bbox": ctes(M, CHECKED)
    + f"""SELECT {POINT}, seq AS sequenceNumber FROM v WHERE {INSIDE_BOX}
      ORDER BY enq DESC, device, seq LIMIT 10000""",
    "alert_bus_union": ctes(M, HOT90, SILENT_GAPS, BUS) + alerts("bus"),
    "latest_position": ctes(M, CHECKED, NEWEST) + f"SELECT {POINT}, seq AS sequenceNumber FROM newest",
    "position_history": ctes(M, CHECKED)
    + HISTORY
    + f" WHERE enq >= TIMESTAMP '{TTL_AS_OF}' - INTERVAL 1800 SECOND",
    "sql_event_load": ctes(M, CHECKED)
    + f"""SELECT device AS deviceid, {text('enq')} AS timestamp, 'POINT (' || lon || ' ' || lat || ')' AS geo,
      {BODY} AS json FROM v""",
    "hot_document_by_delivery": ctes(M, HOT180)
    + alerts("""(SELECT * FROM hot180 QUALIFY row_number() OVER (
      PARTITION BY deliveryid ORDER BY lastoccurrenceutctime DESC, partitionid DESC, deviceid DESC) = 1)"""),
    "silence_document_by_delivery": ctes(M, SILENT_MINUTES)
    + alerts("""(SELECT * FROM silent_minutes QUALIFY row_number() OVER (
      PARTITION BY deliveryid ORDER BY lastoccurrenceutctime DESC, partitionid DESC, deviceid DESC,
      avgtemperature DESC, lastenqueuedutctime DESC) = 1)"""),
    "batch_by_count": ctes(M)
    + """SELECT part AS partition, place // 20 AS batchNo, count(*) AS size,
      string_agg(CAST(seq AS VARCHAR), ',' ORDER BY place) AS sequenceNumbers
      FROM (SELECT *, row_number() OVER (PARTITION BY part ORDER BY seq) - 1 AS place FROM m) GROUP BY part, place // 20""",
    "alert_payload_pack": ctes(M, HOT90, SILENT_GAPS, BUS)
    + f"""SELECT partitionid, place // 100 AS batchNo, count(*) AS size,
      '[' || string_agg(CAST({ALERT_JSON} AS VARCHAR), ',' ORDER BY place) || ']' AS payload
      FROM (SELECT *, row_number() OVER (PARTITION BY partitionid ORDER BY lastoccurrenceutctime, message, deviceid,
              deliveryid, round(avgtemperature, 6), lastenqueuedutctime) - 1 AS place FROM bus)
      GROUP BY partitionid, place // 100""",
    "log_search": ctes(M, CHECKED, LOG)
    + f"SELECT {text('timestamp')} AS timestamp, message FROM log WHERE lower(message) LIKE 'error processing message%'",
    "pipeline_metric_filter": ctes(M, CHECKED)
    + f"""SELECT CAST(n % 3 AS DOUBLE) AS triggerExecution, CAST(0 AS DOUBLE) AS getBatch,
      round(n / 60, 6) AS inputRowsPerSecond, round(c / 60, 6) AS procRowsPerSecond
      FROM (SELECT count(*) AS n, count(*) FILTER (sensor = {EVENT} AND problem IS NULL) AS c
            FROM checked GROUP BY epoch_us(enq) // 60000000) WHERE n > 0 AND c > 0 AND n % 3 > 0""",
    "telemetry_stream": ctes(M)
    + f"""SELECT seq AS sequenceNumber, device AS deviceId, sensor AS sensorType, {text('occ')} AS occurrenceUtcTime,
      {text('enq')} AS enqueuedUtcTime, round(temp, 6) AS temperature FROM m""",
    "dstream_positions": ctes(M) + RAW_POINTS,
    "hot_stream": HOT_STREAM,
    "isfirst_stream": ctes(M, HOT180) + alerts(HOT_FIRST, processed=False),
    "no_telemetry_stream": ctes(M, SILENT_GAPS_ALL) + alerts("silent_gaps", processed=False),
    "no_telemetry_minute_stream": ctes(M, SILENT_MINUTES_ALL) + alerts("silent_minutes", processed=False),
    "silence_30s_stream": ctes(M, SILENT_30S_ALL) + alerts("silent_gaps", processed=False),
    "silence_isfirst_stream": ctes(M, SILENT_MINUTES_ALL) + alerts(SILENT_FIRST, processed=False),
    "silence_document_sink": ctes(M, SILENT_GAPS_ALL) + alerts("silent_gaps", processed=False),
    "document_insert_sink": HOT_STREAM,
    "alert_bus_sink": ctes(M, HOT90, SILENT_GAPS_ALL, BUS) + alerts("bus", processed=False),
    "alert_stream": NOTIFICATIONS_STREAM,
    "notification_sink": NOTIFICATIONS_STREAM,
    "notification_post_sink": NOTIFICATIONS_STREAM,
    "prompt_alert_stream": ctes(M, HOT90, SILENT_GAPS_ALL, BUS)
    + f"""SELECT DISTINCT deviceid, deliveryid, message,
      {text('make_timestamp(epoch_us(lastoccurrenceutctime) // 150000000 * 150000000)')} AS bucketStart FROM bus""",
    "row_writer_sink": ctes(M)
    + f"SELECT seq AS sequenceNumber, device AS deviceId, CASE WHEN seq % 17 <> 0 THEN {text('occ')} END AS occurred FROM m",
    "dead_letter_sink": ctes(M)
    + """SELECT seq AS sequenceNumber, CASE WHEN seq % 17 = 0 THEN 'untimed' WHEN seq % 13 = 0 THEN 'ValueError: refused'
      ELSE 'written' END AS fate FROM m""",
    "capture_range_scan": ctes(M)
    + f"""SELECT seq AS sequenceNumber, part AS partition, {text('enq')} AS enqueuedTime, 'hub1' AS hub,
      part AS hubPartition, '2024-01-01' AS day FROM m
      WHERE seq % 2 = 1 AND part IN (0, 2) AND CAST(enq AS DATE) = DATE '2024-01-01'""",
    "pipeline_metrics": ctes(M)
    + f"""SELECT (count(*) + {DEVICE_TIME_ROWS - 1}) // {DEVICE_TIME_ROWS} + 2 AS triggers, CAST(0 AS BIGINT) AS untimed,
      count(*) + 2 AS written, true AS accounted FROM m""",
    "substream_time": ctes(M, IN_ORDER) + "SELECT seq AS sequenceNumber, device AS deviceId FROM in_order",
    "device_time_hot_stream": ctes(M, ON_TIME, HOT_ON_TIME) + alerts("hot180", processed=False),
    "device_time_isfirst_stream": ctes(M, ON_TIME, HOT_ON_TIME) + alerts(HOT_FIRST, processed=False),
    "latest_position_stream": ctes(M, CHECKED, NEWEST) + f"SELECT {POINT}, seq AS sequenceNumber FROM newest",
    "position_history_stream": ctes(M, CHECKED) + HISTORY,
}
ORACLES["batch_by_count_stream"] = ORACLES["batch_by_count"]
ORACLES["cold_tables_overwrite"] = ORACLES["enrich_telemetry"].replace(
    "SELECT occurrenceUtcTime, deviceId", "SELECT substr(occurrenceUtcTime, 1, 10) AS day, occurrenceUtcTime, deviceId", 1
)
