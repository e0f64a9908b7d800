"""One query per operator, over the whole of the driver's tables."""

from __future__ import annotations

import datetime as dt
import functools
import hashlib
import json
from collections.abc import Callable

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetpulse.functions import fields, geo
from fleetpulse.operators import decode, deliveries, fences, hot, monitoring, packing, policy, positions, silence
from fleetpulse.plans import cold
from fleetpulse.plans import hot as hot_plan
from fleetpulse.schemas import ALERT, HUB_MESSAGE, PIPELINE_METRIC, POSITION, SQL_EVENT, TELEMETRY
from fleetpulse.session import configure, plain_checkpoints, streaming_session
from fleetpulse.sources.messages import alert_bus_stream, capture_range, captured_envelopes
from fleetpulse.streaming import batching, device_time, monitor, queries, sinks, tables
from workload import staging
from workload.telemetry import PROCESSED_AT, messages, telemetry

Query = Callable[[SparkSession, str], DataFrame]

STALE_AS_OF = "2024-01-01 00:30:00"
TTL_AS_OF = "2024-01-01 01:00:00"
TTL = dt.timedelta(seconds=1800)
BOX = (-123.0, 47.5, -122.0, 48.5)
POLYGON = "POLYGON((-124.5 47.25,-122.75 49.75,-121.5 48.5,-122.25 46.5,-124.5 47.25))"
# Of the keyed tables that streams keep.
BUCKETS = 8
# Messages per step of the streams whose results depend on where triggers begin.
DEVICE_TIME_ROWS = 2_500
FENCES = {
    "north": POLYGON,
    "triangle": "POLYGON((-123.5 47.1,-121.2 47.3,-122.4 49.2,-123.5 47.1))",
    "notch": "POLYGON((-124 47.5,-122 47.5,-122 48.5,-122.9 48.5,-122.9 47.9,-123.1 47.9,-123.1 48.5,-124 48.5,-124 47.5))",
}
ALERT_COLUMNS = ALERT.fieldNames()
# Streams stamp alerts with the time of the trigger, which no oracle knows.
STREAM_ALERT_COLUMNS = [c for c in ALERT_COLUMNS if c != "lastprocessedutctime"]


def at(text: str):
    return F.lit(text).cast("timestamp")


def shown(df: DataFrame, *columns: str) -> DataFrame:
    """Columns in a form two engines print alike: times as text, doubles to six places."""
    kinds = dict(zip(df.columns, (f.dataType for f in df.schema.fields)))

    def form(name: str):
        if isinstance(kinds[name], T.TimestampType):
            return fields.time_text(F.col(name)).alias(name)
        if isinstance(kinds[name], T.DoubleType):
            return F.round(name, 6).alias(name)
        return F.col(name)

    return df.select(*[form(c) for c in columns or df.columns])


QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    def configured(spark: SparkSession, sf_dir: str) -> DataFrame:
        return f(configure(spark), sf_dir)

    QUERIES[f.__name__] = configured
    return f


def located(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, _ = positions.positions(telemetry(spark, sf_dir))
    return valid


# Scans and sources


@query
def raw_envelope_scan(spark, sf_dir):
    folder = staging.staged_capture(spark, sf_dir)
    rows = decode.envelope_to_messages(captured_envelopes(spark, folder, file_format="parquet"))
    return shown(
        rows.select("sequenceNumber", "partition", "enqueuedTime", fields.body_text(F.col("body")).alias("telemetryJson"))
    )


@query
def table_preview(spark, sf_dir):
    _, summary = cold.run_cold_path(messages(spark, sf_dir), staging.scratch(spark, "preview"))
    return cold.preview(spark, summary)


@query
def capture_range_scan(spark, sf_dir):
    folder = staging.staged_capture(spark, sf_dir)
    day = dt.date(2024, 1, 1)
    rows = capture_range(
        spark, folder, hub="hub1", partitions=[0, 2], first_day=day, last_day=day, file_format="parquet"
    )
    found = decode.envelope_to_messages(rows).select("sequenceNumber", "partition", "enqueuedTime")
    path = rows.select(F.col("SystemProperties")["sequenceNumber"].cast("long").alias("sequenceNumber"), "hub", "hubPartition", F.col("day").cast("string").alias("day"))
    return shown(found.join(path, "sequenceNumber"))


# Decoding and scalar functions


@query
def body_decode(spark, sf_dir):
    text = fields.body_text(F.col("body")).alias("telemetryJson")
    return messages(spark, sf_dir).select("sequenceNumber", text)


@query
def state_projection(spark, sf_dir):
    return shown(decode.state_projection(messages(spark, sf_dir), processed_at=at(PROCESSED_AT)))


@query
def enrich_telemetry(spark, sf_dir):
    return shown(decode.enrich_telemetry(messages(spark, sf_dir)))


@query
def alert_projection(spark, sf_dir):
    bus = decode.alert_body(hot_plan.bus(telemetry(spark, sf_dir))).withColumn("enqueuedTime", at(PROCESSED_AT))
    return shown(decode.alert_projection(bus, processed_at=at(PROCESSED_AT)))


@query
def position_split(spark, sf_dir):
    parts = {
        name: fields.to_number(fields.position_part(F.col("position"), i))
        for i, name in enumerate(("latitude", "longitude", "altitude"))
    }
    return shown(telemetry(spark, sf_dir).withColumns(parts), "sequenceNumber", *parts)


@query
def position_valid(spark, sf_dir):
    valid, _ = policy.split_by_position(policy.event_rows(telemetry(spark, sf_dir)))
    return shown(valid, "sequenceNumber", "deviceId", "latitude", "longitude")


@query
def position_quarantine(spark, sf_dir):
    _, quarantined = policy.split_by_position(policy.event_rows(telemetry(spark, sf_dir)))
    return quarantined.select("sequenceNumber", "deviceId", "position", "reason")


@query
def wkt_point(spark, sf_dir):
    return positions.raw_positions(telemetry(spark, sf_dir))


@query
def geojson_point(spark, sf_dir):
    documents = positions.position_documents(located(spark, sf_dir))
    return documents.select(
        "id",
        F.col("Location.type").alias("kind"),
        F.round(F.col("Location.coordinates")[0], 6).alias("longitude"),
        F.round(F.col("Location.coordinates")[1], 6).alias("latitude"),
        fields.time_text(F.col("Timestamp")).alias("time"),
    )


@query
def flight_status_decode(spark, sf_dir):
    status = fields.flight_status(F.col("flightStatus")).alias("status")
    return telemetry(spark, sf_dir).select("sequenceNumber", status)


@query
def alert_record(spark, sf_dir):
    record = decode.alert_record(hot.hot_windows_180(telemetry(spark, sf_dir)))
    return record.withColumn("avgtemperature", F.round("avgtemperature", 6))


def rounded_bus(spark, sf_dir):
    return hot_plan.bus(telemetry(spark, sf_dir)).withColumn("avgtemperature", F.round("avgtemperature", 6))


@query
def alert_json_encode(spark, sf_dir):
    return decode.alert_body(rounded_bus(spark, sf_dir))


@query
def alert_json_decode(spark, sf_dir):
    payloads = decode.alert_array(rounded_bus(spark, sf_dir))
    # Producers disagree on the case of the keys.
    mixed = payloads.select(F.replace("payload", F.lit('"deviceid"'), F.lit('"DeviceId"')).alias("payload"))
    alerts, _ = decode.decode_alert_payloads(mixed)
    return shown(alerts)


@query
def try_cast_times(spark, sf_dir):
    # Sequence numbers divisible by 7 carry a broken time.
    text = F.when(F.col("sequenceNumber") % 7 == 0, F.lit("no time")).otherwise(
        fields.time_text(F.col("occurrenceUtcTime"))
    )
    rows = telemetry(spark, sf_dir).select("sequenceNumber", text.alias("time"))
    return shown(decode.cast_times(rows, "time"))


@query
def temperature_flag(spark, sf_dir):
    read = fields.to_number(F.get_json_object(fields.body_text(F.col("body")), "$.temperature"))
    flagged = decode.flag_temperature(messages(spark, sf_dir), read)
    return flagged.select(
        "sequenceNumber",
        F.col("properties")["kind"].alias("kind"),
        F.col("properties")["temperatureAlert"].alias("temperatureAlert"),
    )


# Filters and policies


@query
def state_filter(spark, sf_dir):
    return shown(policy.state_rows(telemetry(spark, sf_dir)), "sequenceNumber", "deviceId", "temperature")


@query
def event_filter(spark, sf_dir):
    return policy.event_rows(telemetry(spark, sf_dir)).select("sequenceNumber", "deviceId", "position")


@query
def event_prefix_filter(spark, sf_dir):
    rows = policy.event_rows_any_version(telemetry(spark, sf_dir))
    return rows.select("sequenceNumber", "deviceId", "sensorType")


@query
def stale_drop(spark, sf_dir):
    kept, dropped = policy.drop_stale(telemetry(spark, sf_dir), as_of=at(STALE_AS_OF))
    both = kept.withColumn("stale", F.lit(0)).unionByName(dropped.withColumn("stale", F.lit(1)))
    return both.select("sequenceNumber", "stale")


@query
def late_arrival_filter(spark, sf_dir):
    return policy.drop_late(telemetry(spark, sf_dir)).select("sequenceNumber", "deviceId")


@query
def out_of_order_filter(spark, sf_dir):
    return policy.drop_out_of_order(telemetry(spark, sf_dir)).select("sequenceNumber", "deviceId")


@query
def dps_dop_filter(spark, sf_dir):
    rows = policy.departed_or_dropped_off(decode.enrich_telemetry(messages(spark, sf_dir)))
    return rows.select("deliveryId", "occurrenceUtcTime", "flightStatus")


@query
def nonempty_body(spark, sf_dir):
    # Sequence numbers divisible by 11 arrive without a body, those divisible by 13 with an empty one.
    body = (
        F.when(F.col("sequenceNumber") % 11 == 0, F.lit(None))
        .when(F.col("sequenceNumber") % 13 == 0, F.lit(b""))
        .otherwise(F.col("body"))
    )
    return decode.nonempty_bodies(messages(spark, sf_dir).withColumn("body", body)).select("sequenceNumber")


@query
def having_threshold(spark, sf_dir):
    rows = hot.hot_windows(telemetry(spark, sf_dir), window_seconds=180, by_partition=True, threshold=78.5)
    return shown(rows, "deviceid", "deliveryid", "avgtemperature")


@query
def route_messages(spark, sf_dir):
    always = F.lit(True)
    routed = policy.route(
        telemetry(spark, sf_dir),
        {"events": always, "storage": always, "batching": F.col("sensorType").startswith(fields.EVENT_SENSOR_PREFIX)},
    )
    return routed.select("sequenceNumber", "endpoint")


# Joins


@query
def no_telemetry_minute_2_10(spark, sf_dir):
    rows = silence.silence_alerts(silence.silent_minutes(telemetry(spark, sf_dir)), by_partition=True)
    return shown(rows)


@query
def no_telemetry_gap_5m(spark, sf_dir):
    rows = silence.silence_alerts(silence.silent_gaps(telemetry(spark, sf_dir)), by_partition=False)
    return shown(rows)


@query
def last_known_position(spark, sf_dir):
    return shown(positions.last_known(located(spark, sf_dir)))


# Aggregations


@query
def hot_tumbling_180(spark, sf_dir):
    return shown(hot.hot_windows_180(telemetry(spark, sf_dir)), *ALERT_COLUMNS)


@query
def hot_tumbling_90(spark, sf_dir):
    return shown(hot.hot_windows_90(telemetry(spark, sf_dir)), *ALERT_COLUMNS)


@query
def alert_first_150(spark, sf_dir):
    return shown(hot_plan.bus_notifications(telemetry(spark, sf_dir)))


@query
def delivery_summary(spark, sf_dir):
    return deliveries.delivery_summary(decode.enrich_telemetry(messages(spark, sf_dir)))


@query
def devices_in_polygon(spark, sf_dir):
    return positions.devices_in_polygon(located(spark, sf_dir), geo.ring_from_wkt(POLYGON))


@query
def positions_envelope(spark, sf_dir):
    return shown(positions.envelope(located(spark, sf_dir)))


@query
def ingest_counters(spark, sf_dir):
    counters = monitoring.ingest_counters(
        telemetry(spark, sf_dir), as_of=at(STALE_AS_OF), write_ms=F.col("sequenceNumber") % 5
    )
    return shown(counters)


# First rows, areas, order, union


@query
def hot_alert_isfirst_5m(spark, sf_dir):
    return shown(hot_plan.windowed_alerts(telemetry(spark, sf_dir)).hot_alerts, *ALERT_COLUMNS)


@query
def no_telemetry_alert_isfirst_5m(spark, sf_dir):
    return shown(hot_plan.windowed_alerts(telemetry(spark, sf_dir)).silence_alerts)


@query
def points_in_bbox(spark, sf_dir):
    return shown(positions.in_box(located(spark, sf_dir), *BOX))


@query
def points_in_polygon(spark, sf_dir):
    return shown(positions.in_polygon(located(spark, sf_dir), geo.ring_from_wkt(POLYGON)))


@query
def points_in_fences(spark, sf_dir):
    rings = {name: geo.ring_from_wkt(wkt) for name, wkt in FENCES.items()}
    return shown(fences.within_fences(located(spark, sf_dir), rings))


@query
def stored_points_in_polygon(spark, sf_dir):
    path = staging.scratch(spark, "cells")
    fences.write_by_cell(located(spark, sf_dir), path)
    return shown(fences.read_fence(spark, path, POSITION, geo.ring_from_wkt(POLYGON)))


@query
def recent_in_bbox(spark, sf_dir):
    return shown(positions.newest_in_box(located(spark, sf_dir), *BOX))


@query
def alert_bus_union(spark, sf_dir):
    return shown(hot_plan.bus(telemetry(spark, sf_dir)))


# Sinks in batch form


@query
def latest_position(spark, sf_dir):
    return shown(positions.latest_position(located(spark, sf_dir)))


@query
def position_history(spark, sf_dir):
    return shown(positions.position_history(located(spark, sf_dir), as_of=at(TTL_AS_OF), ttl=TTL))


@query
def sql_event_load(spark, sf_dir):
    rows, _ = positions.sql_events(messages(spark, sf_dir))
    out = staging.scratch(spark, "sql-events")
    sinks.with_retries(sinks.table_append(out))(rows, 0)
    return shown(sinks.read_appended(spark, out, SQL_EVENT))


@query
def hot_document_by_delivery(spark, sf_dir):
    return shown(hot_plan.windowed_alerts(telemetry(spark, sf_dir)).hot_documents)


@query
def silence_document_by_delivery(spark, sf_dir):
    return shown(hot_plan.windowed_alerts(telemetry(spark, sf_dir)).silence_documents)


@query
def cold_tables_overwrite(spark, sf_dir):
    enriched, _ = cold.run_cold_path(messages(spark, sf_dir), staging.scratch(spark, "cold"))
    return shown(cold.read_enriched(spark, enriched))


@query
def cold_tables_incremental(spark, sf_dir):
    out = staging.scratch(spark, "cold-incremental")
    source = staging.stream(spark, streaming_session(spark), sf_dir)
    _, summary = cold.run_cold_path_incrementally(source, out, buckets=BUCKETS)
    return cold.preview(spark, summary)


# Packing


@query
def batch_by_count(spark, sf_dir):
    batches = packing.batch_by_count(messages(spark, sf_dir), size=20)
    numbers = F.transform("items", lambda item: item["sequenceNumber"].cast("string"))
    return batches.select("partition", "batchNo", "size", F.array_join(numbers, ",").alias("sequenceNumbers"))


@query
def alert_payload_pack(spark, sf_dir):
    return packing.alert_payloads(staging.stored(spark, rounded_bus(spark, sf_dir), "bus"))


# Monitoring


@query
def log_search(spark, sf_dir):
    log = monitoring.ingest_log(telemetry(spark, sf_dir), as_of=at(STALE_AS_OF))
    return shown(monitoring.log_search(log, "error PROCESSING message"))


@query
def pipeline_metric_filter(spark, sf_dir):
    # One metric row per minute of arrival: messages in, and valid positions out, per second.
    checked = policy.with_position(telemetry(spark, sf_dir))
    written = (F.col("sensorType") == fields.EVENT_SENSOR) & F.col("problem").isNull()
    minutes = (
        checked.groupBy(fields.minute_of(F.col("enqueuedUtcTime")).alias("minute"))
        .agg(F.count(F.lit(1)).alias("received"), F.count_if(written).alias("created"))
        .select(
            (F.col("received") % 3).cast("double").alias("triggerExecution"),
            F.lit(0.0).alias("getBatch"),
            (F.col("received") / 60).alias("inputRowsPerSecond"),
            (F.col("created") / 60).alias("procRowsPerSecond"),
        )
    )
    assert minutes.schema.names == PIPELINE_METRIC.names
    active = monitoring.active_metrics(minutes, "inputRowsPerSecond")
    for measure in ("procRowsPerSecond", "triggerExecution"):
        active = monitoring.active_metrics(active, measure)
    return shown(active)


# Streams. Each runs over all staged messages until nothing is left, then its sink is read back.


def run(spark, sf_dir, purpose, build, **staged):
    """Starts `build(messages, out)` (a stream writer) and waits for it; returns the sink folder."""
    out = staging.scratch(spark, purpose)
    source = staging.stream(spark, streaming_session(spark), sf_dir, **staged)
    queries.start(build(source, out), f"{out}-checkpoint", available_now=True).awaitTermination()
    return out


def appended(stream_df, out):
    return queries.to_batches(stream_df, sinks.with_retries(sinks.table_append(out)))


def without_sentinel(df, device="deviceid"):
    return df.filter(F.col(device) != staging.SENTINEL_DEVICE)


def stream_alerts(spark, sf_dir, purpose, build):
    schemas = []

    def writer(source, out):
        alerts = build(source).select(*ALERT_COLUMNS)
        schemas.append(alerts.schema)
        return appended(alerts, out)

    out = run(spark, sf_dir, purpose, writer)
    return shown(without_sentinel(sinks.read_appended(spark, out, schemas[0])), *STREAM_ALERT_COLUMNS)


@query
def telemetry_stream(spark, sf_dir):
    schemas = []

    def writer(source, out):
        rows = decode.decode_telemetry(source).select(
            "sequenceNumber", "deviceId", "sensorType", "occurrenceUtcTime", "enqueuedUtcTime", "temperature"
        )
        schemas.append(rows.schema)
        return appended(rows, out)

    out = run(spark, sf_dir, "telemetry", writer)
    return shown(without_sentinel(sinks.read_appended(spark, out, schemas[0]), "deviceId"))


@query
def dstream_positions(spark, sf_dir):
    out = staging.scratch(spark, "raw-positions")
    source = staging.stream(spark, streaming_session(spark), sf_dir)
    points = positions.raw_positions(decode.decode_telemetry(source))
    running = queries.start(appended(points, out), f"{out}-checkpoint", every="1 second")
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    return sinks.read_appended(spark, out, points.schema)


@query
def hot_stream(spark, sf_dir):
    return stream_alerts(spark, sf_dir, "hot", queries.hot_alert_stream)


@query
def isfirst_stream(spark, sf_dir):
    return stream_alerts(spark, sf_dir, "isfirst", queries.throttled_hot_stream)


@query
def no_telemetry_stream(spark, sf_dir):
    return stream_alerts(spark, sf_dir, "silence", queries.silence_alert_stream)


@query
def no_telemetry_minute_stream(spark, sf_dir):
    return stream_alerts(spark, sf_dir, "silent-minutes", queries.silent_minutes_alert_stream)


@query
def silence_30s_stream(spark, sf_dir):
    return stream_alerts(spark, sf_dir, "silence-30s", lambda s: queries.silence_alert_stream(s, gap_seconds=30))


@query
def silence_isfirst_stream(spark, sf_dir):
    return stream_alerts(spark, sf_dir, "silence-isfirst", queries.throttled_silence_stream)


def documents(spark, sf_dir, purpose, build):
    """Alerts of a stream as the documents that its sink has stored."""

    def writer(source, out):
        return queries.to_batches(decode.alert_record(build(source)), sinks.with_retries(sinks.json_append(out)))

    out = run(spark, sf_dir, purpose, writer)
    record = T.StructType([T.StructField(f.name, f.dataType if f.name in ("partitionid", "avgtemperature")
                                         else T.StringType()) for f in ALERT.fields])
    return spark.read.schema(record).json(f"{out}/batch_id=*")


@query
def document_insert_sink(spark, sf_dir):
    return shown(documents(spark, sf_dir, "documents", queries.hot_alert_stream), *STREAM_ALERT_COLUMNS)


@query
def silence_document_sink(spark, sf_dir):
    rows = documents(spark, sf_dir, "silence-documents", queries.silence_alert_stream)
    return shown(without_sentinel(rows), *STREAM_ALERT_COLUMNS)


def publish_bus(spark, sf_dir):
    """Both alert streams published to topic folders of their own."""
    hot_topic = run(spark, sf_dir, "bus-hot", lambda s, out: sinks.bus_writer(queries.hot_alert_stream(s), out))
    silence_topic = run(
        spark, sf_dir, "bus-silence", lambda s, out: sinks.bus_writer(queries.silence_alert_stream(s), out)
    )
    return hot_topic, silence_topic


@query
def alert_bus_sink(spark, sf_dir):
    topics = publish_bus(spark, sf_dir)
    bus = spark.read.schema("body string, enqueuedTime timestamp").json(list(topics))
    return shown(without_sentinel(decode.alert_projection(bus)), *STREAM_ALERT_COLUMNS)


@query
def prompt_alert_stream(spark, sf_dir):
    """The groups that are notified of at the first arrival; which of a group's alerts that is depends on the order of
    reading, the groups do not."""
    out = staging.scratch(spark, "prompt")
    bus = alert_bus_stream(streaming_session(spark), list(publish_bus(spark, sf_dir)))
    alerts = queries.prompt_notification_stream(bus)
    queries.start(appended(alerts, out), f"{out}-checkpoint", available_now=True).awaitTermination()
    sent = without_sentinel(sinks.read_appended(spark, out, alerts.schema))
    return shown(sent, "deviceid", "deliveryid", "message", "bucketStart")


class JsonLines:
    """A row writer that leaves each task's rows in a file of the shared folder, as JSON, and refuses some."""

    def __init__(self, folder: str, refused: int | None = None):
        self.folder, self.refused = folder, refused

    def open(self, partition_id: int, batch_id: int) -> bool:
        files, place = fs.FileSystem.from_uri(self.folder)
        files.create_dir(place, recursive=True)
        # A task that runs again writes the same place again.
        self.file = files.open_output_stream(f"{place}/{batch_id}-{partition_id}.json")
        return True

    def process(self, row) -> None:
        if self.refused is not None and row["sequenceNumber"] % self.refused == 0:
            raise ValueError("refused")
        self.file.write((json.dumps(row.asDict()) + "\n").encode())

    def close(self, error) -> None:
        self.file.close()


def uri(folder: str) -> str:
    return folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"


def row_stream(source):
    """Messages to write row by row: those divisible by 17 have no time."""
    rows = decode.decode_telemetry(source).filter(F.col("deviceId") != staging.SENTINEL_DEVICE)
    time = F.when(F.col("sequenceNumber") % 17 != 0, fields.time_text(F.col("occurrenceUtcTime")))
    return rows.select("sequenceNumber", "deviceId", time.alias("occurred"))


@query
def row_writer_sink(spark, sf_dir):
    def writer(source, out):
        make = functools.partial(JsonLines, uri(out))
        return queries.to_batches(row_stream(source), sinks.row_by_row(make))

    out = run(spark, sf_dir, "rows", writer)
    return spark.read.schema("sequenceNumber long, deviceId string, occurred string").json(f"{out}/*.json")


@query
def dead_letter_sink(spark, sf_dir):
    """Where every message ends up: written, refused by the row writer, or set aside for want of a time."""
    schema = T.StructType.fromDDL("sequenceNumber long, deviceId string, occurred string")
    failed = T.StructType([*schema.fields, T.StructField("reason", T.StringType())])

    def writer(source, out):
        refuse = sinks.dead_letter(
            functools.partial(JsonLines, uri(f"{out}/written"), 13), sinks.table_append(f"{out}/failed"), schema=schema
        )
        timed = F.col("occurred").isNotNull()
        untimed = sinks.table_append(f"{out}/untimed")
        return queries.to_batches(row_stream(source), sinks.fan_out(sinks.only(timed, refuse), sinks.only(~timed, untimed)))

    out = run(spark, sf_dir, "dead-letters", writer)
    written = spark.read.schema(schema).json(f"{out}/written/*.json").select("sequenceNumber", F.lit("written").alias("fate"))
    refused = sinks.read_appended(spark, f"{out}/failed", failed).select("sequenceNumber", F.col("reason").alias("fate"))
    untimed = sinks.read_appended(spark, f"{out}/untimed", schema).select("sequenceNumber", F.lit("untimed").alias("fate"))
    return written.unionByName(refused).unionByName(untimed)


@query
def batch_by_count_stream(spark, sf_dir):
    """Batches that go on from trigger to trigger, and the short ones that are left at the end."""
    names = ["partition", "batchNo", "size", "items"]
    schema = packing.batch_by_count(spark.createDataFrame([], HUB_MESSAGE)).select(*names).schema

    def writer(source, out):
        state = batching.remainder_state(f"{out}-state", buckets=2)
        write = batching.batches_across_triggers(sinks.table_append(out), state, size=20)
        return queries.to_batches(source.filter("sequenceNumber >= 0"), sinks.with_retries(write))

    out = run(spark, sf_dir, "batches", writer, rows_per_trigger=DEVICE_TIME_ROWS + 7)
    state = batching.remainder_state(f"{out}-state", buckets=2)
    batches = sinks.read_appended(spark, out, schema).unionByName(batching.unfinished(spark, state, size=20))
    numbers = F.transform("items", lambda item: item["sequenceNumber"].cast("string"))
    return batches.select("partition", "batchNo", "size", F.array_join(numbers, ",").alias("sequenceNumbers"))


def run_notifications(spark, sf_dir, purpose, sink):
    """The notification query over the published bus, closed by a far-future alert on a topic of its own."""
    hot_topic, silence_topic = publish_bus(spark, sf_dir)
    out = staging.scratch(spark, purpose)
    end = staging.scratch(spark, "bus-end")
    last = f'{{"message":"end","deviceid":"{staging.SENTINEL_DEVICE}","lastoccurrenceutctime":"2024-01-03 00:00:00"}}'
    closing = spark.range(1).select(F.lit(last).alias("body"), at(PROCESSED_AT).alias("enqueuedTime"))
    closing.write.json(end)
    bus = alert_bus_stream(streaming_session(spark), [hot_topic, silence_topic, end])
    alerts = queries.notification_stream(bus)
    writer = queries.to_batches(without_sentinel(alerts), sinks.with_retries(sink(out)))
    queries.start(writer, f"{out}-checkpoint", available_now=True).awaitTermination()
    return out, alerts.schema


@query
def alert_stream(spark, sf_dir):
    out, schema = run_notifications(spark, sf_dir, "notifications", sinks.table_append)
    return shown(sinks.read_appended(spark, out, schema), *STREAM_ALERT_COLUMNS)


@query
def notification_sink(spark, sf_dir):
    out, _ = run_notifications(spark, sf_dir, "payloads", sinks.payload_append)
    alerts, _ = decode.decode_alert_payloads(sinks.read_appended(spark, out, sinks.PAYLOAD).select("payload"))
    return shown(alerts, *STREAM_ALERT_COLUMNS)


def post_to(folder: str, payload: str) -> None:
    """Stands for the receiver of notifications: keeps each payload under the name of its content."""
    files, place = fs.FileSystem.from_uri(folder)
    files.create_dir(place, recursive=True)
    with files.open_output_stream(f"{place}/{hashlib.sha1(payload.encode()).hexdigest()}.json") as out:
        out.write(payload.encode())


@query
def notification_post_sink(spark, sf_dir):
    """Notifications handed to their receiver directly, and what it has got."""
    out, _ = run_notifications(
        spark, sf_dir, "posted", lambda out: sinks.notifier(functools.partial(post_to, uri(f"{out}/received")))
    )
    received = spark.read.text(f"{out}/received/*.json", wholetext=True).withColumnRenamed("value", "payload")
    alerts, _ = decode.decode_alert_payloads(received)
    return shown(alerts, *STREAM_ALERT_COLUMNS)


@query
def substream_time(spark, sf_dir):
    schemas = []

    def writer(source, out):
        rows = decode.decode_telemetry(source).select(
            "sequenceNumber", "deviceId", "partitionId", "occurrenceUtcTime", "enqueuedUtcTime"
        )
        schemas.append(rows.schema)
        clocks = device_time.device_clocks(f"{out}-clocks", buckets=BUCKETS)
        return queries.to_batches(rows, device_time.in_device_order(sinks.table_append(out), clocks))

    out = run(spark, sf_dir, "substreams", writer, order="arrival")
    kept = without_sentinel(sinks.read_appended(spark, out, schemas[0]), "deviceId")
    return kept.select("sequenceNumber", "deviceId")


def device_time_alerts(spark, sf_dir, purpose, **options):
    """Hot windows closed by each device's own clock, over messages in order of arrival, DEVICE_TIME_ROWS a step."""
    schema = hot.hot_windows_180(spark.createDataFrame([], TELEMETRY)).select("eventTime", *ALERT_COLUMNS).schema

    def writer(source, out):
        write = device_time.hot_windows_in_device_time(
            sinks.table_append(out), device_time.window_state(f"{out}-state", buckets=BUCKETS), step="step", **options
        )
        step = fields.whole(F.col("place"), DEVICE_TIME_ROWS).alias("step")
        rows = decode.decode_telemetry(source, also=[step])
        return queries.to_batches(rows, sinks.with_retries(write))

    out = run(
        spark, sf_dir, purpose, writer, order="arrival", rows_per_trigger=DEVICE_TIME_ROWS, more="place long"
    )
    return shown(without_sentinel(sinks.read_appended(spark, out, schema)), *STREAM_ALERT_COLUMNS)


@query
def device_time_hot_stream(spark, sf_dir):
    return device_time_alerts(spark, sf_dir, "device-time")


@query
def device_time_isfirst_stream(spark, sf_dir):
    return device_time_alerts(spark, sf_dir, "device-time-first", throttle_seconds=300)


@query
def latest_position_stream(spark, sf_dir):
    def writer(source, out):
        table = tables.latest_positions(out, buckets=BUCKETS)
        return queries.to_batches(queries.position_stream(source), sinks.with_retries(table.write))

    out = run(spark, sf_dir, "latest", writer)
    return shown(tables.latest_positions(out, buckets=BUCKETS).read(spark))


@query
def position_history_stream(spark, sf_dir):
    def writer(source, out):
        history = tables.DailyHistory(out, ttl_days=3, compact_after=2)
        return queries.to_batches(queries.position_history_stream(source), sinks.with_retries(history.write))

    return shown(tables.DailyHistory(run(spark, sf_dir, "history", writer)).read(spark))


@query
def pipeline_metrics(spark, sf_dir):
    """Metric records of one run over all messages, which are timings, as what holds of them: one record for each trigger,
    each with its time and its rates.

    A trigger of so few messages is mostly fixed costs, so streams side by side share the triggers."""
    records = []
    source_session = plain_checkpoints(streaming_session(spark))
    out = staging.scratch(spark, "metered")
    sources = staging.streams(spark, source_session, sf_dir, rows_per_trigger=DEVICE_TIME_ROWS, triggers=None)
    names = [f"metered-{n}" for n in range(len(sources))]
    reporter = monitor.ProgressReporter(records.append, query_name=names)
    source_session.streams.addListener(reporter)
    running = []
    try:
        for name, source in zip(names, sources):
            rows = decode.decode_telemetry(source).select("sequenceNumber", "deviceId")
            write = monitor.paced(sinks.with_retries(sinks.table_append(f"{out}/{name}")), reporter)
            writer = queries.to_batches(rows, write)
            running.append(queries.start(writer, f"{out}-checkpoint/{name}", name=name, available_now=True))
        for stream in running:
            stream.awaitTermination()
        monitor.settle(spark, timeout_ms=300_000)
    finally:
        for stream in running:
            stream.stop()
        source_session.streams.removeListener(reporter)
    metrics = monitor.metric_frame(spark, records)
    # Rows of a trigger: its rate of processing times its time, which the record has in milliseconds, and so about right.
    busy = metrics.filter("procRowsPerSecond > 0").withColumn(
        "rows", F.col("procRowsPerSecond") * F.col("triggerExecution") / 1000
    )
    written = sinks.read_appended(spark, f"{out}/*", rows.schema).agg(F.count(F.lit(1)).alias("written"))
    summed = busy.agg(
        F.count(F.lit(1)).alias("triggers"),
        F.count_if(F.col("triggerExecution") <= 0).alias("untimed"),
        F.sum("rows").alias("rows"),
    )
    return summed.withColumn("written", written.scalar()).select(
        "triggers", "untimed", "written", (F.abs(F.col("rows") - F.col("written")) <= 0.05 * F.col("written")).alias("accounted")
    )
