"""The streaming queries: the batch operators behind a source, a watermark, a checkpoint and a sink."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from fleetpulse.operators import hot, positions, silence
from fleetpulse.operators.decode import alert_projection, decode_telemetry
from fleetpulse.streaming.sinks import BatchWriter

# Watermarks of the hot, silence and notification streams.
HOT_LATENESS = "5 seconds"
NOTIFICATION_LATENESS = "10 seconds"


def hot_alert_stream(messages: DataFrame, *, lateness: str = HOT_LATENESS) -> DataFrame:
    """90 s hot windows of a message stream."""
    return hot.hot_windows_90(decode_telemetry(messages), lateness=lateness)


def throttled_hot_stream(messages: DataFrame, *, lateness: str = HOT_LATENESS) -> DataFrame:
    """180 s hot windows, then the first per device and five minutes: two chained aggregations.

    A bucket is emitted when the watermark has passed it.
    """
    return hot.throttle_hot_alerts(hot.hot_windows_180(decode_telemetry(messages), lateness=lateness))


def silence_alert_stream(messages: DataFrame, *, gap_seconds: int = silence.GAP_SECONDS) -> DataFrame:
    """Alerts for devices without a state message within the gap."""
    silent = silence.silent_gaps_stream(decode_telemetry(messages), gap_seconds=gap_seconds)
    return silence.silence_alerts(silent, by_partition=False)


def silent_minutes_alert_stream(messages: DataFrame) -> DataFrame:
    """Alerts for devices that sent nothing from minute 2 to minute 10."""
    return silence.silence_alerts(silence.silent_minutes_stream(decode_telemetry(messages)), by_partition=True)


def throttled_silence_stream(messages: DataFrame) -> DataFrame:
    """Silent minutes, then the first per device and partition and five minutes: an outer join and an aggregation."""
    return hot.throttle_silence_alerts(silent_minutes_alert_stream(messages))


def bus_alerts(bus: DataFrame) -> DataFrame:
    """Alerts of the bus as they were published."""
    alerts = alert_projection(bus)
    return alerts.select(
        "message",
        "partitionid",
        "deviceid",
        "deliveryid",
        "avgtemperature",
        "lastenqueuedutctime",
        "lastoccurrenceutctime",
        F.col("processedutctime").alias("lastprocessedutctime"),
    )


def notification_stream(bus: DataFrame, *, lateness: str = NOTIFICATION_LATENESS) -> DataFrame:
    """First alert per device, delivery, message and 150 s of the alert bus: the earliest, once its bucket is over."""
    return hot.notifications(bus_alerts(bus), lateness=lateness)


def prompt_notification_stream(bus: DataFrame) -> DataFrame:
    """First alert per device, delivery, message and 150 s of the alert bus: the first to arrive, at once."""
    return hot.notifications_at_arrival(bus_alerts(bus))


def position_stream(messages: DataFrame) -> DataFrame:
    """Valid positions of a message stream."""
    valid, _ = positions.positions(decode_telemetry(messages))
    return valid


def position_history_stream(messages: DataFrame) -> DataFrame:
    """Valid positions, all of them, however late: a watermark would lose what a slow partition sends.

    Repeats are appended too; positions.position_history reads each (device, time, point) once.
    """
    return position_stream(messages).drop("sequenceNumber")


def start(
    writer: DataStreamWriter,
    checkpoint: str,
    *,
    name: str | None = None,
    every: str | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Starts a query with its checkpoint; available_now works off what is there and stops."""
    if name is not None:
        writer = writer.queryName(name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif every is not None:
        writer = writer.trigger(processingTime=every)
    return writer.option("checkpointLocation", checkpoint).start()


def to_batches(stream: DataFrame, write: BatchWriter) -> DataStreamWriter:
    """A stream whose micro-batches go to a batch writer."""
    return stream.writeStream.outputMode("append").foreachBatch(write)
