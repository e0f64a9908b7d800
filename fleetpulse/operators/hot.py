"""Hot-engine alerts over tumbling event-time windows. Every function runs on batch and streaming DataFrames alike."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.functions import fields
from fleetpulse.operators.policy import state_rows
from fleetpulse.schemas import ALERT

HOT_MESSAGE = "hotTemperature"


def hot_windows(
    telemetry: DataFrame,
    *,
    window_seconds: int,
    by_partition: bool,
    threshold: float = fields.HOT_TEMPERATURE,
    lateness: str | None = None,
) -> DataFrame:
    """Alerts for windows whose average temperature reaches the threshold, with the window's time as `eventTime`.

    Windows are [start, end) per device and delivery, and per hub partition if by_partition; partitionid is 0 otherwise.
    `eventTime` is the last instant of the window. lateness sets the watermark a stream needs.
    """
    states = state_rows(telemetry)
    if lateness is not None:
        states = states.withWatermark("occurrenceUtcTime", lateness)
    window = F.window("occurrenceUtcTime", f"{window_seconds} seconds")
    keys = ["deviceId", "deliveryId", *(["partitionId"] if by_partition else [])]
    return (
        states.groupBy(window, *keys)
        .agg(
            F.avg("temperature").alias("avgtemperature"),
            F.max("enqueuedUtcTime").alias("lastenqueuedutctime"),
            F.max("occurrenceUtcTime").alias("lastoccurrenceutctime"),
            F.max("processedUtcTime").alias("lastprocessedutctime"),
        )
        .filter(F.col("avgtemperature") >= threshold)
        .select(
            F.window_time("window").alias("eventTime"),
            F.lit(HOT_MESSAGE).alias("message"),
            (F.col("partitionId") if by_partition else F.lit(0)).alias("partitionid"),
            F.col("deviceId").alias("deviceid"),
            F.col("deliveryId").alias("deliveryid"),
            "avgtemperature",
            "lastenqueuedutctime",
            "lastoccurrenceutctime",
            "lastprocessedutctime",
        )
    )


def hot_windows_180(telemetry: DataFrame, **options) -> DataFrame:
    """180 s windows per device, delivery and hub partition."""
    return hot_windows(telemetry, window_seconds=180, by_partition=True, **options)


def hot_windows_90(telemetry: DataFrame, **options) -> DataFrame:
    """90 s windows per device and delivery."""
    return hot_windows(telemetry, window_seconds=90, by_partition=False, **options)


def first_in_bucket(
    alerts: DataFrame,
    *,
    time: str,
    bucket: str,
    keys: Sequence[str],
    order: Sequence[str],
    shift: str | None = None,
) -> DataFrame:
    """First row of every (keys, aligned time bucket) by `order`, ties by all columns.

    Written as an aggregation, so each task keeps one row per group before the shuffle and a stream can use it too.
    shift moves the bucket edges.
    """
    columns = alerts.columns
    ranked = F.struct(*order, *[c for c in columns if c not in order])
    return (
        alerts.groupBy(F.window(time, bucket, startTime=shift), *keys)
        .agg(F.min(ranked).alias("first"))
        .select(*[F.col(f"first.{c}").alias(c) for c in columns])
    )


def throttle_hot_alerts(alerts: DataFrame) -> DataFrame:
    """First hot alert per device and partition in every five minutes of window end."""
    # eventTime is one microsecond before the window's end, so the bucket edges are as well.
    return first_in_bucket(
        alerts,
        time="eventTime",
        bucket="5 minutes",
        shift="299 seconds 999999 microseconds",
        keys=["deviceid", "partitionid"],
        order=["eventTime", "deliveryid"],
    )


def throttle_silence_alerts(alerts: DataFrame) -> DataFrame:
    """First silence alert per device and partition in every five minutes of its last occurrence."""
    return first_in_bucket(
        alerts,
        time="lastoccurrenceutctime",
        bucket="5 minutes",
        keys=["deviceid", "partitionid"],
        order=["lastoccurrenceutctime", "deliveryid"],
    )


def alert_bus(*sources: DataFrame) -> DataFrame:
    """All alert sources as one, duplicates kept."""
    names = ALERT.fieldNames()
    bus = sources[0].select(*names)
    for source in sources[1:]:
        bus = bus.unionByName(source.select(*names))
    return bus


def notifications(alerts: DataFrame, *, lateness: str | None = None) -> DataFrame:
    """One alert per device, delivery and message in every 150 s of last occurrence: the first of them."""
    if lateness is not None:
        alerts = alerts.withWatermark("lastoccurrenceutctime", lateness)
    return first_in_bucket(
        alerts,
        time="lastoccurrenceutctime",
        bucket="150 seconds",
        keys=["deviceid", "deliveryid", "message"],
        order=["lastoccurrenceutctime"],
    )


def first_at_arrival(
    alerts: DataFrame, *, time: str, bucket_seconds: int, keys: Sequence[str], lateness_seconds: int
) -> DataFrame:
    """On a stream, the first alert to arrive of every (keys, aligned time bucket), with the bucket's start; it leaves in
    the trigger it arrives in, where first_in_bucket waits until the watermark has passed the bucket and then gives the
    earliest in time.

    The keys of a bucket are remembered until the watermark, lateness_seconds and a bucket behind the latest alert, has
    passed them. Alerts older than the watermark are dropped.
    """
    start = F.timestamp_seconds(fields.bin_of(F.col(time), bucket_seconds) * bucket_seconds)
    placed = alerts.withWatermark(time, f"{bucket_seconds + lateness_seconds} seconds").withColumn("bucketStart", start)
    return placed.dropDuplicatesWithinWatermark([*keys, "bucketStart"])


def notifications_at_arrival(alerts: DataFrame, *, lateness_seconds: int = 10) -> DataFrame:
    """notifications, each sent as soon as the first alert of its group arrives."""
    return first_at_arrival(
        alerts,
        time="lastoccurrenceutctime",
        bucket_seconds=150,
        keys=["deviceid", "deliveryid", "message"],
        lateness_seconds=lateness_seconds,
    )
