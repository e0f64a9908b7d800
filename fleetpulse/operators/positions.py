"""Latest and historical positions, and the questions a map asks of them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetpulse.functions import fields, geo
from fleetpulse.operators.decode import parse_bodies
from fleetpulse.operators.policy import event_rows, split_by_position

HISTORY_TTL = dt.timedelta(seconds=259_200)
NEWEST_LIMIT = 10_000


def positions(telemetry: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(POSITION rows, quarantined messages) of the flight sensor; the time is the enqueued time."""
    valid, quarantined = split_by_position(event_rows(telemetry))
    return (
        valid.select(
            "deviceId", F.col("enqueuedUtcTime").alias("eventTime"), "latitude", "longitude", "sequenceNumber"
        ),
        quarantined,
    )


def raw_positions(telemetry: DataFrame) -> DataFrame:
    """(device, time, WKT point) of the flight sensor from an unchecked split that keeps the number text."""
    position = F.col("position")
    return event_rows(telemetry).select(
        F.col("deviceId").alias("device_id"),
        fields.time_text(F.col("enqueuedUtcTime")).alias("event_time"),
        fields.wkt_point(fields.position_part(position, 1), fields.position_part(position, 0)).alias("location"),
    )


def latest_position(located: DataFrame) -> DataFrame:
    """One POSITION per device: the latest enqueued, then the highest sequence number.

    A hash aggregation, one row per device and task before the shuffle: time and sequence number are one decimal, whose
    buffer has a fixed width, where that of a struct would have the rows sorted. Rows that agree in both are one message.
    """
    micros = F.unix_micros("eventTime").cast("decimal(38,0)")
    age = micros * F.lit(str(2**63)).cast("decimal(20,0)") + F.coalesce("sequenceNumber", F.lit(-1)).cast("decimal(19,0)")
    newest = located.withColumn("newest", age.cast("decimal(38,0)"))
    return newest.groupBy("deviceId").agg(
        *[F.max_by(c, "newest").alias(c) for c in ("eventTime", "latitude", "longitude", "sequenceNumber")]
    )


def position_documents(located: DataFrame) -> DataFrame:
    """Positions as documents keyed by device, location as a GeoJSON point."""
    return located.select(
        F.col("deviceId").alias("id"),
        "deviceId",
        fields.geojson_point(F.col("longitude"), F.col("latitude")).alias("Location"),
        F.col("eventTime").alias("Timestamp"),
    )


def position_history(
    located: DataFrame, *, as_of: Column | None = None, ttl: dt.timedelta = HISTORY_TTL
) -> DataFrame:
    """Distinct (device, time, point), without those older than ttl at as_of. The age counts from the event time."""
    if as_of is not None:
        located = located.filter(F.col("eventTime") >= as_of - F.lit(ttl))
    return located.select("deviceId", "eventTime", "latitude", "longitude").distinct()


def last_known(events: DataFrame, *, device: str = "deviceId", time: str = "eventTime") -> DataFrame:
    """All rows that carry the latest time of their device, ties kept.

    The join key includes the time, so the rows of one device spread over the tasks; the latest times themselves are
    one row per device, which the optimizer broadcasts only while they are small.
    """
    latest = events.groupBy(device).agg(F.max(time).alias(time))
    return events.join(latest, [device, time], "left_semi")


def in_box(located: DataFrame, sw_lon: float, sw_lat: float, ne_lon: float, ne_lat: float) -> DataFrame:
    return located.filter(geo.in_box(F.col("longitude"), F.col("latitude"), sw_lon, sw_lat, ne_lon, ne_lat))


def in_polygon(located: DataFrame, ring: geo.Ring) -> DataFrame:
    """Points inside a closed ring of (lon, lat); edges are straight in longitude and latitude."""
    return located.filter(geo.in_ring(F.col("longitude"), F.col("latitude"), ring))


def devices_in_polygon(located: DataFrame, ring: geo.Ring) -> DataFrame:
    return in_polygon(located, ring).select("deviceId").distinct()


def newest_in_box(
    located: DataFrame, sw_lon: float, sw_lat: float, ne_lon: float, ne_lat: float, *, limit: int = NEWEST_LIMIT
) -> DataFrame:
    """The newest positions in a box, at most `limit`."""
    return (
        in_box(located, sw_lon, sw_lat, ne_lon, ne_lat)
        .orderBy(F.desc("eventTime"), "deviceId", "sequenceNumber")
        .limit(limit)
    )


def envelope(located: DataFrame) -> DataFrame:
    """Bounding box of all positions; (180, 90, -180, -90) when there are none."""
    return located.agg(
        F.coalesce(F.min("longitude"), F.lit(180.0)).alias("swLon"),
        F.coalesce(F.min("latitude"), F.lit(90.0)).alias("swLat"),
        F.coalesce(F.max("longitude"), F.lit(-180.0)).alias("neLon"),
        F.coalesce(F.max("latitude"), F.lit(-90.0)).alias("neLat"),
    )


def sql_events(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(SQL_EVENT rows with WKT point and original JSON, quarantined messages) of the flight sensor."""
    valid, quarantined = split_by_position(event_rows(parse_bodies(messages)))
    return (
        valid.select(
            F.col("deviceId").alias("deviceid"),
            F.col("enqueuedTime").alias("timestamp"),
            fields.wkt_point(F.col("longitude"), F.col("latitude")).alias("geo"),
            F.col("telemetryJson").alias("json"),
        ),
        quarantined,
    )
