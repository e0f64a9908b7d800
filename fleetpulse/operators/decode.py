"""From hub messages to typed telemetry, and alerts to and from JSON."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetpulse.functions import fields
from fleetpulse.schemas import ALERT, ALERT_TIMES, MESSAGE_BODY


def nonempty_bodies(messages: DataFrame) -> DataFrame:
    """Messages that carry a body."""
    return messages.filter(F.length("body") > 0)


def envelope_to_messages(envelopes: DataFrame) -> DataFrame:
    """Captured envelopes in the shape of live hub messages."""
    system = F.col("SystemProperties")
    return envelopes.select(
        F.col("Body").alias("body"),
        fields.to_time(F.col("EnqueuedTimeUtc")).alias("enqueuedTime"),
        system["partitionId"].try_cast("int").alias("partition"),
        system["sequenceNumber"].try_cast("bigint").alias("sequenceNumber"),
        F.col("Properties").alias("properties"),
    )


def parse_bodies(messages: DataFrame) -> DataFrame:
    """Adds telemetryJson (the body as text) and its fields as text, from one JSON parse per message.

    The fields come out of a generator, so a filter on one of them stays above it instead of parsing again below.
    """
    text = messages.withColumn("telemetryJson", fields.body_text(F.col("body")))
    return text.select(
        *messages.columns, "telemetryJson", F.inline(F.array(F.from_json("telemetryJson", MESSAGE_BODY)))
    )


def decode_telemetry(
    messages: DataFrame, *, processed_at: Column | None = None, also: Sequence[Column] = ()
) -> DataFrame:
    """Hub messages as TELEMETRY rows; fields that are missing or do not parse are NULL.

    processed_at defaults to the time of the batch or trigger. also: more columns, of those of the messages.
    """
    return parse_bodies(messages).select(
        "sequenceNumber",
        F.col("partition").alias("partitionId"),
        "deviceId",
        "deliveryId",
        "sensorType",
        fields.to_time(F.col("occurrenceUtcTime")).alias("occurrenceUtcTime"),
        F.col("enqueuedTime").alias("enqueuedUtcTime"),
        (F.current_timestamp() if processed_at is None else processed_at).alias("processedUtcTime"),
        fields.to_number(F.col("temperature")).alias("temperature"),
        fields.to_number(F.col("velocity")).alias("velocity"),
        fields.to_number(F.col("acceleration")).alias("acceleration"),
        "position",
        "flightStatus",
        *also,
    )


def state_projection(messages: DataFrame, *, processed_at: Column | None = None) -> DataFrame:
    """State-sensor messages as (occurrence, enqueued, processed, device, sensor, delivery, temperature)."""
    return (
        decode_telemetry(messages, processed_at=processed_at)
        .filter(F.col("sensorType") == fields.STATE_SENSOR)
        .select(
            "occurrenceUtcTime",
            "enqueuedUtcTime",
            "processedUtcTime",
            "deviceId",
            "sensorType",
            "deliveryId",
            "temperature",
        )
    )


def enrich_telemetry(messages: DataFrame) -> DataFrame:
    """ENRICHED_TELEMETRY rows of all versions of the flight sensor: position split, status decoded."""
    position = F.col("position")
    return (
        parse_bodies(messages)
        .filter(F.col("sensorType").startswith(fields.EVENT_SENSOR_PREFIX))
        .select(
            "occurrenceUtcTime",
            "deviceId",
            "sensorType",
            "deliveryId",
            fields.to_number(F.col("velocity")).alias("velocity"),
            fields.to_number(F.col("acceleration")).alias("acceleration"),
            fields.to_number(fields.position_part(position, 0)).alias("latitude"),
            fields.to_number(fields.position_part(position, 1)).alias("longitude"),
            fields.to_number(fields.position_part(position, 2)).alias("altitude"),
            fields.flight_status(F.col("flightStatus")).alias("flightStatus"),
        )
    )


def cast_times(df: DataFrame, *names: str) -> DataFrame:
    """Text columns to timestamps, NULL where malformed."""
    return df.withColumns({name: fields.to_time(F.col(name)) for name in names})


def flag_temperature(messages: DataFrame, temperature: Column, *, threshold: float = fields.HOT_TEMPERATURE) -> DataFrame:
    """Sets the message property temperatureAlert."""
    flag = F.create_map(F.lit("temperatureAlert"), fields.temperature_alert(temperature, threshold))
    others = F.map_filter("properties", lambda key, _: key != "temperatureAlert")
    return messages.withColumn("properties", F.map_concat(F.coalesce(others, F.expr("map()").cast("map<string,string>")), flag))


def alert_record(alerts: DataFrame) -> DataFrame:
    """Alerts as the eight-column record of the sinks, times as text."""
    return alerts.select(
        *[
            fields.time_text(F.col(name)).alias(name) if name in ALERT_TIMES else F.col(name)
            for name in ALERT.fieldNames()
        ]
    )


def alert_body(alerts: DataFrame, *kept: str) -> DataFrame:
    """One JSON object per alert, as the body of a bus message, after the columns to be kept."""
    record = alert_record(alerts)
    return record.select(*kept, F.to_json(F.struct(*record.columns)).alias("body"))


def alert_array(alerts: DataFrame) -> DataFrame:
    """One JSON array with a single alert per row, the form the notification function accepts."""
    record = alert_record(alerts)
    return record.select(F.to_json(F.array(F.struct(*record.columns))).alias("payload"))


def alert_projection(bus: DataFrame, *, processed_at: Column | None = None) -> DataFrame:
    """Bus messages (body, enqueuedTime) as typed alerts with their arrival and processing time."""
    names = ALERT.fieldNames()
    text = T.StructType([T.StructField(name, T.StringType()) for name in names])
    parsed = bus.select(F.from_json(fields.body_text(F.col("body")), text).alias("alert"), "enqueuedTime")
    return parsed.select(
        *[F.col(f"alert.{name}").alias(name) if name not in ALERT_TIMES
          else fields.to_time(F.col(f"alert.{name}")).alias(name) for name in names],
        F.col("enqueuedTime").alias("enqueuedUtcTime"),
        (F.current_timestamp() if processed_at is None else processed_at).alias("processedutctime"),
    ).withColumns(
        {
            "partitionid": fields.to_whole(F.col("partitionid").cast("string")),
            "avgtemperature": F.col("avgtemperature").try_cast("double"),
        }
    )


def decode_alert_payloads(payloads: DataFrame, column: str = "payload") -> tuple[DataFrame, DataFrame]:
    """(alerts, rejected payloads) of JSON arrays of alert objects.

    Keys match whatever their case; of keys that differ by case only the last counts. A payload that is not an array of objects is rejected as a whole.
    """
    kept = [c for c in payloads.columns if c != column]
    parsed = payloads.withColumn(
        "items", F.from_json(column, T.ArrayType(T.MapType(T.StringType(), T.StringType())), {"mode": "PERMISSIVE"})
    )
    rejected = parsed.filter(F.col("items").isNull()).drop("items")

    def value(name: str) -> Column:
        same = F.map_filter("item", lambda key, _: F.lower(key) == name)
        return F.try_element_at(F.map_values(same), F.lit(-1))

    alerts = parsed.select(*kept, F.explode("items").alias("item")).select(
        *kept,
        value("message").alias("message"),
        fields.to_whole(value("partitionid")).alias("partitionid"),
        value("deviceid").alias("deviceid"),
        value("deliveryid").alias("deliveryid"),
        value("avgtemperature").try_cast("double").alias("avgtemperature"),
        *[fields.to_time(value(name)).alias(name) for name in ALERT_TIMES],
    )
    return alerts, rejected
