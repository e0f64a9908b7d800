"""Fleet telemetry derived by Spark from the driver's `events` table (see FIXTURES.md, view m)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.schemas import TELEMETRY
from fleetpulse.session import configure

BASE_MICROS = 1_704_067_200_000_000  # 2024-01-01 00:00:00 UTC
PROCESSED_AT = "2024-01-01 02:00:00"

_SENSOR = """
  case when event_type in ('error', 'view') then 'drone-state-sensor;v1'
       when event_type in ('click', 'purchase') then 'drone-event-sensor;v1'
       else 'drone-event-sensor;v2' end"""
_POSITION = """
  case when event_id % 101 = 0 then 'a|b|c'
       when event_id % 103 = 0 then '+95|-121.989734|93.98'
       when event_id % 107 = 0 then '+47.757084|-190|93.98'
       when event_id % 109 = 0 then '47.757084||-121.989734'
       else concat('+', 47 + event_id % 3, '.', lpad(event_id * 7919 % 1000000, 6, '0'),
                   '|-', 121 + event_id % 4, '.', lpad(event_id * 104729 % 1000000, 6, '0'),
                   '|', event_id % 400, '.', lpad(event_id % 100, 2, '0')) end"""


def rows_to_send(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compressed times (occ, enq) and field texts of every event. In a stretch of twenty minutes a fifth of the users send
    from a spare device, so that their own is silent."""
    events = configure(spark).read.parquet(f"{sf_dir}/events.parquet")
    return (
        events.selectExpr(
            "*", f"(unix_micros(cast(ts as timestamp)) - {BASE_MICROS}) div 720 as off"
        )
        .withColumn("spare", F.expr("if(user_id % 5 = 0 and off between 1200000000 and 2399999999, '-spare', '')"))
        .selectExpr(
            "event_id",
            "cast(user_id % 4 as int) as partition_id",
            "concat('drone-', user_id, spare) as device_id",
            "concat('dlv-', user_id, '-', off div 600000000) as delivery_id",
            f"{_SENSOR} as sensor_type",
            f"timestamp_micros({BASE_MICROS} + off) as occ",
            f"timestamp_micros({BASE_MICROS} + off + 1000000 * (event_id % 11 + if(event_id % 97 = 0, 1200, 0))) as enq",
            "6000 + cast(round(value * 100) as bigint) % 2100 as hundredths",
            f"{_POSITION} as position",
            "cast(event_id % 6 as string) as flight_status",
            "event_id % 31 + 0.5D as velocity",
            "event_id % 7 + 0.25D as acceleration",
        )
        .withColumn("temperature", F.expr("concat(hundredths div 100, '.', lpad(hundredths % 100, 2, '0'))"))
    )


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded telemetry rows."""
    return rows_to_send(spark, sf_dir).select(
        F.col("event_id").alias("sequenceNumber"),
        F.col("partition_id").alias("partitionId"),
        F.col("device_id").alias("deviceId"),
        F.col("delivery_id").alias("deliveryId"),
        F.col("sensor_type").alias("sensorType"),
        F.col("occ").alias("occurrenceUtcTime"),
        F.col("enq").alias("enqueuedUtcTime"),
        F.lit(PROCESSED_AT).cast("timestamp").alias("processedUtcTime"),
        F.col("temperature").cast("double").alias("temperature"),
        "velocity",
        "acceleration",
        "position",
        F.col("flight_status").alias("flightStatus"),
    ).select(*TELEMETRY.fieldNames())


def messages(spark: SparkSession, sf_dir: str, *, tasks: int | None = None) -> DataFrame:
    """The same telemetry as hub messages with a JSON body, built in as many tasks as given or as read the events."""
    rows = rows_to_send(spark, sf_dir)
    return as_messages(rows if tasks is None else rows.repartition(tasks, "event_id"))


def as_messages(rows: DataFrame, *also: str) -> DataFrame:
    """Rows to send as hub messages, with other columns of theirs."""
    body = F.to_json(
        F.struct(
            F.date_format("occ", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("occurrenceUtcTime"),
            F.col("device_id").alias("deviceId"),
            F.col("sensor_type").alias("sensorType"),
            F.col("delivery_id").alias("deliveryId"),
            "temperature",
            "velocity",
            "acceleration",
            "position",
            F.col("flight_status").cast("int").alias("flightStatus"),
        )
    )
    # Through a generator, so that filters on the body do not build it a second time.
    return rows.select(
        F.explode(F.array(F.encode(body, "utf-8"))).alias("body"),
        F.col("enq").alias("enqueuedTime"),
        F.col("partition_id").alias("partition"),
        F.col("event_id").alias("sequenceNumber"),
        F.create_map(F.lit("kind"), F.col("sensor_type")).alias("properties"),
        *also,
    )
