"""Record types: hub messages, captured envelopes, JSON bodies, alerts, positions and metrics."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


_TEXT, _TIME, _DOUBLE, _INT, _LONG = T.StringType(), T.TimestampType(), T.DoubleType(), T.IntegerType(), T.LongType()
_PROPERTIES = T.MapType(_TEXT, _TEXT)

# A message as it arrives from the hub. sequenceNumber is its position within the hub partition.
HUB_MESSAGE = _struct(
    body=T.BinaryType(),
    enqueuedTime=_TIME,
    partition=_INT,
    sequenceNumber=_LONG,
    properties=_PROPERTIES,
)

# A message as the hub captures it to files.
CAPTURED_ENVELOPE = _struct(
    EnqueuedTimeUtc=_TEXT,
    Properties=_PROPERTIES,
    SystemProperties=_PROPERTIES,
    Body=T.BinaryType(),
)

# JSON body of flight and state messages; numbers stay text until they are cast, so one bad field does not lose a row.
MESSAGE_BODY = _struct(
    occurrenceUtcTime=_TEXT,
    deviceId=_TEXT,
    sensorType=_TEXT,
    deliveryId=_TEXT,
    temperature=_TEXT,
    velocity=_TEXT,
    acceleration=_TEXT,
    position=_TEXT,
    flightStatus=_TEXT,
)

# A decoded message: what the operators work on.
TELEMETRY = _struct(
    sequenceNumber=_LONG,
    partitionId=_INT,
    deviceId=_TEXT,
    deliveryId=_TEXT,
    sensorType=_TEXT,
    occurrenceUtcTime=_TIME,
    enqueuedUtcTime=_TIME,
    processedUtcTime=_TIME,
    temperature=_DOUBLE,
    velocity=_DOUBLE,
    acceleration=_DOUBLE,
    position=_TEXT,
    flightStatus=_TEXT,
)

ENRICHED_TELEMETRY = _struct(
    occurrenceUtcTime=_TEXT,
    deviceId=_TEXT,
    sensorType=_TEXT,
    deliveryId=_TEXT,
    velocity=_DOUBLE,
    acceleration=_DOUBLE,
    latitude=_DOUBLE,
    longitude=_DOUBLE,
    altitude=_DOUBLE,
    flightStatus=_TEXT,
)

DELIVERY_SUMMARY = _struct(deliveryid=_TEXT, startdate=_TEXT, completedate=_TEXT)

# Hot and silence alerts share one record; times are typed inside and become text at the sinks.
ALERT = _struct(
    message=_TEXT,
    partitionid=_INT,
    deviceid=_TEXT,
    deliveryid=_TEXT,
    avgtemperature=_DOUBLE,
    lastenqueuedutctime=_TIME,
    lastoccurrenceutctime=_TIME,
    lastprocessedutctime=_TIME,
)
ALERT_TIMES = ("lastenqueuedutctime", "lastoccurrenceutctime", "lastprocessedutctime")

POSITION = _struct(
    deviceId=_TEXT,
    eventTime=_TIME,
    latitude=_DOUBLE,
    longitude=_DOUBLE,
    sequenceNumber=_LONG,
)

HISTORY = _struct(deviceId=_TEXT, eventTime=_TIME, latitude=_DOUBLE, longitude=_DOUBLE)

DEVICE_CLOCK = _struct(deviceId=_TEXT, partitionId=_INT, occurrenceUtcTime=_TIME)

# An open window of a device, or (windowStart missing) its clock in lastOccurred and until when it has been alerted.
DEVICE_WINDOW = _struct(
    deviceId=_TEXT,
    partitionId=_INT,
    deliveryId=_TEXT,
    windowStart=_TIME,
    count=_LONG,
    total=_DOUBLE,
    lastEnqueued=_TIME,
    lastOccurred=_TIME,
    lastProcessed=_TIME,
    alertedUntil=_TIME,
)

# How many messages a partition has sent, and those of its unfinished batch with their places.
BATCH_REMAINDER = _struct(
    partition=_INT,
    sent=_LONG,
    slots=T.ArrayType(_struct(place=_LONG, item=_struct(sequenceNumber=_LONG, body=T.BinaryType(), properties=_PROPERTIES))),
)

SQL_EVENT = _struct(deviceid=_TEXT, timestamp=_TIME, geo=_TEXT, json=_TEXT)

PIPELINE_METRIC = _struct(
    triggerExecution=_DOUBLE,
    getBatch=_DOUBLE,
    inputRowsPerSecond=_DOUBLE,
    procRowsPerSecond=_DOUBLE,
)
