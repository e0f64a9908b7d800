"""Reading captured messages and message streams."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fleetpulse.schemas import CAPTURED_ENVELOPE, HUB_MESSAGE
from fleetpulse.sources.files import Store


# Messages that one trigger of each stream takes at most, for max_offsets below.
HOT_PER_TRIGGER, SILENCE_PER_TRIGGER, ALERTS_PER_TRIGGER, POSITIONS_PER_TRIGGER = 120_000, 50_000, 30_000, 64_000


def captured_envelopes(spark: SparkSession, path: str, *, file_format: str = "avro") -> DataFrame:
    """All envelopes under a capture folder (hub/partition/date/time), whatever the files are called."""
    reader = spark.read.schema(CAPTURED_ENVELOPE).option("recursiveFileLookup", True)
    if file_format == "avro":
        reader = reader.option("ignoreExtension", True)
    return reader.format(file_format).load(path)


def capture_range(
    spark: SparkSession,
    path: str,
    *,
    hub: str | None = None,
    partitions: Sequence[int] | None = None,
    first_day: dt.date | None = None,
    last_day: dt.date | None = None,
    file_format: str = "avro",
) -> DataFrame:
    """Envelopes of some hubs, partitions and days of a capture folder laid out as hub/partition/year/month/day/..., with
    the columns hub, hubPartition and day taken from the path.

    Folders outside the range are neither listed nor read: the day's three levels are walked only as far as they match.
    """
    store = Store(spark)
    found = []
    for h in [n for n in store.names(path) if hub is None or n == hub]:
        for p in [n for n in store.names(f"{path}/{h}") if n.isdecimal() and (partitions is None or int(n) in partitions)]:
            found += _days(store, f"{path}/{h}/{p}", first_day, last_day)
    reader = spark.read.schema(CAPTURED_ENVELOPE).option("recursiveFileLookup", True).format(file_format)
    if file_format == "avro":
        reader = reader.option("ignoreExtension", True)
    if not found:
        read = spark.createDataFrame([], CAPTURED_ENVELOPE).withColumn("__at", F.lit(""))
    else:
        read = reader.load(found).withColumn("__at", F.col("_metadata.file_path"))
    # hub/partition/year/month/day, the first five names below the capture folder.
    below = F.split(F.regexp_extract("__at", _BELOW, 0), "/")
    return read.select(
        *CAPTURED_ENVELOPE.fieldNames(),
        F.get(below, F.lit(1)).alias("hub"),
        F.get(below, F.lit(2)).try_cast("int").alias("hubPartition"),
        F.concat_ws("-", F.slice(below, 4, 3)).try_cast("date").alias("day"),
    )


# The names from the hub's to the file's in a capture path, with the slash before them.
_BELOW = r"/[^/]+/[0-9]+/[0-9]{4}/[0-9]{2}/[0-9]{2}/"


def _days(store: Store, folder: str, first: dt.date | None, last: dt.date | None) -> list[str]:
    """Day folders below a partition's within the range."""
    low, high = (first or dt.date.min).timetuple()[:3], (last or dt.date.max).timetuple()[:3]

    def within(*parts: int) -> bool:
        return low[: len(parts)] <= parts <= high[: len(parts)]

    def numbers(at: str) -> list[tuple[str, int]]:
        return [(n, int(n)) for n in store.names(at) if n.isdecimal()]

    return [
        f"{folder}/{y}/{m}/{d}"
        for y, year in numbers(folder) if within(year)
        for m, month in numbers(f"{folder}/{y}") if within(year, month)
        for d, day in numbers(f"{folder}/{y}/{m}") if within(year, month, day)
    ]


def message_stream(
    spark: SparkSession,
    path: str,
    *,
    file_format: str = "parquet",
    files_per_trigger: int | None = None,
    bytes_per_trigger: int | None = None,
    more: str | None = None,
) -> DataFrame:
    """Hub messages as they land in a folder. files_per_trigger or bytes_per_trigger bounds a micro-batch. more: columns
    that the files have besides, as "name type, ..."."""
    if files_per_trigger is not None and bytes_per_trigger is not None:
        raise ValueError("give one limit")
    schema = StructType([*HUB_MESSAGE.fields, *(StructType.fromDDL(more).fields if more else [])])
    reader = spark.readStream.schema(schema).format(file_format)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if bytes_per_trigger is not None:
        reader = reader.option("maxBytesPerTrigger", bytes_per_trigger)
    return reader.load(path)


def kafka_options(
    servers: str, topic: str, *, group: str | None = None, max_offsets: int | None = None, from_end: bool = True
) -> dict[str, str]:
    """Options of a Kafka-compatible hub: start position, consumer group and rate limit."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "latest" if from_end else "earliest",
    }
    if group is not None:
        options["kafka.group.id"] = group
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def kafka_messages(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Hub messages from a Kafka-compatible endpoint; needs the spark-sql-kafka package on the cluster."""
    records = spark.readStream.format("kafka").options(**options, includeHeaders="true").load()
    headers = F.transform(
        F.coalesce("headers", F.array().cast("array<struct<key:string,value:binary>>")),
        lambda h: F.struct(h["key"], h["value"].cast("string")),
    )
    return records.select(
        F.col("value").alias("body"),
        F.col("timestamp").alias("enqueuedTime"),
        "partition",
        F.col("offset").alias("sequenceNumber"),
        F.map_from_entries(headers).alias("properties"),
    )


def alert_bus_stream(spark: SparkSession, topics: Sequence[str]) -> DataFrame:
    """The alert bus: (body, enqueuedTime) of all topic folders written by the bus sink, as one stream."""
    bus = None
    for topic in topics:
        lines = spark.readStream.schema("body string, enqueuedTime timestamp").json(topic)
        bus = lines if bus is None else bus.unionByName(lines)
    return bus
