"""Messages laid out as files for the queries that read a capture folder or a stream.

Everything is derived from the driver's tables by Spark and written to the shared folder, once per application.
"""

from __future__ import annotations

import datetime as dt
import re
import time
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.functions import fields
from fleetpulse.operators.ordered import position_in_order
from fleetpulse.schemas import HUB_MESSAGE
from fleetpulse.session import shared_dir
from fleetpulse.sources.files import Store
from fleetpulse.sources.messages import message_stream
from workload.telemetry import as_messages, messages, rows_to_send, telemetry

SENTINEL_DEVICE = "zz"
_SENTINELS = ("2024-01-02T00:00:00.000000Z", "2024-01-02T12:00:00.000000Z")
# Beyond the places of all messages.
_SENTINEL_PLACE = 1 << 60
# Rows of a staged file, the least that a micro-batch of the streams that read it has.
ROWS_PER_TRIGGER = 25_000
# A larger table is read in as many triggers as this, of several files each, until a trigger has the most rows it may have.
TRIGGERS, FILES_PER_TRIGGER, MOST_ROWS_PER_TRIGGER = 16, 24, 2_000_000
# Messages of small files that a task writes together, if there are enough for all cores.
STAGED_PER_TASK = 50_000
# Envelopes that a task writes to the capture.
CAPTURED_PER_TASK = 250_000

_done: dict[tuple, object] = {}


def scratch(spark: SparkSession, purpose: str) -> str:
    """A new folder for one run."""
    return f"{shared_dir(spark)}/fleetpulse/{spark.sparkContext.applicationId}/{purpose}-{uuid.uuid4().hex[:12]}"


def _once(spark: SparkSession, key: tuple, make):
    key = (spark.sparkContext.applicationId, *key)
    if key not in _done:
        _done[key] = make()
    return _done[key]


def _sentinel(spark: SparkSession, occurred: str) -> DataFrame:
    """A cold state message of a device of its own, far in the future, that moves the watermark."""
    body = (
        f'{{"occurrenceUtcTime":"{occurred}","deviceId":"{SENTINEL_DEVICE}","sensorType":"drone-state-sensor;v1",'
        f'"deliveryId":"{SENTINEL_DEVICE}","temperature":"0.00"}}'
    )
    enqueued = dt.datetime.fromisoformat(occurred.replace("Z", "+00:00"))
    return spark.createDataFrame([(bytearray(body, "utf-8"), enqueued, 0, -1, {})], HUB_MESSAGE)


def staged_stream(
    spark: SparkSession,
    sf_dir: str,
    *,
    order: str = "occurrence",
    rows_per_trigger: int = ROWS_PER_TRIGGER,
    triggers: int | None = TRIGGERS,
) -> tuple[str, int]:
    """Hub messages in order of occurrence or arrival, in files of a fixed number of rows, then two files of a sentinel;
    the folder, and how many files a trigger takes. Files also have the place of a message in that order.

    The files are written at once and then dated one second after the other, as a file source reads them by their times.
    Every trigger visits state and tables as a whole, besides its fixed costs, so a trigger of rows_per_trigger rows would
    make the work grow with the square of the table. It has them, in one file, while that takes at most `triggers`
    triggers; of a larger table it has more, up to MOST_ROWS_PER_TRIGGER. triggers None: always rows_per_trigger.
    """

    def make() -> tuple[str, int]:
        folder = scratch(spark, f"messages-by-{order}")
        rows = telemetry(spark, sf_dir).count()
        count, together = -(-rows // rows_per_trigger), 1
        place = F.col("place")
        file = fields.whole(place, rows_per_trigger)
        if triggers is not None and count > triggers:
            most = max(rows_per_trigger, MOST_ROWS_PER_TRIGGER)
            together = min(-(-count // triggers), FILES_PER_TRIGGER)
            # Files of equal size that fill whole triggers, so that the sentinel has a trigger of its own.
            count = max(triggers, -(-rows // most)) * together
            file = fields.whole(place * count, rows)
        # Messages are built once, where they are written: numbering reads its rows several times, and deals them.
        at = "occ" if order == "occurrence" else "enq"
        placed = position_in_order(rows_to_send(spark, sf_dir), name="place", keys=[], order=[at, "event_id"])
        # A task writes whole files, several if they are small.
        tasks = max(1, min(count, max(-(-rows // STAGED_PER_TASK), 2 * spark.sparkContext.defaultParallelism)))
        dealt = placed.withColumn("file", file.cast("int")).repartitionById(
            tasks, fields.whole(F.col("file") * F.lit(tasks).cast("bigint"), max(count, 1)).cast("int")
        )
        sent = as_messages(dealt, "place", "file")
        sent.select(*HUB_MESSAGE.fieldNames(), "place", "file").write.partitionBy("file").parquet(folder)
        for n, occurred in enumerate(_SENTINELS, count):
            last = _sentinel(spark, occurred).withColumn("place", F.lit(_SENTINEL_PLACE + n).cast("bigint"))
            last.coalesce(1).write.parquet(f"{folder}/file={n}")
        _date_files(spark, folder)
        return folder, together

    return _once(spark, ("stream", sf_dir, order, rows_per_trigger, triggers), make)


def _date_files(spark: SparkSession, folder: str) -> None:
    """Sets the times of the files so that they follow each other by their folder's number."""
    store = Store(spark)
    start = int(time.time()) - 10_000_000
    store.set_times({at: start + int(re.search(r"/file=([0-9]+)/", at)[1]) for at in store.paths(f"{folder}/file=*")})


def stream(
    spark: SparkSession,
    streaming: SparkSession,
    sf_dir: str,
    *,
    more: str | None = None,
    **staged,
) -> DataFrame:
    """The staged messages as a stream, with more columns of the files if some are named; staged: as in staged_stream."""
    folder, files = staged_stream(spark, sf_dir, **staged)
    return message_stream(streaming, f"{folder}/file=*", files_per_trigger=files, more=more)


def streams(spark: SparkSession, streaming: SparkSession, sf_dir: str, **staged) -> list[DataFrame]:
    """The staged messages dealt over up to ten streams, by the last digit of their files' numbers; each reads a file at a
    time, in order. For triggers that are too small to fill the cluster one after the other."""
    folder, files = staged_stream(spark, sf_dir, **staged)
    assert files == 1
    store = Store(spark)
    found = [at for at in (f"{folder}/file=*{digit}" for digit in range(10)) if store.matches(at)]
    # Each lists its folders before it is there.
    with ThreadPoolExecutor(10) as threads:
        return list(threads.map(lambda at: message_stream(streaming, at, files_per_trigger=1), found))


def stored(spark: SparkSession, df: DataFrame, purpose: str) -> DataFrame:
    """The frame as a written table, for an operator that reads its input twice."""
    folder = scratch(spark, purpose)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def staged_capture(spark: SparkSession, sf_dir: str) -> str:
    """A capture folder hub/partition/year/month/day/hour of envelopes, in plain folders without column names."""

    def make() -> str:
        folder = scratch(spark, "capture")
        number, partition = F.col("sequenceNumber").cast("string"), F.col("partition").cast("string")
        # A writer of folders sorts the envelopes of its task, bodies and all, and so has a fixed number of them; few events
        # are left in the tasks that read them.
        tasks = -(-telemetry(spark, sf_dir).count() // CAPTURED_PER_TASK)
        messages(spark, sf_dir, tasks=tasks if tasks > 1 else None).select(
            F.date_format("enqueuedTime", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("EnqueuedTimeUtc"),
            F.col("properties").alias("Properties"),
            F.create_map(F.lit("partitionId"), partition, F.lit("sequenceNumber"), number).alias("SystemProperties"),
            F.col("body").alias("Body"),
            F.concat(F.lit("hub"), F.col("sequenceNumber") % 2).alias("hub"),
            F.col("partition").alias("part"),
            F.date_format("enqueuedTime", "yyyy").alias("year"),
            F.date_format("enqueuedTime", "MM").alias("month"),
            F.date_format("enqueuedTime", "dd").alias("day"),
            F.date_format("enqueuedTime", "HH").alias("hour"),
        ).write.partitionBy(*_LEVELS).parquet(folder)
        _plain_names(Store(spark), folder, _LEVELS)
        return folder

    return _once(spark, ("capture", sf_dir), make)


_LEVELS = ["hub", "part", "year", "month", "day", "hour"]


def _plain_names(store: Store, folder: str, levels: list[str]) -> None:
    """Takes the column names off partition folders, as a hub's capture has none."""
    for name in store.names(folder):
        if levels and name.startswith(f"{levels[0]}="):
            plain = name.removeprefix(f"{levels[0]}=")
            store.rename(f"{folder}/{name}", f"{folder}/{plain}")
            _plain_names(store, f"{folder}/{plain}", levels[1:])
