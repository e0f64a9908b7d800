"""Event time per device: each device and partition has its own progress, where a watermark has one for the stream.

A device's clock is the latest occurrence it has sent. Windows of a device close when its own clock has passed them, or,
for a device that has stopped sending, when messages in general have arrived `idle` later; so a device far behind the
others keeps its windows. What comes for a window that was closed before its trigger goes to the second output, as do
messages without a time.

Every trigger runs on the batch engine: rows are reduced, before any shuffle, to one partial window per device, delivery
and window, and meet the open windows of the buckets that the trigger's devices are in. Buckets with nothing new are
read only when a window in them falls due by arrival; a device that is quiet for longer leaves no state at all. State is
read as it was before the trigger, so a replay writes the same.

A trigger costs several jobs however few its rows are, so one trigger may take the rows of many small ones: its messages
then carry the number of their step, and what is late is told from the clocks before the step, not before the trigger.
Alerts and state are those of a trigger for each step.
"""

from __future__ import annotations

import datetime as dt
import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetpulse.functions import fields
from fleetpulse.operators import hot
from fleetpulse.operators.policy import LATE_AFTER, OUT_OF_ORDER_AFTER, split_out_of_order, split_untimed
from fleetpulse.schemas import DEVICE_CLOCK, DEVICE_WINDOW
from fleetpulse.streaming.sinks import BatchWriter
from fleetpulse.streaming.tables import KeyedTable, PartedFiles, bucketed_files

KEYS = ["deviceId", "partitionId"]
_STEP = "__step"


def _latest(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*KEYS).agg(F.max("occurrenceUtcTime").alias("occurrenceUtcTime"))


def device_clocks(path: str, *, buckets: int = 64) -> KeyedTable:
    """The latest occurrence every device has sent."""
    return KeyedTable(path, DEVICE_CLOCK, _latest, KEYS, buckets=buckets)


def in_device_order(
    keep: BatchWriter,
    clocks: KeyedTable,
    *,
    limit: dt.timedelta = OUT_OF_ORDER_AFTER,
    quarantine: BatchWriter | None = None,
) -> BatchWriter:
    """split_out_of_order on a stream of telemetry: passes on to `keep` what is not too far behind its device, and to
    `quarantine` the rest, messages without a time included, with the column reason.

    A micro-batch starts from the clocks before it (of the buckets its devices are in) and then moves them, all with the
    batch operators, so a busy device is spread over tasks here too.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            before = clocks.read_before(batch.sparkSession, batch_id, like=batch)
            kept, dropped, untimed = split_out_of_order(batch, limit=limit, clocks=before)
            keep(kept, batch_id)
            if quarantine is not None:
                behind = dropped.withColumn("reason", F.lit("out_of_order"))
                quarantine(behind.unionByName(untimed.withColumn("reason", F.lit("untimed"))), batch_id)
            clocks.write(split_untimed(batch)[0], batch_id)
        finally:
            batch.unpersist()

    return write


def window_state(path: str, *, buckets: int = 64) -> PartedFiles:
    """Open windows and clocks of devices."""
    return bucketed_files(path, DEVICE_WINDOW, KEYS, buckets=buckets)


def _interval(seconds: float) -> Column:
    return F.make_dt_interval(secs=F.lit(seconds))


def hot_windows_in_device_time(
    alerts: BatchWriter,
    state: PartedFiles,
    *,
    window_seconds: int = 180,
    threshold: float = fields.HOT_TEMPERATURE,
    lateness: dt.timedelta = OUT_OF_ORDER_AFTER,
    idle: dt.timedelta = LATE_AFTER,
    throttle_seconds: int | None = None,
    quarantine: BatchWriter | None = None,
    step: str | None = None,
) -> BatchWriter:
    """hot_windows per device, delivery and partition on a stream of telemetry, closed by each device's own clock.

    A window closes when its device's clock is `lateness` past its end, or when arrival is `idle` past it. Alerts of the
    windows that a trigger closes go to `alerts`, with the window's last instant as eventTime. With throttle_seconds only
    the first alert per device, partition and bucket of that length goes there: a device's windows close in order, so it
    goes out in the trigger that closes its window, and the bucket is remembered with the device's clock.
    `quarantine` gets the other messages, with the column reason: late (their window was closed before the trigger) or
    untimed. step names a column of ascending numbers, never missing: what is said here of triggers then holds of the rows
    of each number.
    """
    after, quiet = lateness.total_seconds(), idle.total_seconds()
    end = F.col("windowStart") + _interval(window_seconds)
    cell = [*KEYS, "deliveryId", "windowStart"]
    sums = {
        "count": F.sum("count"), "total": F.sum("total"), "lastEnqueued": F.max("lastEnqueued"),
        "lastOccurred": F.max("lastOccurred"), "lastProcessed": F.max("lastProcessed"),
    }

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        try:
            columns = [c for c in batch.columns if c != step]
            timed, untimed = split_untimed(batch.withColumn(_STEP, F.lit(0) if step is None else F.col(step)))
            manifest = state.manifest(spark, batch_id)
            newest = timed.agg(F.unix_micros(F.max("enqueuedUtcTime"))).first()[0]
            arrived_before = manifest.mark
            arrived = max((n for n in (newest, arrived_before) if n is not None), default=None)
            if arrived is None:
                held, touched = state.rows(spark, manifest), []
            else:
                fallen = [part for part, due in manifest.due.items() if due <= arrived]
                touched = sorted({*state.touched(timed), *fallen})
                held = state.rows(spark, manifest, touched)
            clocks = held.where(F.col("windowStart").isNull()).select(*KEYS, F.col("lastOccurred").alias("clock"), "alertedUntil")
            seen = timed.groupBy(*KEYS, _STEP).agg(
                F.max("occurrenceUtcTime").alias("clock"), F.max("enqueuedUtcTime").alias("arrived")
            )
            clocks_before = _before_steps(seen, clocks, arrived_before)
            # A window that ends by then was closed before this step.
            before = F.greatest(F.col("clockBefore") - _interval(after), F.col("arrivedBefore") - _interval(quiet))
            start = fields.bin_of(F.col("occurrenceUtcTime"), window_seconds) * window_seconds
            placed, late = timed.withColumn("windowStart", F.timestamp_seconds(start)), F.coalesce(end <= before, F.lit(False))
            if quarantine is not None:
                given = _same_device(placed, clocks_before, _STEP).filter(late).select(*columns, F.lit("late").alias("reason"))
                quarantine(given.unionByName(untimed.select(*columns, F.lit("untimed").alias("reason"))), batch_id)
            if not touched:
                alerts(_alerts(spark.createDataFrame([], DEVICE_WINDOW), end, threshold), batch_id)
                state.replace(held, batch_id, [], mark=arrived)
                return
            # All messages of a window and step are late or none, so they are reduced before they meet their device's clock.
            partial = placed.filter(F.col("sensorType") == fields.STATE_SENSOR).groupBy(*cell, _STEP).agg(
                F.count("temperature").alias("count"), F.sum("temperature").alias("total"),
                F.max("enqueuedUtcTime").alias("lastEnqueued"), F.max("occurrenceUtcTime").alias("lastOccurred"),
                F.max("processedUtcTime").alias("lastProcessed"),
            )
            in_time = _same_device(partial, clocks_before, _STEP).filter(~late).select(*cell, *sums)
            old = held.where(F.col("windowStart").isNotNull()).select(*cell, *sums)
            windows = old.unionByName(in_time).groupBy(*cell).agg(*[f.alias(n) for n, f in sums.items()])
            moved = clocks.select(*KEYS, "clock", "alertedUntil").unionByName(
                seen.groupBy(*KEYS).agg(F.max("clock").alias("clock")), allowMissingColumns=True
            )
            clocks_now = moved.groupBy(*KEYS).agg(F.max("clock").alias("clock"), F.max("alertedUntil").alias("alertedUntil"))
            now = F.greatest(F.col("clock") - _interval(after), _time(arrived - round(quiet * 1e6)))
            judged = _same_device(windows, clocks_now).withColumn("closed", F.coalesce(end <= now, F.lit(False))).persist()
            try:
                closing = judged.filter("closed")
                found = _alerts(closing, end, threshold, "alertedUntil")
                last = None
                if throttle_seconds is not None:
                    # The window's end is a microsecond after its last instant.
                    bucket = fields.whole(F.unix_micros("eventTime") + 1, throttle_seconds * fields.MICROS)
                    bucket_end = F.timestamp_seconds((bucket + 1) * throttle_seconds)
                    fresh = found.withColumn("until", bucket_end).filter(
                        F.col("alertedUntil").isNull() | (F.col("until") > F.col("alertedUntil"))
                    )
                    names = [c for c in found.columns if c != "alertedUntil"]
                    order = ["eventTime", "deliveryid", *[c for c in names if c not in ("eventTime", "deliveryid")]]
                    first = fresh.groupBy("deviceid", "partitionid", "until").agg(F.min(F.struct(*order)).alias("first"))
                    found = first.select("until", *[F.col(f"first.{c}").alias(c) for c in names])
                    last = found.groupBy(F.col("deviceid").alias("deviceId"), F.col("partitionid").alias("partitionId")).agg(
                        F.max("until").alias("until")
                    )
                alerts(found.drop("alertedUntil", "until"), batch_id)
                if last is not None:
                    clocks_now = _same_device(clocks_now, last).withColumn(
                        "alertedUntil", F.greatest("alertedUntil", "until")
                    ).drop("until")
                state.replace(_state(judged, clocks_now, after, quiet, arrived), batch_id, touched, due=_due(end, after, quiet), mark=arrived)
            finally:
                judged.unpersist()
        finally:
            batch.unpersist()

    return write


def _time(micros: int | None) -> Column:
    return F.timestamp_micros(F.lit(micros).cast("bigint"))


def _before_steps(seen: DataFrame, clocks: DataFrame, arrived_before: int | None) -> DataFrame:
    """(device, partition, step, clockBefore, arrivedBefore) of the devices in each step: a device's clock, and the latest
    arrival of all, before it. seen: their latest times in each step; clocks: before the first."""
    marks = seen.select(*KEYS, _STEP, "clock").unionByName(
        clocks.select(*KEYS, F.lit(None).cast(seen.schema[_STEP].dataType).alias(_STEP), "clock")
    )
    # A missing step sorts first: the clock that the trigger starts from.
    earlier = W.partitionBy(*KEYS).orderBy(_STEP).rowsBetween(W.unboundedPreceding, -1)
    told = marks.withColumn("clockBefore", F.max("clock").over(earlier)).filter(F.col(_STEP).isNotNull()).drop("clock")
    # One row for each step.
    steps = seen.groupBy(_STEP).agg(F.max("arrived").alias("arrived"))
    earlier_steps = W.orderBy(_STEP).rowsBetween(W.unboundedPreceding, -1)
    arrivals = steps.select(
        F.col(_STEP).alias("__of"), F.greatest(F.max("arrived").over(earlier_steps), _time(arrived_before)).alias("arrivedBefore")
    )
    return told.join(arrivals, F.col(_STEP) == F.col("__of")).drop("__of")


def _same_device(rows: DataFrame, others: DataFrame, *also: str) -> DataFrame:
    """A left join on device and partition, and on other columns, where a missing one is a device too."""
    keys = [*KEYS, *also]
    renamed = others.select(*[F.col(k).alias(f"__of_{k}") for k in keys], *[c for c in others.columns if c not in keys])
    same = functools.reduce(operator.and_, [F.col(k).eqNullSafe(F.col(f"__of_{k}")) for k in keys])
    return rows.join(renamed, same, "left").drop(*[f"__of_{k}" for k in keys])


def _alerts(windows: DataFrame, end: Column, threshold: float, *more: str) -> DataFrame:
    """Closed windows as hot alerts."""
    averaged = windows.filter(F.col("count") > 0).select(
        (end - F.make_dt_interval(secs=F.lit(0.000001))).alias("eventTime"),
        F.lit(hot.HOT_MESSAGE).alias("message"),
        F.col("partitionId").alias("partitionid"),
        F.col("deviceId").alias("deviceid"),
        F.col("deliveryId").alias("deliveryid"),
        (F.col("total") / F.col("count")).alias("avgtemperature"),
        F.col("lastEnqueued").alias("lastenqueuedutctime"),
        F.col("lastOccurred").alias("lastoccurrenceutctime"),
        F.col("lastProcessed").alias("lastprocessedutctime"),
        *more,
    )
    return averaged.filter(F.col("avgtemperature") >= threshold)


def _state(judged: DataFrame, clocks: DataFrame, after: float, quiet: float, arrived: int) -> DataFrame:
    """Open windows, and the clocks that still say more than arrival does."""
    columns = DEVICE_WINDOW.fieldNames()
    floor = _time(arrived - round(quiet * 1e6))
    speaks = (F.col("clock") - _interval(after) > floor) | F.coalesce(F.col("alertedUntil") > floor, F.lit(False))
    kept = clocks.filter(speaks).withColumn("lastOccurred", F.col("clock"))
    empty = {f.name: F.lit(None).cast(f.dataType) for f in DEVICE_WINDOW.fields if f.name not in kept.columns}
    windows = judged.filter(~F.col("closed")).withColumn("alertedUntil", F.lit(None).cast("timestamp"))
    return windows.select(*columns).unionByName(kept.withColumns(empty).select(*columns))


def _due(end: Column, after: float, quiet: float) -> Column:
    """When arrival alone closes a window, or makes a clock say nothing, in microseconds."""
    clock = F.greatest(F.col("lastOccurred") - _interval(after), F.col("alertedUntil"))
    return F.unix_micros(F.when(F.col("windowStart").isNotNull(), end).otherwise(clock) + _interval(quiet))
