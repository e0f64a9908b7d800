"""Devices that went silent.

In a batch no row is joined with another row. The rows are first reduced, before any shuffle, to one summary row per
device and time bin; silence is read off neighbouring summary rows; the few silent (device, time) pairs then select
their rows in a semi join whose key includes the time. So a device that sends a third of all rows costs no more per task
than any other, and the work stays linear in the rows.

A silence is only reported once its whole horizon lies before the latest event seen, because the end of the data is not
the silence of a device.

Streams keep messages in state until their horizon has passed and outer-join them with a summary of what was heard
later; see the functions ending in _stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetpulse.functions import fields
from fleetpulse.operators.policy import state_rows

SILENCE_MESSAGE = "noTelemetry"
_FIRST_MINUTE, _LAST_MINUTE = 2, 10
GAP_SECONDS = 300
_STREAM_BIN_SECONDS = 60


def silent_minutes(telemetry: DataFrame, *, horizon: Column | None = None) -> DataFrame:
    """State messages after which their device and partition sent nothing at minute distance 2 to 10.

    The distance counts minute boundaries crossed. Messages of any sensor break the silence. horizon is the latest event
    time seen, taken from the data unless given.
    """
    marked = telemetry.withColumn("minute", fields.minute_of(F.col("occurrenceUtcTime")))
    summary = marked.groupBy("deviceId", "partitionId", "minute").agg(
        F.bool_or(F.col("sensorType") == fields.STATE_SENSOR).alias("hasState")
    )
    later = W.partitionBy("deviceId", "partitionId").orderBy("minute").rangeBetween(_FIRST_MINUTE, _LAST_MINUTE)
    end = _latest(telemetry) if horizon is None else horizon
    silent = (
        summary.withColumn("heard", F.count(F.lit(1)).over(later))
        .filter(F.col("hasState") & (F.col("heard") == 0))
        .filter((F.col("minute") + _LAST_MINUTE + 1) * 60 * fields.MICROS <= F.unix_micros(end))
        .select("deviceId", "partitionId", "minute")
    )
    return state_rows(marked).join(silent, ["deviceId", "partitionId", "minute"], "left_semi").drop("minute")


def silent_gaps(telemetry: DataFrame, *, gap_seconds: int = GAP_SECONDS, horizon: Column | None = None) -> DataFrame:
    """State messages not followed by another state message of their device within the gap.

    A message with the same time does not follow. With bins as wide as the gap only the last time of a bin can be silent,
    and the next message of the device is the first of its next bin.
    """
    states = state_rows(telemetry)
    bins = states.groupBy("deviceId", fields.bin_of(F.col("occurrenceUtcTime"), gap_seconds).alias("bin")).agg(
        F.min("occurrenceUtcTime").alias("firstSeen"), F.max("occurrenceUtcTime").alias("lastSeen")
    )
    following = F.lead("firstSeen").over(W.partitionBy("deviceId").orderBy("bin"))
    deadline = F.col("lastSeen") + F.make_dt_interval(secs=F.lit(gap_seconds))
    end = _latest(telemetry) if horizon is None else horizon
    silent = (
        bins.withColumn("following", following)
        .filter(F.col("following").isNull() | (F.col("following") > deadline))
        .filter(deadline <= end)
        .select("deviceId", F.col("lastSeen").alias("occurrenceUtcTime"))
    )
    return states.join(silent, ["deviceId", "occurrenceUtcTime"], "left_semi")


def _latest(telemetry: DataFrame) -> Column:
    return telemetry.agg(F.max("occurrenceUtcTime")).scalar()


def silence_alerts(silent: DataFrame, *, by_partition: bool) -> DataFrame:
    """Silent messages as alerts: their own temperature and times."""
    return silent.select(
        F.lit(SILENCE_MESSAGE).alias("message"),
        (F.col("partitionId") if by_partition else F.lit(0)).alias("partitionid"),
        F.col("deviceId").alias("deviceid"),
        F.col("deliveryId").alias("deliveryid"),
        F.col("temperature").alias("avgtemperature"),
        F.col("enqueuedUtcTime").alias("lastenqueuedutctime"),
        F.col("occurrenceUtcTime").alias("lastoccurrenceutctime"),
        F.col("processedUtcTime").alias("lastprocessedutctime"),
    )


def silent_gaps_stream(
    telemetry: DataFrame,
    *,
    gap_seconds: int = GAP_SECONDS,
    lateness: str = "10 seconds",
    later_lateness: str = "20 seconds",
) -> DataFrame:
    """silent_gaps on a stream; a message is reported when the watermark has passed its deadline by a bin."""
    states = state_rows(telemetry)
    # With bins no wider than the gap, a message after the deadline is never in the message's own bin.
    width = min(gap_seconds, _STREAM_BIN_SECONDS)
    bins = -(-gap_seconds // width)
    # The first message of a later bin answers if it is in time, the last of the message's own bin if it is later.
    answers = F.expr(
        "lastHeard > occurrenceUtcTime AND "
        f"firstHeard <= occurrenceUtcTime + interval {gap_seconds} seconds"
    )
    return _unanswered(states, states, ["deviceId"], range(bins + 1), width, answers, lateness, later_lateness)


def silent_minutes_stream(
    telemetry: DataFrame, *, lateness: str = "10 seconds", later_lateness: str = "20 seconds"
) -> DataFrame:
    """silent_minutes on a stream; a message is reported when the watermark has passed its tenth minute."""
    minutes = range(_FIRST_MINUTE, _LAST_MINUTE + 1)
    keys = ["deviceId", "partitionId"]
    return _unanswered(state_rows(telemetry), telemetry, keys, minutes, 60, F.lit(True), lateness, later_lateness)


def _unanswered(
    messages: DataFrame,
    later: DataFrame,
    keys: list[str],
    bins: range,
    width: int,
    answers: Column,
    lateness: str,
    later_lateness: str,
) -> DataFrame:
    """Messages that nothing in the given bins after them answers, as an outer join of two streams.

    The later messages are first reduced to one row per key and bin of `width` seconds, each then offered to every earlier bin
    it may answer. So a message meets at most one row per bin, however busy its device is, and the bin in the join key
    spreads a busy device over the state partitions.
    """
    left = messages.withWatermark("occurrenceUtcTime", lateness).withColumn(
        "bin", fields.bin_of(F.col("occurrenceUtcTime"), width)
    )
    heard = (
        later.withWatermark("occurrenceUtcTime", later_lateness)
        .groupBy(F.window("occurrenceUtcTime", f"{width} seconds"), *keys)
        .agg(F.min("occurrenceUtcTime").alias("firstHeard"), F.max("occurrenceUtcTime").alias("lastHeard"))
        .select(
            *[F.col(key).alias(f"heard_{key}") for key in keys],
            F.window_time("window").alias("heardUntil"),
            "firstHeard",
            "lastHeard",
        )
    )
    own_bin = fields.bin_of(F.col("heardUntil"), width)
    right = heard.withColumn("answeredBin", F.explode(F.array(*[own_bin - n for n in bins])))
    same = F.col("bin") == F.col("answeredBin")
    for key in keys:
        same = same & (F.col(key) == F.col(f"heard_{key}"))
    # Implied by the bins; tells the join how long to keep its rows.
    in_time = F.expr(
        "heardUntil >= occurrenceUtcTime AND "
        f"heardUntil <= occurrenceUtcTime + interval {(bins[-1] + 1) * width} seconds"
    )
    joined = left.join(right, same & in_time & answers, "left_outer")
    return joined.filter(F.col("heardUntil").isNull()).select(*messages.columns)
