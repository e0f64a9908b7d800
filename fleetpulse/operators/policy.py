"""Which messages count: sensor filters, stale, late and out-of-order drops, quarantine and routing."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetpulse.functions import fields
from fleetpulse.operators.ordered import running_before

STALE_AFTER = dt.timedelta(minutes=5)
LATE_AFTER = dt.timedelta(seconds=900)
OUT_OF_ORDER_AFTER = dt.timedelta(seconds=5)


def state_rows(telemetry: DataFrame) -> DataFrame:
    return telemetry.filter(F.col("sensorType") == fields.STATE_SENSOR)


def event_rows(telemetry: DataFrame) -> DataFrame:
    return telemetry.filter(F.col("sensorType") == fields.EVENT_SENSOR)


def event_rows_any_version(telemetry: DataFrame) -> DataFrame:
    return telemetry.filter(F.col("sensorType").startswith(fields.EVENT_SENSOR_PREFIX))


def departed_or_dropped_off(enriched: DataFrame) -> DataFrame:
    return enriched.filter(F.col("flightStatus").isin("DPS", "DOP"))


def is_stale(enqueued: Column, as_of: Column, max_age: dt.timedelta) -> Column:
    """Enqueued strictly before as_of - max_age."""
    return enqueued < as_of - F.lit(max_age)


def drop_stale(
    df: DataFrame, *, as_of: Column, max_age: dt.timedelta | None = STALE_AFTER, enqueued: str = "enqueuedUtcTime"
) -> tuple[DataFrame, DataFrame]:
    """(kept, dropped). max_age None keeps everything; a message without an enqueued time is kept."""
    stale = F.lit(False) if max_age is None else F.coalesce(is_stale(F.col(enqueued), as_of, max_age), F.lit(False))
    return df.filter(~stale), df.filter(stale)


def split_untimed(telemetry: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(timed, untimed): messages with both times, and those without, which cannot be placed."""
    timed = F.col("enqueuedUtcTime").isNotNull() & F.col("occurrenceUtcTime").isNotNull()
    return telemetry.filter(timed), telemetry.filter(~timed)


def split_late(telemetry: DataFrame, *, limit: dt.timedelta = LATE_AFTER) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(kept, late, untimed): late messages arrived more than `limit` after they occurred."""
    timed, untimed = split_untimed(telemetry)
    late = F.col("enqueuedUtcTime") - F.col("occurrenceUtcTime") > F.lit(limit)
    return timed.filter(~late), timed.filter(late), untimed


def drop_late(telemetry: DataFrame, *, limit: dt.timedelta = LATE_AFTER) -> DataFrame:
    """The kept part of split_late."""
    return split_late(telemetry, limit=limit)[0]


def drop_out_of_order(
    telemetry: DataFrame,
    *,
    limit: dt.timedelta = OUT_OF_ORDER_AFTER,
    keys: Sequence[str] = ("deviceId", "partitionId"),
    ranges: int | None = None,
    clocks: DataFrame | None = None,
) -> DataFrame:
    """The kept part of split_out_of_order."""
    options = {"limit": limit, "keys": keys, "ranges": ranges, "clocks": clocks}
    return split_out_of_order(telemetry, **options)[0]


def split_out_of_order(
    telemetry: DataFrame,
    *,
    limit: dt.timedelta = OUT_OF_ORDER_AFTER,
    keys: Sequence[str] = ("deviceId", "partitionId"),
    ranges: int | None = None,
    clocks: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(kept, dropped, untimed): dropped messages occurred more than `limit` before the latest occurrence that their
    device had already sent.

    Arrival order is (enqueued time, sequence number). ranges only sets over how many tasks the messages are spread. clocks
    (keys, latest occurrence) holds what the devices had sent before these messages.
    """
    timed, untimed = split_untimed(telemetry)
    ahead = running_before(
        timed,
        name="latestBefore",
        keys=keys,
        order=["enqueuedUtcTime", "sequenceNumber"],
        value=F.col("occurrenceUtcTime"),
        combine=F.max,
        initial=clocks,
        ranges=ranges,
    )
    behind = F.coalesce(F.col("latestBefore") - F.col("occurrenceUtcTime") > F.lit(limit), F.lit(False))
    return ahead.filter(~behind).drop("latestBefore"), ahead.filter(behind).drop("latestBefore"), untimed


def with_position(telemetry: DataFrame) -> DataFrame:
    """Adds latitude, longitude and problem (NULL if the position is usable).

    Each step is a projection of its own, so nothing is parsed twice; the last hands the columns on through a generator,
    because a filter on projected columns would be pushed below with a copy of the parsing for every use of them.
    """
    latitude, longitude = F.col("latitude"), F.col("longitude")
    located = (
        telemetry.withColumn("match", fields.position_match(F.col("position")))
        .withColumns(
            {
                "latitude": fields.to_number(F.get("match", F.lit(0))),
                "longitude": fields.to_number(F.get("match", F.lit(1))),
            }
        )
        .withColumn("located", F.struct("latitude", "longitude", fields.position_problem(latitude, longitude).alias("problem")))
    )
    return located.select(*telemetry.columns, F.inline(F.array("located")))


def split_by_position(telemetry: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantined): rows with latitude and longitude, and rows with the reason they have none."""
    checked = with_position(telemetry)
    valid = checked.filter(F.col("problem").isNull()).drop("problem")
    quarantined = (
        checked.filter(F.col("problem").isNotNull())
        .drop("latitude", "longitude")
        .withColumnRenamed("problem", "reason")
    )
    return valid, quarantined


def route(df: DataFrame, routes: Mapping[str, Column]) -> DataFrame:
    """One row per message and endpoint whose predicate holds, in one pass; a message may go to several endpoints."""
    matches = F.array_compact(F.array(*[F.when(holds, F.lit(name)) for name, holds in routes.items()]))
    return df.select(F.explode(matches).alias("endpoint"), *df.columns)
