"""Ingest counters, logs and pipeline metrics."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetpulse.functions import fields
from fleetpulse.operators.policy import STALE_AFTER, is_stale, with_position


def ingest_counters(
    telemetry: DataFrame,
    *,
    as_of: Column,
    max_age: dt.timedelta | None = STALE_AFTER,
    write_ms: Column | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """received, dropped (stale), created, freshnessMs and meanWriteMs of a batch of messages.

    created counts flight messages that are not stale and have a valid position. freshnessMs is the age at as_of of the
    first message by sequence number. meanWriteMs is the time per created document, 0 if there is none.
    """
    enqueued = F.col("enqueuedUtcTime")
    stale = F.lit(False) if max_age is None else F.coalesce(is_stale(enqueued, as_of, max_age), F.lit(False))
    created = (
        ~stale
        & (F.col("sensorType") == fields.EVENT_SENSOR)
        & F.col("problem").isNull()
    )
    spent = F.lit(0.0) if write_ms is None else write_ms.cast("double")
    first_enqueued = F.min_by(F.unix_micros(enqueued), F.col("sequenceNumber"))
    return (
        with_position(telemetry)
        .groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("received"),
            F.count_if(stale).alias("dropped"),
            F.count_if(created).alias("created"),
            ((F.unix_micros(as_of) - first_enqueued) / 1000).alias("freshnessMs"),
            F.sum(F.when(created, spent)).alias("writeMs"),
        )
        .withColumn("meanWriteMs", F.when(F.col("created") > 0, F.col("writeMs") / F.col("created")).otherwise(0.0))
        .drop("writeMs")
    )


def ingest_log(telemetry: DataFrame, *, as_of: Column, max_age: dt.timedelta | None = STALE_AFTER) -> DataFrame:
    """(timestamp, message) log rows of an ingest: stale drops (none if max_age is None) and messages that could not be
    processed."""
    stale = F.lit(False) if max_age is None else is_stale(F.col("enqueuedUtcTime"), as_of, max_age)
    failed = (F.col("sensorType") == fields.EVENT_SENSOR) & F.col("problem").isNotNull()
    message = F.when(
        stale, F.concat(F.lit("Dropping late message. Sequence number = "), F.col("sequenceNumber").cast("string"))
    ).when(
        failed, F.concat(F.lit("Error processing message "), F.col("sequenceNumber").cast("string"), F.lit(": "), F.col("problem"))
    )
    return (
        with_position(telemetry)
        .select(F.col("enqueuedUtcTime").alias("timestamp"), message.alias("message"))
        .filter(F.col("message").isNotNull())
    )


def log_search(log: DataFrame, prefix: str) -> DataFrame:
    """Log rows whose message starts with the prefix, whatever its case, newest first."""
    return log.filter(F.lower("message").startswith(prefix.lower())).orderBy(F.desc("timestamp"))


def active_metrics(metrics: DataFrame, measure: str) -> DataFrame:
    """Metric rows in which a measure is above zero."""
    return metrics.filter(F.col(measure) > 0)
