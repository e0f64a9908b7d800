"""Warm path: what one batch of messages leaves behind."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetpulse.operators.monitoring import ingest_counters, ingest_log
from fleetpulse.operators.policy import STALE_AFTER, drop_stale
from fleetpulse.operators.positions import positions
from fleetpulse.streaming.sinks import BatchWriter


class WarmIngest(NamedTuple):
    """positions, quarantined and stale are disjoint; flight messages end up in exactly one of them."""

    positions: DataFrame
    quarantined: DataFrame
    stale: DataFrame
    counters: DataFrame
    log: DataFrame


def ingest(telemetry: DataFrame, *, as_of: Column, max_age: dt.timedelta = STALE_AFTER) -> WarmIngest:
    """Positions of the messages that are fresh and well-formed, and everything that is not. A bad message never stops
    the others."""
    fresh, stale = drop_stale(telemetry, as_of=as_of, max_age=max_age)
    located, quarantined = positions(fresh)
    return WarmIngest(
        located,
        quarantined,
        stale,
        ingest_counters(telemetry, as_of=as_of, max_age=max_age),
        ingest_log(telemetry, as_of=as_of, max_age=max_age),
    )


def ingest_writer(
    write_positions: BatchWriter,
    write_quarantined: BatchWriter,
    write_counters: BatchWriter,
    *,
    max_age: dt.timedelta = STALE_AFTER,
    now: Callable[[], dt.datetime] = lambda: dt.datetime.now(dt.timezone.utc),
) -> BatchWriter:
    """ingest for the telemetry of a stream: each micro-batch is read once and leaves one row of counters, with the time
    its positions took to write."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            out = ingest(batch, as_of=F.lit(now()), max_age=max_age)
            started = time.monotonic()
            write_positions(out.positions, batch_id)
            spent = F.lit((time.monotonic() - started) * 1000)
            write_quarantined(out.quarantined, batch_id)
            mean = F.when(F.col("created") > 0, spent / F.col("created")).otherwise(0.0)
            write_counters(out.counters.withColumn("meanWriteMs", mean), batch_id)
        finally:
            batch.unpersist()

    return write
