"""Progress of running streams as metric rows."""

from __future__ import annotations

import json
import logging
import time
from collections.abc import Callable, Iterable

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.streaming.listener import JStreamingQueryListener, QueryProgressEvent

from fleetpulse.schemas import PIPELINE_METRIC
from fleetpulse.streaming.sinks import BatchWriter

log = logging.getLogger(__name__)

Metric = dict[str, float]


class _ByJson(JStreamingQueryListener):
    """Takes a progress event from the JVM as its JSON, in one call instead of one for each of its fields: all events of an
    application come through one thread, and a few calls a field are a third of a second an event."""

    def onQueryProgress(self, jevent) -> None:
        try:
            event = QueryProgressEvent.fromJson(json.loads(jevent.json()))
        except (KeyError, TypeError):
            # JSON leaves out rates that are not finite, of a trigger of no time.
            event = QueryProgressEvent.fromJObject(jevent)
        self.pylistener.onQueryProgress(event)


class ProgressReporter(StreamingQueryListener):
    """Hands one metric record per trigger to `ship`, as a dict. A failing `ship` is logged and never stops a stream.
    query_name: of the queries to report on, one or several; all if not given."""

    def __init__(self, ship: Callable[[Metric], None], *, query_name: str | Iterable[str] | None = None):
        super().__init__()
        self._ship = ship
        #: Triggers begun by the writers that `paced` holds back, and those reported.
        self.begun = self.reported = 0
        self._query_names = {query_name} if isinstance(query_name, str) else None if query_name is None else set(query_name)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if self._query_names is not None and progress.name not in self._query_names:
            return
        try:
            self._ship(
                {
                    "triggerExecution": float(progress.durationMs.get("triggerExecution", 0)),
                    "getBatch": float(progress.durationMs.get("getBatch", 0)),
                    "inputRowsPerSecond": float(progress.inputRowsPerSecond),
                    "procRowsPerSecond": float(progress.processedRowsPerSecond),
                }
            )
        except Exception:
            log.exception("could not ship stream metrics")
        finally:
            self.reported += 1

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    @property
    def _jlistener(self):
        if not hasattr(self, "_jlistenerobj"):
            self._jlistenerobj = SparkContext._jvm.PythonStreamingQueryListenerWrapper(_ByJson(self))
        return self._jlistenerobj


def paced(write: BatchWriter, reporter: ProgressReporter, *, behind: int = 64, wait_seconds: float = 60.0) -> BatchWriter:
    """A writer that waits while its reporter is many triggers behind: Spark drops the events that a slow listener leaves
    in its queue, and records with them, when streams side by side have more triggers than it can take. It waits for a
    limited time, so that an event that never comes stops no stream."""

    def waiting(batch: DataFrame, batch_id: int) -> None:
        reporter.begun += 1
        until = time.monotonic() + wait_seconds
        while reporter.begun - reporter.reported > behind and time.monotonic() < until:
            time.sleep(0.02)
        write(batch, batch_id)

    return waiting


def settle(spark: SparkSession, *, timeout_ms: int = 10_000) -> None:
    """Waits until listeners have seen all progress so far."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(timeout_ms)


def metric_json(metric: Metric) -> str:
    return json.dumps(metric)


def metric_frame(spark: SparkSession, metrics: Iterable[Metric]) -> DataFrame:
    """Collected records (one per trigger) as a DataFrame."""
    names = PIPELINE_METRIC.fieldNames()
    return spark.createDataFrame([tuple(m[name] for name in names) for m in metrics], PIPELINE_METRIC)
