"""Hot path: both alert kinds on one bus, documents and notifications."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame

from fleetpulse.operators import deliveries, hot, silence


class WindowedAlerts(NamedTuple):
    """Outputs of the 180 s windows and the minute-distance silence test: all rows, and the throttled alerts."""

    hot: DataFrame
    hot_alerts: DataFrame
    silent: DataFrame
    silence_alerts: DataFrame
    hot_documents: DataFrame
    silence_documents: DataFrame


def windowed_alerts(telemetry: DataFrame) -> WindowedAlerts:
    hot_rows = hot.hot_windows_180(telemetry)
    silent_rows = silence.silence_alerts(silence.silent_minutes(telemetry), by_partition=True)
    return WindowedAlerts(
        hot_rows,
        hot.throttle_hot_alerts(hot_rows),
        silent_rows,
        hot.throttle_silence_alerts(silent_rows),
        deliveries.latest_alert_by_delivery(hot_rows.drop("eventTime")),
        deliveries.latest_alert_by_delivery(silent_rows),
    )


def bus(telemetry: DataFrame) -> DataFrame:
    """Hot alerts of 90 s windows and five-minute silence alerts, as one."""
    return hot.alert_bus(
        hot.hot_windows_90(telemetry),
        silence.silence_alerts(silence.silent_gaps(telemetry), by_partition=False),
    )


def bus_notifications(telemetry: DataFrame) -> DataFrame:
    """One notification per device, delivery, message and 150 s of the bus."""
    return hot.notifications(bus(telemetry))
