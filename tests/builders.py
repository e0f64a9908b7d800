"""Small telemetry frames for tests."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.schemas import TELEMETRY

START = dt.datetime(2024, 1, 1)
STATE, EVENT = "drone-state-sensor;v1", "drone-event-sensor;v1"


def telemetry(spark: SparkSession, rows: list[dict]) -> DataFrame:
    names = TELEMETRY.fieldNames()
    return spark.createDataFrame([tuple(row.get(n) for n in names) for row in rows], TELEMETRY)


def random_rows(count: int, *, seed: int, devices: int = 4, span_seconds: int = 3600, hot_share: float = 0.5) -> list[dict]:
    """Rows of a few devices, one of which sends hot_share of all, with ties and late arrivals."""
    rnd = random.Random(seed)
    rows = []
    for number in range(count):
        device = 0 if rnd.random() < hot_share else rnd.randrange(1, devices)
        occurred = START + dt.timedelta(seconds=rnd.randrange(span_seconds))
        delay = rnd.choice([0, 0, 1, 2, 7, 60])
        rows.append(
            {
                "sequenceNumber": number,
                "partitionId": device % 2,
                "deviceId": f"d{device}",
                "deliveryId": f"o{device}-{rnd.randrange(2)}",
                "sensorType": rnd.choice([STATE, STATE, EVENT]),
                "occurrenceUtcTime": occurred,
                "enqueuedUtcTime": occurred + dt.timedelta(seconds=delay),
                "processedUtcTime": START + dt.timedelta(hours=2),
                "temperature": round(rnd.uniform(60, 90), 2),
                "position": f"{rnd.uniform(47, 49):.6f}|{rnd.uniform(-123, -121):.6f}|10",
                "flightStatus": str(rnd.randrange(6)),
            }
        )
    return rows


def numbers(df: DataFrame) -> list[int]:
    return sorted(r[0] for r in df.select("sequenceNumber").collect())


def at(seconds: float):
    return F.lit(START + dt.timedelta(seconds=seconds))


def plan(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
