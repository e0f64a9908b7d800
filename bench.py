"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from fleetpulse.session import SETTINGS
from workload.queries import QUERIES
from workload.telemetry import telemetry

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 3

BATCH = (
    "delivery_summary",
    "enrich_telemetry",
    "state_projection",
    "hot_tumbling_180",
    "hot_tumbling_90",
    "hot_alert_isfirst_5m",
    "no_telemetry_minute_2_10",
    "no_telemetry_gap_5m",
    "alert_first_150",
    "out_of_order_filter",
    "last_known_position",
    "latest_position",
    "position_history",
    "points_in_polygon",
    "recent_in_bbox",
    "ingest_counters",
    "batch_by_count",
    "alert_payload_pack",
)
STREAMS = ("telemetry_stream", "hot_stream", "no_telemetry_stream", "latest_position_stream")


def main() -> None:
    builder = SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
    settings = {
        **SETTINGS,
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        "spark.sql.shuffle.partitions": CPUS,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    rows = telemetry(spark, SF_DIR).count()

    def timed(name: str, runs: int) -> float:
        """Best of several runs, the first of which also warms up."""
        best = float("inf")
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - start)
        return best

    seconds = {name: timed(name, RUNS) for name in BATCH}
    # The second run of a stream finds the staged messages in place.
    seconds |= {name: timed(name, 2) for name in STREAMS}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": {name: round(s, 3) for name, s in seconds.items()},
                "rows": rows,
                "rows_per_sec": {name: round(rows / s) for name, s in seconds.items()},
                "sf": os.path.basename(SF_DIR.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    sys.exit(main())
