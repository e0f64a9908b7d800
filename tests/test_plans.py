"""What the physical plans must and must not contain."""

from __future__ import annotations

import pytest
from builders import plan

from workload import telemetry as telemetry_rows
from workload.queries import BOX, QUERIES
from fleetpulse.functions import geo
from fleetpulse.operators import packing, policy, positions
from pyspark.sql import functions as F

STAGED = {
    "raw_envelope_scan", "table_preview", "cold_tables_overwrite", "sql_event_load", "pipeline_metrics",
    "alert_payload_pack", "alert_bus_sink", "document_insert_sink", "silence_document_sink", "notification_sink", "notification_post_sink", "dstream_positions", "substream_time", "row_writer_sink", "dead_letter_sink", "capture_range_scan", "stored_points_in_polygon", "cold_tables_incremental",
}
BATCH = [n for n in QUERIES if n not in STAGED and not n.endswith("_stream")]


@pytest.mark.parametrize("name", BATCH)
def test_no_python_and_no_cross_products(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert operator not in text


def test_top_k_is_not_a_global_sort(spark, sf_dir):
    assert "TakeOrderedAndProject" in plan(QUERIES["recent_in_bbox"](spark, sf_dir))


@pytest.mark.parametrize("name", ["hot_tumbling_180", "hot_tumbling_90"])
def test_windows_combine_before_their_only_shuffle(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert text.count("Exchange") == 1
    assert "partial_avg" in text
    assert "position" not in text


@pytest.mark.parametrize("name", ["no_telemetry_gap_5m", "no_telemetry_minute_2_10"])
def test_silence_never_compares_rows_with_rows(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "LeftAnti" not in text
    assert "LeftSemi" in text
    # The join key has the time in it, not the device alone.
    join = next(line for line in text.splitlines() if "LeftSemi" in line)
    assert "occurrenceUtcTime" in join or "minute" in join


@pytest.mark.parametrize("name", ["out_of_order_filter", "batch_by_count"])
def test_rows_are_dealt_by_range_and_only_once(spark, sf_dir, name):
    if name == "batch_by_count":
        text = plan(packing.batch_by_count(telemetry_rows.messages(spark, sf_dir), ranges=4))
    else:
        text = plan(policy.drop_out_of_order(telemetry_rows.telemetry(spark, sf_dir), ranges=4))
    shuffles = [line for line in text.splitlines() if "Exchange" in line]
    dealt = [line for line in shuffles if "direct_shuffle_partition_id" in line]
    assert dealt and all("__range" in line for line in dealt)
    # Windows and batches use the rows where they are: other shuffles are of written totals and of pieces at edges.
    windows = [line for line in text.splitlines() if "Window " in line and "__is_row" in line]
    assert windows and all("__range" in line for line in windows)
    assert not [line for line in shuffles if "__range" in line and "direct_shuffle_partition_id" not in line]


def test_box_filter_reaches_the_scan(spark, sf_dir, tmp_path):
    path = str(tmp_path / "history")
    located = QUERIES["position_history"](spark, sf_dir)
    located.write.parquet(path)
    text = plan(positions.in_box(spark.read.parquet(path), *BOX).select("deviceId"))
    assert "GreaterThanOrEqual(longitude" in text and "LessThanOrEqual(latitude" in text
    assert "ReadSchema: struct<deviceId:string,latitude:double,longitude:double>" in text


def test_position_is_parsed_once(spark, sf_dir):
    text = plan(QUERIES["points_in_polygon"](spark, sf_dir))
    assert text.count("regexp_extract") == 1


def test_body_is_parsed_once(spark, sf_dir):
    text = plan(QUERIES["delivery_summary"](spark, sf_dir))
    assert text.count("from_json") == 1


def test_long_rings_do_not_grow_the_generated_code(spark):
    ring = [(float(x), float(x % 7)) for x in range(500)] + [(0.0, 0.0)]
    df = spark.range(1).select(F.lit(1.0).alias("lon"), (F.col("id") + 0.5).alias("lat"))
    assert plan(df.filter(geo.in_ring(F.col("lon"), F.col("lat"), ring))).count("CASE") < 5


def test_fences_meet_positions_in_one_equal_join(spark, sf_dir):
    text = plan(QUERIES["points_in_fences"](spark, sf_dir))
    assert text.count("HashJoin") + text.count("SortMergeJoin") == 1 and "[cell" in text


def test_delivery_summary_hashes_all_rows_and_reads_them_once(spark, sf_dir):
    text = plan(QUERIES["delivery_summary"](spark, sf_dir))
    assert text.count("FileScan") == 1
    # From the scan up: all rows by hash, then only what is left of them as text.
    kinds = [line for line in reversed(text.splitlines()) if "Aggregate(" in line]
    assert ["HashAggregate" in line and "Object" not in line for line in kinds] == [True, True, False, False]
    assert "partial_max" in kinds[0] and "partial_max" in kinds[2]


@pytest.mark.parametrize("name", ["hot_tumbling_180", "out_of_order_filter", "points_in_fences", "latest_position"])
def test_one_scan(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert sum("FileScan" in line and "events.parquet" in line for line in text.splitlines()) == 1
