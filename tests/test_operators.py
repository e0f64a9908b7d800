"""Operators against brute force in Python, on devices of very different size."""

from __future__ import annotations

import datetime as dt
import math
import random
from collections import defaultdict

import pytest
from builders import EVENT, START, STATE, at, numbers, random_rows, telemetry
from pyspark.sql import Window
from pyspark.sql import functions as F

from fleetpulse.functions import fields
from fleetpulse.operators import decode, deliveries, fences, hot, monitoring, ordered, packing, policy, positions, silence
from fleetpulse.plans import warm
from fleetpulse.schemas import ALERT, HUB_MESSAGE, POSITION

SEEDS = [1, 2, 3]


def seconds(row, name="occurrenceUtcTime"):
    return int((row[name] - START).total_seconds())


@pytest.mark.parametrize("seed", SEEDS)
@pytest.mark.parametrize("count", [30, 300])
def test_silent_gaps(spark, seed, count):
    rows = random_rows(count, seed=seed)
    states = [r for r in rows if r["sensorType"] == STATE]
    end = max(seconds(r) for r in rows)
    expected = [
        r["sequenceNumber"]
        for r in states
        if seconds(r) + 300 <= end
        and not any(
            o["deviceId"] == r["deviceId"] and seconds(r) < seconds(o) <= seconds(r) + 300 for o in states
        )
    ]
    assert numbers(silence.silent_gaps(telemetry(spark, rows))) == expected


@pytest.mark.parametrize("seed", SEEDS)
@pytest.mark.parametrize("count", [30, 120])
def test_silent_minutes(spark, seed, count):
    rows = random_rows(count, seed=seed, span_seconds=7200)
    end = max(seconds(r) for r in rows)
    expected = [
        r["sequenceNumber"]
        for r in rows
        if r["sensorType"] == STATE
        and (seconds(r) // 60 + 11) * 60 <= end
        and not any(
            o["deviceId"] == r["deviceId"]
            and o["partitionId"] == r["partitionId"]
            and 2 <= seconds(o) // 60 - seconds(r) // 60 <= 10
            for o in rows
        )
    ]
    assert numbers(silence.silent_minutes(telemetry(spark, rows))) == expected


def test_gap_of_exactly_the_limit_is_an_answer(spark):
    rows = [
        {"sequenceNumber": n, "deviceId": "d", "sensorType": STATE, "occurrenceUtcTime": START + dt.timedelta(microseconds=us)}
        for n, us in enumerate([0, 300_000_000, 600_000_001, 600_000_001, 2_000_000_000])
    ]
    # 0 is answered at 300 s sharp; 300 s is followed a microsecond too late; the tied pair is silent, each on its own.
    assert numbers(silence.silent_gaps(telemetry(spark, rows))) == [1, 2, 3]


@pytest.mark.parametrize("seed", SEEDS)
@pytest.mark.parametrize("ranges", [1, 5, 64])
def test_out_of_order(spark, seed, ranges):
    rows = random_rows(200, seed=seed)
    expected, latest = [], {}
    for r in sorted(rows, key=lambda r: (r["enqueuedUtcTime"], r["sequenceNumber"])):
        key = (r["deviceId"], r["partitionId"])
        if key not in latest or latest[key] - seconds(r) <= 5:
            expected.append(r["sequenceNumber"])
        latest[key] = max(latest.get(key, 0), seconds(r))
    kept = policy.drop_out_of_order(telemetry(spark, rows), ranges=ranges)
    assert numbers(kept) == sorted(expected)
    assert kept.columns == telemetry(spark, rows).columns


def test_running_before_treats_null_keys_as_one(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), (None, 200)], "k string, v bigint")
    got = ordered.position_in_order(df, name="n", keys=["k"], order=["v"])
    assert sorted((r.k or "", r.v, r.n) for r in got.collect()) == [("", 1, 0), ("", 2, 1), ("", 200, 2), ("a", 3, 0)]


def rows_per_task(df):
    return sorted(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())


@pytest.mark.parametrize("count", [20_000, 200_000])
def test_numbering_gives_every_task_as_many_rows(spark, count):
    # A third of the rows has one key, half of the others one second; the rest are spread evenly.
    n = F.col("id")
    df = spark.range(count).select(
        F.when(n % 3 == 0, 0).otherwise(1 + n % 50).alias("k"),
        F.when(n % 2 == 0, F.lit(START)).otherwise(F.lit(START) + F.make_dt_interval(secs=n)).alias("t"),
        n.alias("v"),
    )
    numbered = ordered.position_in_order(df, name="n", keys=["k"], order=["t", "v"], ranges=16)
    tasks = rows_per_task(numbered)
    assert sum(tasks) == count and len(tasks) == 16
    assert tasks[-1] <= 2 * tasks[8]
    expected = df.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("t", "v")).cast("bigint") - 1)
    assert numbered.select("k", "v", "n").exceptAll(expected.select("k", "v", "n")).count() == 0


def test_a_bus_of_one_key_is_numbered_by_all_tasks(spark):
    # All alerts are in partition 0 and within one minute.
    for count in (5_000, 50_000):
        df = spark.range(count).select(F.lit(0).alias("k"), (F.lit(START) + F.make_dt_interval(secs=F.col("id") % 60)).alias("t"), "id")
        tasks = rows_per_task(ordered.position_in_order(df, name="n", keys=["k"], order=["t", "id"], ranges=8))
        assert len(tasks) == 8 and tasks[-1] <= 2 * tasks[4]


def test_running_value_after_ties_strings_and_null_order(spark):
    rows = [(k, s, v) for k in ("a", None) for s, v in [(None, 1), ('q"uo\te', 2), ("é", 3), ("z", 4), ("z", 5)]]
    df = spark.createDataFrame(rows, "k string, s string, v bigint")
    for ranges in (1, 3, 10):
        got = ordered.running_before(
            df, name="m", keys=["k"], order=["s", "v"], value=F.col("v"), combine=F.max, ranges=ranges
        ).collect()
        order = sorted(rows, key=lambda r: (r[1] is not None, (r[1] or "").encode(), r[2]))
        for k in ("a", None):
            mine, most = [r for r in order if r[0] == k], None
            for _, s, v in mine:
                assert [r["m"] for r in got if (r["k"], r["s"], r["v"]) == (k, s, v)] == [most]
                most = max(most or 0, v)
    empty = ordered.position_in_order(df.limit(0), name="n", keys=["k"], order=["v"])
    assert empty.count() == 0


@pytest.mark.parametrize("size", [1, 7, 100])
def test_batches_keep_every_message_in_order(spark, size):
    rows = [
        (bytearray(f"b{n}", "ascii"), START, 0 if n % 3 else 1, n * 400_000, {"n": str(n)}) for n in range(100)
    ] + [(None, START, 0, -5, {}), (bytearray(), START, 0, -6, {})]
    batches = packing.batch_by_count(spark.createDataFrame(rows, HUB_MESSAGE), size=size).collect()
    by_partition = defaultdict(dict)
    for b in batches:
        assert len(b["items"]) == b["size"] <= size
        by_partition[b["partition"]][b["batchNo"]] = b["items"]
    for partition, packed in by_partition.items():
        assert sorted(packed) == list(range(len(packed)))
        assert all(len(packed[n]) == size for n in list(sorted(packed))[:-1])
        got = [i["sequenceNumber"] for n in sorted(packed) for i in packed[n]]
        assert got == [r[3] for r in rows[:100] if r[2] == partition]
        assert all(i["properties"] == {"n": str(i["sequenceNumber"] // 400_000)} for n in packed for i in packed[n])


def test_batch_size_must_be_positive(spark):
    with pytest.raises(ValueError):
        packing.batch_by_count(spark.createDataFrame([], HUB_MESSAGE), size=0)


def alert(n, *, device="d", partition=0, message="hotTemperature", delivery="o"):
    time = START + dt.timedelta(seconds=n)
    return (message, partition, device, delivery, 76.5, time, time, time)


def test_payloads_hold_at_most_a_hundred(spark):
    alerts = spark.createDataFrame([alert(n, partition=n % 2) for n in range(450)], ALERT)
    payloads = packing.alert_payloads(alerts)
    assert sorted(r["size"] for r in payloads.collect()) == [25, 25, 100, 100, 100, 100]
    assert packing.oversized(payloads).count() == 0
    assert packing.oversized(payloads, limit=99).count() == 4
    back, rejected = decode.decode_alert_payloads(payloads.select("payload"))
    assert (back.count(), rejected.count()) == (450, 0)
    assert back.exceptAll(alerts).count() == 0


def test_alert_payload_keys_of_any_case(spark):
    two = (
        '[{"message":"hotTelemetry","PartitionId":1,"deliveryId":"81046ea1","deviceid":"Simulated.drone-01.3",'
        '"avgtemperature":74.78,"occurenceUtcTime":"2018-03-23T23:21:00.0000000Z"},'
        '{"message":"hotTelemetry","PartitionId":1,"deliveryId":"81046ea1","deviceid":"Simulated.drone-01.3","avgtemperature":74.78}]'
    )
    one = (
        '[{"message":"hotTelemetry","partitionid":13,"deliveryid":"59b8865f","deviceid":"Simulated.drone-01.3",'
        '"avgtemperature":76.175,"LastOccurrenceUtcTime":"2018-04-04T23:33:00.0000000Z"}]'
    )
    other = '[{"partitionid":1,"device_id":"x","avgtemperature":74.78},{"partitionid":2,"device_id":"y","avgtemperature":74.309999999999988}]'
    clash = '[{"DeviceId":"first","deviceid":"last"}]'
    payloads = spark.createDataFrame([(1, two), (2, one), (3, other), (4, "[{"), (5, "no json"), (6, clash)], "id int, payload string")
    alerts, rejected = decode.decode_alert_payloads(payloads)
    rows = sorted(alerts.collect(), key=lambda r: (r.id, r.partitionid or 0))
    assert [r.id for r in rows] == [1, 1, 2, 3, 3, 6]
    assert (rows[0].partitionid, rows[0].avgtemperature, rows[0].deliveryid) == (1, 74.78, "81046ea1")
    assert (rows[2].partitionid, rows[2].avgtemperature, rows[2].lastoccurrenceutctime) == (13, 76.175, dt.datetime(2018, 4, 4, 23, 33))
    assert (rows[3].message, rows[3].deliveryid, rows[3].deviceid) == (None, None, None)
    assert rows[5].deviceid == "last"
    assert sorted(r.id for r in rejected.collect()) == [4, 5]


def test_alert_survives_the_bus(spark):
    alerts = spark.createDataFrame([alert(1)], ALERT)
    bus = decode.alert_body(alerts).withColumn("enqueuedTime", at(5))
    back = decode.alert_projection(bus, processed_at=at(6))
    assert back.select(*ALERT.fieldNames()).collect() == alerts.collect()
    assert back.columns[-2:] == ["enqueuedUtcTime", "processedutctime"]


def test_one_bad_field_does_not_lose_a_message(spark):
    bodies = [
        '{"deviceId":"a","sensorType":"drone-state-sensor;v1","temperature":"hot","occurrenceUtcTime":"soon"}',
        '{"deviceId":"b","sensorType":"drone-state-sensor;v1","temperature":75.5,"occurrenceUtcTime":"2024-01-01T00:00:00Z"}',
        "not json",
    ]
    rows = [(bytearray(b, "utf-8"), START, 0, n, {}) for n, b in enumerate(bodies)] + [(bytearray(b"\xff"), START, 0, 3, {})]
    got = decode.decode_telemetry(spark.createDataFrame(rows, HUB_MESSAGE)).orderBy("sequenceNumber").collect()
    assert [(r.deviceId, r.temperature, r.occurrenceUtcTime) for r in got] == [
        ("a", None, None),
        ("b", 75.5, START),
        (None, None, None),
        (None, None, None),
    ]


def test_temperature_flag_replaces_an_older_one(spark):
    rows = [
        (bytearray(b"{}"), START, 0, 0, {"temperatureAlert": "false", "k": "v"}),
        (bytearray(b"{}"), START, 0, 1, None),
    ]
    flagged = decode.flag_temperature(spark.createDataFrame(rows, HUB_MESSAGE), F.lit(80.0)).orderBy("sequenceNumber")
    assert [r.properties for r in flagged.collect()] == [{"k": "v", "temperatureAlert": "true"}, {"temperatureAlert": "true"}]


def test_envelope_fields(spark):
    from fleetpulse.schemas import CAPTURED_ENVELOPE

    rows = [("2024-01-01T00:00:05Z", {"p": "1"}, {"partitionId": "3", "sequenceNumber": "9"}, bytearray(b"x"))]
    got = decode.envelope_to_messages(spark.createDataFrame(rows, CAPTURED_ENVELOPE)).first()
    assert (got.enqueuedTime, got.partition, got.sequenceNumber, bytes(got.body)) == (START + dt.timedelta(seconds=5), 3, 9, b"x")


def test_hot_window_edges_and_threshold(spark):
    def state(n, second, temperature, device="d"):
        return {
            "sequenceNumber": n, "partitionId": 2, "deviceId": device, "deliveryId": "o", "sensorType": STATE,
            "occurrenceUtcTime": START + dt.timedelta(seconds=second), "enqueuedUtcTime": START, "temperature": temperature,
        }

    rows = [state(0, 0, 74.0), state(1, 89.999999, 76.0), state(2, 90, 75.0), state(3, 180, 74.99), state(4, 0, None, "e")]
    got = hot.hot_windows_90(telemetry(spark, rows)).orderBy("eventTime").collect()
    assert [(r.avgtemperature, r.partitionid) for r in got] == [(75.0, 0), (75.0, 0)]
    assert got[0].eventTime == START + dt.timedelta(seconds=90, microseconds=-1)
    assert [r.partitionid for r in hot.hot_windows_180(telemetry(spark, rows)).collect()] == [2]


def test_throttle_takes_window_ends_into_the_bucket_they_open(spark):
    ends = [180, 300, 360, 600]
    times = [START + dt.timedelta(seconds=e, microseconds=-1) for e in ends]
    alerts = spark.createDataFrame([(t, *alert(n)) for n, t in enumerate(times)], "eventTime timestamp, " + ALERT.simpleString()[7:-1].replace(":", " "))
    kept = sorted(r.eventTime for r in hot.throttle_hot_alerts(alerts).collect())
    assert kept == [times[0], times[1], times[3]]


def test_notifications_take_the_first_of_each_message(spark):
    alerts = [alert(0), alert(10), alert(149), alert(150), alert(5, message="noTelemetry"), alert(1, device="e")]
    got = hot.notifications(spark.createDataFrame(alerts, ALERT)).collect()
    assert sorted((r.deviceid, r.message, seconds(r, "lastoccurrenceutctime")) for r in got) == [
        ("d", "hotTemperature", 0), ("d", "hotTemperature", 150), ("d", "noTelemetry", 5), ("e", "hotTemperature", 1),
    ]


def test_stale_late_and_no_limit(spark):
    rows = [
        {"sequenceNumber": n, "occurrenceUtcTime": START, "enqueuedUtcTime": START + dt.timedelta(seconds=s)}
        for n, s in enumerate([0, 299, 300, 900, 901])
    ]
    df = telemetry(spark, rows)
    kept, dropped = policy.drop_stale(df, as_of=at(600))
    assert (numbers(kept), numbers(dropped)) == ([2, 3, 4], [0, 1])
    assert numbers(policy.drop_stale(df, as_of=at(600), max_age=None)[0]) == [0, 1, 2, 3, 4]
    assert numbers(policy.drop_late(df)) == [0, 1, 2, 3]


def test_every_row_has_an_output(spark):
    rows = random_rows(300, seed=21)
    for n, row in enumerate(rows):
        if n % 17 == 0:
            row["occurrenceUtcTime"] = None
        if n % 23 == 0:
            row["enqueuedUtcTime"] = None
    df = telemetry(spark, rows)
    for kept, dropped, untimed in (
        policy.split_late(df, limit=dt.timedelta(seconds=3)),
        policy.split_out_of_order(df),
    ):
        assert numbers(kept) and numbers(dropped) and len(numbers(untimed)) == 31
        assert sorted(numbers(kept) + numbers(dropped) + numbers(untimed)) == sorted(r["sequenceNumber"] for r in rows)
        assert kept.columns == dropped.columns == untimed.columns == df.columns


def test_log_without_an_age_limit(spark):
    rows = [{"sequenceNumber": 1, "occurrenceUtcTime": START, "enqueuedUtcTime": START, "sensorType": "x"}]
    df = telemetry(spark, rows)
    assert monitoring.ingest_log(df, as_of=at(10_000)).count() == 1
    assert monitoring.ingest_log(df, as_of=at(10_000), max_age=None).count() == 0


def test_latest_position_has_no_sort(spark):
    rows = [("a", START, 1.0, 2.0, 3), ("a", START, 4.0, 5.0, 7), ("b", START, 6.0, 7.0, None), ("b", START, 8.0, 9.0, 0)]
    df = spark.createDataFrame(rows, "deviceId string, eventTime timestamp, latitude double, longitude double, sequenceNumber long")
    newest = positions.latest_position(df)
    assert sorted((r.deviceId, r.latitude, r.sequenceNumber) for r in newest.collect()) == [("a", 4.0, 7), ("b", 8.0, 0)]
    assert "Sort" not in newest._jdf.queryExecution().executedPlan().toString()


def test_routes_may_overlap_or_miss(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "x int")
    routed = policy.route(df, {"all": F.lit(True), "big": F.col("x") > 2, "none": F.col("x") > 9, "unknown": F.lit(None).cast("boolean")})
    assert sorted(map(tuple, routed.collect())) == [("all", 1), ("all", 2), ("all", 3), ("big", 3)]


def test_latest_position_breaks_ties_by_sequence(spark):
    rows = [("d", START, 1.0, 2.0, 5), ("d", START, 3.0, 4.0, 6), ("d", START - dt.timedelta(days=1), 9.0, 9.0, 7), ("e", START, 0.0, 0.0, 1)]
    located = spark.createDataFrame(rows, "deviceId string, eventTime timestamp, latitude double, longitude double, sequenceNumber bigint")
    assert sorted(map(tuple, positions.latest_position(located).collect())) == [rows[1], rows[3]]
    assert numbers(positions.last_known(located)) == [1, 5, 6]


def test_envelope_of_nothing(spark):
    located = spark.createDataFrame([], "longitude double, latitude double")
    assert tuple(positions.envelope(located).first()) == (180.0, 90.0, -180.0, -90.0)


def test_newest_in_box_keeps_the_newest(spark):
    rows = [("d", START + dt.timedelta(seconds=n), 1.0, 1.0, n) for n in range(20)]
    located = spark.createDataFrame(rows, "deviceId string, eventTime timestamp, latitude double, longitude double, sequenceNumber bigint")
    assert numbers(positions.newest_in_box(located, 0, 0, 1, 1, limit=3)) == [17, 18, 19]
    assert numbers(positions.newest_in_box(located, 2, 2, 3, 3)) == []


def test_delivery_summary_takes_the_latest_of_each(spark):
    rows = [("o1", "DPS", "2024-01-01T00:00:01Z"), ("o1", "DPS", "2024-01-01T00:00:09Z"), ("o1", "DOP", "2024-01-01T00:01:00Z"),
            ("o2", "INF", "2024-01-01T00:00:00Z"), ("o3", "DOP", "2024-01-01T00:00:00Z")]
    enriched = spark.createDataFrame(rows, "deliveryId string, flightStatus string, occurrenceUtcTime string")
    assert sorted(map(tuple, deliveries.delivery_summary(enriched).collect())) == [
        ("o1", "2024-01-01T00:00:09Z", "2024-01-01T00:01:00Z"), ("o3", None, "2024-01-01T00:00:00Z"),
    ]


def test_counters_of_nothing_created(spark):
    df = telemetry(spark, [{"sequenceNumber": 3, "sensorType": STATE, "enqueuedUtcTime": START}])
    got = monitoring.ingest_counters(df, as_of=at(1)).first()
    assert tuple(got) == (1, 0, 0, 1000.0, 0.0)


def test_counters_by_partition(spark):
    rows = random_rows(100, seed=5)
    got = monitoring.ingest_counters(telemetry(spark, rows), as_of=at(1800), by=["partitionId"]).collect()
    assert sum(r.received for r in got) == 100
    assert sum(r.dropped for r in got) == sum(r["enqueuedUtcTime"] < START + dt.timedelta(seconds=1500) for r in rows)


def test_warm_ingest_loses_nothing(spark):
    rows = random_rows(200, seed=6)
    for r in rows[::7]:
        r["position"] = "a|b|c"
    out = warm.ingest(telemetry(spark, rows), as_of=at(1800))
    flights = sum(r["sensorType"] == EVENT for r in rows)
    stale_flights = out.stale.filter(F.col("sensorType") == EVENT).count()
    assert out.positions.count() + out.quarantined.count() + stale_flights == flights
    counters = out.counters.first()
    assert (counters.created, counters.dropped) == (out.positions.count(), out.stale.count())
    assert out.log.count() == out.stale.count() + out.quarantined.count()


def test_log_search_ignores_case_and_sorts(spark):
    rows = [(START, "Starting upserts with 1"), (START + dt.timedelta(seconds=1), "Starting Upserts with 2"), (START, "x Starting Upserts with ")]
    log = spark.createDataFrame(rows, "timestamp timestamp, message string")
    assert [r.message[-1] for r in monitoring.log_search(log, "Starting Upserts with ").collect()] == ["2", "1"]


def random_ring(rnd, corners):
    """A star-shaped area with straight edges, some along the grid."""
    angles = sorted(rnd.uniform(0, 2 * math.pi) for _ in range(corners))
    ring = [(-122 + rnd.uniform(0.2, 1.5) * math.cos(a), 48 + rnd.uniform(0.2, 1.5) * math.sin(a)) for a in angles]
    ring = [(round(x, 1), round(y, 1)) if rnd.random() < 0.3 else (x, y) for x, y in ring]
    return [*ring, ring[0]]


@pytest.mark.parametrize("size", [0.05, 0.3, 2.0])
def test_fences_equal_the_plain_test(spark, size):
    rnd = random.Random(7)
    points = [(f"d{n}", START, rnd.uniform(46, 50), rnd.uniform(-124, -120), n) for n in range(1500)]
    # On the lines and corners of the grid too.
    points += [("g", START, 46 + 0.05 * (n % 70), -124 + 0.1 * (n // 70), 2000 + n) for n in range(1500)]
    located = spark.createDataFrame(points, POSITION)
    rings = {f"f{n}": random_ring(rnd, 3 + n) for n in range(6)}
    got = {(r.fence, r.sequenceNumber) for r in fences.within_fences(located, rings, size=size).collect()}
    expected = {(name, r.sequenceNumber) for name, ring in rings.items() for r in positions.in_polygon(located, ring).collect()}
    assert got == expected and len(got) > 500


def test_fences_with_too_many_cells_are_refused():
    ring = [(-180.0, -90.0), (180.0, -90.0), (180.0, 90.0), (-180.0, 90.0), (-180.0, -90.0)]
    with pytest.raises(ValueError):
        fences.cover(ring, 0.1)
    inside = [edges for edges in fences.cover(ring, 10).values() if edges is None]
    assert len(inside) == 34 * 16


def test_a_fence_reads_only_its_folders(spark, tmp_path):
    rows = [(f"d{n}", START, 40 + (n % 20) + 0.5, -130 + (n // 20) + 0.25, n) for n in range(400)]
    located = spark.createDataFrame(rows, POSITION)
    fences.write_by_cell(located, str(tmp_path))
    ring = [(-125.9, 45.1), (-123.1, 45.1), (-123.1, 46.9), (-125.9, 45.1)]
    found = fences.read_fence(spark, str(tmp_path), POSITION, ring)
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [area" in text
    opened = {r[0].rsplit("/", 2)[1] for r in found.select(F.input_file_name()).collect()}
    assert len(fences.cover(ring, 1.0)) <= 10 and opened <= {f"area={c}_{r}" for c, r in fences.cover(ring, 1.0)}
    assert sorted(found.collect()) == sorted(positions.in_polygon(located, ring).collect())
