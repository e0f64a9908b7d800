from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fleetpulse.functions import fields, geo
from fleetpulse.operators import policy
from fleetpulse.schemas import TELEMETRY


def one(spark, column, **values):
    names = list(values)
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{n} string" for n in names))
    return df.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("+47.757084|-121.989734|93.98", (47.757084, -121.989734, None)),
        ("+95|-121.989734|93.98", (None, None, "invalid_range")),
        ("+47.757084|-190|93.98", (None, None, "invalid_range")),
        ("47.757084||-121.989734", (None, None, "invalid_position")),
        ("a|b|c", (None, None, "invalid_position")),
        ("90|180|0", (90.0, 180.0, None)),
        ("-90|-180|0", (-90.0, -180.0, None)),
        ("at 1.5|2.5|3 m", (1.5, 2.5, None)),
        ("1|2", (None, None, "invalid_position")),
        ("", (None, None, "invalid_position")),
        (None, (None, None, "invalid_position")),
    ],
)
def test_position(spark, text, expected):
    row = [None] * len(TELEMETRY)
    row[TELEMETRY.fieldNames().index("position")] = text
    df = policy.with_position(spark.createDataFrame([tuple(row)], TELEMETRY))
    got = df.first()
    ours = (got["latitude"], got["longitude"], got["problem"])
    if expected[2] is not None:
        assert got["problem"] == expected[2]
        valid, quarantined = policy.split_by_position(df.select(*TELEMETRY.fieldNames()))
        assert (valid.count(), quarantined.count()) == (0, 1)
    else:
        assert ours == expected


def test_unchecked_split_gives_null_for_missing_parts(spark):
    parts = [one(spark, fields.position_part(F.col("p"), i), p="1.0|2") for i in range(3)]
    assert parts == ["1.0", "2", None]


@pytest.mark.parametrize(
    ("code", "status"),
    [("0", "DPS"), ("1", "INF"), ("2", "PUP"), ("3", "DOP"), ("4", "ARS"), ("5", None), ("-1", None), ("x", None), (None, None)],
)
def test_flight_status(spark, code, status):
    assert one(spark, fields.flight_status(F.col("c")), c=code) == status


@pytest.mark.parametrize("text", ["no time", "", "2024-13-01T00:00:00Z", None])
def test_malformed_times_are_null(spark, text):
    assert one(spark, fields.to_time(F.col("t")).isNull(), t=text)


def test_seven_digit_fraction_is_a_time(spark):
    got = one(spark, fields.time_text(fields.to_time(F.col("t"))), t="2018-03-23T23:21:00.0000000Z")
    assert got == "2018-03-23 23:21:00.000000"


def test_numbers_use_a_point(spark):
    assert one(spark, fields.to_number(F.col("n")), n="20.50") == 20.5
    assert one(spark, fields.to_number(F.col("n")), n="20,50") is None


def test_minutes_count_boundaries(spark):
    times = "2024-01-01 00:00:59", "2024-01-01 00:01:01"
    got = one(spark, fields.minute_of(F.col("b").cast("timestamp")) - fields.minute_of(F.col("a").cast("timestamp")), a=times[0], b=times[1])
    assert got == 1


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(-(2**60), 2**60), min_size=1, max_size=50), st.sampled_from([7, 60, 1_000_000, 1 << 20]))
def test_whole_units_round_down_exactly(spark, values, unit):
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    got = [r[0] for r in df.select(fields.whole(F.col("v"), unit)).collect()]
    assert got == [v // unit for v in values]


def test_temperature_alert_is_strict(spark):
    assert one(spark, fields.temperature_alert(F.col("t").cast("double")), t="75") == "false"
    assert one(spark, fields.temperature_alert(F.col("t").cast("double")), t="75.01") == "true"


def test_points(spark):
    got = one(spark, fields.wkt_point(F.col("lon"), F.col("lat")), lon="-121.98", lat="+47.7")
    assert got == "POINT (-121.98 +47.7)"
    got = one(spark, fields.geojson_point(F.lit(-1.5), F.lit(2.5)), x="")
    assert (got["type"], got["coordinates"]) == ("Point", [-1.5, 2.5])


def inside(ring, x, y):
    odd = False
    for (xa, ya), (xb, yb) in zip(ring, ring[1:]):
        if (ya > y) != (yb > y) and x < (xb - xa) * (y - ya) / (yb - ya) + xa:
            odd = not odd
    return odd


@pytest.mark.parametrize("corners", [3, 5, 40, 100])
def test_polygon_equals_ray_casting(spark, corners):
    import math
    import random

    rnd = random.Random(corners)
    angles = sorted(rnd.uniform(0, 2 * math.pi) for _ in range(corners))
    ring = [(rnd.uniform(1, 5) * math.cos(a), rnd.uniform(1, 5) * math.sin(a)) for a in angles]
    ring.append(ring[0])
    points = [(rnd.uniform(-5, 5), rnd.uniform(-5, 5)) for _ in range(500)]
    df = spark.createDataFrame(points, "lon double, lat double")
    got = {(r.lon, r.lat) for r in df.filter(geo.in_ring(F.col("lon"), F.col("lat"), ring)).collect()}
    assert got == {p for p in points if inside(ring, *p)}


def test_ring_from_wkt():
    assert geo.ring_from_wkt("POLYGON((0 0, 1 0,1 1,0 0))") == [(0, 0), (1, 0), (1, 1), (0, 0)]
    assert geo.ring_from_wkt("polygon ((0 0, 1 0, 1 1))")[-1] == (0, 0)
    with pytest.raises(ValueError):
        geo.ring_from_wkt("POINT (1 2)")


def test_time_text_is_ordered(spark):
    at = dt.datetime(2024, 1, 1, 0, 0, 0, 100000)
    got = spark.createDataFrame([(at,)], "t timestamp").select(fields.time_text(F.col("t"))).first()[0]
    assert got == "2024-01-01 00:00:00.100000"


def test_whole_numbers_cut_their_fraction(spark):
    texts = ["3", "3.0", "3.9", "-1.5", "x", "", None, "1e10"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(fields.to_whole(F.col("t"))).collect()] == [3, 3, 3, -1, None, None, None, None]
    assert [r[0] for r in df.select(fields.flight_status(F.col("t"))).collect()][:3] == ["DOP"] * 3
