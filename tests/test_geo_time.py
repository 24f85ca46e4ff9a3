import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from cairn.functions.geo import line_centroid, line_wkt, polyline, trailhead
from cairn.functions.times import as_date, day_or_yesterday, epoch_timestamp

LINE = "array<struct<lon:double,lat:double>>"


def lines(spark, points):
    return spark.createDataFrame([(i, p) for i, p in enumerate(points)], f"i int, line {LINE}")


@pytest.mark.parametrize("points, lat, lon", [
    ([(0.0, 0.0), (2.0, 0.0)], 0.0, 1.0),
    ([(0.0, 0.0), (3.0, 0.0), (3.0, 1.0)], 0.125, 1.875),
    ([(5.0, 5.0), (5.0, 5.0)], 5.0, 5.0),
    ([(7.0, 8.0)], 8.0, 7.0),
])
def test_centroid(spark, points, lat, lon):
    c = lines(spark, [points]).select(line_centroid("line").alias("c")).first().c
    assert (c.lat, c.lon) == (lat, lon)


def test_centroid_of_nothing(spark):
    got = lines(spark, [[], None]).select(line_centroid("line").alias("c")).collect()
    assert [r.c for r in got] == [None, None]


def test_centroid_is_bit_equal_to_a_left_to_right_sum(spark):
    rng = random.Random(3)
    shapes = [[(rng.uniform(-180, 180), rng.uniform(-90, 90)) for _ in range(rng.randint(2, 60))]
              for _ in range(200)]
    got = lines(spark, shapes).select("i", line_centroid("line").alias("c")).collect()
    for r in got:
        length = x = y = 0.0
        for (ax, ay), (bx, by) in zip(shapes[r.i], shapes[r.i][1:]):
            dx, dy = bx - ax, by - ay
            d = math.sqrt(dx * dx + dy * dy)
            length += d
            x += d * ((ax + bx) / 2)
            y += d * ((ay + by) / 2)
        assert (r.c.lat, r.c.lon) == (y / length, x / length)


@pytest.mark.parametrize("points, precision, text", [
    ([(0.0, 0.0), (2.0, 0.0)], 6, "LINESTRING (0 0, 2 0)"),
    ([(0.0, 0.0), (3.0, 0.0), (3.0, 1.0)], 6, "LINESTRING (0 0, 3 0, 3 1)"),
    ([(5.0, 5.0), (5.0, 5.0)], 6, "LINESTRING (5 5, 5 5)"),
    ([(-115.12345678, 51.5), (-115.0, 51.0)], 6, "LINESTRING (-115.123457 51.5, -115 51)"),
    ([(-115.12, 100.0), (1234567.5, 10.0)], 1, "LINESTRING (-115.1 100, 1234567.5 10)"),
    ([(110.4, 100.0), (20.6, 10.0)], 0, "LINESTRING (110 100, 21 10)"),
])
def test_wkt(spark, points, precision, text):
    got = lines(spark, [points]).select(line_wkt("line", precision).alias("w")).first().w
    assert got == text


def test_wkt_rounds_seven_decimals_like_printf(spark):
    rng = random.Random(9)
    points = [(round(rng.uniform(-180, 180), 7), round(rng.uniform(-90, 90), 7)) for _ in range(5000)]
    got = lines(spark, [points]).select(line_wkt("line").alias("w")).first().w
    short = lambda v: f"{v:.6f}".rstrip("0").rstrip(".")
    assert got == "LINESTRING (" + ", ".join(f"{short(x)} {short(y)}" for x, y in points) + ")"


def test_polyline_and_trailhead(spark):
    rows = spark.createDataFrame([([(51.0, -115.0), (52.0, -116.0)],)],
                                 "geometry array<struct<lat:double,lon:double>>")
    r = rows.select(polyline("geometry").alias("l")).select("l", trailhead("l").alias("h")).first()
    assert [tuple(p) for p in r.l] == [(-115.0, 51.0), (-116.0, 52.0)]
    assert tuple(r.h) == (-115.0, 51.0)


def test_epoch(spark):
    rows = spark.createDataFrame([("1700000000",), ("1.5",), ("soon",), (None,)], "s string")
    got = [r[0] for r in rows.select(F.date_format(epoch_timestamp(F.col("s")), "yyyy-MM-dd HH:mm:ss.S")).collect()]
    assert got == ["2023-11-14 22:13:20.0", "1970-01-01 00:00:01.5", None, None]


def test_as_date(spark):
    rows = spark.createDataFrame([("2024-02-30",), ("2024-02-29",), ("2024-02-29 10:00:00",), ("not a date",), (None,)], "s string")
    got = [r[0] for r in rows.select(as_date(F.col("s"))).collect()]
    assert got == [None, dt.date(2024, 2, 29), dt.date(2024, 2, 29), None, None]


def test_day_or_yesterday(spark):
    row = spark.range(1).select(
        day_or_yesterday("2024-05-06").alias("a"),
        (day_or_yesterday(None) == F.date_sub(F.current_date(), 1)).alias("b"),
    ).first()
    assert row.a == dt.date(2024, 5, 6) and row.b


def test_epochs_beyond_the_bounds_are_null(spark):
    rows = spark.createDataFrame(
        [("1e300",), ("-1e300",), ("99999999999999",), ("-99999999999999",), ("NaN",), ("9223372036",)], "s string")
    got = [r[0] for r in rows.select(epoch_timestamp(F.col("s")).isNull()).collect()]
    assert got == [True] * 5 + [False]
