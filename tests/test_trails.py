import datetime as dt
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from cairn import build_trails, trail_metrics
from cairn.operators.enrich import batched_lookup
from cairn.operators.ordering import (
    all_segments,
    longest_segment,
    processing_order,
    request_batches,
    with_index,
)
from cairn.operators.selection import in_area
from cairn.plans.trails import trail_segments
from cairn.schemas import ELEMENT, WEATHER_DAILY, WEATHER_RECORD
from cairn.sources.landed import read_weather
from cairn.vocab import WEATHER_VARIABLES

ELEMENTS = "ord long, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ELEMENT.fields)
DAY = dt.date(2024, 5, 6)


def way(ord_, name, points, foot="yes", **tags):
    tags = {"name": name, "foot": foot, "highway": "path", **tags}
    return (ord_, "way", ord_, None, None, tags, [(float(a), float(b)) for a, b in points])


def elements(spark, rows):
    return spark.createDataFrame(rows, ELEMENTS)


def line(n, at=0):
    return [(i + at, at) for i in range(n)]


def daily(lat, lon, day=DAY, **values):
    arrays = {v: [] for v in WEATHER_VARIABLES} | {k: [x] for k, x in values.items()}
    return (lat, lon, {"time": [day] if day else [], **arrays})


def build(rows, **options):
    return build_trails(rows, area=None, weather_date=DAY, **options)


def names(trails):
    return sorted(r.name for r in trails.collect())


def test_selection_and_longest_segment(spark):
    rows = elements(spark, [
        way(0, "A", line(2, 1)),
        way(1, "A", line(3, 2), surface="gravel"),
        way(2, "A", line(3, 3)),
        way(3, "a", line(2, 4)),
        way(4, "", line(2, 5)),
        way(5, "B", line(2, 6), foot="designated"),
        (6, "node", 6, 1.0, 1.0, {"name": "C", "foot": "yes", "natural": "peak"}, None),
        way(7, "D", line(2, 7)),
        way(8, "H", line(1, 8)),
        (9, "way", 9, None, None, None, [(1.0, 1.0), (2.0, 2.0)]),
        way(10, "I", []),
        (11, "way", 11, None, None, {"name": "J", "foot": "yes"}, None),
        way(12, "J", line(2, 9)),
    ])
    got = {r.name: r for r in build(rows, include_weather=False).collect()}
    assert sorted(got) == ["A", "D", "J", "a"]
    assert [tuple(p) for p in got["A"].geometry] == [(2.0, 2.0), (2.0, 3.0), (2.0, 4.0)]
    assert got["A"].surface == "gravel" and got["D"].surface is None
    assert not {"weather_date", "rain_sum"} & set(build(rows, include_weather=False).columns)
    metrics = trail_metrics(rows, area=None, batch_size=3).first()
    assert metrics.asDict() == {
        "segments": 9, "unique_names": 6, "too_short": 3, "coordinates": 4, "batches": 2,
    }
    assert trail_metrics(rows, area=None, deduplicate=False).first().coordinates == 6
    assert trail_metrics(rows.limit(0), area=None).first().asDict() == {
        "segments": 0, "unique_names": 0, "too_short": 0, "coordinates": 0, "batches": 0,
    }


def test_last_name_wins_a_centroid(spark):
    rows = elements(spark, [way(0, "F", line(2)), way(1, "G", line(2))])
    assert names(build(rows)) == ["G"]


def test_groups_run_before_payload_order(spark):
    rows = elements(spark, [way(0, "F", line(2, 5)), way(1, "G", line(2)), way(2, "F", line(2))])
    assert names(build(rows, deduplicate=False)) == ["F", "G"]
    got = {r.name: r.geometry[0].lat for r in build(rows, deduplicate=False).collect()}
    assert got == {"F": 5.0, "G": 0.0}


def test_negative_zero_is_the_same_coordinate(spark):
    rows = elements(spark, [way(0, "F", [(0, -1), (0, 1)]), way(1, "G", [(-0.0, -1), (-0.0, 1)])])
    assert names(build(rows)) == ["G"]


def simulate(rows, deduplicate):
    """The same in plain Python: groups in order of appearance, a dict keyed by centroid."""
    groups = {}
    for r in sorted(rows, key=lambda r: r[0]):
        groups.setdefault(r[5]["name"], []).append(r)
    at = {}
    for group in groups.values():
        for r in [max(group, key=lambda r: len(r[6]))] if deduplicate else group:
            xs = [p[0] for p in r[6]]
            at[((xs[0] + xs[-1]) / 2, r[6][0][1])] = (r[5]["name"], r[0])
    return sorted(at.values())


@pytest.mark.parametrize("deduplicate", [True, False])
@pytest.mark.parametrize("hot", [0.0, 0.4])
def test_order_rules_against_a_dict(spark, deduplicate, hot):
    rng = random.Random(int(hot * 10) + deduplicate)
    rows = []
    for i in range(600):
        name = "hot" if rng.random() < hot else f"n{rng.randint(0, 80)}"
        rows.append(way(i, name, line(rng.randint(2, 6), rng.randint(0, 25)), surface=str(i)))
    rng.shuffle(rows)
    expected = simulate(rows, deduplicate)
    for parts in (1, 7):
        got = build(elements(spark, rows).repartition(parts), deduplicate=deduplicate).collect()
        assert sorted((r.name, int(r.surface)) for r in got) == expected


def test_area(spark):
    inside = (51.0, -116.0)
    rows = elements(spark, [
        way(0, "in", [(0, 0), inside]),
        way(1, "out", [(0, 0), (51.0, 116.0)]),
        way(2, "steps", [inside, inside], highway="steps"),
        way(3, "footway", [inside, inside], highway="footway"),
        way(4, "bridle", [inside, inside], highway="bridlepath"),
        (5, "node", 5, *inside, {"natural": "peak", "name": "top"}, None),
        (6, "node", 6, *inside, {"natural": "tree", "name": "oak"}, None),
        (7, "node", 7, 1.0, 1.0, {"natural": "peak", "name": "far"}, None),
    ])
    got = sorted(r.tags["name"] for r in in_area(rows).collect())
    assert got == ["bridle", "footway", "in", "top"]
    trails = build_trails(rows, include_weather=False)
    # "footway" and "bridle" share their centroid.
    assert names(trails) == ["bridle", "in"]


def test_landed_weather(spark):
    rows = elements(spark, [way(0, "A", line(2)), way(1, "B", line(2, 4)), way(2, "C", line(2, 8))])
    weather = spark.createDataFrame([
        daily(0.5, 0.0, temperature_2m_max=9.5, sunrise=1700000000),
        daily(0.5, 0.0, dt.date(2024, 5, 5), temperature_2m_max=1.0),
        daily(4.5, 4.0, None, uv_index_max=3.0),
        daily(4.5, 4.0000001, uv_index_max=5.0),
    ], WEATHER_DAILY).withColumn("ord", F.monotonically_increasing_id())
    got = {r.name: r for r in build(rows, weather=weather, with_points=True).collect()}
    assert {r.weather_date for r in got.values()} == {DAY}
    assert (got["A"].temperature_2m_max, got["A"].sunrise, got["A"].rain_sum) == (9.5, 1700000000, None)
    assert got["B"].uv_index_max == 3.0
    assert all(got["C"][v] is None for v in WEATHER_VARIABLES)
    assert tuple(got["A"].centroid) == (0.5, 0.0) and tuple(got["A"].trailhead) == (0.0, 0.0)


def test_the_later_weather_record_wins(spark):
    rows = elements(spark, [way(0, "A", line(2))])
    weather = spark.createDataFrame(
        [daily(0.5, 0.0, rain_sum=float(i)) for i in range(5)], WEATHER_DAILY
    ).withColumn("ord", F.col("daily.rain_sum")[0] * -1)
    assert build(rows, weather=weather).first().rain_sum == 0.0
    with pytest.raises(ValueError):
        build(rows, weather=weather.drop("ord"))


def test_landed_weather_carries_its_order_of_arrival(spark, tmp_path):
    rows = elements(spark, [way(0, "A", line(2))])
    landed = [daily(0.5, 0.0, rain_sum=30.0), daily(0.5, 0.0, rain_sum=10.0)]
    spark.createDataFrame(landed, WEATHER_DAILY).coalesce(1).write.parquet(str(tmp_path / "w"))
    assert build(rows, weather=read_weather(spark, str(tmp_path / "w"))).first().rain_sum == 10.0
    with pytest.raises(ValueError):
        read_weather(spark, str(tmp_path / "w"), "json")


def test_the_asked_day_is_found_anywhere(spark):
    lat, lon, days = daily(0.5, 0.0)
    days |= {"time": [dt.date(2024, 1, 1), DAY], "rain_sum": [1.0, 2.0], "uv_index_max": [5.0]}
    weather = spark.createDataFrame([(lat, lon, days)], WEATHER_DAILY).withColumn("ord", F.lit(1))
    got = build(elements(spark, [way(0, "A", line(2))]), weather=weather).first()
    assert (got.rain_sum, got.uv_index_max, got.weather_date) == (2.0, None, DAY)


def test_lines_that_cross_the_area(spark):
    area = (0.0, 0.0, 1.0, 1.0)
    lines = {
        "through": [(-1, 0.5), (2, 0.5)], "corner": [(-0.5, 0.5), (0.5, -0.5)], "past": [(-1, 0.5), (0.5, 2.1)],
        "edge": [(1, -1), (1, 2)], "beside": [(1.1, -1), (1.1, 2)], "point": [(1, 1), (1, 1)], "one": [(0.5, 0.5)],
        "out": [(2, 2), (2, 2)], "none": [],
    }
    rows = elements(spark, [way(i, n, p) for i, (n, p) in enumerate(lines.items())])
    got = {r.tags["name"] for r in in_area(rows, area).collect()}
    assert got == {"through", "corner", "edge", "point", "one"}


def test_crossing_agrees_with_clipping(spark):
    rng, area = random.Random(7), (0.0, 0.0, 4.0, 4.0)
    lines = [[(rng.randint(-4, 8), rng.randint(-4, 8)) for _ in range(2)] for _ in range(300)]

    def meets(p, q):
        low, high = Fraction(0), Fraction(1)
        for a, b in zip(p, q):
            if a == b:
                if not 0 <= a <= 4:
                    return False
            else:
                ends = sorted([Fraction(0 - a, b - a), Fraction(4 - a, b - a)])
                low, high = max(low, ends[0]), min(high, ends[1])
        return low <= high

    rows = elements(spark, [way(i, str(i), p) for i, p in enumerate(lines)])
    assert {r.ord for r in in_area(rows, area).collect()} == {i for i, (p, q) in enumerate(lines) if meets(p, q)}


def test_unknown_coordinates_drop_out_one_by_one(spark):
    broken = [(0, "way", 0, None, None, {"name": n, "foot": "yes", "highway": "path"}, [(0.0, None), (1.0, 1.0)])
              for n in "AB"]
    rows = elements(spark, [*broken, way(2, "C", line(2)), way(3, "D", line(2, 5))])
    assert names(build(rows)) == ["C", "D"]
    metrics = trail_metrics(rows, area=None).first()
    assert (metrics.segments, metrics.too_short, metrics.coordinates) == (4, 2, 2)


@pytest.mark.parametrize("deduplicate", [True, False])
def test_trails_are_batched_in_processing_order(spark, deduplicate):
    pick = longest_segment if deduplicate else all_segments
    rows = trail_segments(elements(spark, [way(i, "abc"[i % 3], line(2 + i % 2, i)) for i in range(9)]), None)
    got = request_batches(pick(rows, []), processing_order(), 2).orderBy("batch_id", "batch_pos").collect()
    want = sorted((r.first_ord, r.ord) for r in pick(rows, []).collect())
    assert [(r.first_ord, r.ord) for r in got] == want
    assert [(r.batch_id, r.batch_pos) for r in got] == [(i // 2, i % 2) for i in range(len(want))]


def test_null_orders_are_kept_and_come_first(spark):
    rows = spark.createDataFrame([(3,), (None,), (1,)], "o long")
    assert [r.o for r in with_index(rows, "o").orderBy("index").collect()] == [None, 1, 3]


def test_no_weather_source(spark):
    got = build(elements(spark, [way(0, "A", line(2))])).first()
    assert got.weather_date == DAY and got.sunset is None


def test_fetched_weather_batches(spark):
    rows = elements(spark, [way(i, f"n{i:02}", line(2, i)) for i in range(23)]).coalesce(1)
    seen = spark.sparkContext.accumulator(0)

    def fetch(keys):
        seen.add(1)
        if any(lat == 12.5 for lat, _ in keys):
            raise RuntimeError("service down")
        answers = [{"weather_date": DAY, "rain_sum": lat, "sunrise": int(lon)} for lat, lon in keys]
        return answers + [{"rain_sum": -1.0}] * 2

    trails = build(rows, fetch=fetch)
    asked = seen.value
    got = trails.collect()
    assert trails.count() == 23 and seen.value == asked >= 3
    assert len(got) == 23 and {r.weather_date for r in got} == {DAY}
    lost = [r for r in got if r.rain_sum is None]
    assert 3 <= len(lost) <= 10 and "n12" in {r.name for r in lost}
    assert all(r.rain_sum == int(r.name[1:]) + 0.5 for r in got if r.rain_sum is not None)


@pytest.mark.parametrize("chunk", [1, 4, 100])
def test_batches_fill_up_across_chunks(spark, chunk):
    keys = spark.range(23).coalesce(1).select(F.col("id").cast("double").alias("lat"), F.lit(0.0).alias("lon"))

    def fetch(batch):
        return [{"rain_sum": float(len(batch)), "sunrise": None} for _ in batch]

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(chunk))
    try:
        got = batched_lookup(keys, fetch, WEATHER_RECORD, 10).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(r.rain_sum for r in got) == [3.0] * 3 + [10.0] * 20
    assert batched_lookup(keys.limit(0), fetch, WEATHER_RECORD).collect() == []


def test_weather_and_fetch_exclude_each_other(spark):
    with pytest.raises(ValueError):
        build(elements(spark, []), weather=spark.range(1), fetch=list)


def test_index_and_batches(spark):
    rng = random.Random(4)
    values = sorted({rng.randint(-2**62, 2**62) for _ in range(300)} | set(range(-50, 50))
                    | {2**21 - 1, 2**21, 2**42, 2**42 - 1, -(2**42)})
    rows = spark.createDataFrame([(v,) for v in rng.sample(values, len(values))], "o long")
    got = [r.o for r in with_index(rows, "o").orderBy("index").collect()]
    assert got == values
    batches = request_batches(rows, "o", 7).orderBy("batch_id", "batch_pos").collect()
    assert [(r.o, r.batch_id, r.batch_pos) for r in batches] == [
        (v, i // 7, i % 7) for i, v in enumerate(values)
    ]
