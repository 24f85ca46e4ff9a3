import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cairn import apply_ddl, init_tables, load_all, load_gear_reviews, load_trails, trail_metrics
from cairn.schemas import COMMENTS, GEAR_REVIEWS, SUBMISSIONS, TRAIL_WEATHER
from cairn.sinks.loads import Folder, location
from cairn.sources.elements import parse_elements, read_elements, read_landed_elements
from cairn.sources.landed import read_comments, read_submissions

AREA = (0.0, 0.0, 90.0, 90.0)


@pytest.fixture
def payloads(tmp_path):
    def doc(*ways):
        return {"version": 0.6, "elements": [
            {"type": "way", "id": i, "tags": {"name": n, "foot": "yes", "highway": "path"},
             "geometry": [{"lat": 1.0 + i, "lon": 2.0}, {"lat": 1.0 + i, "lon": 2.1234567}]}
            for i, n in ways
        ] + [{"type": "node", "id": 99, "lat": 1.0, "lon": 1.0, "tags": {"natural": "peak"}}]}

    docs = [doc((1, "A"), (2, "B")), doc((3, "A"), (4, "C"))]
    for i, d in enumerate(docs):
        (tmp_path / f"p{i}.json").write_text(json.dumps(d, indent=1))
    return tmp_path, docs


def test_payload_scan(spark, payloads):
    path, docs = payloads
    rows = read_elements(spark, str(path))
    assert rows.count() == 6
    ids = [r.id for r in rows.orderBy("ord").collect()]
    assert ids == [1, 2, 99, 3, 4, 99]
    texts = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "k int, t string")
    assert [r.id for r in parse_elements(texts, "t", "k").orderBy("ord").collect()] == ids
    rows.write.parquet(f"{path}-landed")
    landed = read_landed_elements(spark, f"{path}-landed")
    assert landed.schema.simpleString() == rows.schema.simpleString()
    assert [r.id for r in landed.orderBy("ord").collect()] == ids
    (path / "bad.json").write_text("{")
    with pytest.raises(Exception):
        read_elements(spark, str(path)).count()


def test_ddl_report(spark):
    report = apply_ddl(spark, "CREATE TABLE a(x INT) USING parquet; BAD; ;CREATE TABLE b(y INT) USING parquet")
    got = report.orderBy("idx").collect()
    assert [r.ok for r in got] == [True, False, True]
    assert got[1].statement == "BAD" and got[1].error and got[0].error is None
    assert spark.catalog.tableExists("a") and spark.catalog.tableExists("b")


def test_load_everything(spark, payloads, tmp_path):
    assert all(r.ok for r in init_tables(spark).collect())
    assert all(r.ok for r in init_tables(spark).collect())
    assert spark.table("trail.trail_weather").schema.simpleString() == TRAIL_WEATHER.simpleString()
    assert spark.table("gear.gear_reviews").schema.simpleString() == GEAR_REVIEWS.simpleString()

    landed = tmp_path / "landed"
    spark.createDataFrame([("s1", "hiking", "Winter", "u", 1)], SUBMISSIONS).write.parquet(f"{landed}/s")
    spark.createDataFrame(
        [("c1", "s1", None, "comment", "winter vest, Osprey", 5.0)], COMMENTS
    ).write.parquet(f"{landed}/c")
    subs, comments = read_submissions(spark, f"{landed}/s"), read_comments(spark, f"{landed}/c")
    rows = read_elements(spark, str(payloads[0]) + "/p*.json")
    options = {"area": AREA, "weather_date": "2024-05-06"}

    assert load_all(rows, subs, comments, trails=options) == {"trails": 3, "reviews": 1}
    assert load_trails(rows, include_weather=False, area=AREA) == 3
    trails = spark.table("trail.trail_weather")
    assert trails.count() == 6
    assert {r.geometry for r in trails.where("name = 'A'").collect()} == {
        "LINESTRING (2 2, 2.123457 2)"
    }
    assert trails.where("weather_date = date'2024-05-06'").count() == 3
    review = spark.table("gear.gear_reviews").select("gear_brand", "sent_score", F.unix_timestamp("comment_created").alias("t")).first()
    assert tuple(review) == ("osprey", 1.0, 5)

    assert load_gear_reviews(subs.where("false"), comments) == 0
    assert load_gear_reviews(subs, comments.where("body = 'x'")) == 0
    assert spark.table("gear.gear_reviews").count() == 1
    assert load_trails(rows.where("id < 0"), **options) == 0


def review_inputs(spark):
    subs = spark.createDataFrame([("s1", "hiking", "Winter", "u", 1)], SUBMISSIONS)
    return subs, spark.createDataFrame([("c1", "s1", None, "comment", "winter vest, Osprey", 5.0)], COMMENTS)


def test_a_load_with_an_id_adds_its_rows_once(spark, payloads):
    rows = read_elements(spark, str(payloads[0]) + "/p*.json")
    tables = {"trails": {"table": "once_trails", "area": AREA}, "reviews": {"table": "once_reviews"}}
    first = load_all(rows, *review_inputs(spark), **tables, load_id="day-1")
    again = load_all(rows, *review_inputs(spark), **tables, load_id="day-1")
    assert first == {"trails": 3, "reviews": 1} and again == {"trails": 0, "reviews": 0}
    assert again["trails"].report == first["trails"].report and first["reviews"].report == {"rows": 1}
    assert spark.table("once_trails").count() == 3 and spark.table("once_reviews").count() == 1
    assert load_trails(rows, "once_trails", load_id="day-2", area=AREA) == 3
    assert load_trails(rows, "once_trails", area=AREA) == 3  # appends, as ever
    assert spark.table("once_trails").count() == 9
    folder = Folder(spark, location(spark, "once_trails"))
    assert folder.has("_loads/day-1/done") and not folder.has("_loads/day-1/staged")
    assert load_gear_reviews(*(f.where("false") for f in review_inputs(spark)), table="once_reviews", load_id="none") == 0
    assert spark.table("once_reviews").count() == 1
    with pytest.raises(ValueError, match="load id"):
        load_trails(rows, "once_trails", load_id="../x", area=AREA)
    spark.sql("CREATE TABLE in_json (name STRING) USING json")
    with pytest.raises(ValueError, match="Parquet"):
        location(spark, "in_json")


@pytest.mark.parametrize("moves", [0, 1, 3])
def test_a_load_that_was_cut_short_goes_on(spark, payloads, monkeypatch, moves):
    table = f"cut_{moves}"
    rows = read_elements(spark, str(payloads[0]) + "/p*.json").repartition(3)
    whole, done = Folder.move, []

    def cut(self, name, target):
        if len(done) == moves:
            raise OSError("the driver was lost")
        done.append(name)
        whole(self, name, target)

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        monkeypatch.setattr(Folder, "move", cut)
        with pytest.raises(OSError):
            load_trails(rows, table, load_id="a", area=AREA)
        monkeypatch.setattr(Folder, "move", whole)
        loaded = load_trails(rows, table, load_id="a", area=AREA)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert loaded == 3 and loaded.report["segments"] == 4
    assert sorted(r.name for r in spark.table(table).collect()) == ["A", "B", "C"]
    assert load_trails(rows, table, load_id="a", area=AREA) == 0 and spark.table(table).count() == 3


@pytest.mark.parametrize("deduplicate", [True, False])
@pytest.mark.parametrize("fetch", [None, lambda keys: [{"rain_sum": 1.0} for _ in keys]])
def test_a_load_reports_what_the_metrics_say(spark, payloads, deduplicate, fetch):
    rows = read_elements(spark, str(payloads[0]) + "/p*.json")
    table = f"reported_{deduplicate}_{fetch is None}"
    loaded = load_trails(rows, table, deduplicate=deduplicate, fetch=fetch, batch_size=2, area=AREA)
    want = trail_metrics(rows, deduplicate, 2, AREA).first().asDict()
    assert loaded.report == {"rows": int(loaded), **want} and loaded.report["segments"] == 4


def test_staged_reviews_are_removed(spark, payloads):
    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(Path(shared).glob("reviews-*"))
    assert load_gear_reviews(*review_inputs(spark), table="staged_reviews") == 1
    assert set(Path(shared).glob("reviews-*")) == before


def test_a_failing_trail_load_stops_the_reviews(spark):
    subs = spark.createDataFrame([("s1", "hiking", "Winter", "u", 1)], SUBMISSIONS)
    comments = spark.createDataFrame([("c1", "s1", None, "comment", "winter vest, Osprey", 5.0)], COMMENTS)
    with pytest.raises(Exception):
        load_all(spark.range(1), subs, comments, reviews={"table": "never_written"})
    assert not spark.catalog.tableExists("never_written")
