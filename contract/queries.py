"""One query per operator or job, over the driver's tables.

Dates and timestamps leave as text and counts as bigint, so that both engines print
them alike.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructType

from cairn import (
    build_gear_reviews,
    build_trails,
    init_tables,
    load_all,
    load_trails,
    trail_metrics,
)
from cairn.functions.geo import line_centroid, line_wkt, place_key, trailhead
from cairn.functions.sentiment import lexicon_scorer, model_scorer, sentiment
from cairn.functions.text import (
    brand_pattern,
    first_keyword,
    normalize_text,
    whole_words,
)
from cairn.functions.times import as_date, epoch_timestamp
from cairn.operators.enrich import (
    attach_weather,
    batched_lookup,
    first_day,
    latest_record,
    ordered_lookup,
)
from cairn.operators.joins import with_submission
from cairn.operators.mentions import brand_mentions
from cairn.operators.ordering import (
    all_segments,
    longest_segment,
    processing_order,
    request_batches,
    with_index,
)
from cairn.operators.selection import (
    body_gate,
    foot_trails,
    in_area,
    loaded_comments,
    title_gate,
    top_submissions,
    trail_tags,
)
from cairn.plans.trails import located_trails, trail_rows, trail_segments
from cairn.schemas import EPOCH_VARIABLES
from cairn.session import shared_folder
from cairn.sources.elements import parse_elements
from cairn.sources.landed import flatten_comments, read_comments, read_submissions, walk_comments
from cairn.sources.split import scan_elements
from cairn.vocab import GEAR_CATEGORIES, HOT_SUBMISSIONS, WEATHER_SEASON_WORDS, WEATHER_VARIABLES
from contract import standins as S

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def _stamp(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


# ------------------------------------------------------------------ trails


@query
def area_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return in_area(S.elements(spark, sf_dir), S.AREA).select("id", "type")


@query
def way_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trail_tags(foot_trails(in_area(S.elements(spark, sf_dir), S.AREA)), "id")


@query
def segment_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trail_metrics(S.elements(spark, sf_dir), area=None)


@query
def area_crossing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An area that lines cross without a point inside."""
    return in_area(S.elements(spark, sf_dir), S.STRIP).select("id", "type")


@query
def segment_metrics_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trail_metrics(S.elements(spark, sf_dir), deduplicate=False, area=None)


@query
def longest_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    segments = trail_segments(S.elements(spark, sf_dir), None)
    return longest_segment(segments, ["surface"]).select(
        "name", "first_ord", "ord", F.col("n_points").cast("long").alias("n_points"), "surface"
    )


@query
def all_segments_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    segments = trail_segments(S.elements(spark, sf_dir), None)
    return all_segments(segments, []).select("name", "first_ord", "ord")


@query
def line_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    located = S.vector_lines(spark, sf_dir).select(
        "vec_id", line_centroid("line").alias("c"), trailhead("line").alias("h")
    )
    return located.selectExpr(
        "vec_id", "round(c.lat, 6) AS lat", "round(c.lon, 6) AS lon",
        "h.lat AS head_lat", "h.lon AS head_lon",
    )


@query
def wkt_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.vector_lines(spark, sf_dir).select("vec_id", line_wkt("line").alias("wkt"))


def _located(spark: SparkSession, sf_dir: str, deduplicate: bool) -> DataFrame:
    segments = trail_segments(S.elements(spark, sf_dir), None)
    return located_trails(segments, deduplicate).select(
        "lat", "lon", "name", "surface", F.size("line").cast("long").alias("n_points")
    )


@query
def centroid_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _located(spark, sf_dir, True)


@query
def centroid_last_wins_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _located(spark, sf_dir, False)


@query
def first_day_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = first_day(S.weather(spark, sf_dir), S.DAY)
    return records.select(
        F.col("ord.event_id").alias("event_id"),
        "lat", "lon", "temperature_2m_max", "sunset", "uv_index_max",
        F.col("weather_date").cast("string").alias("weather_date"),
    )


@query
def weather_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = latest_record(first_day(S.weather(spark, sf_dir), S.DAY))
    return records.select("lat", "lon", *WEATHER_VARIABLES)


@query
def trail_weather_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    trails = S.table(spark, sf_dir, "customer").select(
        place_key("c_custkey + 0.5D", "1D").alias("place"),
        F.col("c_name").alias("name"),
    )
    records = latest_record(first_day(S.weather(spark, sf_dir), S.DAY))
    return attach_weather(trails, records, S.DAY).select(
        "name", F.col("weather_date").cast("string").alias("weather_date"), "rain_sum", "sunrise"
    )


@query
def request_batch_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = S.table(spark, sf_dir, "customer").select("c_custkey")
    return request_batches(keys, "c_custkey", 10)


@query
def request_batch_ids_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = S.table(spark, sf_dir, "events").select("event_id")
    return request_batches(keys, "event_id", 64)


def _trail_batches(spark: SparkSession, sf_dir: str, pick) -> DataFrame:
    trails = pick(trail_segments(S.elements(spark, sf_dir), None), [])
    return request_batches(trails, processing_order(), 10).select("ord", "batch_id", "batch_pos")


@query
def trail_request_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trail_batches(spark, sf_dir, longest_segment)


@query
def trail_request_batches_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trail_batches(spark, sf_dir, all_segments)


@query
def batched_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    def fetch(keys: list[tuple]) -> list[dict | None]:
        answers = [{"doubled": balance * 2, "key": int(key)} for balance, key in keys]
        return [a if a["doubled"] >= 0 else None for a in answers] + [{"doubled": -1.0}]

    keys = S.table(spark, sf_dir, "customer").select(
        F.col("c_acctbal").alias("lat"), F.col("c_custkey").cast("double").alias("lon")
    )
    fields = StructType().add("lat", DoubleType()).add("lon", DoubleType())
    fields = fields.add("doubled", DoubleType()).add("key", LongType())
    return batched_lookup(keys, fetch, fields)


@query
def epoch_to_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers, unreadable texts, and values beyond the bounds on either side."""
    seconds = F.concat(
        F.when(F.col("event_type") == "error", "x").otherwise(""),
        (F.col("event_id") * 86_399).cast("string"),
    )
    beyond = F.when(F.col("event_id") % 2 == 0, "1e300").otherwise("-99999999999999")
    seconds = F.when(F.col("event_type") == "purchase", beyond).otherwise(seconds)
    return S.table(spark, sf_dir, "events").select(
        "event_id", _stamp(epoch_timestamp(seconds)).alias("at")
    )


@query
def coerce_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(
        F.when(F.col("event_type") == "error", "on ").otherwise(""),
        F.date_format("ts", "yyyy-MM-dd"),
    )
    return S.table(spark, sf_dir, "events").select(
        "event_id", as_date(text).cast("string").alias("day")
    )


def _trail_output(rows: DataFrame) -> DataFrame:
    return rows.selectExpr(
        "name", "surface", "trail_visibility", "sac_scale",
        "CAST(weather_date AS STRING) AS weather_date",
        *(
            f"date_format({v}, 'yyyy-MM-dd HH:mm:ss') AS {v}" if v in EPOCH_VARIABLES else v
            for v in WEATHER_VARIABLES
        ),
        "geometry",
    )


def _trails(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    trails = build_trails(
        S.elements(spark, sf_dir), S.weather(spark, sf_dir), S.DAY, area=None, **options
    )
    return _trail_output(trail_rows(trails))


@query
def trail_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trails(spark, sf_dir)


@query
def trail_weather_all_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trails(spark, sf_dir, deduplicate=False)


@query
def trails_without_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    trails = build_trails(S.elements(spark, sf_dir), include_weather=False, area=S.AREA)
    return _trail_output(trail_rows(trails))


@query
def osm_payload_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    element = "struct(type, id, lat, lon, tags, geometry)"
    other = (
        "struct('node' AS type, -id AS id, 1.5D AS lat, CAST(NULL AS DOUBLE) AS lon,"
        " CAST(NULL AS MAP<STRING, STRING>) AS tags, geometry)"
    )
    payloads = S.elements(spark, sf_dir).selectExpr(
        "ord", f"to_json(struct(array({element}, {other}) AS elements)) AS payload"
    )
    rows = parse_elements(payloads, "payload", "ord")
    return rows.select(
        F.col("ord.payload").alias("payload"),
        F.col("ord.pos").cast("long").alias("pos"),
        "id", "type", "lat", F.col("tags")["surface"].alias("surface"),
        line_wkt("geometry").alias("wkt"),
    )


@query
def element_file_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders in one payload file, read by many tasks."""
    rows = with_index(scan_elements(spark, S.payload_file(spark, sf_dir)).where("id >= 0"), "ord", "place")
    return rows.select(
        "place", "id", "type", "lat", F.col("tags")["surface"].alias("surface"),
        F.map_keys("tags").alias("_keys"), line_wkt("geometry").alias("wkt"),
    ).withColumn("n_tags", F.size("_keys").cast("long")).drop("_keys")


@query
def resumed_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lookup whose every third batch fails, and the run that asks for the rest."""
    def fetch(run: str):
        def answers(keys: list[tuple]) -> list[dict | None]:
            if run == "first" and keys[0][0] // 10 % 3 == 0:
                raise RuntimeError("no answer")
            return [{"run": run, "n": len(keys)} if key % 5 else None for key, in keys]

        return answers

    keys = S.table(spark, sf_dir, "customer").select("c_custkey")
    fields = StructType().add("c_custkey", LongType()).add("run", StringType()).add("n", LongType())
    folder = f"{shared_folder(spark)}/ledger-{uuid.uuid4().hex}"
    for run in ("first", "second"):
        found = ordered_lookup(keys, F.col("c_custkey"), fetch(run), fields, 10, folder)
    return found


@query
def trail_fetched_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather that depends on the batch a trail is asked with; each batch's eighth has none."""
    def fetch(keys: list[tuple]) -> list[dict | None]:
        return [
            {"temperature_2m_max": float(i), "rain_sum": float(len(keys)), "showers_sum": keys[0][0], "sunrise": int(lat)}
            if i != 7 else None
            for i, (lat, _) in enumerate(keys)]

    trails = build_trails(S.elements(spark, sf_dir), weather_date=S.DAY, fetch=fetch, area=None)
    return trail_rows(trails).selectExpr(
        "name", "surface", "CAST(weather_date AS STRING) AS weather_date", "temperature_2m_max", "rain_sum",
        "showers_sum", "date_format(sunrise, 'yyyy-MM-dd HH:mm:ss') AS sunrise", "geometry")


# What the last call set up; the next one drops it.
_SCHEMAS: list[str] = []


def _own_schema(spark: SparkSession) -> str:
    for earlier in _SCHEMAS:
        spark.sql(f"DROP SCHEMA IF EXISTS {earlier} CASCADE")
    schema = f"cairn_{uuid.uuid4().hex}"
    _SCHEMAS[:] = [schema]
    spark.sql(f"CREATE SCHEMA {schema} LOCATION '{shared_folder(spark)}/{schema}'")
    return schema


@query
def load_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One load run twice under its id, another once, both tables read back."""
    schema = _own_schema(spark)
    tables = {
        "trails": {"table": f"{schema}.trail_weather", "include_weather": False, "area": None},
        "reviews": {"table": f"{schema}.gear_reviews", **_REVIEW_OPTIONS}}
    for load_id in ("monday", "monday", "tuesday"):
        load_all(
            S.elements(spark, sf_dir), S.submissions(spark, sf_dir), S.comments(spark, sf_dir),
            load_id=load_id, **tables)
    trails, reviews = (spark.table(t["table"]) for t in tables.values())
    return trails.select(F.lit("trail").alias("kind"), F.col("name").alias("label"), F.col("geometry").alias("detail")).unionAll(
        reviews.select(F.lit("review").alias("kind"), F.col("gear_brand").alias("label"), F.col("brand_context").alias("detail")))


@query
def load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What two loads, with and without duplicates, count while they write."""
    schema = _own_schema(spark)
    reports = [
        {"deduplicate": one, **load_trails(
            S.elements(spark, sf_dir), f"{schema}.trail_weather", include_weather=False, area=None, deduplicate=one).report}
        for one in (True, False)]
    return spark.createDataFrame(reports, "deduplicate boolean, segments long, unique_names long, "
                                 "too_short long, coordinates long, batches long, rows long")


@query
def append_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sets up both tables in a schema of its own, appends to them twice, reads them back."""
    schema = _own_schema(spark)
    trail_table, gear_table = f"{schema}.trail_weather", f"{schema}.gear_reviews"
    init_tables(spark, trail_table, gear_table)
    elements = S.elements(spark, sf_dir)
    load_trails(elements, trail_table, weather=S.weather(spark, sf_dir), weather_date=S.DAY, area=None)
    load_all(
        elements, S.submissions(spark, sf_dir), S.comments(spark, sf_dir),
        trails={"table": trail_table, "include_weather": False, "area": None},
        reviews={"table": gear_table, **_REVIEW_OPTIONS},
    )
    trails = spark.table(trail_table).select(
        F.lit("trail").alias("kind"), F.col("name").alias("label"),
        F.col("weather_date").cast("string").alias("detail"), F.col("rain_sum").alias("number"),
    )
    reviews = spark.table(gear_table).select(
        F.lit("review").alias("kind"), F.col("gear_brand").alias("label"),
        F.col("brand_context").alias("detail"),
        F.round(F.col("sent_score").cast("double"), 4).alias("number"),
    )
    return trails.unionAll(reviews)


# ----------------------------------------------------------------- reviews

_REVIEW_OPTIONS = {
    "scorer": lexicon_scorer(S.POSITIVE, S.NEGATIVE),
    "communities": S.COMMUNITIES,
    "brands": S.BRANDS,
    "weather_words": S.WEATHER_WORDS,
    "gear_words": S.GEAR_WORDS,
}


@query
def top_submissions_per_community(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = S.table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("submission_id"), F.col("source").alias("subreddit"),
        F.col("doc_id").alias("hot_rank"),
    )
    return top_submissions(posts, S.SOURCES, 20).select("submission_id", "subreddit")


@query
def title_gate_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = S.documents(spark, sf_dir).withColumnRenamed("text", "title")
    return title_gate(posts, S.WEATHER_WORDS).select("doc_id")


@query
def body_gate_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    bodies = S.documents(spark, sf_dir).withColumnRenamed("text", "body")
    return body_gate(bodies, S.WEATHER_WORDS, S.GEAR_WORDS).select("doc_id")


@query
def keyword_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    return S.documents(spark, sf_dir).select(
        "doc_id",
        first_keyword(text, WEATHER_SEASON_WORDS).alias("season"),
        first_keyword(text, GEAR_CATEGORIES).alias("category"),
        first_keyword(text, S.WEATHER_WORDS).alias("word"),
        first_keyword(text, S.GEAR_WORDS).alias("thing"),
    )


@query
def many_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many of some thousand short words a text holds, and the first of them."""
    found = F.regexp_extract_all(F.lower("text"), F.lit(whole_words(S.MANY_WORDS)), F.lit(0))
    return S.documents(spark, sf_dir).select("doc_id", found.alias("_f")).select(
        "doc_id", F.size("_f").cast("long").alias("n"), F.get("_f", F.lit(0)).alias("first"))


@query
def normalized_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.documents(spark, sf_dir).select(
        "doc_id", normalize_text(F.col("text")).alias("clean")
    )


def _mentions(texts: DataFrame, window: int) -> DataFrame:
    clean = texts.withColumn("text", normalize_text(F.col("text")))
    found = brand_mentions(clean, "text", brand_pattern(S.BRANDS), window)
    return found.drop("text").withColumn("mention_pos", F.col("mention_pos").cast("long"))


@query
def brand_mentions_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = S.documents(spark, sf_dir)
    return _mentions(docs, 12).drop("brand_context")


@query
def brand_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mentions(S.turns(spark, sf_dir), 12)


@query
def brand_context_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mentions(S.documents(spark, sf_dir), 3)


@query
def brand_context_left_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A window of 0 words keeps the whole left side."""
    return _mentions(S.turns(spark, sf_dir), 0)


@query
def comment_submission_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = title_gate(S.submissions(spark, sf_dir), S.WEATHER_WORDS)
    return with_submission(S.comments(spark, sf_dir), kept).select(
        "comment_id", "subreddit", "url"
    )


@query
def landed_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Submissions and comments landed as files, read with the explicit schemas."""
    folder = f"{shared_folder(spark)}/landed-{uuid.uuid4().hex}"
    posts = S.submissions(spark, sf_dir).withColumn("hot_rank", F.col("hot_rank").cast("int"))
    posts.write.parquet(f"{folder}/submissions")
    S.comments(spark, sf_dir).write.parquet(f"{folder}/comments")
    submissions, comments = read_submissions(spark, f"{folder}/submissions"), read_comments(spark, f"{folder}/comments")
    return comments.join(submissions, "submission_id", "left").select(
        "comment_id", "submission_id", "kind", "body", "created_utc", "subreddit", "title", "hot_rank")


@query
def comment_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = loaded_comments(flatten_comments(S.threads(spark, sf_dir)))
    return flat.select("submission_id", "comment_id", "body")


@query
def comment_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = loaded_comments(walk_comments(S.deep_threads(spark, sf_dir)))
    return flat.select("submission_id", "comment_id", "body", "depth")


def _sentiment(method: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        verdict = sentiment(F.col("scores"), method, 0.5).alias("v")
        return S.scores(spark, sf_dir).select("event_id", verdict).select(
            "event_id",
            F.col("v.sent_label").alias("sent_label"),
            F.round("v.sent_score", 6).alias("sent_score"),
        )

    return run


for _method in ("threshold", "weighted", "positive_bias", "raw"):
    QUERIES[f"sentiment_{_method}"] = _sentiment(_method)


@query
def lexicon_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = lexicon_scorer(S.POSITIVE, S.NEGATIVE)(F.col("text")).alias("s")
    return S.documents(spark, sf_dir).select("doc_id", scores).select(
        "doc_id", *(F.round(f"s.{c}", 6).alias(c) for c in ("negative", "neutral", "positive"))
    )


@query
def model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    def load():
        def model(texts: list[str]) -> list[dict]:
            commas = [(t.count(","), t.count(".")) for t in texts]
            return [
                {"negative": c / (c + d + 1), "neutral": 1 / (c + d + 1), "positive": d / (c + d + 1)}
                for c, d in commas
            ]

        return model

    scored = S.documents(spark, sf_dir).select("doc_id", model_scorer(load)(F.col("text")).alias("s"))
    verdict = sentiment(F.col("s"), "positive_bias", 0.1).alias("v")
    return scored.select("doc_id", verdict).selectExpr(
        "doc_id", "v.sent_label AS sent_label", "round(v.sent_score, 6) AS sent_score"
    )


@query
def model_scores_by_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model whose scores depend on how far the texts of its batch are padded."""
    def load():
        def model(texts: list[str]) -> list[dict]:
            padded = 1
            while padded < max(map(len, texts)):
                padded *= 2
            return [
                {"negative": len(t) / (2 * padded), "neutral": 1 / padded, "positive": t.count(" ") / padded}
                for t in texts]

        return model

    scorer = model_scorer(load, batch_size=8, truncate=lambda text, most: text[:most], most_tokens=256)
    scored = S.documents(spark, sf_dir).select("doc_id", scorer(F.col("text")).alias("s"))
    return scored.selectExpr("doc_id", *(f"s.{c} AS {c}" for c in ("negative", "neutral", "positive")))


def _reviews(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    rows = build_gear_reviews(
        S.submissions(spark, sf_dir), S.comments(spark, sf_dir), **(_REVIEW_OPTIONS | options)
    )
    return rows.withColumn("comment_created", F.unix_timestamp("comment_created")).withColumn(
        "sent_score", F.round("sent_score", 6)
    )


@query
def gear_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reviews(spark, sf_dir, per_community=HOT_SUBMISSIONS)


@query
def gear_reviews_all_submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reviews(spark, sf_dir, per_community=None)


@query
def gear_reviews_few(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A limit that binds, and a community that is not listed."""
    return _reviews(spark, sf_dir, per_community=10, communities=S.COMMUNITIES[:1])
