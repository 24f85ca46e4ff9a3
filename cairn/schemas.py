"""Explicit schemas: what lands, and what the two result tables hold."""

from __future__ import annotations

from pyspark.sql import types as T

from cairn.vocab import WEATHER_VARIABLES

EPOCH_VARIABLES = ("sunrise", "sunset")

POINT = T.StructType([T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType())])

ELEMENT = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("id", T.LongType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
    T.StructField("geometry", T.ArrayType(POINT)),
])

# An element with its place: the payload it came in and its position or byte offset there.
LANDED_ELEMENT = T.StructType([
    T.StructField("ord", T.StructType([
        T.StructField("payload", T.StringType()),
        T.StructField("pos", T.LongType()),
    ])),
    *ELEMENT.fields,
])

PAYLOAD = T.StructType([T.StructField("elements", T.ArrayType(ELEMENT))])

WEATHER_DAILY = T.StructType([
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("daily", T.StructType(
        [T.StructField("time", T.ArrayType(T.DateType()))]
        + [
            T.StructField(v, T.ArrayType(T.LongType() if v in EPOCH_VARIABLES else T.DoubleType()))
            for v in WEATHER_VARIABLES
        ]
    )),
])

# One row per coordinate, after the first day's values have been taken out.
WEATHER_RECORD = T.StructType(
    [
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("weather_date", T.DateType()),
    ]
    + [
        T.StructField(v, T.LongType() if v in EPOCH_VARIABLES else T.DoubleType())
        for v in WEATHER_VARIABLES
    ]
)

SUBMISSIONS = T.StructType([
    T.StructField("submission_id", T.StringType()),
    T.StructField("subreddit", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("hot_rank", T.IntegerType()),
])

COMMENTS = T.StructType([
    T.StructField("comment_id", T.StringType()),
    T.StructField("submission_id", T.StringType()),
    T.StructField("parent_id", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("body", T.StringType()),
    T.StructField("created_utc", T.DoubleType()),
])

SCORES = T.StructType([
    T.StructField("negative", T.DoubleType()),
    T.StructField("neutral", T.DoubleType()),
    T.StructField("positive", T.DoubleType()),
])

GEAR_REVIEWS = T.StructType([
    T.StructField("subreddit", T.StringType()),
    T.StructField("sub_name", T.StringType()),
    T.StructField("sub_link", T.StringType()),
    T.StructField("comment_created", T.TimestampType()),
    T.StructField("comment_body", T.StringType()),
    T.StructField("weather_season", T.StringType()),
    T.StructField("gear_type", T.StringType()),
    T.StructField("gear_brand", T.StringType()),
    T.StructField("brand_context", T.StringType()),
    T.StructField("sent_label", T.StringType()),
    T.StructField("sent_score", T.FloatType()),
])

TRAIL_WEATHER = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("surface", T.StringType()),
        T.StructField("trail_visibility", T.StringType()),
        T.StructField("sac_scale", T.StringType()),
        T.StructField("weather_date", T.DateType()),
    ]
    + [
        T.StructField(v, T.TimestampType() if v in EPOCH_VARIABLES else T.DoubleType())
        for v in WEATHER_VARIABLES
    ]
    + [T.StructField("geometry", T.StringType())]
)


def comment_tree(depth: int) -> T.ArrayType:
    """Comments that carry their replies nested, ``depth`` levels below the top."""
    fields = [f for f in COMMENTS.fields if f.name not in ("submission_id", "parent_id")]
    if depth > 0:
        fields = fields + [T.StructField("replies", comment_tree(depth - 1))]
    return T.ArrayType(T.StructType(fields))
