"""The driver's tables read as map elements, daily weather, submissions and comments.

Every stand-in is a projection of one table, row by row: nothing is grouped to build it,
so a key that holds a third of a table costs no more than any other row.
"""

from __future__ import annotations

import itertools
import uuid

from pyspark.sql import DataFrame, SparkSession

from cairn.schemas import EPOCH_VARIABLES
from cairn.session import settle, shared_folder
from cairn.vocab import WEATHER_VARIABLES

AREA = (10.0, 5.0, 300.0, 25.0)
# A strip between two rows of points: lines only cross it.
STRIP = (10.25, 5.1, 10.75, 24.9)
DAY = "2024-02-01"
WEATHER_WORDS = ["and", "that", "with", "was"]
GEAR_WORDS = ["this", "from", "are", "for"]
BRANDS = ["heon", "thon", "anly", "eron", "erre", "thou", "erre the"]
COMMUNITIES = ["user", "system"]
SOURCES = [f"src{i}" for i in range(10)]
POSITIVE = ["the", "le", "und"]
NEGATIVE = ["of", "la", "die"]
# All words of two letters, and those of three that begin with a vowel.
_LETTERS = "abcdefghijklmnopqrstuvwxyz"
MANY_WORDS = ["".join(w) for w in itertools.product(_LETTERS, repeat=2)] + [
    "".join(w) for w in itertools.product("aeiou", _LETTERS, _LETTERS)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")


def elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order is a way of as many points as its month says, around (customer / 4, day).

    Orders of status P are peaks; those of status O are open to walkers. All numbers are
    small binary fractions, so centroids are exact and neighbouring customers collide.
    """
    orders = table(spark, sf_dir, "orders").selectExpr(
        "*",
        "CAST(o_custkey DIV 4 AS DOUBLE) AS base",
        "CAST(dayofmonth(o_orderdate) AS DOUBLE) AS day",
        "month(o_orderdate) AS points",
    )
    line = """transform(sequence(1, points), i -> struct(
        base + i % 2 AS lat, day + (i - (points + 1) / 2D) * 0.75D AS lon))"""
    return orders.selectExpr(
        "o_orderkey AS ord",
        "if(o_orderstatus = 'P', 'node', 'way') AS type",
        "o_orderkey AS id",
        "if(o_orderstatus = 'P', base, NULL) AS lat",
        "if(o_orderstatus = 'P', day, NULL) AS lon",
        """map_filter(map(
            'name', if(o_orderkey % 97 = 0, '', CAST(o_custkey AS STRING)),
            'foot', if(o_orderstatus = 'O', 'yes', 'no'),
            'highway', element_at(array('footway', 'path', 'track', 'motorway', 'my_footways'), CAST(o_orderkey % 5 AS INT) + 1),
            'natural', if(o_orderkey % 3 = 0, 'tree', 'peak'), 'surface', o_orderpriority,
            'sac_scale', if(o_orderkey % 4 = 0, 'hiking', NULL),
            'trail_visibility', if(o_orderkey % 7 = 0, 'good', NULL)), (k, v) -> v IS NOT NULL) AS tags""",
        f"if(o_orderstatus = 'P', NULL, {line}) AS geometry",
    )


def payload_file(spark: SparkSession, sf_dir: str) -> str:
    """The elements landed as one payload file, in their order, behind a node of its own; the folder."""
    element = "to_json(struct(type, id, lat, lon, tags, geometry))"
    begin = spark.sql("""SELECT -2L AS ord, '{"version": 0.6, "elements": [{"type": "node", "id": -1}' AS value""")
    end = spark.sql("SELECT 9223372036854775807L AS ord, '], \"remark\": \"the \\\\\"type\\\\\" is }\"}' AS value")
    rows = elements(spark, sf_dir).selectExpr("ord", f"concat(',', {element}) AS value")
    folder = f"{shared_folder(spark)}/payload-{uuid.uuid4().hex}"
    # Sorted by all tasks and kept, then written by one, which holds a row at a time: the file is the point.
    lines = settle(rows.unionAll(begin).unionAll(end).orderBy("ord").select("value"))
    lines.coalesce(1).write.text(folder)
    return folder


def vector_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A vector is a line: pairs of neighbouring entries are its points."""
    return table(spark, sf_dir, "embeddings").selectExpr(
        "vec_id",
        """transform(sequence(0, size(embedding) - 2, 2), i -> struct(
            CAST(embedding[i] AS DOUBLE) AS lon, CAST(embedding[i + 1] AS DOUBLE) AS lat)) AS line""",
    )


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An event is a weather report for (user + 0.5, day of month).

    Sign-ups belong to another day, clicks name none, errors lack the UV index.
    """

    def variable(at: int, name: str) -> str:
        if name in EPOCH_VARIABLES:
            return f"array(event_id * 1000 + {at}) AS {name}"
        if name == "uv_index_max":
            return f"if(event_type = 'error', array(), array(value + {at})) AS {name}"
        return f"array(value + {at}) AS {name}"

    variables = ", ".join(variable(i, n) for i, n in enumerate(WEATHER_VARIABLES))
    return table(spark, sf_dir, "events").selectExpr(
        "user_id + 0.5D AS latitude",
        "CAST(dayofmonth(ts) AS DOUBLE) AS longitude",
        f"""struct(CASE event_type WHEN 'click' THEN array() WHEN 'signup' THEN
            array(DATE'2024-01-31') ELSE array(DATE'{DAY}') END AS time, {variables}) AS daily""",
        "struct(ts, event_id) AS ord",
    )


def submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first turn of a conversation; its role is the community."""
    return table(spark, sf_dir, "conversations").where("turn = 0").selectExpr(
        "CAST(conv_id AS STRING) AS submission_id", "role AS subreddit", "text AS title",
        "concat('c/', conv_id) AS url", "conv_id AS hot_rank",
    )


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The later turns of a conversation."""
    return table(spark, sf_dir, "conversations").where("turn > 0").selectExpr(
        "concat(conv_id, '-', turn) AS comment_id", "CAST(conv_id AS STRING) AS submission_id",
        "CAST(NULL AS STRING) AS parent_id", "'comment' AS kind", "text AS body",
        "conv_id * 1000D + turn AS created_utc",
    )


def threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document is a thread: its lines are comments, the sentences of a line replies.

    Short sentences stand for unloaded replies.
    """
    replies = r"""transform(split(line, '[.] '), (s, j) -> struct(
        concat(doc_id, '-', i, '-', j) AS comment_id,
        if(length(s) < 5, 'more', 'comment') AS kind, s AS body, CAST(j AS DOUBLE) AS created_utc))"""
    return documents(spark, sf_dir).selectExpr(
        "CAST(doc_id AS STRING) AS submission_id",
        rf"""transform(split(text, '\n'), (line, i) -> struct(
            concat(doc_id, '-', i) AS comment_id, 'comment' AS kind, line AS body,
            CAST(i AS DOUBLE) AS created_utc, {replies} AS replies)) AS comments""",
    )


def deep_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document is a chain of replies as JSON text, nested as deep as its id says."""
    depth = "CAST(doc_id % 9 AS INT)"
    begin = """concat('[{"comment_id": "', doc_id, '-', i, '", "kind": "', if(i % 4 = 3, 'more', 'comment'),
        '", "body": "level ', i, '", "created_utc": ', i, ', "replies": ')"""
    return documents(spark, sf_dir).selectExpr(
        "CAST(doc_id AS STRING) AS submission_id",
        f"""concat(array_join(transform(sequence(0, {depth}), i -> {begin}), ''), 'null',
            repeat('}}]', {depth} + 1)) AS comments""",
    )


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three class scores from an event."""
    total = "(value + 10D + event_id % 50)"
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        f"""struct(value / {total} AS negative, 10D / {total} AS neutral,
            CAST(event_id % 50 AS DOUBLE) / {total} AS positive) AS scores""",
    )
