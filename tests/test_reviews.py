import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from cairn import build_gear_reviews
from cairn.functions.sentiment import lexicon_scorer, model_scorer
from cairn.operators.selection import top_submissions
from cairn.schemas import COMMENTS, SUBMISSIONS, comment_tree
from cairn.sources.landed import flatten_comments, walk_comments

SUBS = [
    ("s1", "hiking", "Winter gear", "u1", 1),
    ("s2", "hiking", "Shoes?", "u2", 2),
    ("s3", "Hiking", "Winter gear", "u3", 1),
    ("s4", "backpacking", "Any recommendations", "u4", 401),
]
BODY = "In winter my rain jacket by Osprey and MSR was great"


def tables(spark, comments, subs=SUBS):
    return spark.createDataFrame(subs, SUBMISSIONS), spark.createDataFrame(comments, COMMENTS)


def comment(i, sub, body=BODY, kind="comment", parent=None, created=1700000000.0):
    return (i, sub, parent, kind, body, created)


def test_rows(spark):
    subs, comments = tables(spark, [
        comment("c1", "s1"),
        comment("c2", "s2"),
        comment("c3", "s3"),
        comment("c4", "s1", kind="more"),
        comment("c5", "s1", body=None),
        comment("c6", "s1", body="winter rain\njacket, no\nbrand"),
        comment("c7", "s1", body="Osprey in winter"),
        comment("c8", "s1", body="an  Osprey\nvest for fall", parent="c1", created=None),
        comment("c9", "s4"),
    ])
    got = build_gear_reviews(subs, comments).orderBy("comment_body", "gear_brand").collect()
    assert [(r.comment_body[:6], r.gear_brand) for r in got] == [
        ("In win", "msr"), ("In win", "msr"),
        ("In win", "osprey"), ("In win", "osprey"), ("an  Os", "osprey"),
    ]
    first = [r for r in got if r.sub_link == "u1" and r.gear_brand == "osprey" and r.comment_body == BODY]
    assert len(first) == 1
    r = first[0]
    assert (r.subreddit, r.sub_name, r.weather_season, r.gear_type) == (
        "hiking", "Winter gear", "winter", "rain jacket")
    assert r.brand_context == "In winter my rain jacket by Osprey and MSR was great"
    assert r.comment_created == dt.datetime.fromtimestamp(1700000000)
    assert (r.sent_label, r.sent_score) == ("positive", 0.5)
    reply = next(r for r in got if r.comment_body.startswith("an"))
    assert reply.comment_created is None and reply.brand_context == "an Osprey vest for fall"
    # s4 is the only one of its community: its place is first whatever its rank says.
    assert {r.sub_link for r in got} == {"u1", "u4"}


def test_limit_comes_before_the_title_gate(spark):
    subs = [(f"s{i}", "hiking", "Shoes" if i <= 400 else "Winter", "u", i) for i in range(1, 402)]
    submissions, comments = tables(spark, [comment("c", "s401")], subs)
    assert build_gear_reviews(submissions, comments).count() == 0
    assert build_gear_reviews(submissions, comments, per_community=401).count() == 2
    assert build_gear_reviews(submissions, comments, per_community=None).count() == 2


def test_a_community_that_holds_most_submissions(spark):
    rows = spark.range(5000).select(
        F.col("id").cast("string").alias("submission_id"),
        F.when(F.col("id") % 10 < 8, "hiking").otherwise("backpacking").alias("subreddit"),
        F.lit("t").alias("title"), F.lit("u").alias("url"),
        (F.lit(5000) - F.col("id")).cast("int").alias("hot_rank"),
    ).repartition(9)
    got = top_submissions(rows).groupBy("subreddit").agg(F.count("*").alias("n"), F.max("hot_rank").alias("m"))
    assert {r.subreddit: (r.n, r.m) for r in got.collect()} == {
        "hiking": (400, 500), "backpacking": (400, 1992)
    }


def test_policies_and_scorers(spark):
    subs, comments = tables(spark, [comment("c1", "s1")])

    def load():
        return lambda texts: [{"negative": 0.2, "neutral": 0.7, "positive": 0.1} for _ in texts]

    def labels(**options):
        return {(r.sent_label, round(r.sent_score, 3))
                for r in build_gear_reviews(subs, comments, **options).collect()}

    model = model_scorer(load)
    assert labels(scorer=model) == {("neutral", 0.7)}
    assert labels(scorer=model, method="threshold", threshold=0.8) == {("NEUTRAL", 0.7)}
    assert labels(scorer=lexicon_scorer(["great"], []), method="raw") == {("neutral", 0.5)}


def test_nested_replies(spark):
    def node(i, *replies, kind="comment"):
        return {"comment_id": i, "kind": kind, "body": i * 2, "created_utc": 1.0, "replies": list(replies)}

    leaf = lambda i: {"comment_id": i, "kind": "comment", "body": i, "created_utc": 1.0}
    schema = "submission_id string, comments " + comment_tree(2).simpleString()
    threads = spark.createDataFrame([
        ("s1", [node("a", node("b", leaf("c")), node("d")), node("e", kind="more")]),
        ("s2", [{"comment_id": "f", "kind": "comment", "body": "f", "created_utc": None, "replies": None}]),
        ("s3", []), ("s4", None),
    ], schema)
    flat = flatten_comments(threads).orderBy("submission_id", "position").collect()
    assert [(r.submission_id, r.comment_id) for r in flat] == [
        ("s1", "a"), ("s1", "e"), ("s1", "b"), ("s1", "d"), ("s1", "c"), ("s2", "f")
    ]
    assert flat[1].kind == "more"


@pytest.mark.parametrize("depth", range(1, 13))
def test_replies_at_any_depth(spark, depth):
    def node(i):
        replies = [node(i + 1), {"comment_id": f"s{i}", "kind": "more"}] if i < depth else None
        return {"comment_id": f"c{i}", "kind": "comment", "body": f"b {i}", "created_utc": 1.0, "replies": replies}

    threads = spark.createDataFrame(
        [("t", json.dumps([node(0)])), ("u", None), ("v", "[]")], "submission_id string, comments string")
    got = sorted((r.depth, r.comment_id, r.body) for r in walk_comments(threads).collect())
    want = [(i, f"c{i}", f"b {i}") for i in range(depth + 1)] + [(i, f"s{i - 1}", None) for i in range(1, depth + 1)]
    assert got == sorted(want, key=lambda x: (x[0], x[1]))
