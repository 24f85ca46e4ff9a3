"""What the plans must look like for large tables."""

import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from cairn import build_gear_reviews, build_trails
from cairn.operators import joins
from cairn.operators.ordering import all_segments, request_batches
from cairn.operators.selection import top_submissions
from contract import standins as S
from contract.queries import _REVIEW_OPTIONS


@contextmanager
def settings(spark, **values):
    keys = {k.replace("__", "."): str(v) for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def initial_plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def final_plan(frame):
    frame.collect()
    return initial_plan(frame).split("== Initial Plan ==")[0]


def trails(spark, small, **options):
    return build_trails(S.elements(spark, small), S.weather(spark, small), S.DAY, area=None, **options)


def reviews(spark, small, **options):
    return build_gear_reviews(
        S.submissions(spark, small), S.comments(spark, small), **(_REVIEW_OPTIONS | options)
    )


def test_trails_shuffle_once_per_key(spark, small):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold=-1):
        plan = initial_plan(trails(spark, small))
    keys = re.findall(r"Exchange hashpartitioning\((\w+)#", plan)
    assert sorted(keys) == ["name", "place", "place"]
    assert "SinglePartition" not in plan
    # Each aggregation reduces inside the map tasks first.
    assert plan.count("partial_m") >= 4


def test_trails_read_only_what_they_need(spark, small):
    plan = initial_plan(trails(spark, small, include_weather=False))
    assert "o_totalprice" not in plan


def test_limited_reviews_never_shuffle_comments(spark, small):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold=-1):
        plan = initial_plan(reviews(spark, small))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert "Exchange hashpartitioning" not in plan and "WindowGroupLimit" not in plan
    # Comments meet the kept submissions before any keyword is searched.
    scan_side = plan[plan.index("BroadcastHashJoin"):]
    assert "RLIKE" not in scan_side and "regexp" not in scan_side and "Generate" not in scan_side
    assert "regexp" in plan or "RLIKE" in plan


def test_the_hottest_submissions_are_picked_once(spark, small):
    """One job picks and keeps them; measuring, joining and writing read what was kept."""
    tracker, group = spark.sparkContext.statusTracker(), "hot-once"
    spark.sparkContext.setJobGroup(group, group)
    try:
        rows = reviews(spark, small)
        plan = initial_plan(rows)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert "Window" not in plan and len(tracker.getJobIdsForGroup(group)) >= 1


def test_unlimited_reviews_join_by_shuffle(spark, small):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold=-1):
        plan = initial_plan(reviews(spark, small, per_community=None))
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert "RLIKE" in plan[plan.index("SortMergeJoin"):]  # gated below the join, before the shuffle


def test_a_side_that_measures_large_is_not_broadcast(spark, small, monkeypatch):
    expected = sorted(map(str, reviews(spark, small).collect()))
    with settings(spark, spark__sql__autoBroadcastJoinThreshold=-1):
        monkeypatch.setattr(joins, "BROADCAST_BYTES", 1)
        by_bytes = reviews(spark, small)
        assert "Broadcast" not in initial_plan(by_bytes)
        assert sorted(map(str, by_bytes.collect())) == expected
        monkeypatch.setattr(joins, "BROADCAST_ROWS", 1)
        assert "Broadcast" not in initial_plan(reviews(spark, small))


def test_mentions_are_extracted_once(spark, small):
    plan = initial_plan(reviews(spark, small))
    assert plan.count("regexp_replace(translate(_text") <= 1
    assert plan.count("Generate") == 2  # the keywords, the mentions


def test_a_hot_name_is_salted(spark):
    rows = spark.range(0, 60_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("n"), F.col("id"))).alias("name"),
        F.col("id").alias("ord"), F.lit(2).alias("n_points"), F.lit("payload").alias("line"),
    )
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold=-1,
        spark__sql__adaptive__enabled="false",
        spark__sql__shuffle__partitions=16,
    ):
        segments = all_segments(rows, ["line"])
        gathered = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", initial_plan(segments))
        assert [re.sub(r"#\w+", "", g) for g in gathered if "_salt" not in g] == ["name, 16"]
        sizes = [r["count"] for r in segments.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 60_000 and max(sizes) < 2 * 60_000 / 16
        assert segments.where("name = 'hot' AND first_ord <> 0").isEmpty()
        assert segments.where("name <> 'hot' AND first_ord <> ord").isEmpty()


def test_a_hot_submission_is_split_at_run_time(spark):
    comments = spark.range(0, 40_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("submission_id"),
        F.sha2(F.col("id").cast("string"), 512).alias("body"),
    )
    submissions = spark.range(0, 40_000, 1, 8).select(
        F.when(F.col("id") == 0, "hot").otherwise(F.col("id").cast("string")).alias("submission_id"),
        *(F.lit("x").alias(c) for c in ("subreddit", "title", "url")),
    )
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold=-1,
        spark__sql__adaptive__autoBroadcastJoinThreshold=-1,
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="100KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor=2,
        spark__sql__adaptive__advisoryPartitionSizeInBytes="100KB",
        spark__sql__shuffle__partitions=16,
    ):
        joined = joins.with_submission(comments, submissions)
        assert "skewed" in final_plan(joined)
        assert joined.count() == spark.range(40_000).where("id % 3 = 0 OR id > 0").count()


def test_numbering_has_no_global_window_over_rows(spark):
    rows = spark.range(10).withColumn("payload", F.lit("x"))
    plan = initial_plan(request_batches(rows, "id", 3))
    [single] = re.findall(r"Exchange SinglePartition[^\n]*\n([^\n]*)", plan)
    assert "_part" in single and "payload" not in single


@pytest.mark.parametrize("deduplicate", [True, False])
def test_results_do_not_depend_on_partitioning(spark, small, deduplicate):
    found = []
    for partitions in (1, 4, 64):
        with settings(spark, spark__sql__shuffle__partitions=partitions):
            found.append(sorted(map(str, trails(spark, small, deduplicate=deduplicate).collect())))
    assert found[0] == found[1] == found[2]


def test_top_submissions_keep_ties_apart(spark):
    rows = spark.range(1000).select(
        F.col("id").cast("string").alias("submission_id"), F.lit("a").alias("subreddit"),
        F.lit(7).alias("hot_rank"),
    )
    got = [r.submission_id for r in top_submissions(rows, ["a"], 5).collect()]
    assert sorted(got) == sorted(sorted(str(i) for i in range(1000))[:5])


@pytest.mark.parametrize("deduplicate", [True, False])
def test_counters_add_no_scan(spark, small, deduplicate):
    from cairn.plans.trails import TrailCounters

    elements = S.elements(spark, small)

    def plan(counters):
        found = build_trails(elements, include_weather=False, deduplicate=deduplicate, area=None, counters=counters)
        return initial_plan(found)

    assert plan(TrailCounters()).count("FileScan") == plan(None).count("FileScan") == (1 if deduplicate else 2)
    assert "CollectMetrics" in plan(TrailCounters())
