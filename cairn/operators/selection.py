"""Which elements, submissions and comments take part."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cairn.functions.text import has_keyword
from cairn.vocab import (
    COMMUNITIES,
    GEAR_CATEGORIES,
    HOT_SUBMISSIONS,
    NODE_NATURAL,
    TRAIL_AREA,
    WAY_HIGHWAY_PATTERN,
    WEATHER_SEASON_WORDS,
)

# Parts a community is split into while its hottest submissions are picked.
SALTS = 64


def in_area(
    elements: DataFrame, area: tuple[float, float, float, float] = TRAIL_AREA
) -> DataFrame:
    """Footpath ways and peaks inside (south, west, north, east).

    A way is inside when one of its points is, or when a stretch between two neighbouring
    points meets the area, touching included.
    """
    south, west, north, east = area

    def inside(point: str) -> str:
        return (
            f"({point}lat BETWEEN {south!r}D AND {north!r}D"
            f" AND {point}lon BETWEEN {west!r}D AND {east!r}D)"
        )

    # A stretch meets the area when their ranges meet in both directions and the corners do
    # not all lie on one side of its line.
    sides = [
        f"((q.lon - p.lon) * ({lat!r}D - p.lat) - (q.lat - p.lat) * ({lon!r}D - p.lon))"
        for lat in (south, north) for lon in (west, east)
    ]
    crossing = f"""(greatest(p.lat, q.lat) >= {south!r}D AND least(p.lat, q.lat) <= {north!r}D
        AND greatest(p.lon, q.lon) >= {west!r}D AND least(p.lon, q.lon) <= {east!r}D
        AND p.lat + p.lon + q.lat + q.lon IS NOT NULL
        AND least({", ".join(sides)}) <= 0 AND greatest({", ".join(sides)}) >= 0)"""
    stretches = (
        "zip_with(geometry, slice(geometry, 2, greatest(size(geometry) - 1, 0)), (p, q) ->"
        f" coalesce({crossing}, false))"
    )

    return elements.where(
        f"(type = 'way' AND tags['highway'] RLIKE '{WAY_HIGHWAY_PATTERN}'"
        f" AND (exists(geometry, p -> {inside('p.')}) OR exists({stretches}, meets -> meets)))"
        f" OR (type = 'node' AND tags['natural'] = '{NODE_NATURAL}' AND {inside('')})"
    )


def foot_trails(elements: DataFrame) -> DataFrame:
    """Ways with a name that are tagged exactly ``foot=yes``."""
    return elements.where("type = 'way' AND tags['name'] <> '' AND tags['foot'] = 'yes'")


def trail_tags(elements: DataFrame, *keep: str) -> DataFrame:
    """The tags a trail row carries, absent ones null."""
    names = ("name", "surface", "trail_visibility", "sac_scale")
    return elements.selectExpr(*keep, *(f"tags['{n}'] AS {n}" for n in names))


def top_submissions(
    submissions: DataFrame,
    communities: Sequence[str] = tuple(COMMUNITIES),
    per_community: int | None = HOT_SUBMISSIONS,
) -> DataFrame:
    """The hottest submissions of each listed community (all of them for ``None``).

    Taken in three steps that each keep the limit: inside every map task (Spark does so
    for a bounded rank), per salted part of a community, then per community. However
    large one community is, its last step sees at most ``SALTS * per_community`` rows.
    """
    listed = submissions.where(F.col("subreddit").isin(*communities))
    if per_community is None:
        return listed
    salted = listed.withColumn("_salt", F.pmod(F.xxhash64("submission_id"), F.lit(SALTS)))
    parts = _hottest(salted, ["subreddit", "_salt"], per_community)
    return _hottest(parts, ["subreddit"], per_community).drop("_salt")


def _hottest(submissions: DataFrame, group: list[str], most: int) -> DataFrame:
    by_rank = Window.partitionBy(*group).orderBy("hot_rank", "submission_id")
    ranked = submissions.withColumn("_place", F.row_number().over(by_rank))
    return ranked.where(F.col("_place") <= most).drop("_place")


def title_gate(
    submissions: DataFrame, weather_words: Sequence[str] = tuple(WEATHER_SEASON_WORDS)
) -> DataFrame:
    """Submissions whose title holds a weather or season word."""
    return submissions.where(has_keyword(F.col("title"), weather_words))


def loaded_comments(comments: DataFrame) -> DataFrame:
    """Comments at any depth, without the stubs that stand for unloaded ones."""
    return comments.where(F.coalesce(F.col("kind"), F.lit("comment")) != "more")


def body_gate(
    comments: DataFrame,
    weather_words: Sequence[str] = tuple(WEATHER_SEASON_WORDS),
    gear_words: Sequence[str] = tuple(GEAR_CATEGORIES),
) -> DataFrame:
    """Comments whose raw body holds a weather or season word and a gear category."""
    body = F.col("body")
    return comments.where(has_keyword(body, gear_words) & has_keyword(body, weather_words))
