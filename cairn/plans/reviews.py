"""Gear reviews: from forum submissions and comments to one row per brand mention."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.functions.sentiment import Scorer, lexicon_scorer, sentiment
from cairn.functions.text import brand_pattern, first_keyword, normalize_text
from cairn.functions.times import epoch_timestamp
from cairn.operators.joins import with_submission
from cairn.operators.mentions import brand_mentions
from cairn.operators.selection import body_gate, loaded_comments, title_gate, top_submissions
from cairn.session import settle
from cairn.vocab import (
    COMMUNITIES,
    CONTEXT_WORDS,
    GEAR_BRANDS,
    GEAR_CATEGORIES,
    HOT_SUBMISSIONS,
    SENTIMENT_METHOD,
    SENTIMENT_THRESHOLD,
    WEATHER_SEASON_WORDS,
)


def build_gear_reviews(
    submissions: DataFrame,
    comments: DataFrame,
    scorer: Scorer | None = None,
    window_words: int = CONTEXT_WORDS,
    threshold: float = SENTIMENT_THRESHOLD,
    method: str = SENTIMENT_METHOD,
    communities: Sequence[str] = tuple(COMMUNITIES),
    brands: Sequence[str] = tuple(GEAR_BRANDS),
    weather_words: Sequence[str] = tuple(WEATHER_SEASON_WORDS),
    gear_words: Sequence[str] = tuple(GEAR_CATEGORIES),
    per_community: int | None = HOT_SUBMISSIONS,
) -> DataFrame:
    """Brand mentions in the comments of hot submissions, with context and sentiment.

    Titles and bodies are gated on the raw text; mentions are looked for in the
    normalized one. With a limit per community the submissions are few: they are found
    once, when the plan is built, and kept; comments meet them by broadcast if they measure
    small, without a shuffle, and only those that do are searched for keywords.
    ``per_community=None`` takes all submissions and joins by shuffle, after the gates.
    """
    hot = title_gate(top_submissions(submissions, communities, per_community), weather_words)
    loaded = loaded_comments(comments)
    body = F.col("body")
    words = F.struct(
        first_keyword(body, weather_words).alias("weather_season"),
        first_keyword(body, gear_words).alias("gear_type"),
    )
    if per_community is None:
        joined = with_submission(body_gate(loaded, weather_words, gear_words), hot)
    else:
        joined = with_submission(loaded, settle(hot), per_community * len(communities))
    # Generated columns: each keyword is searched once, and their filter stays above the join.
    tagged = joined.withColumn("_words", F.explode(F.array(words))).where(
        "_words.weather_season IS NOT NULL AND _words.gear_type IS NOT NULL"
    ).select(
        "subreddit",
        F.col("title").alias("sub_name"),
        F.col("url").alias("sub_link"),
        epoch_timestamp(F.col("created_utc")).alias("comment_created"),
        body.alias("comment_body"),
        "_words.weather_season",
        "_words.gear_type",
        normalize_text(body).alias("_text"),
    )
    scores = (scorer or lexicon_scorer())(F.col("brand_context"))
    found = brand_mentions(tagged, "_text", brand_pattern(brands), window_words)
    return (
        found.withColumn("_scores", scores)
        .withColumn("_s", sentiment(F.col("_scores"), method, threshold))
        .select(
            "subreddit", "sub_name", "sub_link", "comment_created", "comment_body",
            "weather_season", "gear_type", "gear_brand", "brand_context",
            "_s.sent_label", "_s.sent_score",
        )
    )
