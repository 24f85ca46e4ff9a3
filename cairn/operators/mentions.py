"""One row per brand mention."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.functions.text import context_window, mark_mentions, marked_mentions
from cairn.vocab import CONTEXT_WORDS


def brand_mentions(
    texts: DataFrame,
    column: str,
    pattern: str,
    window_words: int = CONTEXT_WORDS,
) -> DataFrame:
    """Adds ``mention_pos``, ``gear_brand`` and ``brand_context``, a row per mention.

    Mentions do not overlap, repeats are kept, texts without any drop out.
    """
    if window_words < 0:
        raise ValueError("window_words must not be negative")
    kept = texts.columns
    marked = texts.withColumn("_marked", mark_mentions(F.col(column), pattern))
    # The outer form plus a null filter: the inner one makes the optimizer repeat
    # the extraction below the projection to drop empty arrays early.
    found = marked.select(
        *kept,
        F.posexplode_outer(marked_mentions(F.col("_marked"), window_words)).alias(
            "mention_pos", "_m"
        ),
    ).where(F.col("_m").isNotNull())
    mention = F.col("_m.mention")
    return found.select(
        *kept,
        "mention_pos",
        F.lower(mention).alias("gear_brand"),
        context_window(mention, F.col("_m.left"), F.col("_m.right")).alias("brand_context"),
    )
