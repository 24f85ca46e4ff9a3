"""Comments to submissions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A side is broadcast only below both bounds.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 64 * 1024 * 1024


def broadcast_if_small(side: DataFrame, most_rows: int | None) -> DataFrame:
    """Marks ``side`` for broadcast when its rows are bounded and its texts measure small.

    ``most_rows`` is what the caller can prove; with no bound, or a large one, the side
    stays unmarked and the join shuffles, with skewed keys split at run time. Otherwise
    one small aggregate measures the bytes first.
    """
    if most_rows is None or most_rows > BROADCAST_ROWS:
        return side
    size = " + ".join(f"coalesce(octet_length(CAST({c} AS STRING)), 0)" for c in side.columns)
    measured = side.agg(F.expr(f"sum({size})")).first()[0] or 0
    return F.broadcast(side) if measured <= BROADCAST_BYTES else side


def with_submission(
    comments: DataFrame, submissions: DataFrame, most_submissions: int | None = None
) -> DataFrame:
    """Comments of the given submissions, each with its community, title and link."""
    side = submissions.select("submission_id", "subreddit", "title", "url")
    return comments.join(broadcast_if_small(side, most_submissions), "submission_id")
