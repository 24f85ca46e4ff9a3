"""Building and appending to the result tables."""

from __future__ import annotations

import uuid
from typing import Any

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from cairn.plans.reviews import build_gear_reviews
from cairn.plans.trails import TrailCounters, build_trails, trail_rows
from cairn.schemas import GEAR_REVIEWS
from cairn.session import observed, shared_folder
from cairn.sinks.loads import Folder, publish_once
from cairn.sinks.tables import GEAR_TABLE, TRAIL_TABLE, append, conform
from cairn.vocab import WEATHER_BATCH


class Loaded(int):
    """The number of rows that a load wrote, with its ``report``: ``rows``, and for trails the
    counters of ``TrailCounters``. A load that was published before writes 0 rows and has the report
    of that time."""

    report: dict[str, int]

    def __new__(cls, rows: int, report: dict[str, int]) -> Loaded:
        loaded = super().__new__(cls, rows)
        loaded.report = report
        return loaded


def load_trails(
    elements: DataFrame,
    table: str = TRAIL_TABLE,
    precision: int = 6,
    load_id: str | None = None,
    **options: Any,
) -> Loaded:
    """Appends the trails (options of ``build_trails``); the number of rows written.

    The elements are read once: rows, segments, names and batches are counted on the way. With a
    ``load_id`` the same load adds its rows once, however often it is run; see ``publish_once``.
    """
    counters = TrailCounters(options.get("batch_size", WEATHER_BATCH))
    rows = trail_rows(build_trails(elements, counters=counters, **options), precision)
    seen = Observation()
    counted = rows.observe(seen, F.count(F.lit(1)).alias("rows"))
    if load_id is None:
        append(counted, table)
        report = {**observed(seen, "rows"), **counters.get()}
        return Loaded(report["rows"], report)
    report, new = publish_once(counted, table, load_id, lambda: {**observed(seen, "rows"), **counters.get()})
    return Loaded(report["rows"] if new else 0, report)


def load_gear_reviews(
    submissions: DataFrame,
    comments: DataFrame,
    table: str = GEAR_TABLE,
    load_id: str | None = None,
    **options: Any,
) -> Loaded:
    """Appends the reviews (options of ``build_gear_reviews``); the number of rows written.

    The comments are read once: the reviews are staged and counted on the way, and the staged
    files are removed afterwards. Without any review nothing is written to the table. With a
    ``load_id`` the same load adds its rows once; see ``publish_once``.
    """
    rows = conform(build_gear_reviews(submissions, comments, **options), GEAR_REVIEWS)
    seen = Observation()
    counted = rows.observe(seen, F.count(F.lit(1)).alias("rows"))
    if load_id is not None:
        report, new = publish_once(counted, table, load_id, lambda: observed(seen, "rows"))
        return Loaded(report["rows"] if new else 0, report)
    spark = rows.sparkSession
    staged = f"{shared_folder(spark)}/reviews-{uuid.uuid4().hex}"
    try:
        counted.write.parquet(staged)
        written = observed(seen, "rows")["rows"]
        if written:
            append(spark.read.schema(rows.schema).parquet(staged), table)
    finally:
        Folder(spark, staged).remove()
    return Loaded(written, {"rows": written})


def load_all(
    elements: DataFrame,
    submissions: DataFrame,
    comments: DataFrame,
    trails: dict[str, Any] | None = None,
    reviews: dict[str, Any] | None = None,
    load_id: str | None = None,
) -> dict[str, Loaded]:
    """Trails, then reviews. A failure of the trails stops the reviews; run again with the same
    ``load_id``, what was published before is left as it is."""
    same = {"load_id": load_id}
    written = {"trails": load_trails(elements, **(same | (trails or {})))}
    written["reviews"] = load_gear_reviews(submissions, comments, **(same | (reviews or {})))
    return written
