"""Trails: from map elements to one row per trail with a day of weather."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from cairn.functions.geo import line_centroid, line_wkt, place_key, polyline, trailhead
from cairn.functions.times import as_date, epoch_timestamp
from cairn.operators.enrich import (
    Fetch,
    attach_weather,
    fetched_weather,
    first_day,
    latest_record,
    without_records,
)
from cairn.operators.ordering import (
    all_segments,
    last_wins,
    longest_segment,
    processing_order,
)
from cairn.operators.selection import foot_trails, in_area, trail_tags
from cairn.schemas import EPOCH_VARIABLES, TRAIL_WEATHER
from cairn.session import observed, settle
from cairn.sinks.tables import conform
from cairn.vocab import TRAIL_AREA, WEATHER_BATCH, WEATHER_VARIABLES

Area = tuple[float, float, float, float]

_TAGS = ["surface", "trail_visibility", "sac_scale"]


def trail_segments(elements: DataFrame, area: Area | None = TRAIL_AREA) -> DataFrame:
    """Named foot trails: name, tags, landed points (``line``), ``n_points`` and ``ord``."""
    inside = in_area(elements, area) if area else elements
    return trail_tags(
        foot_trails(inside), "ord", "geometry AS line", "coalesce(size(geometry), 0) AS n_points"
    )


def drawable() -> Column:
    """Whether a line can be drawn: two points or more, all coordinates known."""
    known = F.forall("line", lambda p: p["lat"].isNotNull() & p["lon"].isNotNull())
    return (F.col("n_points") >= 2) & F.coalesce(known, F.lit(False))


class TrailCounters:
    """Counts trails while they are built, in the same pass: segments found, unique names, lines too
    short or with an unknown coordinate, coordinates and weather batches.

    ``get`` waits for the first action on the plan. Tasks that Spark runs again after an executor
    was lost count again, as all of its observed metrics do; ``trail_metrics`` counts exactly.
    """

    def __init__(self, batch_size: int = WEATHER_BATCH):
        self.batch_size = batch_size
        self._seen: list[tuple[Observation, tuple[str, ...]]] = []

    def _watch(self, rows: DataFrame, **counts: Column) -> DataFrame:
        self._seen.append((Observation(), tuple(counts)))
        return rows.observe(self._seen[-1][0], *(c.alias(n) for n, c in counts.items()))

    def segments(self, segments: DataFrame, deduplicate: bool) -> DataFrame:
        """All segments, before one per name is picked. Where all stay they are counted behind, as
        they are read twice."""
        if not deduplicate:
            return segments
        return self._watch(segments, segments=F.count(F.lit(1)), too_short=F.count_if(~drawable()))

    def picked(self, lines: DataFrame, deduplicate: bool) -> DataFrame:
        if deduplicate:
            return self._watch(lines, unique_names=F.count(F.lit(1)), coordinates=F.count_if(drawable()))
        return self._watch(
            lines, segments=F.count(F.lit(1)), unique_names=F.count_if(F.col("ord") == F.col("first_ord")),
            too_short=F.count_if(~drawable()), coordinates=F.count_if(drawable()))

    def get(self) -> dict[str, int]:
        found = {name: n for seen, names in self._seen for name, n in observed(seen, *names).items()}
        names = ("segments", "unique_names", "too_short", "coordinates")
        return {n: found[n] for n in names} | {"batches": -(-found["coordinates"] // self.batch_size)}


def located_lines(
    segments: DataFrame, deduplicate: bool = True, counters: TrailCounters | None = None
) -> DataFrame:
    """The longest segment per name, or all, with their centroids (``place``, ``lat``, ``lon``) and
    the columns of their processing order.

    Lines of fewer than two points, or with an unknown coordinate, drop out after they have
    counted for where their name first occurs.
    """
    pick = longest_segment if deduplicate else all_segments
    if counters:
        segments = counters.segments(segments, deduplicate)
    lines = pick(segments, ["line", *_TAGS])
    if counters:
        lines = counters.picked(lines, deduplicate)
    return lines.where(drawable()).withColumn("_c", line_centroid("line")).select(
        place_key("_c.lat", "_c.lon").alias("place"), "_c.lat", "_c.lon",
        "name", *_TAGS, "line", "first_ord", "ord",
    )


def located_trails(segments: DataFrame, deduplicate: bool = True) -> DataFrame:
    """One row per centroid: of several lines with the same one the last in processing order."""
    return last_on_place(located_lines(segments, deduplicate))


def last_on_place(lines: DataFrame) -> DataFrame:
    return last_wins(lines, ["place"], processing_order()).drop("first_ord", "ord")


def build_trails(
    elements: DataFrame,
    weather: DataFrame | None = None,
    weather_date: dt.date | str | None = None,
    deduplicate: bool = True,
    include_weather: bool = True,
    fetch: Fetch | None = None,
    batch_size: int = WEATHER_BATCH,
    area: Area | None = TRAIL_AREA,
    with_points: bool = False,
    ledger_folder: str | None = None,
    counters: TrailCounters | None = None,
) -> DataFrame:
    """Trails with tags, weather (unless left out) and ``geometry`` as (lon, lat) points.

    Weather comes from a landed table, or from ``fetch``, called with batches of (lat,
    lon), consecutive in processing order; the lines and the answers are then computed right
    away and kept in the shared folder. With ``ledger_folder`` answered batches are never asked
    again, see ``ordered_lookup``. Without either, and wherever both are silent, the variables are null.
    ``with_points`` adds ``centroid`` and ``trailhead``. ``counters`` count on the way.
    """
    if weather is not None and fetch is not None:
        raise ValueError("give landed weather or a fetch function, not both")
    lines = located_lines(trail_segments(elements, area), deduplicate, counters)
    if include_weather and fetch is not None:
        lines = settle(lines)
    trails = last_on_place(lines)
    columns = ["name", *_TAGS]
    if include_weather:
        if weather is not None:
            records = latest_record(first_day(weather, weather_date))
            trails = attach_weather(trails, records, weather_date)
        elif fetch is not None:
            records = fetched_weather(lines, fetch, weather_date, batch_size, ledger_folder)
            trails = attach_weather(trails, records, weather_date)
        else:
            trails = without_records(trails, weather_date)
        columns += ["weather_date", *WEATHER_VARIABLES]
    # Points are put in (lon, lat) order here, for the trails that are left.
    drawn = trails.withColumn("geometry", polyline("line"))
    extra = []
    if with_points:
        extra = [F.expr("struct(lat, lon) AS centroid"), trailhead("geometry").alias("trailhead")]
    return drawn.select(*columns, "geometry", *extra)


def trail_rows(trails: DataFrame, precision: int = 6) -> DataFrame:
    """Trails in the form of the result table: geometry as text, sun times as timestamps."""
    readers = {"weather_date": as_date} | {name: epoch_timestamp for name in EPOCH_VARIABLES}
    changed = {n: read(F.col(n)) for n, read in readers.items() if n in trails.columns}
    changed["geometry"] = line_wkt("geometry", precision)
    return conform(trails.withColumns(changed), TRAIL_WEATHER)


def trail_metrics(
    elements: DataFrame,
    deduplicate: bool = True,
    batch_size: int = WEATHER_BATCH,
    area: Area | None = TRAIL_AREA,
) -> DataFrame:
    """One row: segments found, unique names, lines too short or with an unknown coordinate
    (``too_short``), coordinates, weather batches.

    Counted per name first, so that a name of any size is one row per map task.
    """
    segments = trail_segments(elements, area)
    drawn = drawable()
    per_name = segments.groupBy("name").agg(
        F.count(F.lit(1)).alias("segments"),
        F.count_if(drawn).alias("drawn"),
    )
    coordinates = F.count_if(F.col("drawn") > 0) if deduplicate else F.coalesce(F.sum("drawn"), F.lit(0))
    return per_name.agg(
        F.coalesce(F.sum("segments"), F.lit(0)).alias("segments"),
        F.count(F.lit(1)).alias("unique_names"),
        F.coalesce(F.sum(F.col("segments") - F.col("drawn")), F.lit(0)).alias("too_short"),
        coordinates.alias("coordinates"),
    ).withColumn("batches", F.ceil(F.col("coordinates") / F.lit(batch_size)))
