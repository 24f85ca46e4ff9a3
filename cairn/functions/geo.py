"""Line geometry as ``array<struct<lon, lat>>``: build, centroid, text form (EPSG:4326).

Arguments are SQL expressions, mostly a column name. A lambda built from Python columns
costs the driver dozens of round trips to the JVM; a text costs one.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def polyline(geometry: str) -> Column:
    """(lon, lat) points in payload order."""
    return F.expr(f"transform({geometry}, p -> struct(p.lon AS lon, p.lat AS lat))")


def trailhead(line: str) -> Column:
    """The first point."""
    return F.expr(f"get({line}, 0)")


def line_centroid(line: str) -> Column:
    """``struct<lat, lon>``: segment midpoints weighted by segment length, in the plane.

    A line without length has its first point as centroid; one without points, null.
    Sums run left to right, so equal lines give bit-equal centroids.
    """
    count = f"greatest(size({line}) - 1, 0)"
    segments = f"""zip_with(slice({line}, 1, {count}), slice({line}, 2, {count}), (p, q) -> struct(
        sqrt((q.lon - p.lon) * (q.lon - p.lon) + (q.lat - p.lat) * (q.lat - p.lat)) AS length,
        (p.lon + q.lon) / 2 AS lon,
        (p.lat + q.lat) / 2 AS lat))"""
    totals = """s -> struct(
        aggregate(s, 0D, (sum, e) -> sum + e.length) AS length,
        aggregate(s, 0D, (sum, e) -> sum + e.length * e.lon) AS lon,
        aggregate(s, 0D, (sum, e) -> sum + e.length * e.lat) AS lat)"""
    centroid = f"""t -> if(t.length > 0,
        struct(t.lat / t.length AS lat, t.lon / t.length AS lon),
        struct(get({line}, 0).lat AS lat, get({line}, 0).lon AS lon))"""
    # The one-element array names an intermediate value, so that it is computed once.
    whole = f"get(transform(transform(array({segments}), {totals}), {centroid}), 0)"
    return F.expr(f"if(size({line}) > 0, {whole}, NULL)")


def place_key(lat: str, lon: str) -> Column:
    """The exact coordinate as text, equal for equal numbers (and for 0.0 and -0.0).

    Spark wraps floating-point join keys, and then no longer sees that their rows are
    already partitioned by them; a text key is shuffled once for grouping and joining.
    """
    return F.expr(f"concat(CAST({lat} + 0D AS STRING), ' ', CAST({lon} + 0D AS STRING))")


def line_wkt(line: str, precision: int = 6) -> Column:
    """``LINESTRING (lon lat, …)``, trailing zeros cut.

    ``format_number`` rounds the exact binary value; ``format_string`` and decimal
    casts round its shortest decimal form, which differs in the last place for many
    coordinates of seven decimals.
    """
    pattern = "0." + "#" * precision if precision > 0 else "0"
    point = f"concat(format_number(p.lon, '{pattern}'), ' ', format_number(p.lat, '{pattern}'))"
    return F.expr(
        f"concat('LINESTRING (', array_join(transform({line}, p -> {point}), ', '), ')')"
    )
