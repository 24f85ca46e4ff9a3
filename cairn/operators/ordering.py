"""Jobs whose result hangs on the order of their input, carried as an ``ord`` column.

``ord`` may be any orderable value that is unique per row: an integer, or a struct of
payload and position.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairn.session import settle

# Parts a name's segments are salted into.
SALTS = 4096


def last_wins(rows: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    """One row per key: the last in order.

    An aggregate, not a window: every map task reduces a key to one row before the
    shuffle, however many rows the key has.
    """
    rest = [c for c in rows.columns if c not in keys]
    best = F.max_by(F.struct(*rest), order).alias("_best")
    return rows.groupBy(*keys).agg(best).select(*keys, "_best.*").select(*rows.columns)


def longest_segment(segments: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Per ``name`` the segment with most points (``n_points``), the first one on ties.

    ``first_ord`` is where the name first occurs among *all* its segments.
    """
    best = F.min_by(F.struct("ord", "n_points", *keep), F.struct(-F.col("n_points"), "ord"))
    return (
        segments.groupBy("name")
        .agg(F.min("ord").alias("first_ord"), best.alias("_best"))
        .select("name", "first_ord", "_best.*")
    )


def all_segments(segments: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Every segment, with ``first_ord``: where its name first occurs.

    Segments never gather by name alone: a name is salted into parts, each part gives its
    first place, the first of a name's at most ``SALTS`` parts is handed to all of them,
    and segments meet their part. Adaptive execution would not split a plain join back,
    because it leaves joins with an aggregate on one side as they are.
    """
    salted = segments.withColumn("_salt", F.pmod(F.xxhash64("ord"), F.lit(SALTS)))
    parts = salted.groupBy("name", "_salt").agg(F.min("ord").alias("_first"))
    whole = F.min("_first").over(Window.partitionBy("name"))
    first = parts.select("name", "_salt", whole.alias("first_ord"))
    return salted.join(first, ["name", "_salt"]).select(
        "name", "first_ord", "ord", "n_points", *keep
    )


def processing_order() -> Column:
    """Names by first occurrence, then the segments of a name in payload order."""
    return F.struct("first_ord", "ord")


def with_index(rows: DataFrame, order: str | Column, index: str = "index") -> DataFrame:
    """Numbers rows 0, 1, 2… by an orderable column or struct, nulls first, without a global
    window: ranges of rows are sorted apart, and each starts at the sum of the sizes before it.

    The sorted rows are kept, so that their numbers hold. ``rows`` is read twice (once to find
    the ranges); settle it before if it is a costly plan.
    """
    key = F.col(order) if isinstance(order, str) else order
    context = rows.sparkSession.sparkContext
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), context.defaultParallelism)
    placed = settle(
        rows.withColumn("_key", key)
        .repartitionByRange(parts, "_key").sortWithinPartitions("_key").drop("_key")
        .withColumn("_at", F.monotonically_increasing_id())
    ).withColumn("_part", F.shiftright("_at", 33))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select(  # a row a partition
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = F.col("_at") - F.shiftleft("_part", 33)
    return placed.join(starts, "_part").withColumn(index, F.col("_start") + inside).drop("_part", "_at", "_start")


def request_batches(rows: DataFrame, order: str | Column, batch_size: int) -> DataFrame:
    """Consecutive batches in order: adds ``batch_id`` and ``batch_pos``, both from 0.

    ``order`` is a column or a struct, like :func:`processing_order`; null orders come first."""
    if batch_size < 1:
        raise ValueError("batch_size must be positive")
    size = F.lit(batch_size).cast("long")
    return (
        with_index(rows, order, "_index")
        .withColumn("batch_id", F.floor(F.col("_index") / size))
        .withColumn("batch_pos", F.col("_index") % size)
        .drop("_index")
    )
