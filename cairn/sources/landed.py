"""Landed weather and forum tables, read with explicit schemas."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from cairn.schemas import COMMENTS, SUBMISSIONS, WEATHER_DAILY
from cairn.session import settle


def read_weather(spark: SparkSession, path: str | list[str], fmt: str = "parquet") -> DataFrame:
    """Daily weather: a row per requested coordinate, an array per variable, and ``ord``, its
    order of arrival: by file path, then by place in the file.

    Only Parquet tells a row's place; for other formats land a column ``ord`` and read it
    with a schema of your own.
    """
    if fmt != "parquet":
        raise ValueError("the order of arrival can only be read from parquet")
    rows = spark.read.schema(WEATHER_DAILY).format(fmt).load(path)
    place = F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    return rows.withColumn("ord", place)


def read_submissions(
    spark: SparkSession, path: str | list[str], fmt: str = "parquet"
) -> DataFrame:
    """Forum submissions with their rank in the community's hot list."""
    return spark.read.schema(SUBMISSIONS).format(fmt).load(path)


def read_comments(spark: SparkSession, path: str | list[str], fmt: str = "parquet") -> DataFrame:
    """Forum comments, one row each, at any depth."""
    return spark.read.schema(COMMENTS).format(fmt).load(path)


def flatten_comments(threads: DataFrame, comments: str = "comments") -> DataFrame:
    """Nested threads (``submission_id``, array of comments with ``replies``) to flat rows.

    All levels of a thread are laid end to end, top level first, and exploded once. How
    deep the nesting goes is read off the schema; for JSON text of unknown depth, where a
    schema would cut replies off, see :func:`walk_comments`.
    """
    level, kind = F.col(comments), threads.schema[comments].dataType
    names = [f.name for f in _element(kind).fields if f.name != "replies"]
    levels = []
    while True:
        levels.append(F.transform(level, lambda c: F.struct(*(c[n].alias(n) for n in names))))
        nested = [f.dataType for f in _element(kind).fields if f.name == "replies"]
        if not nested:
            break
        level, kind = _replies(level, nested[0]), nested[0]
    empty = F.slice(levels[0], 1, 0)
    every = F.concat(*(F.coalesce(each, empty) for each in levels))
    rest = [c for c in threads.columns if c != comments]
    flat = threads.select(*rest, F.posexplode(every).alias("position", "_c"))
    return flat.select(*rest, "position", "_c.*")


def _element(array: ArrayType) -> StructType:
    return array.elementType


def _replies(level: Column, replies: ArrayType) -> Column:
    none = F.array().cast(replies)
    return F.flatten(F.transform(level, lambda c: F.coalesce(c["replies"], none)))


def walk_comments(threads: DataFrame, comments: str = "comments") -> DataFrame:
    """Nested threads at any depth to flat rows: ``comments`` is the JSON text of an array whose
    members carry their ``replies`` the same way.

    Each round takes one level apart and keeps the replies' own text for the next, until a
    level holds none; the driver only counts rounds. Adds ``depth``, from 0 at the top.
    """
    rest = [c for c in threads.columns if c != comments]
    fields = [f for f in COMMENTS.fields if f.name not in ("submission_id", "parent_id")]
    level = ArrayType(StructType([*fields, StructField("replies", StringType())]))
    waiting, levels, depth = threads.withColumnRenamed(comments, "_json"), [], 0
    while True:
        found = settle(
            waiting.where("_json IS NOT NULL")
            .select(*rest, F.explode(F.from_json("_json", level)).alias("_c"))
            .select(*rest, "_c.*")
        )
        if found.isEmpty() and levels:
            break
        levels.append(found.drop("replies").withColumn("depth", F.lit(depth)))
        waiting = found.select(*rest, F.col("replies").alias("_json"))
        depth += 1
    return functools.reduce(DataFrame.unionByName, levels)
