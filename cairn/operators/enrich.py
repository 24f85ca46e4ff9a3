"""Attaching data to keys: landed weather, or a user's lookup in batches."""

from __future__ import annotations

import datetime as dt
import functools
import logging
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from cairn.functions.geo import place_key
from cairn.functions.times import day_or_yesterday
from cairn.operators import ledger
from cairn.operators.ordering import last_wins, processing_order, request_batches
from cairn.schemas import WEATHER_RECORD
from cairn.session import settle
from cairn.vocab import WEATHER_BATCH, WEATHER_VARIABLES

Fetch = Callable[[list[tuple]], Sequence[dict | None]]


def first_day(weather: DataFrame, day: dt.date | str | None = None) -> DataFrame:
    """Landed daily weather to one record per row: every variable's value of the asked day.

    The day may stand anywhere in ``daily.time``. Variables without a value are null. Rows
    without the asked day drop out; rows whose first day is not named count as the asked one.
    """
    asked = day_or_yesterday(day)
    unnamed = F.expr("get(daily.time, 0)").isNull()
    at = F.when(unnamed, 0).otherwise(F.array_position("daily.time", asked) - 1).cast("int")
    found = weather.withColumn("_at", at).where("_at >= 0").withColumn("weather_date", asked)
    return found.selectExpr(
        "latitude AS lat",
        "longitude AS lon",
        "weather_date",
        *(f"get(daily.{v}, _at) AS {v}" for v in WEATHER_VARIABLES),
        *(c for c in weather.columns if c == "ord"),
    )


def latest_record(records: DataFrame) -> DataFrame:
    """One record per coordinate (adds ``place``): the last by ``ord``, its order of arrival."""
    if "ord" not in records.columns:
        raise ValueError("weather needs its order of arrival, a column ord; see read_weather")
    placed = records.withColumn("place", place_key("lat", "lon"))
    return last_wins(placed, ["place"], F.col("ord")).drop("ord")


def attach_weather(
    trails: DataFrame, records: DataFrame, day: dt.date | str | None = None
) -> DataFrame:
    """Left join on the exact coordinate. Misses get null variables but the asked date.

    No join hint: both sides have one row per ``place``, and the sizes decide. A shuffled
    join finds both sides partitioned already.
    """
    dated = F.coalesce("weather_date", day_or_yesterday(day)).alias("weather_date")
    return trails.join(records.drop("lat", "lon"), "place", "left").select(
        *trails.columns, dated, *WEATHER_VARIABLES
    )


def without_records(trails: DataFrame, day: dt.date | str | None = None) -> DataFrame:
    """What :func:`attach_weather` gives when there is no record at all."""
    return trails.withColumn("weather_date", day_or_yesterday(day)).selectExpr(
        "*",
        *(
            f"CAST(NULL AS {WEATHER_RECORD[v].dataType.simpleString()}) AS {v}"
            for v in WEATHER_VARIABLES
        ),
    )


def batched_lookup(
    keys: DataFrame,
    fetch: Fetch,
    fields: StructType,
    batch_size: int = WEATHER_BATCH,
    ledger_folder: str | None = None,
) -> DataFrame:
    """Calls ``fetch`` with lists of ``batch_size`` keys; one row per answered key.

    ``keys`` holds only the key columns, which lead in ``fields``. Answers are
    positional dicts; surplus ones are ignored, and a batch that fails loses its own
    keys only. Batches are filled across Arrow chunks inside a partition; only the
    last one of a partition may be short.

    Without a ledger the lookup is part of the plan, and a rerun task asks again. With one the
    requests go out when this is called; keys that it has are not asked, whatever run or task
    attempt asked them, and those of failed batches are open for the next call.
    """
    if batch_size < 1:
        raise ValueError("batch_size must be positive")
    if ledger_folder is not None:
        return _resumed_lookup(keys, fetch, fields, batch_size, ledger_folder)
    names = fields.names
    value_names = names[len(keys.columns):]

    def ask(batch: list[tuple]) -> list[tuple]:
        try:
            return [
                key + tuple(answer.get(v) for v in value_names)
                for key, answer in zip(batch, fetch(batch))
                if answer is not None
            ]
        except Exception as error:
            logging.getLogger("cairn").warning("lookup of %d keys failed: %s", len(batch), error)
            return []

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: list[tuple] = []
        for frame in frames:
            waiting += zip(*(frame[c].tolist() for c in frame.columns))
            full = len(waiting) - len(waiting) % batch_size
            rows = [
                row
                for start in range(0, full, batch_size)
                for row in ask(waiting[start:start + batch_size])
            ]
            waiting = waiting[full:]
            yield pd.DataFrame(rows, columns=names, dtype=object)
        if waiting:
            yield pd.DataFrame(ask(waiting), columns=names, dtype=object)

    return keys.mapInPandas(run, fields)


def _resumed_lookup(
    keys: DataFrame, fetch: Fetch, fields: StructType, batch_size: int, folder: str
) -> DataFrame:
    spark, names = keys.sparkSession, keys.columns
    folder = ledger.opened(folder)

    def same(rows: DataFrame) -> Column:
        return functools.reduce(Column.__and__, (keys[n].eqNullSafe(rows[n]) for n in names))

    known = ledger.entries(spark, folder, fields).select(*names).distinct()
    open_keys = keys.join(known, same(known), "left_anti")
    _ask_all(_packed(open_keys, batch_size), fetch, fields, len(names), folder)
    answered = ledger.entries(spark, folder, fields).where(ledger.ANSWERED)
    answered = answered.select(*fields.names).dropDuplicates(names)
    return keys.join(answered, same(answered)).select(*(answered[n] for n in fields.names))


def _packed(keys: DataFrame, batch_size: int) -> DataFrame:
    """Each partition's keys in lists (``members``) of ``batch_size``; kept, so that a task that runs
    anew sees the same ones."""
    kind = T.ArrayType(T.StructType(keys.schema.fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[dict] = []
        for batch in batches:
            waiting += batch.to_pylist()
            full = len(waiting) - len(waiting) % batch_size
            made = [waiting[i:i + batch_size] for i in range(0, full, batch_size)]
            waiting = waiting[full:]
            yield pa.RecordBatch.from_arrays([pa.array(made, members)], names=["members"])
        if waiting:
            yield pa.RecordBatch.from_arrays([pa.array([waiting], members)], names=["members"])

    members = to_arrow_type(kind)
    return settle(keys.mapInArrow(run, T.StructType([T.StructField("members", kind)])))


def _ask_all(
    batches: DataFrame, fetch: Fetch, fields: StructType, keys: int, folder: str
) -> None:
    """Asks every batch (``members``) the ledger does not have; the requests go out now."""
    ask = ledger.asking(fetch, fields.names, keys, fields, folder)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            done = [
                ask(digest, [tuple(m.values()) for m in members])
                for digest, members in zip(*(c.to_pylist() for c in part.columns))
            ]
            yield pa.RecordBatch.from_arrays([pa.array(done, pa.bool_())], names=["done"])

    named = batches.select(ledger.digest(F.col("members")), "members")
    named.mapInArrow(run, "done boolean").write.format("noop").mode("overwrite").save()


def ordered_lookup(
    keys: DataFrame,
    order: Column,
    fetch: Fetch,
    fields: StructType,
    batch_size: int = WEATHER_BATCH,
    ledger_folder: str | None = None,
) -> DataFrame:
    """Like :func:`batched_lookup`, but the batches are consecutive in ``order`` over all keys, so
    only the very last one may be short. Adds ``batch_id`` and ``batch_pos``.

    ``keys`` may hold other columns; those named in ``fields``, where they lead, are the key. The
    batches are numbered and kept when this is called. With a ledger the requests go out then as
    well: a batch is asked once, and a later call with the same keys asks only those that failed.
    """
    names = [n for n in fields.names if n in keys.columns]
    if names != fields.names[:len(names)]:
        raise ValueError("the key columns must lead in fields")
    placed = request_batches(keys, order, batch_size)
    member = F.struct(*names)
    batches = settle(
        placed.groupBy("batch_id")  # at most batch_size rows each
        .agg(F.array_sort(F.collect_list(F.struct("batch_pos", member.alias("member")))).alias("_m"))
        .select("batch_id", F.transform("_m", lambda m: m["member"]).alias("members"))
    )
    if ledger_folder is not None:
        spark, folder = keys.sparkSession, ledger.opened(ledger_folder)
        named = batches.withColumn(ledger.BATCH, ledger.digest(F.col("members")))
        known = ledger.entries(spark, folder, fields).select(ledger.BATCH).distinct()
        _ask_all(named.join(known, ledger.BATCH, "left_anti").select("members"), fetch, fields, len(names), folder)
        answered = ledger.entries(spark, folder, fields).where(ledger.ANSWERED)
        return named.select("batch_id", ledger.BATCH).join(answered, ledger.BATCH).select(
            *fields.names, "batch_id", F.col(ledger.PLACE).cast("long").alias("batch_pos"))
    value_names, added = fields.names[len(names):], T.StructType([
        *fields.fields, T.StructField("batch_id", T.LongType()), T.StructField("batch_pos", T.LongType())])
    kinds = [to_arrow_type(f.dataType) for f in added]

    def ask(batch_id: int, batch: list[tuple]) -> list[tuple]:
        try:
            return [
                key + tuple(answer.get(v) for v in value_names) + (batch_id, i)
                for i, (key, answer) in enumerate(zip(batch, fetch(batch)))
                if answer is not None
            ]
        except Exception as error:
            logging.getLogger("cairn").warning("lookup of %d keys failed: %s", len(batch), error)
            return []

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            rows = [
                row
                for batch_id, members in zip(*(c.to_pylist() for c in part.columns))
                for row in ask(batch_id, [tuple(m.values()) for m in members])
            ]
            columns = zip(*rows) if rows else ([] for _ in kinds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), kind) for c, kind in zip(columns, kinds)], names=added.names)

    return batches.mapInArrow(run, added)


def fetched_weather(
    places: DataFrame,
    fetch: Fetch,
    day: dt.date | str | None = None,
    batch_size: int = WEATHER_BATCH,
    ledger_folder: str | None = None,
) -> DataFrame:
    """Weather records from a user's ``fetch``, one for each ``place`` that has an answer.

    ``places`` has a row for each trail that is asked for (``lat``, ``lon`` and the columns of
    ``processing_order``): requests are consecutive in that order, a coordinate that several
    trails share is asked for each of them, and its last answer holds. Records are keyed by the
    coordinate asked for, never by one the service returns. The requests go out when this is
    called, once: the records are kept.
    """
    records = settle(
        ordered_lookup(places, processing_order(), fetch, WEATHER_RECORD, batch_size, ledger_folder)
        .withColumn("place", place_key("lat", "lon")))
    last = last_wins(records, ["place"], F.struct("batch_id", "batch_pos"))
    return last.drop("batch_id", "batch_pos").withColumn(
        "weather_date", F.coalesce("weather_date", day_or_yesterday(day)))
