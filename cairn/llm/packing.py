"""Packing documents into sequences: cutting stock by column generation.

Documents are cut into whole sequences and one tail each. The tails' lengths, rounded up to a
grid, make a histogram of at most ``size / grid`` rows; that alone goes to the driver. There a
linear program over *patterns* (how many tails of each length share a sequence) is solved by
column generation: the simplex method keeps one pattern for each length, and a knapsack by
dynamic programming finds the pattern that its dual prices value most, until none is worth more
than a sequence. Patterns are used as many whole times as the solution says, the rest is filled
by largest first. Spark then ranks the pieces of each length (by document and place), and the
pieces of a rank take the place the patterns hold for it.

The histogram covers all documents, and the program's size does not grow with them. Ranks come
from counts of (length, bucket) with as many buckets as the root of the number of pieces, so a
length that a third of all pieces share is spread as well.

Defined results: null text counts as empty, and an empty text is one piece of the closing id;
documents of any length are cut; repeated ids are packed row by row; an empty table gives an
empty one. Only ``doc_id`` and ``text`` are read, so further columns can't clash.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cairn.llm.common import keep, map_rows, texts
from cairn.llm.token_counts import byte_pairs

SIZE = 2048
#: Tails count as lengths that are multiples of this: 3.5 tokens of padding a piece at most, on
#: average, and a linear program of 256 rows.
GRID = 8
STEPS = 6000


def cut(documents: DataFrame, tokenizer: str, end_id: int = 1, size: int = SIZE) -> DataFrame:
    """Pieces of at most ``size`` ids: ``doc_id, start, length, ids_crc32, doc_tokens``."""

    def run(rows: dict) -> dict:
        coder, made = byte_pairs(tokenizer), ([], [], [], [], [])
        for doc, text in zip(rows["doc_id"], rows["text"]):
            ids = np.append(coder.ids(text), np.uint32(end_id)).astype("<u4")
            for start in range(0, len(ids), size):
                piece = ids[start:start + size]
                for column, value in zip(made, (doc, start, len(piece), zlib.crc32(piece.tobytes()), len(ids))):
                    column.append(value)
        return dict(zip(("doc_id", "start", "length", "ids_crc32", "doc_tokens"), made))

    return map_rows(
        texts(documents),
        "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint", run)


def best_pattern(lengths: np.ndarray, prices: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The most valuable pattern that fits in ``room``: an unbounded knapsack."""
    best, choice = np.zeros(room + 1), np.full(room + 1, -1)
    for space in range(1, room + 1):
        fit = int(np.searchsorted(lengths, space, side="right"))
        best[space] = best[space - 1]
        if fit:
            worth = best[space - lengths[:fit]] + prices[:fit]
            top = int(worth.argmax())
            if worth[top] > best[space]:
                best[space], choice[space] = worth[top], top
    pattern, space = np.zeros(len(lengths)), room
    while space > 0:
        if choice[space] < 0:
            space -= 1
        else:
            pattern[choice[space]] += 1
            space -= lengths[choice[space]]
    return float(best[room]), pattern


def solve(lengths: np.ndarray, counts: np.ndarray, room: int, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (columns) and how often each is used in the linear program's solution.

    ``steps`` bounds the pivots; a solution stopped early is feasible too, only not the least.
    """
    columns = np.diag(room // lengths).astype(float)
    inverse = np.diag(1.0 / columns.diagonal())
    for step in range(steps):
        if step % 500 == 499:
            inverse = np.linalg.inv(columns)
        # Sums of products in place of matrix products: these are small, and threads of a linear
        # algebra library would only get in each other's way.
        used = (inverse * counts).sum(axis=1)
        worth, pattern = best_pattern(lengths, inverse.sum(axis=0), room)
        if worth <= 1 + 1e-7:
            break
        change = (inverse * pattern).sum(axis=1)
        able = change > 1e-9
        ratios = np.full(len(used), np.inf)
        ratios[able] = np.maximum(used[able], 0) / change[able]
        out = int(ratios.argmin())
        columns[:, out] = pattern
        row = inverse[out] / change[out]
        inverse -= np.outer(change, row)
        inverse[out] = row
    return columns, np.maximum(np.linalg.solve(columns, counts), 0)


def plan(lengths: list[int], counts: list[int], room: int) -> list[tuple[dict[int, int], int]]:
    """(pattern as length: number, times it is used), whole numbers that hold all pieces."""
    if not lengths:
        return []
    order = np.argsort(lengths)
    sizes, wanted = np.array(lengths)[order], np.array(counts, dtype=np.int64)[order]
    columns, used = solve(sizes, wanted.astype(float), room)
    out, left = [], wanted.copy()
    for pattern, times in zip(columns.T.astype(np.int64), np.floor(used + 1e-6).astype(np.int64)):
        held = pattern > 0
        times = min(int(times), int((left[held] // pattern[held]).min()))
        if times > 0:
            out.append((dict(zip(sizes[held].tolist(), pattern[held].tolist())), times))
            left = left - pattern * times
    while left.any():  # what rounding left over, largest first
        space, pattern = room, np.zeros_like(left)
        for i in range(len(sizes) - 1, -1, -1):
            pattern[i] = min(left[i], space // sizes[i])
            space -= pattern[i] * sizes[i]
        held = pattern > 0
        times = int((left[held] // pattern[held]).min())
        out.append((dict(zip(sizes[held].tolist(), pattern[held].tolist())), times))
        left = left - pattern * times
    return out


@dataclass
class Places:
    """For the pieces of one length: from which rank on a pattern takes them, how many of them
    are in each of its sequences, and its first sequence."""

    ranks: np.ndarray
    each: np.ndarray
    first: np.ndarray

    def sequences(self, ranks: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.ranks, ranks, side="right") - 1
        return self.first[at] + (ranks - self.ranks[at]) // self.each[at]


def places(patterns: list[tuple[dict[int, int], int]]) -> dict[int, Places]:
    rows: dict[int, list[tuple[int, int, int]]] = {}
    ranks: dict[int, int] = {}
    first = 0
    for pattern, times in patterns:
        for length, each in pattern.items():
            rows.setdefault(length, []).append((ranks.get(length, 0), each, first))
            ranks[length] = ranks.get(length, 0) + each * times
        first += times
    return {length: Places(*map(np.array, zip(*r))) for length, r in rows.items()}


def ranked(pieces: DataFrame) -> DataFrame:
    """The pieces with their ``rank`` (from 0) among those of the same ``units``."""
    total = pieces.count()
    buckets = max(1, math.isqrt(total))
    pieces = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start"), F.lit(buckets)))
    before = Window.partitionBy("units").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        pieces.groupBy("units", "bucket").agg(F.count("*").alias("n"))
        .select("units", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    )
    inside = Window.partitionBy("units", "bucket").orderBy("doc_id", "start", "ids_crc32")
    return (
        pieces.withColumn("rank", F.row_number().over(inside) - 1)
        .join(offsets, ["units", "bucket"])
        .withColumn("rank", F.col("rank") + F.col("before"))
        .drop("bucket", "before")
    )


def pack(
    documents: DataFrame, tokenizer: str, end_id: int = 1, size: int = SIZE, grid: int = GRID
) -> DataFrame:
    """Every piece of every document with its ``sequence_id`` and its ``offset`` there.

    ``size`` has to be a multiple of ``grid``.
    """
    if size % grid:
        raise ValueError("the size of sequences is no multiple of the grid")
    pieces = keep(cut(documents, tokenizer, end_id, size), "pieces").withColumn(
        "units", F.ceil(F.col("length") / grid).cast("int"))
    histogram = pieces.groupBy("units").count().collect()  # at most size / grid rows
    held = places(plan([r[0] for r in histogram], [r[1] for r in histogram], size // grid))

    def place(batches):
        for batch in batches:
            units = batch.column("units").to_numpy()
            ranks = batch.column("rank").to_numpy()
            out = np.zeros(len(units), dtype=np.int64)
            for unit in np.unique(units):
                mine = units == unit
                out[mine] = held[int(unit)].sequences(ranks[mine])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(out)], names=[*batch.schema.names, "sequence_id"])

    rows = ranked(pieces)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + ", sequence_id bigint"
    placed = rows.mapInArrow(place, schema)
    order = Window.partitionBy("sequence_id").orderBy(F.desc("units"), "rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    return placed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
        F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset"),
    )


def sequences(documents: DataFrame, packed: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    """The packed ids themselves: ``sequence_id`` and ``ids``, for documents with distinct ids."""

    def run(rows: dict) -> dict:
        coder, made = byte_pairs(tokenizer), []
        for text, start, length in zip(rows["text"], rows["start"], rows["length"]):
            made.append(np.append(coder.ids(text), np.uint32(end_id))[start:start + length].astype(np.int32))
        return {"sequence_id": rows["sequence_id"], "offset": rows["offset"], "ids": made}

    pieces = texts(documents).join(packed.select("doc_id", "start", "length", "sequence_id", "offset"), "doc_id")
    filled = map_rows(pieces, "sequence_id bigint, offset bigint, ids array<int>", run)
    return filled.groupBy("sequence_id").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda p: p["ids"])).alias("ids")
    )
