"""Element payloads of any size: one file is read by many tasks.

Spark's text reader splits a file into blocks and cuts records at ``separator``, a piece of text
that stands in every element. The cuts mean nothing by themselves: behind a quoted separator a
reader is always outside of a string, so only two things about a block's begin are unknown, how
deep it lies and whether the list around it is the ``elements``. A first scan notes for each block
how it changes the depth and which lists it opens; sums along a file tell every block's begin. The
second scan cuts the elements out; one that crosses blocks comes in pieces that are joined by their
places. Spark then parses each element apart.

A task holds one element and a buffer, never a file. Compressed files can't be split and are one
block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cairn.schemas import ELEMENT
from cairn.session import landed

SEPARATOR = '"type"'
#: Blocks whose begins are broadcast (about 150 bytes each); with more, records meet them by shuffle.
BROADCAST_BLOCKS = 500_000
#: Bytes of an unfinished object that are kept before it is read brace by brace.
UNFINISHED = 16 << 20

_BLOCKS = "file string, start bigint, n_bytes bigint, delta int, opened map<int, boolean>"
_PIECES = "file string, start bigint, pos bigint, part int, text string"


def _records(spark: SparkSession, path: str | list[str], separator: str) -> DataFrame:
    """The text between separators, by file and block, in their order within each block."""
    rows = spark.read.option("lineSep", separator).text(path)
    return rows.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.col("value").cast("binary").alias("data"))


def _scanner(separator: str) -> Callable:
    """The function that walks through a block. Nested, so that it travels to executors by value."""
    import re

    string = rb'"(?:[^"\\]++|\\.)*+"'
    flat = rb'[^{}"]++|' + string
    point = rb"\{(?:" + flat + rb")*+\}"
    member = rb"\{(?:" + flat + rb"|" + point + rb")*+\}"
    whole = rb"\{(?:" + flat + rb"|" + member + rb")*+\}"  # an element: two levels below it
    token = re.compile(rb"(?P<whole>" + whole + rb')|(?P<string>' + string + rb')|[{}\[\]"]', re.S)
    single = re.compile(rb'(?P<string>' + string + rb')|[{}\[\]"]', re.S)
    after_key, open_key = re.compile(rb"\s*:\s*"), re.compile(rb"\s*:?\s*")

    def walk(chunks: Iterator[bytes], depth: int, root: bool, found: Callable, opened: Callable, inside: bool = False):
        """Reads a block's chunks from ``depth`` on; ``root`` if that is known to be the true one.

        ``opened(level, elements)`` is told of each list or object and ``found(pos, text, part)`` of
        each element inside ``elements`` if the true depth is known: whole (0), its begin (1) or what
        continues one from an earlier block (2). Returns the depth at the end, and the length.
        """
        buffer, base, at, enough = b"", 0, 0, 0
        begun = 0 if root and depth > 2 and inside else None  # where the open element's text begins
        part = 2
        key = (-1, b"")  # the last string: its end and text

        def read(last: bool) -> None:
            nonlocal buffer, base, at, depth, inside, begun, part, key, enough
            while True:
                # The outermost object holds the elements, so it is never taken as a whole.
                match = (single if root and depth == 0 else token).search(buffer, at)
                if match is None:
                    at = len(buffer)
                    break
                mark = match.group()
                if mark == b'"' or mark == b"{" and not last and len(buffer) - match.start() < UNFINISHED:
                    at = match.start()  # goes on in the next chunk, or in the next block
                    if last:
                        at = len(buffer)
                    break
                begin, at = match.span()
                if match.lastgroup == "string":
                    key = (at, mark)
                elif match.lastgroup == "whole":
                    if root and depth == 2 and inside:
                        found(base + begin, mark, 0)
                elif mark in b"{[":
                    named = key[1] if key[0] >= 0 and after_key.fullmatch(buffer, key[0], begin) else b""
                    if root and depth == 2 and inside and mark == b"{":
                        begun, part = begin, 1
                    if root and depth == 1:
                        inside = mark == b"[" and named == b'"elements"'
                    opened(depth, mark == b"[" and named == b'"elements"')
                    depth += 1
                else:
                    depth -= 1
                    if root and depth == 2 and begun is not None:
                        found(base + begun, buffer[begun:at], 0 if part == 1 else 2)
                        begun = None
            keep = at if begun is None else begun
            if key[0] >= 0 and open_key.fullmatch(buffer, key[0]) and not last:
                keep = min(keep, key[0] - len(key[1]))
            buffer, base, at = buffer[keep:], base + keep, at - keep
            key = (key[0] - keep, key[1])
            begun = None if begun is None else begun - keep
            enough = 2 * len(buffer)  # an unfinished object is not searched again for every chunk

        for chunk in chunks:
            buffer += chunk
            if len(buffer) >= enough:
                read(False)
        read(True)
        if begun is not None:
            found(base + begun, buffer[begun:], part)
        return depth, base + len(buffer)

    mark = separator.encode()

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """``file, start`` and further columns of each block, with its chunks; to be used up in turn."""
        from itertools import groupby

        def rows():
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns))

        for about, records in groupby(rows(), key=lambda r: r[:2] + r[3:]):
            def chunks(records=records, first=about[1] == 0):
                waiting, size = [], 0
                for record in records:
                    waiting.append(record[2] if first else mark + record[2])
                    first, size = False, size + len(record[2])
                    if size > 1 << 20:
                        yield b"".join(waiting)
                        waiting, size = [], 0
                yield b"".join(waiting)

            yield about, chunks()

    return walk, blocks


def _block_ends(records: DataFrame, separator: str) -> DataFrame:
    """How each block changes the depth, and of the last list or object opened at each relative
    level whether it was ``elements``."""
    walk, blocks = _scanner(separator)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (file, start), chunks in blocks(batches):
            opened: dict[int, bool] = {}
            delta, size = walk(chunks, 0, start == 0, lambda *_: None, opened.__setitem__)
            yield pa.RecordBatch.from_arrays(
                [pa.array([file]), pa.array([start]), pa.array([size]), pa.array([delta], pa.int32()),
                 pa.array([list(opened.items())], pa.map_(pa.int32(), pa.bool_()))],
                names=["file", "start", "n_bytes", "delta", "opened"])

    return records.mapInArrow(run, _BLOCKS)


def _block_begins(ends: DataFrame) -> DataFrame:
    """``file, start`` and each block's place in the file, depth and whether it is inside the elements."""
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    summed = ends.withColumns({
        "base": F.coalesce(F.sum("n_bytes").over(before), F.lit(0)),
        "depth": F.coalesce(F.sum("delta").over(before), F.lit(0)).cast("int"),
    }).withColumn("own", F.try_element_at("opened", 1 - F.col("depth")))
    inside = F.coalesce(F.last("own", ignorenulls=True).over(before), F.lit(False))
    return summed.select("file", "start", "base", "depth", inside.alias("inside"))


def scan_elements(spark: SparkSession, path: str | list[str], separator: str = SEPARATOR) -> DataFrame:
    """One row per element of every file, like ``read_elements``; ``ord`` is (file, byte offset).

    The elements are landed once, when this is called, in the shared folder. ``separator`` must be
    quoted text that every element holds. A file whose braces do not balance, or an element that
    can't be parsed, fails the job; members of ``elements`` that are no objects are left out.
    """
    if not (len(separator) > 2 and separator[0] == separator[-1] == '"' and separator[1:-1].isalnum()):
        raise ValueError("the separator must be a quoted word")
    records = _records(spark, path, separator)
    ends = landed(_block_ends(records, separator), "blocks")
    broken = ends.groupBy("file").agg(F.sum("delta").alias("left")).where("left <> 0").first()
    if broken:
        raise ValueError(f"{broken.file} is no whole payload")
    begins = _block_begins(ends)
    few = ends.count() <= BROADCAST_BLOCKS
    keys, columns = ["file", "start"], ["file", "start", "data", "base", "depth", "inside"]
    if few:  # the records keep their order
        begun = records.join(F.broadcast(begins), keys).select(*columns)
    else:
        begun = (
            records.withColumn("_seq", F.monotonically_increasing_id()).join(begins, keys)
            .repartition(*keys).sortWithinPartitions(*keys, "_seq").select(*columns))
    walk, blocks = _scanner(separator)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["file", "start", "pos", "part", "text"]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            texts = pa.array([r[4] for r in rows], pa.binary()).cast(pa.string())
            first = [pa.array(c) for c in zip(*(r[:3] for r in rows))]
            return pa.RecordBatch.from_arrays([*first, pa.array([r[3] for r in rows], pa.int32()), texts], names=names)

        for (file, start, base, depth, inside), chunks in blocks(batches):
            rows: list[tuple] = []
            ready: list[pa.RecordBatch] = []

            def found(pos: int, text: bytes, part: int, rows=rows, file=file, start=start, base=base) -> None:
                rows.append((file, start, base + pos, part, text))

            def fed(chunks=chunks, rows=rows, ready=ready):
                for chunk in chunks:  # what was found in the chunks before leaves as a batch
                    if len(rows) >= 2000:
                        ready.append(batch_of(rows))
                        rows.clear()
                    yield chunk

            walk(fed(), depth, True, found, lambda *_: None, inside)
            yield from ready
            if rows:
                yield batch_of(rows)

    cut = begun.mapInArrow(run, _PIECES)
    element = F.from_json("text", ELEMENT, {"mode": "FAILFAST"})
    parsed = landed(
        cut.withColumns({
            "element": F.when(F.col("part") == 0, element), "text": F.when(F.col("part") != 0, F.col("text"))}),
        "elements")
    # Pieces: at most two a block. Those of an element follow its begin, up to the next begin.
    so_far = Window.partitionBy("file").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    joined = (
        parsed.where("part <> 0").withColumn("first", F.max(F.when(F.col("part") == 1, F.col("pos"))).over(so_far))
        .groupBy("file", F.col("first").alias("pos"))
        .agg(F.array_sort(F.collect_list(F.struct(F.col("pos").alias("at"), "text"))).alias("pieces"))
        .withColumn("text", F.array_join(F.transform("pieces", lambda p: p["text"]), ""))
        .select("file", "pos", element.alias("element"))
    )
    every = parsed.where("part = 0").select("file", "pos", "element").unionByName(joined)
    return every.select(
        F.struct(F.col("file").alias("payload"), "pos").alias("ord"), *(f"element.{n}" for n in ELEMENT.names))
