"""Removal of repeated lines or paragraphs, by hashing.

Texts are split into units: lines, or paragraphs (at empty lines). A unit is normalised (lower
case, one blank between words) and counts if it has ``least_words`` words or more. Of the units
with the same digest, over all documents, the earliest stays: the one of the document first in
rank, and there the first in the text. The others are removed; their places in the original
text, in characters, are kept.

A passage may also stand inside longer lines. So sentences are hashed as well, and a run of
neighbouring sentences that all have an earlier occurrence is removed when it has ``RUN_WORDS``
words or more; sentences of fewer than ``SHORT`` words don't interrupt a run.

``passages`` needs no sentences: every window of ``PASSAGE`` words that stands earlier, in any text,
is removed. The smallest hash of the ``ANCHOR``-word runs in a window is its anchor, so equal windows
have equal anchors. Neighbouring windows with their anchor at the same place are a stretch, one row
with a digest of all their hashes; only stretches whose anchor stands twice are compared. Of equal
stretches all but the earliest are repeated, window by window; of the earliest, windows are compared
one by one, if other stretches have the same anchor. Every removed word stands in an equal window
before it, so a first occurrence stays, word for word, though it can be spread over the texts that
hold its parts first.

A digest many units share is reduced in the map tasks to its earliest, and units are joined to
these rows, where adaptive execution can split a hot digest.

Defined results: null texts stay null and have no units; texts of any length are taken whole;
copies under other ids count as later occurrences, in the order of the rank, then of the id, then of
the text's hash. Rows of one id, or without one, are told apart by their texts (``text_key``); rows
equal in id and text are one document: each keeps or loses the same units. Null ranks and ids come
last; an empty table gives an empty one. Further columns are kept by ``remove`` whatever their names;
names that begin with ``_rep_`` are the operator's.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairn.llm.common import KEY, keep, map_rows, same_document, text_key
from cairn.llm.near_duplicates import mixed, word_hashes

LEAST_WORDS = 10
#: Words of repeated sentences in a row that are removed, and of the shortest sentence that counts.
RUN_WORDS, SHORT = 25, 3
#: Words of a passage that is removed wherever it stands, and of the runs that are its anchors.
PASSAGE, ANCHOR = 50, 16
LINES, PARAGRAPHS = "\n", r"\n[^\S\n]*\n\s*"


SENTENCES = re.compile(r"[^.!?\n]*[.!?\n]+|[^.!?\n]+")
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
#: What is told of a span to remove.
SPAN = ("doc_id", KEY, "level", "begin", "end", "next", "n_words", "kept_doc_id", "kept_begin")


def spans(text: str, breaks: re.Pattern) -> Iterator[tuple[int, int, int]]:
    """Begin and end of each unit, and where the next begins, behind the break."""
    begin = 0
    for match in breaks.finditer(text):
        yield begin, match.start(), match.end()
        begin = match.end()
    yield begin, len(text), len(text)


def source_of(documents: DataFrame, rank: str) -> DataFrame:
    return documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), text_key().alias(KEY),
        F.col(rank).cast("bigint").alias("rank"), F.col("text").cast("string").alias("text"))


def units(documents: DataFrame, rank: str = "doc_id", least_words: int = LEAST_WORDS, breaks: str = LINES) -> DataFrame:
    """Each unit that counts: ``rank, doc_id, text_key, begin, end, next, n_words, digest``."""
    pattern = re.compile(breaks)

    def run(rows: dict) -> dict:
        names = ("rank", "doc_id", KEY, "begin", "end", "next", "n_words", "digest")
        made: dict[str, list] = {n: [] for n in names}
        for doc, own, order, text in zip(rows["doc_id"], rows[KEY], rows["rank"], rows["text"]):
            for begin, end, after in spans(text or "", pattern):
                found = WORDS.findall((text or "")[begin:end].lower())
                if len(found) >= least_words:
                    same = " ".join(found).encode("utf-8", "surrogatepass")
                    digest = hashlib.blake2b(same, digest_size=16).digest()
                    for name, value in zip(names, (order, doc, own, begin, end, after, len(found), digest)):
                        made[name].append(value)
        return made

    source = source_of(documents, rank)
    return map_rows(
        source,
        f"rank bigint, doc_id bigint, {KEY} bigint, begin int, end int, next int, n_words int, digest binary", run)


def sentences(documents: DataFrame, rank: str = "doc_id") -> DataFrame:
    """Sentences of ``SHORT`` words or more: ``rank, doc_id, text_key, place, begin, next, n_words, digest``.
    ``place`` counts them in their text. The digest has 64 bits: one of them alone removes
    nothing."""
    import xxhash

    def run(rows: dict) -> dict:
        names = ("rank", "doc_id", KEY, "place", "begin", "next", "n_words", "digest")
        made: dict[str, list] = {n: [] for n in names}
        for doc, own, order, text in zip(rows["doc_id"], rows[KEY], rows["rank"], rows["text"]):
            begin, place = 0, 0
            for part in SENTENCES.findall(text or ""):
                found = WORDS.findall(part.lower())
                if len(found) >= SHORT:
                    digest = xxhash.xxh3_64_intdigest(" ".join(found).encode("utf-8", "surrogatepass"))
                    values = (order, doc, own, place, begin, begin + len(part), len(found), digest - (1 << 63))
                    for name, value in zip(names, values):
                        made[name].append(value)
                    place += 1
                begin += len(part)
        return made

    source = source_of(documents, rank)
    return map_rows(
        source,
        f"rank bigint, doc_id bigint, {KEY} bigint, place int, begin int, next int, n_words int, digest bigint", run)


def order(rank: str, *more: str) -> Column:
    """What comes first: by rank, then by id, the text's hash and the place."""
    by_rank = [] if rank == "doc_id" else [F.col("rank").isNull().alias("last"), F.col("rank")]
    return F.struct(*by_rank, F.col("doc_id").isNull().alias("no_id"), "doc_id", KEY, "begin", *more)


def later(found: DataFrame, rank: str) -> DataFrame:
    """The units that are not the earliest of their digest, with the earliest (``first``)."""
    first = keep(  # as a table, so that the join shuffles both sides and a hot digest is split
        found.groupBy("digest").agg(F.min(order(rank)).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1").select("digest", "first"), "firsts")
    return found.join(first, "digest").where(order(rank) != F.col("first")).withColumns({
        "kept_doc_id": F.col("first.doc_id"), "kept_begin": F.col("first.begin")}).drop("first", "digest", "rank")


def repeats(
    documents: DataFrame, rank: str = "doc_id", least_words: int = LEAST_WORDS, breaks: str = LINES,
    run_words: int = RUN_WORDS,
) -> DataFrame:
    """Each span to remove: ``doc_id, text_key, level, begin, end, next, n_words, kept_doc_id,
    kept_begin``, of ``level`` ``unit`` or ``run``. Spans of the two levels may overlap."""
    lines = later(keep(units(documents, rank, least_words, breaks), "units"), rank).dropDuplicates(
        ["doc_id", KEY, "begin"]).withColumn("level", F.lit("unit")).select(*SPAN)
    # Neighbours in a text have places one apart; the difference to their rank names the run.
    inside = Window.partitionBy("doc_id", KEY).orderBy("place")
    runs = (
        later(keep(sentences(documents, rank), "sentences"), rank)
        .withColumn("copy", F.coalesce(F.lag("place").over(inside) == F.col("place"), F.lit(False)))
        .withColumn("run", F.col("place") - F.dense_rank().over(inside))
        .where("not copy")  # of a row equal in id and text
        .groupBy("doc_id", KEY, "run").agg(
            F.min("begin").alias("begin"), F.max("next").alias("next"), F.sum("n_words").cast("int").alias("n_words"),
            F.min_by(F.struct("kept_doc_id", "kept_begin"), "place").alias("first"))
        .where(F.col("n_words") >= run_words)
        .select("*", "first.*", F.lit("run").alias("level"), F.col("next").alias("end")).select(*SPAN)
    )
    return lines.unionByName(runs)


def joined_hashes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mixed(a * np.uint64(0x9E3779B97F4A7C15) + b)


def windows(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each window of ``PASSAGE`` words the anchor, the word where that begins, and the hash. All
    are empty for a text with fewer words than a window."""
    known = word_hashes()
    get = known.new.get
    hashes = np.array(
        [get(w) or known(w) for w in text.lower().encode("utf-8", "surrogatepass").split()], dtype=np.uint64)
    if len(hashes) < PASSAGE:
        return (np.empty(0, np.int64),) * 3
    size = 1
    while size < ANCHOR:  # a power of two
        hashes = joined_hashes(hashes[:-size], hashes[size:])
        size *= 2
    runs = hashes
    while 2 * size <= PASSAGE:
        hashes = joined_hashes(hashes[:-size], hashes[size:])
        size *= 2
    rest = PASSAGE - size  # two runs that overlap make a window
    whole = joined_hashes(hashes[:len(hashes) - rest], hashes[rest:])
    inside = np.lib.stride_tricks.sliding_window_view(runs, PASSAGE - ANCHOR + 1)
    at = np.arange(len(inside)) + inside.argmin(axis=1)
    return runs[at].view(np.int64), at, whole.view(np.int64)


def word_places(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The begin of each word, and its end behind the blanks that follow it, in characters."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    blank = (codes == 0x20) | (codes == 0x09)
    space = np.concatenate(([True], blank | ((codes > 0x09) & (codes < 0x0E)), [True]))
    edges = np.flatnonzero(space[1:] != space[:-1])
    stops = np.flatnonzero(np.concatenate((~blank, [True])))
    return edges[::2], stops[np.searchsorted(stops, edges[1::2])]


def table_of(parts: list[tuple], *names: str) -> dict:
    """Columns of the parts; each begins with rank, id and key, and goes on with arrays."""
    made: dict = {n: [] for n in ("rank", "doc_id", KEY)}
    for part in parts:
        for name, value in zip(made, part):
            made[name] += [value] * len(part[3])
    some = [*zip(*(p[3:] for p in parts))] or [()] * len(names)
    return made | {n: np.concatenate([np.empty(0, np.int64), *arrays]) for n, arrays in zip(names, some)}


def stretches(documents: DataFrame, rank: str = "doc_id") -> DataFrame:
    """The windows of every text that share an anchor's place, as one row: ``rank, doc_id, text_key,
    place, n, begin, next, anchor, digest`` of ``n`` windows from the word ``place`` on."""
    def run(rows: dict) -> dict:
        parts = []
        for doc, own, order, text in zip(*(rows[n] for n in ("doc_id", KEY, "rank", "text"))):
            its, at, whole = windows(text or "")
            if not len(its):
                continue
            begins, ends = word_places(text)
            first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
            many = np.diff(np.append(first, len(at)))
            offsets = np.arange(len(at)) - np.repeat(first, many)
            digest = np.add.reduceat(joined_hashes(whole.view(np.uint64), offsets.astype(np.uint64)), first)
            parts.append((
                order, doc, own, first, many, begins[first], ends[first + many - 1 + PASSAGE - 1], its[first],
                digest.view(np.int64)))
        return table_of(parts, "place", "n", "begin", "next", "anchor", "digest")

    return map_rows(
        source_of(documents, rank),
        f"rank bigint, doc_id bigint, {KEY} bigint, place int, n int, begin int, next int, anchor bigint, digest bigint", run)


def windows_of(documents: DataFrame, asked: DataFrame, rank: str) -> DataFrame:
    """Every window of the stretches ``asked``: ``rank, doc_id, text_key, place, begin, next, digest``."""
    def run(rows: dict) -> dict:
        parts = []
        for doc, own, order, text, some in zip(*(rows[n] for n in ("doc_id", KEY, "rank", "text", "stretches"))):
            _, _, whole = windows(text or "")
            begins, ends = word_places(text or "")
            place = np.concatenate([np.arange(s["place"], s["place"] + s["n"]) for s in some])
            parts.append((order, doc, own, place, begins[place], ends[place + PASSAGE - 1], whole[place]))
        return table_of(parts, "place", "begin", "next", "digest")

    source = source_of(documents, rank)
    source = source.join(asked, same_document(source, asked)).select(*(source[c] for c in source.columns), "stretches")
    return map_rows(
        source, f"rank bigint, doc_id bigint, {KEY} bigint, place int, begin int, next int, digest bigint", run)


def passages(documents: DataFrame, rank: str = "doc_id") -> DataFrame:
    """The spans of ``PASSAGE`` words or more that stand earlier, as ``repeats`` gives them, of
    ``level`` ``passage``."""
    every = keep(stretches(documents, rank), "stretches")
    twice = keep(every.groupBy("anchor").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("anchor"), "twice")
    found = keep(every.join(twice, "anchor"), "found")
    place = order(rank, "place")
    distinct = keep(
        found.groupBy("anchor", "digest").agg(
            F.min(place).alias("first"), F.max("n").alias("n"), F.count(F.lit(1)).alias("times"))
        .select("*", F.col("first.doc_id").alias("doc_id"), F.col(f"first.{KEY}").alias(KEY), F.col("first.place").alias("place")),
        "distinct")
    # Windows can be equal in unequal stretches, if those have the same anchor.
    mixed_ = distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1").select("anchor")
    asked = keep(
        distinct.join(mixed_, "anchor").groupBy("doc_id", KEY).agg(F.collect_list(F.struct("place", "n")).alias("stretches")),
        "asked")
    again = keep(
        later(keep(windows_of(documents, asked, rank), "windows"), rank).withColumn("last", F.col("place")), "again")
    # All windows of a stretch that stands earlier do so; where the first of them is kept is known
    # from the earliest such stretch.
    heads = distinct.where("times > 1")
    known = again.select(
        F.col("doc_id").alias("its_id"), F.col(KEY).alias("its_key"), F.col("place").alias("its_place"), "kept_doc_id", "kept_begin")
    same = heads["doc_id"].eqNullSafe(known["its_id"]) & (heads[KEY] == known["its_key"]) & (heads["place"] == known["its_place"])
    own = F.col("its_place").isNull()
    heads = heads.join(known, same, "left").select(
        "anchor", "digest", "first", F.when(own, F.col("first.doc_id")).otherwise(F.col("kept_doc_id")).alias("kept_doc_id"),
        F.when(own, F.col("first.begin")).otherwise(F.col("kept_begin")).alias("kept_begin"))
    copies = (
        found.join(keep(heads, "heads"), ["anchor", "digest"]).where(place != F.col("first"))
        .withColumn("last", F.col("place") + F.col("n") - 1).select(*again.columns))
    inside = Window.partitionBy("doc_id", KEY).orderBy("place")
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    return (
        again.unionByName(copies)
        .withColumn("new", (F.col("place") > F.max("last").over(before) + PASSAGE).cast("int"))
        .withColumn("run", F.sum(F.coalesce("new", F.lit(0))).over(inside))
        .groupBy("doc_id", KEY, "run").agg(
            F.min("begin").alias("begin"), F.max("next").alias("next"),
            (F.max("last") - F.min("place") + PASSAGE).cast("int").alias("n_words"),
            F.min_by(F.struct("kept_doc_id", "kept_begin"), "place").alias("first"))
        .select("*", "first.*", F.lit("passage").alias("level"), F.col("next").alias("end")).select(*SPAN)
    )


def remove(documents: DataFrame, found: DataFrame, instead: str = "") -> DataFrame:
    """The documents without the spans ``found`` in them (from ``begin`` to ``next``, so a unit goes
    with the break behind it), with all columns and ``instead`` in each place. Spans may overlap.
    Spans without a ``text_key`` are those of all rows of their id."""
    keys = {"_rep_doc": F.col("doc_id")} | ({"_rep_key": F.col(KEY)} if KEY in found.columns else {})
    lists = found.groupBy(*(c.alias(n) for n, c in keys.items())).agg(
        F.array_sort(F.collect_set(F.struct("begin", "next"))).alias("_rep_spans"))  # of one document
    own = documents.withColumn("_rep_own", text_key())
    same = own["doc_id"].cast("bigint").eqNullSafe(lists["_rep_doc"])
    if "_rep_key" in keys:
        same &= own["_rep_own"] == lists["_rep_key"]
    joined = own.join(lists, same, "left")
    gone = F.col("_rep_spans")
    # Overlapping spans are one: what stays begins behind the furthest end so far.
    furthest = F.transform(gone, lambda s, i: F.array_max(F.transform(F.slice(gone, 1, i + 1), lambda x: x["next"])))
    ends = F.transform(gone, lambda s, i: F.coalesce(F.get(furthest, i - 1), F.lit(0)))
    apart = F.filter(
        F.zip_with(gone, ends, lambda s, end: F.struct(end.alias("end"), s["begin"].alias("begin"))),
        lambda x: (x["begin"] > x["end"]) | (x["end"] == 0))
    stays = F.transform(apart, lambda x: F.substring(F.col("text"), x["end"] + 1, x["begin"] - x["end"]))
    rest = F.substring(F.col("text"), F.array_max(furthest) + 1, F.char_length("text"))
    return joined.withColumn(
        "text", F.when(gone.isNull(), F.col("text")).otherwise(F.concat(F.array_join(stays, instead), F.lit(instead), rest))
    ).select(*documents.columns)
