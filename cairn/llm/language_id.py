"""Language identification by compression.

A bounded sample of labelled texts of each language becomes a raw-content zstandard dictionary.
A text, in lower case, is compressed in blocks of ``BLOCK`` bytes with each dictionary; the language whose
dictionary leaves the fewest bytes wins. The margin between the best two, as a part of the
smaller, gives the score; a margin under ``narrow`` rejects.

Defined results: texts that are null or hold no letter are ``und`` with score 0, and so is every
text when no language was learned; equal sizes go to the language first in order, with score 0.
Labels or texts that are null are not learned from; texts of any length are taken whole; repeated
rows give repeated results. Only ``doc_id`` and ``text`` are read for a prediction.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairn.llm.common import keep, map_rows, texts

UNDETERMINED = "und"
#: Of each language, so many labelled texts, by their ids' hashes, fill its dictionary, each with
#: ``WINDOWS`` windows at equal steps from its begin to its end that hold so many characters together;
#: where all languages would take more than ``ALL_CHARS``, each gets an equal, smaller share. They
#: bound what the driver gets; no language is left out.
SAMPLE_TEXTS, SAMPLE_CHARS, WINDOWS, ALL_CHARS = 100, 2000, 8, 40_000_000
PARTS = 32
BLOCK, LEVEL, NARROW = 1024, 9, 0.02


def windows(text: Column, size: int) -> Column:
    """``WINDOWS`` windows of ``size`` characters over the whole text, or the text where they hold it all."""
    step = (F.char_length(text) - size) / (WINDOWS - 1)
    parts = [F.substring(text, F.floor(step * i).cast("int") + 1, F.lit(size)) for i in range(WINDOWS)]
    return F.when(F.char_length(text) <= size * WINDOWS, text).otherwise(F.concat_ws("\n", *parts))


def learn(labelled: DataFrame) -> dict[str, bytes]:
    """A dictionary of raw text for each ``lang``, from ``doc_id``, ``text`` and ``lang``."""
    known = labelled.where(F.col("lang").isNotNull() & (F.trim(F.col("text")) != "")).select(
        "doc_id", F.col("lang").cast("string").alias("lang"), "text")
    hashed = known.select("doc_id", "lang", F.xxhash64("doc_id").alias("h")).withColumn(
        "part", F.pmod("h", F.lit(PARTS)))
    inside = Window.partitionBy("lang", "part").orderBy("h", "doc_id")
    first = Window.partitionBy("lang").orderBy("h", "doc_id")
    chosen = keep(  # first of each part of a language, so that no task gets all its rows
        hashed.withColumn("place", F.row_number().over(inside)).where(F.col("place") <= SAMPLE_TEXTS)
        .withColumn("place", F.row_number().over(first)).where(F.col("place") <= SAMPLE_TEXTS), "languages")
    langs = chosen.select("lang").distinct().count()
    window = max(1, min(SAMPLE_CHARS, ALL_CHARS // max(1, langs * SAMPLE_TEXTS)) // WINDOWS)
    rows = (
        known.join(F.broadcast(chosen.select("doc_id", "lang", "place")), ["doc_id", "lang"])
        .select("lang", "place", windows(F.col("text"), window).alias("text")).collect()
    )
    out: dict[str, list[str]] = {}
    for lang, _, text in sorted(tuple(r) for r in rows):
        out.setdefault(lang, []).append(text.lower())
    return {lang: "\n".join(parts).encode() for lang, parts in out.items()}


class Compressors:
    """One compressor for each language, by the languages' order."""

    def __init__(self, samples: Mapping[str, bytes]):
        import zstandard

        self.langs = sorted(samples)
        self.compressors = []
        for lang in self.langs:
            content = zstandard.ZstdCompressionDict(samples[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(level=LEVEL)
            self.compressors.append(zstandard.ZstdCompressor(
                dict_data=content, write_content_size=False, write_checksum=False, write_dict_id=False))

    def sizes(self, text: str) -> list[int]:
        data = text.lower().encode("utf-8", "surrogatepass")
        blocks = [data[i:i + BLOCK] for i in range(0, len(data), BLOCK)]
        return [sum(len(c.compress(b)) for b in blocks) for c in self.compressors]

    def predict(self, text: str) -> tuple[str, float]:
        """The language and the margin, 0 to 1."""
        if not self.langs or not any(map(str.isalpha, text)):
            return UNDETERMINED, 0.0
        sizes = self.sizes(text)
        order = sorted(range(len(sizes)), key=sizes.__getitem__)
        if len(order) == 1:
            return self.langs[order[0]], 1.0
        return self.langs[order[0]], 1.0 - sizes[order[0]] / sizes[order[1]]


def identify(documents: DataFrame, samples: Mapping[str, bytes], narrow: float = NARROW) -> DataFrame:
    """``doc_id, best, score, rejected``: the nearest language, the margin, and whether the margin
    is narrow; ``lang`` is the language, or ``und`` where it is rejected."""
    shared = documents.sparkSession.sparkContext.broadcast(dict(samples))
    made: list[Compressors] = []

    def run(rows: dict) -> dict:
        if not made:
            made.append(Compressors(shared.value))
        found = [made[0].predict(t) for t in rows["text"]]
        rejected = [best == UNDETERMINED or margin < narrow for best, margin in found]
        return {
            "doc_id": rows["doc_id"],
            "best": [b for b, _ in found],
            "score": [m for _, m in found],
            "rejected": rejected,
            "lang": [UNDETERMINED if no else b for (b, _), no in zip(found, rejected)],
        }

    return map_rows(
        texts(documents), "doc_id bigint, best string, score double, rejected boolean, lang string", run)
