"""Near duplicates by MinHash bands, odd sketches and exact verification.

A document is the set of its distinct word shingles. Documents with equal sets are one class.
Classes meet in buckets of ``BANDS`` bands of ``ROWS`` MinHash samples each; two sets of similarity
0.8 share none with a probability of 3 in a million. The samples of a set are folded into an odd
sketch, a bitmap of the parity of how many (place, sample) pairs fall on each bit: the population
count of two sketches' XOR tells how many samples differ, so pairs well under the threshold are
dropped without their texts. The bound lies four and a half standard deviations under the
threshold. Links are then confirmed on the full sets of the texts.

No bucket's pairs are all formed. Each class is tested against its bucket's first class only. The
pairs whose sketches pass make *families*, the confirmed ones components. Then, in blocks:

* within a family, classes outside its largest component are compared with all of the family, on
  full sets; one link with each component is reported;
* in a bucket, classes outside the first one's family are compared with all of the bucket, by
  sketches; the pairs that pass are confirmed.

Links within a component change nothing, so every link between different components is found
that shares a bucket. Components come from rounds of large-star and small-star steps on kept
tables; nothing is collected.

Defined results: null and empty texts, and texts without words, have 0 shingles and are kept and
alone; fewer words than a shingle make the whole sequence one shingle; texts of any length are
taken whole; rows of one id are documents of their own, linked if their texts are; an empty table
gives an empty one. Rows without an id come after all others: a component is named by the smallest
id in it, or null where none has one, and then ``kept`` holds for one row of it. Of each component
``distinct_documents`` keeps one row, of the smallest id and there of the smallest text hash; rows
without words all stay. Only ``doc_id`` and ``text`` are read, so further columns can't clash; names
that begin with ``_near_`` are the operator's.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.llm.common import KEY, Remembered, keep, map_rows, same_document, text_key, texts

BANDS, ROWS, SEED = 32, 5, 5
SAMPLES, BITS = BANDS * ROWS, 512
#: Rows of a block of sketches, and of a block of texts, which holds about ``SHINGLES`` at most unless a
#: single text has more.
BLOCK, TEXT_BLOCK, SHINGLES = 1024, 512, 1 << 22
#: Standard deviations by which a sketch may lie under the threshold.
SAFE = 4.5
REMEMBERED = 300_000


def word_hash(word: bytes) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(word)


@functools.cache
def word_hashes() -> Remembered:
    return Remembered(word_hash, REMEMBERED)


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit numbers with their bits mixed."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def shingles(text: str, size: int) -> np.ndarray:
    """The distinct hashes of the shingles of ``size`` words, in order."""
    known = word_hashes()
    get = known.new.get
    # Bytes know only ASCII: A-Z are lowered, and words end at U+0020 and U+0009 to U+000D.
    words = text.encode("utf-8", "surrogatepass").lower().split()
    hashes = np.array([get(w) or known(w) for w in words], dtype=np.uint64)
    if not len(hashes):
        return hashes
    size = min(size, len(hashes))
    many = len(hashes) - size + 1
    out = np.full(many, size, dtype=np.uint64)
    for k in range(size):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + hashes[k:k + many])
    return np.unique(out)


@functools.cache
def multipliers() -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(SEED)
    return (random.integers(0, 1 << 32, SAMPLES, dtype=np.uint32) | np.uint32(1),
            random.integers(0, 1 << 32, SAMPLES, dtype=np.uint32))


def samples(hashes: np.ndarray) -> np.ndarray:
    """The smallest of the hashes under each of ``SAMPLES`` orders."""
    low = (hashes >> np.uint64(32)).astype(np.uint32)
    times, plus = multipliers()
    out = np.full(SAMPLES, np.iinfo(np.uint32).max, dtype=np.uint32)
    for at in range(0, len(low), 1024):  # as much as the processor's cache holds
        ordered = low[at:at + 1024] * times[:, None]
        ordered += plus[:, None]
        np.minimum(out, ordered.min(axis=1), out=out)
    return out


def sketch(mins: np.ndarray) -> np.ndarray:
    """Parity bitmap of the samples with their places, as 64-bit words."""
    spots = mixed(mins.astype(np.uint64) + (np.arange(SAMPLES, dtype=np.uint64) << np.uint64(32))) % np.uint64(BITS)
    odd = np.bincount(spots.astype(np.int64), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def band_keys(mins: np.ndarray) -> np.ndarray:
    key = np.arange(BANDS, dtype=np.uint64)
    for column in mins.reshape(BANDS, ROWS).T:
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + column)
    return key.view(np.int64)


def most_differing_bits(threshold: float) -> int:
    """How many bits of two sketches may differ, for sets of at least this similarity."""
    low = threshold - SAFE * math.sqrt(threshold * (1 - threshold) / SAMPLES)
    bits = BITS / 2 * (1 - math.exp(-4 * SAMPLES * (1 - low) / BITS))
    return math.ceil(bits + math.sqrt(BITS) / 4)


def described(documents: DataFrame, size: int) -> DataFrame:
    """``doc_id, text_key, n_shingles, digest, bands, sketch`` of every document."""
    import hashlib

    def run(rows: dict) -> dict:
        made: dict[str, list] = {n: [] for n in ("n_shingles", "digest", "bands", "sketch")}
        for text in rows["text"]:
            found = shingles(text, size)
            made["n_shingles"].append(len(found))
            made["digest"].append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
            mins = samples(found) if len(found) else None
            made["bands"].append(None if mins is None else band_keys(mins))
            made["sketch"].append(None if mins is None else sketch(mins))
        return {"doc_id": rows["doc_id"], KEY: rows[KEY], **made}

    return map_rows(
        texts(documents).withColumn(KEY, text_key()),
        f"doc_id bigint, {KEY} bigint, n_shingles bigint, digest binary, bands array<bigint>, sketch array<bigint>", run)


def differing_bits(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)


def similar_sizes(a: Column, b: Column, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def star_pairs(met: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Each class with the first class of each of its buckets, where sizes and sketches allow it."""
    pairs = met.where("id <> first").select(F.col("id").alias("u"), F.col("first").alias("v")).distinct()
    described = classes.select("id", "n", "sketch")
    both = (
        pairs.join(described.toDF("u", "n_u", "sketch_u"), "u").join(described.toDF("v", "n_v", "sketch_v"), "v")
    )
    return both.where(
        similar_sizes(F.col("n_u"), F.col("n_v"), percent)
        & (differing_bits(F.col("sketch_u"), F.col("sketch_v")) <= most_differing_bits(percent / 100))
    ).select("u", "v")


def block_pairs(percent: int):
    """For a group of sketches: pairs of a foreign row and any row of another component that sizes
    and sketches allow."""
    most = most_differing_bits(percent / 100)

    def run(table: pa.Table) -> pa.Table:
        rows = Block(table, percent, most)
        found = [(rows.ids[i], rows.ids[j]) for i in rows.left for j in rows.near(i)]
        return pa.table({
            "u": pa.array([max(p) for p in found], pa.int64()), "v": pa.array([min(p) for p in found], pa.int64())})

    return run


def block_links(percent: int, size: int):
    """For a group of texts: of each foreign row one confirmed link with each other component."""
    most = most_differing_bits(percent / 100)

    def run(table: pa.Table) -> pa.Table:
        rows, sets, us, vs = Block(table, percent, most), {}, [], []
        bands, text = np.stack(table.column("bands").to_pylist()), table.column("text")

        def set_of(i: int) -> np.ndarray:
            if rows.ids[i] not in sets:
                sets[rows.ids[i]] = shingles(text[int(i)].as_py(), size)
            return sets[rows.ids[i]]

        for i in rows.left:
            fits = rows.near(i)
            fits = fits[(bands[fits] == bands[i]).any(axis=1)]
            if not len(fits):
                continue
            mine, others = set_of(i), [set_of(j) for j in fits]
            sizes = np.array([len(o) for o in others])
            flat = np.concatenate(others)
            at = np.minimum(np.searchsorted(mine, flat), len(mine) - 1)
            common = np.add.reduceat((mine[at] == flat).astype(np.int64), np.cumsum(sizes) - sizes)
            linked = fits[100 * common >= percent * (len(mine) + sizes - common)]
            one_each = linked[np.unique(rows.comp[linked], return_index=True)[1]]
            us += [rows.ids[i]] * len(one_each)
            vs += rows.ids[one_each].tolist()
        return pa.table({"u": pa.array(us, pa.int64()), "v": pa.array(vs, pa.int64())})

    return run


class Block:
    """Rows of a group: foreign ones (``left``) and those they are compared with (``right``)."""

    def __init__(self, table: pa.Table, percent: int, most: int):
        self.ids, self.n, self.comp = (table.column(c).to_numpy() for c in ("id", "n", "comp"))
        side = table.column("foreign_row").to_numpy(zero_copy_only=False)
        self.words = np.stack(table.column("sketch").to_pylist()).astype(np.int64).view(np.uint64)
        self.left, self.right = np.flatnonzero(side), np.flatnonzero(~side)
        self.percent, self.most = percent, most

    def near(self, i: int) -> np.ndarray:
        """Rows of other components that may be similar to row ``i`` by size and sketch."""
        n, right = self.n, self.right
        fits = right[(self.comp[right] != self.comp[i])
                     & (100 * np.minimum(n[right], n[i]) >= self.percent * np.maximum(n[right], n[i]))]
        return fits[np.bitwise_count(self.words[fits] ^ self.words[i]).sum(axis=1) <= self.most]


def in_blocks(rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Deals the rows of a key (with ``foreign``, and in how many blocks to cut, ``all_blocks`` and
    ``foreign_blocks``) to groups ``key, a, b``: the foreign rows of a block and all rows of a block, so
    that each foreign row meets each row once."""
    blocks = {side: F.col(f"{side}_blocks").cast("int") for side in ("all", "foreign")}

    def spread(own: str, other: str) -> DataFrame:
        some = rows.where("foreign") if own == "foreign" else rows
        mine = F.pmod(F.xxhash64("id"), blocks[own]).cast("int")
        others = F.explode(F.sequence(F.lit(0), blocks[other] - 1))
        dealt = some.select(key, *columns, mine.alias("mine"), others.alias("others"))
        a, b = ("mine", "others") if own == "foreign" else ("others", "mine")
        return dealt.select(
            key, F.col(a).alias("a"), F.col(b).alias("b"), *columns, F.lit(own == "foreign").alias("foreign_row"))

    return spread("foreign", "all").unionByName(spread("all", "foreign"))


def cross_pairs(met: DataFrame, classes: DataFrame, families: DataFrame, percent: int) -> DataFrame:
    """Pairs of classes that share a bucket but no family, where sizes and sketches allow it: in
    each bucket the rows outside its first class's family are compared with all rows."""
    rows = (
        met.where("many > 2").select("key", "id", "first")
        .join(families.toDF("id", "comp"), "id", "left").withColumn("comp", F.coalesce("comp", "id"))
        .join(families.toDF("first", "main"), "first", "left")
        .withColumn("foreign", F.col("comp") != F.coalesce("main", "first"))
    )
    sizes = rows.groupBy("key").agg(
        F.ceil(F.count("*") / BLOCK).alias("all_blocks"), F.ceil(F.count_if("foreign") / BLOCK).alias("foreign_blocks"))
    open_ = rows.join(sizes.where("foreign_blocks > 0"), "key").join(classes.select("id", "n", "sketch"), "id")
    return (
        in_blocks(open_, "key", ["id", "n", "comp", "sketch"])
        .groupBy("key", "a", "b").applyInArrow(block_pairs(percent), "u bigint, v bigint").distinct()
    )


def family_links(
    families: DataFrame, groups: DataFrame, classes: DataFrame, words_of: DataFrame, size: int, percent: int
) -> DataFrame:
    """Links between different components (``groups``) of the same family, confirmed in blocks on
    full sets: the rows outside a family's largest component are compared with all its rows."""
    rows = (
        families.toDF("id", "family").join(groups, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
        .join(classes.select("id", "n"), "id")
    )
    largest = F.max(F.struct("many", "comp", "shingles"))
    blocks = lambda many, shingles: F.greatest(F.ceil(many / TEXT_BLOCK), F.ceil(shingles / SHINGLES))
    sizes = (
        rows.groupBy("family", "comp").agg(F.count("*").alias("many"), F.sum("n").alias("shingles"))
        .groupBy("family").agg(
            largest["comp"].alias("main"), blocks(F.sum("many"), F.sum("shingles")).alias("all_blocks"),
            blocks(F.sum("many") - largest["many"], F.sum("shingles") - largest["shingles"]).alias("foreign_blocks"))
        .where("foreign_blocks > 0")
    )
    open_ = keep(
        rows.join(sizes, "family").withColumn("foreign", F.col("comp") != F.col("main"))
        .join(classes.select("id", "bands", "sketch"), "id").join(words_of, "id"), "families")
    return (
        in_blocks(open_, "family", ["id", "n", "comp", "bands", "sketch", "text"])
        .groupBy("family", "a", "b").applyInArrow(block_links(percent, size), "u bigint, v bigint")
    )


def confirmed(pairs: DataFrame, words_of: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs that are links by their full sets."""
    both = pairs.join(words_of.toDF("u", "text_u"), "u").join(words_of.toDF("v", "text_v"), "v")

    def run(rows: dict) -> dict:
        known: dict[int, np.ndarray] = {}
        linked = []
        for u, v, text_u, text_v in zip(rows["u"], rows["v"], rows["text_u"], rows["text_v"]):
            for doc, text in ((u, text_u), (v, text_v)):
                if doc not in known:
                    known[doc] = shingles(text, size)
            a, b = known[u], known[v]
            common = len(a) + len(b) - len(np.union1d(a, b))
            linked.append(100 * common >= percent * (len(a) + len(b) - common))
        return {"u": rows["u"], "v": rows["v"], "linked": linked}

    return map_rows(both, "u bigint, v bigint, linked boolean", run, small=8 << 20).where("linked").select("u", "v")


def components(links: DataFrame) -> DataFrame:
    """``id`` and the smallest id of its component, for all ids in ``links`` (``u``, ``v``)."""
    edges = keep(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "edges")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = keep(large, "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        edges = keep(
            large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "edges")
        found = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if tuple(found) == state:
            break
        state = tuple(found)
    ends = edges.select(F.col("v").alias("id")).distinct().select("id", F.col("id").alias("comp"))
    return keep(edges.select(F.col("u").alias("id"), F.col("v").alias("comp")).unionByName(ends), "components")


def grouped(documents: DataFrame, size: int, percent: int) -> DataFrame:
    """Each row's ``doc_id, text_key, n_shingles, component_id``, and whether it is the ``first`` of its
    component."""
    # The rows' numbers are written with them, so they stay.
    rows = keep(described(documents, size).withColumn("row", F.monotonically_increasing_id()), "described")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", KEY, "row")
    classes = keep(
        rows.where("n_shingles > 0").groupBy("digest", F.col("n_shingles").alias("n"))
        .agg(F.min(place).alias("lead"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
        .withColumn("id", F.monotonically_increasing_id()), "classes")
    placed = classes.select("id", F.explode("bands").alias("key"))
    buckets = placed.groupBy("key").agg(F.min("id").alias("first"), F.count("*").alias("many")).where("many > 1")
    met = keep(placed.join(buckets, "key"), "met")

    stars = keep(star_pairs(met, classes, percent), "stars")
    needed = met.where("many > 2").select("id").unionByName(
        stars.select(F.explode(F.array("u", "v")).alias("id"))).distinct()
    leads = classes.join(needed, "id", "left_semi").select(
        "id", F.col("lead.doc_id").alias("lead_doc"), F.col(f"lead.{KEY}").alias("lead_key"))
    source = texts(documents).withColumn(KEY, text_key())
    words_of = keep(
        source.join(leads, same_document(source, leads, "lead_doc", "lead_key")).select("id", "text")
        .dropDuplicates(["id"]), "texts")
    links = keep(confirmed(stars, words_of, size, percent), "links")
    families = components(stars)
    crossing = keep(cross_pairs(met, classes, families, percent), "crossing")
    more = confirmed(crossing, words_of, size, percent).unionByName(
        family_links(families, components(links), classes, words_of, size, percent))
    groups = components(links.unionByName(more))

    named = classes.select("digest", "n", "lead", "id").join(groups, "id", "left").withColumn(
        "comp", F.coalesce("comp", "id"))
    heads = keep(named.groupBy("comp").agg(F.min("lead").alias("head")), "heads")
    named = named.join(heads, "comp").select("digest", F.col("n").alias("n_shingles"), "head")
    return (
        rows.select("doc_id", KEY, "row", "n_shingles", "digest").join(named, ["digest", "n_shingles"], "left")
        .select(
            "doc_id", KEY, "n_shingles",
            F.when(F.col("head").isNull(), F.col("doc_id")).otherwise(F.col("head.doc_id")).alias("component_id"),
            F.coalesce(F.col("row") == F.col("head.row"), F.lit(True)).alias("first"))
    )


def near_duplicates(documents: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """Each document's set size and component: ``doc_id, n_shingles, component_id, kept``."""
    return grouped(documents, size, percent).select(
        "doc_id", "n_shingles", "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("first")).alias("kept"))


def distinct_documents(documents: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component, and all without words, with all their columns."""
    stays = grouped(documents, size, percent).where("first AND n_shingles > 0").select(
        F.col("doc_id").alias("_near_doc"), F.col(KEY).alias("_near_key"))
    own = documents.withColumn("_near_own", text_key())
    worded = F.coalesce(F.col("text").cast("string"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    same = own["doc_id"].cast("bigint").eqNullSafe(stays["_near_doc"]) & (own["_near_own"] == stays["_near_key"])
    some = own.where(worded).join(stays, same).dropDuplicates(["_near_doc", "_near_key"])  # rows equal in both
    return some.select(*documents.columns).unionByName(documents.where(~worded))
