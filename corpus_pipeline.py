"""The corpus pipeline: documents in, packed sequences out.

Each stage takes what the one before kept, and all but the last return the columns of
``documents``; ``n_chars`` follows a text that changes. Rows of one id, or without one, are documents
of their own, told apart by their texts; they pass every stage like the rest and keep their id.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.llm import near_duplicates, packing, repeats, secrets, toxicity
from cairn.llm.common import KEY, keep, remainder

#: What stands in a text where a secret was.
REDACTED = "[SECRET]"


def recounted(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.coalesce(F.char_length("text").cast(kind), F.col("n_chars")))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents under the toxicity threshold. The network learns from the labelled two folds."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(remainder(F.col("doc_id"), 3) != 1)
    return toxicity.without_toxic(docs, toxicity.learn(docs, labels))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, on five-word shingles."""
    return near_duplicates.distinct_documents(docs, size=5, percent=80)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines, and without the passages of 50 words, that an earlier place has."""
    found = repeats.repeats(docs).unionByName(repeats.passages(docs))
    return recounted(repeats.remove(docs, found))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ``REDACTED`` in place of each secret."""
    found = keep(secrets.scan(docs).where("secret").select("doc_id", KEY, "begin", "next"), "secrets")
    return recounted(repeats.remove(docs, found, REDACTED))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=1, size=2048)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_lines", drop_repeated_lines),
    ("secrets", redact_secrets),
    ("packing", pack_sequences),
]

#: SQL can't express a trained network, MinHash or a linear program; see the brute-force tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each over what the one before kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
