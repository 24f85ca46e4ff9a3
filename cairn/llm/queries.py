"""The operators over the given tables, as registered queries, and their SQL where SQL can say it.

Each query takes its rows through its operator and adds only the columns asked for. Tokenizer
files are read at the path the installed package ``public_tokenizers`` gives.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.llm import (
    centroids, language_id, near_duplicates, packing, quality, repeats, secrets, sentence_pieces, token_counts,
    top_k, toxicity, warc, whitening,
)
from cairn.llm.common import KEY, remainder
from cairn.session import shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

BYTE_BPE = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"


def query(function: Callable[[SparkSession, str], DataFrame]):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(parts: int, fold: int) -> Column:
    """Whether nothing is learned from a row; rows without an id are in no fold and never learned from."""
    return F.coalesce(remainder(F.col("doc_id"), parts) == fold, F.lit(True)).alias("held_out")


@query
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact token counts, and the characters that fit in 512 tokens."""
    counted = token_counts.prefix_counts(
        table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), limit=512)
    return counted.select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"), "fitting_chars")


@query
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    return packing.pack(
        table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), end_id=1, size=2048)


@query
def op10_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text's pieces, and whether decoding gives the text back."""
    coded = sentence_pieces.encode(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))
    return coded.select("doc_id", F.size("ids").cast("bigint").alias("n_pieces"), "ids", "round_trip")


@query
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every text, learned from three folds of four."""
    documents = table(spark, sf_dir, "documents")
    samples = language_id.learn(documents.where(remainder(F.col("doc_id"), 4) != 2))
    return language_id.identify(documents, samples).select(
        "doc_id", held_out(4, 2),
        F.col("best").alias("lang_pred"), "score", "rejected")


@query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every text, learned from two folds of three."""
    documents = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(remainder(F.col("doc_id"), 3) != 1)
    net = toxicity.learn(documents, labels)
    return toxicity.score(documents, net).select(
        "doc_id", held_out(3, 1), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


@query
def op3_quality_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and robust outliers over every text."""
    counted = quality.statistics(table(spark, sf_dir, "documents"))
    return quality.outliers(counted).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "distance")


@query
def op4_repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line, run of sentences and passage of 50 words that an earlier document, or the same text
    before, has as well."""
    documents = table(spark, sf_dir, "documents")
    found = repeats.repeats(documents, least_words=10).unionByName(repeats.passages(documents))
    return found.drop(KEY)


ORACLES["op4_repeated_lines"] = """
WITH lines AS (
  SELECT doc_id, i, line, coalesce(list_sum(list_transform(parts[1:i - 1], lambda p: length(p) + 1)), 0)::INTEGER AS "begin",
         length(line)::INTEGER AS size, i = len(parts) AS final,
         regexp_extract_all(lower(line), '[^\\x20\\x09-\\x0D]+') AS words
  FROM (SELECT DISTINCT doc_id, text, string_split(text, chr(10)) AS parts FROM documents),
       unnest(parts) WITH ORDINALITY AS u(line, i)),
units AS (
  SELECT *, len(words)::INTEGER AS n_words, row_number() OVER w AS place,
         first_value(doc_id) OVER w AS kept_doc_id, first_value("begin") OVER w AS kept_begin
  FROM lines WHERE len(words) >= 10
  WINDOW w AS (PARTITION BY array_to_string(words, ' ') ORDER BY doc_id, i)),
parts AS (
  SELECT doc_id, i, regexp_extract_all(lower(part), '[^\\x20\\x09-\\x0D]+') AS words,
         coalesce(sum(length(part)) OVER (PARTITION BY doc_id ORDER BY i
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::INTEGER AS "begin",
         length(part)::INTEGER AS size
  FROM (SELECT doc_id, regexp_extract_all(text, '[^.!?\\n]*[.!?\\n]+|[^.!?\\n]+') AS found FROM documents),
       unnest(found) WITH ORDINALITY AS u(part, i)),
sentences AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS idx, row_number() OVER w AS place,
         first_value(doc_id) OVER w AS kept_doc_id, first_value("begin") OVER w AS kept_begin
  FROM parts WHERE len(words) >= 3
  WINDOW w AS (PARTITION BY array_to_string(words, ' ') ORDER BY doc_id, i)),
runs AS (
  SELECT doc_id, min("begin") AS "begin", max("begin" + size) AS next, sum(len(words))::INTEGER AS n_words,
         arg_min(kept_doc_id, idx) AS kept_doc_id, arg_min(kept_begin, idx) AS kept_begin
  FROM (SELECT *, idx - row_number() OVER (PARTITION BY doc_id ORDER BY idx) AS run FROM sentences WHERE place > 1)
  GROUP BY doc_id, run),
pieces AS (
  SELECT doc_id, i - 1 AS place, lower(regexp_extract(piece, '^[^\\x20\\x09-\\x0D]+')) AS word,
         length(regexp_extract(piece, '^[^\\x20\\x09-\\x0D]+[\\x20\\x09]*')) AS size,
         lead + coalesce(sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY i
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS "begin"
  FROM (SELECT DISTINCT doc_id, length(regexp_extract(text, '^[\\x20\\x09-\\x0D]*')) AS lead,
               regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+[\\x20\\x09-\\x0D]*') AS found FROM documents),
       unnest(found) WITH ORDINALITY AS u(piece, i)),
windows AS (
  SELECT * FROM (
    SELECT doc_id, place, "begin"::INTEGER AS "begin", (max("begin" + size) OVER w)::INTEGER AS next,
           count(*) OVER w AS n, md5(string_agg(word, ' ') OVER w) AS key
    FROM pieces WINDOW w AS (PARTITION BY doc_id ORDER BY place ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING))
  WHERE n = 50),
again AS (
  SELECT *, place > lag(place) OVER (PARTITION BY doc_id ORDER BY place) + 50 AS new FROM (
    SELECT *, row_number() OVER w AS nth, first_value(doc_id) OVER w AS kept_doc_id, first_value("begin") OVER w AS kept_begin
    FROM windows WINDOW w AS (PARTITION BY key ORDER BY doc_id, place))
  WHERE nth > 1),
passages AS (
  SELECT doc_id, min("begin") AS "begin", max(next) AS next, (max(place) - min(place) + 50)::INTEGER AS n_words,
         arg_min(kept_doc_id, place) AS kept_doc_id, arg_min(kept_begin, place) AS kept_begin
  FROM (SELECT *, sum(coalesce(new, false)::INTEGER) OVER (PARTITION BY doc_id ORDER BY place) AS run FROM again)
  GROUP BY doc_id, run)
SELECT doc_id, 'unit' AS level, "begin", "begin" + size AS "end",
       ("begin" + size + CASE WHEN final THEN 0 ELSE 1 END)::INTEGER AS next, n_words, kept_doc_id, kept_begin
FROM units WHERE place > 1
UNION ALL
SELECT doc_id, 'run', "begin", next, next, n_words, kept_doc_id, kept_begin FROM runs WHERE n_words >= 25
UNION ALL
SELECT doc_id, 'passage', "begin", next, next, n_words, kept_doc_id, kept_begin FROM passages
"""


@query
def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate of every text with the forest's verdict."""
    return secrets.scan(table(spark, sf_dir, "documents")).drop(KEY)


@query
def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of two-word shingles are alike to 80 percent."""
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"), size=2, percent=80)


@query
def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five highest inner products of every fiftieth vector with all others."""
    vectors = top_k.whole_vectors(table(spark, sf_dir, "embeddings"))
    return top_k.search(vectors, F.col("vec_id") % 50 == 0, k=5)


ORACLES["op7_top_k"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
r AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
  FROM s)
SELECT * FROM r WHERE rank <= 5
"""


@query
def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as web archives and read back."""
    folder = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    warc.write(table(spark, sf_dir, "pages"), folder)
    return warc.read(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLES["op11_warc"] = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes FROM pages),
r AS (
  SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY html) ELSE page_id END AS lead FROM p)
SELECT page_id, payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN lead = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN lead <> page_id THEN lead END AS refers_to
FROM r
"""


@query
def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five rounds of clustering around 40 centroids, over all vectors."""
    return centroids.cluster(table(spark, sf_dir, "embeddings"), k=40, rounds=5, dim=64, salt="2:")


def _centroid_sql(rounds: int) -> str:
    """The rounds as steps of a query: ``a0`` to ``a5`` assign, ``c0`` to ``c5`` hold the centroids."""
    def nearest(i: int) -> str:
        return f"""
a{i} AS (
  SELECT v.vec_id, arg_min(c.k, (d, c.k)) AS k, min(d) AS d
  FROM v, c{i} AS c, LATERAL (SELECT list_sum(list_transform(list_zip(v.e, c.e), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d)
  GROUP BY v.vec_id)"""

    def move(i: int) -> str:
        return f"""
c{i} AS (
  SELECT c.k, coalesce(m.e, c.e) AS e FROM c{i - 1} AS c LEFT JOIN (
    SELECT k, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY j) AS e
    FROM (SELECT a.k, j, sum(v.e[j]) AS s, count(*) AS n
          FROM a{i - 1} AS a JOIN v USING (vec_id), unnest(range(1, 65)) AS u(j) GROUP BY a.k, j) GROUP BY k) AS m USING (k))"""

    steps = [nearest(0)]
    for i in range(1, rounds + 1):
        steps += [move(i), nearest(i)]
    return f"""
WITH v AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS (
  SELECT (row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1)::INTEGER AS k, e FROM v
  QUALIFY k < 40),{",".join(s.replace(" AS (", " AS MATERIALIZED (", 1) for s in steps)}
SELECT vec_id, k AS cluster, d AS distance, sum(d) OVER (PARTITION BY k)::BIGINT AS cluster_inertia,
       sum(d) OVER ()::BIGINT AS inertia, sha256(array_to_string(e, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} USING (k)
"""


ORACLES["op12_centroids"] = _centroid_sql(5)


@query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 16 whitened components of every vector."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))
