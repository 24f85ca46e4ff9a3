"""The pipeline's stages over documents with planted cases."""

from __future__ import annotations

import random

import pytest

import corpus_pipeline
from cairn.llm import near_duplicates
from cairn.llm.queries import ORACLES, QUERIES


def test_stages_hold_their_contract(spark, small, tmp_path):
    rnd = random.Random(1)
    words = lambda n: " ".join(f"term{rnd.randrange(5000)}" for _ in range(n))
    passage, near = words(60), words(80)
    key = 'token = "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b"'
    kind = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    rows = [
        (900001, f"{words(50)}\n{passage}", "en", "p", 1), (900002, f"{passage}\n{words(50)}", "en", "p", 1),
        (900003, near, "en", "p", 1), (900004, f"{near} end", "en", "p", 1), (900005, near, "en", "p", 1),
        (900006, f"{words(30)} {key} {words(9)}", "en", "p", 1), (900007, None, None, None, None), (900008, "", "en", "p", 0),
        (900009, words(40), "en", "p", 1), (900009, words(40), "en", "p", 1),
    ]
    docs = kind.unionByName(spark.createDataFrame(rows, kind.schema))
    columns, kept, after = docs.columns, {}, {}
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "repeated_lines", "secrets", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, small).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        after[name] = docs.where("doc_id > 900000").collect()
        kept[name] = {r.doc_id: r for r in docs.where("doc_id > 900000").collect()} if "text" in docs.columns else None
        assert name == "packing" or docs.columns == columns
    assert set(kept["near_duplicates"]) == {900001, 900002, 900003, 900006, 900007, 900008, 900009}
    assert sum(r.doc_id == 900009 for r in after["near_duplicates"]) == 2  # two documents of one id
    assert passage in kept["repeated_lines"][900001].text and passage not in kept["repeated_lines"][900002].text
    text = kept["secrets"][900006].text
    assert "9f86d081" not in text and corpus_pipeline.REDACTED in text and kept["secrets"][900006].n_chars == len(text)
    assert kept["secrets"][900007].text is None
    assert {r.doc_id for r in docs.where("doc_id > 900000").collect()} == set(kept["secrets"])


def test_documents_without_an_id_are_neither_lost_nor_spared(spark, small, tmp_path):
    rnd = random.Random(2)
    words = lambda n: " ".join(f"item{rnd.randrange(5000)}" for _ in range(n))
    passage, near, alone = words(60), words(80), words(70)
    key = 'token = "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b"'
    rows = [
        (1, f"{words(50)}\n{passage}"), (None, f"{passage}\n{words(50)}"), (2, near), (None, f"{near} end"),
        (None, alone), (None, f"{alone} end"), (None, f"{words(30)} {key} {words(9)}"), (None, None), (None, ""),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = near_duplicates.near_duplicates(docs).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in found) == sorted(
        [(1, 1, True), (2, 2, True), (0, 2, False), (0, 0, False), *[(0, 0, True)] * 5])
    for name, stage in corpus_pipeline.STAGES[1:4]:  # the others are tested with null ids as operators
        stage(spark, docs, small).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        left = [(r.doc_id, r.text) for r in docs.collect()]
        assert sum(i is None for i, _ in left) == 5, name
    text = [t or "" for i, t in left if i is None]
    assert sum(t.startswith(alone) for t in text) == 1 and not any(t.startswith(near) for t in text)
    assert not any(passage in t or "9f86d081" in t for t in text) and sum(corpus_pipeline.REDACTED in t for t in text) == 1


def test_no_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, small).count() == 0


def test_every_operator_has_one_query():
    assert sorted(int(n.split("_")[0][2:]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op1_packing", "op2_language_id", "op8_near_duplicates"}))
def test_queries_return_rows_and_agree_with_their_sql(spark, small, name):
    import check

    rows, difference, *_ = check.compare(spark, small, name)
    assert rows > 0 and difference is None
