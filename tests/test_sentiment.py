import pytest
from pyspark.sql import functions as F

from cairn.functions.sentiment import lexicon_scorer, model_scorer, sentiment
from cairn.schemas import SCORES

CASES = [
    # scores, threshold 0.5, weighted, positive_bias, other
    ((.10, .60, .30), ("neutral", .60), ("neutral", .60), ("neutral", .60), ("neutral", .60)),
    ((.30, .40, .30), ("NEUTRAL", .40), ("neutral", .40), ("positive", .30), ("neutral", .40)),
    ((.60, .20, .20), ("negative", .60), ("negative", .60), ("positive", .20), ("negative", .60)),
    ((.65, .30, .05), ("negative", .65), ("negative", .65), ("negative", .65), ("negative", .65)),
    # scores that do not sum to one
    ((.10, .20, .20), ("NEUTRAL", .20), ("NEUTRAL", .20), ("positive", .20), ("neutral", .20)),
    ((.00, .00, .00), ("NEUTRAL", .00), ("NEUTRAL", .00), ("neutral", .00), ("negative", .00)),
]


@pytest.mark.parametrize("at, method", list(enumerate(["threshold", "weighted", "positive_bias", "raw"], 1)))
def test_policies(spark, at, method):
    rows = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)],
                                 f"i int, s {SCORES.simpleString()}")
    got = rows.select("i", sentiment(F.col("s"), method, 0.5).alias("v")).orderBy("i").collect()
    assert [tuple(r.v) for r in got] == [c[at] for c in CASES]


def test_lexicon(spark):
    rows = spark.createDataFrame([("Great, durable pack",), ("it leaked",), ("",), (None,)], "t string")
    got = [tuple(r[0]) for r in rows.select(lexicon_scorer()(F.col("t"))).collect()]
    assert got == [(0.0, 1 / 3, 2 / 3), (0.5, 0.5, 0.0), (0.0, 1.0, 0.0), (0.0, 1.0, 0.0)]


def test_model_is_loaded_once_and_scores_each_text_once(spark, tmp_path):
    log = str(tmp_path)

    def load():
        open(f"{log}/loads", "a").write("x")

        def model(texts):
            open(f"{log}/texts", "a").write("x" * len(texts))
            return [{"negative": 0.1, "neutral": 0.2, "positive": len(t) / 10} for t in texts]

        return model

    rows = spark.createDataFrame([("ab",), (None,), ("abcd",)], "t string").coalesce(1)
    scored = rows.select("t", model_scorer(load)(F.col("t")).alias("s"))
    found = scored.select("t", sentiment(F.col("s"), "positive_bias", 0.1).alias("v"))
    found = found.where(F.col("v.sent_label") == "positive").select("t", "v.sent_score")
    assert sorted(map(tuple, found.collect())) == [("ab", 0.2), ("abcd", 0.4)]
    assert open(f"{log}/loads").read() == "x"
    assert open(f"{log}/texts").read() == "xxx"


@pytest.mark.parametrize("chunk, waiting", [(3, 4096), (7, 20), (500, 1), (1, 5)])
def test_batches_hold_texts_of_like_lengths_across_chunks(spark, tmp_path, chunk, waiting):
    log = str(tmp_path / "batches")

    def load():
        def model(texts):
            sizes = [len(t) for t in texts]
            assert max(sizes) <= 2 * max(1, min(sizes))
            with open(log, "a") as file:
                file.write(f"{len(texts)}\n")
            return [{"negative": len(t), "neutral": t.count("a"), "positive": max(sizes) > 8} for t in texts]

        return model

    texts = [None if i % 11 == 0 else "a" * (i * 7 % 23) + "b" * (i % 3) for i in range(120)]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").coalesce(1)
    score = model_scorer(load, 8, truncate=lambda text, most: text[:most], most_tokens=12, waiting_rows=waiting)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(chunk))
    try:
        got = {r.i: tuple(r.s) for r in rows.select("i", score(F.col("t")).alias("s")).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    cut = [(t or "")[:12] for t in texts]
    assert got == {i: (len(t), t.count("a"), float(len(t) > 8)) for i, t in enumerate(cut)}
    sizes = [int(x) for x in open(log).read().split()]
    assert sum(sizes) == 120 and max(sizes) <= 8
    if waiting == 4096:  # batches fill up, whatever the chunks are
        assert len(sizes) <= 120 // 8 + 6


def test_scorer_settings_are_checked():
    with pytest.raises(ValueError):
        model_scorer(lambda: None, batch_size=0)
