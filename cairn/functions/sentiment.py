"""Sentiment: class scores from a pluggable scorer, and the policies that read them.

A scorer is a function from a text column to a struct column
``<negative, neutral, positive>`` of doubles.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from cairn.functions.text import whole_words
from cairn.schemas import SCORES
from cairn.vocab import LEXICON_NEGATIVE, LEXICON_POSITIVE

Scorer = Callable[[Column], Column]

# The class labels in model order, and the label that low scores get.
CLASSES = ("negative", "neutral", "positive")
UNSURE = "NEUTRAL"

# Fixed value: the tokens of a text that a model reads.
MODEL_TOKENS = 256

# The cut-offs of the policies.
WEIGHTED_FLOOR = 0.2
POSITIVE_OVER_NEUTRAL = 0.6
NEGATIVE_OVER_NEUTRAL = 1.5


def lexicon_scorer(
    positive: Sequence[str] = LEXICON_POSITIVE, negative: Sequence[str] = LEXICON_NEGATIVE
) -> Scorer:
    """Scores from counts of listed words, as plain expressions; one count stands for neutral."""

    def score(text: Column) -> Column:
        lowered = F.lower(F.coalesce(text, F.lit("")))
        pos = F.size(F.regexp_extract_all(lowered, F.lit(whole_words(positive)), F.lit(0)))
        neg = F.size(F.regexp_extract_all(lowered, F.lit(whole_words(negative)), F.lit(0)))
        total = (pos + neg + 1).cast("double")
        return F.struct(
            (neg / total).alias("negative"),
            (F.lit(1.0) / total).alias("neutral"),
            (pos / total).alias("positive"),
        )

    return score


def model_scorer(
    load: Callable[[], Callable[[list[str]], list[dict]]],
    batch_size: int = 32,
    truncate: Callable[[str, int], str] | None = None,
    most_tokens: int = MODEL_TOKENS,
    waiting_rows: int = 4096,
) -> Scorer:
    """Scores from a user's model.

    ``load`` runs once per Python worker and returns a function from a list of
    texts to a list of ``{"negative": …, "neutral": …, "positive": …}``. ``truncate`` cuts a text
    to ``most_tokens`` tokens before that; without it, cutting is the model's business.

    A model pads the texts of a batch to the longest. So a batch holds at most ``batch_size``
    texts whose lengths have the same power of two above them: less than half of it is padding.
    Batches fill up across Arrow chunks, until ``waiting_rows`` rows wait for their scores; those
    left then go in short batches.
    """
    if batch_size < 1 or waiting_rows < 1:
        raise ValueError("batch_size and waiting_rows must be positive")

    def score_batches(chunks: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = load()
        names = ["negative", "neutral", "positive"]
        results: list[list] = []  # of each waiting chunk, in order
        classes: dict[int, list[tuple[list, int, str]]] = {}
        rows = 0

        def run(some: list[tuple[list, int, str]]) -> None:
            for (result, place, _), scores in zip(some, model([text for _, _, text in some]), strict=True):
                result[place] = [scores[n] for n in names]

        for chunk in chunks:
            result: list = [None] * len(chunk)
            results.append(result)
            rows += len(chunk)
            for place, text in enumerate(chunk.fillna("").tolist()):
                if truncate is not None:
                    text = truncate(text, most_tokens)
                same = classes.setdefault((len(text) - 1).bit_length() if text else 0, [])
                same.append((result, place, text))
                if len(same) == batch_size:
                    run(same)
                    same.clear()
            if rows >= waiting_rows:
                for same in classes.values():
                    if same:
                        run(same)
                classes.clear()
            while results and None not in results[0]:
                rows -= len(results[0])
                yield pd.DataFrame(results.pop(0), columns=names, dtype="float64")
        for same in classes.values():
            if same:
                run(same)
        for result in results:
            yield pd.DataFrame(result, columns=names, dtype="float64")

    # Non-deterministic for the optimizer: a text must not be scored twice because a
    # later filter was moved below the projection.
    udf = F.pandas_udf(score_batches, SCORES).asNondeterministic()
    return lambda text: udf(text)


def _verdict(label: Column | str, score: Column) -> Column:
    label = F.lit(label) if isinstance(label, str) else label
    return F.struct(label.alias("sent_label"), score.alias("sent_score"))


def sentiment(scores: Column, method: str, threshold: float) -> Column:
    """``struct<sent_label, sent_score>`` by one of the policies.

    ``threshold``: the best class, or ``NEUTRAL`` when its score is below the threshold.
    ``weighted``: the best class above a floor, else ``NEUTRAL`` (no class carries that
    upper-case label, so none is left out). ``positive_bias``: positive as soon as it
    reaches a share of neutral, then negative, then neutral. Anything else: the best class.
    """
    neg, neu, pos = (scores[c] for c in CLASSES)
    best = F.greatest(neg, neu, pos)
    top = F.when(neg >= best, CLASSES[0]).when(neu >= best, CLASSES[1]).otherwise(CLASSES[2])
    if method == "threshold":
        return _verdict(F.when(best < threshold, UNSURE).otherwise(top), best)
    if method == "weighted":
        return _verdict(F.when(best > WEIGHTED_FLOOR, top).otherwise(UNSURE), best)
    if method == "positive_bias":
        return (
            F.when(pos > neu * POSITIVE_OVER_NEUTRAL, _verdict("positive", pos))
            .when(neg > neu * NEGATIVE_OVER_NEUTRAL, _verdict("negative", neg))
            .otherwise(_verdict("neutral", neu))
        )
    return _verdict(top, best)
