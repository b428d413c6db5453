"""Batch scoring of texts into three classes."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, functions as F

from lakesteps.functions.text import clean_text

# Model label, score, stored label; and the text scored in place of an empty one.
POSITIVE = ("POS", 1, "Tích cực")
NEGATIVE = ("NEG", -1, "Tiêu cực")
NEUTRAL = ("NEU", 0, "Trung lập")
EMPTY_TEXT = "trống"

Scorer = Callable[[list[str]], list[str]]


def map_label(c: Column) -> Column:
    """Model label to ``struct<score, label>``; anything else is neutral."""
    def pair(entry):
        return F.struct(F.lit(entry[1]).alias("score"), F.lit(entry[2]).alias("label"))

    return (
        F.when(c == POSITIVE[0], pair(POSITIVE))
        .when(c == NEGATIVE[0], pair(NEGATIVE))
        .otherwise(pair(NEUTRAL))
    )


def model_input(c: Column) -> Column:
    """Cleaned text, never empty. A model with an input limit cuts it itself."""
    text = F.coalesce(clean_text(c), F.lit(""))
    # a cleaned text starts with a word, so only an empty one is blank
    return F.regexp_replace(text, "^$", EMPTY_TEXT)


def score_text(
    df: DataFrame,
    col: str,
    scorer_factory: Callable[[], Scorer],
    batch_size: int = 16,
    score: str = "score",
    label: str = "label",
    observation: Observation | None = None,
) -> DataFrame:
    """Add ``score`` and ``label`` from a model that labels texts ``POS``, ``NEG`` or other.

    Cleaning and label mapping stay in the JVM; only the model call is Python. The model is
    loaded once per task and called with ``batch_size`` texts. A call that fails makes its own
    texts neutral; ``observation`` then reports their number as ``failed``. The model gets whole
    texts.
    """

    @F.pandas_udf("string")
    def model_label(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = scorer_factory()
        for texts in batches:
            labels: list[str] = []
            for i in range(0, len(texts), batch_size):
                part = texts.iloc[i:i + batch_size].tolist()
                try:
                    got = list(scorer(part))
                    if len(got) != len(part):
                        raise ValueError("the model returned another number of labels")
                except Exception:  # noqa: BLE001 - any model failure means neutral
                    got = ["FAILED"] * len(part)
                labels.extend(got)
            yield pd.Series(labels)

    scored = df.withColumn("_label", model_label(model_input(F.col(col))))
    if observation is not None:
        failed = F.count_if(F.col("_label") == "FAILED").alias("failed")
        scored = scored.observe(observation, failed)
    return (
        scored.withColumn("_pair", map_label(F.col("_label")))
        .withColumns({score: F.col("_pair.score"), label: F.col("_pair.label")})
        .drop("_label", "_pair")
    )


def word_list_scorer(positive: Sequence[str], negative: Sequence[str]) -> Callable[[], Scorer]:
    """A model that compares the numbers of positive and negative words."""
    good, bad = frozenset(positive), frozenset(negative)

    def load() -> Scorer:
        def scorer(texts: list[str]) -> list[str]:
            labels = []
            for text in texts:
                words = text.lower().split()
                balance = sum(w in good for w in words) - sum(w in bad for w in words)
                labels.append("POS" if balance > 0 else "NEG" if balance < 0 else "NEU")
            return labels

        return scorer

    return load


def word_list_label(c: Column, positive: Sequence[str], negative: Sequence[str]) -> Column:
    """The word-list model as a column expression, without leaving the JVM: one pass over the
    words that counts up and down."""
    words = F.split(F.lower(F.coalesce(clean_text(c), F.lit(""))), " ")

    def step(balance, w):
        return balance + (
            F.when(w.isin(list(positive)), 1).when(w.isin(list(negative)), -1).otherwise(0))

    def label(balance):
        return F.when(balance > 0, "POS").when(balance < 0, "NEG").otherwise("NEU")

    return map_label(F.aggregate(words, F.lit(0), step, label))
