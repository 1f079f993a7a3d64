"""Choosing predicted rows that go back into the training set."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.functions.scores import CONFIDENT_THRESHOLD, surely_safe, surely_toxic
from textmill.functions.text import is_content
from textmill.operators.membership import without_known
from textmill.operators.sample import sample_by_key
from textmill.operators.words import flagged


def sampled_positives(
    predictions: DataFrame, fraction: float = 0.1, seed: int = 42, id_col: str = "id"
) -> DataFrame:
    """`text, is_destructive`: a sample of the rows predicted positive, labelled 1."""
    chosen = sample_by_key(flagged(predictions), id_col, fraction, seed)
    return chosen.select("text", F.lit(1).alias("is_destructive"))


def confident_labels(scored: DataFrame, threshold: float = CONFIDENT_THRESHOLD) -> DataFrame:
    """`text, is_destructive`, distinct: 1 above the threshold, 0 below one minus it."""
    return _labels(_confident_texts(scored, threshold))


def confident_conflicts(scored: DataFrame, threshold: float = CONFIDENT_THRESHOLD) -> DataFrame:
    """`conflicts`: how many texts are confidently both."""
    texts = _confident_texts(scored, threshold)
    return texts.agg(F.count_if(F.col("_toxic") & F.col("_safe")).alias("conflicts"))


def new_texts(candidates: DataFrame, existing: DataFrame, text: str = "text") -> DataFrame:
    """The candidate rows whose text is not among the existing texts.

    Only rows whose text may be known move; see `membership`.
    """
    return without_known(candidates, existing, text)


def confident_feedback(
    scored: DataFrame, existing: DataFrame, threshold: float = CONFIDENT_THRESHOLD
) -> DataFrame:
    """`text, is_destructive` of confident rows whose text is not yet trained on.

    Candidates hold each text once, so no text is hot in the join.
    """
    return _labels(without_known(_confident_texts(scored, threshold), existing))


def _confident_texts(scored: DataFrame, threshold: float) -> DataFrame:
    """One row per confident text, saying which labels it got."""
    toxic = surely_toxic(F.col("toxicity_score"), threshold)
    safe = surely_safe(F.col("toxicity_score"), threshold)
    return (
        scored.filter(toxic | safe)
        .filter(is_content(F.col("original_content")))
        .groupBy(F.col("original_content").alias("text"))
        .agg(F.bool_or(toxic).alias("_toxic"), F.bool_or(safe).alias("_safe"))
    )


def _labels(texts: DataFrame) -> DataFrame:
    """A row per text and label."""
    labels = F.filter(
        F.array(F.when(F.col("_toxic"), 1), F.when(F.col("_safe"), 0)), lambda x: x.isNotNull()
    )
    return texts.select("text", F.explode(labels).alias("is_destructive"))
