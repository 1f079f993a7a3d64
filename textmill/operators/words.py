"""Word counts and top-k word reports."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.functions.text import lower_space_words, letter_words, space_words, stripped_words


def count_words(
    df: DataFrame,
    text: str,
    split: Callable[[Column], Column] = space_words,
    longer_than: int = 0,
    stop_words: Sequence[str] | DataFrame = (),
) -> DataFrame:
    """`word, count` over the given texts.

    Words are counted in each task before the one shuffle on the word. A list of
    stop words filters before counting; a frame with a column `word` is
    anti-joined to the counts, which are far fewer than the words. Nulls among
    the stop words stand for nothing.
    """
    words = df.select(F.explode(split(F.col(text))).alias("word"))
    if longer_than:
        words = words.filter(F.length("word") > longer_than)
    joined = isinstance(stop_words, DataFrame)
    listed = [] if joined else [w for w in stop_words if w is not None]
    if listed:
        words = words.filter(~F.col("word").isin(listed))
    counts = words.groupBy("word").agg(F.count("*").alias("count"))
    if joined:
        counts = counts.join(stop_words.select("word").distinct(), "word", "left_anti")
    return counts


def top_words(counts: DataFrame, k: int) -> DataFrame:
    """The k most frequent words; equal counts are ordered by word."""
    return counts.orderBy(F.desc("count"), F.asc("word")).limit(k)


def flagged(df: DataFrame, flag: str = "is_toxic_pred") -> DataFrame:
    """The rows predicted positive; the comparison reaches the Parquet scan."""
    return df.filter(F.col(flag) == 1)


def frequent_pieces(df: DataFrame, text: str, k: int = 10) -> DataFrame:
    """Pieces between spaces longer than four characters."""
    return top_words(count_words(df, text, space_words, 4), k)


def frequent_lower_pieces(df: DataFrame, text: str, stop_words, k: int = 10) -> DataFrame:
    """Lower-case pieces between spaces longer than three characters, without stop words."""
    return top_words(count_words(df, text, lower_space_words, 3, stop_words), k)


def frequent_letter_runs(df: DataFrame, text: str, k: int = 300) -> DataFrame:
    """Runs of letters longer than two characters."""
    return top_words(count_words(df, text, letter_words, 2), k)


def frequent_stripped(df: DataFrame, text: str, stop_words, k: int = 15) -> DataFrame:
    """Pieces stripped to letters, longer than three characters, without stop words."""
    return top_words(count_words(df, text, stripped_words, 3, stop_words), k)
