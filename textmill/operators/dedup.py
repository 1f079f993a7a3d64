"""One row per key, and distinct rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _first_by(df: DataFrame, keys: Sequence[str], order: list) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    # Spark keeps one row per key in every task before the shuffle
    # (WindowGroupLimit), so a hot key sends one row per task, not its group.
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def first_per_text(df: DataFrame, text: str, order: Sequence[str]) -> DataFrame:
    """The row with the smallest order columns of each text.

    Texts are told apart by 128 bits of digest, so none is compared or sorted.
    """
    digests = {"_digest1": F.xxhash64(text), "_digest2": F.xxhash64(F.lit(1), text)}
    firsts = _first_by(
        df.withColumns(digests), list(digests), [F.col(c).asc_nulls_last() for c in order]
    )
    return firsts.drop(*digests)


def latest_by_key(df: DataFrame, keys: Sequence[str], recency: Sequence[str]) -> DataFrame:
    """The row with the greatest recency columns of each key."""
    return _first_by(df, keys, [F.col(c).desc_nulls_last() for c in recency])


def earliest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the smallest order columns of each key."""
    return _first_by(df, keys, [F.col(c).asc_nulls_last() for c in order])
