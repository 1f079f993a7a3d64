"""The recurring cycle on new raw files only: clean them, score what was cleaned.

Every distinct version of a message is appended once; which version counts is
decided by the same rule as in the batch job, so the result does not depend on
how the files fell into cycles. The current version of every message is kept
beside the versions (`streaming/state`), so reading it does not go through the
whole history. Files that hold no whole JSON array are set aside.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.functions.dates import day_key
from textmill.operators.clean import (
    COMMENT_RECENCY,
    POST_RECENCY,
    comment_versions,
    post_versions,
)
from textmill.schemas import (
    COMMENT_VERSIONS,
    POST_VERSIONS,
    RAW_COMMENTS,
    RAW_POSTS,
    SCORED_VERSIONS,
)
from textmill.streaming.incremental import (
    append_new,
    new_files,
    new_json_arrays,
    quarantined,
)
from textmill.streaming.state import Newest

KEYS = ("chat_id", "id")


def _posts(spark: SparkSession, root: str) -> Newest:
    return Newest(spark, f"{root}/current_posts", POST_VERSIONS, KEYS, POST_RECENCY)


def _comments(spark: SparkSession, root: str) -> Newest:
    return Newest(spark, f"{root}/current_comments", COMMENT_VERSIONS, KEYS, COMMENT_RECENCY)


def _scores(spark: SparkSession, root: str) -> Newest:
    return Newest(spark, f"{root}/current_scores", SCORED_VERSIONS, KEYS, COMMENT_RECENCY)


def _take_in(
    spark: SparkSession, raw: str, schema: T.StructType, versions: Callable[[DataFrame], DataFrame],
    state: Newest, root: str, kind: str, options: dict[str, str],
) -> None:
    def shape(records: DataFrame) -> DataFrame:
        typed = versions(records)
        digest = F.md5(F.to_json(F.struct(*typed.columns)).cast("binary"))
        day = day_key(text=F.col("date"), seconds=F.col("ts"))
        return typed.withColumn("version", digest).withColumn("day", day)

    append_new(
        new_json_arrays(spark, raw, schema, **options), f"{root}/{kind[:-1]}_versions", f"{root}/progress/{kind}",
        [*KEYS, "version"], shape=shape, then=state.add, quarantine=f"{root}/quarantine/{kind}",
    )


def clean_new_posts(spark: SparkSession, raw: str, root: str, **options: str) -> None:
    """Take in the post files that arrived since the last run; the options are the reader's."""
    _take_in(spark, raw, RAW_POSTS, post_versions, _posts(spark, root), root, "posts", options)


def clean_new_comments(spark: SparkSession, raw: str, root: str, **options: str) -> None:
    """Take in the comment files that arrived since the last run; the options are the reader's."""
    _take_in(spark, raw, RAW_COMMENTS, comment_versions, _comments(spark, root), root, "comments", options)


def broken_raw_files(spark: SparkSession, root: str) -> DataFrame:
    """`kind, file, content` of the raw files that were set aside."""
    kinds = [quarantined(spark, f"{root}/quarantine/{k}").select(F.lit(k).alias("kind"), "*") for k in ("posts", "comments")]
    return kinds[0].union(kinds[1])


def current_posts(spark: SparkSession, root: str) -> DataFrame:
    """The cleaned posts as the batch job would give them."""
    return _posts(spark, root).read().drop("ts", "version", "day")


def current_comments(spark: SparkSession, root: str) -> DataFrame:
    """The cleaned comments as the batch job would give them."""
    return _comments(spark, root).read().drop("ts", "version", "day")


SCORE_COLUMNS = ("chat_id", "id", "version", "day", "text", "is_toxic_pred")


def score_new_comments(spark: SparkSession, model: PipelineModel, root: str) -> None:
    """Append the class of the comment versions not scored yet, with chat, id and version.

    A version without a text has no class, but takes the place of the one before.
    """

    def shape(versions: DataFrame) -> DataFrame:
        scored = model.transform(versions.select("*", F.col("text").alias("_text")).na.fill("", ["text"]))
        label = F.when(F.col("_text").isNotNull(), F.col("prediction").cast("int"))
        return scored.select(
            *[c for c in COMMENT_VERSIONS.names if c != "text"], F.col("_text").alias("text"), label.alias("is_toxic_pred")
        )

    append_new(
        new_files(spark, f"{root}/comment_versions", COMMENT_VERSIONS), f"{root}/comment_scores", f"{root}/progress/scores",
        [*KEYS, "version"], shape=shape, then=_scores(spark, root).add, stored=SCORE_COLUMNS,
    )


def current_scores(spark: SparkSession, root: str) -> DataFrame:
    """`chat_id, id, text, is_toxic_pred` of each comment's current version."""
    scored = _scores(spark, root).read().filter(F.col("is_toxic_pred").isNotNull())
    return scored.select(*KEYS, "text", "is_toxic_pred")
