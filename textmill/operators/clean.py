"""Raw messages to clean tables, and the checks on training rows and content."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.functions.dates import day_key
from textmill.functions.labels import numeric_label
from textmill.functions.text import is_content, one_line
from textmill.operators.dedup import latest_by_key


def first_present(df: DataFrame, *names: str) -> Column:
    """The first non-null value among those of the columns that exist."""
    present = [F.col(n) for n in names if n in df.columns]
    if not present:
        raise ValueError(f"none of the columns {names} is present")
    return F.coalesce(*present)


def post_versions(raw: DataFrame) -> DataFrame:
    """Typed, normalised posts before deduplication, with their recency in `ts`.

    Both key spellings are read, ids stay 64 bit wide, rows without an id go.
    """
    return raw.select(
        first_present(raw, "post_id", "id").cast("bigint").alias("id"),
        first_present(raw, "channel_id", "chat_id").cast("bigint").alias("chat_id"),
        F.col("date").cast("string").alias("date"),
        one_line(F.col("text")).alias("text"),
        F.col("views").cast("bigint").alias("views"),
        F.col("ts").cast("bigint").alias("ts"),
    ).filter(F.col("id").isNotNull())


def comment_versions(raw: DataFrame) -> DataFrame:
    """Typed, normalised comments before deduplication, with their recency in `ts`."""
    return raw.select(
        first_present(raw, "comment_id", "id").cast("bigint").alias("id"),
        F.col("post_id").cast("bigint").alias("post_id"),
        first_present(raw, "channel_id", "chat_id").cast("bigint").alias("chat_id"),
        F.col("author_name"),
        F.col("date").cast("string").alias("date"),
        one_line(F.col("text")).alias("text"),
        F.col("ts").cast("bigint").alias("ts"),
    ).filter(F.col("id").isNotNull())


# Which version of a message survives: the newest, then the most viewed; the
# remaining columns only make the choice unique.
POST_RECENCY = ("ts", "views", "date", "text")
COMMENT_RECENCY = ("ts", "date", "text", "author_name", "post_id")


def clean_posts(raw: DataFrame, keys: tuple[str, ...] = ("chat_id", "id"), day: str | None = None) -> DataFrame:
    """`id, chat_id, date, text, views`, one row per key; with `day`, a column of that name says the day."""
    return _dated(latest_by_key(post_versions(raw), keys, POST_RECENCY), day)


def clean_comments(raw: DataFrame, keys: tuple[str, ...] = ("chat_id", "id"), day: str | None = None) -> DataFrame:
    """`id, post_id, chat_id, author_name, date, text`, one row per key; with `day`, a column of that name says the day."""
    return _dated(latest_by_key(comment_versions(raw), keys, COMMENT_RECENCY), day)


def _dated(versions: DataFrame, day: str | None) -> DataFrame:
    """Without `ts`, which is the day of a record whose date can't be read."""
    if day is not None:
        versions = versions.withColumn(day, day_key(text=F.col("date"), seconds=F.col("ts")))
    return versions.drop("ts")


def training_rows(df: DataFrame, text: str = "text") -> DataFrame:
    """`text, label` of the rows with a text and a numeric label."""
    label = numeric_label(first_present(df, "is_destructive", "label").cast("string"))
    return df.select(F.col(text).alias("text"), label.alias("label")).filter(
        F.col("text").isNotNull() & F.col("label").isNotNull()
    )


def with_content(df: DataFrame, text: str) -> DataFrame:
    """The rows whose text carries content."""
    return df.filter(is_content(F.col(text)))
