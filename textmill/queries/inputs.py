"""The given tables, and frames Spark derives from all of their rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.functions.sampling import sample_bound
from textmill.functions.scores import decision
from textmill.functions.text import one_line
from textmill.streaming.incremental import new_files


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def table_stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A stream over the files of a table, which is one file or a folder of them."""
    # A stream takes a single file by a pattern only.
    return new_files(spark, f"{folder}/{name}.parque[t]", table(spark, folder, name).schema)


def labelled(spark: SparkSession, folder: str) -> DataFrame:
    """`doc_id, text, is_destructive` of the documents with a label."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").select("doc_id", F.col("toxic").alias("is_destructive"))
    return documents.join(labels, "doc_id")


def training(spark: SparkSession, folder: str) -> DataFrame:
    """`doc_id, text, label` for the classifiers."""
    return labelled(spark, folder).select(
        "doc_id", "text", F.col("is_destructive").cast("double").alias("label")
    )


def messages(spark: SparkSession, folder: str) -> DataFrame:
    """The documents as messages: `id, author_name, text`."""
    return table(spark, folder, "documents").select(
        F.col("doc_id").alias("id"), F.col("source").alias("author_name"), "text"
    )


def scored(spark: SparkSession, folder: str) -> DataFrame:
    """All documents with a score both engines can compute: a digest of the id
    in hundredths from 0.00 to 1.00. It stands in for a model's probability."""
    digest = F.substring(F.md5(F.col("doc_id").cast("string").cast("binary")), 1, 4)
    number = F.conv(digest, 16, 10).cast("int")
    score = (F.floor(number * 101 / 65536) / 100).cast("double")
    return table(spark, folder, "documents").select(
        F.col("doc_id").alias("id"),
        F.col("source").alias("author_name"),
        F.col("text").alias("original_content"),
        score.alias("toxicity_score"),
        decision(score).alias("is_toxic_pred"),
    )


# The same frame in SQL.
SCORED_SQL = """
    select id, author_name, original_content, toxicity_score,
           case when toxicity_score > cast(0.40 as double) then cast(1 as double)
                else cast(0 as double) end as is_toxic_pred
    from (
        select doc_id as id, source as author_name, text as original_content,
               floor(cast('0x' || substr(md5(cast(doc_id as varchar)), 1, 4) as integer)
                     * 101 / cast(65536 as double)) / 100 as toxicity_score
        from documents
    ) s
"""


def digest_in_sample_sql(key: str, fraction: float) -> str:
    """The sampling rule in SQL."""
    if fraction >= 1.0:
        return "true"
    digest = f"md5('42:' || cast({key} as varchar))"
    return f"{digest} < '{sample_bound(fraction)}'"


def raw_posts(spark: SparkSession, folder: str) -> DataFrame:
    """The documents as raw posts. Some arrive under the other key spelling."""
    chat = F.lit(-1000000000000) - F.substring("source", 4, 10).cast("bigint")
    other = F.col("lang") == "de"
    return table(spark, folder, "documents").select(
        F.when(~other, F.col("doc_id")).alias("post_id"),
        F.when(~other, chat).alias("channel_id"),
        F.when(other, F.col("doc_id")).alias("id"),
        F.when(other, chat).alias("chat_id"),
        F.lit("2024-01-01").alias("date"),
        F.col("n_chars").alias("ts"),
        "text",
        F.col("n_chars").alias("views"),
    )


def raw_comments(spark: SparkSession, folder: str) -> DataFrame:
    """The conversations as raw comments: a turn is a newer version of its conversation."""
    return table(spark, folder, "conversations").select(
        F.col("conv_id").alias("comment_id"),
        F.col("conv_id").alias("post_id"),
        F.lit(-1000000000000).alias("channel_id"),
        F.col("role").alias("author_name"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("turn").cast("int"))
        .cast("string")
        .alias("date"),
        F.col("turn").alias("ts"),
        "text",
    )


def line_form(text: F.Column) -> F.Column:
    """A text as one line without white space at its ends, for line-based files."""
    return F.regexp_replace(one_line(text), r"(?U)^\s+|\s+$", "")
