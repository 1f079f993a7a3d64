"""Term features: tokens, term counts, inverse document frequency."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import HashingTF, StopWordsRemover, Tokenizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bytes of compressed texts whose terms a task counts.
COUNTED_BYTES = 4 << 20


def tokenize(df: DataFrame, text: str = "text", out: str = "words") -> DataFrame:
    """Lower-case pieces between white space. Rows without a text go."""
    return Tokenizer(inputCol=text, outputCol=out).transform(df.filter(F.col(text).isNotNull()))


def remove_stop_words(
    df: DataFrame, stop_words: Sequence[str], words: str = "words", out: str = "filtered"
) -> DataFrame:
    remover = StopWordsRemover(inputCol=words, outputCol=out, stopWords=list(stop_words))
    return remover.transform(df)


def hashed_counts(
    df: DataFrame, buckets: int, words: str = "words", out: str = "raw"
) -> DataFrame:
    """Sparse vectors of term counts in hash buckets."""
    return HashingTF(inputCol=words, outputCol=out, numFeatures=buckets).transform(df)


def bucket_total(vector: str) -> F.Column:
    """The sum over the stored entries of a sparse vector column."""
    values = F.unwrap_udt(F.col(vector)).getField("values")
    return F.aggregate(values, F.lit(0.0), lambda total, x: total + x)


def term_counts(df: DataFrame, id_col: str, words: str = "words", size: int = 0) -> DataFrame:
    """`id, term, tf` with the exact terms.

    Rows move once, by id, with their terms still in a list; as every group of
    (id, term) is then in one task, the counts move no more. A task keeps its
    counts in memory, so that there are as many as `size` asks for, the bytes of
    the files with the texts; without it Spark's settings decide.
    """
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = [max(usual, -(-size // COUNTED_BYTES))] if size else []
    return (
        df.select(id_col, words)
        .repartition(*parts, id_col)
        .select(id_col, F.explode(words).alias("term"))
        .groupBy(id_col, "term")
        .agg(F.count("*").alias("tf"))
    )


def inverse_document_frequency(
    df: DataFrame, words: str = "words", rows: int | None = None
) -> DataFrame:
    """`term, df, idf` with idf = ln((rows + 1) / (df + 1)).

    Repeats are dropped inside each row, so one shuffle on the term is enough.
    A row count that is known already saves one scan of the texts.
    """
    rows = F.lit(rows) if rows is not None else df.select(F.count("*")).scalar()
    return (
        df.select(F.explode(F.array_distinct(words)).alias("term"))
        .groupBy("term")
        .agg(F.count("*").alias("df"))
        .withColumn("idf", F.log((rows + F.lit(1.0)) / (F.col("df") + F.lit(1.0))))
    )
