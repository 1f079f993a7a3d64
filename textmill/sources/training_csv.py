"""Training rows kept as CSV files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TEXT = "text"
# The names a label column may have.
LABELS = ("is_destructive", "label")
# What stands for null in a file; an empty text is an empty quoted field.
NULL = "\\N"


def _records(spark: SparkSession, path: str) -> DataFrame:
    """`file, first, second, broken` of every record; records may span lines."""
    return (
        spark.read.schema("first string, second string, broken string")
        .option("header", False)
        .option("multiLine", True)
        .option("escape", '"')
        .option("nullValue", NULL)
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "broken")
        .option("recursiveFileLookup", True)
        .csv(path)
        .select("first", "second", "broken", F.col("_metadata.file_path").alias("file"))
    )


def _name(column: str) -> F.Column:
    """A header's field without quotes, blanks and byte order mark."""
    return F.lower(F.trim(F.translate(F.col(column), '"\ufeff', "")))


def _is_header() -> F.Column:
    """Whether a record names the two columns; true as well if the text comes first."""
    first, second = _name("first"), _name("second")
    return (first.isin(*LABELS) & (second == TEXT)) | ((first == TEXT) & second.isin(*LABELS))


def read_training_csv(spark: SparkSession, path: str) -> DataFrame:
    """`is_destructive, text` as strings, without malformed records.

    Every file is read by its own header, which names a label (`is_destructive`
    or `label`) and the text, in either order, quoted or not; a file without one
    is an error. Quotes inside a field are doubled, line breaks and empty texts
    are kept. As records may span lines, a file is read by one task:
    `append_training_csv` writes files of an even size.
    """
    records = _records(spark, path)
    header = F.coalesce(_is_header(), F.lit(False))
    headers = records.filter(header).groupBy("file").agg(F.max(_name("first") == TEXT).alias("text_first"))
    rows = records.filter(~header & F.col("broken").isNull()).join(headers, "file", "left")
    known = F.when(
        F.col("text_first").isNull(),
        F.raise_error(F.concat(F.lit("no header of a text and a label in "), F.col("file"))),
    ).otherwise(F.col("text_first"))
    return rows.withColumn("known", known).select(
        F.when(F.col("known"), F.col("second")).otherwise(F.col("first")).alias("is_destructive"),
        F.when(F.col("known"), F.col("first")).otherwise(F.col("second")).alias("text"),
    )


def malformed_records(spark: SparkSession, path: str) -> DataFrame:
    """`file, broken`: the records that `read_training_csv` leaves out."""
    records = _records(spark, path)
    # All fields take part, so that a record is judged by all of them.
    whole = F.length(F.concat_ws("", "first", "second")) >= 0
    return records.filter(F.col("broken").isNotNull() & whole).select("file", "broken")
