"""Label-line text: `__label__A,__label__B text...`, one message per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.functions.labels import line_is_destructive, line_text, strip_blanks


def read_label_lines(spark: SparkSession, path: str) -> DataFrame:
    """`is_destructive, text`; blank lines are skipped."""
    return parse_label_lines(spark.read.text(path), "value")


def parse_label_lines(lines: DataFrame, line: str) -> DataFrame:
    stripped = lines.select(strip_blanks(F.col(line)).alias("line")).filter("line <> ''")
    return stripped.select(
        line_is_destructive(F.col("line")).alias("is_destructive"),
        line_text(F.col("line")).alias("text"),
    )
