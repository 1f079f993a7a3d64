"""The raw files themselves, by age. Nothing is deleted."""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def raw_file_ages(spark: SparkSession, path: str, as_of: datetime, days: int = 7) -> DataFrame:
    """`path, modified, bytes, keep` of every file; contents are not read."""
    first = F.timestamp_seconds(F.lit((as_of - timedelta(days=days)).timestamp()))
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    )
    return files.select(
        "path",
        F.col("modificationTime").alias("modified"),
        F.col("length").alias("bytes"),
        (F.col("modificationTime") >= first).alias("keep"),
    )


def modified_after(as_of: datetime, days: int = 7) -> dict[str, str]:
    """Reader options that skip the files `raw_file_ages` would not keep.

    The reader compares strictly, so the bound lies one second earlier.
    """
    first = (as_of - timedelta(days=days, seconds=1)).astimezone(UTC)
    return {"modifiedAfter": first.strftime("%Y-%m-%dT%H:%M:%S"), "timeZone": "UTC"}
