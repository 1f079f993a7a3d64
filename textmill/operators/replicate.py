"""Copies of a table for load tests, and exact cuts of a stored table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


# Buckets of files, whose totals are added up by the driver.
_BUCKETS = 1024


def _copies(k: Column | int) -> Column:
    """One row per copy number 0..k-1; no second table, no join, no shuffle."""
    last = (k if isinstance(k, Column) else F.lit(k)) - F.lit(1)
    return F.explode(F.sequence(F.lit(0), last))


def replicate(df: DataFrame, k: int, id_col: str = "id", shift: str = "rows") -> DataFrame:
    """k copies of every row; copy i moves the id by i times the shift.

    `shift="rows"` moves by the row count, which may clash when ids have gaps;
    `shift="range"` moves by the width of the id range, which cannot.
    """
    if id_col not in df.columns:
        return df.select("*", _copies(k).alias("_copy")).drop("_copy")
    if shift == "rows":
        width = df.select(F.count("*")).scalar()
    elif shift == "range":
        width = df.select(F.max(id_col) - F.min(id_col) + 1).scalar()
    else:
        raise ValueError("shift is 'rows' or 'range'")
    return (
        df.select("*", _copies(k).alias("_copy"))
        .withColumn(id_col, F.col(id_col) + width * F.col("_copy"))
        .drop("_copy")
    )


def replicate_dates(df: DataFrame, k: int, date_col: str = "date") -> DataFrame:
    """k copies of every row; copy i lies i days earlier. Marks all as synthetic."""
    return (
        df.select("*", _copies(k).alias("_copy"))
        .withColumn(date_col, F.date_sub(F.col(date_col).cast("date"), F.col("_copy")))
        .withColumn("is_synthetic", F.lit(True))
        .drop("_copy")
    )


def _located(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.row_index").alias("_row"),
    )


def _bucket() -> Column:
    return F.pmod(F.xxhash64("_file"), F.lit(_BUCKETS))


def _within_first(spark: SparkSession, path: str, n: int) -> Column:
    """Whether a row belongs to the first n, in the order of file bucket, file name and row number.

    That position is a property of the stored files, so it stays the same on a
    retry or under another split of the scan. The cut is found on two levels:
    the totals of `_BUCKETS` buckets of files, then the files of one bucket.
    """
    if n <= 0:
        return F.lit(False)
    files = _located(spark, path).groupBy("_file").agg(F.count("*").alias("_rows"))
    files = files.withColumn("_bucket", _bucket())
    totals = files.groupBy("_bucket").agg(F.sum("_rows").alias("_rows")).orderBy("_bucket")
    before, cut = 0, None
    for bucket, rows in totals.collect():  # at most one row a bucket
        if before + rows >= n:
            cut = bucket
            break
        before += rows
    if cut is None:
        return F.lit(True)
    window = Window.partitionBy("_bucket").orderBy("_file").rowsBetween(Window.unboundedPreceding, 0)
    last = (
        files.filter(F.col("_bucket") == cut)
        .withColumn("_through", F.sum("_rows").over(window) + before)
        .filter(F.col("_through") >= n)
        .orderBy("_file")
        .select("_file", (F.lit(n) - F.col("_through") + F.col("_rows")).alias("_part"))
        .first()
    )
    whole = (_bucket() < cut) | ((_bucket() == cut) & (F.col("_file") < last["_file"]))
    return whole | ((F.col("_file") == last["_file"]) & (F.col("_row") < last["_part"]))


def take_exact(spark: SparkSession, path: str, n: int) -> DataFrame:
    """Exactly n rows of a stored table (all, if it has fewer), cut in every task.

    `limit(n)` would send the n rows through one task.
    """
    return _located(spark, path).filter(_within_first(spark, path, n)).drop("_file", "_row")


def grow_to(spark: SparkSession, path: str, n: int) -> DataFrame:
    """Exactly n rows made of whole copies of a stored table and a part of one more."""
    rows = spark.read.parquet(path).count()
    if rows == 0:
        raise ValueError("an empty table cannot grow")
    whole, rest = divmod(n, rows)
    copies = F.lit(whole) + F.when(_within_first(spark, path, rest), 1).otherwise(0)
    return (
        _located(spark, path)
        .withColumn("_copies", copies)
        .filter("_copies > 0")
        .withColumn("_copy", _copies(F.col("_copies")))
        .drop("_file", "_row", "_copies", "_copy")
    )
