"""Appends to the training table that count once, however often their job is run.

An append belongs to a run and an origin. The ledger, a small table in the
training folder that its readers don't see, lists the appends that are
complete. One that is listed is not made again. One that stopped half-way may
have left some of its files: then only the rows that are still missing are
added, as often as they are missing.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.schemas import LEDGER, TRAINING
from textmill.sinks.files import balanced, counted


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """`run, origin, rows, committed` of the complete appends."""
    try:
        return spark.read.schema(LEDGER).parquet(_ledger_path(path))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def read_training(spark: SparkSession, path: str, before: tuple[str, tuple[str, ...]] | None = None) -> DataFrame:
    """The training rows; with `before=(run, origins)` without those that this run added as these origins.

    So a job that is run again learns from the same rows as the first time.
    """
    rows = spark.read.schema(TRAINING).parquet(path)
    if before is None:
        return rows
    run, origins = before
    own = (F.col("run") == run) & F.col("origin").isin(*origins)
    return rows.filter(~F.coalesce(own, F.lit(False)))


def append_once(df: DataFrame, path: str, origin: str, run: str) -> int:
    """Add `text, is_destructive` rows for a run; returns how many were added now.

    Two jobs must not append for the same run and origin at the same time.
    """
    spark = df.sparkSession
    if not ledger(spark, path).filter(_is(run, origin)).isEmpty():
        return 0
    rows = df.select(
        "text", F.col("is_destructive").cast("int"), F.lit(origin).alias("origin"), F.lit(run).alias("run")
    )
    half = read_training(spark, path).filter(_is(run, origin))
    if not half.isEmpty():
        rows = rows.exceptAll(half.select(*rows.columns))
    with counted(balanced(rows)) as (marked, count):
        marked.write.mode("append").parquet(path)
    done = spark.range(1).select(
        F.lit(run).alias("run"), F.lit(origin).alias("origin"), F.lit(count()).cast("bigint").alias("rows"),
        F.current_timestamp().cast("string").alias("committed"),
    )
    done.coalesce(1).write.mode("append").parquet(_ledger_path(path))
    return count()


def _is(run: str, origin: str) -> Column:
    return (F.col("run") == run) & (F.col("origin") == origin)


def _ledger_path(path: str) -> str:
    # Readers pass by names that begin with an underscore.
    return f"{path}/_ledger"
