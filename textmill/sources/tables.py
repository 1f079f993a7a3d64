"""Tables by name, Parquet by path, and small local rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession


class MissingTable(LookupError):
    """A job's input table does not exist."""


def require_table(spark: SparkSession, name: str) -> DataFrame:
    """The table, or an error that names it."""
    if not spark.catalog.tableExists(name):
        raise MissingTable(f"table {name} not found")
    return spark.table(name)


def read_parquet(
    spark: SparkSession, path: str, columns: Sequence[str], where: Column | None = None
) -> DataFrame:
    """The named columns of the rows that match; both reach the scan."""
    df = spark.read.parquet(path)
    if where is not None:
        df = df.filter(where)
    return df.select(*columns)


def local_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A frame of a few rows written in the program, such as a word list."""
    return spark.createDataFrame(list(rows), schema)
