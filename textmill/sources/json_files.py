"""Raw message files: JSON arrays below date folders, and JSON lines."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_json_arrays(
    spark: SparkSession, path: str, schema: T.StructType, **options: str
) -> DataFrame:
    """Files that each hold one JSON array, at any depth below the path.

    Folder names are not read as columns: a file may lie under another date
    than its records, so dates come from the records only.
    """
    return (
        spark.read.schema(schema)
        .option("multiLine", True)
        .option("recursiveFileLookup", True)
        .options(**options)
        .json(path)
    )


# What a raw file that holds no whole JSON array leaves in place of records.
BROKEN, FILE = "_broken", "_file"


def marked(schema: T.StructType) -> T.StructType:
    """The schema with the column that takes the content of a file that can't be read."""
    return T.StructType([*schema.fields, T.StructField(BROKEN, T.StringType())])


def read_marked_arrays(spark: SparkSession, path: str, schema: T.StructType, **options: str) -> DataFrame:
    """As `read_json_arrays`; a file without a whole JSON array gives one row, with its content in `_broken`."""
    return read_json_arrays(spark, path, marked(schema), columnNameOfCorruptRecord=BROKEN, **options)


@contextmanager
def whole_records(raw: DataFrame) -> Iterator[tuple[DataFrame, Callable[[], int]]]:
    """The records without what broken files left, and a function that tells how many files those were.

    They are counted on the way of the records: ask after the frame was used
    once. A frame that is not marked has none.
    """
    if BROKEN not in raw.columns:
        yield raw, lambda: 0
        return
    seen = Observation()
    counted = raw.observe(seen, F.count_if(F.col(BROKEN).isNotNull()).alias("broken"))
    yield counted.filter(F.col(BROKEN).isNull()).drop(BROKEN), lambda: seen.get["broken"]


def broken_files(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """`file, content` of the raw files that hold no whole JSON array, such as cut-off ones."""
    rows = read_marked_arrays(spark, path, schema)
    # Spark answers no query on the mark alone, so the filter names the other columns too.
    whole = F.length(F.to_json(F.struct(*schema.names))) >= 0
    return rows.filter(F.col(BROKEN).isNotNull() & whole).select(
        F.col("_metadata.file_path").alias("file"), F.col(BROKEN).alias("content")
    )


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Files with one JSON object per line; large files are split."""
    return spark.read.schema(schema).option("recursiveFileLookup", True).json(path)
