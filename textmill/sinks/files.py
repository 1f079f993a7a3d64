"""File sinks."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from textmill.sources.training_csv import NULL

# Bytes of records that a task cuts into arrays at once, and the record that goes beyond.
PIECE = 4 << 20
_JSON_ARRAY = pa.schema([(name, pa.string()) for name in ("date", "batch", "value")])


def balanced(df: DataFrame, *columns: str) -> DataFrame:
    """Even output files: AQE joins small partitions and splits large ones,
    also when most rows share one value of the columns."""
    return df.hint("rebalance", *columns)


@contextmanager
def counted(df: DataFrame) -> Iterator[tuple[DataFrame, Callable[[], int]]]:
    """The frame, and a function that tells how many rows went through it once it was written.

    The rows are counted on their way, so nothing is read for the count.
    """
    seen = Observation()
    yield df.observe(seen, F.count(F.lit(1)).alias("rows")), lambda: seen.get["rows"]


def write_parquet(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Replace the files at a path."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def append_training(df: DataFrame, path: str, origin: str) -> None:
    """Add `text, is_destructive` rows to the training table, marked with their origin."""
    rows = df.select("text", F.col("is_destructive").cast("int"), F.lit(origin).alias("origin"))
    balanced(rows).write.mode("append").parquet(path)


def append_training_csv(df: DataFrame, path: str) -> None:
    """Add rows to a CSV training folder, in the column order of its base file.

    Fields are quoted, so line breaks and empty texts come back as they are.
    """
    (
        balanced(df.select("is_destructive", "text"))
        .write.mode("append")
        .option("header", True)
        .option("quoteAll", True)
        .option("escape", '"')
        .option("nullValue", NULL)
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_day_buckets(df: DataFrame, path: str, day: Column) -> None:
    """JSON lines below `date=yyyy-MM-dd` folders. A crowded day gets several files."""
    rows = df.select(F.to_json(F.struct("*")).alias("value"), day.alias("date"))
    balanced(rows, "date").write.mode("append").partitionBy("date").text(path)


def write_json_batches(df: DataFrame, path: str, day: Column, rows_per_file: int = 500) -> None:
    """Files of one JSON array each, below `date=` folders, as collectors leave them.

    Every task cuts its own rows into arrays, `PIECE` bytes of an Arrow batch at a
    time: no shuffle, no day or message repeated often can outgrow a file, and
    long messages don't take more memory than short ones.
    """
    rows = df.select(day.alias("date"), F.to_json(F.struct("*")).alias("value"))
    (
        rows.mapInArrow(_json_arrays(rows_per_file), "date string, batch string, value string")
        .write.mode("append")
        .partitionBy("date", "batch")
        .text(path)
    )


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of the batches, PIECE bytes and a record at most at a time."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy().astype(np.int64))
        starts = np.flatnonzero(np.diff(ends // PIECE, prepend=-1)) if len(ends) else []
        for start, end in zip(starts, [*starts[1:], batch.num_rows]):
            yield batch.slice(start, end - start)


def _json_arrays(rows_per_file: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            days = batch.column(0).dictionary_encode()
            number = np.array(days.indices.fill_null(len(days.dictionary)))
            order = np.argsort(number, kind="stable")
            number = number[order]
            # A file begins with a day, and after so many rows of it.
            first = np.flatnonzero(np.append(True, number[1:] != number[:-1]))
            place = np.arange(len(number)) - np.repeat(first, np.diff(np.append(first, len(number))))
            starts = np.flatnonzero(place % rows_per_file == 0)
            offsets = pa.array(np.append(starts, len(number)).astype(np.int32))
            values = pa.ListArray.from_arrays(offsets, batch.column(1).take(pa.array(order)))
            joined = pc.binary_join_element_wise("[", pc.binary_join(values, ",\n"), "]", "")
            names = pa.array([uuid.uuid4().hex for _ in starts])
            dates = batch.column(0).take(pa.array(order[starts]))
            yield pa.RecordBatch.from_arrays([dates, names, joined], schema=_JSON_ARRAY)

    return cut


def discard(df: DataFrame) -> None:
    """Compute every row and keep none, for timing."""
    df.write.format("noop").mode("overwrite").save()
