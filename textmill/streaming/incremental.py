"""Incremental cleaning and scoring: each run handles the files that are new."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.functions.text import one_line
from textmill.schemas import QUARANTINE
from textmill.session import cached
from textmill.sinks.files import balanced
from textmill.sources.json_files import BROKEN, FILE, marked


def new_files(
    spark: SparkSession, path: str, schema: T.StructType, form: str = "parquet", **options: str
) -> DataFrame:
    """A stream over the files of a folder. Files are taken once each."""
    return spark.readStream.schema(schema).format(form).options(**options).load(path)


def new_json_arrays(
    spark: SparkSession, path: str, schema: T.StructType, **options: str
) -> DataFrame:
    """A stream over raw files of one JSON array each, at any depth, with what broken files leave marked.

    How many files a step takes (`maxFilesPerTrigger`) changes no result.
    """
    own = {"multiLine": "true", "recursiveFileLookup": "true", "columnNameOfCorruptRecord": BROKEN}
    stream = new_files(spark, path, marked(schema), "json", **own, **options)
    return stream.withColumn(FILE, F.col("_metadata.file_path"))


def clean_stream(stream: DataFrame, text: str = "text") -> DataFrame:
    """Messages with normalised texts."""
    return stream.withColumn(text, one_line(F.col(text)))


def score_stream(
    model: PipelineModel, stream: DataFrame, keys: Sequence[str] = ("id",)
) -> DataFrame:
    """The keys, `text` and `is_toxic_pred` of new messages."""
    scored = model.transform(stream.filter(F.col("text").isNotNull()))
    return scored.select(*keys, "text", F.col("prediction").cast("int").alias("is_toxic_pred"))


def _same(one: DataFrame, other: DataFrame, columns: Sequence[str]) -> Column:
    return reduce(Column.__and__, (one[c].eqNullSafe(other[c]) for c in columns))


def _stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def append_new(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    day: str = "day",
    shape: Callable[[DataFrame], DataFrame] | None = None,
    then: Callable[[DataFrame], None] | None = None,
    stored: Sequence[str] | None = None,
    quarantine: str | None = None,
) -> None:
    """Append the rows whose (day, keys) are not stored yet, once each, then stop.

    A step drops its own repeats and those stored for the days it touches; of
    the other days no file is opened. Nothing is late and nothing is kept as
    state, so the result depends neither on the order of files nor on how they
    fall into steps, and a step that runs again after a failure adds nothing
    twice. A step writes as many files as its days and their size ask for.
    `shape` makes the rows from a step's records; `stored` names the columns
    that are kept, if not all; `then` gets a step's rows once they are stored,
    and may get them again after a failure. What broken files left goes to the
    folder `quarantine`, as `file, content`.
    """
    identity = [day, *keys]

    def add(batch: DataFrame, number: int) -> None:
        # A step reads its files once.
        with cached(batch) as records:
            if BROKEN in batch.columns:
                set_aside(records, number)
                records = records.filter(F.col(BROKEN).isNull()).drop(BROKEN, FILE)
            rows = records if shape is None else shape(records)
            store(rows if stored is None else rows.select(*stored))
            if then is not None:
                then(rows)

    def set_aside(rows: DataFrame, number: int) -> None:
        broken = rows.filter(F.col(BROKEN).isNotNull())
        if quarantine is not None and not broken.isEmpty():
            named = broken.select(F.col(FILE).alias("file"), F.col(BROKEN).alias("content"))
            # A step that runs again writes to the same place.
            named.write.mode("overwrite").parquet(f"{quarantine}/step={number}")

    def store(batch: DataFrame) -> None:
        fresh = batch.dropDuplicates(identity)
        old = _stored(batch.sparkSession, path, batch.schema)
        if old is not None:
            days = batch.select(day).distinct()
            touched = old.join(days, _same(old, days, [day]), "left_semi").select(*identity)
            fresh = fresh.join(touched, _same(fresh, touched, identity), "left_anti")
        balanced(fresh, day).write.mode("append").partitionBy(day).parquet(path)

    writer = stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()


def quarantined(spark: SparkSession, path: str) -> DataFrame:
    """`file, content` of the raw files that were set aside in a folder."""
    kept = _stored(spark, path, QUARANTINE)
    return (spark.createDataFrame([], QUARANTINE) if kept is None else kept).select("file", "content")


def run_available(
    stream: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = ()
) -> None:
    """Append what is available now to Parquet files, then stop.

    Progress lives at the checkpoint, so the next run goes on from there and
    every file is written once.
    """
    writer = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    query = writer.start(path)
    query.awaitTermination()
