"""Session settings and the shared folder for staged data."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings the operators are tuned for. None of them changes a result.
SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    # Dedup state of a long-running stream outgrows the executor heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
SHUFFLE_PART_BYTES = 128 * 1024 * 1024
# Shuffled rows against compressed files, as a rule of thumb.
ROWS_PER_FILE_BYTE = 3

def session(app: str = "textmill", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; the master comes from spark-submit if not given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session without the setting falls back to a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    root = tempfile.mkdtemp(prefix="textmill-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def staging_path(spark: SparkSession, name: str) -> str:
    """A new, never reused path below the shared folder."""
    return f"{shared_root(spark)}/textmill/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write once and read back: cuts lineage and survives the loss of executors."""
    path = staging_path(df.sparkSession, name)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_shuffles(spark: SparkSession) -> None:
    """Have the shuffle files of ended statements removed now.

    Spark removes them when the driver collects its garbage, which by itself may be after
    many steps; its setting to remove them with a statement leaves out statements that write.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def file_bytes(spark: SparkSession, *paths: str) -> int:
    """The size of all files below the paths, from their listing alone."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths))
    return files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


@contextmanager
def sized_shuffles(spark: SparkSession, size: int) -> Iterator[int]:
    """Start shuffles with parts of an even size for an input of the given bytes.

    The default of 200 would make parts of hundreds of gigabytes at 100 TB.
    Starting high is safe: AQE joins partitions that turn out small.
    """
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    partitions = max(usual, -(-size * ROWS_PER_FILE_BYTE // SHUFFLE_PART_BYTES))
    before = spark.conf.get(INITIAL_PARTITIONS, None)
    spark.conf.set(INITIAL_PARTITIONS, str(partitions))
    try:
        yield partitions
    finally:
        if before is None:
            spark.conf.unset(INITIAL_PARTITIONS)
        else:
            spark.conf.set(INITIAL_PARTITIONS, before)


@contextmanager
def cached(df: DataFrame) -> Iterator[DataFrame]:
    """Keep a frame in memory, then on disk, for the length of the block."""
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield held
    finally:
        held.unpersist()
