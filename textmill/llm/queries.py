"""One registered query for each corpus operator, and the SQL that checks it.

A query applies its operator with production parameters to its whole table and
derives digest columns from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.llm import (
    byte_pairs,
    conversations,
    decontamination,
    edit_fingerprints,
    hard_negatives,
    language_id,
    language_model,
    license_scan,
    line_duplicates,
    near_duplicates,
    oracles,
    quality,
    shards,
    warc,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql:
            ORACLES[name] = sql
        return function

    return register


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**QUERIES, "pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {**ORACLES, **({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})}


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _digest(column: str) -> F.Column:
    return F.sha2(F.col(column).cast("binary"), 256)


def _remainder(divisor: int, value: int) -> F.Column:
    """Whether the checksum of the id leaves this remainder."""
    return F.crc32(F.col("doc_id").cast("string")) % divisor == value


@_query("op1_language_id")
def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, learned from those that are not held out."""
    documents = _table(spark, folder, "documents")
    held_out = _remainder(3, 1)
    model = language_id.fit(documents.filter(~held_out))
    found = language_id.predict(documents, model)
    return found.select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected"
    )


@_query("op2_license_scan", license_scan.oracle_sql())
def op2_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """License phrases and template notices of every document."""
    return license_scan.scan(_table(spark, folder, "documents"))


@_query("op3_warc")
def op3_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Every page's record, written to archives and read back."""
    records = warc.archive(_table(spark, folder, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")


@_query("op4_language_model")
def op4_language_model(spark: SparkSession, folder: str) -> DataFrame:
    """Log10 probability of every document under a context tree of the training documents."""
    return language_model.score(_table(spark, folder, "documents"), _remainder(7, 2))


@_query("op8_decontamination", oracles.DECONTAMINATION)
def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document that lie in a window of a benchmark item."""
    found = decontamination.contaminated(
        _table(spark, folder, "documents"), _table(spark, folder, "benchmark")
    )
    items = F.concat_ws(",", "items").alias("items")
    return found.withColumn("items", items).select(
        "doc_id", "n_words", "n_hit", "n_items", _digest("items").alias("items_sha256"), "contaminated"
    )


@_query("op9_edit_fingerprints")
def op9_edit_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and the group of like documents."""
    return edit_fingerprints.with_groups(edit_fingerprints.fingerprint_edits(_table(spark, folder, "documents")))


@_query("op5_quality")
def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every document from its text, its source and the source's part in its language."""
    return quality.classify(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


@_query("op6_near_duplicates", oracles.NEAR_DUPLICATES)
def op6_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Connected groups of documents of which 85 in 100 shingles are common."""
    return near_duplicates.groups(_table(spark, folder, "documents"))


@_query("op7_byte_pairs")
def op7_byte_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Encode and decode every document's text."""
    vocabulary = byte_pairs.read_vocabulary(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return byte_pairs.round_trip(_table(spark, folder, "documents"), vocabulary).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@_query("op10_line_duplicates")
def op10_line_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's text without its repeated and nearly repeated lines."""
    documents = _table(spark, folder, "documents").select("doc_id", "text")
    kept = line_duplicates.drop_repeats(documents, removed="n_removed")
    return kept.select("doc_id", "n_removed", F.length("text").cast("bigint").alias("n_chars"), "text")


@_query("op11_hard_negatives", oracles.HARD_NEGATIVES)
def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of every fiftieth vector's nearest rows of its label."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(_table(spark, folder, "embeddings").withColumn("label", moved))


@_query("op12_conversations", oracles.CONVERSATIONS)
def op12_conversations(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation's faults after planted damage, and its cheapest repair."""
    table = _table(spark, folder, "conversations")
    repaired = conversations.repair(conversations.damage(table)).withColumnRenamed("conv_id", "_conv")
    every = table.select("conv_id").distinct()
    found = every.join(repaired, every["conv_id"].eqNullSafe(repaired["_conv"]), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in conversations.COUNTS]
    return found.select(
        "conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


@_query("op13_shards")
def op13_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's shard of 24, of near equal bytes."""
    placed = shards.place(_table(spark, folder, "documents"), 24)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "map_version",
    )
