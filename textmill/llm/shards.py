"""Shards of even size by fixed virtual slots, with DataFrame functions only.

Every record is hashed by its id into one of `SLOTS` virtual slots. The bytes of
a slot decide into how many pieces it falls: one, unless the slot holds far more
than its share (an id that repeats, many null ids); then its rows are dealt out
by their place in the written rows. A map says which shard a piece belongs to.
The map is a table with a version: dealing the pieces in turn gives the first,
and each rebalancing appends a version in which as few pieces as needed have moved. A record's slot never
changes, so a shard is found from the id alone, with a map of bounded size:
`SLOTS` pieces and `SPLIT` more for each shard at most, whatever the input.

Only that map is built on the driver. Places inside a shard come from the
pieces' row counts and from ranks inside a piece, so no task sorts a shard.

Defined cases: a null text has no bytes and the checksum of no bytes; rows with
a null id share a slot; rows that repeat are placed each, at places that follow id,
checksum and order in the input; one text larger than a shard's share fills its shard alone as far as
possible; an empty table gives an empty table; extra columns pass by unread.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textmill.session import stage, staging_path

SLOTS = 4096
# A slot of more than this part of a shard's share falls into pieces.
SPLIT = 64
# Bytes of a record besides its text.
OVERHEAD = 8

MAP = "version int, virtual_slot int, piece int, shard int, first bigint"


@dataclass(frozen=True)
class Piece:
    """A virtual slot, or a part of one, with what it holds."""

    slot: int
    part: int
    size: int
    rows: int


def deal(pieces: Sequence[Piece], shards: int) -> list[int]:
    """The first map: pieces to shards in turn."""
    return [number % shards for number in range(len(pieces))]


def rebalance(pieces: Sequence[Piece], current: Sequence[int], shards: int) -> list[int]:
    """A new map for so many shards that moves no more than needed for an even size.

    Shards above the mean release their smallest pieces until they are not, shards that are no
    more release all; the released ones, largest first, go to the shard with the
    fewest bytes.
    """
    shard_of = list(current)
    loads = [0] * shards
    held: list[list[int]] = [[] for _ in range(shards)]
    released = []
    for number, shard in enumerate(shard_of):
        if shard < shards:
            held[shard].append(number)
            loads[shard] += pieces[number].size
        else:
            released.append(number)
    mean = sum(p.size for p in pieces) / shards
    for shard, own in enumerate(held):
        own.sort(key=lambda n: (pieces[n].size, pieces[n].slot, pieces[n].part))
        for number in own[:-1]:
            if loads[shard] <= mean:
                break
            loads[shard] -= pieces[number].size
            released.append(number)
    lightest = [(load, shard) for shard, load in enumerate(loads)]
    heapq.heapify(lightest)
    for number in sorted(released, key=lambda n: (-pieces[n].size, pieces[n].slot, pieces[n].part)):
        load, shard = heapq.heappop(lightest)
        shard_of[number] = shard
        heapq.heappush(lightest, (load + pieces[number].size, shard))
    return shard_of


def _integers(values: Sequence[int], kind: str) -> F.Column:
    """A constant array, as one literal."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def store_map(spark: SparkSession, path: str, version: int, pieces: Sequence[Piece], shard_of: Sequence[int]) -> None:
    """Append a version to the map's table; `first` is a piece's first place in its shard."""
    if not pieces:
        return
    places: dict[int, int] = {}
    firsts = []
    for piece, shard in zip(pieces, shard_of):
        firsts.append(places.get(shard, 0))
        places[shard] = firsts[-1] + piece.rows
    columns = {
        "virtual_slot": _integers([p.slot for p in pieces], "int"),
        "piece": _integers([p.part for p in pieces], "int"),
        "shard": _integers(shard_of, "int"),
        "first": _integers(firsts, "bigint"),
    }
    arrays = spark.range(1, numPartitions=1).select(*[c.alias(n) for n, c in columns.items()])
    rows = arrays.select(F.lit(version).alias("version"), F.inline(F.arrays_zip(*columns)))
    rows.write.mode("append").parquet(path)


def read_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    """The pieces of one version."""
    return spark.read.schema(MAP).parquet(path).filter(F.col("version") == version)


def _sized(df: DataFrame, id_col: str, text: str, slots: int) -> DataFrame:
    """A narrow row a record, with its virtual slot and its place in the input."""
    octets = F.coalesce(F.col(text), F.lit("")).cast("binary")
    return df.select(
        F.col(id_col).alias("_id"),
        (F.octet_length(octets) + OVERHEAD).cast("bigint").alias("size"),
        F.crc32(octets).alias("text_crc32"),
        F.pmod(F.xxhash64(F.col(id_col)), F.lit(slots)).cast("int").alias("virtual_slot"),
        F.monotonically_increasing_id().alias("_row"),
    )


def _in_pieces(rows: DataFrame, shards: int) -> DataFrame:
    """The rows with the piece of their slot they belong to."""
    slots = rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"))
    total = slots.agg(F.coalesce(F.sum("bytes"), F.lit(1))).scalar()
    parts = slots.select(
        "virtual_slot", F.ceil(F.col("bytes") * (shards * SPLIT) / total).cast("int").alias("_parts")
    )
    piece = F.pmod(F.xxhash64("_row"), F.col("_parts")).cast("int")
    # At most `SLOTS` rows.
    return rows.join(F.broadcast(parts), "virtual_slot").withColumn("piece", piece).drop("_parts")


def place(
    df: DataFrame, shards: int, id_col: str = "doc_id", text: str = "text", slots: int = SLOTS,
    map_path: str | None = None,
) -> DataFrame:
    """`id, size, text_crc32, virtual_slot, piece, shard, slot, map_version` of every row.

    Shards hold about equal bytes; `slot` numbers a shard's rows without a gap
    from 0. The map's versions are written to `map_path` (a new folder below the
    shared one if not given): 1 as dealt, 2 as rebalanced, which is used.
    """
    spark = df.sparkSession
    rows = stage(_in_pieces(stage(_sized(df, id_col, text, slots), "records"), shards), "pieces")
    totals = rows.groupBy("virtual_slot", "piece").agg(F.sum("size").alias("size"), F.count("*").alias("rows"))
    pieces = sorted(
        (Piece(r["virtual_slot"], r["piece"], r["size"], r["rows"]) for r in totals.collect()),
        key=lambda p: (p.slot, p.part),
    )
    path = map_path or staging_path(spark, "shard-map")
    spark.range(0).select(*[F.lit(None).cast(t).alias(n) for n, t in (f.split() for f in MAP.split(", "))]).write.mode(
        "append"
    ).parquet(path)
    dealt = deal(pieces, shards)
    store_map(spark, path, 1, pieces, dealt)
    store_map(spark, path, 2, pieces, rebalance(pieces, dealt, shards))
    placed = rows.join(F.broadcast(read_map(spark, path, 2)), ["virtual_slot", "piece"])
    ranks = F.row_number().over(
        Window.partitionBy("virtual_slot", "piece").orderBy("_id", "text_crc32", "_row")
    )
    return placed.select(
        F.col("_id").alias(id_col), "size", "text_crc32", "virtual_slot", "piece", "shard",
        (F.col("first") + ranks - 1).alias("slot"), F.col("version").alias("map_version"),
    )
