"""Rows whose text is not among known texts, without moving those that surely are new.

A sketch of texts is a set of bitmaps, one bit a text, by a digest. It is built
by partial aggregation and has at most `BITMAPS` rows of 4 KB, whatever the
number of texts, so every task may hold it. A text whose bit is not set is not
among the sketched ones. Candidates that the known texts' sketch does not name
are new and stay where they are; the others meet the known texts that *their*
sketch names, by digest and text. Sketches that are too full for the data only
let more rows meet; the result is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.session import stage

# Rows of a sketch: 16 MB at most.
BITMAPS = 4096
# Bits of a row, as Spark's bitmap functions have them.
_BITS = 32768

_DIGEST, _MAYBE = "_text_digest", "_maybe"


def _slot(digest: Column, bitmaps: int) -> tuple[Column, Column]:
    """The bitmap and the place in it of a digest."""
    slot = F.pmod(digest, F.lit(bitmaps * _BITS))
    return F.floor(slot / _BITS).cast("int"), slot % _BITS


def sketch(df: DataFrame, text: str, bitmaps: int = BITMAPS) -> DataFrame:
    """`number, bitmap` of the texts of a frame. Texts don't move."""
    number, place = _slot(F.xxhash64(text), bitmaps)
    return df.filter(F.col(text).isNotNull()).groupBy(number.alias("number")).agg(
        F.bitmap_construct_agg(place).alias("bitmap")
    )


def maybe_known(df: DataFrame, text: str, known: DataFrame, bitmaps: int = BITMAPS, flag: str = _MAYBE) -> DataFrame:
    """The rows with a flag: whether the text may be among the sketched ones. Null texts are not."""
    number, place = _slot(F.xxhash64(text), bitmaps)
    held = known.select(F.col("number").alias("_number"), F.col("bitmap").alias("_bitmap"))
    byte = F.conv(F.hex(F.substr("_bitmap", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = byte.bitwiseAND(F.element_at(F.array(*[F.lit(1 << k) for k in range(8)]), (place % 8).cast("int") + 1)) > 0
    marked = df.join(F.broadcast(held), number == F.col("_number"), "left")  # at most `bitmaps` rows
    return marked.select(*df.columns, F.coalesce(bit & F.col(text).isNotNull(), F.lit(False)).alias(flag))


def without_known(candidates: DataFrame, existing: DataFrame, text: str = "text", bitmaps: int = BITMAPS) -> DataFrame:
    """The candidate rows whose text is not among the existing texts; null texts are kept.

    Candidates are written once, by whether they may be known. The existing
    texts are read twice: stage them before if they are dear to compute.
    """
    known = existing.select(F.col(text).alias("_known"))
    split = maybe_known(candidates, text, sketch(known, "_known", bitmaps), bitmaps)
    written = stage(split, "candidates", _MAYBE)
    sure, unsure = (written.filter(F.col(_MAYBE) == flag).select(*candidates.columns) for flag in (False, True))
    near = maybe_known(known, "_known", sketch(unsure, text, bitmaps), bitmaps).filter(_MAYBE).select("_known").distinct()
    # Written down, both sides of the join are plain shuffles, and AQE can split a
    # text that many candidates share.
    near = stage(near, "known-texts").withColumn(_DIGEST, F.xxhash64("_known"))
    # A digest comes first among the keys: rows are ordered by it, and texts are
    # only compared where it is equal.
    marked = unsure.withColumn(_DIGEST, F.xxhash64(text))
    same = (marked[_DIGEST] == near[_DIGEST]) & (marked[text] == near["_known"])
    return sure.union(marked.join(near, same, "left_anti").select(*candidates.columns))
