"""Benchmark passages in documents, through a distributed positional index.

The index holds postings (term, document, position) of the terms that decide:
of every window of a benchmark item the rarest term in the corpus, the window's
anchor. A posting carries the terms around it, so that the other terms' lists,
offset to the same start, are intersected where the anchor's list meets the
item's: a window occurs exactly where all its terms stand at their offsets.
Rarest terms come first, so frequent ones have no postings to move.

Each task needs to know which terms matter. It gets a bitmap of a fixed 2^22
slots of their hashes: more terms only let more needless postings through,
which the join drops. Terms are compared by a 64-bit hash.

Defined cases: null texts have no words; items without words match nowhere; an
item of fewer words than a window is one window; repeated items count once by
id and null item ids match but are not listed; rows that repeat are judged
each; empty tables give no hit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.buffers import (
    ALPHANUMERIC,
    bounded_slices,
    list_array,
    lower_bytes,
    signed,
    text_buffer,
    word_hashes,
    word_spans,
)
from textmill.session import stage

WINDOW = 13
# Two anchors of an item this many words apart, or fewer, are a proximity match.
NEAR = 26
SLOT_BITS = 22


def _terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts, and the first of each."""
    data, rows = text_buffer(column)
    low = lower_bytes(data)
    starts, ends, firsts = word_spans(low, rows, ALPHANUMERIC)
    return word_hashes(low, starts, ends), firsts


def _slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _bitmap(terms: DataFrame) -> np.ndarray:
    """Which slots the terms fall into: at most 2^22 numbers reach the driver."""
    slot = F.shiftrightunsigned(F.col("term"), 64 - SLOT_BITS)
    bits = np.zeros(1 << SLOT_BITS, bool)
    bits[terms.select(slot.alias("slot")).distinct().toArrow().column(0).to_numpy()] = True
    return bits


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in bounded_slices(batches, "_text"):
        hashes, firsts = _terms(batch.column("_text"))
        yield pa.RecordBatch.from_arrays(
            [batch.column("_item"), list_array(signed(hashes), firsts)], ["_item", "terms"]
        )


def _count_terms(bits: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded_slices(batches, "_text"):
            hashes, _ = _terms(batch.column("_text"))
            hashes = hashes[bits[_slots(hashes)]]
            terms, counts = np.unique(hashes, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(signed(terms)), pa.array(counts)], ["term", "n"])

    return run


def _context(terms: np.ndarray, at: np.ndarray, first: np.ndarray, last: np.ndarray, width: int, fill: int) -> np.ndarray:
    """The terms `width - 1` places around each position, `fill` beyond its text."""
    around = at[:, None] + np.arange(1 - width, width)
    inside = (around >= first[:, None]) & (around < last[:, None])
    return np.where(inside, terms[np.clip(around, 0, max(len(terms) - 1, 0))], np.uint64(fill))


def _anchors(width: int):
    """Of every window its rarest term, once for each place in the item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                found = batch.column("found")[row].as_py()
                found.sort(key=lambda x: x["at"])
                counts = np.array([x["n"] or 0 for x in found])
                terms = np.array([x["term"] for x in found], np.int64).view(np.uint64)
                span = min(width, len(terms))
                windows = np.lib.stride_tricks.sliding_window_view(counts, span)
                rare = np.lib.stride_tricks.sliding_window_view(terms, span)
                order = np.lexsort((rare, windows), axis=1)[:, 0]
                possible = windows.min(1) > 0  # else a term of the window is in no document
                at = np.unique((np.arange(len(windows)) + order)[possible])
                size = np.full(len(at), len(terms))
                around = _context(terms, at, 0 * at, size, width, 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(terms[at])), batch.column("_item").take(pa.array(np.full(len(at), row))),
                     pa.array(at.astype(np.int32)), pa.array(size.astype(np.int32)),
                     list_array(signed(around.reshape(-1)), np.arange(len(at) + 1) * around.shape[1])],
                    ["term", "_item", "offset", "size", "around"],
                )

    return run


def anchors(items: DataFrame, docs: DataFrame, item_id: str, text: str, width: int) -> DataFrame:
    """`term, _item, offset, size, around`: the terms that find every window of the items."""
    terms = items.select(F.col(item_id).cast("string").alias("_item"), F.col(text).alias("_text")).mapInArrow(
        _item_terms, "_item string, terms array<bigint>"
    )
    placed = stage(
        terms.distinct()
        .withColumn("_key", F.monotonically_increasing_id())
        .select("_key", "_item", F.posexplode("terms").alias("at", "term")),
        "index-items",
    )
    bits = _bitmap(placed)
    counts = docs.mapInArrow(_count_terms(bits), "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    found = placed.join(counts, "term", "left").groupBy("_key", "_item").agg(
        F.collect_list(F.struct("at", "term", "n")).alias("found")
    )
    kinds = "term bigint, _item string, offset int, size int, around array<bigint>"
    return stage(found.select("_item", "found").mapInArrow(_anchors(width), kinds), "index-anchors")


def _postings(bits: np.ndarray, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded_slices(batches, "_text"):
            hashes, firsts = _terms(batch.column("_text"))
            at = np.flatnonzero(bits[_slots(hashes)])
            text = np.searchsorted(firsts, at, side="right") - 1
            around = _context(hashes, at, firsts[text], firsts[text + 1], width, 0)
            bounds = np.searchsorted(at, firsts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row"), batch.column("_id"), pa.array(np.diff(firsts)),
                 list_array(signed(hashes[at]), bounds),
                 list_array((at - firsts[text]).astype(np.int32), bounds),
                 list_array(signed(around.reshape(-1)), bounds * around.shape[1])],
                ["_row", "_id", "n_words", "terms", "positions", "around"],
            )

    return run


def build_index(docs: DataFrame, terms: DataFrame, width: int = WINDOW) -> DataFrame:
    """One row a document: its number of words and the postings of the terms, in order of position.

    `docs` has the columns _row, _id and _text.
    """
    kind = docs.schema["_id"].dataType.simpleString()
    return stage(
        docs.mapInArrow(
            _postings(_bitmap(terms), width),
            f"_row bigint, _id {kind}, n_words bigint, terms array<bigint>, positions array<int>, around array<bigint>",
        ),
        "index-postings",
    )


def postings(index: DataFrame, width: int = WINDOW) -> DataFrame:
    """`term, _row, position, around` of every posting."""
    span = 2 * width - 1
    return index.select(
        "_row", "positions", "around", F.posexplode("terms").alias("_n", "term")
    ).select(
        "term", "_row",
        F.element_at("positions", F.col("_n") + 1).alias("position"),
        F.slice("around", F.col("_n") * span + 1, span).alias("around"),
    )


def _runs(width: int):
    """How far the terms around a posting and around an anchor agree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = 2 * width - 1
        for batch in batches:
            if not batch.num_rows:
                continue
            mine, theirs = (
                np.asarray(batch.column(c).flatten()).reshape(-1, span) for c in ("around", "item_around")
            )
            same = mine == theirs
            left = np.cumprod(same[:, width - 2 :: -1], axis=1).sum(1) if width > 1 else 0
            right = np.cumprod(same[:, width:], axis=1).sum(1) if width > 1 else 0
            position, offset, size = (batch.column(c).to_numpy() for c in ("position", "offset", "size"))
            whole = (size < width) & (left >= offset) & (right >= size - 1 - offset)
            exact = np.where(size < width, whole, left + right + 1 >= width)
            first, last = position - left, position + right
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row"), batch.column("_item"), batch.column("position"), batch.column("offset"),
                 pa.array(exact), pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32))],
                ["_row", "_item", "position", "offset", "exact", "first", "last"],
            )

    return run


def phrase_matches(index: DataFrame, wanted: DataFrame, width: int = WINDOW) -> DataFrame:
    """Every meeting of a posting and an anchor, whether a window of the item occurs there (`exact`),
    and the first and last document word of the agreeing run."""
    pairs = postings(index, width).join(wanted.withColumnRenamed("around", "item_around"), "term")
    return pairs.mapInArrow(
        _runs(width), "_row bigint, _item string, position int, offset int, exact boolean, first int, last int"
    )


def contaminated(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", width: int = WINDOW, parts: int = 20,
) -> DataFrame:
    """The id with n_words, n_hit, n_items, items, near_items and contaminated.

    A document is contaminated if one in `parts` of its words, or more, lies in
    a window of an item. near_items counts items of which two anchors stand
    within NEAR words, whether or not a whole window occurs.
    """
    narrow = docs.select(
        F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("_id"), F.col(text).alias("_text")
    )
    wanted = anchors(items, narrow.select("_text"), item_id, item_text, width)
    index = build_index(narrow, wanted.select("term"), width)
    meetings = phrase_matches(index, wanted, width)
    # Neighbours by position; two anchors of one item close together are a proximity match.
    ranges = F.collect_set(F.when(F.col("exact"), F.struct("first", "last")))
    places = F.array_sort(F.collect_set(F.struct("position", "offset")))
    near = F.exists(
        F.zip_with(
            F.slice("places", 1, F.greatest(F.size("places") - 1, F.lit(0))),
            F.slice("places", 2, F.size("places")),
            lambda a, b: (a["offset"] != b["offset"]) & (b["position"] - a["position"] <= NEAR),
        ),
        lambda x: x,
    )
    by_item = meetings.groupBy("_row", "_item").agg(ranges.alias("ranges"), places.alias("places"))
    by_doc = by_item.select("_row", "_item", "ranges", near.alias("near")).groupBy("_row").agg(
        F.array_sort(F.collect_set(F.when(F.size("ranges") > 0, F.col("_item")))).alias("items"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("ranges")))).alias("ranges"),
        F.count_if("near").alias("near_items"),
    )
    covered = F.aggregate(
        "ranges",
        F.struct(F.lit(0).alias("n"), F.lit(-1).alias("to")),
        lambda done, r: F.struct(
            (done["n"] + F.greatest(r["last"] - F.greatest(r["first"] - 1, done["to"]), F.lit(0))).alias("n"),
            F.greatest(done["to"], r["last"]).alias("to"),
        ),
        lambda done: done["n"],
    )
    hits = by_doc.select("_row", "items", "near_items", covered.cast("bigint").alias("hit"))
    n_hit = F.coalesce("hit", F.lit(0).cast("bigint"))
    return index.select("_row", "_id", "n_words").join(hits, "_row", "left").select(
        F.col("_id").alias(id_col),
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("bigint").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("near_items", F.lit(0).cast("bigint")).alias("near_items"),
        ((n_hit > 0) & (parts * n_hit >= F.col("n_words"))).alias("contaminated"),
    )
