"""Near-duplicate documents: banded MinHash, odd sketches, exact confirmation.

Texts with the same set of shingles form a class, told by 128 bits, and one
document stands for it. Bands of the representatives' MinHash samples propose
pairs. A pair's odd sketches are bitmaps of parities into which samples are
folded; the bits in which they differ estimate the similarity. One holds the
MinHash samples and drops pairs far below the threshold. One holds every
shingle: two sets differ in at least as many shingles as bits, so it drops most
pairs just below the threshold and never a link; of texts of thousands of words
its bits are too few to tell, and the first one decides. What is left is
confirmed on the full sets.

A bucket never emits all its pairs. In some rounds each bucket is compared with
one leader, another one each time, and what links joins a group at once. After
that only members of different groups still meet: pairs inside a group would
tell nothing new. So no link between groups is lost, and a large group of
copies costs as many pairs as it has members.

Defined cases: null texts and texts without words have no shingles and link
with nothing, as do rows with a null id (their component_id is null); a text of
fewer words than a shingle is one shingle; rows that repeat an id share its
result, and if their words differ any of them stands for it; an empty table
gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.buffers import (
    SPACE_SEPARATED,
    bounded_slices,
    list_array,
    lower_bytes,
    mix,
    signed,
    text_buffer,
    window_hashes,
    word_hashes,
    word_spans,
)
from textmill.llm.links import link_buckets
from textmill.session import stage

WORDS = 5
# The contract's threshold, as a fraction.
SIMILARITY = (85, 100)
# A pair of similarity 0.85 shares no band with probability (1 - 0.85^4)^20 = 4e-7.
BANDS, ROWS = 20, 4
SKETCH_BITS = 256
# Bits by which the sketches of pairs at the threshold differ: 2 x 80 x 0.15 = 24 samples
# differ on average, deviation below 7; 60 samples, or 48 bits, are five deviations off.
MOST_DIFFERENT_BITS = 48
SET_BITS = 512

_SAMPLES = BANDS * ROWS
_SKETCH = [*(f"s{i}" for i in range(SKETCH_BITS // 64)), *(f"f{i}" for i in range(SET_BITS // 64))]
_RANDOM = np.random.default_rng(85)
_FACTORS = _RANDOM.integers(1, 2**63, _SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADDENDS = _RANDOM.integers(0, 2**63, _SAMPLES, dtype=np.uint64)


def shingle_sets(column: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, and where each text's begin."""
    data, rows = text_buffer(column)
    low = lower_bytes(data)
    starts, ends, firsts = word_spans(low, rows, SPACE_SEPARATED)
    shingles, _, first = window_hashes(word_hashes(low, starts, ends), firsts, words)
    sets = [np.unique(shingles[a:b]) for a, b in zip(first, first[1:])]
    bounds = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)
    return (np.concatenate(sets) if sets else shingles[:0]), bounds


def samples(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """MinHash samples [non-empty set, sample]."""
    full = bounds[:-1][np.diff(bounds) > 0]
    out = np.empty((len(full), _SAMPLES), np.uint64)
    for i in range(_SAMPLES if len(full) else 0):
        out[:, i] = np.minimum.reduceat(values * _FACTORS[i] + _ADDENDS[i], full)
    return out


def odd_sketches(found: np.ndarray) -> np.ndarray:
    """Parities of where the samples fall [set, four 64-bit words]."""
    places = mix(found ^ (np.arange(_SAMPLES, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    places = (places % np.uint64(SKETCH_BITS)).astype(np.int64)
    bits = np.zeros((len(found), SKETCH_BITS), np.uint8)
    np.add.at(bits, (np.arange(len(found))[:, None], places), 1)
    return np.packbits(bits & 1, axis=1).view(np.uint64)


def set_sketches(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Parities of where all shingles fall [set, eight 64-bit words]."""
    sizes = np.diff(bounds)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    places = owner * SET_BITS + (mix(values) % np.uint64(SET_BITS)).astype(np.int64)
    bits = np.bincount(places, minlength=len(sizes) * SET_BITS).astype(np.uint8) & 1
    return np.packbits(bits.reshape(-1, SET_BITS), axis=1).view(np.uint64)


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["_id", "n_shingles", "d1", "d2", "bands", *_SKETCH]
    for batch in bounded_slices(batches, "_text"):
        values, bounds = shingle_sets(batch.column("_text"))
        sizes = np.diff(bounds)
        full = sizes > 0
        found = samples(values, bounds)
        bands = found.reshape(-1, BANDS, ROWS)
        keys = np.zeros(bands.shape[:2], np.uint64)
        for row in range(ROWS):
            keys = mix(keys ^ bands[:, :, row]) + np.uint64(row)
        keys = mix(keys ^ np.arange(1, BANDS + 1, dtype=np.uint64))
        sketch = odd_sketches(found)
        digests = np.zeros((2, len(sizes)), np.uint64)
        words = np.zeros((4, len(sizes)), np.uint64)
        if full.any():
            starts = bounds[:-1][full]
            for i, seed in enumerate((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)):
                digests[i, full] = np.add.reduceat(mix(values ^ np.uint64(seed)), starts)
            words[:, full] = sketch.T
        lists = np.concatenate([[0], np.cumsum(np.where(full, BANDS, 0))])
        yield pa.RecordBatch.from_arrays(
            [batch.column("_id"), pa.array(sizes), *[pa.array(signed(d)) for d in digests],
             list_array(signed(keys.reshape(-1)), lists), *[pa.array(signed(w)) for w in words],
             *[pa.array(signed(np.ascontiguousarray(w))) for w in set_sketches(values, bounds).T]],
            names,
        )


def _confirm(similarity: tuple[int, int]):
    part, whole = similarity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded_slices(bounded_slices(batches, "_text"), "text_b"):
            sets = [shingle_sets(batch.column(c)) for c in ("_text", "text_b")]
            linked = []
            for i in range(batch.num_rows):
                one, two = (values[bounds[i] : bounds[i + 1]] for values, bounds in sets)
                common = len(np.intersect1d(one, two, assume_unique=True))
                linked.append(whole * common >= part * (len(one) + len(two) - common))
            kept = batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))
            yield kept

    return run


def _alike(similarity: tuple[int, int]) -> F.Column:
    """Whether two sketches may belong to similar sets.

    Sets of sizes n and m that differ in d elements have p/w of their union in
    common if d (w + p) <= (w - p) (n + m).
    """
    part, whole = similarity
    bits = {c: F.bit_count(F.col(f"{c}_a").bitwiseXOR(F.col(f"{c}_b"))) for c in _SKETCH}
    folded, full = (sum(n for c, n in bits.items() if c[0] == kind) for kind in "sf")
    most = (whole - part) * (F.col("n_shingles_a") + F.col("n_shingles_b"))
    return (full * (whole + part) <= most) & (folded <= MOST_DIFFERENT_BITS)


def _confirmed(pairs: DataFrame, texts: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    pairs = pairs.join(texts.select(F.col("_id").alias("b"), F.col("_text").alias("text_b")), "b")
    both = pairs.join(texts.select(F.col("_id").alias("a"), "_text"), "a")
    return both.select("a", "b", "_text", "text_b").mapInArrow(_confirm(similarity), "a bigint, b bigint")


def groups(
    df: DataFrame, id_col: str = "doc_id", text: str = "text", similarity: tuple[int, int] = SIMILARITY
) -> DataFrame:
    """The id with n_shingles, component_id (the smallest id reachable by links) and kept."""
    narrow = df.select(F.col(id_col).cast("bigint").alias("_id"), F.col(text).alias("_text"))
    signed_docs = stage(
        narrow.mapInArrow(
            _signatures,
            "_id bigint, n_shingles bigint, d1 bigint, d2 bigint, bands array<bigint>, "
            + ", ".join(f"{c} bigint" for c in _SKETCH),
        ),
        "signatures",
    )
    linkable = signed_docs.filter("n_shingles > 0 and _id is not null")
    classes = stage(linkable.groupBy("d1", "d2").agg(F.min("_id").alias("rep")), "classes")
    members = linkable.select("_id", "d1", "d2").join(classes, ["d1", "d2"]).select("_id", "rep")
    # One document of each class goes on; a repeated id may bring it more than once.
    heads = signed_docs.join(
        classes.select(F.col("rep").alias("_id"), "d1", "d2"), ["_id", "d1", "d2"], "left_semi"
    ).dropDuplicates(["_id"])
    placed = stage(heads.select(F.explode("bands").alias("bucket"), F.col("_id").alias("node")), "placed")
    shared = placed.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    buckets = stage(placed.join(shared, "bucket").select("bucket", "node"), "buckets")
    wanted = buckets.select(F.col("node").alias("_id")).distinct()
    texts = narrow.join(wanted, "_id").dropDuplicates(["_id"])
    texts = stage(texts, "texts")

    sketches = stage(heads.join(wanted, "_id").select(F.col("_id").alias("node"), "n_shingles", *_SKETCH), "sketches")
    labels, _ = link_buckets(buckets, sketches, _alike(similarity), lambda pairs: _confirmed(pairs, texts, similarity))
    roots = labels.select(F.col("node").alias("rep"), "root")
    component = members.join(roots, "rep", "left").select("_id", F.coalesce("root", "rep").alias("root"))
    found = signed_docs.select("_id", "n_shingles").join(component.distinct(), "_id", "left")
    # Texts of one id that repeats with different words: the smallest component counts.
    root = F.coalesce("root", "_id")
    return found.select(
        F.col("_id").alias(id_col), "n_shingles", root.alias("component_id"),
        F.coalesce(F.col("_id") == root, F.lit(True)).alias("kept"),
    )
