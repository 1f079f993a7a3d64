"""Fingerprints whose Hamming distance follows the edit distance.

A text is embedded by a random walk over its characters: at step j it writes
the current character, and a bit that all texts share for (j, character) says
whether to advance. Texts that differ by few edits walk in step again soon, so
the written sequences differ in few places. Walks are compared on sampled
steps: a step's level is the number of trailing zeros of its hash, and a text of
level k keeps those of level k and more, about `SAMPLES` of them. Levels nest,
so texts of different lengths have the coarser one's steps in common.

Bands of sampled characters propose pairs of like texts, and the agreement on
all common samples verifies them.

Defined cases: a null text counts as empty; an empty text has no samples, is
like another empty text (1) and unlike any other (0); equal texts have equal
fingerprints; texts are walked whole; repeated ids follow each other in order
of their text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.llm.buffers import bounded_slices, code_points, mix
from textmill.llm.links import link_buckets
from textmill.session import stage

# A text keeps between SAMPLES and twice as many steps of its walk.
SAMPLES = 128
# Two characters of running text write the same digit about so often.
CHANCE = 1 / 8
# Bits of a sample, and 64-bit words of each at a text's own level and the next coarser one,
# that pairs are compared by before they are written: by the first bits, then by all.
PLANES, FIRST, WORDS = "xyzw", "xy", (5, 3)
# Samples of a band.
BAND = 16
# Texts of few samples also have narrow overlapping bands: so many samples, from one to the next.
NARROW, FEW_SAMPLES = (4, 2), 60
# Rounds in which all texts of a slice step together end when so few are left;
# the rest walk on one by one.
FEW = 64
SLICE = 6 << 20
_STEP_SEED = 0x2545F4914F6CDD1D


class _Walk:
    """The shared random choices of all steps up to a length, in growing tables."""

    def __init__(self) -> None:
        self.advance = np.zeros(0, np.uint64)
        self.level = np.zeros(0, np.uint8)

    def upto(self, steps: int) -> None:
        if steps > len(self.advance):
            number = np.arange(1 << int(steps).bit_length(), dtype=np.uint64)
            self.advance = mix(number * np.uint64(_STEP_SEED) + np.uint64(1))
            hashed = mix(number ^ np.uint64(0x5851F42D4C957F2D))
            lowest = hashed & (~hashed + np.uint64(1))
            self.level = np.log2(np.maximum(lowest, 1).astype(np.float64)).astype(np.uint8)


_WALK = _Walk()


def levels(lengths: np.ndarray) -> np.ndarray:
    """The sampling level of texts: a walk of about twice the length keeps SAMPLES steps or more."""
    return np.maximum(np.floor(np.log2(np.maximum(lengths * 2 / SAMPLES, 1))), 0).astype(np.int64)


def walk(codes: np.ndarray, rows: np.ndarray) -> list[bytes]:
    """The sampled characters of every text's walk, as hex digits; rows: where texts start, and the end."""
    lengths = np.diff(rows)
    if not len(lengths):
        return []
    mixed = mix(codes.astype(np.uint64) + np.uint64(0x1234567))
    column = (mixed & np.uint64(63)).astype(np.uint8)  # which bit of a step's word decides
    written = (mixed >> np.uint64(60)).astype(np.uint8)  # the character as one hex digit
    order = np.argsort(-lengths, kind="stable")
    level = levels(lengths)[order]
    at, end = rows[:-1][order].copy(), rows[1:][order]
    _WALK.upto(int(lengths.max()) * 3 + 64)
    advance, step_level = _WALK.advance, _WALK.level
    marks: list[tuple[np.ndarray, np.ndarray]] = []
    alive = int((lengths > 0).sum())
    index = np.arange(alive)
    at, end_at = at[:alive].copy(), end[:alive]
    # Levels fall along the order, so texts that keep a step are a tail of it.
    first_at_most = np.searchsorted(-level[:alive], -np.arange(65), side="left")
    one, step = np.uint64(1), 0
    while len(index) > FEW:
        stop = step + 64
        if stop > len(advance):
            _WALK.upto(2 * stop)
            advance, step_level = _WALK.advance, _WALK.level
        for step in range(step, stop):
            keep = step_level[step]
            if len(index) and keep >= level[index[-1]]:
                cut = np.searchsorted(index, first_at_most[keep])
                inside = at[cut:] < end_at[cut:]
                marks.append((index[cut:][inside], written[at[cut:][inside]]))
            here = np.minimum(at, len(codes) - 1)
            at += ((advance[step] >> column[here]) & one).astype(np.int64)
        step = stop
        still = at < end_at
        index, at, end_at = index[still], at[still], end_at[still]
    out = [bytearray() for _ in range(len(lengths))]
    if marks:
        text = np.concatenate([m[0] for m in marks])
        digit = np.concatenate([m[1] for m in marks])
        by = np.argsort(text, kind="stable")
        digits = np.frombuffer(b"0123456789abcdef", np.uint8)[digit[by]]
        bounds = np.searchsorted(text[by], np.arange(len(lengths) + 1))
        raw = digits.tobytes()
        for i, (a, b) in enumerate(zip(bounds, bounds[1:])):
            out[i] += raw[a:b]
    for i, place, last in zip(index.tolist(), at.tolist(), end_at.tolist()):
        out[i] += _alone(column, written, place, last, step, int(level[i]))
    found: list[bytes] = [b""] * len(lengths)
    for i, own in enumerate(order.tolist()):
        found[own] = bytes(out[i])
    return found


def _alone(column, written, place: int, last: int, step: int, level: int) -> bytes:
    """One text's walk from a step on. The steps at a character end at the first that advances,
    so the walk is made block by block of steps with a table of next advancing steps."""
    out = bytearray()
    columns, digits = column[place:last].tobytes(), written[place:last].tobytes()
    words = _WALK.advance
    keeps = np.flatnonzero(_WALK.level[step:] >= level) + step
    block, here, size = 1 << 14, 0, last - place
    marked = 0
    while here < size:
        part = words[step : step + block].tolist()
        if not part:
            _WALK.upto(2 * len(_WALK.advance))
            words = _WALK.advance
            keeps = np.flatnonzero(_WALK.level >= level)
            marked = int(np.searchsorted(keeps, step))
            continue
        kept = keeps[marked : marked + int(np.searchsorted(keeps[marked:], step + len(part)))].tolist()
        marked += len(kept)
        kept.append(1 << 62)
        wanted, nth = kept[0], 0
        for number, word in enumerate(part, step):
            if here == size:
                break
            if number == wanted:
                out.append(b"0123456789abcdef"[digits[here]])
                nth += 1
                wanted = kept[nth]
            if word >> columns[here] & 1:
                here += 1
        step += len(part)
    return bytes(out)


def fingerprints(codes: np.ndarray, rows: np.ndarray) -> list[str]:
    """`level:digits` of every text."""
    found = walk(codes, rows)
    return [f"{k}:{d.decode()}" for k, d in zip(levels(np.diff(rows)).tolist(), found)]


_STEPS: dict[tuple[int, int, int], np.ndarray] = {}


def _coarser(level: int, to: int, size: int) -> np.ndarray:
    """Which of the first `size` samples of a level belong to a coarser one."""
    key = (level, to, size)
    if key not in _STEPS:
        if len(_STEPS) > 4096:
            _STEPS.clear()
        steps = np.flatnonzero(_WALK.level >= level)
        while len(steps) < size:
            _WALK.upto(2 * len(_WALK.advance) or 1024)
            steps = np.flatnonzero(_WALK.level >= level)
        _STEPS[key] = _WALK.level[steps[:size]] >= to
    return _STEPS[key]


def likeness(one: str, other: str) -> float:
    """Share of equal samples among the common steps, of the longer walk; chance agreement taken out."""
    if one == other:
        return 1.0
    parts = []
    level = max(int(one.split(":")[0]), int(other.split(":")[0]))
    for fingerprint in (one, other):
        own, digits = fingerprint.split(":")
        array = np.frombuffer(digits.encode(), np.uint8)
        parts.append(array[_coarser(int(own), level, len(array))] if int(own) < level else array)
    most, common = max(map(len, parts)), min(map(len, parts))
    if not most:
        return 0.0
    agree = float((parts[0][:common] == parts[1][:common]).sum()) / most
    return max(0.0, (agree - CHANCE) / (1 - CHANCE))


def _with_next(narrow: DataFrame) -> DataFrame:
    """Rows in ranges of descending id, sorted within; `_extra` rows at a range's end are the next one's first.

    Cut points come from the ids' quantiles, so ranges are even and no task sees
    all rows; the texts move once. The last range is followed by the first one.
    """
    spark = narrow.sparkSession
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = narrow.agg(
        F.percentile_approx("_key", [i / parts for i in range(1, parts)], 10_000).alias("cuts")
    ).first()["cuts"]
    cuts = np.unique(np.array(found or [0], np.int64))[::-1].copy()

    @F.pandas_udf("int")
    def part_of(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(-cuts.astype(np.float64), -key.to_numpy(np.float64)))

    dealt = narrow.withColumn("_part", part_of("_key"))
    tops = dealt.groupBy("_part").agg(F.max("_key").alias("top")).orderBy("_part").collect()
    if not tops:
        return dealt.withColumn("_extra", F.lit(False))
    # The first row of each range also goes to the range before it.
    before = {tops[i]["top"]: tops[i - 1]["_part"] for i in range(len(tops))}
    to = F.try_element_at(F.create_map(*[F.lit(x) for pair in before.items() for x in pair]), F.col("_key"))
    own = F.struct(F.col("_part").alias("part"), F.lit(False).alias("extra"))
    copy = F.struct(to.alias("part"), F.lit(True).alias("extra"))
    places = F.when(to.isNull(), F.array(own)).otherwise(F.array(own, copy))
    spread = dealt.withColumn("_place", F.explode(places))
    return (
        spread.select("_id", "_key", "_text", F.col("_place.part").alias("_part"), F.col("_place.extra").alias("_extra"))
        .repartition("_part")
        .sortWithinPartitions("_part", "_extra", F.desc("_key"), "_text")
    )


def _edited(codes: np.ndarray, rows: np.ndarray, followed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The last half of each followed text replaced by as much of the next one's beginning."""
    parts, sizes = [], [0]
    for i in followed.tolist():
        start, end, stop = rows[i], rows[i + 1], rows[i + 2]
        half = (end - start) // 2
        parts += [codes[start : end - half], codes[end : min(stop, end + half)]]
        sizes.append(len(parts[-1]) + len(parts[-2]))
    return np.concatenate(parts) if parts else codes[:0], np.cumsum(sizes)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fingerprints of sorted rows and of their edited texts."""
    names = ["_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    carried = None
    for batch in bounded_slices(batches, "_text", SLICE):
        if carried is not None:
            batch = pa.concat_batches([carried, batch])
        carried = batch.slice(batch.num_rows - 1)
        part = batch.column("_part").to_numpy()
        extra = batch.column("_extra").to_numpy(zero_copy_only=False)
        codes, rows = code_points(batch.column("_text"))
        followed = np.flatnonzero(~extra[:-1] & (part[:-1] == part[1:]))
        edited, edited_rows = _edited(codes, rows, followed)
        both = fingerprints(np.concatenate([codes, edited]), np.concatenate([rows, edited_rows[1:] + rows[-1]]))
        own, after = both[: batch.num_rows], both[batch.num_rows :]
        raw = edited.astype("<u4").tobytes()
        digests = [
            hashlib.sha256(raw[4 * a : 4 * b].decode("utf-32-le").encode()).hexdigest()
            for a, b in zip(edited_rows.tolist(), edited_rows[1:].tolist())
        ]
        at = followed.tolist()
        yield pa.RecordBatch.from_arrays(
            [batch.column("_id").take(pa.array(followed)), pa.array(np.diff(rows)[followed]),
             pa.array(digests, pa.string()), pa.array([own[i] for i in at], pa.string()),
             pa.array(after, pa.string()),
             pa.array([likeness(own[i], x) for i, x in zip(at, after)], pa.float64()),
             pa.array([likeness(own[i], own[i + 1]) for i in at], pa.float64())],
            names,
        )


def fingerprint_edits(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Each text's fingerprint, that of its edited text, and their likeness to it and to the next text's.

    The edited text has its last half replaced by as much of the beginning of
    the text with the next lower id; the lowest id is followed by the highest.
    Null ids come after all others.
    """
    key = F.coalesce(F.col("_id").cast("bigint"), F.lit(-(1 << 63)).cast("bigint"))
    narrow = df.select(F.col(id_col).alias("_id"), F.col(text).alias("_text")).withColumn("_key", key)
    kind = narrow.schema["_id"].dataType.simpleString()
    return _with_next(narrow).mapInArrow(
        _compare,
        f"_id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    ).withColumnRenamed("_id", id_col)


def _bands(digits: bytes) -> list[tuple[str, bytes]]:
    """Where runs of the samples of a level begin, and the runs."""
    kinds = [(BAND, BAND), NARROW] if len(digits) < FEW_SAMPLES else [(BAND, BAND)]
    return [
        (f"{width}:{at}", digits[at : at + width])
        for width, stride in kinds for at in range(0, max(len(digits) - width, 0) + 1, stride)
    ]


def _own_and_coarser(fingerprint: str) -> tuple[int, tuple[np.ndarray, np.ndarray]]:
    """A text's level, its samples there, and those of them that the next coarser level keeps."""
    level, digits = fingerprint.split(":")
    samples = np.frombuffer(digits.encode(), np.uint8)
    return int(level), (samples, samples[_coarser(int(level), int(level) + 1, len(samples))])


def _band_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys of runs of sampled characters, at a text's own level and at the next coarser one."""
    for batch in batches:
        nodes, keys = [], []
        for node, fingerprint in zip(batch.column("node").to_pylist(), batch.column("fingerprint").to_pylist()):
            level, both = _own_and_coarser(fingerprint)
            for at, samples in enumerate(both, level):
                for place, run in _bands(samples.tobytes()):
                    part = f"{at}:{place}:".encode() + run
                    nodes.append(node)
                    keys.append(int.from_bytes(hashlib.blake2b(part, digest_size=8).digest(), "little", signed=True))
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(nodes, pa.int64())], ["bucket", "node"])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sizes, and the four bits of each sample as bits of 64-bit words, at both levels of a text."""
    for batch in batches:
        prints = batch.column("fingerprint").to_pylist()
        levels_, sizes = np.zeros(len(prints), np.int32), np.zeros((2, len(prints)), np.int32)
        bits = [np.zeros((len(PLANES), len(prints), 64 * words), np.uint8) for words in WORDS]
        for row, fingerprint in enumerate(prints):
            levels_[row], both = _own_and_coarser(fingerprint)
            for which, samples in enumerate(both):
                sizes[which, row] = len(samples)
                first = samples[: 64 * WORDS[which]]
                digit = np.where(first < ord("a"), first - ord("0"), first - ord("a") + 10)
                for plane in range(len(PLANES)):
                    bits[which][plane, row, : len(first)] = digit >> plane & 1
        packed = [np.packbits(b, axis=2, bitorder="little").view("<i8") for b in bits]
        words = [pa.array(p[plane, :, w].copy()) for p in packed for plane in range(len(PLANES)) for w in range(p.shape[2])]
        yield pa.RecordBatch.from_arrays(
            [batch.column("node"), pa.array(levels_), pa.array(sizes[0]), pa.array(sizes[1]), *words],
            ["node", "level", "size0", "size1", *_words()],
        )


def _words() -> list[str]:
    return [f"{plane}{which}{w}" for which in range(2) for plane in PLANES for w in range(WORDS[which])]


def _may_be_like(least: float) -> Column:
    """What any two texts of a likeness of `least` meet, at the coarser of their levels.

    Samples whose bits differ are different ones, and a walk's samples beyond the
    other's end agree with nothing, so both counts are bounded by the share of
    samples that may disagree. Samples beyond the words are not looked at. Two bits
    leave out most pairs; all four, a pair that is only nearly like. These are looked at
    by an array function, which keeps them out of the join's compiled code, too long for
    the JVM to compile otherwise.
    """

    def differing(planes: str, a: int, b: int) -> list[Column]:
        out = []
        for word in range(min(WORDS[a], WORDS[b])):
            either = F.lit(0).cast("bigint")
            for plane in planes:
                either = either.bitwiseOR(F.col(f"{plane}{a}{word}_a").bitwiseXOR(F.col(f"{plane}{b}{word}_b")))
            out.append(F.bit_count(either))
        return out

    def meets(a: int, b: int) -> Column:
        some = reduce(Column.__add__, differing(FIRST, a, b))
        every = F.aggregate(F.array(*differing(PLANES, a, b)), F.lit(0), lambda total, n: total + n)
        sizes = F.col(f"size{a}_a"), F.col(f"size{b}_b")
        most = F.floor(F.greatest(*sizes) * ((1 - least) * (1 - CHANCE)) + 1e-6)
        return (F.abs(sizes[0] - sizes[1]) <= most) & (some <= most) & (every <= most)

    above = F.col("level_b") - F.col("level_a")
    return F.when(above == 0, meets(0, 0)).when(above == 1, meets(1, 0)).when(above == -1, meets(0, 1)).otherwise(False)


def with_groups(prints: DataFrame, id_col: str = "doc_id", least: float = 0.8) -> DataFrame:
    """The rows with group_id, the smallest id connected by fingerprints of a likeness of `least` or more.

    Equal fingerprints are one class. Bands of BAND samples propose pairs of
    classes; the bits of their samples, compared inside the join, leave out what
    isn't like, and all common samples verify the rest. Samples that differ come in runs,
    until the walks are in step again, so that like texts have whole bands in
    common far more often than if samples agreed independently.
    """
    prints = stage(prints, "fingerprints")
    rows = prints.select(F.col(id_col).cast("bigint").alias("_id"), "fingerprint")
    classes = stage(
        rows.filter("_id is not null").groupBy("fingerprint").agg(F.min("_id").alias("node")), "fingerprint-classes"
    )
    bands = stage(classes.mapInArrow(_band_keys, "bucket bigint, node bigint"), "fingerprint-bands")
    shared = bands.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    buckets = stage(bands.join(shared, "bucket").select("bucket", "node"), "fingerprint-buckets")
    met = classes.join(buckets.select("node").distinct(), "node", "left_semi")
    columns = ", ".join(f"{c} bigint" for c in _words())
    marks = stage(
        met.mapInArrow(_packed, f"node bigint, level int, size0 int, size1 int, {columns}"), "fingerprint-marks"
    )

    @F.pandas_udf("double")
    def like(one: pd.Series, other: pd.Series) -> pd.Series:
        return pd.Series([likeness(a, b) for a, b in zip(one, other)], dtype=float)

    def confirm(pairs: DataFrame) -> DataFrame:
        for side in "ab":
            pairs = pairs.join(classes.select(F.col("node").alias(side), F.col("fingerprint").alias(f"print_{side}")), side)
        return pairs.filter(like("print_a", "print_b") >= least).select("a", "b")

    labels, _ = link_buckets(buckets, marks, _may_be_like(least), confirm)
    member = classes.join(labels, "node", "left").select("fingerprint", F.coalesce("root", "node").alias("group_id"))
    found = prints.join(member, "fingerprint", "left")
    return found.select(*prints.columns, F.when(F.col(id_col).isNotNull(), F.col("group_id")).alias("group_id"))


def like_groups(prints: DataFrame, id_col: str = "doc_id", least: float = 0.8) -> DataFrame:
    """The id with its group_id."""
    return with_groups(prints, id_col, least).select(F.col(id_col).cast("bigint").alias(id_col), "group_id")
