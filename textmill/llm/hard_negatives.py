"""Hard negatives by exact integer scores in a residue number system.

Vectors become integers (`floor(SCALE * x)`), and their inner products are
computed exactly with float32 matrix products: one product for each of several
small primes, of components reduced modulo the prime and centred, in blocks so
narrow that no sum leaves the integers that float32 holds. The residues of a
score give its digits in the mixed radix of the primes, with centred digits, so
the sum of the digits is the signed score itself. How many primes are needed
follows from the greatest norms (Cauchy-Schwarz).

All rows are dealt into cells of bounded bytes; every cell meets every anchor
once. A cell's task holds the cell's components and streams the anchors past
them. First each cell gives an anchor's best rows of its own label, and a window
over what the cells gave picks the positives; then each cell gives, for every
positive, the best rows of other labels in the positive's score range, and a
second window picks the negatives. What a cell gives is bounded by anchors, not by rows.

Defined cases: rows with a null label, a null vector, or a null or non-finite
component take no part; vectors of unequal length count as padded with zeros;
an empty vector scores 0; a null id is no anchor and comes last among ties; rows
that repeat, also those of one id, are rows of their own (ties beyond the id
follow the order in the input); an anchor without a positive or a positive
without a row in its range gives no row; an empty table gives an empty table;
extra columns pass by unread. Scores that a bigint might not hold, or components
beyond 32 bits, are an error.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmill.llm.buffers import string_array
from textmill.session import stage

SCALE = 256
# Components in one float32 product: WIDTH * 125 ** 2 < 2 ** 22, which leaves
# room to round sums to multiples of the prime without an error.
WIDTH = 256
PRIMES = [p for p in range(251, 2, -1) if all(p % d for d in range(2, 16))]
FEWEST_PRIMES = 3

# Bytes of components that a cell's task holds, anchors and rows scored at once.
CELL_BYTES = 64 << 20
ANCHORS_AT_ONCE = 128
ROWS_AT_ONCE = 8192
# Cells for a number of rows: their root over this, so that the anchors' copies grow slowly.
CELL_ROOT = 32

_NONE = np.iinfo(np.int64).min


# --- exact scores ---------------------------------------------------------------------


def primes_for(bound: float) -> list[int]:
    """As many primes as hold all integers up to the bound, of either sign."""
    if bound >= 2**61:
        raise ValueError(f"scores up to {bound:.3g} don't fit 64 bits")
    count, product = 0, 1
    while product <= 2 * bound or count < FEWEST_PRIMES:
        product *= PRIMES[count]
        count += 1
    return PRIMES[:count]


def residues(values: np.ndarray, primes: list[int]) -> list[np.ndarray]:
    """The integers modulo each prime, centred on zero, one byte each."""
    out = []
    for p in primes:
        left = np.mod(values, p)
        out.append(np.where(left > p // 2, left - p, left).astype(np.int8))
    return out


def _centred(x: np.ndarray, p: int) -> np.ndarray:
    """Float32 integers below 2**22 modulo a prime, centred."""
    return x - np.float32(p) * np.rint(x / np.float32(p))


def scores(one: list[np.ndarray], other: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Inner products of all rows of both sides, given by their residues, as exact int64."""
    shape = (len(one[0]), len(other[0]))
    digits: list[np.ndarray] = []
    total = np.zeros(shape, np.int64)
    radix = 1
    for p, a, b in zip(primes, one, other):
        found = np.zeros(shape, np.float32)
        for start in range(0, a.shape[1], WIDTH):
            part = slice(start, start + WIDTH)
            found = _centred(found + a[:, part].astype(np.float32) @ b[:, part].astype(np.float32).T, p)
        # The digit: what is left after the digits so far, over their radix.
        step = 1
        for digit, q in zip(digits, primes):
            found = _centred(found - _centred(digit * np.float32(step), p), p)
            step = step * q % p
        found = _centred(found * np.float32(pow(step, -1, p)), p)
        digits.append(found)
        total += found.astype(np.int64) * radix
        radix *= p
    return total


# --- rows as integers -----------------------------------------------------------------

PACKED = "row bigint, id bigint, label bigint, vector binary, norm double, size int, fits boolean"


def _pack(scale: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index("vector"))
            items = lists.flatten()
            lengths = np.array(lists.value_lengths().fill_null(0), np.int64)
            ends = np.cumsum(lengths)
            starts = ends - lengths
            x = np.array(items.cast(pa.float64()).fill_null(np.nan))
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(x))])
            with np.errstate(invalid="ignore", over="ignore"):
                whole = np.floor(scale * np.where(np.isfinite(x), x, 0))
            large = np.concatenate([[0], np.cumsum(np.abs(whole) > 2**31 - 1)])
            fits = large[ends] == large[starts]
            squares = np.append(np.where(np.abs(whole) > 2**31 - 1, 0, whole) ** 2, 0)
            norms = np.add.reduceat(squares, np.minimum(starts, len(whole))) * (lengths > 0) if len(starts) else squares[:0]
            kept = np.flatnonzero((bad[ends] == bad[starts]) & np.array(lists.is_valid()))
            flat = np.clip(whole, -(2**31) + 1, 2**31 - 1).astype("<i4")
            vectors = string_array(flat.view(np.uint8), np.concatenate([[0], ends]) * 4).cast(pa.binary())
            take = pa.array(kept)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(batch.schema.get_field_index(n)).take(take) for n in ("row", "id", "label")),
                    vectors.take(take), pa.array(norms).take(take),
                    pa.array(lengths.astype(np.int32)).take(take), pa.array(fits).take(take),
                ],
                ["row", "id", "label", "vector", "norm", "size", "fits"],
            )

    return pack


def integer_rows(df: DataFrame, id_col: str, label: str, vector: str, scale: int = SCALE) -> DataFrame:
    """The rows that take part, as packed 32-bit integers, with their order in the input."""
    rows = df.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("bigint").alias("id"),
        F.col(label).cast("bigint").alias("label"), F.col(vector).cast("array<double>").alias("vector"),
    ).filter("label is not null and vector is not null")
    return rows.mapInArrow(_pack(scale), PACKED)


# --- cells ----------------------------------------------------------------------------


@dataclass(frozen=True)
class Grid:
    """What every task needs to know: vector size, primes, number of cells."""

    size: int
    primes: tuple[int, ...]
    cells: int


def grid(rows: DataFrame, anchor: Column, cell_bytes: int = CELL_BYTES, root: int = CELL_ROOT) -> Grid:
    found = rows.agg(
        F.count("*").alias("rows"), F.max("size").alias("size"), F.coalesce(F.max("norm"), F.lit(0.0)).alias("norm"),
        F.coalesce(F.max(F.when(anchor, F.col("norm"))), F.lit(0.0)).alias("anchor"),
        F.coalesce(F.bool_and("fits"), F.lit(True)).alias("fits"),
    ).first()
    if not found["fits"]:
        raise ValueError("a vector's component doesn't fit 32 bits")
    bound = math.sqrt(found["norm"]) * math.sqrt(found["anchor"]) * (1 + 1e-6) + 1
    size = max(1, found["size"] or 1)
    cells = max(math.ceil(math.sqrt(found["rows"]) / root), math.ceil(found["rows"] * size * 4 / cell_bytes), 1)
    return Grid(size, tuple(primes_for(bound)), cells)


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    """Packed vectors as one array, padded with zeros."""
    flat = column.cast(pa.large_binary())
    lengths = np.array(pa.compute.binary_length(flat), np.int64) // 4
    out = np.zeros((len(flat), size), np.int32)
    _, offsets, data = flat.buffers()
    first = np.frombuffer(offsets, np.int64)[flat.offset] // 4
    values = np.frombuffer(data, "<i4")[first : first + lengths.sum()] if data is not None else np.zeros(0, "<i4")
    out[np.arange(size) < lengths[:, None]] = values
    return out


class _Cell:
    """A cell's rows, in the order that ties ask for."""

    def __init__(self, batches: list[pa.RecordBatch], known: Grid):
        table = pa.Table.from_batches(batches).select(["row", "id", "label"]).combine_chunks()
        self.row = np.array(table["row"], np.int64)
        self.label = np.array(table["label"], np.int64)
        self.id = pa.concat_arrays(table["id"].chunks)
        whole = [_matrix(b.column(b.schema.get_field_index("vector")), known.size) for b in batches]
        self.residues = residues(np.concatenate(whole), list(known.primes))
        by_label = np.argsort(self.label, kind="stable")
        labels, firsts = np.unique(self.label[by_label], return_index=True)
        self.of_label = dict(zip(labels.tolist(), np.split(by_label, firsts[1:])))


def _best(found: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The greatest scores of each line and their columns; the first of equals comes first. Spoils `found`."""
    lines = np.arange(len(found))
    columns = np.zeros((len(found), count), np.int64)
    values = np.full((len(found), count), _NONE)
    for k in range(min(count, found.shape[1])):
        columns[:, k] = found.argmax(axis=1)
        values[:, k] = found[lines, columns[:, k]]
        found[lines, columns[:, k]] = _NONE
    return values, columns


def _merge(kept, values: np.ndarray, columns: np.ndarray):
    """The best of two lists of best rows; `kept` holds earlier columns."""
    if kept is None:
        return values, columns
    values, columns = np.concatenate([kept[0], values], 1), np.concatenate([kept[1], columns], 1)
    # The least integer has no negative, so what is missing is sent to the end.
    falling = np.where(values == _NONE, np.iinfo(np.int64).max, -values)
    order = np.argsort(falling, axis=1, kind="stable")[:, : values.shape[1] // 2]
    return np.take_along_axis(values, order, 1), np.take_along_axis(columns, order, 1)


def _streams(batches: Iterator[pa.RecordBatch], known: Grid, work: Callable) -> Iterator[pa.RecordBatch]:
    """Cells come one after the other, first a cell's rows, then the anchors that meet it."""
    current, held, cell = None, [], None
    for batch in batches:
        cells = np.array(batch.column(batch.schema.get_field_index("cell")), np.int64)
        kinds = np.array(batch.column(batch.schema.get_field_index("kind")), np.int64)
        marks = np.flatnonzero((np.diff(cells) != 0) | (np.diff(kinds) != 0)) + 1
        for start, end in zip([0, *marks.tolist()], [*marks.tolist(), len(cells)]):
            if start == end:
                continue
            if current != cells[start]:
                current, held, cell = cells[start], [], None
            part = batch.slice(start, end - start)
            if kinds[start] == 0:
                held.append(part)
                continue
            if cell is None and held:
                cell = _Cell(held, known)
                held = []
            if cell is None:
                continue
            for at in range(0, part.num_rows, ANCHORS_AT_ONCE):
                yield from work(cell, part.slice(at, ANCHORS_AT_ONCE))


FOUND = "anchor_row bigint, slot int, row bigint, id bigint, score bigint"


def _rows_of(cell: _Cell, anchor_rows: np.ndarray, slots: np.ndarray, values: np.ndarray, at: np.ndarray):
    """What was found, as records."""
    line, column = np.nonzero(values != _NONE)
    where = at[line, column]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(anchor_rows[line]), pa.array(slots[line].astype(np.int32)), pa.array(cell.row[where]),
            cell.id.take(pa.array(where)), pa.array(values[line, column]),
        ],
        ["anchor_row", "slot", "row", "id", "score"],
    )


def _same_label(known: Grid, count: int):
    """Each anchor's best other rows of its own label."""
    primes = list(known.primes)

    def work(cell: _Cell, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        columns = {n: batch.column(batch.schema.get_field_index(n)) for n in ("row", "label", "vector")}
        own_rows, labels = (np.array(columns[n], np.int64) for n in ("row", "label"))
        mine = residues(_matrix(columns["vector"], known.size), primes)
        for label in np.unique(labels).tolist():
            of = cell.of_label.get(label)
            if of is None:
                continue
            lines, kept = np.flatnonzero(labels == label), None
            one = [m[lines] for m in mine]
            for start in range(0, len(of), ROWS_AT_ONCE):
                some = of[start : start + ROWS_AT_ONCE]
                found = scores(one, [r[some] for r in cell.residues], primes)
                found[own_rows[lines][:, None] == cell.row[some]] = _NONE
                values, at = _best(found, count)
                kept = _merge(kept, values, some[at])
            yield _rows_of(cell, own_rows[lines], np.zeros(len(lines)), *kept)

    return lambda batches: _streams(batches, known, work)


def _hundredths(score: np.ndarray, part: int) -> np.ndarray:
    """Floor of so many hundredths, with no product beyond 64 bits."""
    return score // 100 * part + score % 100 * part // 100


def _other_labels(known: Grid, count: int, least: int, most: int):
    """For each positive of each anchor the best rows of other labels in its range."""
    primes = list(known.primes)

    def work(cell: _Cell, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        columns = {n: batch.column(batch.schema.get_field_index(n)) for n in batch.schema.names}
        own_rows, labels = (np.array(columns[n], np.int64) for n in ("row", "label"))
        mine = residues(_matrix(columns["vector"], known.size), primes)
        sizes = np.array(columns["positives"].value_lengths(), np.int64)
        given = np.array(columns["positives"].flatten(), np.int64)
        lower, upper = -_hundredths(-given, least), _hundredths(given, most)
        firsts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        kept: dict[int, tuple] = {}
        for start in range(0, len(cell.row), ROWS_AT_ONCE):
            part = slice(start, start + ROWS_AT_ONCE)
            found = scores(mine, [r[part] for r in cell.residues], primes)
            found[labels[:, None] == cell.label[part]] = _NONE
            for slot in range(int(sizes.max(initial=0))):
                lines = np.flatnonzero(sizes > slot)
                high, low = upper[firsts[lines] + slot], lower[firsts[lines] + slot]
                of = found[lines]
                values, at = _best(np.where((of <= high[:, None]) & (of >= low[:, None]), of, _NONE), count)
                kept[slot] = _merge(kept.get(slot), values, at + start)
        for slot, (values, at) in kept.items():
            lines = np.flatnonzero(sizes > slot)
            yield _rows_of(cell, own_rows[lines], np.full(len(lines), slot), values, at)

    return lambda batches: _streams(batches, known, work)


def _met(rows: DataFrame, anchors: DataFrame, known: Grid) -> DataFrame:
    """A partition a cell: its rows in the order of ties, then all anchors."""
    cell = F.pmod(F.xxhash64("row"), F.lit(known.cells)).cast("int")
    some = rows.select("row", "id", "label", "vector").withColumns({"cell": cell, "kind": F.lit(0)})
    every = anchors.withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(known.cells - 1)))).withColumn("kind", F.lit(1))
    both = some.unionByName(every, allowMissingColumns=True)
    return both.repartitionById(known.cells, "cell").sortWithinPartitions(
        "cell", "kind", F.col("id").asc_nulls_last(), "row"
    )


def _first(found: DataFrame, keys: list[str], count: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.col("id").asc_nulls_last(), "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= count)


def mine(
    df: DataFrame, id_col: str = "vec_id", label: str = "label", vector: str = "embedding",
    anchor_every: int = 50, positives: int = 5, negatives: int = 3, lower: int = 50, upper: int = 95,
    scale: int = SCALE, cell_bytes: int = CELL_BYTES, cell_root: int = CELL_ROOT,
) -> DataFrame:
    """`anchor_id, positive_id, rank, negative_id, positive_score, negative_score`.

    Anchors are the rows whose id is a multiple of `anchor_every`; each one's
    positives are its best other rows of the same label. A negative has another
    label and a score of `lower` to `upper` hundredths of the positive's.
    """
    rows = stage(integer_rows(df, id_col, label, vector, scale), "integer-rows")
    is_anchor = F.coalesce(F.col("id") % anchor_every == 0, F.lit(False))
    known = grid(rows, is_anchor, cell_bytes, cell_root)
    anchors = rows.filter(is_anchor).select("row", "label", "vector")
    best = _met(rows, anchors, known).mapInArrow(_same_label(known, positives), FOUND)
    # A positive: place among the anchor's, row, id, score.
    chosen = _first(best, ["anchor_row"], positives).select(
        "anchor_row", (F.col("rank") - 1).cast("int").alias("slot"), F.col("id").alias("positive_id"),
        F.col("score").alias("positive_score"),
    )
    chosen = stage(chosen, "positives")
    scored = chosen.groupBy("anchor_row").agg(
        F.array_sort(F.collect_list(F.struct("slot", "positive_score"))).alias("of")  # at most `positives`
    )
    scored = scored.select(F.col("anchor_row").alias("row"), F.col("of.positive_score").alias("positives"))
    met = _met(rows, anchors.join(scored, "row"), known).mapInArrow(
        _other_labels(known, negatives, lower, upper), FOUND
    )
    taken = _first(met, ["anchor_row", "slot"], negatives)
    names = rows.filter(is_anchor).select(F.col("row").alias("anchor_row"), F.col("id").alias("anchor_id"))
    return taken.join(chosen, ["anchor_row", "slot"]).join(names, "anchor_row").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )

