"""Byte-level BPE encoding and decoding, split without regular expressions.

A text's code points become classes, and each class is a function from the
splitter's state to its next state. Composing those functions is associative,
so a blocked prefix scan finds the state before every character of a whole
batch at once, and with it where each piece starts. Pieces are byte slices that
go through pair merging once and then come from a bounded cache. Every token
keeps its byte offset, with which decoding places all tokens at once.

Defined cases: a null or empty text has no tokens and decodes to an empty text;
the texts are never cut, one of any length is one row; rows that repeat are
encoded each; an empty table gives an empty table.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from array import array
from collections.abc import Iterator
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.buffers import bounded_slices, list_array, string_array, text_buffer

# Pieces a task remembers; the cache starts anew beyond that, which changes no result.
CACHED_PIECES = 1 << 18
# Stands for a pair that is no token.
MISSING = 1 << 60
# Longer pieces are merged with a heap, shorter ones by scanning.
HEAP_FROM = 48

# Unicode's White_Space code points.
WHITE_SPACE = [
    *range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
]

# Symbols, by class and what follows. A contraction is 's 't 'm 'd or 're 've 'll.
LETTER, NUMBER, OTHER, SHORT, LONG, GLUE, LAST, SPACE = range(8)
# States: what the character before belongs to. GLUED is a single space that joins
# what follows; TWO and ONE are a contraction's characters still to come.
FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_SPACE, GLUED, ONE, TWO = range(8)


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """The next state, and whether a piece starts at this character."""
    if state == TWO:
        return ONE, False
    if state == ONE:
        return FRESH, False
    if symbol in (LETTER, NUMBER, OTHER):
        run = {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS, OTHER: IN_OTHERS}[symbol]
        return run, state not in (run, GLUED)
    if symbol in (SHORT, LONG):
        if state in (IN_OTHERS, GLUED):
            return IN_OTHERS, False
        return (ONE if symbol == SHORT else TWO), True
    if symbol == GLUE:
        return GLUED, True
    if symbol == LAST:
        return FRESH, True
    return IN_SPACE, state != IN_SPACE


@cache
def _machine() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start flags, the functions that compositions can reach, and their composition table.

    Functions 0-7 are the symbols', 8-15 the same at the start of a text, 16 the identity.
    """
    starts = np.array([[_step(s, x)[1] for x in range(8)] for s in range(8)])
    functions = [tuple(_step(s, x)[0] for s in range(8)) for x in range(8)]
    functions += [(f[FRESH],) * 8 for f in functions] + [tuple(range(8))]
    known: dict[tuple, int] = {}
    for number, f in enumerate(functions):
        known.setdefault(f, number)
    table: list[list[int]] = []
    for f in functions:  # grows while it runs
        row = []
        for g in functions[:17]:
            both = tuple(g[s] for s in f)
            if both not in known:
                known[both] = len(functions)
                functions.append(both)
            row.append(known[both])
        table.append(row)
    size = len(functions)
    full = np.array(
        [[known[tuple(g[s] for s in f)] for g in functions] for f in functions], np.uint16
    )
    assert size == len(table)
    return starts, np.array(functions, np.uint8), full


def _scan(codes: np.ndarray, table: np.ndarray, block: int = 128) -> np.ndarray:
    """Inclusive prefix compositions."""
    if len(codes) <= block:
        out = codes.copy()
        for i in range(1, len(out)):
            out[i] = table[out[i - 1], out[i]]
        return out
    blocks = -(-len(codes) // block)
    grid = np.full(blocks * block, 16, np.uint16)
    grid[: len(codes)] = codes
    grid = np.ascontiguousarray(grid.reshape(blocks, block).T)
    for i in range(1, block):
        grid[i] = table[grid[i - 1], grid[i]]
    ahead = _scan(grid[-1], table, block)
    grid[:, 1:] = table[ahead[:-1], grid[:, 1:]]
    return grid.T.reshape(-1)[: len(codes)]


@cache
def _classes() -> np.ndarray:
    """LETTER, NUMBER, SPACE or OTHER of every code point."""
    kinds = np.full(0x110000, OTHER, np.uint8)
    letters = [unicodedata.category(chr(i))[0] for i in range(0x110000)]
    kinds[[i for i, c in enumerate(letters) if c == "L"]] = LETTER
    kinds[[i for i, c in enumerate(letters) if c == "N"]] = NUMBER
    kinds[WHITE_SPACE] = SPACE
    return kinds


def piece_starts(codes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Whether a piece starts at each code point; rows: where each text starts, and the end."""
    size = len(codes)
    if not size:
        return np.zeros(0, bool)
    first = np.zeros(size + 1, bool)
    first[rows] = True
    kinds = _classes()[codes]
    padded = np.concatenate([codes, np.zeros(3, codes.dtype)])
    one, two = padded[1 : size + 1], padded[2 : size + 2]
    next_inside = ~first[1:]
    symbols = kinds.copy()
    marks = np.flatnonzero((codes == 0x27) & next_inside)
    if len(marks):
        a, b = one[marks], two[marks]
        short = np.isin(a, [ord(c) for c in "stmd"])
        inside = np.concatenate([next_inside, [False]])[marks + 1]
        long = inside & (
            (np.isin(a, [ord("r"), ord("v")]) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))
        )
        symbols[marks[short]] = SHORT
        symbols[marks[long & ~short]] = LONG
    following = np.concatenate([kinds[1:], [SPACE]])
    last = (kinds == SPACE) & next_inside & (following != SPACE)
    symbols[last] = np.where(codes[last] == 0x20, GLUE, LAST)
    starts, functions, table = _machine()
    after = functions[_scan(symbols + 8 * first[:-1].astype(np.uint16), table), FRESH]
    before = np.concatenate([[FRESH], after[:-1]])
    return starts[before, symbols] | first[:-1]


class PairMerger:
    """Token ids of pieces, by the ranks of a vocabulary."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        size = max(ranks.values()) + 1
        self.lengths = np.zeros(size, np.int64)
        for token, rank in ranks.items():
            self.lengths[rank] = len(token)
        self.offsets = np.concatenate([[0], np.cumsum(self.lengths)])
        by_rank = sorted(ranks, key=ranks.get)
        self.bytes = np.frombuffer(b"".join(by_rank), np.uint8)
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {
            ranks[a] << 32 | ranks[b]: rank
            for token, rank in ranks.items()
            for cut in range(1, len(token))
            if (a := token[:cut]) in ranks and (b := token[cut:]) in ranks
        }
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_values = np.array([pairs[k] for k in sorted(pairs)], np.int64)
        self._forget()

    def _forget(self) -> None:
        self.index: dict[bytes, int] = {}
        self.flat = array("i")
        self.firsts = array("q", [0])

    def _pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_values[at], MISSING)

    def merge(self, pieces: list[bytes]) -> list[list[int]]:
        """Merge in every piece the pair of lowest rank, the leftmost first, until none is left.

        All pieces take one merge a round.
        """
        out: list[list[int] | None] = [None] * len(pieces)
        open_pieces = []
        for number, piece in enumerate(pieces):
            if (rank := self.ranks.get(piece)) is not None:
                out[number] = [rank]
            elif len(piece) >= HEAP_FROM:
                out[number] = self._merge_long(piece)
            else:
                open_pieces.append(number)
        if not open_pieces:
            return out
        ids = self.byte_ids[np.frombuffer(b"".join([pieces[n] for n in open_pieces]), np.uint8)]
        sizes = np.array([len(pieces[n]) for n in open_pieces])
        owner = np.repeat(np.array(open_pieces), sizes)
        pairs = np.full(len(ids), MISSING)  # of a token and the next one of its piece
        inner = np.flatnonzero(owner[:-1] == owner[1:])
        pairs[inner] = self._pair_ranks(ids[inner], ids[inner + 1])
        while len(ids):
            firsts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            sizes = np.diff(np.concatenate([firsts, [len(ids)]]))
            best = np.minimum.reduceat(pairs, firsts)
            done = np.repeat(best == MISSING, sizes)
            if done.any():
                values, of = ids[done].tolist(), firsts[best == MISSING]
                stops = np.cumsum(sizes[best == MISSING]).tolist()
                for number, start, stop in zip(owner[of].tolist(), [0, *stops], stops):
                    out[number] = values[start:stop]
                ids, owner, pairs = ids[~done], owner[~done], pairs[~done]
                continue
            at = np.flatnonzero(pairs == np.repeat(best, sizes))
            at = at[np.concatenate([[True], owner[at][1:] != owner[at][:-1]])]
            ids[at] = best
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            at = at - np.arange(len(at))
            ids, owner, pairs = ids[keep], owner[keep], pairs[keep]
            right = np.minimum(at + 1, len(ids) - 1)
            pairs[at] = np.where(
                (right > at) & (owner[right] == owner[at]), self._pair_ranks(ids[at], ids[right]), MISSING
            )
            left = at[(at > 0)]
            left = left[owner[left - 1] == owner[left]] - 1
            pairs[left] = self._pair_ranks(ids[left], ids[left + 1])
        return out

    def _merge_long(self, piece: bytes) -> list[int]:
        ranks, size = self.ranks, len(piece)
        end = list(range(1, size + 1))  # of the part that starts here; 0: merged away
        before = list(range(-1, size - 1))

        def rank_at(i: int) -> int | None:
            j = end[i]
            return ranks.get(piece[i : end[j]]) if j < size else None

        heap = [(r, i, i + 2) for i in range(size - 1) if (r := rank_at(i)) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = end[i]
            if not j or j >= size or end[j] != stop:
                continue
            end[i], end[j] = stop, 0
            if stop < size:
                before[stop] = i
            for k in (i, before[i]):
                if k >= 0 and (r := rank_at(k)) is not None:
                    heapq.heappush(heap, (r, k, end[end[k]]))
        out, i = [], 0
        while i < size:
            out.append(ranks[piece[i : end[i]]])
            i = end[i]
        return out

    def encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All pieces' ids, and how many each has."""
        if len(self.index) > CACHED_PIECES:
            self._forget()
        index, known = self.index, self.index.get
        numbers = np.array([known(p, -1) for p in pieces], np.int64)
        unknown = np.flatnonzero(numbers < 0).tolist()
        fresh = list(dict.fromkeys([pieces[i] for i in unknown]))
        for piece, ids in zip(fresh, self.merge(fresh)):
            index[piece] = len(index)
            self.flat.extend(ids)
            self.firsts.append(len(self.flat))
        numbers[unknown] = [index[pieces[i]] for i in unknown]
        firsts, flat = np.frombuffer(self.firsts, np.int64), np.frombuffer(self.flat, np.int32)
        counts = np.diff(firsts)[numbers]
        total = np.concatenate([[0], np.cumsum(counts)])
        at = np.arange(total[-1]) + np.repeat(firsts[numbers] - total[:-1], counts)
        return flat[at], counts  # a copy: the cache may grow again


@lru_cache(maxsize=2)
def _merger(vocabulary: bytes) -> PairMerger:
    lines = (line.split() for line in vocabulary.splitlines() if line)
    return PairMerger({base64.b64decode(token): int(rank) for token, rank in lines})


def read_vocabulary(path: str) -> bytes:
    """The rank file: one token in base64 and its rank a line. Below 2 MB for 100,000 tokens."""
    with open(path, "rb") as file:
        return file.read()


def encode_batch(column: pa.Array, merger: PairMerger) -> tuple[pa.Array, pa.Array]:
    """Ids and byte offsets of every text's tokens."""
    data, rows = text_buffer(column)
    raw = data.tobytes()
    heads = np.flatnonzero((data & 0xC0) != 0x80)
    codes = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), np.uint32)
    at = heads[piece_starts(codes, np.searchsorted(heads, rows))]
    bounds = at.tolist() + [len(raw)]
    ids, counts = merger.encode([raw[a:b] for a, b in zip(bounds, bounds[1:])])
    ends = np.concatenate([[0], np.cumsum(merger.lengths[ids])])
    tokens = np.concatenate([[0], np.cumsum(counts)])[np.searchsorted(at, rows)]
    offsets = ends[:-1] - np.repeat(rows[:-1], np.diff(tokens))
    return list_array(ids, tokens), list_array(offsets.astype(np.int32), tokens)


def encode(df: DataFrame, vocabulary: bytes, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The id with `ids` and `offsets`: every token of the text and the byte it starts at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger = _merger(vocabulary)
        for batch in bounded_slices(batches, "_text"):
            ids, offsets = encode_batch(batch.column("_text"), merger)
            yield pa.RecordBatch.from_arrays([batch.column("_id"), ids, offsets], ["_id", "ids", "offsets"])

    narrow = df.select(F.col(id_col).alias("_id"), F.col(text).alias("_text"))
    kind = narrow.schema["_id"].dataType.simpleString()
    out = narrow.mapInArrow(run, f"_id {kind}, ids array<int>, offsets array<int>")
    return out.withColumnRenamed("_id", id_col)


def decode_batch(ids: pa.ListArray, offsets: pa.ListArray, merger: PairMerger) -> pa.Array:
    rows = np.concatenate([[0], np.cumsum(np.asarray(ids.value_lengths()))])
    tokens, places = np.asarray(ids.flatten()), np.asarray(offsets.flatten()).astype(np.int64)
    lengths = merger.lengths[tokens]
    sums = np.concatenate([[0], np.cumsum(lengths)])
    sizes = sums[rows]
    places = places + np.repeat(sizes[:-1], np.diff(rows))
    shift = np.repeat(merger.offsets[tokens] - places, lengths)
    out = np.empty(sums[-1], np.uint8)
    at = np.repeat(places - sums[:-1], lengths) + np.arange(sums[-1])
    out[at] = merger.bytes[shift + at]
    return string_array(out, sizes)


def decode(df: DataFrame, vocabulary: bytes, id_col: str = "doc_id") -> DataFrame:
    """The id with `ids` and `decoded`: the bytes that the ids stand for, placed by `offsets`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger = _merger(vocabulary)
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                whole = decode_batch(part.column("ids"), part.column("offsets"), merger)
                yield pa.RecordBatch.from_arrays(
                    [part.column("_id"), part.column("ids"), whole.cast(pa.binary())], ["_id", "ids", "decoded"]
                )

    narrow = df.select(F.col(id_col).alias("_id"), "ids", "offsets")
    kind = narrow.schema["_id"].dataType.simpleString()
    out = narrow.mapInArrow(run, f"_id {kind}, ids array<int>, decoded binary")
    return out.withColumnRenamed("_id", id_col)


def round_trip(df: DataFrame, vocabulary: bytes, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The id with `ids` and the bytes `decoded` from them, encoded and decoded in the same task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger = _merger(vocabulary)
        for batch in bounded_slices(batches, "_text", 1 << 20):
            ids, offsets = encode_batch(batch.column("_text"), merger)
            whole = decode_batch(ids, offsets, merger).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("_id"), ids, whole], ["_id", "ids", "decoded"])

    narrow = df.select(F.col(id_col).alias("_id"), F.col(text).alias("_text"))
    kind = narrow.schema["_id"].dataType.simpleString()
    out = narrow.mapInArrow(run, f"_id {kind}, ids array<int>, decoded binary")
    return out.withColumnRenamed("_id", id_col)
