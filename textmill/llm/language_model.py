"""Context-tree weighting over bytes, and a unigram base score.

The next byte is eight binary choices, one for each prefix of its bits. Every
choice has a context tree over the bytes before it. A node of that tree holds
the Krichevsky-Trofimov estimate from its counts, and its weighted probability
is half its own estimate and half the product of its children's. Prediction
mixes the estimates of all depths along a context with the resulting weights.

Counts of (context, next byte) come from all training texts, added up in each
task and then by key. The tree has all contexts of up to three bytes that occur.
Its nodes below a two-byte context are weighed together, in the task that has
that context; only sums by the last byte go to the driver, for the nodes of one
byte and none. The table of predictions stays distributed, a row of 256 numbers
for a context. The rows of the `contexts` most frequent three-byte contexts, and
those that stand for the unseen ones below each two-byte context, go to all
tasks: at most 65,536 of each, 134 MB. What other contexts predict meets the
texts' remaining bytes in a join.

Unigram counts are as many as there are distinct tokens. The `frequent` most
frequent of them go to all tasks too; all others meet the documents' remaining
tokens in a join. Tokens are compared by a 64-bit hash.

Defined cases: null and empty texts have no byte, score 0 and one token, the
end; a null id counts as training; rows that repeat count and score each;
without training texts every bit has probability 1/2.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.buffers import (
    SPACE_SEPARATED,
    bounded_slices,
    list_array,
    lower_bytes,
    signed,
    text_buffer,
    word_hashes,
    word_spans,
)
from textmill.session import stage

# Two-byte contexts there can be: all get children.
PAIRS = 1 << 16
# Three-byte contexts whose predictions, and tokens whose counts, go to all tasks.
CONTEXTS = 1 << 16
FREQUENT = 1 << 18
# Tokens gathered in a task before they are counted, and counts before they are passed on.
GATHERED = 1 << 20
# Bytes of text handled at once, and three-byte contexts weighed at once, or one two-byte context's.
SLICE, WEIGHED = 1 << 19, 1 << 10

_TOKEN, _GRAM = 0, 1


def _before(low: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, ...]:
    """The byte one, two and three places before each one; 0 before a text's first."""
    place = np.arange(len(low)) - np.repeat(rows[:-1], np.diff(rows))
    out = []
    for back in (1, 2, 3):
        shifted = np.zeros_like(low)
        shifted[back:] = low[:-back]
        shifted[place < back] = 0
        out.append(shifted)
    return tuple(out)


class _Tally:
    """Counts by key, merged when many keys were gathered."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, values: np.ndarray) -> None:
        self.parts.append(np.unique(values, return_counts=True))
        self.size += len(self.parts[-1][0])
        if self.size > GATHERED:
            self.parts = [self.merged()]
            self.size = len(self.parts[0][0])

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        keys, counts = (np.concatenate(x) for x in zip(*self.parts))
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        return keys[first], np.add.reduceat(counts[order], first)

    def passed_on(self, kind: int, least: int = 0) -> Iterator[pa.RecordBatch]:
        """The counts, if there are more than `least`; then it begins anew."""
        if self.size > least:
            yield _batch(kind, *self.merged())
            self.__init__()


def _batch(kind: int, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(keys), kind, np.int32)), pa.array(keys.astype(np.uint64).view(np.int64)),
         pa.array(counts.astype(np.int64))],
        ["kind", "key", "n"],
    )


def _count_corpus(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of tokens and of bytes after three others in this task's texts.

    The key of a byte after others: second last, last, third last, the byte; so two-byte contexts lie together.
    """
    tokens, grams = _Tally(), _Tally()
    for batch in bounded_slices(batches, "_text", SLICE):
        data, rows = text_buffer(batch.column("_text"))
        if not len(data):
            continue
        low = lower_bytes(data)
        starts, ends, _ = word_spans(low, rows, SPACE_SEPARATED)
        tokens.add(word_hashes(low, starts, ends))
        one, two, three = (part.astype(np.uint32) for part in _before(low, rows))
        grams.add(two << 24 | one << 16 | three << 8 | low)
        yield from tokens.passed_on(_TOKEN, GATHERED // 2)
        yield from grams.passed_on(_GRAM, GATHERED // 2)
    yield from tokens.passed_on(_TOKEN)
    yield from grams.passed_on(_GRAM)


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series after eight steps of the recurrence."""
    product = np.ones_like(x)
    for step in range(8):
        product *= x + step
    z = x + 8
    series = 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5)
    return (z - 0.5) * np.log(z) - z + 0.5 * np.log(2 * np.pi) + series - np.log(product)


def _log_estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of that many zeros and ones."""
    both = _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - _log_gamma(zeros + ones + 1.0)
    return both - 2 * _log_gamma(np.array([0.5]))[0]


def _bit_counts(counts: np.ndarray) -> np.ndarray:
    """Counts of bytes [rows, 256] to those of bit prefixes [rows, 512]; 2v and 2v + 1 extend v."""
    out = np.zeros((len(counts), 512))
    out[:, 256:] = counts
    for level in range(7, -1, -1):
        first = 1 << level
        out[:, first : 2 * first] = out[:, 2 * first : 4 * first].reshape(len(counts), first, 2).sum(2)
    return out


class _Level:
    """The nodes of one depth: estimate of a one, log estimate, log weighted probability."""

    def __init__(self, counts: np.ndarray) -> None:
        bits = _bit_counts(counts)
        zeros, ones = bits[:, 0::2][:, :256], bits[:, 1::2][:, :256]
        self.one = (ones + 0.5) / (zeros + ones + 1.0)
        self.log_own = _log_estimate(zeros, ones)
        self.log_weighted = self.log_own.copy()
        self.own_share = np.ones_like(self.one)

    def weigh(self, children: np.ndarray, inner: np.ndarray) -> None:
        """Mix with the children's product; children: sums of their logs; inner: rows that have any."""
        mixed = np.logaddexp(self.log_own, children) - np.log(2)
        self.log_weighted = np.where(inner[:, None], mixed, self.log_own)
        share = np.exp(self.log_own - np.log(2) - self.log_weighted)
        self.own_share = np.where(inner[:, None], share, 1.0)


def _byte_log10(one: np.ndarray) -> np.ndarray:
    """Probabilities of a one [rows, 256 prefixes] to log10 probabilities of bytes [rows, 256]."""
    out = np.zeros((len(one), 512))
    for level in range(8):
        first = 1 << level
        p = one[:, first : 2 * first]
        own = out[:, first : 2 * first]
        out[:, 2 * first : 4 * first : 2] = own + np.log10(1 - p)
        out[:, 2 * first + 1 : 4 * first : 2] = own + np.log10(p)
    return out[:, 256:].astype(np.float32)


@dataclass
class ContextTree:
    """`table` [row, byte]: log10 probabilities. Rows by two-byte context, or below an expanded one."""

    table: np.ndarray
    two: np.ndarray
    numbers: np.ndarray
    three: np.ndarray

    def rows(self, one: np.ndarray, two: np.ndarray, three: np.ndarray) -> np.ndarray:
        context = two.astype(np.int64) << 8 | one
        head = self.numbers[context]
        return np.where(head >= 0, self.three[np.maximum(head, 0) * 256 + three], self.two[context])


class _Weighed:
    """Two- and three-byte contexts, the former with all that is below them.

    From counts of three-byte tuples and of those below the contexts with `numbers`: number << 16 | byte << 8 | next.
    """

    def __init__(self, grams: tuple[np.ndarray, np.ndarray], numbers: np.ndarray, deeper: tuple[np.ndarray, np.ndarray]) -> None:
        keys, counts = grams
        self.seen2, at2 = np.unique(keys >> 8, return_inverse=True)
        self.counts2 = np.zeros((len(self.seen2) + 1, 256))  # the last row: a context never seen
        self.counts2[at2, keys & 255] = counts
        self.seen3, at3 = np.unique(deeper[0] >> 8, return_inverse=True)  # head << 8 | byte
        counts3 = np.zeros((len(self.seen3) + 1, 256))
        counts3[at3, deeper[0] & 255] = deeper[1]
        self.totals3 = counts3.sum(1)[:-1]
        self.leaf, self.mid = _Level(counts3), _Level(self.counts2)
        head2 = np.concatenate([numbers[self.seen2], [-1]])
        self.row_of_head = np.zeros(int(numbers.max()) + 2, np.int64)
        self.row_of_head[head2[head2 >= 0]] = np.flatnonzero(head2 >= 0)
        below = np.zeros_like(self.mid.one)
        np.add.at(below, self.row_of_head[self.seen3 >> 8], self.leaf.log_weighted[:-1])
        self.mid.weigh(below, head2 >= 0)

    def upper(self) -> tuple[np.ndarray, np.ndarray]:
        """By last byte: counts of next bytes, and sums of the log weighted probabilities."""
        counts1, below = np.zeros((256, 256)), np.zeros((256, 256))
        np.add.at(counts1, self.seen2 & 255, self.counts2[:-1])
        np.add.at(below, self.seen2 & 255, self.mid.log_weighted[:-1])
        return counts1, below


def _top(counts1: np.ndarray, below: np.ndarray) -> tuple[_Level, _Level]:
    """The contexts of one byte and of none."""
    low, root = _Level(counts1), _Level(counts1.sum(0)[None])
    low.weigh(below, np.ones(256, bool))
    root.weigh(low.log_weighted.sum(0)[None], np.ones(1, bool))
    return low, root


def _mixture(
    top: tuple[_Level, _Level], bytes1: np.ndarray, below: _Weighed | None = None,
    rows2: np.ndarray | None = None, rows3: np.ndarray | None = None,
) -> np.ndarray:
    """log10 probabilities of the next byte; without rows of `below`: after a two-byte context never seen."""
    low, root = top
    out = np.empty((len(bytes1), 256), np.float32)
    for start in range(0, len(bytes1), 2048):
        part = slice(start, start + 2048)
        p = np.full((len(bytes1[part]), 256), 0.5) if rows2 is None else below.mid.one[rows2[part]]
        if rows3 is not None:
            share = below.mid.own_share[rows2[part]]
            p = share * p + (1 - share) * below.leaf.one[rows3[part]]
        share = low.own_share[bytes1[part]]
        p = share * low.one[bytes1[part]] + (1 - share) * p
        p = root.own_share * root.one + (1 - root.own_share) * p
        out[part] = _byte_log10(p)
    return out


def _below_heads(top: tuple[_Level, _Level], below: _Weighed, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Predictions below numbered two-byte contexts: for a third byte never seen there, and for each that was."""
    at3 = below.seen3 >> 8
    unseen = np.full(len(heads), len(below.seen3))
    return (
        _mixture(top, heads & 255, below, below.row_of_head[: len(heads)], unseen),
        _mixture(top, heads[at3] & 255, below, below.row_of_head[at3], np.arange(len(below.seen3))),
    )


def _numbered(numbers: np.ndarray) -> np.ndarray:
    """The two-byte contexts in the order of their numbers."""
    heads = np.flatnonzero(numbers >= 0)
    return heads[np.argsort(numbers[heads])]


def build_tree(grams: tuple[np.ndarray, np.ndarray], numbers: np.ndarray, deeper: tuple[np.ndarray, np.ndarray]) -> ContextTree:
    """The mixture of all depths from counts of three-byte tuples and of those below expanded contexts."""
    below, heads = _Weighed(grams, numbers, deeper), _numbered(numbers)
    top, seen2 = _top(*below.upper()), below.seen2
    # Rows: one for each last byte (unseen contexts), seen contexts, those below expanded ones
    # (first, for each, the one for a byte that was never seen there).
    table = np.concatenate([
        _mixture(top, np.arange(256)),
        _mixture(top, seen2 & 255, below, np.arange(len(seen2))),
        *_below_heads(top, below, heads),
    ])
    two = np.arange(65536) & 255
    two[seen2] = 256 + np.arange(len(seen2))
    three = np.repeat(256 + len(seen2) + np.arange(len(heads)), 256)
    three[below.seen3] = 256 + len(seen2) + len(heads) + np.arange(len(below.seen3))
    if not len(three):
        three = np.zeros(256, np.int64)
    return ContextTree(table, two.astype(np.int32), numbers, three.astype(np.int32))


def expand(keys: np.ndarray, counts: np.ndarray, most: int = PAIRS) -> np.ndarray:
    """Numbers of the most frequent two-byte contexts, -1 for all others."""
    seen, at = np.unique(keys >> 8, return_inverse=True)
    totals = np.bincount(at, counts, len(seen)) if len(seen) else np.zeros(0)
    chosen = seen[np.lexsort((seen, -totals))][:most]
    numbers = np.full(65536, -1, np.int32)
    numbers[chosen] = np.arange(len(chosen))
    return numbers


def _by_heads(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Weighed, np.ndarray]]:
    """Weighed two-byte contexts, and those contexts, from counts sorted by key that have each one's in a row."""

    def weighed(keys: np.ndarray, counts: np.ndarray) -> tuple[_Weighed, np.ndarray]:
        pairs, at = np.unique((keys >> 16) << 8 | keys & 255, return_inverse=True)
        grams = pairs, np.bincount(at, counts, len(pairs))
        numbers = np.full(PAIRS, -1, np.int32)
        heads = np.unique(keys >> 16)
        numbers[heads] = np.arange(len(heads))
        return _Weighed(grams, numbers, (numbers[keys >> 16].astype(np.int64) << 16 | keys & 0xFFFF, counts)), heads

    keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        keys = np.concatenate([keys, batch.column("key").to_numpy()])
        counts = np.concatenate([counts, batch.column("n").to_numpy()])
        # Where a two-byte context begins, and how many three-byte ones lie before it.
        starts = np.flatnonzero(np.append(True, keys[1:] >> 16 != keys[:-1] >> 16)) if len(keys) else keys
        before = np.cumsum(np.append(False, keys[1:] >> 8 != keys[:-1] >> 8))[starts] if len(keys) else keys
        done = 0
        for i in range(1, len(starts)):
            if i + 1 == len(starts) or before[i + 1] - before[np.searchsorted(starts, done)] > WEIGHED:
                yield weighed(keys[done : starts[i]], counts[done : starts[i]])
                done = starts[i]
        keys, counts = keys[done:], counts[done:]
    if len(keys):
        yield weighed(keys, counts)


def _sum_upper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What this task's two-byte contexts add to those of one byte."""
    counts1, below = np.zeros((256, 256)), np.zeros((256, 256))
    for part, _ in _by_heads(batches):
        counts, weights = part.upper()
        counts1, below = counts1 + counts, below + weights
    seen = np.flatnonzero(counts1.any(1))
    cells = (seen[:, None] << 8 | np.arange(256)).ravel()
    yield pa.RecordBatch.from_arrays(
        [pa.array(cells.astype(np.int64)), pa.array(counts1[seen].ravel()), pa.array(below[seen].ravel())],
        ["cell", "n", "weight"],
    )


def _predictions(shared, least: int):
    """A row of log10 probabilities for each context, byte -1: for third bytes never seen; of a context
    with less than `least` bytes after it: what is to add to that row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for below, heads in _by_heads(batches):
            unseen, seen = _below_heads(shared.value, below, heads)
            head, totals = below.seen3 >> 8, below.totals3.astype(np.int64)
            seen = np.where((totals < least)[:, None], seen - unseen[head], seen)
            logs = np.concatenate([unseen, seen])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([heads, heads[head]]).astype(np.int32)),
                 pa.array(np.concatenate([np.full(len(heads), -1), below.seen3 & 255]).astype(np.int32)),
                 pa.array(np.concatenate([np.zeros(len(heads), np.int64), totals])),
                 list_array(logs.ravel(), np.arange(len(logs) + 1) * 256)],
                ["head", "byte", "n", "logs"],
            )

    return run


def _gathered_tree(top: tuple[_Level, _Level], rows: DataFrame) -> tuple[ContextTree, int]:
    """The tree of the rows that go to all tasks, and the first row of a three-byte context in it."""
    found = rows.orderBy(F.col("byte") >= 0, "head", "byte").toArrow()
    head, byte = (found.column(c).to_numpy().astype(np.int64) for c in ("head", "byte"))
    logs = found.column("logs").combine_chunks().flatten().to_numpy().reshape(-1, 256) if len(head) else np.zeros((0, 256))
    heads = head[byte < 0]
    numbers = np.full(PAIRS, -1, np.int32)
    numbers[heads] = np.arange(len(heads))
    three = np.repeat(256 + np.arange(max(1, len(heads))), 256)
    listed = byte >= 0
    three[numbers[head[listed]].astype(np.int64) << 8 | byte[listed]] = 256 + np.flatnonzero(listed)
    table = np.concatenate([_mixture(top, np.arange(256)), logs.astype(np.float32)])
    return ContextTree(table, (np.arange(PAIRS) & 255).astype(np.int32), numbers, three.astype(np.int32)), 256 + len(heads)


def _score_batches(shared, frequent: tuple[np.ndarray, np.ndarray], listed: int):
    """Each text's context-tree score, its known tokens' logs, and the tokens and bytes left to look up.

    Bytes are left where the row of their context, below a seen one of two bytes, comes before `listed`.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree: ContextTree = shared.value
        hashes, logs = frequent
        for batch in bounded_slices(batches, "_text", SLICE):
            data, rows = text_buffer(batch.column("_text"))
            low = lower_bytes(data)
            one, two, three = _before(low, rows)
            at_row = tree.rows(one, two, three)
            values = tree.table[at_row, low].astype(np.float64)
            deep = np.flatnonzero((at_row >= 256) & (at_row < listed))
            grams = two[deep].astype(np.int64) << 24 | one[deep].astype(np.int64) << 16 | three[deep].astype(np.int64) << 8 | low[deep]
            deep_rows = np.searchsorted(deep, rows)
            sums = np.concatenate([[0], np.cumsum(values)])
            starts, ends, firsts = word_spans(low, rows, SPACE_SEPARATED)
            words = word_hashes(low, starts, ends)
            order = np.argsort(words, kind="stable")  # near keys are looked up together
            at = np.empty(len(words), np.int64)
            at[order] = np.searchsorted(hashes, words[order])
            at = np.minimum(at, len(hashes) - 1)
            found = hashes[at] == words if len(hashes) else np.zeros(len(words), bool)
            log_sums = np.concatenate([[0], np.cumsum(np.where(found, logs[at], 0.0) if len(hashes) else 0.0 * at)])
            known = np.concatenate([[0], np.cumsum(found)])
            left = np.concatenate([[0], np.cumsum(~found)])[firsts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row"), batch.column("_id"), batch.column("_held"),
                 pa.array(np.diff(rows)), pa.array(np.diff(firsts)),
                 pa.array(np.diff(known[firsts])), pa.array(np.diff(log_sums[firsts])),
                 pa.array(np.diff(sums[rows])), list_array(signed(words[~found]), left), list_array(grams, deep_rows)],
                ["_row", "_id", "held_out", "n_bytes", "n_words", "n_known", "logs", "score", "rest", "deep"],
            )

    return run


def _gathered(df: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Keys and counts of a table whose size is bounded."""
    table = df.toArrow()
    return table.column(0).to_numpy(), table.column(1).to_numpy()


def _least(counts: DataFrame, most: int) -> tuple[int, int, int]:
    """The least count `n` such that `most` rows at most have it or a greater one; the sum of counts, the rows."""
    least, total, taken = 1 << 62, 0, 0
    for n, many in counts.groupBy("n").agg(F.count("*").alias("many")).orderBy(F.desc("n")).toLocalIterator():
        total, taken = total + n * many, taken + many
        least = n if taken <= most else least
    return least, total, taken


def _trained(grams: DataFrame, contexts: int) -> tuple[ContextTree, int, DataFrame | None]:
    """The tree for all tasks, the first row of a context of three bytes in it, and `context, logs` to add for the others, if any."""
    spark = grams.sparkSession
    # A two-byte context has 65,536 counts at most, and they lie in one task.
    head = F.shiftright("key", 16)
    by_heads = grams.repartition(head).sortWithinPartitions("key")
    parts = by_heads.select("key", "n").mapInArrow(_sum_upper, "cell bigint, n double, weight double")
    # Added up as decimals, whose sum doesn't depend on the order.
    sums = parts.groupBy("cell").agg(
        F.sum(F.col("n").cast("decimal(28,0)")).cast("double").alias("n"),
        F.sum(F.col("weight").cast("decimal(28,8)")).cast("double").alias("weight"),
    ).toArrow()
    both = np.zeros((2, PAIRS))
    both[:, sums.column("cell").to_numpy()] = sums.column("n").to_numpy(), sums.column("weight").to_numpy()
    top = _top(*both.reshape(2, 256, 256))
    totals = grams.groupBy(F.shiftright("key", 8).alias("context")).agg(F.sum("n").alias("n"))
    least, _, found = _least(totals, contexts)
    shared = spark.sparkContext.broadcast(top)
    rows = stage(
        by_heads.select("key", "n").mapInArrow(_predictions(shared, least), "head int, byte int, n bigint, logs array<float>"),
        "lm-contexts",
    )
    tree, listed = _gathered_tree(top, rows.filter((F.col("byte") < 0) | (F.col("n") >= least)).select("head", "byte", "logs"))
    if len(tree.table) - listed == found:
        return tree, 0, None  # nothing to look up
    context = (F.shiftleft("head", 8) + F.col("byte")).cast("bigint").alias("context")
    return tree, listed, rows.filter((F.col("byte") >= 0) & (F.col("n") < least)).select(context, "logs")


def score(
    df: DataFrame, held_out: F.Column, id_col: str = "doc_id", text: str = "text",
    frequent: int = FREQUENT, contexts: int = CONTEXTS,
) -> DataFrame:
    """Score all texts with a model of those that are not held out.

    Columns: the id, held_out, n_tokens, n_known, train_tokens, base_score, score
    (log10 probability under the context tree) and bits_per_byte.
    """
    spark = df.sparkSession
    texts = df.select(F.col(id_col).alias("_id"), F.col(text).alias("_text"), F.coalesce(held_out, F.lit(False)).alias("_held"))
    training = texts.filter("not _held").select("_text")
    kind = "kind int, key bigint, n bigint"
    counts = stage(
        training.mapInArrow(_count_corpus, kind).groupBy("kind", "key").agg(F.sum("n").alias("n")), "lm-counts"
    )
    tokens = counts.filter(F.col("kind") == _TOKEN).select("key", "n")
    tree, listed, deeper = _trained(counts.filter(F.col("kind") == _GRAM).select("key", "n"), contexts)
    shared = spark.sparkContext.broadcast(tree)

    ends = training.count()
    least, total, distinct = _least(tokens, frequent)
    total, distinct = total + ends, distinct + int(ends > 0)
    keys, many = _gathered(tokens.filter(F.col("n") >= least))
    order = np.argsort(keys.view(np.uint64))
    common = (keys.view(np.uint64)[order], np.log10(many[order] + 1.0))

    kind = texts.schema["_id"].dataType.simpleString()
    scored = stage(
        texts.withColumn("_row", F.monotonically_increasing_id()).mapInArrow(
            _score_batches(shared, common, listed),
            f"_row bigint, _id {kind}, held_out boolean, n_bytes bigint, n_words bigint, n_known bigint, "
            "logs double, score double, rest array<bigint>, deep array<bigint>",
        ),
        "lm-scores",
    )
    rest = scored.select("_row", F.explode("rest").alias("key")).groupBy("_row", "key").agg(F.count("*").alias("times"))
    rare = tokens.filter(F.col("n") < least)
    looked_up = (
        rest.join(rare, "key")
        .groupBy("_row")
        .agg(
            F.sum("times").alias("_known"),
            F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("_logs"),
        )
    )
    if deeper is not None:
        left = scored.select("_row", F.explode("deep").alias("key")).groupBy("_row", "key").agg(F.count("*").alias("times"))
        more = (
            left.withColumn("context", F.shiftright("key", 8)).join(deeper, "context").groupBy("_row")
            .agg(F.sum(F.col("times") * F.get("logs", F.col("key").bitwiseAND(255).cast("int"))).alias("_more"))
        )
        scored = scored.join(more, "_row", "left").withColumn("score", F.col("score") + F.coalesce("_more", F.lit(0.0)))
    words = F.col("n_words") + 1
    logs = F.col("logs") + F.coalesce("_logs", F.lit(0.0)) + float(np.log10(ends + 1.0))
    return scored.drop("rest", "deep").join(looked_up, "_row", "left").select(
        F.col("_id").alias(id_col),
        "held_out",
        words.alias("n_tokens"),
        (F.col("n_known") + F.coalesce("_known", F.lit(0)) + int(ends > 0)).alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"),
        (logs - words * float(np.log10(total + distinct + 1.0))).alias("base_score"),
        "score",
        F.when(F.col("n_bytes") > 0, -F.col("score") / float(np.log10(2)) / F.col("n_bytes")).alias("bits_per_byte"),
    )
