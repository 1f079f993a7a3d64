"""Language of a text from averaged hashed subword embeddings.

Subwords are the runs of two to four letters of each lower-cased word, with its
two ends as letters of their own. Each hashes to an embedding; a text is the
mean of its subwords' embeddings, and a linear softmax gives the languages.
Embeddings and softmax are trained together by stochastic gradient descent.
As both are linear before the softmax, prediction adds up one precomputed
number a subword and language.

The model is fitted on a bounded sample: at most `rows` texts, as evenly by
language as there are texts, chosen by a hash of the id. One in five of them
only calibrates: a temperature makes scores honest, and a text is rejected if
its score lies below all but `rejected` of the rightly predicted ones.

Defined cases: null texts and texts without a letter are `und` with score 0 and
rejected; rows with a null language are never learned from; without any
labelled text all are `und`; of equal scores the first language by name wins;
texts are read whole; rows that repeat are predicted each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.buffers import bounded_slices, code_points, list_array
from textmill.llm.byte_pairs import LETTER, _classes

BUCKETS = 1 << 15
# Bounds of the fit: texts, and languages (the most frequent ones).
SAMPLE_ROWS = 1600
MOST_LANGUAGES = 200
DIMENSIONS, EPOCHS, RATE = 16, 6, 0.5
REJECTED = 0.01
UNKNOWN = "und"


@cache
def _folded() -> np.ndarray:
    """Lower-case letter of each code point, 0 for what is no letter."""
    table = np.zeros(0x110000, np.uint32)
    for code in np.flatnonzero(_classes() == LETTER).tolist():
        low = chr(code).lower()
        table[code] = ord(low) if len(low) == 1 else code
    return table


def subwords(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all texts' subwords, the first of each text, and whether a text has a letter."""
    codes, rows = code_points(column)
    count = len(rows) - 1
    letters = np.zeros(len(codes) + count + 3, np.uint64)
    text = np.repeat(np.arange(count), np.diff(rows))
    letters[np.arange(len(codes)) + text + 1] = _folded()[codes]  # one 0 before each text
    inside = letters != 0
    starts = rows + np.arange(count + 1)  # of the 0 before each text
    found, places = [], []
    value = letters * np.uint64(0x9E3779B97F4A7C15)
    for width in (2, 3, 4):
        size = len(letters) - width + 1
        value = value[:size] + letters[width - 1 :] * np.uint64(
            pow(0x9E3779B97F4A7C15, 2 * width + 1, 1 << 64)
        )
        whole = inside[1 : 1 + size] if width > 2 else inside[:size] | inside[1:]
        if width == 4:
            whole = whole & inside[2 : 2 + size]
        at = np.flatnonzero(whole)
        mixed = (value[at] ^ (value[at] >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        found.append((mixed >> np.uint64(64 - 15)).astype(np.int32))
        places.append(np.searchsorted(at, starts))
    # All widths of a text side by side: ranges of each width, text after text.
    firsts = sum(places)
    buckets = np.empty(firsts[-1], np.int32)
    shift = np.zeros(count + 1, np.int64)
    for own, place in zip(found, places):
        lengths = np.diff(place)
        to = firsts[:-1] + shift[:-1]
        buckets[np.arange(len(own)) + np.repeat(to - place[:-1], lengths)] = own
        shift[:-1] += lengths
    has = np.diff(np.concatenate([[0], np.cumsum(inside)])[np.minimum(starts, len(letters))]) > 0
    return buckets, firsts, has


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # [language, bucket]
    temperature: float
    least: float  # score below which a text is rejected

    def logits(self, buckets: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        lengths = np.diff(firsts)
        full = np.flatnonzero(lengths)
        out = np.zeros((len(lengths), len(self.languages)))
        if len(full):
            for language, weights in enumerate(self.weights):
                sums = np.add.reduceat(weights[buckets], firsts[full], dtype=np.float64)
                out[full, language] = sums / lengths[full]
        return out

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        return _softmax(logits / self.temperature)


def _softmax(logits: np.ndarray) -> np.ndarray:
    powers = np.exp(logits - logits.max(-1, keepdims=True))
    return powers / powers.sum(-1, keepdims=True)


def train(bags: list[tuple[np.ndarray, np.ndarray]], names: list[str], rejected: float = REJECTED) -> Model | None:
    """Fit by stochastic gradient descent; bags: a text's buckets and how often each occurs."""
    if not bags:
        return None
    languages = sorted(set(names))
    labels = np.array([languages.index(n) for n in names])
    random = np.random.default_rng(7)
    embeddings = random.uniform(-1, 1, (BUCKETS, DIMENSIONS)) / DIMENSIONS
    softmax = np.zeros((DIMENSIONS, len(languages)))
    order = random.permutation(len(bags))
    checks, fits = order[: len(bags) // 5], order[len(bags) // 5 :]
    steps, step = EPOCHS * len(fits), 0
    for _ in range(EPOCHS):
        for i in random.permutation(fits):
            rate = RATE * (1 - step / steps)
            step += 1
            buckets, times = bags[i]
            share = times / times.sum()
            mean = share @ embeddings[buckets]
            error = -_softmax(mean @ softmax)
            error[labels[i]] += 1
            pull = softmax @ error
            softmax += rate * np.outer(mean, error)
            # A subword's share of a long text is tiny: steps count it against the mean share.
            embeddings[buckets] += rate * np.minimum(share * len(buckets), 4)[:, None] * pull
    model = Model(languages, (embeddings @ softmax).T.astype(np.float32).copy(), 1.0, 0.0)
    checks = checks if len(checks) else fits
    buckets = np.concatenate([np.repeat(*bags[i]) for i in checks])
    firsts = np.concatenate([[0], np.cumsum([bags[i][1].sum() for i in checks])])
    logits = model.logits(buckets, firsts)
    own = labels[checks]
    rows = np.arange(len(checks))
    grid = np.geomspace(0.05, 20, 60)
    losses = [-np.log(np.maximum(_softmax(logits / t)[rows, own], 1e-12)).mean() for t in grid]
    model.temperature = float(grid[int(np.argmin(losses))])
    chances = model.probabilities(logits)
    right = chances.max(1)[chances.argmax(1) == own]
    model.least = float(np.quantile(right, rejected)) if len(right) else 1.0
    return model


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in bounded_slices(batches, "_text"):
        buckets, firsts, has = subwords(batch.column("_text"))
        for i in np.flatnonzero(has).tolist():
            own, times = np.unique(buckets[firsts[i] : firsts[i + 1]], return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_lang").slice(i, 1), list_array(own, np.array([0, len(own)])),
                 list_array(times.astype(np.int32), np.array([0, len(times)]))],
                ["_lang", "buckets", "times"],
            )


def fit(df: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang", rows: int = SAMPLE_ROWS) -> Model | None:
    """Fit on a bounded sample of the labelled rows."""
    labelled = df.select(
        F.col(id_col).alias("_id"), F.col(text).alias("_text"), F.col(lang).alias("_lang")
    ).filter("_lang is not null")
    counts = labelled.groupBy("_lang").count().orderBy(F.desc("count"), "_lang").limit(MOST_LANGUAGES).collect()
    if not counts:
        return None
    each = rows / len(counts)
    shares = F.create_map(*[F.lit(x) for r in counts for x in (r[0], min(1.0, each / r[1]))])
    place = F.pmod(F.xxhash64("_id"), F.lit(1 << 30)) / float(1 << 30)
    sample = labelled.filter(place < F.try_element_at(shares, F.col("_lang"))).limit(2 * rows)
    bags = sample.mapInArrow(_bags, "_lang string, buckets array<int>, times array<int>").toArrow()
    names = bags.column("_lang").to_pylist()
    pairs = [
        (np.asarray(a.values), np.asarray(b.values).astype(np.int64))
        for a, b in zip(bags.column("buckets"), bags.column("times"))
    ]
    order = sorted(range(len(names)), key=lambda i: (names[i], pairs[i][0].tolist()[:8], len(pairs[i][0]), i))
    return train([pairs[i] for i in order], [names[i] for i in order])


def predict(df: DataFrame, model: Model | None, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The id with `lang_pred`, its calibrated `score` and `rejected`."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = pa.array([*(model.languages if model else []), UNKNOWN])
        for batch in bounded_slices(batches, "_text", 1 << 20):
            buckets, firsts, has = subwords(batch.column("_text"))
            best, score = np.full(len(has), len(names) - 1), np.zeros(len(has))
            if model:
                chances = model.probabilities(model.logits(buckets, firsts))
                best = np.where(has, chances.argmax(1), best)
                score = np.where(has, chances.max(1), 0.0)
            low = score < model.least if model else ~has
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), names.take(pa.array(best)), pa.array(score), pa.array(low | ~has)],
                ["_id", "lang_pred", "score", "rejected"],
            )

    narrow = df.select(F.col(id_col).alias("_id"), F.col(text).alias("_text"))
    kind = narrow.schema["_id"].dataType.simpleString()
    out = narrow.mapInArrow(run, f"_id {kind}, lang_pred string, score double, rejected boolean")
    return out.withColumnRenamed("_id", id_col)
