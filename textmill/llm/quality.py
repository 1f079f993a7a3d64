"""Document quality from the text and from the site it comes from.

A logistic regression on counts of character classes and words gives each
document's own evidence. Sites form a hierarchy of keys (by default source, then
source and language; for pages host, then host and path). Each node's rate of
good documents is the mean evidence of its documents, shrunk towards its
parent's rate, the first level's towards the global mean. How strongly is
estimated from the data (empirical Bayes): nodes that differ little, or hold
few documents, follow their parent. A document is left out of its own nodes'
rates, so its evidence counts once. Its score adds the log odds of its node's
rate, over those of the global mean, to the log odds of its evidence.

The regression is fitted on at most `rows` labelled documents. The bar for
rejection is 0.5, or lower if more than `lost` of the labelled good documents
would go. Rates cover all documents; only sums by node are shuffled.

Defined cases: null and empty texts have all counts 0; null keys are a node of
their own; labels that differ for an id are averaged; without both labels all
documents are kept with score 1; rows that repeat are scored each.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.buffers import (
    SPACE_SEPARATED,
    bounded_slices,
    list_array,
    lower_bytes,
    text_buffer,
    word_hashes,
    word_spans,
)
from textmill.session import stage

SAMPLE_ROWS = 20_000
BAR, LOST = 0.5, 0.005
# Bounds of the prior's strength, in documents.
WEAKEST, STRONGEST = 2.0, 1e6

_CLASSES = {
    "upper": [*range(65, 91)],
    "lower": [*range(97, 123), *range(128, 256)],
    "digit": [*range(48, 58)],
    "stop": [33, 44, 46, 58, 59, 63],
    "bar": [124],
    "mark": [33],
    "other": [*range(34, 44), 45, 47, *range(60, 63), 64, *range(91, 97), 123, 124, 125, 126],
    "line": [10],
}


def features(column: pa.Array) -> np.ndarray:
    """Shares of character classes and measures of words [text, feature]."""
    data, rows = text_buffer(column)
    sizes = np.diff(rows)
    share = np.maximum(sizes, 1)

    def total(flags: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(flags)])[rows])

    counts = {}
    for name, codes in _CLASSES.items():
        table = np.zeros(256, bool)
        table[codes] = True
        counts[name] = total(table[data])
    low = lower_bytes(data)
    starts, ends, firsts = word_spans(low, rows, SPACE_SEPARATED)
    words = np.diff(firsts)
    some = np.maximum(words, 1)
    hashes = word_hashes(low, starts, ends)
    owner = np.repeat(np.arange(len(words)), words)
    order = np.lexsort((hashes, owner))
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[order][1:] != hashes[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    distinct = np.bincount(owner[order][fresh], minlength=len(words))
    lengths = np.add.reduceat(np.append(ends - starts, 0), np.minimum(firsts[:-1], len(starts))) * (words > 0)
    letters = np.maximum(counts["upper"] + counts["lower"], 1)
    return np.stack([
        counts["upper"] / letters, counts["digit"] / share, counts["stop"] / share, counts["bar"] / some,
        counts["mark"] / some, counts["other"] / share, counts["line"] / some, lengths / some / 10,
        distinct / some, np.log1p(words) / 10, (distinct / some) * np.log1p(words) / 10,
    ], axis=1)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in bounded_slices(batches, "_text"):
        found = features(batch.column("_text"))
        bounds = np.arange(len(found) + 1) * found.shape[1]
        kept = [n for n in batch.schema.names if n != "_text"]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(n) for n in kept], list_array(found.reshape(-1), bounds)], [*kept, "features"]
        )


def fit(values: np.ndarray, labels: np.ndarray, rounds: int = 25, ridge: float = 1.0) -> np.ndarray | None:
    """Weights of a logistic regression, the constant last, by Newton's method; None without both labels."""
    if not len(labels) or labels.max() <= 0 or labels.min() >= 1:
        return None
    mean, spread = values.mean(0), values.std(0) + 1e-9
    design = np.hstack([(values - mean) / spread, np.ones((len(values), 1))])
    weights, penalty = np.zeros(design.shape[1]), np.full(design.shape[1], ridge)
    penalty[-1] = 0
    for _ in range(rounds):
        chance = 1 / (1 + np.exp(-np.clip(design @ weights, -30, 30)))
        slope = design.T @ (labels - chance) - penalty * weights
        curve = (design * (chance * (1 - chance) + 1e-9)[:, None]).T @ design + np.diag(penalty)
        weights = weights + np.linalg.solve(curve, slope)
    raw = weights[:-1] / spread
    return np.append(raw, weights[-1] - raw @ mean)


def _key(columns: Sequence[str]) -> F.Column:
    """Nodes as text; null differs from any value."""
    return F.to_json(F.struct(*[F.col(c).cast("string").alias(f"k{i}") for i, c in enumerate(columns)]))


def prior_strength(nodes: DataFrame, mean: float) -> float:
    """How many documents a parent's rate is worth, by moments of the nodes' means.

    `nodes` has n, total and squares (sums of evidence and of its square).
    """
    within = F.greatest(F.col("squares") / F.col("n") - F.pow(F.col("total") / F.col("n"), 2), F.lit(0.0))
    apart = F.pow(F.col("total") / F.col("n") - mean, 2)
    row = nodes.agg(
        F.sum(F.col("n") * apart).alias("apart"), F.sum(within).alias("chance"), F.sum("n").alias("n"),
        F.sum(within * F.col("n")).alias("within"),
    ).first()
    if not row["n"]:
        return STRONGEST
    between = max((row["apart"] - row["chance"]) / row["n"], 0.0)
    spread = row["within"] / row["n"]
    return float(np.clip(spread / between if between > 0 else STRONGEST, WEAKEST, STRONGEST))


def combine(evidence: DataFrame, levels: Sequence[str]) -> tuple[DataFrame, float]:
    """`evidence` (with `p` and a node key `_level1`, `_level2`... for each level) with each level's rate.

    A document's rates leave out its own evidence.
    """
    total = evidence.agg(F.avg("p").alias("mean")).first()["mean"]
    mean = min(max(total if total is not None else 0.5, 1e-6), 1 - 1e-6)
    out, parent = evidence, F.lit(mean)
    for number in range(1, len(levels) + 1):
        key, rate = f"_level{number}", f"rate{number}"
        sums = evidence.groupBy(key).agg(
            F.count("*").alias("n"), F.sum("p").alias("total"), F.sum(F.col("p") * F.col("p")).alias("squares")
        )
        sums = stage(sums, "quality-nodes")
        strength = prior_strength(sums, mean)
        out = out.join(sums.drop("squares"), key)
        out = out.withColumn(
            rate, (F.col("total") - F.col("p") + strength * parent) / (F.col("n") - 1 + strength)
        ).drop("n", "total")
        parent = F.col(rate)
    return out, mean


def _log_odds(p: F.Column) -> F.Column:
    safe = F.greatest(F.least(p, F.lit(1 - 1e-9)), F.lit(1e-9))
    return F.log(safe / (1 - safe))


def classify(
    docs: DataFrame, labels: DataFrame, levels: Sequence[str] = ("source", "lang"), id_col: str = "doc_id",
    text: str = "text", label: str = "quality", rows: int = SAMPLE_ROWS, lost: float = LOST,
) -> DataFrame:
    """The id with its evidence, the rates of its nodes (rate1, rate2...), score and kept."""
    keys = [_key(levels[: i + 1]).alias(f"_level{i + 1}") for i in range(len(levels))]
    narrow = docs.select(F.col(id_col).alias("_id"), *keys, F.col(text).alias("_text"))
    kind = narrow.schema["_id"].dataType.simpleString()
    names = ", ".join(f"_level{i + 1} string" for i in range(len(levels)))
    measured = stage(
        narrow.mapInArrow(_features, f"_id {kind}, {names}, features array<double>"), "quality-features"
    )
    wanted = labels.filter(F.col(label).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.avg(label).alias("_y"))
    labelled = measured.select("_id", "features").dropDuplicates(["_id"]).join(wanted, "_id")
    share = rows / max(wanted.count(), 1)
    if share < 1:
        labelled = labelled.filter(F.pmod(F.xxhash64("_id"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))
    sample = labelled.orderBy(F.xxhash64("_id"), "_id").limit(rows).toArrow()
    values = np.array(sample.column("features").to_pylist(), float)
    weights = fit(values, sample.column("_y").to_numpy()) if len(values) else None
    if weights is None:
        none = F.lit(1.0)
        rates = [none.alias(f"rate{i + 1}") for i in range(len(levels))]
        return measured.select(
            F.col("_id").alias(id_col), none.alias("evidence"), *rates, none.alias("score"), F.lit(True).alias("kept")
        )
    constants = F.array(*[F.lit(float(w)) for w in weights[:-1]])
    logit = F.aggregate(
        F.zip_with("features", constants, lambda x, w: x * w), F.lit(float(weights[-1])), lambda a, x: a + x
    )
    evidence = measured.select(
        "_id", *[f"_level{i + 1}" for i in range(len(levels))], (1 / (1 + F.exp(-logit))).alias("p")
    )
    rated, mean = combine(stage(evidence, "quality-evidence"), levels)
    shift = _log_odds(F.col(f"rate{len(levels)}")) - _log_odds(F.lit(mean)) if levels else F.lit(0.0)
    score = 1 / (1 + F.exp(-(_log_odds(F.col("p")) + shift)))
    scored = stage(rated.withColumn("score", score), "quality-scores")
    good = scored.select("_id", "score").join(wanted.filter("_y > 0.5"), "_id")
    low = good.agg(F.percentile_approx("score", lost, 10_000).alias("low")).first()["low"]
    bar = min(BAR, low) if low is not None else BAR
    return scored.select(
        F.col("_id").alias(id_col), F.col("p").alias("evidence"), *[f"rate{i + 1}" for i in range(len(levels))],
        "score", (F.col("score") >= bar).alias("kept"),
    )
