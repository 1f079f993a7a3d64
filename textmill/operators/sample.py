"""Key-based samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.functions.sampling import in_sample

# Fixed values.
TRAINING_FRACTIONS = (0.1, 0.3, 0.5, 0.7, 1.0)


def sample_by_key(df: DataFrame, key: str, fraction: float, seed: int = 42) -> DataFrame:
    """A repeatable sample; smaller fractions are contained in larger ones."""
    return df.filter(in_sample(F.col(key), fraction, seed))


def sample_sizes(
    df: DataFrame, key: str, fractions: Sequence[float] = TRAINING_FRACTIONS, seed: int = 42
) -> DataFrame:
    """`fraction, rows` for nested samples, counted in one pass."""
    counts = df.agg(
        *(F.count_if(in_sample(F.col(key), f, seed)).alias(f"f{i}") for i, f in enumerate(fractions))
    )
    sizes = F.array(
        *(
            F.struct(F.lit(float(f)).alias("fraction"), F.col(f"f{i}").alias("rows"))
            for i, f in enumerate(fractions)
        )
    )
    return counts.select(F.inline(sizes))
