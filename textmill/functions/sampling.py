"""Seeded sampling that depends only on the key of a row."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column
from pyspark.sql import functions as F

_STEPS = 16**32


def sample_bound(fraction: float) -> str:
    """The 32 hex digits below which a key's digest falls with the given probability."""
    if not 0.0 <= fraction < 1.0:
        raise ValueError("fraction must lie in [0, 1)")
    return format(int(Fraction(fraction) * _STEPS), "032x")


def in_sample(key: Column, fraction: float, seed: int = 42) -> Column:
    """Whether the row belongs to the sample.

    The digest is compared with a bound, so a smaller sample of the same seed
    lies inside a larger one, and a re-run picks the same rows.
    """
    if fraction >= 1.0:
        return F.lit(True)
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")).cast("binary"))
    return digest < sample_bound(fraction)
