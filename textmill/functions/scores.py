"""Score thresholds. All comparisons are strict and in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
REPORT_THRESHOLD = 0.40
CONFIDENT_THRESHOLD = 0.85


def decision(score: Column, threshold: float = REPORT_THRESHOLD) -> Column:
    """1.0 above the threshold, else 0.0."""
    return F.when(score > F.lit(float(threshold)), 1.0).otherwise(0.0)


def surely_toxic(score: Column, threshold: float = CONFIDENT_THRESHOLD) -> Column:
    return score > F.lit(float(threshold))


def surely_safe(score: Column, threshold: float = CONFIDENT_THRESHOLD) -> Column:
    return score < F.lit(1.0) - F.lit(float(threshold))
