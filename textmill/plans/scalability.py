"""How training and scoring times grow with the number of rows."""

from __future__ import annotations

import math
import time
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from textmill.operators.classify import fitted, logistic, predict_class, prepared
from textmill.operators.replicate import grow_to, take_exact
from textmill.operators.sample import TRAINING_FRACTIONS, sample_by_key
from textmill.session import cached, staging_path
from textmill.sinks.files import discard

# Fixed values.
BENCH_FEATURES = 2000
SCORING_FRACTIONS = (0.2, 0.4, 0.6, 0.8, 1.0)
SCORING_ROWS = 2_500_000
# Files of the grown table: so many for a core in its smallest part, and of so many rows at most.
_FILES, _FILE_ROWS = 4, 20_000

_TIMES = "rows bigint, time_sec double, rows_per_sec double"


def training_times(
    training: DataFrame, key: str, fractions: Sequence[float] = TRAINING_FRACTIONS
) -> DataFrame:
    """`rows, time_sec, rows_per_sec` of a fit on nested samples of `key, text, label`.

    Samples are taken, spread and kept before the clock starts.
    """
    results = []
    with cached(training) as rows:
        for fraction in fractions:
            with prepared(sample_by_key(rows, key, fraction)) as part:
                count = part.count()
                start = time.perf_counter()
                fitted(logistic(BENCH_FEATURES), part)
                seconds = time.perf_counter() - start
            results.append((count, seconds, count / seconds))
    return training.sparkSession.createDataFrame(results, _TIMES)


def scoring_times(
    spark: SparkSession,
    model: PipelineModel,
    messages: str,
    rows: int = SCORING_ROWS,
    id_col: str = "id",
    fractions: Sequence[float] = SCORING_FRACTIONS,
) -> DataFrame:
    """`rows, time_sec, rows_per_sec` of scoring parts of a stored table grown to a number of rows.

    The grown table is written once, in so many files that each part, an exact
    cut of them, has work for all cores.
    """
    grown = staging_path(spark, "scoring")
    files = max(math.ceil(spark.sparkContext.defaultParallelism * _FILES / min(fractions)), rows // _FILE_ROWS)
    grow_to(spark, messages, rows).select(id_col, "text").repartition(files, id_col).write.parquet(grown)
    results = []
    for fraction in fractions:
        count = int(rows * fraction)
        part = take_exact(spark, grown, count)
        start = time.perf_counter()
        discard(predict_class(model, part, id_col))
        seconds = time.perf_counter() - start
        results.append((count, seconds, count / seconds))
    return spark.createDataFrame(results, _TIMES)
