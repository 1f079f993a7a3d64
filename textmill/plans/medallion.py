"""The whole job: clean, replicate, train and score, feed back, retain."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from textmill.operators.classify import (
    forest,
    logistic,
    predict_class,
    predict_score,
    save,
    train,
)
from textmill.operators.clean import clean_comments, clean_posts, training_rows
from textmill.operators.feedback import confident_feedback, sampled_positives
from textmill.operators.replicate import replicate
from textmill.operators.retention import RETENTION_DAYS, retain
from textmill.session import sized_shuffles
from textmill.sinks.ledger import append_once, read_training
from textmill.sinks.publish import publish
from textmill.sources.json_files import whole_records
from textmill.sources.tables import require_table

_LOG = logging.getLogger(__name__)

# Copies of each cleaned table.
COMMENT_COPIES = 5
POST_COPIES = 3
# The tables the job leaves. Their names must match.
TABLES = (
    "silver_posts",
    "silver_comments",
    "gold_synthetic_posts",
    "gold_synthetic_comments",
    "gold_toxic_predictions",
    "gold_rf_predictions",
)


@dataclass
class Medallion:
    """Runs the stages in order against one warehouse folder.

    `training` is a Parquet folder of `text, is_destructive, origin, run`; feedback
    is appended to it, once for a `run_id` (the day if not given): running the
    same run again, after a failure or not, learns from the same rows and
    leaves the same ones. Table names start with `prefix`.
    """

    spark: SparkSession
    root: str
    training: str
    as_of: str
    days: int = RETENTION_DAYS
    prefix: str = ""
    run_id: str | None = None
    report: list[tuple[str, str, int | None]] = field(default_factory=list)
    broken: dict[str, int] = field(default_factory=dict)

    def name(self, table: str) -> str:
        return self.prefix + table

    def table(self, table: str) -> DataFrame:
        return require_table(self.spark, self.name(table))

    def _publish(self, df: DataFrame, table: str, partition_by: tuple[str, ...] = ()) -> int:
        return publish(df, self.name(table), self.root, partition_by)

    # --- stages -------------------------------------------------------------

    def clean(self, raw_posts: DataFrame, raw_comments: DataFrame) -> int:
        """Cleaned tables, partitioned by day so that retention prunes folders.

        Broken files among marked raw frames are counted on the way.
        """
        with whole_records(raw_posts) as (records, broken):
            posts = self._publish(clean_posts(records, day="day"), "silver_posts", ("day",))
            self.broken["raw posts"] = broken()
        with whole_records(raw_comments) as (records, broken):
            comments = self._publish(clean_comments(records, day="day"), "silver_comments", ("day",))
            self.broken["raw comments"] = broken()
        return posts + comments

    def replicate(self) -> int:
        comments = replicate(self.table("silver_comments").drop("day"), COMMENT_COPIES, shift="range")
        posts = replicate(self.table("silver_posts").drop("day"), POST_COPIES, shift="range")
        return self._publish(comments, "gold_synthetic_comments") + self._publish(
            posts, "gold_synthetic_posts"
        )

    def _known(self, *own: str) -> DataFrame:
        """The training rows as they were before this run added its own of these origins."""
        return read_training(self.spark, self.training, (self.run_id or self.as_of, own))

    def _feed(self, rows: DataFrame, origin: str) -> None:
        """Rows for the training set, once a run."""
        append_once(rows, self.training, origin, self.run_id or self.as_of)

    def _fit(self, stages, *own: str) -> PipelineModel:
        return train(stages, training_rows(self._known(*own)))

    def class_model(self) -> int:
        """Logistic regression over the replicated comments; a sample feeds back.

        Scores are written once and read back for the feedback.
        """
        model = self._fit(logistic(), "logistic", "forest")
        save(model, f"{self.root}/models/logistic")
        scored = predict_class(model, self.table("gold_synthetic_comments"))
        rows = self._publish(scored, "gold_toxic_predictions")
        if rows:
            # Another day draws another sample.
            seed = int(self.as_of.replace("-", ""))
            fed = sampled_positives(self.table("gold_toxic_predictions"), seed=seed)
            self._feed(fed, "logistic")
        return rows

    def score_model(self) -> int:
        """Random forest over the cleaned comments; confident new texts feed back."""
        model = self._fit(forest(), "forest")
        save(model, f"{self.root}/models/forest")
        scored = predict_score(model, self.table("silver_comments"))
        rows = self._publish(scored, "gold_rf_predictions")
        if rows:
            # The files are listed here, before the append adds to them.
            fed = confident_feedback(self.table("gold_rf_predictions"), self._known("forest").select("text"))
            self._feed(fed, "forest")
        return rows

    def retain(self) -> int:
        kept = retain(
            self.spark, self.name("silver_comments"), self.as_of, self.root, self.days, "day"
        )
        return kept.rows_kept

    # --- order and gating ----------------------------------------------------

    def _stage(self, name: str, work: Callable[[], int], run: bool = True) -> bool:
        if not run:
            self.report.append((name, "SKIPPED", None))
            return False
        try:
            self.report.append((name, "OK", work()))
            return True
        except Exception as error:  # a stage's failure decides what follows, and is reported
            _LOG.exception("stage %s failed", name)
            self.report.append((name, f"FAILED: {type(error).__name__}: {error}", None))
            return False

    def run(self, raw_posts: DataFrame, raw_comments: DataFrame, size: int = 0) -> DataFrame:
        """`stage, status, rows`. Nothing runs on uncleaned tables; retention
        runs even if scoring fails. `size`: bytes of the raw files, for the shuffles."""
        with sized_shuffles(self.spark, size):
            cleaned = self._stage("clean", lambda: self.clean(raw_posts, raw_comments))
            self.report += [(name, "BROKEN FILES", n) for name, n in self.broken.items() if n]
            copied = self._stage("replicate", self.replicate, cleaned)
            self._stage("class_model", self.class_model, copied)
            self._stage("score_model", self.score_model, cleaned)
            self._stage("retain", self.retain, cleaned)
        return self.spark.createDataFrame(self.report, "stage string, status string, rows bigint")
