"""Run the jobs: `spark-submit --py-files ... -m textmill`, or `python -m textmill <command>`.

run        clean, replicate, train, score, feed back, retain; then a health report
cycle      clean and score only the raw files that are new
training   add CSV files or label lines to the training table
words      the top words of flagged messages
health     existence and row counts of tables, with samples if asked for
training-times, scoring-times
           how training and scoring times grow with the rows
"""

from __future__ import annotations

import argparse
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.functions.stopwords import REPORT_STOP_WORDS
from textmill.operators.classify import load
from textmill.operators.clean import training_rows
from textmill.operators.health import health, sample_rows
from textmill.operators.words import flagged, frequent_stripped
from textmill.plans.cycle import (
    broken_raw_files,
    clean_new_comments,
    clean_new_posts,
    current_scores,
    score_new_comments,
)
from textmill.plans.medallion import TABLES, Medallion
from textmill.plans.scalability import SCORING_ROWS, scoring_times, training_times
from textmill.schemas import RAW_COMMENTS, RAW_POSTS
from textmill.session import file_bytes, session, sized_shuffles
from textmill.sinks.files import append_training
from textmill.sinks.ledger import append_once, read_training
from textmill.sources.json_files import read_marked_arrays
from textmill.sources.label_lines import read_label_lines
from textmill.sources.raw_files import modified_after, raw_file_ages
from textmill.sources.training_csv import malformed_records, read_training_csv


def _run(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    job = Medallion(spark, args.root, args.training, args.as_of, args.days, run_id=args.run_id)
    fresh = _fresh(args)
    report = job.run(
        read_marked_arrays(spark, args.posts, RAW_POSTS, **fresh),
        read_marked_arrays(spark, args.comments, RAW_COMMENTS, **fresh),
        file_bytes(spark, args.posts, args.comments),
    )
    old = _left_out(spark, args)
    tables = health(spark, TABLES).select(
        F.col("table").alias("stage"), "status", F.col("rows").alias("rows")
    )
    return report.union(old).unionByName(tables)


def _fresh(args: argparse.Namespace) -> dict[str, str]:
    """Reader options for the raw files that are not too old."""
    return modified_after(_now(args), args.raw_days) if args.raw_days is not None else {}


def _now(args: argparse.Namespace) -> datetime:
    return datetime.fromisoformat(args.raw_as_of).astimezone(UTC) if args.raw_as_of else datetime.now(UTC)


def _left_out(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """`stage, status, rows`: how many raw files are too old to be read."""
    report = "stage string, status string, rows bigint"
    if args.raw_days is None:
        return spark.createDataFrame([], report)
    old = [
        (name, "OLD FILES", raw_file_ages(spark, path, _now(args), args.raw_days).filter("not keep").count())
        for name, path in (("raw posts", args.posts), ("raw comments", args.comments))
    ]
    return spark.createDataFrame([row for row in old if row[2]], report)


def _cycle(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    fresh = _fresh(args)
    with sized_shuffles(spark, file_bytes(spark, args.posts, args.comments)):
        clean_new_posts(spark, args.posts, args.root, **fresh)
        clean_new_comments(spark, args.comments, args.root, **fresh)
        score_new_comments(spark, load(args.model), args.root)
    for row in broken_raw_files(spark, args.root).groupBy("kind").count().collect():
        print(f"{row['count']} broken files of {row['kind']} set aside")
    for row in _left_out(spark, args).collect():
        print(f"{row['rows']} files of {row['stage']} too old")
    return current_scores(spark, args.root).groupBy("is_toxic_pred").count()


def _training(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.csv:
        rows = training_rows(read_training_csv(spark, args.csv))
        rows = rows.select("text", F.col("label").cast("int").alias("is_destructive"))
        if malformed := malformed_records(spark, args.csv).count():
            print(f"{malformed} malformed records left out")
    else:
        rows = read_label_lines(spark, args.label_lines)
    if args.run_id:
        append_once(rows, args.training, "base", args.run_id)
    else:
        append_training(rows, args.training, "base")
    return spark.read.parquet(args.training).groupBy("origin", "is_destructive").count()


def _words(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    predictions = flagged(spark.read.parquet(args.predictions))
    return frequent_stripped(predictions, args.text, REPORT_STOP_WORDS, args.k)


def _health(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    report = health(spark, args.tables or None)
    if args.samples:
        for row in report.filter("status = 'OK'").toLocalIterator():
            rows = spark.table(row["table"])
            order = args.order if args.order in rows.columns else rows.columns[0]
            print(f"--- {row['table']}")
            print(*rows.columns, sep="\t")
            for found in sample_rows(rows, order, args.samples).collect():
                print(*found, sep="\t")
    return report


def _training_times(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    rows = training_rows(read_training(spark, args.training))
    return training_times(rows.withColumn("key", F.md5(F.col("text").cast("binary"))), "key")


def _scoring_times(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    return scoring_times(spark, load(args.model), args.messages, args.rows, args.id)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="textmill", description=__doc__,
                                  formatter_class=argparse.RawDescriptionHelpFormatter)
    commands = top.add_subparsers(required=True)

    def command(name, work, *required):
        sub = commands.add_parser(name)
        for option in required:
            sub.add_argument(f"--{option}", required=True)
        sub.set_defaults(work=work)
        return sub

    run = command("run", _run, "posts", "comments", "root", "training")
    run.add_argument("--as-of", default=datetime.now(UTC).strftime("%Y-%m-%d"))
    run.add_argument("--days", type=int, default=7)
    cycle = command("cycle", _cycle, "posts", "comments", "root", "model")
    for sub in (run, cycle):
        sub.add_argument("--raw-days", type=int, help="leave out raw files that were not modified for so many days")
        sub.add_argument("--raw-as-of", help="the moment that raw files' ages count from, if not now")
    load_training = command("training", _training, "training")
    for sub in (run, load_training):
        sub.add_argument("--run-id", help="rows enter the training table once for a run")
    source = load_training.add_mutually_exclusive_group(required=True)
    source.add_argument("--csv")
    source.add_argument("--label-lines")
    words = command("words", _words, "predictions")
    words.add_argument("--text", default="original_content")
    words.add_argument("-k", type=int, default=15)
    tables = command("health", _health)
    tables.add_argument("tables", nargs="*")
    tables.add_argument("--samples", type=int, default=0, help="print so many rows of each table")
    tables.add_argument("--order", default="id", help="the column that picks them, if a table has it")
    command("training-times", _training_times, "training")
    scoring = command("scoring-times", _scoring_times, "model", "messages")
    scoring.add_argument("--rows", type=int, default=SCORING_ROWS)
    scoring.add_argument("--id", default="id")
    return top


def main(arguments: list[str] | None = None) -> DataFrame:
    args = parser().parse_args(arguments)
    spark = session("textmill")
    report = args.work(spark, args)
    inputs = [getattr(args, name) for name in ("predictions", "root") if getattr(args, name, None)]
    with sized_shuffles(spark, file_bytes(spark, *inputs) if inputs else 0):
        print(*report.columns, sep="\t")
        for row in report.toLocalIterator():
            print(*row, sep="\t")
    return report


if __name__ == "__main__":
    main()
