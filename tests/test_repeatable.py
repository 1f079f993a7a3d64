"""Jobs that are run again, state that is kept step by step, files that are set aside."""

import json
import os
import random
from datetime import UTC, datetime, timedelta

import pytest
from conftest import final_plan, plan
from pyspark.sql import functions as F

from textmill.__main__ import main
from textmill.operators.clean import clean_comments
from textmill.operators.dedup import latest_by_key
from textmill.plans.cycle import broken_raw_files, clean_new_comments, clean_new_posts, current_comments, current_posts
from textmill.plans.medallion import Medallion
from textmill.schemas import POST_VERSIONS, RAW_COMMENTS, RAW_POSTS
from textmill.sinks import ledger as ledgers
from textmill.sinks.files import append_training, counted
from textmill.sinks.ledger import append_once, ledger, read_training
from textmill.sources.json_files import read_json_arrays, read_marked_arrays, whole_records
from textmill.streaming.state import Newest

FED = [("rude", 1), ("rude", 1), ("vile", 1), (None, 1)]
LABELLED = "text string, is_destructive int"


def stored(spark, path, run=None):
    rows = read_training(spark, path)
    rows = rows if run is None else rows.filter(F.col("run") == run)
    return sorted(((r.text, r.is_destructive, r.origin, r.run) for r in rows.collect()), key=str)


# --- the ledger --------------------------------------------------------------------


def test_append_counts_once_for_a_run(spark, rows, tmp_path):
    path = str(tmp_path / "training")
    append_training(rows([("calm", 0)], LABELLED), path, "base")
    assert append_once(rows(FED, LABELLED), path, "logistic", "one") == 4
    once = stored(spark, path)
    assert append_once(rows(FED, LABELLED), path, "logistic", "one") == 0
    assert stored(spark, path) == once and ("calm", 0, "base", None) in once
    assert append_once(rows(FED, LABELLED), path, "forest", "one") == 4
    assert append_once(rows(FED, LABELLED), path, "logistic", "two") == 4
    assert append_once(rows([], LABELLED), path, "logistic", "three") == 0
    done = {(r.run, r.origin): r.rows for r in ledger(spark, path).collect()}
    assert done == {("one", "logistic"): 4, ("one", "forest"): 4, ("two", "logistic"): 4, ("three", "logistic"): 0}
    # The ledger is no part of the table.
    assert spark.read.parquet(path).count() == 13


def test_append_goes_on_after_a_failure_half_way(spark, rows, tmp_path, monkeypatch):
    """Some files of an append are there, its entry in the ledger is not."""
    path = str(tmp_path / "training")
    append_training(rows([("calm", 0)], LABELLED), path, "base")
    half = rows(FED[1:3], LABELLED).select("*", F.lit("logistic").alias("origin"), F.lit("one").alias("run"))
    half.write.mode("append").parquet(path)
    assert append_once(rows(FED, LABELLED), path, "logistic", "one") == 2
    assert sorted((t for t, *_ in stored(spark, path, "one")), key=str) == [None, "rude", "rude", "vile"]

    # All rows were written, and the job ended before the entry.
    monkeypatch.setattr(ledgers, "_ledger_path", lambda path: "file:///proc/none")
    with pytest.raises(Exception):
        append_once(rows(FED, LABELLED), path, "logistic", "two")
    monkeypatch.undo()
    assert append_once(rows(FED, LABELLED), path, "logistic", "two") == 0
    assert len(stored(spark, path, "two")) == 4


def test_running_the_job_twice_leaves_the_same_training_rows(spark, tmp_path):
    path = str(tmp_path / "training")
    data = [(f"you trash {i}", 1) for i in range(20)] + [(f"a lovely day {i}", 0) for i in range(20)]
    append_training(spark.createDataFrame(data, LABELLED), path, "base")
    posts = spark.createDataFrame([(1, -5, None, None, "2024-01-15", 1, "hello", 1, 0)], RAW_POSTS)
    comment = lambda i: (i, None, 1, -5, None, f"{'you trash' if i % 2 else 'a lovely day'} x{i}", 1, "a", "2024-01-15", 1, 0, False)
    comments = spark.createDataFrame([comment(i) for i in range(60)], RAW_COMMENTS)
    found = []
    for run in ("one", "one", "two"):
        job = Medallion(spark, str(tmp_path / "w"), path, "2024-01-20", prefix="again_", run_id=run)
        assert {r.status for r in job.run(posts, comments).collect()} == {"OK"}
        found.append(stored(spark, path))
    assert found[0] == found[1] and len(found[0]) > 40
    assert len(found[2]) > len(found[1])


# --- counts on the way -------------------------------------------------------------


def test_counts_need_no_second_read(spark, rows, tmp_path):
    for number, df in enumerate([rows([(i,) for i in range(70)], "id int"), rows([], "id int")]):
        with counted(df.repartition(3)) as (passing, count):
            passing.write.parquet(str(tmp_path / f"out{number}"))
        assert count() == (70, 0)[number]
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "a.json").write_text('[{"id": 1, "text": "a"}, {"id": 2}]')
    (tmp_path / "raw" / "b.json").write_text('[{"id": 3, "te')
    with whole_records(read_marked_arrays(spark, str(tmp_path / "raw"), RAW_POSTS)) as (records, broken):
        assert sorted(r.id for r in records.collect()) == [1, 2]
        assert broken() == 1
    with whole_records(records) as (same, none):
        assert same is records and none() == 0


def test_models_go_to_tasks_after_rows_were_observed(spark, rows):
    """A fitted model must not carry the session along."""
    from textmill.operators.classify import forest, logistic, predict_class, train

    with counted(rows([(1,)], "id int")) as (passing, count):
        passing.collect()
    assert count() == 1
    labelled = rows([(i, ("bad", "good")[i % 2], float(i % 2)) for i in range(20)], "id int, text string, label double")
    for stages in (logistic(), forest(trees=2, depth=2)):
        assert predict_class(train(stages, labelled), labelled).count() == 20


# --- retention of dated rows, raw files' ages ----------------------------------------


def test_rows_without_a_date_keep_the_day_of_their_time(spark, tmp_path):
    """Of the day before: one dated, one with epoch seconds alone; and one with neither."""
    seconds = int(datetime(2024, 1, 19, 12, tzinfo=UTC).timestamp())
    comment = lambda i, date, ts: (i, None, 1, -5, None, "text", 1, "ann", date, ts, 0, False)
    comments = spark.createDataFrame(
        [comment(1, "2024-01-19", 1), comment(2, None, seconds), comment(3, "soon", seconds), comment(4, None, None)],
        RAW_COMMENTS,
    )
    job = Medallion(spark, str(tmp_path), str(tmp_path / "none"), "2024-01-20", prefix="dated_")
    job.clean(spark.createDataFrame([], RAW_POSTS), comments)
    assert job.retain() == 3
    assert {r.id: r.day for r in spark.table("dated_silver_comments").collect()} == dict.fromkeys((1, 2, 3), "2024-01-19")
    assert clean_comments(comments).columns == ["id", "post_id", "chat_id", "author_name", "date", "text"]


def post(number, text, ts=1, date="2024-01-01"):
    return {"channel_id": -5, "post_id": number, "date": date, "ts": ts, "text": text, "views": 1, "replies_count": 0}


def write(folder, name, content):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(content if isinstance(content, str) else json.dumps(content))
    return str(folder)


def test_old_raw_files_are_left_out(spark, tmp_path, capsys):
    now = datetime(2024, 1, 20, 12, tzinfo=UTC)
    for kind in ("posts", "comments"):
        key = "post_id" if kind == "posts" else "comment_id"
        for number, days in enumerate((1, 30)):
            write(tmp_path / kind, f"{number}.json", [{**post(number, "hi"), key: number}])
            stamp = (now - timedelta(days=days)).timestamp()
            os.utime(tmp_path / kind / f"{number}.json", (stamp, stamp))
    write(tmp_path / "posts", "cut.json", '[{"post_id": 5, "te')
    paths = ["--posts", str(tmp_path / "posts"), "--comments", str(tmp_path / "comments"), "--root", str(tmp_path / "w")]
    ages = ["--raw-days", "7", "--raw-as-of", now.isoformat()]
    report = main(["run", *paths, *ages, "--training", str(tmp_path / "none"), "--as-of", "2024-01-20"])
    found = {(r.stage, r.status): r.rows for r in report.collect()}
    assert found["clean", "OK"] == 2 and found["raw posts", "OLD FILES"] == found["raw comments", "OLD FILES"] == 1
    assert found["raw posts", "BROKEN FILES"] == 1 and ("raw comments", "BROKEN FILES") not in found


# --- state -------------------------------------------------------------------------


def test_state_equals_the_batch_rule_whatever_the_steps(spark, tmp_path):
    pick = random.Random(6)
    make = lambda n: (pick.randrange(30), pick.choice([-5, -6, None]), "2024-01-01", f"t{n}", n % 3, pick.randrange(9), f"v{n}", "d")
    data = [make(n) for n in range(300)]
    keys, recency = ("chat_id", "id"), ("ts", "views", "date", "text")
    state = Newest(spark, str(tmp_path / "s"), POST_VERSIONS, keys, recency, buckets=4)
    assert state.read().collect() == [] and state.superseded().collect() == []
    at = 0
    for size in (150, 5, 5, 60, 1, 79):
        step = spark.createDataFrame(data[at : at + size], POST_VERSIONS)
        at += size
        state.add(step)
        if size == 5:
            state.add(step)  # a step that comes twice
        whole = latest_by_key(spark.createDataFrame(data[:at], POST_VERSIONS), keys, recency)
        assert sorted(state.read().collect(), key=str) == sorted(whole.collect(), key=str)
    folders = {r.folder for r in state.superseded().collect()}
    live = {(r.epoch, r.bucket, r.base) for r in state.live().collect()}
    assert folders and all(os.path.isdir(f) for f in folders)
    assert len(live) + len(folders) == state.epochs().count()


def test_reading_a_compacted_state_moves_nothing(spark, tmp_path):
    rows = spark.range(2000).select(
        "id", F.lit(-5).cast("bigint").alias("chat_id"), F.lit("2024-01-01").alias("date"), F.lit("t").alias("text"),
        F.lit(1).cast("bigint").alias("views"), F.lit(1).cast("bigint").alias("ts"), F.lit("v").alias("version"), F.lit("d").alias("day"),
    )
    state = Newest(spark, str(tmp_path / "s"), POST_VERSIONS, ("chat_id", "id"), ("ts", "text"), buckets=4)
    state.add(rows)
    assert "Exchange" not in plan(state.read())
    state.add(rows.filter("id < 20").withColumn("ts", F.lit(2).cast("bigint")))
    assert {r.base for r in state.live().collect()} == {True, False}
    text = final_plan(state.read())
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text  # 2,000 base rows stay where they are
    found = state.read().groupBy("ts").count().collect()
    assert {r.ts: r["count"] for r in found} == {1: 1980, 2: 20}


def test_an_interrupted_step_is_not_read(spark, tmp_path, monkeypatch):
    row = lambda ts: spark.createDataFrame([(1, -5, "d", "t", 1, ts, "v", "d")], POST_VERSIONS)
    state = Newest(spark, str(tmp_path / "s"), POST_VERSIONS, ("chat_id", "id"), ("ts",), buckets=2)
    state.add(row(1))
    number = state.epochs().agg(F.max("epoch")).first()[0] + 1
    row(9).withColumn("_bucket", F.lit(0)).write.partitionBy("_bucket").parquet(f"{state.path}/delta-{number}")
    assert [r.ts for r in state.read().collect()] == [1]
    state.add(row(2))
    assert [r.ts for r in state.read().collect()] == [2]


def test_broken_files_are_set_aside(spark, tmp_path):
    root = str(tmp_path / "out")
    assert broken_raw_files(spark, root).collect() == []
    posts = write(tmp_path / "posts", "a.json", [post(1, "one"), post(2, "two")])
    write(tmp_path / "posts", "cut.json", '[{"post_id": 3, "text": "three"}, {"post_id": 4, "te')
    comments = write(tmp_path / "comments", "c.json", "not json")
    clean_new_posts(spark, posts, root)
    clean_new_comments(spark, comments, root)
    aside = {(r.kind, r.file.rsplit("/", 1)[1]): r.content for r in broken_raw_files(spark, root).collect()}
    assert aside.keys() == {("posts", "cut.json"), ("comments", "c.json")}
    assert aside["posts", "cut.json"].endswith('"te')
    assert sorted(r.id for r in current_posts(spark, root).collect()) == [1, 2]
    assert current_comments(spark, root).collect() == []
    # The file comes back whole under another name.
    write(tmp_path / "posts", "whole.json", [post(3, "three"), post(4, "four")])
    clean_new_posts(spark, posts, root)
    assert sorted(r.id for r in current_posts(spark, root).collect()) == [1, 2, 3, 4]
    assert broken_raw_files(spark, root).count() == 2
    assert read_json_arrays(spark, posts, RAW_POSTS).count() == 5
