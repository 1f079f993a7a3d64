"""The command line and the recurring cycle, on raw files."""

import json

import pytest

from textmill.__main__ import main
from textmill.operators.classify import predict_class
from textmill.operators.clean import clean_comments, clean_posts
from textmill.operators.classify import load
from textmill.plans.cycle import (
    clean_new_comments,
    clean_new_posts,
    current_comments,
    current_posts,
    current_scores,
)
from textmill.schemas import RAW_COMMENTS, RAW_POSTS
from textmill.sources.json_files import read_json_arrays


def post(number, text, views, ts=1, chat=-5):
    return {
        "channel_id": chat, "post_id": number, "date": "2024-01-01 10:00:00", "ts": ts,
        "text": text, "views": views, "replies_count": 0,
    }


def comment(number, text, ts=1, author="ann", date="2024-01-15"):
    return {
        "comment_id": number, "post_id": 1, "channel_id": -5, "text": text, "author_id": 2**40,
        "author_name": author, "date": date, "ts": ts, "reply_to_msg_id": 0,
        "is_reply_to_user": False,
    }


@pytest.fixture
def raw(tmp_path):
    def write(kind, name, *records, folder="date=2024-01-01"):
        target = tmp_path / "raw" / kind / folder
        target.mkdir(parents=True, exist_ok=True)
        (target / name).write_text(json.dumps(records, indent=4, ensure_ascii=False))
        return str(tmp_path / "raw" / kind)

    return write


def rows(df):
    return sorted((tuple(r) for r in df.select(sorted(df.columns)).collect()), key=str)


def test_cycles_equal_the_batch_clean(spark, raw, tmp_path):
    root = str(tmp_path / "out")
    for turn in range(3):
        posts = raw(
            "posts", f"{turn}.json",
            *(post(n, f" text\n{n} ", views=turn * 10 + n % 2) for n in range(turn, 4)),
            post(turn, "again", 0), post(turn, "again", 0), {"text": "no id"},
            folder=f"date=leftovers{turn}",
        )
        comments = raw(
            "comments", f"{turn}.json",
            *(comment(n, f"c{n} at {turn}", ts=turn, author=None) for n in range(3)),
        )
        clean_new_posts(spark, posts, root)
        clean_new_comments(spark, comments, root)
        batch = clean_posts(read_json_arrays(spark, posts, RAW_POSTS))
        assert rows(current_posts(spark, root)) == rows(batch)
        batch = clean_comments(read_json_arrays(spark, comments, RAW_COMMENTS))
        assert rows(current_comments(spark, root)) == rows(batch)
    versions = spark.read.parquet(f"{root}/post_versions").count()
    clean_new_posts(spark, posts, root)
    assert spark.read.parquet(f"{root}/post_versions").count() == versions


def test_commands(spark, raw, tmp_path, capsys):
    root, training = str(tmp_path / "w"), str(tmp_path / "training")
    (tmp_path / "lines.txt").write_text(
        "".join(f"__label__INSULT you trash {i}\n__label__NORMAL a lovely day {i}\n" for i in range(20))
    )
    (tmp_path / "csv").mkdir()
    (tmp_path / "csv" / "a.csv").write_text("is_destructive,text\n0,calm\n")
    (tmp_path / "csv" / "b.csv").write_text("text,is_destructive\nrude,1\n")
    main(["training", "--training", training, "--label-lines", str(tmp_path / "lines.txt")])
    main(["training", "--training", training, "--csv", str(tmp_path / "csv")])
    assert spark.read.parquet(training).count() == 42

    posts = raw("posts", "a.json", post(1, "hello", 1), post(2, "world", 1))
    comments = raw(
        "comments", "a.json",
        comment(1, "you trash trash"), comment(2, "a lovely day"), comment(3, "old", date="2023-01-01"),
    )
    paths = ["--posts", posts, "--comments", comments, "--root", root]
    report = main(["run", *paths, "--training", training, "--as-of", "2024-01-20"])
    found = {r.stage: (r.status, r.rows) for r in report.collect()}
    assert found["clean"] == ("OK", 5) and found["retain"] == ("OK", 2)
    assert found["silver_comments"] == ("OK", 2)
    assert found["gold_synthetic_comments"] == ("OK", 15)
    assert found["gold_toxic_predictions"] == ("OK", 15)
    assert {status for status, _ in found.values()} == {"OK"}

    model = f"{root}/models/logistic"
    scored = main(["cycle", *paths, "--model", model])
    assert sum(r["count"] for r in scored.collect()) == 3
    # An edit and the same id in another chat: one score for each current comment.
    raw("comments", "b.json", comment(1, "a lovely day", ts=1800000000), {**comment(1, "you trash trash"), "channel_id": -9})
    main(["cycle", *paths, "--model", model])
    scores = current_scores(spark, root)
    current = current_comments(spark, root)
    assert scores.count() == current.count() == 4
    assert rows(scores.select("id", "text", "is_toxic_pred")) == rows(predict_class(load(model), current))
    assert spark.read.parquet(f"{root}/comment_scores").count() == 5

    flagged = str(tmp_path / "flagged")
    spark.createDataFrame([("Trash, trash!", 1.0), ("kind", 0.0)],
                          "original_content string, is_toxic_pred double").write.parquet(flagged)
    assert [tuple(r) for r in main(["words", "--predictions", flagged]).collect()] == [("trash", 2)]
    status = {r.table: r.status for r in main(["health", "silver_posts", "nothing"]).collect()}
    assert status == {"silver_posts": "OK", "nothing": "MISSING"}
    capsys.readouterr()
    main(["health", "silver_posts", "--samples", "1"])
    assert "--- silver_posts" in capsys.readouterr().out
    times = main(["training-times", "--training", training]).collect()
    assert times[-1].rows == 42 + spark.read.parquet(training).filter("origin not in ('base')").count()
    spark.table("silver_comments").write.parquet(str(tmp_path / "messages"))
    times = main(["scoring-times", "--model", model, "--messages", str(tmp_path / "messages"), "--rows", "10"]).collect()
    assert [r.rows for r in times] == [2, 4, 6, 8, 10]
    with pytest.raises(SystemExit):
        main(["unknown"])
