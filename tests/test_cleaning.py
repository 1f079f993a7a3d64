"""Cleaning, deduplication and validity, with made-up messages."""

import json

import pytest
from conftest import plan
from pyspark.sql import functions as F

from textmill.functions.dates import day_key, within_days
from textmill.functions.text import is_content, one_line
from textmill.operators.clean import (
    clean_comments,
    clean_posts,
    first_present,
    training_rows,
    with_content,
)
from textmill.operators.dedup import earliest_by_key, latest_by_key
from textmill.operators.features import tokenize
from textmill.schemas import COMMENTS, POSTS, RAW_COMMENTS, RAW_POSTS
from textmill.sources.json_files import read_json_arrays

CHAT_1, CHAT_2 = -1000000000001, -1000000000002


def post(chat, number, text="hello", views=1, date="2024-01-01", ts=1704067200):
    return {
        "channel_id": chat, "post_id": number, "date": date, "ts": ts,
        "text": text, "views": views, "replies_count": 0,
    }


@pytest.fixture
def raw_posts(spark, tmp_path):
    def write(*files):
        for i, (folder, records) in enumerate(files):
            target = tmp_path / "posts" / folder
            target.mkdir(parents=True, exist_ok=True)
            (target / f"{i}.json").write_text(json.dumps(records, indent=4, ensure_ascii=False))
        return read_json_arrays(spark, str(tmp_path / "posts"), RAW_POSTS)

    return write


def test_wide_ids_survive(raw_posts):
    cleaned = clean_posts(raw_posts(("date=2024-01-01", [post(CHAT_1, 2**40)])))
    assert [(r.id, r.chat_id) for r in cleaned.collect()] == [(2**40, CHAT_1)]
    assert cleaned.dtypes == [(f.name, f.dataType.simpleString()) for f in POSTS]


def test_newest_version_survives(raw_posts):
    versions = [post(CHAT_1, 1, views=v, ts=t) for v, t in ((10, 5), (12, 5), (99, 4))]
    for order in (versions, versions[::-1]):
        cleaned = clean_posts(raw_posts(("date=2024-01-01", order)))
        assert [r.views for r in cleaned.collect()] == [12]


def test_same_id_in_two_chats_is_two_posts(raw_posts):
    raw = raw_posts(("date=2024-01-01", [post(CHAT_1, 1), post(CHAT_2, 1)]))
    assert clean_posts(raw).count() == 2
    assert clean_posts(raw, keys=("id",)).count() == 1


def test_other_key_names_and_missing_ids(raw_posts):
    other = {
        "id": 7, "chat_id": CHAT_1, "date": "2024-01-02 10:00:00", "text": "b", "views": 3,
    }
    nameless = {"text": "no id", "date": "2024-01-02"}
    raw = raw_posts(("date=2024-01-01", [post(CHAT_1, 1)]), ("x", [other, nameless, nameless]))
    assert sorted((r.id, r.chat_id) for r in clean_posts(raw).collect()) == [
        (1, CHAT_1),
        (7, CHAT_1),
    ]


def test_date_comes_from_the_record_not_the_folder(raw_posts):
    raw = raw_posts(("date=leftovers", [post(CHAT_1, 1, date="2023-05-06")]))
    assert [r.date for r in clean_posts(raw).collect()] == ["2023-05-06"]


def test_empty_text_is_kept_by_cleaning_and_dropped_by_the_content_check(raw_posts):
    raw = raw_posts(("a", [post(CHAT_1, 1, text=""), post(CHAT_1, 2, text=" a\nb\r ")]))
    cleaned = clean_posts(raw)
    assert sorted(r.text for r in cleaned.collect()) == ["", "a b"]
    assert [r.text for r in with_content(cleaned, "text").collect()] == ["a b"]


def test_comments(rows):
    raw = rows(
        [
            (1, None, 9, CHAT_1, None, "old", 5, "ann", "2024-01-01", 1, 0, False),
            (1, None, 9, CHAT_1, None, "new\nline", 5, None, "2024-01-01", 2, 0, False),
            (None, 3, 9, None, CHAT_2, None, 5, "bob", "2024-01-01", None, 0, False),
        ],
        RAW_COMMENTS,
    )
    cleaned = clean_comments(raw)
    assert cleaned.dtypes == [(f.name, f.dataType.simpleString()) for f in COMMENTS]
    assert sorted((r.id, r.chat_id, r.text or "", r.author_name) for r in cleaned.collect()) == [
        (1, CHAT_1, "new line", None),
        (3, CHAT_2, "", "bob"),
    ]


def test_only_spaces_are_trimmed(rows):
    df = rows([("\t a\r\nb \n",)], "t string").select(one_line(F.col("t")).alias("t"))
    assert df.first().t == "\t a  b"


def test_first_present(rows):
    df = rows([(None, 2), (1, 3)], "a int, b int")
    assert [r[0] for r in df.select(first_present(df, "zz", "a", "b")).collect()] == [2, 1]
    with pytest.raises(ValueError):
        first_present(df, "zz")


def test_dedup_cuts_hot_keys_before_the_shuffle(rows):
    df = rows([(1, i) for i in range(50)] + [(2, 0)], "k int, v int")
    kept = latest_by_key(df, ("k",), ("v",))
    assert sorted(tuple(r) for r in kept.collect()) == [(1, 49), (2, 0)]
    assert "Partial" in plan(kept) and "WindowGroupLimit" in plan(kept)
    assert sorted(tuple(r) for r in earliest_by_key(df, ("k",), ("v",)).collect()) == [
        (1, 0),
        (2, 0),
    ]


def test_training_rows_need_text_and_a_numeric_label(rows):
    df = rows(
        [("a", "1"), ("b", "0.0"), ("c", "NaN"), ("d", "text"), ("e", None), (None, "1"), ("f", "")],
        "text string, is_destructive string",
    )
    assert sorted(tuple(r) for r in training_rows(df).collect()) == [("a", 1.0), ("b", 0.0)]
    renamed = df.withColumnRenamed("is_destructive", "label")
    assert training_rows(renamed).count() == 2


def test_content_check_on_text_that_looks_like_a_number(rows):
    texts = ["NaN", " nan ", "12", "x", "  ", "ok", None, "NaN said"]
    df = rows([(t,) for t in texts], "t string").filter(is_content(F.col("t")))
    assert [r.t for r in df.collect()] == ["12", "ok", "NaN said"]


def test_bad_and_null_dates_expire(rows):
    df = rows(
        [("2024-01-13",), ("2024-01-12",), ("2024-02-01 10:00:00",), ("leftovers",), (None,)],
        "date string",
    )
    kept = df.filter(within_days(F.col("date"), "2024-01-20", 7))
    assert [r.date for r in kept.collect()] == ["2024-01-13", "2024-02-01 10:00:00"]


def test_day_key_takes_the_first_form_present(rows, spark):
    df = rows(
        [("2024-03-01 12:00:00", 0), (None, 1704153599), (None, -1), (None, None)],
        "text string, ts bigint",
    )
    keyed = df.select(day_key(F.col("text"), F.col("ts"), as_of="2030-01-01").alias("d"))
    expected = ["2024-03-01", "2024-01-01", "1969-12-31", "2030-01-01"]
    zone = spark.conf.get("spark.sql.session.timeZone")
    for other in ("UTC", "Asia/Tokyo"):
        spark.conf.set("spark.sql.session.timeZone", other)
        assert [r.d for r in keyed.collect()] == expected
    spark.conf.set("spark.sql.session.timeZone", zone)


def test_tokens_of_null_text_and_blanks(rows):
    df = rows([(" Hi  there ",), (None,), ("",)], "text string")
    assert [r.words for r in tokenize(df).collect()] == [["", "hi", "", "there"], [""]]
