import base64
import hashlib
import random

import pytest

from textmill.llm import warc

INNER = (
    "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: 5\r\n\r\nabcde\r\n\r\n"
)


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def brute(data, least=0):
    last = {}
    for i, _, text in data:
        last[text or ""] = max(last.get(text or "", -1), i)
    return sorted(
        (i, len((t or "").encode()), digest(t), *(
            ("revisit", last[t or ""]) if last[t or ""] != i and len((t or "").encode()) >= least else ("response", None)
        ))
        for i, _, t in data
    )


def read(frame):
    rows = frame.collect()
    assert all(r.intact for r in rows)
    return sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows)


@pytest.mark.parametrize("part_bytes", ["128m", "9k"])
def test_payloads_that_hold_records(spark, rows, part_bytes):
    """Boundaries are right wherever Spark cuts the files."""
    pick = random.Random(3)
    pieces = ["x", "é\r\n\r\n", "\r\nWARC/1.", "\r\nWARC/1.0\r\n", INNER, "\r\n\r\n" + INNER, "\r\n", "\r\nWARC/1.0\r\n\r\n"]
    data = []
    for i in range(120):
        text = pick.choice(pieces) * pick.randrange(1, 12) + str(pick.randrange(30))
        kind = pick.random()
        data.append((i, None if i % 7 == 0 else f"http://a/{i} b\r\n", None if kind < 0.05 else "" if kind < 0.1 else text))
    df = rows([(*r, "x", 1) for r in data], "page_id bigint, url string, html string, _digest string, _file int")
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(k) for k in keys]
    try:
        spark.conf.set(keys[0], part_bytes)
        spark.conf.set(keys[1], "1")
        assert read(warc.archive(df.repartition(2))) == brute(data)
    finally:
        for k, v in zip(keys, before):
            spark.conf.set(k, v)


def test_long_payloads_least_size_and_repeats(rows):
    data = [(1, "u", "y" * 3_000_000), (2, "u", "y" * 3_000_000), (3, "u", "ab"), (4, "u", "ab"), (5, "u", None), (6, "u", "")]
    df = rows(data, "page_id bigint, url string, html string")
    assert read(warc.archive(df, least=3)) == brute(data, 3)
    twice = rows([(3, "u", "ab"), (3, "u", "ab"), (1, "v", "ab")], "page_id bigint, url string, html string")
    assert [(r[0], r[3], r[4]) for r in read(warc.archive(twice))] == [(1, "revisit", 3), (3, "response", None), (3, "response", None)]
    unnamed = rows([(None, "u", "ab"), (None, "u", "c")], "page_id bigint, url string, html string")
    assert {(r.page_id, r.record_type) for r in warc.archive(unnamed).collect()} == {(None, "response")}
    assert warc.archive(df.limit(0)).collect() == []


def test_pointer_jumping(rows):
    links = [("f", 0, 10), ("f", 10, 25), ("f", 12, 25), ("f", 25, 40), ("f", 30, 40), ("g", 5, 9), ("h", 0, 7), ("f", 90, 3)]
    links += [("k", i, i + 1) for i in range(300)]
    got = {(r["_file"], r["at"]) for r in warc.reachable(rows(links, "_file string, at bigint, next bigint")).collect()}
    assert got == {("f", 0), ("f", 10), ("f", 25), ("h", 0)} | {("k", i) for i in range(300)}


def test_query(spark):
    from textmill.llm.queries import op3_warc

    folder = "/root/testdata/sf0.001"
    data = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{folder}/pages.parquet").collect()]
    assert read(op3_warc(spark, folder)) == brute(data)
