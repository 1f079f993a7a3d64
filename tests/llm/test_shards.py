import random
import re
import zlib
from collections import defaultdict

from textmill.llm import shards as sh


def placed(df, shards, **options):
    found = sh.place(df, shards, **options).collect()
    slots = defaultdict(list)
    for r in found:
        slots[r.shard].append(r.slot)
    assert all(sorted(own) == list(range(len(own))) for own in slots.values())
    assert all(0 <= s < shards for s in slots)
    return found


def loads(found, shards):
    sizes = [0] * shards
    for r in found:
        sizes[r.shard] += r["size"]
    return sizes


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    found = placed(docs, 24)
    texts = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    assert sorted(r.doc_id for r in found) == sorted(texts)
    for r in found:
        assert (r["size"], r.text_crc32) == (len(texts[r.doc_id]) + 8, zlib.crc32(texts[r.doc_id]))
    sizes = loads(found, 24)
    assert max(sizes) - min(sizes) < 0.02 * sum(sizes) / 24


def test_nulls_repeats_and_clashing_names(rows):
    data = [(i, "x" * (i % 50), 1, "a") for i in range(300)] + [(7, "same", 2, "b")] * 400 + [(None, None, 3, "c")] * 300
    df = rows(data, "doc_id bigint, text string, shard int, virtual_slot string")
    found = placed(df.repartition(5), 4)
    assert len(found) == 1000 and found[0].asDict().keys() == {
        "doc_id", "size", "text_crc32", "virtual_slot", "piece", "shard", "slot", "map_version"}
    assert {(r["size"], r.text_crc32) for r in found if r.doc_id is None} == {(8, 0)}
    sizes = loads(found, 4)  # a third of the rows share an id, and yet
    assert max(sizes) < 1.1 * sum(sizes) / 4


def test_very_long_text_and_empty_table(rows):
    df = rows([(i, "é" * (2_000_000 if i == 3 else 100)) for i in range(200)], "doc_id bigint, text string")
    found = placed(df, 5)
    big = next(r for r in found if r.doc_id == 3)
    assert big["size"] == 4_000_008 and sum(r.shard == big.shard for r in found) == 1
    assert sh.place(df.limit(0), 5).collect() == []


def test_map_versions(spark, rows, tmp_path):
    path = str(tmp_path / "map")
    df = rows([(i, "y" * (i * i % 97)) for i in range(2000)], "doc_id bigint, text string")
    placed(df, 6, map_path=path)
    one, two = (
        {(r.virtual_slot, r.piece): r.shard for r in sh.read_map(spark, path, v).collect()} for v in (1, 2)
    )
    assert one.keys() == two.keys() and one != two
    assert sum(one[k] != two[k] for k in one) < len(one) / 4


def test_rebalancing_moves_little():
    pick = random.Random(5)
    pieces = [sh.Piece(i, 0, pick.randrange(50, 200), 1) for i in range(4096)]
    total = sum(p.size for p in pieces)
    now = sh.rebalance(pieces, sh.deal(pieces, 24), 24)

    def spread(shard_of, shards):
        sizes = [0] * shards
        for p, s in zip(pieces, shard_of):
            sizes[s] += p.size
        return (max(sizes) - min(sizes)) / (total / shards)

    assert spread(now, 24) < 0.02
    assert sh.rebalance(pieces, now, 24).count(-1) == 0
    more = sh.rebalance(pieces, now, 25)
    moved = [(a, b) for a, b in zip(now, more) if a != b]
    assert spread(more, 25) < 0.03 and len(moved) < 4096 / 25 * 2.2
    fewer = sh.rebalance(pieces, now, 23)
    assert spread(fewer, 23) < 0.03 and max(fewer) == 22
    assert all(a == b or a == 23 or b < 23 for a, b in zip(now, fewer))
    assert sh.rebalance([], [], 3) == [] and sh.deal([], 3) == []


def test_native_plan(rows):
    df = rows([(1, "a")], "doc_id bigint, text string").select("doc_id", "text")
    native = df.sparkSession.range(50).selectExpr("id as doc_id", "cast(id as string) as text")
    text = sh.place(native, 3)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|RDD", text)
