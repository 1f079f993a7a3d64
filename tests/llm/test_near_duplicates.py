import random

import numpy as np
import pyarrow as pa
from brute import near_groups

from textmill.llm import near_duplicates
from textmill.llm.links import components, link_buckets


def checked(df, data):
    got = {r.doc_id: r for r in near_duplicates.groups(df).collect()}
    root, size = near_groups(data)
    for i, _ in data:
        assert (got[i].n_shingles, got[i].component_id, got[i].kept) == (size[i], root[i], root[i] == i)
    return got


def test_whole_tables(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    checked(df, [(r.doc_id, r.text) for r in df.collect()])


def test_copies_near_copies_and_chains(rows):
    pick = random.Random(2)
    word = lambda: "".join(pick.choice("abcdefgh") for _ in range(5))
    base = [word() for _ in range(120)]
    data = [(100 + i, " ".join(base)) for i in range(40)]
    for i in range(60):  # near copies: a word changed each, more and more apart
        base = [*base]
        base[pick.randrange(120)] = word()
        data.append((300 + i, " ".join(base)))
    data += [(500 + i, " ".join(word() for _ in range(pick.randrange(1, 60)))) for i in range(40)]
    data += [(1, None), (2, ""), (3, " \t\n"), (4, "a b c"), (5, "A  b\nc"), (6, "a b c d"), (7, "x " * 30000)]
    df = rows([(i, t, 7, "k") for i, t in data], "doc_id bigint, text string, bands int, `_id` string")
    got = checked(df, data)
    assert not got[1].n_shingles and got[5].component_id == 4
    assert got[359].component_id == 100  # linked over the chain only


def test_nulls_repeats_and_empty(rows):
    schema = "doc_id bigint, text string"
    assert near_duplicates.groups(rows([], schema)).collect() == []
    got = near_duplicates.groups(
        rows([(None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f")], schema)
    ).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in got) == [
        (0, 0, True), (1, 1, True), (1, 1, True), (2, 1, False),
    ]


def test_odd_sketch_bits_follow_similarity():
    pick = np.random.default_rng(4)
    for common in (990, 900, 500):
        values = pick.integers(0, 2**63, 2000 - common, dtype=np.uint64)
        one, two = np.sort(values[:1000]), np.sort(values[1000 - common :][:1000])
        found = near_duplicates.samples(np.concatenate([one, two]), np.array([0, 1000, 1000 + len(two)]))
        a, b = near_duplicates.odd_sketches(found)
        differ = int(np.bitwise_count(a ^ b).sum())
        similarity = common / (2000 - common)
        expected = near_duplicates.SKETCH_BITS / 2 * (1 - np.exp(-4 * 80 * (1 - similarity) / near_duplicates.SKETCH_BITS))
        assert abs(differ - expected) < 25


def test_components(rows):
    pick = random.Random(1)
    links = [(pick.randrange(400), pick.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1200)]
    from brute import roots

    want = roots({x for pair in links if pair[0] != pair[1] for x in pair}, links)
    got = {r.node: r.root for r in components(rows(links, "a bigint, b bigint")).collect()}
    assert got == want


def test_buckets_lose_no_link(rows):
    """Links that no leader sees are found when all members of different groups meet."""
    members = [(9, n) for n in range(30)]
    wanted = rows([(4, 17), (17, 22), (5, 6), (28, 29)], "a bigint, b bigint")
    from pyspark.sql import functions as F

    labels, _ = link_buckets(
        rows(members, "bucket int, node bigint"), rows([(n,) for n in range(30)], "node bigint"), F.lit(True), lambda p: p.join(wanted, ["a", "b"]), rounds=1
    )
    assert {r.node: r.root for r in labels.collect() if r.node != r.root} == {17: 4, 22: 4, 6: 5, 29: 28}


def test_shingle_sets_of_batches():
    sets, bounds = near_duplicates.shingle_sets(pa.array(["a b c d e f", None, "a b c d e f", "f e d"]))
    assert np.diff(bounds).tolist() == [2, 0, 2, 1] and (sets[:2] == sets[2:4]).all()
