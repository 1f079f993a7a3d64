import random

from brute import roots
from pyspark.sql import functions as F

from textmill.llm import links


def test_groups_of_many_rounds_and_no_pair_confirmed_twice(rows):
    """Nodes are linked if their places are near; leaders of a round reach few of a long chain."""
    pick = random.Random(4)
    places = [pick.randrange(400) for _ in range(120)]
    buckets = [(b, node) for node, at in enumerate(places) for b in {at // 40, 100 + (at + 20) // 40}]
    marks = rows([(node, at) for node, at in enumerate(places)], "node bigint, place bigint")
    seen = []

    def confirm(pairs):
        seen.extend(tuple(r) for r in pairs.collect())
        for side in "ab":
            pairs = pairs.join(marks.select(F.col("node").alias(side), F.col("place").alias(f"at_{side}")), side)
        return pairs.filter(F.abs(F.col("at_a") - F.col("at_b")) <= 4).select("a", "b")

    labels, found = links.link_buckets(rows(buckets, "bucket bigint, node bigint"), marks, F.lit(True), confirm)
    near = {(a, b) for a in range(120) for b in range(a) if abs(places[a] - places[b]) <= 4}
    meet = [(b, a) for a, b in near if {x for x, n in buckets if n == a} & {x for x, n in buckets if n == b}]
    want = roots(list(range(120)), meet)
    got = {r.node: r.root for r in labels.collect()}
    assert {n: got.get(n, n) for n in range(120)} == want
    assert len(seen) == len(set(seen))
    assert {tuple(r) for r in found.collect()} <= set(meet)


def test_nothing_linked(rows):
    marks = rows([(1, 0), (2, 0)], "node bigint, place bigint")
    labels, found = links.link_buckets(
        rows([(7, 1), (7, 2)], "bucket bigint, node bigint"), marks, F.lit(True), lambda pairs: pairs.filter("a < 0")
    )
    assert labels.count() == found.count() == 0


def test_parts_of_the_buckets_find_the_same_groups_and_keep_no_marks(rows, monkeypatch):
    """Every part has some of the buckets, and what is written holds no marks of their rows."""
    pick = random.Random(5)
    places = [pick.randrange(300) for _ in range(90)]
    buckets = [(b, node) for node, at in enumerate(places) for b in {at // 40, -1 - (at + 20) // 40}]
    marks = rows([(node, at) for node, at in enumerate(places)], "node bigint, place bigint")
    written, seen = [], []
    stage = links.stage
    monkeypatch.setattr(links, "stage", lambda df, name: written.append((name, df.columns)) or stage(df, name))

    def confirm(pairs):
        seen.extend(tuple(r) for r in pairs.collect())
        for side in "ab":
            pairs = pairs.join(marks.select(F.col("node").alias(side), F.col("place").alias(f"at_{side}")), side)
        return pairs.filter(F.abs(F.col("at_a") - F.col("at_b")) <= 4).select("a", "b")

    frame = rows(buckets, "bucket bigint, node bigint")
    got = []
    for parts in (1, 3):
        del seen[:], written[:]
        labels, _ = links.link_buckets(frame, marks, F.abs(F.col("place_a") - F.col("place_b")) <= 9, confirm, parts=parts)
        got.append(sorted(tuple(r) for r in labels.collect()))
        assert len(seen) == len(set(seen))
    assert got[0] == got[1] and got[0]
    assert not [name for name, columns in written if "place" in columns]
