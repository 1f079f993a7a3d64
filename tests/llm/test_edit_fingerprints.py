import hashlib
import random

import numpy as np
import pyarrow as pa

from textmill.llm import edit_fingerprints as ef
from textmill.llm.buffers import code_points


def brute(data):
    """id to (n_chars, edited text, next id)."""
    order = sorted(data, key=lambda x: -x[0])
    out = {}
    for place, (i, text) in enumerate(order):
        other_id, other = order[(place + 1) % len(order)]
        text, other = text or "", other or ""
        half = len(text) // 2
        out[i] = (len(text), text[: len(text) - half] + other[:half], other_id)
    return out


def checked(df, data):
    got = {r.doc_id: r for r in ef.fingerprint_edits(df).collect()}
    want = brute(data)
    assert set(got) == set(want)
    prints = {i: ef.fingerprints(*code_points(pa.array([t])))[0] for i, t in data}
    for i, (size, edited, following) in want.items():
        r = got[i]
        assert r.n_chars == size
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == prints[i]
        assert r.edited_fingerprint == ef.fingerprints(*code_points(pa.array([edited])))[0]
        assert r.near_edited == ef.likeness(r.fingerprint, r.edited_fingerprint)
        assert r.near_next == ef.likeness(prints[i], prints[following])
    return got


def test_whole_tables(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = checked(df, [(r.doc_id, r.text) for r in df.collect()])
    long = [r for r in got.values() if r.n_chars > 200]
    assert sum(r.near_edited > r.near_next for r in long) > 0.97 * len(long)


def test_edges(rows):
    data = [(5, None), (7, ""), (-3, "é" * 7), (100, "x"), (101, "the same"), (102, "the same"), (2**40, "abc " * 30000)]
    df = rows([(i, t, 1, 2) for i, t in data], "doc_id bigint, text string, _part int, `_key` int")
    got = checked(df, data)
    assert got[101].fingerprint == got[102].fingerprint and got[102].near_next == 1
    one = rows([(1, "ab")], "doc_id bigint, text string")
    assert ef.fingerprint_edits(one).first().edited_sha256 == hashlib.sha256(b"aa").hexdigest()
    assert ef.fingerprint_edits(one.limit(0)).collect() == []
    repeats = rows([(None, "zz"), (1, "ab"), (1, "ab"), (1, "cd")], "doc_id bigint, text string")
    assert len(ef.fingerprint_edits(repeats).collect()) == 4


def test_walking_alone_or_together_is_the_same(monkeypatch):
    pick = random.Random(3)
    texts = ["".join(pick.choice("abcdef ") for _ in range(pick.randrange(3000))) for _ in range(150)]
    codes, rows = code_points(pa.array(texts))
    some = ef.fingerprints(codes, rows)
    for few in (0, 10**9):
        monkeypatch.setattr(ef, "FEW", few)
        assert ef.fingerprints(codes, rows) == some
    assert [ef.fingerprints(*code_points(pa.array([t])))[0] for t in texts[:20]] == some[:20]


def test_likeness_falls_with_edits():
    pick = random.Random(9)
    text = "".join(pick.choice("abcdefghij ") for _ in range(3000))

    def edited(times):
        letters = list(text)
        for _ in range(times):
            at = pick.randrange(len(letters))
            letters[at : at + pick.randrange(2)] = pick.choice(["", "q"])
        return "".join(letters)

    first = ef.fingerprints(*code_points(pa.array([text])))[0]
    means = [
        np.mean([ef.likeness(first, ef.fingerprints(*code_points(pa.array([edited(k)])))[0]) for _ in range(8)])
        for k in (1, 30, 600)
    ]
    assert means[0] > means[1] > means[2]
    assert means[0] > 0.8 and means[2] < 0.3


def test_bands_and_verification_find_like_texts(rows):
    pick = random.Random(5)
    word = lambda: "".join(pick.choice("abcdefghijkl") for _ in range(6))
    base = [" ".join(word() for _ in range(pick.randrange(150, 500))) for _ in range(12)]
    data = []
    for k, text in enumerate(base):
        copies = [text, text, text[:-4] + "zzzz", text + " tail", text[:-9]]
        data += [(10 * k + i, t) for i, t in enumerate(copies)]
    data += [(200, ""), (201, None), (202, "ab")]
    prints = ef.fingerprint_edits(rows(data, "doc_id bigint, text string"))
    got = {r.doc_id: r.group_id for r in ef.like_groups(prints).collect()}
    assert all(got[10 * k + i] == 10 * k for k in range(12) for i in range(5))
    assert got[201] == 200 and got[202] == 202


def test_recall_of_like_pairs(spark, rows):
    """All pairs whose fingerprints are like enough, with edits all over the text."""
    pick = random.Random(21)
    sizes = [10, 12, 15, 25, 40, 64, 130, 260, 2000]
    data = []
    for k in range(1800):
        letters = [pick.choice("aabcddeefghiijklmnoopqrsttu   ") for _ in range(sizes[k % len(sizes)])]
        edited = list(letters)
        for at in pick.sample(range(len(letters)), max(1, int(pick.choice([0.01, 0.03, 0.06]) * len(letters)))):
            edited[at] = pick.choice(["y", "z", letters[at] + "x", ""])
        data += ["".join(letters), "".join(edited)]
    prints = ef.fingerprints(*code_points(pa.array(data)))
    likes = {k: ef.likeness(prints[2 * k], prints[2 * k + 1]) for k in range(1800)}
    got = {r.doc_id: r.group_id for r in ef.like_groups(rows(list(enumerate(prints)), "doc_id bigint, fingerprint string")).collect()}
    for short in (True, False):
        wanted = [k for k, like in likes.items() if 0.8 <= like < 0.9 and (k % len(sizes) < 3) == short]
        found = sum(got[2 * k] == got[2 * k + 1] for k in wanted)
        assert len(wanted) >= 60 and found >= 0.95 * len(wanted), (short, found, len(wanted))


def test_query_has_groups(spark):
    from textmill.llm import queries

    assert "group_id" in queries.op9_edit_fingerprints(spark, "/root/testdata/sf0.001").columns


def test_comparison_inside_the_join_loses_no_like_pair(spark):
    """Texts of one level and of neighbouring ones, a few of which are like and many of which nearly."""
    pick = random.Random(31)
    texts = []
    for size in (5, 20, 70, 126, 130, 254, 262, 1022, 1030):
        base = [pick.choice("abcdefghij ") for _ in range(size)]
        for share in (0, 0.02, 0.04, 0.06, 0.09, 0.15, 0.3):
            letters = list(base)
            for at in pick.sample(range(size), int(share * size)):
                letters[at] = pick.choice(["", "q", letters[at] + "x"])
            texts += ["".join(letters), "".join(letters) + "tail"]
    prints = dict(enumerate(ef.fingerprints(*code_points(pa.array(texts)))))
    frame = spark.createDataFrame(list(prints.items()), "node bigint, fingerprint string")
    columns = ", ".join(f"{c} bigint" for c in ef._words())
    marks = frame.mapInArrow(ef._packed, f"node bigint, level int, size0 int, size1 int, {columns}").cache()
    sides = [marks.select(*[marks[c].alias(f"{c}_{side}") for c in marks.columns]) for side in "ab"]
    met = sides[0].crossJoin(sides[1]).filter("node_a < node_b").filter(ef._may_be_like(0.8)).select("node_a", "node_b")
    met = {tuple(r) for r in met.collect()}
    pairs = [(a, b) for a in prints for b in prints if a < b]
    like = {p for p in pairs if ef.likeness(prints[p[0]], prints[p[1]]) >= 0.8}
    level = lambda i: prints[i].split(":")[0]
    assert like <= met and any(level(a) != level(b) for a, b in like)
    assert len(met) < len(like) + 0.02 * len(pairs)


def test_pairs_just_below_the_bound_are_left_out_in_the_join(spark):
    """A group of near copies that are hardly like: their pairs would grow with its square."""
    pick = random.Random(33)
    base = [pick.choice("abcdefghij ") for _ in range(1500)]
    texts = []
    for _ in range(40):
        letters = list(base)
        for at in pick.sample(range(len(letters)), 18):
            letters[at] = pick.choice(["", "q", letters[at] + "x"])
        texts.append("".join(letters))
    prints = dict(enumerate(ef.fingerprints(*code_points(pa.array(texts)))))
    columns = ", ".join(f"{c} bigint" for c in ef._words())
    frame = spark.createDataFrame(list(prints.items()), "node bigint, fingerprint string")
    marks = frame.mapInArrow(ef._packed, f"node bigint, level int, size0 int, size1 int, {columns}").cache()
    sides = [marks.select(*[marks[c].alias(f"{c}_{side}") for c in marks.columns]) for side in "ab"]
    met = sides[0].crossJoin(sides[1]).filter("node_a < node_b").filter(ef._may_be_like(0.8))
    met = {tuple(r) for r in met.select("node_a", "node_b").collect()}
    likes = {(a, b): ef.likeness(prints[a], prints[b]) for a in prints for b in prints if a < b}
    like = {p for p, x in likes.items() if x >= 0.8}
    nearly = {p for p, x in likes.items() if 0.72 <= x < 0.8}
    assert like <= met and len(nearly) > 60
    assert len(met - like) < 0.15 * len(nearly), (len(met), len(like), len(nearly))
