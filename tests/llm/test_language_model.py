import math
import zlib

import numpy as np
import pytest
from brute import base_scores
from pyspark.sql import functions as F

from textmill.llm import language_model as lm


def held(i):
    return zlib.crc32(str(i).encode()) % 7 == 2


HELD = lambda: F.crc32(F.col("doc_id").cast("string")) % 7 == 2


def log_kt(zeros, ones):
    return math.lgamma(zeros + 0.5) + math.lgamma(ones + 0.5) - 2 * math.lgamma(0.5) - math.lgamma(zeros + ones + 1)


class BruteTree:
    """Log weighted probability of all coded bits, from counts by context and bit prefix."""

    def __init__(self, texts, expanded):
        self.counts, self.expanded = {}, expanded
        for text in texts:
            self.add(text)

    def add(self, text):
        padded = b"\0\0\0" + text
        for at in range(len(text)):
            self.count(padded[at : at + 3], text[at])

    def count(self, before, byte, sign=1):
        for depth in range(4):
            context = before[3 - depth :]
            if depth == 3 and before[1:] not in self.expanded:
                break
            node = 1
            for shift in range(7, -1, -1):
                bit = byte >> shift & 1
                cell = self.counts.setdefault((context, node), [0, 0])
                cell[bit] += sign
                node = 2 * node + bit

    def log_weighted(self):
        """Over all trees, one for each bit prefix."""
        total, by_depth = {}, sorted(self.counts, key=lambda k: -len(k[0]))
        children = {}
        out = 0.0
        for context, node in by_depth:
            own = log_kt(*self.counts[context, node])
            inner = len(context) < 2 or (len(context) == 2 and context in self.expanded)
            value = np.logaddexp(own, children.get((context, node), 0.0)) - math.log(2) if inner else own
            total[context, node] = value
            if context:
                children[context[1:], node] = children.get((context[1:], node), 0.0) + value
            else:
                out += value
        return out


def grams(texts):
    """Counts as the operator gathers them."""
    two, three = {}, {}
    for text in texts:
        padded = b"\0\0\0" + text
        for at in range(len(text)):
            a, b, c = padded[at : at + 3]
            two[b << 16 | c << 8 | text[at]] = two.get(b << 16 | c << 8 | text[at], 0) + 1
            three[a, b, c, text[at]] = three.get((a, b, c, text[at]), 0) + 1
    return (np.array(sorted(two)), np.array([two[k] for k in sorted(two)])), three


@pytest.mark.parametrize("expanded", [0, 1, 4, 256])
def test_prediction_is_the_ratio_of_weighted_probabilities(expanded):
    texts = [b"abracadabra abra", b"cadabra \xc3\xa9\xc3\xa9 ab", b"", b"a"]
    counted, three = grams(texts)
    numbers = lm.expand(*counted, most=expanded)
    chosen = {bytes([k >> 8, k & 255]) for k in np.flatnonzero(numbers >= 0)}
    deeper = {}
    for (a, b, c, byte), n in three.items():
        if (head := numbers[b << 8 | c]) >= 0:
            deeper[int(head) << 16 | a << 8 | byte] = n
    keys = np.array(sorted(deeper), np.int64)
    tree = lm.build_tree(counted, numbers, (keys, np.array([deeper[k] for k in keys.tolist()], np.int64)))
    brute = BruteTree(texts, chosen)
    before = brute.log_weighted()
    for context, byte in ((b"abr", b"a"), (b"\0\0\0", b"a"), (b"zzz", b"q"), (b"xra", b"c"), (b"qab", b"r"), (b"a\xc3\xa9", b"\xc3")):
        row = tree.rows(*(np.array([x], np.uint8) for x in reversed(context)))
        got = tree.table[row[0], byte[0]]
        brute.count(context, byte[0])
        assert got == pytest.approx((brute.log_weighted() - before) / math.log(10), abs=2e-5)
        brute.count(context, byte[0], -1)
    assert np.allclose((10.0 ** tree.table.astype(float)).sum(1), 1, atol=1e-4)


def test_log_gamma():
    x = np.array([0.5, 1.0, 1.5, 3.25, 10.0, 1e3, 1e7])
    assert np.allclose(lm._log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-11, atol=1e-9)


@pytest.mark.parametrize("frequent", [0, 5, 1 << 18])
def test_base_scores(rows, frequent):
    data = [(i, t) for i, t in enumerate([
        "A b a", None, "", "x " * 500, "é B b\x0bq", "new words here", "a b c d e", "a b c d e", " ", "Zz zZ",
        "y" * 5000, "a", "b b b", "held only", "c", "d e f", "g h", "never seen before", "a z",
    ])]
    df = rows([(i, t, 1, "k") for i, t in data], "doc_id bigint, text string, n bigint, key string")
    got = {r.doc_id: r for r in lm.score(df, HELD(), frequent=frequent).collect()}
    want = base_scores(data, held)
    assert any(held(i) for i, _ in data) and len(got) == len(data)
    for i, text in data:
        tokens, known, total, score = want[i]
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens, got[i].held_out) == (tokens, known, total, held(i))
        assert got[i].base_score == pytest.approx(score, abs=1e-9)
        assert (got[i].score == 0) == (not text)


def test_whole_tables_and_better_than_one_byte_model(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    data = [(r.doc_id, r.text) for r in df.collect()]
    got = {r.doc_id: r for r in lm.score(df, HELD()).collect()}
    want = base_scores(data, held)
    for i, _ in data:
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens) == want[i][:3]
        assert got[i].base_score == pytest.approx(want[i][3], abs=1e-7)
    counts = np.bincount(np.frombuffer("".join(t or "" for _, t in data).lower().encode(), np.uint8))
    share = counts[counts > 0] / counts.sum()
    entropy = -(share * np.log2(share)).sum()
    out = [r for i, r in got.items() if held(i) and r.score]
    mean = -sum(r.score for r in out) / math.log10(2) / sum(len((t or "").encode()) for i, t in data if held(i))
    assert mean < 0.8 * entropy


def test_empty_and_null_ids(rows):
    empty = rows([], "doc_id bigint, text string")
    assert lm.score(empty, HELD()).collect() == []
    got = lm.score(rows([(None, "ab"), (None, "ab")], "doc_id bigint, text string"), HELD()).collect()
    assert [(r.doc_id, r.held_out, r.n_tokens, r.n_known) for r in got] == [(None, False, 2, 2)] * 2
    assert got[0].score == got[1].score < 0


@pytest.mark.parametrize("limits", [{}, {"contexts": 0}, {"contexts": 40}])
def test_all_contexts_get_children(rows, limits):
    """More than 256 contexts of two bytes; those not sent to all tasks are joined."""
    random = np.random.default_rng(3)
    letters = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz0123456789 ", np.uint8)
    data = [(i, bytes(random.choice(letters, 300) if i % 3 else letters[:: i % 2 + 1]).decode() * 2) for i in range(40)]
    counted, three = grams([t.encode() for i, t in data if not held(i)])
    numbers = lm.expand(*counted, most=1 << 16)
    assert numbers.max() > 256
    deeper = {int(numbers[b << 8 | c]) << 16 | a << 8 | byte: n for (a, b, c, byte), n in three.items()}
    keys = np.array(sorted(deeper), np.int64)
    tree = lm.build_tree(counted, numbers, (keys, np.array([deeper[k] for k in keys.tolist()], np.int64)))
    got = {r.doc_id: r.score for r in lm.score(rows(data, "doc_id bigint, text string"), HELD(), **limits).collect()}
    for i, text in data:
        codes = np.frombuffer(b"\0\0\0" + text.encode(), np.uint8)
        want = tree.table[tree.rows(codes[2:-1], codes[1:-2], codes[:-3]), codes[3:]].astype(float).sum()
        assert got[i] == pytest.approx(want, abs=1e-3)
