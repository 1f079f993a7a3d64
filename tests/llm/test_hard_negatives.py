import math
import random

import numpy as np
import pytest

from textmill.llm import hard_negatives as hn


def brute(data, every=50):
    """Rows of (id, label, vector), in order, to the operator's records."""
    kept = [
        (n, i, label, [math.floor(256 * float(x)) for x in v])
        for n, (i, label, v) in enumerate(data)
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    late = lambda r: (r[1] is None, r[1] or 0, r[0])
    out = []
    for a in kept:
        if a[1] is None or a[1] % every:
            continue
        ranked = sorted(((-sum(x * y for x, y in zip(a[3], b[3])), late(b), b) for b in kept if b is not a), key=lambda t: t[:2])
        own = [(-s, b) for s, _, b in ranked if b[2] == a[2]][:5]
        for p, b in own:
            hard = [(-s, c) for s, _, c in ranked if c[2] != a[2] and 50 * p <= -100 * s <= 95 * p][:3]
            out += [(a[1], b[1], k, c[1], p, s) for k, (s, c) in enumerate(hard, 1)]
    return sorted(out, key=str)


def mined(df, **options):
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted((tuple(r) for r in hn.mine(df, **options).select(names).collect()), key=str)


SCHEMA = "vec_id bigint, label int, embedding array<double>, row int, slot string"


def frame(rows, data):
    return rows([(*d, 1, "x") for d in data], SCHEMA).coalesce(1)


def test_exact_scores_for_any_size():
    pick = np.random.default_rng(3)
    for size, peak in ((1, 5), (64, 300), (700, 9000), (300, 2**24)):
        a, b = (pick.integers(-peak, peak + 1, (n, size)) for n in (7, 11))
        a[0], b[0], b[1] = peak, peak, -peak
        want = a.astype(object) @ b.astype(object).T
        primes = hn.primes_for(float(size * peak * peak))
        got = hn.scores(hn.residues(a, primes), hn.residues(b, primes), primes)
        assert got.tolist() == want.tolist() and len(primes) >= hn.FEWEST_PRIMES
    with pytest.raises(ValueError):
        hn.primes_for(2.0**62)


def test_small_vectors_with_many_ties(rows):
    pick = random.Random(4)
    data = [(i, pick.randrange(3), [pick.choice([0.0, 0.5, -0.25, 1.0]) for _ in range(4)]) for i in range(400)]
    assert mined(frame(rows, data), cell_root=4) == brute(data)


def test_nulls_repeats_lengths_and_hot_label(rows):
    pick = random.Random(9)
    vector = lambda n: [round(pick.gauss(0, 1), 2) for _ in range(n)]
    data = [(i, 1 if i % 3 else pick.randrange(4), vector(5)) for i in range(150)]
    data += [(50, 1, vector(5)), (50, 1, vector(5)), (0, 2, vector(3)), (None, 1, vector(5)), (None, 2, vector(5))]
    data += [(200, None, vector(5)), (250, 1, None), (300, 1, [1.0, None]), (350, 1, [math.nan, 1.0]),
             (400, 1, [math.inf]), (450, 1, []), (500, 99, vector(5)), (51, 1, vector(5)), (51, 1, vector(5))]
    data += [(7, 3, [0.5] * 5)] * 30
    assert mined(frame(rows, data), cell_root=3) == brute(data)


def test_cells_do_not_matter(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    one = mined(df)
    assert one and one == mined(df, cell_root=1) == mined(df, cell_bytes=1 << 14)


def test_empty_tables_and_bounds(rows):
    empty = rows([], SCHEMA)
    assert hn.mine(empty).collect() == []
    assert mined(rows([(1, 1, [1.0], 1, "x")], SCHEMA)) == []
    with pytest.raises(ValueError):
        hn.mine(rows([(50, 1, [1e12], 1, "x")], SCHEMA))
    with pytest.raises(ValueError):
        hn.mine(rows([(50, 1, [8e6] * 9, 1, "x")], SCHEMA))
