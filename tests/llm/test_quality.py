import numpy as np
import pyarrow as pa
import pytest

from textmill.llm import quality


def test_rejects_labelled_junk_and_keeps_good(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in quality.classify(docs, labels).collect()}
    assert len(got) == docs.count()
    known = {r.doc_id: r.quality for r in labels.collect() if r.doc_id in got}
    good, junk = ([i for i, q in known.items() if q == v] for v in (1, 0))
    assert sum(got[i].kept for i in good) >= 0.99 * len(good)
    assert sum(not got[i].kept for i in junk) >= 0.9 * len(junk)


def test_rates_by_hand(rows):
    """Shrinkage and leaving out, recomputed in plain numpy."""
    pick = np.random.default_rng(1)
    data = []
    for host in range(12):
        for i in range(int(pick.integers(1, 40))):
            path = f"{host}/{i % 3}"
            data.append((len(data), f"{host}", path, float(np.clip(pick.normal(0.2 + 0.06 * host, 0.1), 0.01, 0.99))))
    df = rows(data, "_id bigint, _level1 string, _level2 string, p double")
    out, mean = quality.combine(df, ["host", "path"])
    p = np.array([r[3] for r in data])
    assert mean == pytest.approx(p.mean())

    def strength(keys):
        groups = [p[[i for i, k in enumerate(keys) if k == key]] for key in sorted(set(keys))]
        n = sum(map(len, groups))
        apart = sum(len(g) * (g.mean() - p.mean()) ** 2 for g in groups)
        between = max((apart - sum(g.var() for g in groups)) / n, 0)
        within = sum(g.var() * len(g) for g in groups) / n
        return np.clip(within / between if between else quality.STRONGEST, quality.WEAKEST, quality.STRONGEST)

    hosts, paths = [r[1] for r in data], [r[2] for r in data]
    k1, k2 = strength(hosts), strength(paths)
    for r in out.collect():
        own = p[[i for i, h in enumerate(hosts) if h == r._level1]]
        rate1 = (own.sum() - r.p + k1 * mean) / (len(own) - 1 + k1)
        own = p[[i for i, h in enumerate(paths) if h == r._level2]]
        rate2 = (own.sum() - r.p + k2 * rate1) / (len(own) - 1 + k2)
        assert r.rate1 == pytest.approx(rate1) and r.rate2 == pytest.approx(rate2)


def test_bad_sites_pull_doubtful_documents_down(rows):
    data = [(i, "good", 0.97) for i in range(60)] + [(100 + i, "bad", 0.05) for i in range(60)] + [(200, "bad", 0.6), (201, "good", 0.6)]
    data += [(300, "alone", 0.6)]
    out, mean = quality.combine(rows(data, "_id bigint, _level1 string, p double"), ["site"])
    rate = {r._id: r.rate1 for r in out.collect()}
    assert rate[200] < 0.2 < 0.8 < rate[201]
    assert rate[300] == pytest.approx(mean)  # nothing else is known of its site


def test_edges(rows):
    schema = "doc_id bigint, text string, source string, lang string, features int, p string, _text string"
    data = [(1, None, None, "en", 1, "a", "b"), (2, "", "s", None, 1, "a", "b"), (None, "x y", "s", "en", 1, "a", "b"),
            (3, "w " * 50000, "s", "en", 1, "a", "b"), (3, "w " * 50000, "s", "en", 1, "a", "b")]
    labels = rows([(1, 1), (3, 0), (3, 1), (2, None)], "doc_id bigint, quality int")
    got = quality.classify(rows(data, schema), labels).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    same = [r for r in got if r.doc_id == 3]
    assert same[0] == same[1]
    none = quality.classify(rows(data, schema), labels.limit(0)).collect()
    assert len(none) == 5 and all(r.kept and r.score == 1 for r in none)
    assert quality.classify(rows([], schema), labels).collect() == []


def test_features_are_each_texts_own():
    texts = ["Ab cd!! 12 | x", "", None, "zz zz zz\nzz"]
    together = quality.features(pa.array(texts))
    alone = np.concatenate([quality.features(pa.array([t], pa.string())) for t in texts])
    assert np.allclose(together, alone)
