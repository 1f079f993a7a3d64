import zlib

import pyarrow as pa
from pyspark.sql import functions as F

from textmill.llm import language_id


def test_held_out_accuracy(spark):
    from textmill.llm.queries import op1_language_id

    folder = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = op1_language_id(spark, folder).collect()
    assert len(got) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    out = [r for r in got if r.held_out]
    right = [r for r in out if r.lang_pred == truth[r.doc_id]]
    assert len(right) >= 0.97 * len(out)
    assert all(0 <= r.score <= 1 for r in got)
    assert sum(r.rejected for r in right) <= 0.05 * len(right)


def labelled(rows, extra=()):
    data = [(i, "the cat and the dog went home " * (1 + i % 3), "en") for i in range(0, 60, 2)]
    data += [(i, "der hund und die katze gehen heim " * (1 + i % 3), "de") for i in range(1, 60, 2)]
    return rows([(*r, "z", 1) for r in [*data, *extra]], "doc_id bigint, text string, lang string, _lang string, buckets int")


def test_edges(rows):
    extra = [(100, None, "en"), (101, "", "de"), (102, "12 ?! 34", "en"), (103, "the dog", None), (None, "die katze", "de"),
             (104, "the dog went home", "en"), (104, "the dog went home", "en"), (105, "und die katze " * 30000, "de")]
    df = labelled(rows, extra)
    model = language_id.fit(df)
    assert model.languages == ["de", "en"]
    got = {}
    for r in language_id.predict(df, model).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert [got[i][0].lang_pred for i in (100, 101, 102)] == ["und"] * 3
    assert all(got[i][0].score == 0 and got[i][0].rejected for i in (100, 101, 102))
    assert got[103][0].lang_pred == "en" and got[None][0].lang_pred == "de" and got[105][0].lang_pred == "de"
    assert len(got[104]) == 2 and got[104][0] == got[104][1]
    assert language_id.predict(df.limit(0), model).collect() == []


def test_foreign_texts_are_rejected(rows):
    model = language_id.fit(labelled(rows))
    odd = rows([(1, "xqzw jjkkv qqxz wvvk zzqj")], "doc_id bigint, text string")
    sure = rows([(1, "the cat went home and the dog")], "doc_id bigint, text string")
    assert language_id.predict(odd, model).first().score < language_id.predict(sure, model).first().score


def test_without_labels_all_are_unknown(rows):
    df = labelled(rows).withColumn("lang", F.lit(None).cast("string"))
    model = language_id.fit(df)
    assert model is None
    assert {r.lang_pred for r in language_id.predict(df, model).collect()} == {"und"}


def test_subwords_are_each_texts_own():
    together = language_id.subwords(pa.array(["Abc d", None, "1", "abc D"]))
    alone = language_id.subwords(pa.array(["abc d"]))
    buckets, firsts, has = together
    assert has.tolist() == [True, False, False, True]
    assert sorted(buckets[firsts[0] : firsts[1]]) == sorted(buckets[firsts[3] : firsts[4]]) == sorted(alone[0])
    assert len(alone[0]) == 9 + 3  # abc: 4 pairs, 3 triples, 2 fours; d: 2 pairs, 1 triple
