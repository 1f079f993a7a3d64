import random

from brute import contamination

from textmill.llm.decontamination import contaminated, postings


def checked(df, items, data, given):
    want = contamination(data, given)
    got = contaminated(df, items).collect()
    assert len(got) == len(data)
    for r in got:
        n_words, n_hit, found = want[r.doc_id]
        assert (r.n_words, r.n_hit, list(r.items)) == (n_words, n_hit, found), r.doc_id
        assert r.contaminated == (n_hit > 0 and 20 * n_hit >= n_words)
        assert r.n_items == len(found)
    return {r.doc_id: r for r in got}


def test_whole_tables(spark):
    folder = "/root/testdata/sf0.01"
    docs, items = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    got = checked(
        docs, items, [(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()]
    )
    assert any(r.contaminated for r in got.values())


def test_windows_overlaps_and_short_items(rows):
    pick = random.Random(8)
    word = lambda: pick.choice("abcde") + pick.choice("xyz")
    item = [word() for _ in range(30)]
    data = [
        (1, " ".join(item)), (2, " ".join(item[3:16])), (3, " ".join(item[3:15])), (4, None), (5, ""),
        (6, "Q! " + "-".join(item[5:25]).upper() + " q " + " ".join(item[10:28])),
        (7, " ".join(word() for _ in range(4000))), (8, "short one here"), (9, "a short one, here"),
        (10, " ".join([*item[:13], "zz", *item[13:26]])), (11, "cc dd " * 40), (12, " ".join(item * 3)),
    ]
    given = [(1, " ".join(item)), (2, "short one here"), (3, None), (4, ""), (5, "cc dd " * 10), (1, " ".join(item[:20])),
             (6, "nowhere at all")]
    docs = rows([(i, t, 3) for i, t in data], "doc_id bigint, text string, term int")
    items = rows([(i, t, 4) for i, t in given], "item_id bigint, text string, doc_id int")
    got = checked(docs, items, data, given)
    assert got[3].n_hit == 0 and got[3].near_items == 1  # twelve words: near, but no window


def test_empty_tables(rows):
    docs, items = rows([(1, "a b")], "doc_id bigint, text string"), rows([(1, "a b")], "item_id bigint, text string")
    assert contaminated(docs.limit(0), items).collect() == []
    row = contaminated(docs, items.limit(0)).first()
    assert (row.n_words, row.n_hit, row.contaminated) == (2, 0, False)


def test_null_and_repeated_ids(rows):
    docs = rows([(None, "one two"), (1, "one two"), (1, "one two")], "doc_id bigint, text string")
    items = rows([(None, "one two"), (3, "one two")], "item_id bigint, text string")
    assert sorted((r.doc_id or 0, r.n_hit, tuple(r["items"])) for r in contaminated(docs, items).collect()) == [
        (0, 2, ("3",)), (1, 2, ("3",)), (1, 2, ("3",)),
    ]
    assert postings is not None
