import re

from brute import plain_words

from textmill.llm import license_scan as ls


def brute(text, templates=ls.TEMPLATES):
    words, places = plain_words(text), []
    for phrase, label in ls.PHRASES.items():
        own = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(own)] == own]
    labels, score = {p[1] for p in places}, 1.0 if places else 0.0
    for line in (text or "").split("\n"):
        block = set(plain_words(line))
        for label, template in templates:
            want = set(template.split())
            if len(block & want) >= ls.needed(len(want)):
                labels.add(label)
                score = max(score, len(block & want) / len(want))
    at = [p[0] for p in places]
    return (len(words), len(places), min(at, default=None), max(at, default=None),
            ",".join(sorted({p[1] for p in places})), ",".join(sorted(labels)), score)


TEXTS = [
    None, "", " \n ", "CC-BY", "cc by cc by", "cc by\ncc by", "all rights\nreserved. All Rights Reserved", "xcc by", "cc byx",
    "gnu General Public License, general public licenses general public license", "Released under the MIT License.",
    "released under mit license!", "license the under released mit mit mit", "Licensed under the Apache License, version 2",
    "permission is hereby granted\nfree of charge to any person", "word " * 30000 + "all rights reserved", "cc by" * 3,
    "Licensed under CC BY-NC 4.0.", "Éa cc by é", "all rights reserved", "all rights reserved", "copyright rights reserved all",
]


def test_against_brute_force(rows):
    df = rows([(i, t, 1, "x") for i, t in enumerate(TEXTS)], "doc_id bigint, text string, blocks int, label string")
    got = {r.doc_id: r for r in ls.scan(df).collect()}
    assert len(got) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score) == brute(text), text


def test_filters_lose_no_template(rows):
    """Every subset of a template's words, against the threshold."""
    words = "a b c d e f".split()
    texts = [" ".join(w for k, w in enumerate(words) if mask >> k & 1) + " zz" for mask in range(64)]
    df = rows(list(enumerate(texts)), "doc_id bigint, text string")
    templates = [("six", "f e d c b a"), ("three", "a c e"), ("one", "d")]
    got = {r.doc_id: r.labels for r in ls.scan(df, templates=templates).collect()}
    assert got == {i: brute(t, templates)[5] for i, t in enumerate(texts)}


def test_empty_table_and_native_plan(rows):
    empty = rows([], "doc_id bigint, text string")
    assert ls.scan(empty).collect() == []
    text = ls.scan(empty)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", text)
