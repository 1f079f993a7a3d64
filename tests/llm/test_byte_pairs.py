import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from textmill.llm import byte_pairs

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def vocabulary():
    return byte_pairs.read_vocabulary(PATH)


@pytest.fixture(scope="module")
def library(vocabulary):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    pick = random.Random(5)
    letters = "ab'stmdrevlAZ  \n\t 12!?é中\U0001f600́½ \u0085 "
    made = ["".join(pick.choice(letters) for _ in range(pick.randrange(60))) for _ in range(1500)]
    odd = ["x" * 3000 + "ab" * 400, None, "", " ", "\n\n", "don't you'll 's we've", " 's", "'", "a  b  ", "\n's", "'ll'lll're",
           "the same", "the same", "word " * 20000, "!" * 200, "abcdefghij" * 300]
    return made + odd


def test_equals_the_library_and_round_trips(rows, vocabulary, library):
    data = list(enumerate(texts()))
    df = rows([(i, t, "x", 1) for i, t in data], "doc_id bigint, text string, _text string, ids int")
    encoded = byte_pairs.encode(df, vocabulary)
    got = {r.doc_id: r for r in encoded.collect()}
    assert len(got) == len(data)
    for i, text in data:
        assert got[i].ids == library.encode_ordinary(text or ""), text
        assert [library.decode_bytes(got[i].ids[:k]) for k in (0,)] == [b""]
        raw = (text or "").encode()
        assert [raw[o : o + 1] for o in got[i].offsets] == [library.decode_single_token_bytes(x)[:1] for x in got[i].ids]
    for frame in (byte_pairs.decode(encoded, vocabulary), byte_pairs.round_trip(df, vocabulary)):
        decoded = {r.doc_id: bytes(r.decoded) for r in frame.collect()}
        assert decoded == {i: (t or "").encode() for i, t in data}


def test_every_code_point_has_the_library_class(vocabulary, library):
    import pyarrow as pa

    points = [chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000][::7]
    made = ["a" + c + "b 1" + c + "2" + c + c + "!" + c for c in points]
    ids, _ = byte_pairs.encode_batch(pa.array(made), byte_pairs._merger(vocabulary))
    assert ids.to_pylist() == library.encode_ordinary_batch(made)


def test_cache_may_start_anew(vocabulary, library, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(byte_pairs, "CACHED_PIECES", 3)
    merger = byte_pairs._merger(vocabulary)
    for text in ("one two three four five", "six seven one two", "one two three four five"):
        assert byte_pairs.encode_batch(pa.array([text]), merger)[0].to_pylist() == [library.encode_ordinary(text)]


def test_empty_table_and_null_id(rows, vocabulary):
    empty = rows([], "doc_id bigint, text string")
    assert byte_pairs.round_trip(empty, vocabulary).collect() == []
    one = rows([(None, "hi")], "doc_id bigint, text string")
    assert bytes(byte_pairs.round_trip(one, vocabulary).first().decoded) == b"hi"


def test_query_digests(spark, library):
    from textmill.llm.queries import op7_byte_pairs

    folder = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in op7_byte_pairs(spark, folder).collect()}
    for row in spark.read.parquet(f"{folder}/documents.parquet").limit(60).collect():
        ids = library.encode_ordinary(row.text or "")
        assert got[row.doc_id].n_tokens == len(ids)
        assert got[row.doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[row.doc_id].decoded_sha256 == hashlib.sha256((row.text or "").encode()).hexdigest()
