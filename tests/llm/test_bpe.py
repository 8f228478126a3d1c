import base64
import hashlib
import random

import pytest

from opsmart.llm import bpe

tiktoken = pytest.importorskip("tiktoken")


@pytest.fixture(scope="module")
def own():
    return bpe.codec(*bpe.default_vocabulary())


@pytest.fixture(scope="module")
def library(own):
    path, pattern = bpe.default_vocabulary()
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def texts():
    pick = random.Random(5)
    parts = ["a", "b", " ", "  ", "\n", "\t", "'s", "'ll", "é", "ü", "中", "😀", "1", "½", "%%", "\x1c", "\xa0", "hello", " world"]
    yield from ("", " ", "a" * 3000, "ab" * 2000, "=" * 500 + "x", "\x85​ x", "na" * 40 + " " * 40)
    for _ in range(400):
        yield "".join(pick.choice(parts) for _ in range(pick.randint(0, 30)))


def test_equals_the_library_and_round_trips(own, library):
    every = list(texts())
    for text, (ids, data) in zip(every, own.written(every)):
        wanted = library.encode_ordinary(text)
        assert ids == " ".join(map(str, wanted))
        assert own.encode(text) == wanted
        assert data == text.encode() == own.decode(wanted)


def test_memory_is_bounded(own, monkeypatch):
    monkeypatch.setattr(bpe, "MEMORY", 10)
    for _ in range(3):
        list(own.written([" ".join(f"w{i}q" for i in range(40))]))
    assert len(own.ids_of) < 100


def test_query_rows(spark):
    rows = [(1, "one two"), (2, None), (2, ""), (None, "one two"), (1, "one two")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS n_tokens")
    out = bpe.digests(df).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert len(out) == 5
    assert [r for r in out if r.doc_id == 2] == [(2, 0, empty, empty)] * 2
    assert all(r.decoded_sha256 == hashlib.sha256(b"one two").hexdigest() for r in out if r.n_tokens)
    assert bpe.digests(df.limit(0)).count() == 0
    assert {r.decoded for r in bpe.encode(df).collect()} == {"one two", ""}


def test_a_text_of_many_megabytes():
    codec = bpe.codec(*bpe.default_vocabulary())
    text = "some ordinary words, and 12345 more of them. " * 120_000 + "x" * 300_000  # 5.7 MB
    ids = codec.encode(text)
    assert codec.decode(ids) == text.encode()
    assert ids[: len(ids) // 3] == codec.encode(text[:2_500_000])[: len(ids) // 3]
