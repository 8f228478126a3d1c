import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from opsmart.llm import suffixes
from opsmart.llm.suffixarray import common_prefixes, suffix_array


def test_suffix_array_and_prefixes():
    pick = random.Random(0)
    for _ in range(800):
        k = pick.choice([1, 2, 3, 26])
        text = [pick.randint(1, k) for _ in range(pick.randint(0, 60))] + [0]
        order = suffix_array(np.array(text))
        assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
        shared = common_prefixes(np.array(text), order, 7, 5)
        for x, y in zip(order, order[1:]):
            n = 0
            while n < 7 and text[x + n] == text[y + n] != 0:
                n += 1
            assert shared[y] == n


def brute(rows):
    first, out = {}, []
    texts = [(1 << 62 if i is None else i, (t or "").encode()) for i, t in rows]
    for i, t in texts:
        for p in range(len(t) - 49):
            first[t[p : p + 50]] = min(i, first.get(t[p : p + 50], i))
    for i, t in texts:
        gone = bytearray(len(t))
        for p in range(len(t) - 49):
            if first[t[p : p + 50]] < i:
                gone[p : p + 50] = b"\1" * 50
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(gone[j] and (j == 0 or not gone[j - 1]) for j in range(len(t)))
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize(("seed", "hot", "block_bytes"), [(0, 2000, 1 << 22), (1, 3, 1 << 22), (2, 2000, 3000), (3, 3, 3000)])
def test_equals_brute_force(spark, seed, hot, block_bytes):
    pick = random.Random(seed)
    letters = "ab" if seed == 1 else "abcdefgh é\0"
    base = ["".join(pick.choice(letters) for _ in range(pick.randint(10, 200))) for _ in range(12)]
    rows = []
    for i in range(120):
        text = "".join(
            pick.choice(base)[pick.randint(0, 9) : pick.randint(20, 200)]
            if pick.random() < 0.6
            else "".join(pick.choice("xyz ") for _ in range(pick.randint(0, 60)))
            for _ in range(pick.randint(0, 6))
        )
        if i % 30 == 7:
            text = "a" * pick.randint(40, 400) + text
        if i % 31 == 8:
            text = "abc" * pick.randint(40, 100)
        rows.append((pick.choice([i, i, i, 5, None]), text if i % 40 else None))
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS block")
    found = suffixes.deduplicated(df, False, hot, block_bytes).withColumn("kept", F.col("kept").cast("string"))
    got = sorted((1 << 62 if r[0] is None else r[0], *r[1:]) for r in found.collect())
    assert got == brute(rows)


def test_edges(spark):
    df = spark.createDataFrame([(1, "x" * 49), (2, "x" * 49), (3, None)], "doc_id long, text string")
    assert [r.n_removed for r in suffixes.deduplicated(df).collect()] == [0, 0, 0]
    assert suffixes.deduplicated(df.limit(0)).count() == 0


def test_only_repeats_are_sorted(monkeypatch):
    pick = random.Random(7)
    shared = ["".join(pick.choice("abcdef ") for _ in range(120)).encode() for _ in range(5)]
    segments = [
        b"".join(pick.choice(shared)[pick.randint(0, 30) :] + str(pick.random()).encode() * 3 for _ in range(3))
        for _ in range(40)
    ]
    docs = np.array([pick.randint(0, 30) for _ in segments])
    whole = [r.tolist() for r in suffixes.sorted_ranges(segments, docs)]
    sizes = []
    plain = suffixes.sorted_ranges

    def counted(segments, docs, span=50):
        sizes.append(sum(map(len, segments)))
        return plain(segments, docs, span)

    monkeypatch.setattr(suffixes, "sorted_ranges", counted)
    assert [r.tolist() for r in suffixes.repeated_ranges(segments, docs)] == whole
    assert sum(sizes) < 0.7 * sum(map(len, segments))
    assert suffixes.seen_twice(np.array([5, 1, 5, 2, 1 << 40, 9], np.uint64)).tolist() == [True, False, True, False, False, False]


def test_a_text_of_many_megabytes(spark):
    unit = "".join(random.Random(3).choice("abcdefgh ") for _ in range(997))
    rows = [(1, unit * 50), (2, unit * 50_000), (3, "z" * 40 + unit[:60])]  # 50 MB
    out = {r.doc_id: r for r in suffixes.deduplicated(spark.createDataFrame(rows, "doc_id long, text string"), False).collect()}
    assert (out[1].n_removed, out[2].n_bytes, out[2].n_removed, out[2].n_spans) == (0, 49_850_000, 49_850_000, 1)
    assert (out[3].n_removed, out[3].n_spans) == (60, 1)
