import random

import numpy as np
from pyspark.sql import functions as F

from opsmart.llm import simhash


def brute_fingerprint(text):
    import re

    import xxhash

    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(values, radius):
    parent = list(range(len(values)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if bin(values[i] ^ values[j]).count("1") <= radius:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def test_fingerprints():
    for text in ("", " \n", "a", "A b", "one two three", "One two three four\tfive", "É é É é", "x\x1cy z", "a b c a b c a b c"):
        assert simhash.fingerprint(text) == brute_fingerprint(text), text


def test_forest_joins_what_is_near():
    pick = random.Random(1)
    values = [pick.getrandbits(64) for _ in range(40)]
    for _ in range(260):
        v = pick.choice(values)
        for _ in range(pick.randint(0, 3)):
            v ^= 1 << pick.randrange(64)
        values.append(v)
    for radius in (0, 1, 2, 6):
        label = simhash.forest(np.zeros(300, np.int64), np.array(values, np.uint64), radius)
        assert label.tolist() == brute_components(values, radius)


def test_components_over_chunks_and_chains(spark):
    pick = random.Random(2)
    base = pick.getrandbits(40)
    chain = [base ^ ((1 << k) - 1) << 3 for k in range(0, 30)]  # neighbours differ in one bit
    values = sorted({*chain, *(pick.getrandbits(63) for _ in range(80))})
    rows = [(1000 - i, v) for i, v in enumerate(values)]
    classes = spark.createDataFrame(rows, "id long, fingerprint long")
    wanted = brute_components(values, 2)
    smallest = {}
    for (i, _), root in zip(rows, wanted):
        smallest[root] = min(i, smallest.get(root, i))
    want = {i: smallest[root] for (i, _), root in zip(rows, wanted)}
    for limit in (2048, 5):  # the second cuts common keys into chunks
        found = {r.node: r.root for r in simhash.components(simhash.links(classes, 2, limit)).collect()}
        assert {i: found.get(i, i) for i in want} == want


def test_documents(spark):
    rows = [(5, "a b c d"), (3, "A B  c\nd"), (9, None), (7, " "), (1, "other words stand here"), (3, "A B  c\nd"), (None, "a b c d")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "7 AS component_id")
    out = sorted((r.doc_id or -1, r.component_id) for r in simhash.near_duplicates(df).collect())
    assert out == [(-1, 3), (1, 1), (3, 3), (3, 3), (5, 3), (7, 7), (9, 7)]
    assert simhash.near_duplicates(df.limit(0)).count() == 0
    kept = simhash.one_of_each(df, 2, 3)
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 1, 3, 7]
    assert kept.columns == df.columns


def test_rows_without_id_link_others(spark, monkeypatch):
    values = {"five": 0b0000, "none": 0b0011, "nine": 0b1111, "far": -1, "two": 1 << 40}
    monkeypatch.setattr(
        simhash,
        "fingerprints",
        lambda docs, shingle: docs.select("doc_id", F.create_map(*[F.lit(x) for p in values.items() for x in p])[F.col("text")].cast("long").alias("fingerprint")),
    )
    rows = [(5, "five"), (None, "none"), (9, "nine"), (None, "far"), (2, "two")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r.doc_id, r.fingerprint): r.component_id for r in simhash.near_duplicates(df).collect()}
    # None and 9 hang on 5 through the row without id; 2 differs from 5 in one bit.
    assert found == {(5, 0): 2, (None, 3): 2, (9, 15): 2, (None, -1): None, (2, 1 << 40): 2}


def test_long_texts_in_stretches(monkeypatch):
    pick = random.Random(6)
    texts = [" ".join(pick.choice(["a", "bc", "déf", "X"]) for _ in range(n)) for n in (1, 2, 3, 50, 400)]
    texts += [t.replace(" ", "  \n") for t in texts] + ["x" * 90, " " * 70 + "a b c d", "a " + "y" * 100 + " b c"]
    for stretch in (1, 7, 64):
        monkeypatch.setattr(simhash, "STRETCH", stretch)
        assert [simhash.fingerprint(t) for t in texts] == [brute_fingerprint(t) for t in texts]
    monkeypatch.undo()
    long = "one two three four five six seven " * 1_500_000  # 51 MB
    assert simhash.fingerprint(long) == simhash.fingerprint("one two three four five six seven " * 20_000)
