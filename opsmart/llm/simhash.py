"""SimHash near-duplicates by bit-sliced comparison.

1. Every text gets a 64-bit fingerprint: a bit is set if it is set in more than half of the XXH64
   values of the text's word shingles.
2. Equal fingerprints form one class, so copies cost one row however many there are.
3. Two fingerprints within ``radius`` differing bits agree on whole blocks of bits: with
   ``radius + 2`` blocks at least two agree. Each class is dealt out once per choice of two blocks.
4. Inside such a bucket the fingerprints are stored as 64 vertical bit planes. Comparing all rows
   with those ``shift`` places further is a few word operations per plane; carry-save counters hold
   64 distances per word, and a word is abandoned once all of its 64 pairs exceed the radius.
5. A bucket gives a spanning forest of its links, not all pairs; the forests of all buckets are
   joined by star contraction, whose rounds are written to the shared folder.

A key that more than ``limit`` classes share is split into chunks, and every pair of chunks is a
bucket of its own, so no link is lost and no task holds more than two chunks of one key.

Defined results: a null or blank text has fingerprint zero and links like any other; rows with a
null ``doc_id`` take part and can only be chosen as component id if no other row is reachable.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opsmart.llm.common import importable, map_rows, stored, table, tasks, text_or_empty

RADIUS, SHINGLE, SEED, LIMIT = 2, 3, 42, 2048
#: Bytes of a text whose shingles are hashed together, and where a stretch may end.
STRETCH = 1 << 20
BLANK = re.compile(rb"[ \t-\r]")


# --- fingerprints ---


def _stretches(data: bytes, shingle: int) -> Iterator[list[bytes]]:
    """The words of a text in stretches of about ``STRETCH`` bytes; each begins with the last
    ``shingle - 1`` words of the one before, so every shingle lies in exactly one."""
    held: list[bytes] = []
    at = 0
    while at < len(data):
        gap = BLANK.search(data, at + STRETCH)
        end = gap.start() if gap else len(data)
        words = held + data[at:end].split()  # at space and bytes 9 to 13
        at = end
        if len(words) >= shingle:
            yield words
            held = words[len(words) - shingle + 1 :]
        else:
            held = words


def fingerprint(text: str, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The 64-bit fingerprint of one text; zero without a word. Holds one stretch of a text."""
    import xxhash

    hashed = xxhash.xxh64_intdigest
    data = text.encode().lower()  # lowers A-Z only
    counts, total = np.zeros(64, np.int64), 0
    for words in _stretches(data, shingle):
        line = b" ".join(words)
        ends = list(itertools.accumulate(map(len, words), lambda a, b: a + b + 1))
        starts = [0, *[e + 1 for e in ends[: len(ends) - shingle]]]
        values = [hashed(line[a:b], seed) for a, b in zip(starts, ends[shingle - 1 :])]
        bits = np.unpackbits(np.array(values, "<u8").view(np.uint8), bitorder="little")
        counts += bits.reshape(-1, 64).sum(axis=0, dtype=np.int64)
        total += len(values)
    if not total:
        words = data.split()  # fewer words than a shingle has
        return hashed(b" ".join(words), seed) if words else 0
    return int(np.packbits(counts * 2 > total, bitorder="little").view("<u8")[0])


def _fingerprints(rows: Iterator[tuple], shingle: int) -> Iterator[tuple]:
    for doc_id, text in rows:
        value = fingerprint(text, shingle)
        yield doc_id, value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id`` and its fingerprint as a signed long."""
    return map_rows(
        docs.select("doc_id", text_or_empty()),
        "doc_id long, fingerprint long",
        _fingerprints,
        shingle,
    )


# --- links ---


def bit_planes(values: np.ndarray) -> np.ndarray:
    """64 rows of packed bits: bit i of row p is bit p of ``values[i]``; one spare word at the end."""
    n = len(values)
    bits = np.unpackbits(values.astype("<u8").view(np.uint8), bitorder="little").reshape(n, 64)
    words = -(-n // 64) + 1
    padded = np.zeros((64, words * 64), np.uint8)
    padded[:, :n] = bits.T
    return np.packbits(padded, axis=1, bitorder="little").view("<u8")


def near_pairs(planes: np.ndarray, shift: int, pairs: np.ndarray, radius: int) -> np.ndarray:
    """Those i of ``pairs`` (sorted) for which rows i and i + shift differ in at most ``radius`` bits.

    ``counter`` holds the distances of 64 pairs per word, one plane of counter bits each; ``over``
    marks the pairs whose distance exceeds the radius.
    """
    words, jump, by = planes.shape[1], shift >> 6, np.uint64(shift & 63)
    wanted = np.zeros(words * 64, np.uint8)
    wanted[pairs] = 1
    wanted = np.packbits(wanted, bitorder="little").view("<u8")
    active = np.flatnonzero(wanted)
    over = ~wanted[active]
    counter = [np.zeros(len(active), np.uint64) for _ in range((radius + 1).bit_length())]
    for p in range(64):
        plane = planes[p]
        there = plane[np.minimum(active + jump, words - 1)]
        if by:
            following = plane[np.minimum(active + jump + 1, words - 1)]
            there = (there >> by) | (following << (np.uint64(64) - by))
        carry = plane[active] ^ there
        for k, bits in enumerate(counter):
            counter[k], carry = bits ^ carry, bits & carry
        over |= carry  # the counter has overflowed
        equal = ~over  # pairs that stand at radius + 1 now
        for k, bits in enumerate(counter):
            equal &= bits if (radius + 1) >> k & 1 else ~bits
        over |= equal
        if p & 3 == 3:
            alive = np.flatnonzero(~over)
            if not len(alive):
                return np.zeros(0, np.int64)
            if len(alive) < len(active):
                active, over = active[alive], over[alive]
                counter = [bits[alive] for bits in counter]
    bits = np.unpackbits((~over).view(np.uint8), bitorder="little").reshape(-1, 64)
    word, bit = np.nonzero(bits)
    return active[word] * 64 + bit


def forest(keys: np.ndarray, values: np.ndarray, radius: int) -> np.ndarray:
    """For each row the first row that it is linked to, directly or through others of its key.

    ``keys`` are sorted; only rows of one key are compared.
    """
    n = len(keys)
    label = np.arange(n)
    last = np.searchsorted(keys, keys, side="right") - 1
    planes = bit_planes(values)
    pairs, shift = np.flatnonzero(last > label), 1
    while len(pairs):
        near = near_pairs(planes, shift, pairs, radius)
        a, b = near, near + shift
        while len(a):
            while (label[label] != label).any():
                label = label[label]
            low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
            apart = low != high
            a, b, low, high = a[apart], b[apart], low[apart], high[apart]
            np.minimum.at(label, high, low)
        shift += 1
        pairs = pairs[pairs + shift <= last[pairs]]
    while (label[label] != label).any():
        label = label[label]
    return label


def block_keys(value: Column, radius: int) -> list[Column]:
    """One key for each choice of two of ``radius + 2`` blocks of bits."""
    count = radius + 2
    edges = [64 * i // count for i in range(count + 1)]
    blocks = [
        F.shiftrightunsigned(value, a).bitwiseAND(F.lit((1 << (b - a)) - 1))
        for a, b in zip(edges, edges[1:])
    ]
    return [
        F.xxhash64(F.lit(i), F.lit(j), blocks[i], blocks[j])
        for i, j in itertools.combinations(range(count), 2)
    ]


def links(classes: DataFrame, radius: int = RADIUS, limit: int = LIMIT) -> DataFrame:
    """``(a, b)``: a spanning forest of the links inside each bucket, between ids of classes.

    ``classes`` has ``id`` and ``fingerprint``, each fingerprint once. Two classes within the
    radius are connected through these edges. Keys are 64-bit hashes of their bits; a collision
    only puts strangers into one bucket, where they are compared like the others.
    """
    spark = classes.sparkSession
    importable(spark)
    dealt = classes.select(
        "id", "fingerprint", F.explode(F.array(*block_keys(F.col("fingerprint"), radius))).alias("key")
    )
    sizes = dealt.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    pieces = dealt.join(sizes, "key").withColumn("chunks", F.ceil(F.col("n") / limit).cast("int"))
    own = F.pmod(F.xxhash64("fingerprint", F.lit(7)), F.col("chunks")).cast("int")
    partner = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    pieces = (
        pieces.withColumn("own", own)
        .withColumn("partner", partner)
        .select(
            "id",
            "fingerprint",
            F.xxhash64("key", F.least("own", "partner"), F.greatest("own", "partner")).alias("key"),
        )
    )
    groups = tasks(spark, 6 * classes.count(), 100_000)

    def compare(group: pa.Table) -> pa.Table:
        key = group.column("key").to_numpy()
        order = np.argsort(key, kind="stable")
        ids = group.column("id").to_numpy()[order]
        values = group.column("fingerprint").to_numpy()[order].view(np.uint64)
        label = forest(key[order], values, radius)
        moved = np.flatnonzero(label != np.arange(len(label)))
        return pa.table({"a": ids[moved], "b": ids[label[moved]]})

    return (
        pieces.withColumn("bucket", F.pmod("key", F.lit(groups)))
        .groupBy("bucket")
        .applyInArrow(compare, "a long, b long")
    )


# --- components ---


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``: root is the smallest node reachable.

    Alternates the two star contractions: every node hangs its larger neighbours, then its smaller
    ones, under the smallest of them. The minimum per node is combined before the shuffle and joined
    back, so a node with very many neighbours is an ordinary skewed join. Each round is stored.
    """
    edges = stored(_ordered(edges), "edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Larger neighbours of a node go under the smallest of its neighbourhood.
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        edges = stored(_ordered(large), "edges")
        # The node itself and its smaller neighbours go under the smallest of them.
        low = edges.groupBy("a").agg(F.min("b").alias("low"))
        joined = edges.join(low, "a")
        small = joined.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(
            low.select("a", F.col("low").alias("b"))
        )
        edges = stored(_ordered(small), "edges")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = tuple(state)


def _ordered(edges: DataFrame) -> DataFrame:
    """Each edge once, larger node first, without loops."""
    return (
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .filter("a <> b")
        .distinct()
    )


def near_duplicates(
    docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE, limit: int = LIMIT
) -> DataFrame:
    """``doc_id``, ``fingerprint`` (long) and ``component_id`` for every row of ``docs``."""
    found = stored(fingerprints(docs, shingle), "fingerprints")
    classes = stored(
        found.groupBy("fingerprint").agg(F.min("doc_id").alias("id")), "fingerprint-classes"
    )
    # Each fingerprint is its class's own id, also where no row of the class has a ``doc_id``.
    roots = components(links(classes.select(F.col("fingerprint").alias("id"), "fingerprint"), radius, limit))
    placed = classes.join(roots, classes["fingerprint"] == roots["node"], "left").withColumn(
        "root", F.coalesce("root", "fingerprint")
    )
    smallest = placed.groupBy("root").agg(F.min("id").alias("component_id"))
    placed = placed.join(smallest, "root").select("fingerprint", "component_id")
    return found.join(placed, "fingerprint").select("doc_id", "fingerprint", "component_id")


def one_of_each(docs: DataFrame, radius: int, shingle: int) -> DataFrame:
    """The rows of ``docs`` without those whose component has a smaller ``doc_id``.

    Of repeated rows with one ``doc_id`` one stays. Rows without ``doc_id`` cannot be named by a
    component and all stay.
    """
    named = docs.filter("doc_id is not null")
    kept = (
        near_duplicates(named, radius, shingle)
        .filter("doc_id = component_id")
        .select("doc_id")
        .distinct()
    )
    chosen = named.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return chosen.unionByName(docs.filter("doc_id is null"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id",
    )
