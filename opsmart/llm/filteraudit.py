"""How filters interact: every order of five filters over the whole corpus.

A to D are conditions on one text; E asks whether a smaller ``doc_id`` has the same text. For E texts
are dealt into ranges and put into radix tries (compressed: an edge carries a run of bytes) whose
terminals hold the smallest id seen:

1. ``separators`` cuts the texts' order into ranges of about equal bytes. Texts are drawn by their own
   hash, in proportion to their bytes, so copies are drawn together and count once. Keys start with 64
   characters and grow eightfold where so many drawn texts share a key that it would fill a range; a
   cut is the shortest prefix that still parts its neighbours. Cuts balance the tasks and nothing else.
2. Every task puts its texts into a trie of bounded size. A row whose id is above the terminal's is
   decided there and travels without its text; of a text with a third of all rows, one row a trie
   remains.
3. The undecided rows meet in the trie of their range, and a traversal decides them.

A document is then a mask of failed filters. Masks are counted per part, at most 32 rows each, and the
figures of all 120 orders follow from the counts.

Defined results: a null text is empty; null ``lang`` is the part ``''``; a row without ``doc_id`` has
no smaller and is no smaller id, so it never fails E and never makes another fail; repeated rows count
each, and those of the smallest id do not fail E; a document with several label rows is good (toxic)
if one of them says so; other columns are not read; an empty table gives no rows.

Memory of a task: the distinct texts of its ranges (32 MB each), without copies and shared prefixes.
To the driver come 16 keys a range.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from itertools import permutations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsmart.llm.common import map_rows, table

FILTERS = "ABCDE"
MIN_WORDS = 200
#: Bytes of text in a range at most, keys drawn for each range, and characters of a first key.
RANGE_BYTES, DRAWN, KEY = 32 << 20, 16, 64
#: Bytes of text in a trie that a task fills before it passes its rows on.
LOCAL_BYTES = 32 << 20
#: What a terminal is taken to cost besides its text.
NODE_BYTES = 400
UPPER = bytes(range(ord("A"), ord("Z") + 1))
MARKS = b"#$%&*|"
CONTINUED = bytes(range(0x80, 0xC0))
E = 1 << FILTERS.index("E")
ROW = "doc_id long, part string, mask int, n long"


def failed(text: bytes) -> int:
    """The filters A to D that a text fails, as bits."""
    words = text.split()
    distinct = len(set(words))
    upper = len(text) - len(text.translate(None, UPPER))
    points = len(text.translate(None, CONTINUED))
    return (
        (len(words) < MIN_WORDS)
        | (100 * distinct < 50 * len(words)) << 1
        | (100 * upper > 3 * points) << 2
        | (len(text.translate(None, MARKS)) < len(text)) << 3
    )


def _common(label: bytes, text: bytes, at: int) -> int:
    """How many bytes of ``label`` stand in ``text`` from ``at`` on."""
    low, high = 0, min(len(label), len(text) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if label[low:middle] == text[at + low : at + middle]:
            low = middle
        else:
            high = middle - 1
    return low


class Trie:
    """Texts with, at each terminal, the smallest id and the rows of that id.

    A node is ``[edge bytes, children by first byte, terminal]``, a terminal
    ``[id, mask, {part: rows}]``.
    """

    def __init__(self):
        self.root = [b"", {}, None]
        self.bytes = 0

    def _node(self, text: bytes) -> list:
        node, at = self.root, 0
        while at < len(text):
            first = text[at]
            child = node[1].get(first)
            if child is None:
                child = node[1][first] = [text[at:], {}, None]
                self.bytes += len(text) - at + NODE_BYTES
                return child
            label = child[0]
            if text.startswith(label, at):
                node, at = child, at + len(label)
                continue
            same = _common(label, text, at)
            upper = node[1][first] = [label[:same], {label[same]: child}, None]
            child[0] = label[same:]
            self.bytes += NODE_BYTES
            node, at = upper, at + same
        return node

    def insert(self, text: bytes, doc_id: int, part: str, mask: int, n: int) -> list[tuple]:
        """The rows that this one decides: those whose id is not the smallest of their text."""
        node = self._node(text)
        held = node[2]
        if held is None:
            node[2] = [doc_id, mask, {part: n}]
        elif doc_id > held[0]:
            return [(doc_id, part, mask | E, n)]
        elif doc_id == held[0]:
            held[2][part] = held[2].get(part, 0) + n
        else:
            node[2] = [doc_id, mask, {part: n}]
            return [(held[0], p, mask | E, k) for p, k in held[2].items()]
        return []

    def rows(self, texts: bool = True) -> Iterator[tuple]:
        """The undecided rows: ``text, doc_id, part, mask, n``; without ``texts`` the text is None."""
        stack = [(self.root, b"")]
        while stack:
            node, above = stack.pop()
            text = above + node[0] if texts else None
            if node[2] is not None:
                doc_id, mask, parts = node[2]
                yield from ((text, doc_id, part, mask, n) for part, n in parts.items())
            stack.extend((child, text) for child in node[1].values())


def separators(texts: DataFrame, column: str = "text", range_bytes: int = RANGE_BYTES) -> list[bytes]:
    """Ascending prefixes that cut the texts of a binary column into ranges of about equal bytes."""
    spark = texts.sparkSession
    text = F.col(f"`{column}`")
    total = texts.agg(F.sum(F.octet_length(text))).first()[0] or 0
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    every = max(1, min(range_bytes, total // least) // DRAWN)
    own = F.xxhash64(text)
    size = F.octet_length(text)
    drawn = texts.filter(F.pmod(own, F.lit(every).cast("long")) < size).select(
        text.alias("text"), own.alias("own"), F.greatest(F.lit(1.0), size / every).alias("weight")
    )
    keys: dict[bytes, float] = {}
    length, shared = KEY, None
    while True:
        key = F.substring("text", 1, length)
        found = drawn if shared is None else drawn.filter(F.substring("text", 1, length // 8).isin(shared))
        counts = (
            found.select(key.alias("key"), "own", "weight")
            .distinct()
            .groupBy("key")
            .agg(F.sum("weight").alias("weight"), F.count("*").alias("texts"))
            .collect()
        )
        shared = [bytes(r.key) for r in counts if r.weight > DRAWN and r.texts > 1]
        keys.update((bytes(r.key), r.weight) for r in counts if not (r.weight > DRAWN and r.texts > 1))
        if not shared:
            break
        length *= 8
    cuts, filled, before = [], 0.0, b""
    for key in sorted(keys):
        if filled >= DRAWN:
            cuts.append(key[: _common(before, key, 0) + 1])
            filled = 0.0
        filled += keys[key]
        before = key
    return cuts


def _local(rows: Iterator[tuple], cuts: list[bytes], most: int) -> Iterator[tuple]:
    trie = Trie()

    def undecided() -> Iterator[tuple]:
        for text, doc_id, part, mask, n in trie.rows():
            yield doc_id, part, mask, n, bisect_right(cuts, text), text

    for doc_id, part, text in rows:
        mask = failed(text)
        if doc_id is None:
            yield doc_id, part, mask, 1, None, None
            continue
        for row in trie.insert(text, doc_id, part, mask, 1):
            yield *row, None, None
        if trie.bytes > most:
            yield from undecided()
            trie = Trie()
    yield from undecided()


def _ranges(rows: Iterator[tuple]) -> Iterator[tuple]:
    trie = Trie()
    for doc_id, part, mask, n, place, text in rows:
        if place is None:
            yield doc_id, part, mask, n
        else:
            yield from trie.insert(text, doc_id, part, mask, n)
    for _, doc_id, part, mask, n in trie.rows(texts=False):
        yield doc_id, part, mask, n


def masks(docs: DataFrame, range_bytes: int = RANGE_BYTES, local_bytes: int = LOCAL_BYTES) -> DataFrame:
    """``doc_id, part, mask, n``: the filters that ``n`` equal rows fail, as bits (A is 1, E is 16)."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("lang"), F.lit("")).alias("part"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"),
    )
    cuts = separators(rows, "text", range_bytes)
    local = map_rows(rows, ROW + ", place int, text binary", _local, cuts, local_bytes, batch=32)
    spread = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), len(cuts) + 1)
    dealt = local.repartition(spread, F.coalesce("place", -1 - F.pmod("doc_id", F.lit(1 << 20)), F.lit(-1)))
    return map_rows(dealt, ROW, _ranges)


def figures(spark: SparkSession) -> DataFrame:
    """For every mask, order and step what one document adds to the figures: 19,200 fixed rows."""
    rows = []
    for order in permutations(FILTERS):
        before = 0
        for step, name in enumerate(order, 1):
            bit = 1 << FILTERS.index(name)
            for mask in range(1 << len(FILTERS)):
                fails, earlier = bool(mask & bit), bool(mask & before)
                share = 120 // mask.bit_count() if fails else 0
                rows.append(
                    ("".join(order), step, mask, int(not (fails or earlier)), int(fails and not earlier),
                     int(fails and earlier), int(mask == bit), share)
                )
            before |= bit
    schema = "filter_order string, step int, mask int, kept int, removed int, redundant int, alone int, share int"
    return spark.createDataFrame(rows, schema)


def audit(docs: DataFrame, labels: DataFrame, **sizes: int) -> DataFrame:
    """The figures of every part, order and step; ``sizes`` go to ``masks``."""
    spark = docs.sparkSession
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"),
        F.max((F.col("toxic") == 1).cast("int")).alias("toxic"),
    )
    rows = masks(docs, **sizes).groupBy("doc_id", "part", "mask").agg(F.sum("n").alias("n"))
    marked = rows.join(marks, "doc_id", "left")
    counted = marked.groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("good"),
        F.sum(F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic"),
    )

    def total(count: str, factor: str, name: str):
        return F.sum(F.col(count) * F.col(factor)).cast("long").alias(name)

    return (
        counted.join(F.broadcast(figures(spark)), "mask")
        .groupBy("part", "filter_order", "step")
        .agg(
            total("n", "kept", "kept"),
            total("n", "removed", "removed"),
            total("n", "redundant", "redundant"),
            total("n", "alone", "unique_fails"),
            total("good", "removed", "good_lost"),
            total("toxic", "removed", "toxic_lost"),
            total("n", "share", "shapley"),
        )
    )


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders of the five filters over ``documents``."""
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP11_SQL = r"""
WITH RECURSIVE texts AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents
),
marks AS (
    SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
        max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
    FROM labels GROUP BY doc_id
),
failing AS (
    SELECT t.part, coalesce(m.good, 0) AS good, coalesce(m.toxic, 0) AS toxic,
        CASE WHEN len(t.words) < 200 THEN 'A' ELSE '' END
        || CASE WHEN 100 * len(list_distinct(t.words)) < 50 * len(t.words) THEN 'B' ELSE '' END
        || CASE WHEN 100 * length(regexp_replace(t.text, '[^A-Z]', '', 'g')) > 3 * length(t.text) THEN 'C' ELSE '' END
        || CASE WHEN regexp_matches(t.text, '[#$%&*|]') THEN 'D' ELSE '' END
        || CASE WHEN t.doc_id > min(t.doc_id) OVER (PARTITION BY t.text) THEN 'E' ELSE '' END AS fails
    FROM texts t LEFT JOIN marks m ON t.doc_id = m.doc_id
),
counted AS (
    SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failing GROUP BY part, fails
),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter),
orders AS (
    SELECT letter AS filter_order FROM letters
    UNION ALL
    SELECT o.filter_order || l.letter FROM orders o JOIN letters l ON NOT contains(o.filter_order, l.letter)
),
steps AS (
    SELECT filter_order, step, substr(filter_order, step, 1) AS letter, substr(filter_order, 1, step - 1) AS before
    FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step) WHERE length(filter_order) = 5
),
applied AS (
    SELECT c.*, s.*, contains(fails, letter) AS failing,
        before <> '' AND length(translate(fails, before, '')) < length(fails) AS earlier
    FROM counted c, steps s
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step,
    CAST(sum(CASE WHEN NOT failing AND NOT earlier THEN n ELSE 0 END) AS BIGINT) AS kept,
    CAST(sum(CASE WHEN failing AND NOT earlier THEN n ELSE 0 END) AS BIGINT) AS removed,
    CAST(sum(CASE WHEN failing AND earlier THEN n ELSE 0 END) AS BIGINT) AS redundant,
    CAST(sum(CASE WHEN fails = letter THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
    CAST(sum(CASE WHEN failing AND NOT earlier THEN good ELSE 0 END) AS BIGINT) AS good_lost,
    CAST(sum(CASE WHEN failing AND NOT earlier THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost,
    CAST(sum(CASE WHEN failing THEN n * 120 // length(fails) ELSE 0 END) AS BIGINT) AS shapley
FROM applied GROUP BY part, filter_order, step
"""
