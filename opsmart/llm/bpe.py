"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A text is cut into pre-tokens by the tokenizer's pattern. Inside a pre-token every pair of
neighbouring parts has a merge rank; the pair of lowest rank (leftmost among equals) is merged until
no pair has a rank. The queue behind that choice has one bucket per rank, holding positions of a
linked list of parts, and a three-level bitmap over the buckets: the next rank is three
find-first-set steps away whatever the length of the pre-token. An entry whose pair has changed
since it was queued is stale and skipped. A pre-token of n bytes costs O(n log n), so a text
without a single space is no problem. The new pre-tokens of some megabytes of text share one list
and one queue, so that a bucket is merged in one step.

Defined results: a null text counts as empty; an empty text has no ids; bytes that are no token of
the vocabulary raise ``KeyError`` (byte-level vocabularies hold all 256 bytes).
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from collections.abc import Iterable, Iterator
from heapq import heappop, heappush

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from opsmart.llm.common import map_rows, table, text_or_empty

#: Distinct pre-tokens whose ids a Python worker remembers before it starts afresh.
MEMORY = 300_000
#: Characters of text whose new pre-tokens are merged together.
GROUP_CHARS = 6_000_000
#: Finds a character for which latin_form() does not hold (also the four separators that the two
#: pattern libraries class differently).
BEYOND_LATIN = re.compile("[^\0-\x1b\x20-\u017f]").search
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def latin_form(pattern: str) -> str:
    """The pattern for texts without characters beyond U+017F, with its classes written out.

    The standard library's matcher has no \\p classes but is several times faster; within this
    range both find the same matches.
    """
    import regex

    for name in ("L", "N"):
        group = rf"\p{{{name}}}"
        inside = regex.compile(group).match
        spelt = "".join(f"\\u{c:04x}" for c in range(0x180) if inside(chr(c)))
        pattern = re.sub(
            r"\[[^]]*\]", lambda m, g=group, s=spelt: m[0].replace(g, s), pattern
        ).replace(group, f"[{spelt}]")
    return pattern


class Codec:
    """Encoder and decoder of one vocabulary of ranks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.ranks = ranks
        self.tokens = {i: t for t, i in ranks.items()}
        self.decimal = {i: str(i) for i in self.tokens}
        self.split_any = regex.compile(pattern).findall
        self.split_latin = re.compile(latin_form(pattern)).findall
        words = (max(ranks.values(), default=0) >> 6) + 1
        # The queue: a bucket per rank, and a bitmap of three levels over the ranks in use (the
        # third is an integer of its own). Every merge leaves it empty.
        self.buckets: list[list | None] = [None] * (words * 64)
        self.low, self.mid = [0] * words, [0] * ((words >> 6) + 1)
        self.none = len(self.buckets)  # stands behind each pre-token; no pair holds it
        self.byte_id = np.full(256, self.none, np.int64)
        for value in range(256):
            self.byte_id[value] = ranks.get(bytes([value]), self.none)
        halves = sorted(
            (ranks[t[:cut]] * self.none + ranks[t[cut:]], rank)
            for t, rank in ranks.items()
            for cut in range(1, len(t))
            if t[:cut] in ranks and t[cut:] in ranks
        )
        self.pair_keys = np.array([k for k, _ in halves] + [1 << 62], np.int64)
        self.pair_ranks = np.array([r for _, r in halves] + [-1], np.int64)
        self.ids_of: dict[str, str] = {}
        self.bytes_of: dict[str, bytes] = {}

    def split(self, text: str) -> list[str]:
        """The matches of the pattern."""
        return (self.split_any if BEYOND_LATIN(text) else self.split_latin)(text)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token."""
        rank_of = self.ranks.get
        if (known := rank_of(piece)) is not None:
            return [known]
        n = len(piece)
        parts = [piece[i : i + 1] for i in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pair: list[int | None] = [None] * n  # the rank under which a position is queued now
        buckets, low, mid, top = self.buckets, self.low, self.mid, 0
        # One pass queues the pairs of the whole pre-token, each turn of the loop those that a
        # merge has made.
        fresh = range(n - 1)
        while True:
            for i in fresh:
                k = after[i]
                rank = rank_of(parts[i] + parts[k]) if k < n else None
                if rank == pair[i]:
                    continue
                pair[i] = rank
                if rank is None:
                    continue
                if (bucket := buckets[rank]) is None:
                    buckets[rank] = [i]
                    word = rank >> 6
                    low[word] |= 1 << (rank & 63)
                    mid[word >> 6] |= 1 << (word & 63)
                    top |= 1 << (word >> 6)
                else:
                    heappush(bucket, i)
            if not top:
                break
            high = (top & -top).bit_length() - 1
            bits = mid[high]
            word = high << 6 | ((bits & -bits).bit_length() - 1)
            bits = low[word]
            rank = word << 6 | ((bits & -bits).bit_length() - 1)
            bucket = buckets[rank]
            i = heappop(bucket)
            if not bucket:
                buckets[rank] = None
                low[word] = bits & (bits - 1)
                if not low[word]:
                    mid[high] &= mid[high] - 1
                    if not mid[high]:
                        top &= top - 1
            if pair[i] != rank:  # stale: merged away, or its right neighbour has grown
                fresh = ()
                continue
            j = after[i]
            parts[i] += parts[j]
            parts[j] = b""
            pair[i] = pair[j] = None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
            fresh = (before[i], i) if before[i] >= 0 else (i,)
        return [self.ranks[p] for p in parts if p]

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text, each match of the pattern by itself."""
        return [i for piece in self.split(text) for i in self.merge(piece.encode())]

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join([self.tokens[i] for i in ids])

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge rank of each pair of ids, -1 where it has none."""
        keys = np.where((left < self.none) & (right < self.none), left * self.none + right, -1)
        at = np.searchsorted(self.pair_keys, keys)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], -1)

    def merge_all(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of many pre-tokens, which share one linked list and one queue.

        Merges of different pre-tokens do not touch each other, so a whole bucket of equal rank is
        merged in one step. Two cases depend on the order inside a pre-token: pairs of equal rank
        that overlap, and a merge that makes a pair of lower rank. Pre-tokens that show one are
        merged again by themselves, position by position.
        """
        if not pieces:
            return []
        sizes = np.array([len(p) + 1 for p in pieces])
        ends = np.cumsum(sizes) - 1
        n = int(ends[-1]) + 1
        ids = self.byte_id[np.frombuffer(b"\0".join([*pieces, b""]), np.uint8)]
        ids[ends] = self.none
        owner = np.repeat(np.arange(len(pieces)), sizes)
        alone = np.zeros(len(pieces), bool)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[-1] = before[0] = n - 1
        pair, marked = np.full(n, -1), np.zeros(n, np.int64)
        buckets, low, mid, top = self.buckets, self.low, self.mid, 0
        fresh = np.arange(n)
        rank, step = -1, 0
        while True:
            found = self._pairs(ids[fresh], ids[after[fresh]])
            pair[fresh] = found
            if (found < rank).any():
                alone[owner[fresh[(found >= 0) & (found < rank)]]] = True
            fresh, found = fresh[found >= 0], found[found >= 0]
            if len(found):
                order = np.argsort(found, kind="stable")
                fresh, found = fresh[order], found[order]
                cuts = np.flatnonzero(found[1:] != found[:-1]) + 1
                starts = [0, *cuts.tolist(), len(found)]
                for at, upto, rank in zip(starts, starts[1:], found[starts[:-1]].tolist()):
                    if (bucket := buckets[rank]) is None:
                        buckets[rank] = [fresh[at:upto]]
                        word = rank >> 6
                        low[word] |= 1 << (rank & 63)
                        mid[word >> 6] |= 1 << (word & 63)
                        top |= 1 << (word >> 6)
                    else:
                        bucket.append(fresh[at:upto])
            if not top:
                break
            high = (top & -top).bit_length() - 1
            bits = mid[high]
            word = high << 6 | ((bits & -bits).bit_length() - 1)
            bits = low[word]
            rank = word << 6 | ((bits & -bits).bit_length() - 1)
            low[word] = bits & (bits - 1)
            if not low[word]:
                mid[high] &= mid[high] - 1
                if not mid[high]:
                    top &= top - 1
            held, buckets[rank] = buckets[rank], None
            at = held[0] if len(held) == 1 else np.concatenate(held)
            at = at[pair[at] == rank]  # the rest is stale
            gone = after[at]
            if (overlap := pair[gone] == rank).any():
                alone[owner[at[overlap]]] = True
                at = at[~alone[owner[at]]]
                gone = after[at]
            behind = after[gone]
            ids[at], ids[gone] = rank, -1
            pair[gone] = -1
            after[at], before[behind] = behind, at
            step += 1
            marked[at] = step
            left = before[at]
            fresh = np.concatenate([at, left[marked[left] != step]])
        kept = (ids >= 0) & (ids < self.none)
        upto = np.cumsum(kept)[ends].tolist()
        flat = ids[kept].tolist()
        out = [flat[i:j] for i, j in zip([0, *upto], upto)]
        for k in np.flatnonzero(alone).tolist():
            out[k] = self.merge(pieces[k])
        return out

    def written(self, texts: list[str]) -> Iterator[tuple[str, bytes]]:
        """Per text its ids in decimal joined by one space, and the bytes these ids decode to.

        Both are remembered per distinct pre-token, up to ``MEMORY`` of them and those of one call.
        """
        ids_of, bytes_of, decimal = self.ids_of, self.bytes_of, self.decimal
        if len(ids_of) > MEMORY:
            ids_of.clear()
            bytes_of.clear()
        cut = [self.split(text) for text in texts]
        new = sorted(set().union(*(set(pieces).difference(ids_of) for pieces in cut)))
        for piece, ids in zip(new, self.merge_all([p.encode() for p in new])):
            ids_of[piece] = " ".join([decimal[i] for i in ids])
            bytes_of[piece] = self.decode(ids)
        for pieces in cut:
            yield " ".join(map(ids_of.__getitem__, pieces)), b"".join(
                map(bytes_of.__getitem__, pieces)
            )


@functools.lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    """The vocabulary file's codec, read once per Python process.

    The file belongs to an installed library, so it is on every machine that can run the task.
    """
    with open(path, "rb") as file:
        ranks = {base64.b64decode(t): int(i) for t, i in map(bytes.split, file)}
    return Codec(ranks, pattern)


def _groups(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
    """Rows in groups of about ``GROUP_CHARS`` characters; a longer text is a group of its own."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[1]) + 100
        if size >= GROUP_CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


def _digests(rows: Iterator[tuple], path: str, pattern: str) -> Iterator[tuple]:
    own = codec(path, pattern)
    for group in _groups(rows):
        for (doc_id, _), (ids, data) in zip(group, own.written([text for _, text in group])):
            yield (
                doc_id,
                ids.count(" ") + 1 if ids else 0,
                hashlib.sha256(ids.encode()).hexdigest(),
                hashlib.sha256(data).hexdigest(),
            )


def _ids(rows: Iterator[tuple], path: str, pattern: str) -> Iterator[tuple]:
    own = codec(path, pattern)
    for group in _groups(rows):
        for (doc_id, _), (ids, data) in zip(group, own.written([text for _, text in group])):
            yield doc_id, [int(i) for i in ids.split()], data.decode("utf-8", "replace")


def default_vocabulary() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def encode(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``doc_id``, its token ids and the text those decode to; one row per row of ``docs``."""
    own_path, own_pattern = default_vocabulary()
    return map_rows(
        docs.select("doc_id", text_or_empty()),
        "doc_id long, ids array<int>, decoded string",
        _ids,
        path or own_path,
        pattern or own_pattern,
    )


def digests(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """Per document the number of tokens and digests of the ids and of the decoded bytes."""
    own_path, own_pattern = default_vocabulary()
    return map_rows(
        docs.select("doc_id", text_or_empty()),
        SCHEMA,
        _digests,
        path or own_path,
        pattern or own_pattern,
    )


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every whole document."""
    return digests(table(spark, sf_dir, "documents"))
