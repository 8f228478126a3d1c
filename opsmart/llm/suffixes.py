"""Exact substring dedup: bytes of any 50-byte string that starts in an earlier document go.

Every 50-byte string has an anchor, the smallest hash among its 16-byte substrings. Equal strings have
equal anchors, so all places of a string meet if documents are dealt out by anchor; neighbouring
strings mostly share theirs, so the text around an anchor travels as one segment.

1. Documents are dealt into blocks of some megabytes. Each block names its anchors, with the number of
   its documents that have them; an anchor of two or more documents is shared, and its blocks are told.
2. Each block sends the segments of its shared anchors, every distinct one once with the smallest of
   its documents. Segments of one anchor land in one shard.
3. A shard puts the distinct segments of its anchors side by side, without the stretches whose strings
   have a rolling hash of their own, builds their suffix array by induced sorting and the permuted
   common prefixes, and so finds the runs of suffixes that share 50 bytes. Strings that also start in a
   smaller document are answered to the blocks that hold them.
4. Each block removes what it was told, and what it knows itself from equal segments inside it.

An anchor of more than ``HOT`` documents does not travel as segments: each of its 50-byte strings is
dealt out by its own hash, where equal ones collapse into one before sorting. So no shard depends on
how common a passage is, and what one string costs a shard is one entry per block.

Segments are told apart by anchor and a 64-bit polynomial hash together. Defined results: a null text
counts as empty; matches never cross documents; rows with one ``doc_id`` do not remove each other, and
rows without ``doc_id`` come after all others.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsmart.llm.common import importable, stored, table, text_or_empty
from opsmart.llm.suffixarray import common_prefixes, suffix_array

#: Length of a duplicated string, of the substrings an anchor is chosen from.
SPAN, GRAM = 50, 16
#: Bytes of text in a block, and anchors in a bucket of the first exchange.
BLOCK_BYTES, BUCKET_ANCHORS = 4 << 20, 1 << 20
#: Documents of an anchor from which its strings are dealt one by one.
HOT = 2000
#: Strings of one anchor in a row from which a segment is cut into its strings.
LONG = 128
#: Bytes that are hashed at a time.
PART = 1 << 18

_RANDOM = np.random.default_rng(50)
_BYTE = _RANDOM.integers(0, 1 << 64, (2, 256), np.uint64)
_ODD = _RANDOM.integers(0, 1 << 63, 8, np.uint64) * np.uint64(2) + np.uint64(1)
_LAST = np.iinfo(np.int64).max


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x *= _ODD[6]
    x ^= x >> np.uint64(29)
    return x


def anchors(data: np.ndarray, span: int = SPAN, gram: int = GRAM) -> np.ndarray:
    """For every start of a ``span``-byte string its anchor."""
    hashes, width = _BYTE[0][data], 1
    while width < gram:
        hashes = hashes[:-width] * _ODD[width.bit_length()] + hashes[width:]
        width *= 2
    hashes = _mixed(hashes)
    grams, width = span - gram + 1, 1
    while 2 * width <= grams:
        hashes = np.minimum(hashes[:-width], hashes[width:])
        width *= 2
    if width < grams:
        hashes = np.minimum(hashes[: -(grams - width)], hashes[grams - width :])
    return hashes


@dataclass
class Pieces:
    """Stretches of text by anchor: key, content hash, start and end in the part, document."""

    key: np.ndarray
    content: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray

    def where(self, chosen: np.ndarray) -> Pieces:
        return Pieces(*(getattr(self, n)[chosen] for n in ("key", "content", "start", "end", "doc")))


def _powers(base: np.uint64, count: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_INVERSE = np.uint64(pow(int(_ODD[7]), -1, 1 << 64))


class Part:
    """Some documents' bytes side by side, and what is known about their strings."""

    def __init__(self, texts: list[bytes], span: int = SPAN):
        self.span = span
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        sizes = np.array([len(t) for t in texts])
        self.starts = np.cumsum(sizes) - sizes
        usable = np.maximum(sizes - span + 1, 0)
        if usable.sum():
            found = anchors(self.data, span)
            self.doc = np.repeat(np.arange(len(texts)), usable)
            at = np.arange(len(self.doc)) - np.repeat(np.cumsum(usable) - usable, usable)
            self.at = at + self.starts[self.doc]
            self.anchor = found[self.at]
            turn = (self.anchor[1:] != self.anchor[:-1]) | (self.doc[1:] != self.doc[:-1])
            self.first = np.append(0, np.flatnonzero(turn) + 1)
        else:
            self.doc = self.at = self.first = np.zeros(0, np.int64)
            self.anchor = np.zeros(0, np.uint64)

    def runs(self) -> tuple[np.ndarray, np.ndarray]:
        """Anchor and document of every run of strings with one anchor."""
        return self.anchor[self.first], self.doc[self.first]

    def pieces(self, shared: np.ndarray, hot: np.ndarray) -> Pieces:
        """The segments of shared anchors; strings one by one where these are hot or runs are long."""
        anchor, doc = self.runs()
        count = np.diff(np.append(self.first, len(self.at)))
        known = _among(anchor, shared)
        single = known & (_among(anchor, hot) | (count > LONG))
        whole = np.flatnonzero(known & ~single)
        start = self.at[self.first[whole]]
        end = start + count[whole] + self.span - 1
        each = _spread(self.first[single], count[single])
        start = np.concatenate([start, self.at[each]])
        end = np.concatenate([end, self.at[each] + self.span])
        key = np.concatenate([anchor[whole], self.anchor[each]])
        content = content_hash(self.data, start, end)
        by_itself = np.append(np.zeros(len(whole), bool), _among(self.anchor[each], hot))
        key = np.where(by_itself, _mixed(content), key)
        return Pieces(key, content, start, end, np.concatenate([doc[whole], self.doc[each]]))


def content_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A polynomial hash of each stretch, with its length."""
    n = len(data)
    rise = _powers(_ODD[7], n + 1)[:n]
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE[1][data] * rise)])
    fall = _powers(_INVERSE, n + 1)
    found = (sums[end] - sums[start]) * fall[start]
    return _mixed(found + (end - start).astype(np.uint64) * _ODD[0])


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are in the sorted ``known``."""
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _spread(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """All indices first, first + 1, ... of each run."""
    total = int(count.sum())
    return np.arange(total) + np.repeat(first - (np.cumsum(count) - count), count)


def _parts(docs: pa.Table):
    """The documents of a block, smallest id first, some at a time: ids, texts, their part."""
    ids = docs.column("doc_id").to_pylist()
    texts = [t.encode() for t in docs.column("text").to_pylist()]
    order = sorted(range(len(ids)), key=lambda i: _LAST if ids[i] is None else ids[i])
    at = 0
    while at < len(order):
        upto, size = at, 0
        while upto < len(order) and (upto == at or size + len(texts[order[upto]]) <= PART):
            size += len(texts[order[upto]])
            upto += 1
        chosen = order[at:upto]
        own = [texts[i] for i in chosen]
        yield [ids[i] for i in chosen], own, Part(own)
        at = upto


def _numbers(ids: list) -> np.ndarray:
    return np.array([_LAST if i is None else i for i in ids], np.int64)


def _packed(data: bytes | np.ndarray) -> bytes:
    """Bytes as they travel: their number and a Zstandard frame."""
    raw = data if isinstance(data, bytes) else data.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def _unpacked(data: bytes) -> bytes:
    size = int.from_bytes(data[:8], "little")
    return pa.decompress(data[8:], size, "zstd", asbytes=True)


def _words(column: pa.ChunkedArray, dtype, packed: bool = False) -> list[np.ndarray]:
    return [np.frombuffer(_unpacked(b) if packed else b, dtype) for b in column.to_pylist()]


# --- 1: which anchors are shared ---


def _named(buckets: int):
    def run(docs: pa.Table) -> pa.Table:
        block = docs.column("block")[0].as_py()
        found = []
        for _, _, part in _parts(docs):
            anchor, doc = part.runs()
            order = np.lexsort((doc, anchor))
            anchor, doc = anchor[order], doc[order]
            once = np.append(True, (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1]))[: len(anchor)]
            found.append(anchor[once])
        every, count = np.unique(np.concatenate(found), return_counts=True)
        count = np.minimum(count, 1 << 15).astype("<u2")
        bucket = (every % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
        rows = [
            (block, b, every[order[i:j]].tobytes(), count[order[i:j]].tobytes())
            for b, (i, j) in enumerate(zip(cuts, cuts[1:]))
            if j > i
        ]
        return _table(rows, _NAMED)

    return run


_NAMED = pa.schema(
    {"block": pa.int64(), "bucket": pa.int64(), "anchors": pa.binary(), "counts": pa.binary()}
)
_SHARED = pa.schema({"block": pa.int64(), "shared": pa.binary(), "hot": pa.binary()})


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _sharing(hot_from: int):
    """Per block of one bucket its anchors that two or more documents have."""

    def run(named: pa.Table) -> pa.Table:
        return _shared_rows(named, hot_from)

    return run


def _shared_rows(named: pa.Table, hot_from: int) -> pa.Table:
    lists = _words(named.column("anchors"), "<u8")
    counts = np.concatenate(_words(named.column("counts"), "<u2")).astype(np.int64)
    every = np.concatenate(lists)
    order = np.argsort(every, kind="stable")
    run = np.append(0, np.cumsum(every[order][1:] != every[order][:-1]))
    total = np.bincount(run, counts[order])[run]
    documents = np.empty(len(every))
    documents[order] = total
    rows, at = [], 0
    for block, own in zip(named.column("block").to_pylist(), lists):
        number = documents[at : at + len(own)]
        shared, hot = own[number > 1], own[number > hot_from]
        if len(shared):
            rows.append((block, shared.tobytes(), hot.tobytes()))
        at += len(own)
    return _table(rows, _SHARED)


# --- 2: segments to shards ---

_SENT = pa.schema(
    {
        "shard": pa.int64(), "block": pa.int64(), "keys": pa.binary(), "docs": pa.binary(),
        "sizes": pa.binary(), "data": pa.binary(),
    }
)


def _told(shared: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The shared and the hot anchors of a block, sorted."""
    none = np.zeros(0, np.uint64)
    return tuple(
        np.sort(np.concatenate([none, *_words(shared.column(n), "<u8")])) for n in ("shared", "hot")
    )


def _classes(key: np.ndarray, content: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings equal pieces together, and where each class starts in it."""
    order = np.lexsort((content, key))
    k, c = key[order], content[order]
    return order, np.flatnonzero(np.append(True, (k[1:] != k[:-1]) | (c[1:] != c[:-1]))[: len(k)])


def _sent(shards: int):
    def run(docs: pa.Table, shared: pa.Table) -> pa.Table:
        if not docs.num_rows or not shared.num_rows:
            return _table([], _SENT)
        block = docs.column("block")[0].as_py()
        anchors_shared, hot = _told(shared)
        keys, contents, smallest, sizes, texts = [], [], [], [], []
        for ids, _, part in _parts(docs):
            p = part.pieces(anchors_shared, hot)
            order, first = _classes(p.key, p.content)
            if not len(order):
                continue
            chosen = p.where(order[first])
            keys.append(chosen.key)
            contents.append(chosen.content)
            smallest.append(np.minimum.reduceat(_numbers(ids)[p.doc[order]], first))
            sizes.append(chosen.end - chosen.start)
            whole = part.data.tobytes()
            texts += [whole[a:b] for a, b in zip(chosen.start.tolist(), chosen.end.tolist())]
        if not keys:
            return _table([], _SENT)
        key, content, doc, size = map(np.concatenate, (keys, contents, smallest, sizes))
        order, first = _classes(key, content)
        doc = np.minimum.reduceat(doc[order], first)
        one = order[first]
        key, size = key[one], size[one].astype("<i4")
        shard = (key % np.uint64(shards)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        cuts = np.flatnonzero(np.append(True, np.diff(shard[order]) != 0))
        rows = []
        for i, j in zip(cuts, [*cuts[1:], len(order)]):
            at = order[i:j]
            data = b"".join([texts[t] for t in one[at].tolist()])
            rows.append(
                (
                    int(shard[at[0]]), block, key[at].tobytes(),
                    *map(_packed, (doc[at], size[at], data)),
                )
            )
        return _table(rows, _SENT)

    return run


# --- 3: the shard ---

_ANSWERS = pa.schema(
    {
        "block": pa.int64(), "keys": pa.binary(), "contents": pa.binary(), "smallest": pa.binary(),
        "counts": pa.binary(), "ranges": pa.binary(),
    }
)


def seen_twice(hashes: np.ndarray) -> np.ndarray:
    """Which hashes occur more than once. Two counts by some of their bits leave few to be sorted."""
    left = np.arange(len(hashes))
    bits = max(10, int(4 * len(hashes)).bit_length())
    for shift in (0, bits):
        part = ((hashes[left] >> np.uint64(shift)) & np.uint64((1 << bits) - 1)).astype(np.int64)
        left = left[np.bincount(part, minlength=1 << bits)[part] > 1]
    _, number, count = np.unique(hashes[left], return_inverse=True, return_counts=True)
    out = np.zeros(len(hashes), bool)
    out[left[count[number] > 1]] = True
    return out


def repeated_ranges(segments: list[bytes], docs: np.ndarray, span: int = SPAN) -> list[np.ndarray]:
    """Per segment the stretches (flat: from, to, ...) covered by ``span``-byte strings that also
    stand in a segment of a smaller document.

    A string whose rolling hash occurs once is no repeat: only the stretches of segments that strings
    with a repeated hash cover are sorted.
    """
    out = [np.zeros(0, "<i4")] * len(segments)
    sizes = np.array([len(s) for s in segments], np.int64)
    base = np.cumsum(sizes) - sizes
    joined = b"".join(segments)
    usable = np.maximum(sizes - span + 1, 0)
    starts = _spread(base, usable)
    owner = np.repeat(np.arange(len(segments)), usable)
    again = seen_twice(content_hash(np.frombuffer(joined, np.uint8), starts, starts + span))
    starts, owner = starts[again], owner[again]
    if not len(starts):
        return out
    first = np.flatnonzero(np.append(True, (np.diff(starts) > span) | (np.diff(owner) != 0)))
    last = np.append(first[1:], len(starts)) - 1
    low, high, of = starts[first], starts[last] + span, owner[first]
    # Equal stretches are sorted once, for the smallest document; the others repeat it as a whole.
    numbers: dict[bytes, int] = {}
    number = np.array([numbers.setdefault(joined[a:b], len(numbers)) for a, b in zip(low.tolist(), high.tolist())])
    smallest = np.full(len(numbers), _LAST)
    np.minimum.at(smallest, number, docs[of])
    found = sorted_ranges(list(numbers), smallest, span)
    whole = docs[of] > smallest[number]
    shifted = [
        np.array([a, b], "<i4") if w else found[n] + np.int32(a)
        for w, n, a, b in zip(whole.tolist(), number.tolist(), (low - base[of]).tolist(), (high - base[of]).tolist())
    ]
    cuts = np.flatnonzero(np.append(True, np.diff(of) != 0))
    for i, j in zip(cuts, [*cuts[1:], len(of)]):
        out[of[i]] = np.concatenate(shifted[i:j])
    return out


def sorted_ranges(segments: list[bytes], docs: np.ndarray, span: int = SPAN) -> list[np.ndarray]:
    """``repeated_ranges`` of segments, by suffix array and common prefixes."""
    sizes = np.array([len(s) + 1 for s in segments])
    text = np.frombuffer(b"\0".join([*segments, b""]), np.uint8).astype(np.int64) + 2
    ends = np.cumsum(sizes) - 1
    text[ends] = 1  # the border of a segment, below all bytes
    text = np.append(text, 0)
    order = suffix_array(text)
    text[ends] = 0
    shared = common_prefixes(text, order, span)[order]
    run = np.cumsum(shared < span) - 1
    owner = np.append(np.repeat(np.arange(len(segments)), sizes), 0)
    doc = docs[owner[order]]
    smallest = np.minimum.reduceat(doc, np.flatnonzero(shared < span))
    starts = np.sort(order[smallest[run] < doc])
    out = [np.zeros(0, "<i4")] * len(segments)
    if len(starts):
        seg = owner[starts]
        turn = np.append(True, (np.diff(starts) > span) | (np.diff(seg) != 0))
        first = np.flatnonzero(turn)
        last = np.append(first[1:], len(starts)) - 1
        base = ends - sizes + 1
        low = starts[first] - base[seg[first]]
        high = starts[last] - base[seg[last]] + span
        pairs = np.stack([low, high], axis=1).astype("<i4")
        cuts = np.flatnonzero(np.append(True, np.diff(seg[first]) != 0))
        for i, j in zip(cuts, [*cuts[1:], len(first)]):
            out[seg[first[i]]] = pairs[i:j].ravel()
    return out


def _answered(sent: pa.Table) -> pa.Table:
    """What a shard tells its blocks."""
    keys, docs = _words(sent.column("keys"), "<u8"), _words(sent.column("docs"), "<i8", True)
    sizes = _words(sent.column("sizes"), "<i4", True)
    data = [_unpacked(d) for d in sent.column("data").to_pylist()]
    contents = []
    for own, text in zip(sizes, data):
        end = np.cumsum(own, dtype=np.int64)
        contents.append(content_hash(np.frombuffer(text, np.uint8), end - own, end))
    key, content, doc = map(np.concatenate, (keys, contents, docs))
    order, first = _classes(key, content)
    number = np.empty(len(key), np.int64)
    number[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(order))))
    smallest = np.minimum.reduceat(doc[order], first)
    class_key = key[order[first]]
    several = np.append(True, class_key[1:] != class_key[:-1])
    group = np.cumsum(several) - 1
    crowded = np.flatnonzero(np.bincount(group)[group] > 1)  # classes with others of their anchor
    ranges: dict[int, np.ndarray] = {}
    if len(crowded):
        place = np.empty(len(first), np.int64)
        place[:] = -1
        place[crowded] = np.arange(len(crowded))
        texts: list[bytes] = [b""] * len(crowded)
        at = 0
        for own, text in zip(sizes, data):
            offsets = np.cumsum(own) - own
            wanted = place[number[at : at + len(own)]]
            for i in np.flatnonzero(wanted >= 0).tolist():
                texts[wanted[i]] = text[offsets[i] : offsets[i] + own[i]]
            at += len(own)
        found = repeated_ranges(texts, smallest[crowded])
        ranges = {int(c): r for c, r in zip(crowded, found) if len(r)}
    has_range = np.zeros(len(first), bool)
    has_range[list(ranges)] = True
    rows, at = [], 0
    none = np.zeros(0, "<i4")
    for block, own_keys, own_contents, own_docs in zip(
        sent.column("block").to_pylist(), keys, contents, docs
    ):
        own = number[at : at + len(own_keys)]
        at += len(own_keys)
        told = np.flatnonzero((smallest[own] < own_docs) | has_range[own])
        if not len(told):
            continue
        each = [ranges.get(c, none) for c in own[told].tolist()]
        rows.append(
            (
                block, own_keys[told].tobytes(), own_contents[told].tobytes(),
                _packed(smallest[own[told]]),
                _packed(np.array([len(r) // 2 for r in each], "<i4")),
                _packed(np.concatenate([none, *each]).astype("<i4")),
            )
        )
    return _table(rows, _ANSWERS)


# --- 4: removal ---

_RESULT = pa.schema(
    {
        "doc_id": pa.int64(), "n_bytes": pa.int64(), "n_removed": pa.int64(), "n_spans": pa.int64(),
        "kept": pa.binary(),
    }
)


class _Known:
    """The answers a block has got, by class."""

    def __init__(self, told: pa.Table):
        def whole(name: str, dtype: str, packed: bool = False) -> np.ndarray:
            column = told.column(name).drop_null()
            return np.concatenate([np.zeros(0, dtype), *_words(column, dtype, packed)])

        key, content = whole("keys", "<u8"), whole("contents", "<u8")
        self.order = np.argsort(self.name(key, content), kind="stable")
        self.names = self.name(key, content)[self.order]
        self.smallest = whole("smallest", "<i8", True)
        self.counts = whole("counts", "<i4", True).astype(np.int64)
        self.ranges = whole("ranges", "<i4", True).reshape(-1, 2).astype(np.int64)
        self.first = np.cumsum(self.counts) - self.counts

    @staticmethod
    def name(key: np.ndarray, content: np.ndarray) -> np.ndarray:
        return _mixed(key * _ODD[1] + content * _ODD[2])

    def find(self, p: Pieces) -> np.ndarray:
        """The answer's number for each piece, -1 if there is none."""
        if not len(self.names):
            return np.full(len(p.key), -1)
        name = self.name(p.key, p.content)
        at = np.minimum(np.searchsorted(self.names, name), len(self.names) - 1)
        return np.where(self.names[at] == name, self.order[at], -1)


def _removed(keep_text: bool):
    def run(docs: pa.Table, told: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return _table([], _RESULT)
        shared, hot = _told(
            pa.table({n: told.column(n).drop_null() for n in ("shared", "hot")})
            if told.num_rows
            else pa.table({n: pa.array([], pa.binary()) for n in ("shared", "hot")})
        )
        known = _Known(told)
        held = list(_parts(docs))
        found = [part.pieces(shared, hot) for _, _, part in held]
        # The smallest document of each class inside the block.
        name = np.concatenate([known.name(p.key, p.content) for p in found])
        doc = np.concatenate([_numbers(ids)[p.doc] for (ids, _, _), p in zip(held, found)])
        every, number = np.unique(name, return_inverse=True)
        inside = np.full(len(every), _LAST)
        np.minimum.at(inside, number, doc)
        rows, at = [], 0
        for (ids, texts, part), p in zip(held, found):
            own = doc[at : at + len(p.key)]
            least = inside[number[at : at + len(p.key)]]
            at += len(p.key)
            answer = known.find(p)
            has = answer >= 0
            least[has] = np.minimum(least[has], known.smallest[answer[has]])
            # A document after the first of its class loses the whole piece, the first the ranges.
            lost = own > least
            low, high = [p.start[lost]], [p.end[lost]]
            partly = np.flatnonzero(~lost & has)
            if len(partly):
                count = known.counts[answer[partly]]
                which = _spread(known.first[answer[partly]], count)
                base = np.repeat(p.start[partly], count)
                low.append(base + known.ranges[which, 0])
                high.append(base + known.ranges[which, 1])
            depth = np.zeros(len(part.data) + 1, np.int64)
            np.add.at(depth, np.concatenate(low), 1)
            np.add.at(depth, np.concatenate(high), -1)
            gone = np.cumsum(depth[:-1]) > 0
            for i, (doc_id, text) in enumerate(zip(ids, texts)):
                mask = gone[part.starts[i] : part.starts[i] + len(text)]
                total = int(mask.sum())
                kept, spans = text, 0
                if total:
                    kept = part.data[part.starts[i] : part.starts[i] + len(text)][~mask].tobytes()
                    spans = int(mask[0]) + int((mask[1:] & ~mask[:-1]).sum())
                data = kept if keep_text else hashlib.sha256(kept).hexdigest().encode()
                rows.append((doc_id, len(text), total, spans, data))
        return _table(rows, _RESULT)

    return run


def deduplicated(
    docs: DataFrame, keep_text: bool = True, hot: int = HOT, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Per row ``doc_id, n_bytes, n_removed, n_spans`` and ``kept``: the remaining bytes, or their
    SHA-256 in hex without ``keep_text``."""
    spark = docs.sparkSession
    importable(spark)
    docs = docs.select("doc_id", text_or_empty().alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    buckets = max(1, size // (SPAN - GRAM) * 2 // BUCKET_ANCHORS)
    block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).alias("block")
    placed = docs.select("doc_id", "text", block)
    by_block = placed.groupBy("block")
    named = by_block.applyInArrow(
        _named(buckets), "block long, bucket long, anchors binary, counts binary"
    )
    shared = stored(
        named.groupBy("bucket").applyInArrow(
            _sharing(hot), "block long, shared binary, hot binary"
        ),
        "shared-anchors",
    )
    sent = by_block.cogroup(shared.groupBy("block")).applyInArrow(
        _sent(blocks),
        "shard long, block long, keys binary, docs binary, sizes binary, data binary",
    )
    answers = sent.groupBy("shard").applyInArrow(
        _answered,
        "block long, keys binary, contents binary, smallest binary, counts binary, ranges binary",
    )
    told = shared.unionByName(answers, allowMissingColumns=True)
    return by_block.cogroup(told.groupBy("block")).applyInArrow(
        _removed(keep_text), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    )


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Removed bytes and the digest of what is left, for every document."""
    found = deduplicated(table(spark, sf_dir, "documents"), keep_text=False)
    return found.withColumn("kept_sha256", F.col("kept").cast("string")).drop("kept")
