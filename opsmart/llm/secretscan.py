"""Secrets in texts: fixed patterns, and random strings by token efficiency.

A byte-pair vocabulary learned on ordinary text needs few tokens for names and words and many for
random strings. A candidate is a maximal run of 20 or more characters of the alphabets that keys are
written in. Under ``DENSE`` characters a token it counts as a secret of kind ``random``, unless

- a fixed pattern already covers a part of it;
- it is a digest: hexadecimal in one case of a digest's length, an integrity value (``sha256-…``), or
  one of the caller's ``known`` strings;
- it is an identifier: a UUID, digits with separators, words of one case each with separators, letters
  of one case only, an ascending stretch of the alphabet;
- it is the content of a ``base64,`` link.

Tokens are counted in stretches of 256 characters, so a run of any length takes linear time. Random
strings of 20 characters have 1.0 to 1.7 characters a token, words of unknown languages 2.3 to 4.

Defined results: a null text is empty; spans are code points, end exclusive, ordered by start and then
by kind as listed in ``KINDS``; repeated rows give repeated results; other columns are not read; an
empty table gives no rows. A task holds one batch of texts.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession

from opsmart.llm.bpe import default_vocabulary
from opsmart.llm.common import map_rows, sha256, table, text_or_empty

KINDS = ("assign", "access", "hex", "random")

# Fixed patterns: names in either case are spelt out, since ignoring case would also take letters
# beyond ASCII.
NAMES = "|".join(
    "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in name)
    for name in ("password", "passwd", "secret", "token")
) + "|[Aa][Pp][Ii]_?[Kk][Ee][Yy]"
ASSIGN = re.compile(rf"""(?:{NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ASSIGNED = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")

#: A candidate, and the characters a token under which it is random.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
DENSE = 2.0
STRETCH = 256
# Fixed lengths of hexadecimal digests: MD5, SHA-1, SHA-224, SHA-256, SHA-384, SHA-512.
DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)
HEX_RUN = re.compile(r"[0-9a-f]+|[0-9A-F]+")
INTEGRITY = re.compile(r"(?:sha(?:1|224|256|384|512)|md5)[-_/]", re.IGNORECASE)
UUID = re.compile(r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
NUMBERS = re.compile(r"[0-9TZ+/_-]+")
ONE_CASE = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
WORDS = re.compile(r"(?:[A-Z]?[a-z]{0,20}|[A-Z]{1,20})[0-9]{0,4}[a-z]{0,2}|[0-9]{1,14}")
SEPARATOR = re.compile(r"[-_/+=]+")
LINKED = "base64,"

SCHEMA = (
    "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_random long"
)
Span = tuple[int, int, int]


@functools.lru_cache(maxsize=2)
def encoding(path: str, pattern: str):
    """The vocabulary file's encoder, read once per Python process."""
    import base64

    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(t): int(i) for t, i in map(bytes.split, file)}
    return tiktoken.Encoding("secrets", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def base_spans(text: str) -> list[Span]:
    """``start, kind, end`` of the fixed patterns, in order; kinds are places in ``KINDS``."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= ASSIGNED]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def is_digest(run: str) -> bool:
    return (len(run) in DIGEST_LENGTHS and HEX_RUN.fullmatch(run) is not None) or INTEGRITY.match(run) is not None


def is_identifier(run: str) -> bool:
    if UUID.fullmatch(run) or NUMBERS.fullmatch(run) or ONE_CASE.fullmatch(run):
        return True
    parts = [p for p in SEPARATOR.split(run) if p]
    if len(parts) > 1 and all(WORDS.fullmatch(p) for p in parts):
        return True
    return 2 * sum(ord(b) - ord(a) == 1 for a, b in zip(run, run[1:])) > len(run)


def efficiency(run: str, encoder) -> float:
    """Characters a token."""
    pieces = [run[at : at + STRETCH] for at in range(0, len(run), STRETCH)]
    return len(run) / sum(len(encoder.encode_ordinary(piece)) for piece in pieces)


def random_spans(text: str, base: list[Span], encoder, known: frozenset[str] = frozenset()) -> list[Span]:
    """Runs that the vocabulary cannot shorten and that are neither digests nor identifiers."""
    found = []
    at = 0
    ends = [end for _, _, end in base]
    for i in range(1, len(ends)):
        ends[i] = max(ends[i], ends[i - 1])
    for match in CANDIDATE.finditer(text):
        run, start, end = match[0], match.start(), match.end()
        while at < len(base) and ends[at] <= start:
            at += 1
        if at < len(base) and base[at][0] < end:
            continue
        if run in known or is_digest(run) or is_identifier(run) or text.endswith(LINKED, 0, start):
            continue
        if efficiency(run, encoder) < DENSE:
            found.append((start, KINDS.index("random"), end))
    return found


def joined(spans: Iterable[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def _rows(rows: Iterator[tuple], path: str, pattern: str, known: frozenset[str]) -> Iterator[tuple]:
    encoder = encoding(path, pattern)
    for doc_id, text in rows:
        base = base_spans(text)
        added = random_spans(text, base, encoder, known)
        counts = [sum(s[1] == kind for s in base) for kind in range(3)]
        yield doc_id, *counts, sha256(joined(base).encode()), joined(sorted(base + added)), len(added)


def _spans(rows: Iterator[tuple], path: str, pattern: str, known: frozenset[str]) -> Iterator[tuple]:
    encoder = encoding(path, pattern)
    for doc_id, text in rows:
        base = base_spans(text)
        for start, kind, end in sorted(base + random_spans(text, base, encoder, known)):
            yield doc_id, KINDS[kind], start, end, text[start:end]


def _mapped(docs, schema, function, path, pattern, known):
    own_path, own_pattern = default_vocabulary() if path is None else (path, pattern)
    rows = docs.select(docs["doc_id"].cast("long"), text_or_empty())
    return map_rows(rows, schema, function, own_path, pattern or own_pattern, frozenset(known), batch=64)


def spans(
    docs: DataFrame, path: str | None = None, pattern: str | None = None, known: Iterable[str] = ()
) -> DataFrame:
    """One row per secret: ``doc_id, kind, start, end, value``. ``path`` and ``pattern`` name a
    vocabulary of ranks, ``known`` holds strings (digests, identifiers) that are no secrets."""
    return _mapped(docs, "doc_id long, kind string, start long, end long, value string", _spans, path, pattern, known)


def digests(
    docs: DataFrame, path: str | None = None, pattern: str | None = None, known: Iterable[str] = ()
) -> DataFrame:
    """One row per document: counts, digest of the fixed patterns' spans, all spans."""
    return _mapped(docs, SCHEMA, _rows, path, pattern, known)


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secrets of every document."""
    return digests(table(spark, sf_dir, "documents"))
