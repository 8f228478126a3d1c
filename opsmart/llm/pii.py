"""Personal data, also when disguised, found at its place in the source text.

Plain detectors find e-mail addresses, IPv4 addresses, card numbers and phone numbers as written.
Then transducers rewrite the text step by step - look-alike characters to ASCII, invisible ones away,
spelled digits to digits, ``at`` and ``dot`` in words or brackets to signs - and keep for every
character of the result the stretch of source characters it came from. The detectors run again on the
rewritten text, and what they find there is mapped back. Spans found plainly always stay; a rewritten
one is added if the rewriting touched it and no plain span of its kind covers it.

Only texts that hold a trigger (a character beyond the Latin ranges, a digit word, a bracketed sign, a
domain behind a spoken ``at``) are rewritten; finding triggers reads the whole text. All detectors take linear time.

Defined results: a null text counts as empty and has no spans; rows are judged one by one, so
repeated ids and texts give repeated rows. Offsets count code points, the end is exclusive.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

from opsmart.llm.common import map_rows, table, text_or_empty

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, int]  # start, end, index of the kind

# --- plain detectors ---

_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]*\Z")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A run of digits is entered at its start only: what fails there fails further inside too.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9]){13,}")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_NOT_DIGIT = re.compile("[^0-9]")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def emails(text: str) -> Iterator[Span]:
    """At each ``@`` the longest local part behind the previous match, and the domain."""
    free = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            free = domain.end()
            yield start, free, 0
        else:
            free = max(free, at + 1)
        at = text.find("@", at + 1 if free <= at else free)


def detect(text: str) -> list[Span]:
    """The spans as written, by start and then kind."""
    found = list(emails(text))
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(part.lstrip("0")) < 4 and int(part) < 256 for part in m[0].split(".")):
                found.append((*m.span(), 1))
        for m in _CARD.finditer(text):
            digits = _NOT_DIGIT.sub("", m[0])
            if len(digits) <= 19 and luhn(digits):
                found.append((*m.span(), 2))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                    found.append((*m.span(), 3))
    return sorted(found, key=lambda s: (s[0], s[2]))


# --- transducers ---


class Trace:
    """A rewritten text and, per character, the stretch of the source it stands for."""

    def __init__(self, text: str):
        self.text = text
        self.starts: list[int] = list(range(len(text)))
        self.ends: list[int] = list(range(1, len(text) + 1))

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        """Replace stretches (sorted, apart); every new character stands for its whole stretch."""
        if not edits:
            return
        out, starts, ends, at = [], [], [], 0
        for start, end, new in edits:
            out.append(self.text[at:start])
            starts += self.starts[at:start]
            ends += self.ends[at:start]
            if new:
                out.append(new)
                starts += [self.starts[start]] * len(new)
                ends += [self.ends[end - 1]] * len(new)
            at = end
        out.append(self.text[at:])
        self.starts = starts + self.starts[at:]
        self.ends = ends + self.ends[at:]
        self.text = "".join(out)

    def source(self, start: int, end: int) -> tuple[int, int]:
        return self.starts[start], self.ends[end - 1]


# Cyrillic, Greek, Armenian and rare Latin letters drawn like ASCII ones, and the letters
# they resemble; full stops of other scripts.
LOOK_ALIKE = {
    c: plain
    for odd, like in (
        ("АВЕЅІЈКМНОРСТХУ", "ABESIJKMHOPCTXY"),
        ("асеѕіјорхуԁԛԝһ", "acesijopxydqwh"),
        ("кмтнгпѵү", "kmthrnvy"),
        ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "ABEZHIKMNOPTYX"),
        ("ονα", "ova"),
        ("ικρτυηωγσβε", "ikptunwyobe"),
        ("օոսհցզ", "onuhgq"),
        ("ɑɡıȷɩʋ", "agijiv"),
        ("ᴀʙᴄᴅᴇɢʜɪᴊᴋʟᴍɴᴏᴘʀᴛᴜᴠᴡʏᴢ", "ABCDEGHIJKLMNOPRTUVWYZ"),
        ("。｡․", "..."),
    )
    for c, plain in zip(odd, like)
}
# Characters without width.
INVISIBLE = "­​‌‍⁠﻿"
# Digit words in English, German, French and Spanish.
DIGIT_WORDS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5",
    "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "zwo": "2", "drei": "3", "vier": "4", "fünf": "5",
    "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7",
    "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6",
    "siete": "7", "ocho": "8", "nueve": "9",
}
# Names of the signs.
AT_WORDS, DOT_WORDS, PLUS_WORDS = "at|arroba|arobase|ät", "dot|punkt|point|punto", "plus|más"
# Words that follow "at" in plain prose.
NO_DOMAIN = "the|a|an|this|that|these|those|my|our|your|his|her|its|their|which|one"
# Words that precede "at" and a domain in plain prose.
NO_LOCAL = frozenset(
    "us me you it him her them is are was were be been look looks looking looked meet met meeting find "
    "found visit available hosted online published posted read more info information site website page "
    "blog details here store shop work works worked working based learn live stay buy sold sell register "
    "registered contact reach reached order orders up out in on or and log login not only now today also "
    "back all listed see seen check home them downloaded download documented".split()
)
#: Digit words so common as other words that they are no trigger by themselves.
WEAK = {"un", "uno", "oh", "one", "dos", "six", "null"}

_ODD = re.compile("[ı ­ƀ-\U0010ffff]")
# Every repetition is bounded or possessive, and no match can start inside a run of its own first
# characters, so that matching stays linear on any text.
_BRACKETS = re.compile(
    rf" {{0,2}}[\[({{<] ?(?:(?P<at>@|{AT_WORDS})|(?P<dot>\.|{DOT_WORDS})) ?[\])}}>] {{0,2}}", re.I
)
_PART = rf"(?:(?: (?:{DOT_WORDS}) |\.)[a-z0-9_%+-]{{1,64}}){{0,8}}"
_SPOKEN = re.compile(
    rf"(?<![\w%+-])(?P<local>[a-z0-9_%+-]{{1,64}}{_PART})(?P<at>@| (?:{AT_WORDS}) (?!(?:{NO_DOMAIN}) ))"
    rf"(?P<domain>[a-z0-9-]{{1,64}}{_PART}(?: (?:{DOT_WORDS}) |\.)[a-z]{{2,24}}\b)",
    re.I,
)
_AT_DOMAIN = re.compile(rf"\s(?:{AT_WORDS})\s+[a-z0-9-]{{1,64}}\.[a-z0-9]", re.I)
#: An address that is already whole; what follows a spoken dot then is prose.
_WHOLE = re.compile(r"@\S*\.(?:com|org|net|edu|gov|info|de|fr|es)\Z", re.I)
_SIGNS = re.compile(rf" (?:(?P<at>{AT_WORDS})|(?P<dot>{DOT_WORDS})) ", re.I)
# Signs between blanks of any kind and number, with blanks around, as entities and with underscores.
_LOOSE = re.compile(rf"(?<!\s)\s++({AT_WORDS}|{DOT_WORDS}|@|\.)\s+", re.I)
_SPACED = re.compile(
    r"(?<![\w.%+-])[a-z0-9._%+-]{1,64} @ [a-z0-9-]{1,64}(?:(?: \. |\.)[a-z0-9-]{1,64}){0,8}(?: \. |\.)[a-z]{2,24}\b",
    re.I,
)
_SPACED_SIGN = re.compile(r" ([@.]) ")
_ENTITY = re.compile(r"&(?:#0*64|#x0*40|(commat)|#0*46|#x0*2e|(period));", re.I)
_JOINED = re.compile(
    r"(?<![A-Za-z0-9])[a-z0-9.%+-]{1,64}(?:_(?!at_)[a-z0-9.%+-]{1,64}){0,8}_at_[a-z0-9-]{1,64}(?:_dot_[a-z0-9-]{1,64}){0,8}_dot_"
    r"[a-z]{2,24}(?![A-Za-z0-9])",
    re.I,
)
_JOINED_SIGN = re.compile(r"_(at|dot)_", re.I)
_DOTTED = re.compile(rf"(?<![\w.])[0-9]{{1,3}}(?: (?:{DOT_WORDS}) [0-9]{{1,3}}){{3}}(?![\w.])", re.I)
_DOTTED_SIGN = re.compile(rf" (?:{DOT_WORDS}) ", re.I)
_TOKEN = rf"(?:{'|'.join(sorted(DIGIT_WORDS, key=len, reverse=True))}|[0-9]+)"
_SPELLED = re.compile(
    rf"(?<!\w)(?:(?:{PLUS_WORDS}) |\+)?{_TOKEN}(?:(?: (?:{DOT_WORDS}) | ?[-,.] ?| ){_TOKEN}){{3,}}(?!\w)",
    re.I,
)
_STEP = re.compile(rf"(?:{PLUS_WORDS}) |{_TOKEN}| (?:{DOT_WORDS}) | ?[-,.] ?| ", re.I)
_BETWEEN = str.maketrans(",.-;:()[]", "         ")
_STRONG = frozenset(DIGIT_WORDS) - WEAK | {*DOT_WORDS.split("|")}


@lru_cache(maxsize=4096)
def plain_character(c: str) -> str:
    """What a character beyond the Latin ranges stands for in ASCII; itself if nothing."""
    if c in INVISIBLE:
        return ""
    if c in LOOK_ALIKE:
        return LOOK_ALIKE[c]
    if (digit := unicodedata.decimal(c, None)) is not None:
        return str(digit)
    folded = unicodedata.normalize("NFKC", c)
    if unicodedata.category(c) == "Pd":
        return "-"
    return folded if folded.isascii() else c


def characters(trace: Trace) -> None:
    """Look-alikes and width variants to ASCII, invisible characters away."""
    edits = []
    for m in _ODD.finditer(trace.text):
        if (new := plain_character(m[0])) != m[0]:
            edits.append((*m.span(), new))
    trace.rewrite(edits)


def spelled_digits(trace: Trace) -> list[tuple[int, int]]:
    """Runs of four or more digit words or numbers to digits; where these runs now stand."""
    edits, runs, moved = [], [], 0
    for m in _SPELLED.finditer(trace.text):
        steps = list(_STEP.finditer(trace.text, *m.span()))
        words = [s for s in steps if s[0].lower() in DIGIT_WORDS]
        if len(words) < 3:
            continue
        own = []
        for s in steps:
            word = s[0].strip().lower()
            if word in DIGIT_WORDS:
                own.append((*s.span(), DIGIT_WORDS[word]))
            elif word in PLUS_WORDS.split("|"):
                own.append((*s.span(), "+"))
            elif word in DOT_WORDS.split("|") or word == ".":
                own.append((*s.span(), "."))
            elif not word or word in "-,":
                own.append((*s.span(), ""))
        size = m.end() - m.start() + sum(len(new) - (e - b) for b, e, new in own)
        runs.append((m.start() + moved, m.start() + moved + size))
        moved += size - (m.end() - m.start())
        edits += own
    trace.rewrite(edits)
    return runs


def signs(trace: Trace) -> None:
    """Signs as entities, in brackets or joined by underscores, signs between blanks, and spoken ones in
    the shape of a whole address."""
    trace.rewrite([(*m.span(), "@" if m[1] or re.match(r"&#(?:0*64|x0*40);", m[0], re.I) else ".") for m in _ENTITY.finditer(trace.text)])
    trace.rewrite([
        (*s.span(), "@" if s[1].lower() == "at" else ".")
        for m in _JOINED.finditer(trace.text) for s in _JOINED_SIGN.finditer(trace.text, *m.span())
    ])
    trace.rewrite([(*m.span(), f" {m[1]} ") for m in _LOOSE.finditer(trace.text) if m[0] != f" {m[1]} "])
    trace.rewrite([
        (*s.span(), s[1])
        for m in _SPACED.finditer(trace.text)
        if m[0].split(" ")[0].lower() not in NO_LOCAL
        for s in _SPACED_SIGN.finditer(trace.text, *m.span())
    ])
    trace.rewrite([
        (*s.span(), ".") for m in _DOTTED.finditer(trace.text) for s in _DOTTED_SIGN.finditer(trace.text, *m.span())
    ])
    trace.rewrite([(*m.span(), "@" if m["at"] else ".") for m in _BRACKETS.finditer(trace.text)])
    edits = []
    for whole in _SPOKEN.finditer(trace.text):
        spoken_domain = " " in whole["domain"]
        if whole["at"] != "@" and not spoken_domain:
            # "look at example.com" is prose, unless the domain itself was disguised.
            start, end = trace.source(*whole.span("domain"))
            if end - start == len(whole["domain"]) and (
                whole["local"].lower().split()[-1] in NO_LOCAL or whole["domain"].lower().startswith("www.")
            ):
                continue
        for m in _SIGNS.finditer(trace.text, *whole.span()):
            if m["dot"] and whole["at"] == "@":
                # Beside a plain address "point" is a word of prose.
                if not spoken_domain and m["dot"].lower() == "point":
                    continue
                if _WHOLE.search(trace.text, whole.start(), m.start()):
                    break
            edits.append((*m.span(), "@" if m["at"] else "."))
    trace.rewrite(edits)


def triggered(text: str) -> bool:
    """Whether rewriting could change this text."""
    return bool(
        _ODD.search(text)
        or _BRACKETS.search(text)
        or _AT_DOMAIN.search(text)
        or "&" in text and _ENTITY.search(text)
        or " @ " in text
        or "_at_" in text.lower()
        or not _STRONG.isdisjoint(text.lower().translate(_BETWEEN).split())
    )


def disguised(text: str) -> list[Span]:
    """Spans that only the rewritten text shows, in source offsets."""
    if not triggered(text):
        return []
    trace = Trace(text)
    characters(trace)
    signs(trace)
    runs = spelled_digits(trace)
    found = detect(trace.text)
    for start, end in runs:  # a spelled number needs no plus sign to be a phone number
        digits = trace.text[start:end]
        if digits.isdigit() and 10 <= len(digits) <= 13:
            found.append((start, end, 3))
    spans = []
    for start, end, kind in found:
        a, b = trace.source(start, end)
        if trace.text[start:end] != text[a:b]:
            spans.append((a, b, kind))
    return spans


def spans(text: str) -> tuple[list[Span], list[Span]]:
    """The plain spans, and all spans with the disguised ones."""
    base = detect(text)
    more = []
    for a, b, kind in disguised(text):
        if not any(k == kind and s <= a and b <= e for s, e, k in base):
            more.append((a, b, kind))
    return base, sorted({*base, *more}, key=lambda s: (s[0], s[2], s[1]))


def written(found: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in found)


def redacted(text: str) -> str:
    """The text with every span replaced by its kind in angle brackets; overlaps become one."""
    out, at = [], 0
    for a, b, kind in spans(text)[1]:
        if a >= at:
            out += (text[at:a], f"<{KINDS[kind].upper()}>")
        at = max(at, b)
    return "".join([*out, text[at:]]) if out else text


def _digests(rows: Iterator[tuple]) -> Iterator[tuple]:
    for doc_id, text in rows:
        base, every = spans(text)
        yield (
            doc_id,
            *(sum(k == kind for _, _, k in base) for kind in range(4)),
            hashlib.sha256(written(base).encode()).hexdigest(),
            written(every),
            len(every) - len(base),
        )


def find(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` the plain counts, their digest, all spans and how many were disguised."""
    return map_rows(
        docs.select("doc_id", text_or_empty()),
        "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
        "spans string, n_disguised long",
        _digests,
    )


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with its personal data replaced in ``text``, and ``n_chars`` following if present.

    A null text stays null.
    """
    names = docs.columns
    text_at = names.index("text")
    size_at = names.index("n_chars") if "n_chars" in names else None

    def rows(inputs: Iterator[tuple]) -> Iterator[tuple]:
        for row in inputs:
            text = row[text_at]
            if text:
                clean = redacted(text)
                if clean is not text:
                    row = list(row)
                    row[text_at] = clean
                    if size_at is not None:
                        row[size_at] = len(clean)
            yield tuple(row)

    return map_rows(docs, ", ".join(f"`{c}` {t}" for c, t in docs.dtypes), rows)


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return find(table(spark, sf_dir, "documents"))
