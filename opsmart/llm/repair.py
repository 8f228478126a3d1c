"""Repair of conversation structure by weighted interval parsing.

A legal conversation is ``(system? (user assistant)+)?``. Its grammar, in Chomsky normal form, has a
symbol (p, q) for every pair of states between turns: the symbol spans the rows that lead from p to q.

- (p, q) -> (p, r) (r, q), for every state r;
- (p, q) -> one row that is kept, given another role or deleted, with inserted turns on either side
  (the closure of the insertions, which needs no row).

A cell holds, per symbol, the cheapest (cost, audit) of a span, ties ASCII-least. Spans are combined
bottom-up by length: up to ``BLOCK`` rows with every split point, beyond that in pairs of neighbours of
equal length. As the symbols name states, a derivation can be cut at any row, so for longer spans one
split point gives the same cell as all (the tests compare both). Two audits of a cell with equal cost
are never one a prefix of the other, since the rest would be insertions, which cost; so the least parts
give the least whole.

Defined results: a null ``conv_id`` is a conversation of its own; null ``turn`` comes first, ties by
role and text; null role or text is one space, which no role equals and which is blank; an empty role
has no initial; other columns are not read; an empty table gives no rows.

Rows are sorted by conversation and streamed; a conversation's texts are never held. Its audit is one
string, and SHA-256 runs over its texts in order, so by the contract one conversation is read by one
task; that task holds a few bytes a row.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsmart.llm.common import map_rows, table

#: Costs.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: States between turns: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
FINAL = (START, ASSISTANT)
STEP = {
    (START, "s"): SYSTEM,
    (START, "u"): USER,
    (SYSTEM, "u"): USER,
    (ASSISTANT, "u"): USER,
    (USER, "a"): ASSISTANT,
}
LEGAL = {"su", "ua", "au"}
ENDS = frozenset(".!?")
BLANKS = " \t\n\x0b\x0c\r"
#: Rows of a span that is combined over every split point, and spans remembered by their symbols.
BLOCK, REMEMBERED = 8, 50_000
FIGURES = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"

Cell = tuple  # 16 entries (from state * 4 + to state) of (cost, audit) or None


def _least(found: Iterable) -> tuple | None:
    return min((f for f in found if f is not None), default=None)


def combined(left: Cell, right: Cell) -> Cell:
    """The span of two neighbouring spans."""
    out = []
    for p in STATES:
        for q in STATES:
            best = None
            for r in STATES:
                a, b = left[4 * p + r], right[4 * r + q]
                if a is None or b is None:
                    continue
                cost = a[0] + b[0]
                if best is None or cost <= best[0]:
                    found = (cost, a[1] + b[1])
                    if best is None or found < best:
                        best = found
            out.append(best)
    return tuple(out)


@functools.cache
def insertions() -> Cell:
    """The closure of insertions: the cheapest way from state to state without a row."""
    cell = {(p, p): (0, "") for p in STATES}
    for _ in STATES:
        for (p, q), (cost, audit) in list(cell.items()):
            for role in "ua":
                to = STEP.get((q, role))
                if to is not None:
                    found = (cost + INSERT, audit + "I")
                    cell[p, to] = min(cell.get((p, to), found), found)
    return tuple(cell.get((p, q)) for p in STATES for q in STATES)


@functools.cache
def leaf(symbol: str) -> Cell:
    """One row. ``x`` must be deleted; otherwise the initial of its role (``o``: any other), as a
    capital letter if the row is truncated."""
    cell: dict = {(p, p): (DELETE, "D") for p in STATES}

    def offer(p: int, role: str, cost: int, edit: str) -> None:
        q = STEP.get((p, role))
        if q is not None:
            cell[p, q] = min(cell.get((p, q), (cost, edit)), (cost, edit))

    if symbol != "x":
        fault = TRUNCATED if symbol.isupper() else 0
        for p in STATES:
            offer(p, symbol.lower(), fault, "K")
            for role in "ua":
                offer(p, role, REROLE + fault, "R")
    row = tuple(cell.get((p, q)) for p in STATES for q in STATES)
    return combined(combined(insertions(), row), insertions())


@functools.lru_cache(maxsize=REMEMBERED)
def parsed(symbols: str) -> Cell:
    """The cell of a span of at least one row, over every split point and by growing length."""
    n = len(symbols)
    chart = {(i, 1): leaf(symbols[i]) for i in range(n)}
    for length in range(2, n + 1):
        for i in range(n - length + 1):
            splits = [combined(chart[i, k], chart[i + k, length - k]) for k in range(1, length)]
            chart[i, length] = tuple(_least(cells) for cells in zip(*splits))
    return chart[0, n]


class Spans:
    """The cell of a conversation whose rows arrive one by one.

    Finished blocks wait as spans of falling length, each twice the next or more; equal ones are
    combined, so a conversation of n rows holds log n spans.
    """

    def __init__(self, block: int = BLOCK):
        self.block, self.open = block, []
        self.spans: list[tuple[int, Cell]] = []

    def add(self, symbol: str) -> None:
        self.open.append(symbol)
        if len(self.open) == self.block:
            self._close()

    def _close(self) -> None:
        cell, length = parsed("".join(self.open)), 1
        self.open = []
        while self.spans and self.spans[-1][0] == length:
            cell = combined(self.spans.pop()[1], cell)
            length *= 2
        self.spans.append((length, cell))

    def best(self) -> tuple[int, str]:
        """The cheapest repair: cost and audit."""
        cells = [cell for _, cell in self.spans]
        if self.open:
            cells.append(parsed("".join(self.open)))
        if not cells:
            return 0, ""
        whole = cells.pop()
        while cells:
            whole = combined(cells.pop(), whole)
        return _least(whole[4 * START + q] for q in FINAL)


class Faults:
    """The figures of one conversation whose rows arrive in order."""

    def __init__(self):
        self.turns, self.low, self.high, self.last = 0, None, None, None
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal, self.before = 0, None
        self.seen: set[bytes] = set()
        self.spans = Spans()

    def add(self, turn: int | None, role: str, text: str) -> None:
        if turn is not None:
            if self.low is None:
                self.low = turn
            self.turns += turn != self.last
            self.high = self.last = turn
        initial = role[:1]
        if self.before is not None:
            self.illegal += self.before + initial not in LEGAL
        self.before = initial
        own = hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()
        ended = text.rstrip(BLANKS)[-1:]
        fault = (
            "blank" if not ended
            else "duplicate" if own in self.seen
            else "truncated" if ended not in ENDS
            else None
        )
        self.seen.add(own)
        if fault:
            self.counts[fault] += 1
        symbol = initial if initial and initial in "sua" else "o"
        self.spans.add("x" if fault in ("blank", "duplicate") else symbol.upper() if fault else symbol)

    def figures(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return gaps, *self.counts.values(), self.illegal, *self.spans.best()


class Repaired:
    """Applies an audit to the rows of a conversation as they arrive: ``role, text`` pairs."""

    def __init__(self, audit: str):
        self.audit, self.at, self.place = audit, 0, 0
        self.system = (len(audit) - audit.count("D")) % 2

    def _role(self) -> str:
        """The role that a legal conversation of this length has here."""
        self.place += 1
        return "assistant" if (self.place - 1 - self.system) % 2 else "user"

    def inserted(self) -> Iterator[tuple[str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            yield self._role(), ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            expected = self._role()
            yield (role if edit == "K" else expected), text


def _figures(rows: Iterator[tuple]) -> Iterator[tuple]:
    current, faults = None, None
    for conv_id, turn, role, text, gone in rows:
        if faults is None or conv_id != current:
            if faults is not None:
                yield current, *faults.figures()
            current, faults = conv_id, Faults()
        if not gone:
            faults.add(turn, role, text)
    if faults is not None:
        yield current, *faults.figures()


def _repaired(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Every conversation's figures lead its rows: ``conv_id, position, role, text``."""
    repair = current = None
    for conv_id, lead, _, role, text, gone, *_, audit in rows:
        if lead == 0:
            if repair is not None:
                yield from ((current, repair.place, *r) for r in repair.inserted())
            repair, current = Repaired(audit), conv_id
        elif not gone:
            yield from ((conv_id, repair.place, *r) for r in repair.row(role, text))
    if repair is not None:
        yield from ((current, repair.place, *r) for r in repair.inserted())


def _digests(rows: Iterator[tuple]) -> Iterator[tuple]:
    held = repair = digest = None

    def feed(turns: Iterable[tuple[str, str]]) -> None:
        nonlocal empty
        for role, text in turns:
            digest.update(("" if empty else "\n").encode() + f"{role}:{text}".encode())
            empty = False

    empty = True
    for conv_id, lead, _, role, text, gone, *figures in rows:
        if lead == 0:
            if held is not None:
                feed(repair.inserted())
                yield *held, digest.hexdigest()
            held, repair, digest, empty = (conv_id, *figures), Repaired(figures[-1]), hashlib.sha256(), True
        elif not gone:
            feed(repair.row(role, text))
    if held is not None:
        feed(repair.inserted())
        yield *held, digest.hexdigest()


def damaged(turns: DataFrame) -> DataFrame:
    """The rows after the damage of the contract: ``conv_id, turn, role, text, gone``. A dropped row
    stays as a mark (``gone``), so that its conversation keeps a row."""

    def read(name: str):
        return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(" "))

    kind = F.pmod(F.crc32(F.concat_ws(":", read("conv_id"), read("turn")).cast("binary")), F.lit(20))
    marked = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        read("role").alias("role"),
        read("text").alias("text"),
        kind.alias("kind"),
    )
    text = (
        F.when(F.col("kind").isin(0, 1), F.lit(""))
        .when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text"))
    )
    return marked.select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        (F.col("kind") == 0).alias("gone"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


def unharmed(turns: DataFrame) -> DataFrame:
    """The rows as they are, in the columns of ``damaged``."""
    return turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        F.lit(False).alias("gone"),
    )


def _sorted(rows: DataFrame, *leading: str) -> DataFrame:
    """Whole conversations in one partition, their rows in order."""
    order = ["conv_id", *leading, F.col("turn").asc_nulls_first(), "role", "text"]
    return rows.repartition("conv_id").sortWithinPartitions(*order)


def audits(rows: DataFrame) -> DataFrame:
    """Per conversation the faults, the cost and the audit of its cheapest repair."""
    return map_rows(_sorted(rows), f"conv_id long, {FIGURES}", _figures)


def _led(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of every conversation in order, led by its figures."""
    led = found.withColumn("lead", F.lit(0)).unionByName(rows.withColumn("lead", F.lit(1)), allowMissingColumns=True)
    names = [c for c in found.columns if c != "conv_id"]
    return _sorted(led.select("conv_id", "lead", "turn", "role", "text", "gone", *names), "lead")


def repaired(turns: DataFrame) -> DataFrame:
    """The logged conversations after their cheapest repair: ``conv_id, position`` (from 1), ``role,
    text``."""
    rows = unharmed(turns)
    return map_rows(
        _led(rows, audits(rows)), "conv_id long, position long, role string, text string", _repaired
    )


def digests(rows: DataFrame) -> DataFrame:
    """The figures of every conversation and the digest of its repaired rows."""
    return map_rows(_led(rows, audits(rows)), f"conv_id long, {FIGURES}, repaired_sha256 string", _digests)


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged and repaired."""
    return digests(damaged(table(spark, sf_dir, "conversations")))
