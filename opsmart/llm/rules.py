"""Quality rules: a learned decision list of threshold conjunctions.

Per text a few counts are taken, from which rates follow. Sequential covering learns from labelled
rows which of them mark a bad text: a rule grows by the condition with the best information gain on
two thirds of the rows, loses its last conditions again where the remaining third is better off
without them, and is kept while it is precise there; the rows it covers leave, and the next rule is
grown. The list becomes one conditional Spark expression, tried in order.

Learning reads at most ``TRAIN_ROWS`` labelled rows, those of smallest hash of ``doc_id``, since a
classifier of a few thresholds does not improve beyond that; the rules judge every row.

Defined results: a null or blank text has no words and fails the base rules; a document labelled
both ways counts as good; labels that are null, or whose document is missing, are left out; without
a bad and a good label nothing is learned and the base rules alone decide.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opsmart.llm.common import map_rows, table, text_or_empty

#: Labelled rows that learning reads at most.
TRAIN_ROWS = 6000
#: A rule must be this precise on the rows it is pruned on, and cover so many bad ones.
PRECISION, SUPPORT = 0.95, 3
MAX_CONDITIONS, MAX_RULES = 4, 16

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper",
    "n_letters", "n_distinct_words", "n_marks",
)
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\v\f\r"


def counts(text: str) -> tuple[int, ...]:
    """The counts of one text, in the order of ``COUNTS``."""
    words = text.encode().split()  # at space and bytes 9 to 13
    n = len(words)
    lines = [line for line in text.split("\n") if line.strip(BLANKS)]
    upper = sum(map(str.isupper, text)) if not text.isascii() else _upper(text)
    blanks = sum(map(text.count, BLANKS))
    return (
        n,
        len(text) - blanks,
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        _repeated(words),
        len(lines),
        upper,
        _letters(text),
        len(set(words)),
        text.count("!") + text.count("?") + text.count("~"),
    )


_UPPER = {c: None for c in range(128) if not chr(c).isupper()}
_NOT_LETTER = {c: None for c in range(128) if not chr(c).isalpha()}


def _upper(text: str) -> int:
    return len(text.translate(_UPPER))


def _letters(text: str) -> int:
    return len(text.translate(_NOT_LETTER))


def _repeated(words: list[bytes]) -> int:
    """Words that stand in a three-word window found twice or more."""
    n = len(words)
    if n < 4:
        return 0
    own = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
    windows = own[:-2] * np.uint64(0x9E3779B97F4A7C15)
    windows = (windows ^ (windows >> np.uint64(29))) + own[1:-1]
    windows *= np.uint64(0xBF58476D1CE4E5B9)
    windows = (windows ^ (windows >> np.uint64(32))) + own[2:]
    order = np.argsort(windows)
    equal = windows[order[1:]] == windows[order[:-1]]
    if not equal.any():
        return 0
    inside = np.zeros(n, bool)
    for which in (order[1:][equal], order[:-1][equal]):
        for k in range(3):
            inside[which + k] = True
    return int(inside.sum())


def _rows(rows: Iterator[tuple]) -> Iterator[tuple]:
    for doc_id, text in rows:
        yield doc_id, *counts(text)


def statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the counts of every row."""
    schema = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS)
    return map_rows(docs.select("doc_id", text_or_empty()), schema, _rows)


#: Rates a rule may use: numerator and denominator. A rate over nothing is zero.
RATES = {
    "n_words": ("n_words", None),
    "mean_word": ("word_chars", "n_words"),
    "symbols_per_word": ("n_symbols", "n_words"),
    "marks_per_word": ("n_marks", "n_words"),
    "dup_lines": ("n_dup_lines", "n_lines"),
    "repeat_words": ("n_repeat_words", "n_words"),
    "upper_rate": ("n_upper", "word_chars"),
    "letter_rate": ("n_letters", "word_chars"),
    "distinct_rate": ("n_distinct_words", "n_words"),
    "words_per_line": ("n_words", "n_lines"),
}


def rate(name: str) -> Column:
    """The rate as a Spark expression over the counts."""
    over, under = RATES[name]
    value = F.col(over).cast("double")
    return value if under is None else F.coalesce(value / F.nullif(F.col(under), F.lit(0)), F.lit(0.0))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


# --- learning ---


@dataclass(frozen=True)
class Condition:
    name: str
    above: bool
    threshold: float

    def holds(self, values: dict[str, np.ndarray]) -> np.ndarray:
        x = values[self.name]
        return x > self.threshold if self.above else x <= self.threshold

    def column(self) -> Column:
        x = rate(self.name)
        return x > self.threshold if self.above else x <= self.threshold

    def __str__(self) -> str:
        return f"{self.name} {'>' if self.above else '<='} {self.threshold:g}"


Rule = tuple[Condition, ...]


def covers(rule: Rule, values: dict[str, np.ndarray], among: np.ndarray) -> np.ndarray:
    found = among
    for condition in rule:
        found = found & condition.holds(values)
    return found


def _best(values: dict[str, np.ndarray], bad: np.ndarray, among: np.ndarray) -> Condition | None:
    """The condition with the highest gain of information about bad rows, over all thresholds."""
    before_bad, before = (bad & among).sum(), among.sum()
    if not before_bad or before_bad == before:
        return None
    base = np.log2(before_bad / before)
    best, gain = None, 1e-9
    for name, x in values.items():
        order = np.argsort(x[among], kind="stable")
        at, hit = x[among][order], bad[among][order]
        cut = np.flatnonzero(at[1:] != at[:-1])
        if not len(cut):
            continue
        below, below_bad = cut + 1, np.cumsum(hit)[cut]
        for above, p, n in ((False, below_bad, below), (True, before_bad - below_bad, before - below)):
            with np.errstate(divide="ignore", invalid="ignore"):
                gains = np.where(p > 0, p * (np.log2(p / n) - base), 0)
            k = int(np.argmax(gains))
            if gains[k] > gain:
                middle = (float(at[cut[k]]) + float(at[cut[k] + 1])) / 2
                best, gain = Condition(name, above, middle), gains[k]
    return best


def learn(values: dict[str, np.ndarray], bad: np.ndarray, grow: np.ndarray) -> list[Rule]:
    """An ordered list of rules for bad rows; ``grow`` marks the rows that rules grow on."""
    rules: list[Rule] = []
    left = np.ones(len(bad), bool)
    while len(rules) < MAX_RULES:
        rule: Rule = ()
        among = left & grow
        while len(rule) < MAX_CONDITIONS and (found := _best(values, bad, among)):
            rule += (found,)
            among = among & found.holds(values)
        if not rule:
            break
        prune = left & ~grow

        def worth(size: int, rule: Rule = rule, prune: np.ndarray = prune) -> float:
            hit = covers(rule[:size], values, prune)
            p = int((hit & bad).sum())
            return (2 * p - int(hit.sum())) / max(1, int(hit.sum()))

        rule = rule[: max(range(1, len(rule) + 1), key=lambda size: (worth(size), -size))]
        hit = covers(rule, values, prune)
        right, own = int((hit & bad).sum()), covers(rule, values, left & grow)
        if right < SUPPORT or right < PRECISION * hit.sum():
            break
        if (own & bad).sum() < PRECISION * own.sum():
            break
        rules.append(rule)
        left &= ~covers(rule, values, left)
    return rules


def labelled(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """``doc_id``, ``good`` and the counts of a bounded number of labelled documents."""
    chosen = (
        labels.select("doc_id", F.col("quality").alias("good"))
        .filter("doc_id is not null and good is not null")
        .groupBy("doc_id")
        .agg(F.max("good").alias("good"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    # At most ``rows`` rows of two numbers; of repeated rows of one id one text counts.
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen.select("doc_id")), "doc_id")
    texts = texts.groupBy("doc_id").agg(F.min("text").alias("text"))
    return statistics(texts).join(F.broadcast(chosen), "doc_id")


def learned(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> list[Rule]:
    """The decision list for these documents."""
    found = labelled(docs, labels, rows).select(
        "doc_id", "good", *[rate(name).alias(name) for name in RATES], base_failed().alias("failed")
    )
    held = sorted(r for r in map(tuple, found.collect()) if not r[-1])
    if not held:
        return []
    columns = list(zip(*held))
    values = {name: np.array(columns[2 + i], float) for i, name in enumerate(RATES)}
    grow = np.arange(len(held)) % 3 != 2
    return learn(values, np.array(columns[1]) == 0, grow)


def verdict(rules: list[Rule]) -> Column:
    """The list as one conditional expression: the number of the first rule that holds, or 0."""
    found = F.lit(0)
    if rules:
        whens = F
        for number, rule in enumerate(rules, 1):
            holds = F.lit(True)
            for condition in rule:
                holds = holds & condition.column()
            whens = whens.when(holds, F.lit(number))
        found = whens.otherwise(F.lit(0))
    return found


def judged(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """Per row of ``docs`` its counts, ``base_failed``, the rule that hit (0: none) and ``kept``."""
    rules = learned(docs, labels, rows)
    return (
        statistics(docs)
        .withColumn("base_failed", base_failed())
        .withColumn("rule", verdict(rules))
        .withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))
    )


def keep(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their own columns."""
    rules = learned(docs, labels)
    names = docs.columns
    schema = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes)
    mark = "_"
    while any(mark + c in names for c in COUNTS):
        mark += "_"
    count = [mark + c for c in COUNTS]
    text_at = names.index("text")

    def rows(inputs: Iterator[tuple]) -> Iterator[tuple]:
        for row in inputs:
            yield *row, *counts(row[text_at] or "")

    wide = map_rows(docs, schema + "".join(f", {c} long" for c in count), rows)
    row = F.struct(*[F.col(f"`{c}`") for c in names]).alias("row")
    own = wide.select(row, *[F.col(a).alias(b) for a, b in zip(count, COUNTS)])
    kept = own.filter(~base_failed() & (verdict(rules) == 0))
    return kept.select(*[F.col(f"row.`{c}`") for c in names])


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base statistics and verdict of every document."""
    found = judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "rule",
    )
