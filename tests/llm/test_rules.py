import re
from collections import Counter

import numpy as np

from opsmart.llm import rules


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often, inside, seen, dup = Counter(windows), set(), set(), 0
    for i, w in enumerate(windows):
        if often[w] > 1:
            inside.update((i, i + 1, i + 2))
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside)


def test_counts():
    for text in ("", " ", "a b c", "a b c a b c", "x x x x x", "l\nl\n\n \n \nl", "é# ü*\x1c<>", "a b c d a b c", "\x85 a\xa0b"):
        assert rules.counts(text)[:5] == brute(text), repr(text)


def test_learns_and_orders_rules():
    pick = np.random.default_rng(0)
    n = 900
    values = {"symbols_per_word": pick.random(n), "upper_rate": pick.random(n), "noise": pick.random(n)}
    bad = (values["symbols_per_word"] > 0.8) | (values["upper_rate"] > 0.7) & (values["symbols_per_word"] <= 0.3)
    learned = rules.learn(values, bad, np.arange(n) % 3 != 2)
    hit = np.zeros(n, bool)
    for rule in learned:
        hit |= rules.covers(rule, values, np.ones(n, bool))
    assert learned and (hit == bad).mean() > 0.98
    assert rules.learn(values, np.zeros(n, bool), np.arange(n) % 3 != 2) == []


def documents(spark):
    good = " ".join(f"word{i}" for i in range(60))
    noisy = " ".join(f"w{i}%%%" for i in range(60))
    rows = [(i, f"{good} n{i}" if i % 2 else f"{noisy} n{i}") for i in range(120)]
    rows += [(900, None), (901, ""), (902, "short"), (903, "a b c " * 40), (None, good)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_query_rows(spark):
    docs = documents(spark)
    labels = spark.createDataFrame(
        [(i, i % 2) for i in range(120)] + [(1, 0), (None, 0), (5000, 0), (3, None)], "doc_id long, quality int"
    )
    out = {r.doc_id: r for r in rules.judged(docs, labels).collect()}
    assert all(out[i].kept == bool(i % 2) for i in range(120))
    assert [out[i].base_failed for i in (900, 901, 902, 903, None)] == [True, True, True, True, False]
    kept = rules.keep(docs.withColumn("rule", docs.doc_id), labels)
    assert kept.columns == ["doc_id", "text", "rule"] and kept.count() == 61
    assert rules.judged(docs, labels.limit(0)).filter("kept").count() == 121
    assert rules.judged(docs.limit(0), labels).count() == 0


def test_repeated_rows_and_names_do_not_matter(spark):
    rows = [(i, "some words " * (60 if i % 3 else 3)) for i in range(60)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(60)], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame(rows + rows[:1] * 3000 + [(0, None)], "doc_id long, text string")
    found = rules.labelled(docs, labels, 50)
    assert found.count() == found.select("doc_id").distinct().count() <= 50
    extra = docs.selectExpr("*", "7 AS _n_words", "8 AS n_words", "9 AS `a.b`", "1 AS row", "2 AS __n_words")
    kept = rules.keep(extra, labels)
    assert kept.columns == extra.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in rules.keep(docs, labels).collect())
    assert all(tuple(r)[2:] == (7, 8, 9, 1, 2) for r in kept.collect())


def test_counts_of_a_text_of_many_megabytes():
    text = "alpha beta gamma #\n" * 600_000  # 11 MB
    assert tuple(rules.counts(text))[:5] == (4 * 600_000, 15 * 600_000, 600_000, 599_999, 4 * 600_000)
