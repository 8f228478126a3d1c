import random
from itertools import permutations
from pathlib import Path

import duckdb
import pytest

from opsmart.llm import filteraudit

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = "doc_id long, quality int, toxic int"


def documents():
    pick = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    base = [" ".join(pick.choice(words) for _ in range(pick.choice([3, 150, 250, 600]))) for _ in range(40)]
    base += ["", "Ab # c", "THE END " * 120, "é" * 90 + "AB", "same beginning " * 40, "same beginning " * 40 + "x"]
    rows = [(i, pick.choice(base), pick.choice(["en", "fr", None, ""]), "s", 0) for i in range(300)]
    rows += [rows[0], rows[0], (None, base[0], "en", "s", 0), (None, base[0], "en", "s", 0)]
    rows += [(1000 + i, "near copy " * 300 + str(i % 50), "de", "s", 0) for i in range(200)]
    rows += [(0, None, "fr", "s", 0), (2000, "", "fr", "s", 0), (7, "long " * 400_000, "en", "s", 0), (9, "long " * 400_000, "en", "s", 0)]
    labels = [(i, pick.choice([0, 1, None]), pick.choice([0, 1])) for i in range(0, 1200, 2)] + [(2, 1, 1), (None, 1, 1)]
    return rows, labels


def brute(rows, labels):
    out = {}
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    blanks = " \t\n\x0b\x0c\r"
    first = {}
    for d, t, *_ in rows:
        if d is not None:
            first[t or ""] = min(d, first.get(t or "", d))
    docs = []
    for d, t, lang, *_ in rows:
        t = t or ""
        words = "".join(" " if c in blanks else c for c in t).split(" ")
        words = [w for w in words if w]
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t),
            "D": any(c in "#$%&*|" for c in t),
            "E": d is not None and d > first[t],
        }
        docs.append((d, lang or "", {k for k, v in fails.items() if v}))
    for order in map("".join, permutations("ABCDE")):
        for step, f in enumerate(order, 1):
            before = set(order[: step - 1])
            for d, part, fails in docs:
                row = out.setdefault((part, order, step), [0] * 7)
                gone = bool(fails & before)
                row[0] += not gone and f not in fails
                row[1] += not gone and f in fails
                row[2] += gone and f in fails
                row[3] += fails == {f}
                row[4] += not gone and f in fails and d in good
                row[5] += not gone and f in fails and d in toxic
                row[6] += 120 // len(fails) if f in fails else 0
    return out


def found(df):
    return {
        (r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley]
        for r in df.collect()
    }


@pytest.mark.parametrize("sizes", [{}, {"range_bytes": 3000, "local_bytes": 5000}])
def test_figures_of_every_order(spark, sizes):
    rows, labels = documents()
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS part", "2 AS mask", "3 AS `a.b`", "4 AS place").repartition(5)
    out = filteraudit.audit(docs, spark.createDataFrame(labels, LABELS).selectExpr("*", "1 AS good", "1 AS n"), **sizes)
    assert found(out) == brute(rows, labels)


def test_ranges_follow_the_bytes(spark):
    rows, _ = documents()
    texts = spark.createDataFrame(rows, SCHEMA).selectExpr("CAST(coalesce(text, '') AS BINARY) AS text")
    cuts = filteraudit.separators(texts, range_bytes=8000)
    assert cuts == sorted(set(cuts)) and len(cuts) > 10
    assert any(cut.startswith(b"near copy near copy") for cut in cuts)


def test_sum_of_all_orders_and_sql(spark):
    rows, labels = documents()
    con = duckdb.connect()
    docs = [r for r in rows if len(r[1] or "") < 10_000]
    spark_docs, spark_labels = spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, LABELS)
    con.register("documents", spark_docs.toArrow())
    con.register("labels", spark_labels.toArrow())
    result = con.execute(filteraudit.OP11_SQL)
    names = [c[0] for c in result.description]
    keys = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    expected = {}
    for row in result.fetchall():
        r = dict(zip(names, row))
        expected[r["part"], r["filter_order"], r["step"]] = [r[k] for k in keys]
    out = found(filteraudit.audit(spark_docs, spark_labels))
    assert out == expected
    for part in {k[0] for k in out}:
        for f in "ABCDE":
            removed = sum(v[1] for k, v in out.items() if k[0] == part and k[1][k[2] - 1] == f)
            assert {v[6] for k, v in out.items() if k[0] == part and k[1][k[2] - 1] == f} == {removed}


def test_empty_tables(spark):
    docs, labels = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], LABELS)
    assert filteraudit.audit(docs, labels).count() == 0
    one = spark.createDataFrame([(1, None, None, None, None)], SCHEMA)
    assert filteraudit.audit(one, labels).count() == 600


def test_trie_holds_every_text():
    pick = random.Random(2)
    texts = {bytes(pick.choice(b"ab") for _ in range(pick.randint(0, 12))) for _ in range(300)} | {b"", b"a" * 1000}
    trie = filteraudit.Trie()
    for i, text in enumerate(sorted(texts, key=hash)):
        assert trie.insert(text, i, "p", 0, 1) == []
    assert sorted(t for t, *_ in trie.rows()) == sorted(texts)


def test_registered():
    import __spark_entry__

    assert "op11_filter_audit" in __spark_entry__.queries() and "op11_filter_audit" in __spark_entry__.oracle_sql()
    assert Path(filteraudit.__file__).parent.name == "llm"
