import random

from opsmart.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def logged():
    pick = random.Random(3)
    rows = []
    for i in range(60):
        base = [(r, f"t{pick.randint(0, 2)}") for r in ("user", "assistant") * 3][: pick.randint(1, 6)]
        rows += [(i, k, r, t) for k, (r, t) in enumerate(base)]
    rows += [(70, k, "user", f"long {k}") for k in range(700)] + [(71, k, "user", f"long {k}") for k in range(600)]
    rows += [(80, 0, None, None), (81, 0, "", ""), (82, None, "user", "x"), (82, 0, "user", "y"), (60, 0, "user", "t1"), (60, 0, "user", "t1")]
    return rows


def brute(rows):
    turns = {}
    for c, k, r, t in set(rows):
        turns.setdefault(c, []).append((k is not None, k or 0, r or "", t or ""))
    whole = {c: tuple((r, t) for *_, r, t in sorted(v)) for c, v in turns.items()}
    out = {}
    for c, v in whole.items():
        if not any(len(o) > len(v) and o[: len(v)] == v for o in whole.values()):
            first = min(o for o, w in whole.items() if w == v)
            out[first] = (len(v), sum(w == v for w in whole.values()))
    return out


def test_maximal_conversations(spark):
    rows = logged()
    random.Random(1).shuffle(rows)
    out = chat.collapsed(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.conv_id: (r.n_turns, r.copies) for r in out} == brute(rows)
    assert all(sum(o.conv_id == r.conv_id for o in out) == r.n_turns for r in out)


def test_rendering_and_edges(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "bot", "yo"), (2, 0, "user", "hi"), (None, 0, "user", "a"), (None, 0, "user", "b")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS position", "2 AS conversation")
    out = chat.rendered(df).collect()
    assert [r.rendered for r in sorted(out, key=lambda r: (r.conv_id or 0, r.position)) if r.conv_id] == [
        "<|user|>\nhi<|end|>\n", "<|bot|>\nyo<|end|>\n",
    ]
    assert sum(r.conv_id is None for r in out) == 2
    assert chat.rendered(df.limit(0)).count() == 0


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, 0, "user", "hi")], SCHEMA)
    plan = chat.prefixes(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
